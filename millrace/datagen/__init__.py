"""Repeatable sales data with chosen skew."""
