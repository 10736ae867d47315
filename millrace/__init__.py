"""Skew-aware sales, text and dump processing as plain PySpark DataFrame operators."""
