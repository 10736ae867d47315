"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
