"""Registered queries over the given tables, each next to the SQL that must give the same rows."""

from . import generated, layouts, parsing, sales, sources, streams, text  # noqa: F401  (register on import)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
