"""Name to query, name to equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import widen

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is left out where SQL cannot say it."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def wide_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table on all cores, for costly work per row."""
    return widen(table(spark, sf_dir, name).select(*columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
