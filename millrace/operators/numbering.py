"""Row numbers that do not push a hot key, or the whole table, through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .keys import ROWS_PER_TASK, hot_salts


def _order(order: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def number_table(df: DataFrame, order: list[str | Column], out: str = "row_num") -> DataFrame:
    """``row_number()`` over the whole table by any orderable columns, also descending ones.

    The rows are dealt into ranges of the order and sorted inside each; a row's number is its place in its
    range behind the exact counts of the ranges before. What one task holds depends on the number of
    shuffle partitions only. ``order`` must be total, else rows that tie get any of their numbers.
    """
    columns = _order(order)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
    # The id counts the rows of a partition in its low 33 bits. Staged, as the counts and the rows must agree.
    placed = stage(ranked.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    which = F.shiftright("_place", 33)
    counts = placed.groupBy(which.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(starts), which == starts["_range"])
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return joined.select(*df.columns, number.cast("bigint").alias(out))


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    out: str = "row_num",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``row_number()`` per key, or over the whole table when ``keys`` is empty; ``order`` is a total order.

    The rows of hot keys, found by a sketch, are numbered apart: over the whole of them by key and order,
    minus the rows of the keys before. All others take the ordinary window. Works for every orderable type.
    """
    columns = _order(order)
    if not keys:
        return number_table(df, columns, out)
    spread = df.withColumn("_key", F.to_json(F.struct(*keys)))  # a NULL key is a key like any other
    hot = hot_salts(spread, "_key", rows_per_task).select("hot_key")
    if hot.isEmpty():
        window = Window.partitionBy(*keys).orderBy(*columns)
        return df.select(*df.columns, F.row_number().over(window).cast("bigint").alias(out))
    is_hot = spread["_key"] == hot["hot_key"]
    window = Window.partitionBy(*keys).orderBy(*columns)
    cold = spread.join(F.broadcast(hot), is_hot, "left_anti")
    cold = cold.select(*df.columns, F.row_number().over(window).cast("bigint").alias(out))
    rows = spread.join(F.broadcast(hot), is_hot, "left_semi")
    numbered = number_table(rows, [F.col("_key"), *columns], "_number")
    first = numbered.groupBy("_key").agg(F.min("_number").alias("_first")).withColumnRenamed("_key", "_hot")
    placed = numbered.join(F.broadcast(first), numbered["_key"] == first["_hot"])
    return cold.unionByName(placed.select(*df.columns, (F.col("_number") - F.col("_first") + 1).alias(out)))
