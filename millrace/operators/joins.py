"""Left outer joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import ROWS_PER_TASK, hot_salts

# Rows without a key are spread over so many places of the shuffle.
NULL_SALTS = 1 << 20


def left_join_hot_right(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_task: int = ROWS_PER_TASK,
    salts: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right`` with the same rows, for a right side with hot keys.

    Adaptive execution cannot split the right side of a left outer join. So both sides are joined on the
    key and a salt: 0 for ordinary keys; a hot key's right rows are dealt over as many salts as its rows
    need tasks, and left rows that carry it are repeated once per salt. A hot key is one seen in the
    right side, so each such left row has a match under some salt, and its repeats without one are
    filtered out: the rows of the plain join remain. Each side is scanned once, at every size alike.

    Left rows without a key match nothing; their salt is a hash of the row, which spreads them evenly.
    The salt of a right row depends on the row and its input partition, so identical copies are spread
    as well and a repeated task computes the same salt again. ``salts`` may hold known hot keys
    (columns ``hot_key``, ``salts``); each must occur in ``right``. The two sides must not share a
    column name.
    """
    hot = hot_salts(right, right_key, rows_per_task) if salts is None else salts
    if hot.isEmpty():  # a property of the data: without a hot key the plain join, in whatever form Spark takes, is balanced
        return left.join(right, left[left_key] == right[right_key], "left")
    left_hot = hot.select(F.col("hot_key").alias("_left_hot"), F.col("salts").alias("_left_salts"))
    right_hot = hot.select(F.col("hot_key").alias("_right_hot"), F.col("salts").alias("_right_salts"))

    many = F.coalesce(F.col("_left_salts"), F.lit(1))
    alone = F.pmod(F.xxhash64(*left.columns), F.lit(NULL_SALTS)).cast("int")
    own = F.when(F.col(left_key).isNull(), F.array(alone)).otherwise(F.sequence(F.lit(0), many - 1))
    spread_left = (
        left.join(F.broadcast(left_hot), left[left_key] == left_hot["_left_hot"], "left")
        .select(*left.columns, (many > 1).alias("_left_is_hot"), F.explode(own).alias("_left_salt"))
    )
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *right.columns), F.coalesce(F.col("_right_salts"), F.lit(1)))
    spread_right = (
        right.join(F.broadcast(right_hot), right[right_key] == right_hot["_right_hot"], "left")
        .select(*right.columns, dealt.cast("int").alias("_right_salt"))
    )
    on = (spread_left[left_key] == spread_right[right_key]) & (F.col("_left_salt") == F.col("_right_salt"))
    joined = spread_left.join(spread_right.hint("merge"), on, "left")
    matched = ~F.col("_left_is_hot") | F.col("_right_salt").isNotNull()
    return joined.filter(matched).select(*left.columns, *right.columns)


def join_by_merge(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """The same join with broadcasting ruled out for this join only."""
    return left.join(right.hint("merge"), left[left_key] == right[right_key], how)
