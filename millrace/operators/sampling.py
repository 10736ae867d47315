"""Samples: Spark's own random ones and a hash-based one that repeats anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..datagen.sales import digest, poisson_count


def sample_bernoulli(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(False, fraction, seed)


def sample_with_replacement(df: DataFrame, fraction: float, key: Column, label: str) -> DataFrame:
    """Every row a Poisson number of times, drawn from its key: a repeated task draws the same again."""
    times = poisson_count(digest(label, key), 1, fraction)
    drawn = df.withColumn("_times", times).filter(F.col("_times") > 0)
    return drawn.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_i")


def hash_fraction(key: Column, salt: str = "") -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5: equal keys always draw the same number."""
    digest = F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") / F.lit(4294967296.0)


def sample_by_hash(df: DataFrame, key: Column, fraction: float, salt: str = "") -> DataFrame:
    return df.filter(hash_fraction(key, salt) < fraction)


def pair_with_sample(left: DataFrame, right: DataFrame, right_key: str, k: int, salt: str = "") -> DataFrame:
    """Each left row with each of k sampled right rows.

    The right sample has a fixed size k, so the output grows with the left side only. The pairs come
    from a slot number on both sides and an equi-join; there is no cartesian product in the plan.
    """
    chosen = (
        right.withColumn("_draw", F.md5(F.concat(F.lit(salt), F.col(right_key).cast("string"))))
        .orderBy("_draw", right_key)
        .limit(k)
    )
    # k rows at most: an array in one row, turned into a slot number per element.
    fields = [c for c in chosen.columns if c != "_draw"]
    packed = chosen.agg(F.sort_array(F.collect_list(F.struct("_draw", *fields))).alias("_rows"))
    slots = packed.select(F.posexplode("_rows").alias("_slot", "_row")).select(
        "_slot", *[F.col(f"_row.{c}").alias(c) for c in fields]
    )
    spread = left.withColumn("_left_slot", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return spread.join(F.broadcast(slots), spread["_left_slot"] == slots["_slot"]).drop("_slot", "_left_slot")
