"""Key counts, skew profile and hot-key detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So many rows make a fair task; a key with several times that is worth splitting.
ROWS_PER_TASK = 100_000
# Keys whose counts a sketch follows. A key with a larger share of the rows than one over a fraction of this is seen.
SKETCHED = 16_384
# So many different keys are counted by one task at most, about; a count takes some hundred bytes.
KEYS_PER_TASK = 1_000_000
# Fixed value: the factor by which a key must exceed the median to be called hot.
HOT_FACTOR = 5.0


def key_counts(
    df: DataFrame, key: Column | str, name: str = "key", keys_per_task: int = KEYS_PER_TASK
) -> DataFrame:
    """Rows per key. Spark counts per task before the shuffle, so a hot key sends one row per task.

    Counts of many different keys compress well, and adaptive execution, which goes by bytes, hands most of them to one
    task. Where an estimate finds more than ``keys_per_task`` keys, the keys are dealt over a number of tasks that
    follows from the estimate instead; a task then holds the counts of its keys alone, however many rows a key has.
    """
    column = F.col(key) if isinstance(key, str) else key
    keys = df.select(column.alias(name))
    many = keys.agg(F.approx_count_distinct(name).alias("keys")).first()["keys"]
    if many > keys_per_task:
        keys = keys.repartition(-(-2 * many // keys_per_task), name)
    return keys.groupBy(name).agg(F.count(F.lit(1)).alias("rec_count"))


def top_keys(df: DataFrame, key: Column | str, n: int, name: str = "key") -> DataFrame:
    """The n most frequent keys; the key breaks ties."""
    return key_counts(df, key, name).orderBy(F.desc("rec_count"), F.asc(name)).limit(n)


def frequent_values(df: DataFrame, column: Column, most: int) -> tuple[int, list[tuple]]:
    """Rows of a table, NULLs left out, and its most frequent values with their counts, the largest first.

    One job without a shuffle of the values: every task hands in a sketch. A count may be a little high;
    each value listed does occur.
    """
    values = df.select(column.alias("v")).filter("v IS NOT NULL")
    found = values.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(v, {most}, {SKETCHED})").alias("top")
    ).first()
    return found["rows"], [(t["item"], t["count"]) for t in found["top"]]


def hot_salts(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, factor: float = 2.0) -> DataFrame:
    """The hot keys of a table (``hot_key``) and over how many tasks to deal each (``salts``).

    Hot is relative: a key with more than ``factor`` times the rows of a fair task, which is the table's
    rows by the shuffle partitions, or ``rows_per_task`` if that is more. So there are fewer hot keys
    than shuffle partitions. Counts from the sketch touch the balance only. NULL never joins and is left out.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.select(F.col(key).alias("hot_key")).schema["hot_key"].dataType.simpleString()
    rows, top = frequent_values(df, F.col(key), max(1, min(partitions, SKETCHED // 2)))
    fair = max(rows / partitions, rows_per_task)
    hot = [(value, -(-count // int(fair))) for value, count in top if count > factor * fair]
    return spark.createDataFrame(hot, f"hot_key {kind}, salts INT")


def counts_of_all_keys(sources: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """source, key (as text) and rec_count for several keys of several tables.

    Keys of one table (the same DataFrame) come from one scan, and all of them from one shuffle of counts made per task.
    NULL keys are left out.
    """
    tables: dict[int, tuple[DataFrame, list[Column]]] = {}
    for name, (df, key) in sources.items():
        entry = F.struct(F.lit(name).alias("source"), key.cast("string").alias("key"))
        tables.setdefault(id(df), (df, []))[1].append(entry)
    parts = [df.select(F.inline(F.array(*keys))) for df, keys in tables.values()]
    rows = reduce(DataFrame.unionByName, parts).filter("key IS NOT NULL")
    return rows.groupBy("source", "key").agg(F.count(F.lit(1)).alias("rec_count"))


def skew_profile(sources: dict[str, tuple[DataFrame, Column]], factor: float = HOT_FACTOR) -> DataFrame:
    """One row per join key: keys, rows, largest and median group, and how many keys are hot.

    All counts are exact. How many keys have a count is a small table; the median comes from it, not from the keys.
    """
    counts = counts_of_all_keys(sources)
    histogram = counts.groupBy("source", "rec_count").agg(F.count(F.lit(1)).alias("keys"))
    summary = histogram.groupBy("source").agg(
        F.sum("keys").alias("n_keys"),
        F.sum(F.col("keys") * F.col("rec_count")).alias("n_rows"),
        F.max("rec_count").alias("max_rows"),
        F.percentile("rec_count", F.lit(0.5), F.col("keys")).alias("median_rows"),
    )
    # One row per source, so as many as the caller named.
    hot = histogram.join(F.broadcast(summary.select("source", "median_rows")), "source").groupBy("source").agg(
        F.sum(F.when(F.col("rec_count") > F.lit(factor) * F.col("median_rows"), F.col("keys")).otherwise(0)).alias("n_hot_keys")
    )
    return summary.join(F.broadcast(hot), "source").select(
        "source", "n_keys", "n_rows", "max_rows", "median_rows",
        (F.col("max_rows") / F.col("median_rows")).alias("max_to_median"),
        "n_hot_keys",
    )


def hot_values_by_median(
    df: DataFrame, key: Column, factor: float = HOT_FACTOR, name: str = "key", least_rows: int = 0
) -> DataFrame:
    """Keys whose count exceeds ``factor`` times the median count and reaches ``least_rows``.

    Without a floor most keys of a long tail are hot, as its median is tiny.
    """
    counts = key_counts(df.filter(key.isNotNull()), key, name)
    histogram = counts.groupBy("rec_count").agg(F.count(F.lit(1)).alias("keys"))
    median = histogram.agg(F.percentile("rec_count", F.lit(0.5), F.col("keys")).alias("m")).first()["m"]
    return counts.filter((F.col("rec_count") > F.lit(factor) * F.lit(median)) & (F.col("rec_count") >= least_rows))
