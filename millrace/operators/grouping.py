"""Group counts, distinct counts, layout advice and the files of a stored layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_cardinality(df: DataFrame, key: Column, alias: str = "n_groups") -> DataFrame:
    """How many groups there are. NULL counts as a group, as it does for a row-wise group-by."""
    has_null = F.coalesce(F.max(F.when(key.isNull(), 1).otherwise(0)), F.lit(0))
    return df.agg((F.count_distinct(key) + has_null).cast("bigint").alias(alias))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table; each count is answered from file footers where the format allows it."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def union_sources(parts: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """UNION ALL of tables with different column names: each comes with ``{target: source}``."""
    aligned = [
        df.select(*[F.col(source).alias(target) for target, source in names.items()]) for df, names in parts
    ]
    return reduce(DataFrame.unionByName, aligned)


def layout_advice(df: DataFrame, day: Column, row_bytes: Column, min_file_bytes: float) -> DataFrame:
    """Partition size by day and by month, and which of the two reaches ``min_file_bytes`` on average.

    The days are aggregated once; the months are built from the days.
    """
    per_day = df.groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b"))
    per_month = per_day.groupBy(F.trunc("d", "month").alias("d")).agg(F.sum("n").alias("n"), F.sum("b").alias("b"))

    def summary(per_value: DataFrame, unit: str) -> DataFrame:
        return per_value.agg(
            F.count_distinct("d").alias("n_values"),
            F.min("b").cast("bigint").alias("min_bytes"),
            F.max("b").cast("bigint").alias("max_bytes"),
            F.avg("b").alias("avg_bytes"),
        ).select(
            F.lit(unit).alias("unit"), "n_values", "min_bytes", "max_bytes", "avg_bytes",
            (F.col("avg_bytes") >= F.lit(min_file_bytes)).alias("large_enough"),
        )

    return summary(per_day, "day").unionByName(summary(per_month, "month"))


def layout_files(stored: DataFrame, *values: str) -> DataFrame:
    """Rows, files and the bytes of these per partition value of a stored layout.

    The sizes are those that the scan knows of its files; one row per file and task is shuffled, no data column is read.
    """
    found = stored.select(*values, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    files = found.groupBy(*values, "file", "bytes").agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(*values).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"),
        F.min("bytes").alias("least_bytes"), F.max("bytes").alias("most_bytes"), F.avg("bytes").alias("avg_bytes"),
    )
