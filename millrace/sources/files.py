"""File sources. All of them are Spark's own readers: pushdown and pruning come with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_orc(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.orc(path)


def read_parquet(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json_lines(spark: SparkSession, path, schema: str | None = None, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON lines. Without a schema Spark infers one; at scale pass a schema or a small ratio,
    because inference is an extra pass over the input."""
    if schema is not None:
        return spark.read.schema(schema).json(path)
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One column ``value``, one row per line."""
    return spark.read.text(path)


def row_range(spark: SparkSession, rows: int, column: str = "id") -> DataFrame:
    return spark.range(rows).toDF(column)


# A table of at most so many bytes is dealt over all cores before costly work: moving it costs little beside that.
WIDEN_BYTES = 1 << 30
# A task of a scan should not have more bytes than this, as one row group or one gzip file may have.
TASK_BYTES = 256 << 20


def widen(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Spread a scan of few, large pieces over more tasks before costly work per row.

    A small table, or one stored as a single row group or gzip file, is read by few tasks. What counts are
    bytes: a small table is dealt over the cores, a large one only if its tasks would be too large.
    """
    have = df.rdd.getNumPartitions()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = tasks or df.sparkSession.sparkContext.defaultParallelism
    if size <= WIDEN_BYTES:
        return df if have >= wanted else df.repartition(wanted)
    needed = -(-size // TASK_BYTES)
    return df if have >= needed // 2 else df.repartition(needed)
