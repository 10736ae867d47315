"""Delimited text with an explicit schema: plain or gzip, with or without header, globs allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DATASETS, dataset_path


def read_delimited(
    spark: SparkSession, path, schema: str, sep: str = "|", header: bool = False,
    quote: str = '"', escape: str = "\\", multi_line: bool = False,
) -> DataFrame:
    """A value that does not fit its column type becomes NULL instead of failing the job.

    ``multi_line`` allows line breaks inside quotes; such files cannot be split, so one task reads each.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_dataset(spark: SparkSession, root: str, name: str, pattern: str = "") -> DataFrame:
    spec = DATASETS[name]
    path = dataset_path(root, name) + (f"/{pattern}" if pattern else "")
    return read_delimited(spark, path, spec.schema, spec.sep, spec.header)
