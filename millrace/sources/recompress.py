"""Turn a non-splittable line file into many splittable or smaller ones."""

from __future__ import annotations

from pyspark.sql import SparkSession


def recompress_lines(
    spark: SparkSession,
    source: str,
    target: str,
    codec: str = "bzip2",
    lines_per_file: int = 4_000_000,
    tasks: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Copy text lines under another codec: ``bzip2`` (splittable), ``gzip`` or ``none``.

    One large gzip file is read by a single task, which only inflates it; the shuffle behind it
    spreads the costly compression over ``tasks`` writers (default: the shuffle width).
    """
    lines = spark.read.text(source)
    width = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartition(width)
        .write.mode(mode)
        .option("compression", codec)
        .option("maxRecordsPerFile", lines_per_file)
        .text(target)
    )
