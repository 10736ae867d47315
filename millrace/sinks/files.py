"""File sinks. Settings travel as write options, so no session setting changes."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import DATASETS, dataset_path

ROWS_PER_FILE = 5_000_000


def write_csv(df: DataFrame, root: str, name: str, mode: str = "append", codec: str | None = "gzip") -> None:
    """A dataset in its declared format: separator and header rule are those of its reader."""
    spec = DATASETS[name]
    writer = df.write.mode(mode).option("sep", spec.sep).option("header", spec.header)
    if codec:
        writer = writer.option("compression", codec)
    writer.csv(dataset_path(root, name))


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").orc(path)


def write_bounded(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    files: int = 1,
    rows_per_file: int = ROWS_PER_FILE,
    rows: int | None = None,
    mode: str = "overwrite",
    **options,
) -> int:
    """``files`` files, or more when they would otherwise exceed ``rows_per_file``.

    A small table ends up in one file; a large one is never squeezed through one task. The shuffle
    in front of the writers keeps the work before it at full width. Pass ``rows`` when known;
    otherwise the frame is counted, so stage an expensive one first. Returns the number of writers.
    """
    total = df.count() if rows is None else rows
    writers = max(files, math.ceil(total / rows_per_file), 1)
    writer = df.repartition(writers).write.mode(mode).options(**options)
    if fmt in ("parquet", "orc"):
        writer = writer.option("compression", options.get("compression", "snappy"))
    writer.format(fmt).save(path)
    return writers


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> dict[str, int]:
    """Write, and give what was written: ``rows``, ``nulls`` of all columns together and ``bytes`` of their texts.

    The numbers are taken while the rows pass, so nothing is read or computed a second time for them.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = sum((F.when(c.isNull(), 1).otherwise(0) for c in columns), F.lit(0))
    texts = [F.col(f"`{c}`") for c, kind in df.dtypes if kind == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    seen = Observation()
    metrics = (
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
    )
    df.observe(seen, *metrics).write.mode(mode).options(**options).format(fmt).save(path)
    return seen.get


def cache_then_coalesce(
    df: DataFrame, path: str, files: int = 1, rows_per_file: int = ROWS_PER_FILE, fmt: str = "orc"
) -> int:
    """Compute at full width into the cache, then narrow without a shuffle for the write.

    The count that fills the cache also bounds the rows per writer. A lost executor's blocks are
    computed again from the source.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        writers = max(files, math.ceil(cached.count() / rows_per_file), 1)
        cached.coalesce(writers).write.mode("overwrite").option("compression", "snappy").format(fmt).save(path)
    finally:
        cached.unpersist()
    return writers


def write_one_record_files(lines: DataFrame, path: str, column: str = "value") -> None:
    """One text file per record."""
    lines.select(F.col(column).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
