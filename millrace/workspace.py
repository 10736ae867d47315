"""Shared working folder: where staged tables, sinks under test and stream checkpoints live.

On a cluster every executor must see the folder, so it comes from ``spark.checkpoint.dir``.
A session of one machine (``local``, not ``local-cluster``) without that setting gets a temporary folder, which goes
when Python ends; any other session is refused.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after its measured size stayed under this.
BROADCAST_BYTES = 32 * 1024 * 1024

# A lookup table of so many rows at most is held as a local relation.
LOOKUP_ROWS = 10_000

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, _local_roots[context.applicationId], ignore_errors=True)
    return _local_roots[context.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet; callers create it by writing to it."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write once, read many: cuts the lineage and survives the loss of executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is in; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, row_bytes: int = 16) -> bool:
    """Whether all rows take at most ``limit`` bytes, measured on no more rows than could fit.

    A row counts with ``row_bytes`` besides its rendered columns, NULLs included, so the sum is on the
    upper side and ``limit / row_bytes`` rows settle the question, however large the table is.
    """
    columns = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(4)) for c in df.columns]
    width = sum(columns, F.lit(row_bytes)) if all(k != "binary" for _, k in df.dtypes) else None
    if width is None:
        return False
    few = df.limit(limit // row_bytes + 1).select(width.cast("bigint").alias("b"))
    return few.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()["b"] <= limit


def lookup_table(df: DataFrame, label: str = "lookup", rows: int = LOOKUP_ROWS) -> DataFrame:
    """Fix the content of a table that is expected to be small, for several joins against it.

    Up to ``rows`` rows become a local relation. More are staged, so nothing unbounded reaches the
    driver. Either is marked for broadcasting only when its measured size allows it.
    """
    few = df.limit(rows + 1).toArrow()
    if few.num_rows <= rows and few.nbytes <= BROADCAST_BYTES:
        return F.broadcast(df.sparkSession.createDataFrame(few, df.schema))
    staged = stage(df, label)
    return F.broadcast(staged) if fits_broadcast(staged) else staged
