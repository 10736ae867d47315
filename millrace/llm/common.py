"""Helpers shared by the operators: words, staged tables, numbering of hot groups."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import fresh_dir

# A table of so many bytes at most is broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 * 1024 * 1024

# Bytes of a batch that become Python objects at once; one larger row is taken alone.
SLICE_BYTES = 4 * 1024 * 1024

# Spark's bound on the bytes of a batch that goes to Python; its default of 64 MB is held several times by each task.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# Rows that one task numbers at once.
ROWS_PER_BUCKET = 20_000

# Fixed value: the characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"


def by_value(module: str) -> None:
    """Ship a module's functions to the Python workers by value: executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than the six ASCII blanks, as UTF-8."""
    return utf8(text).split()


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def worker_cache(name: str) -> dict:
    """A dictionary that outlives the task in a reused Python worker."""
    module = sys.modules.setdefault(f"_worker_cache_{name}", types.ModuleType(name))
    return module.__dict__.setdefault("cache", {})


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Staged tables of one operator in the shared folder; ``drop`` removes those not needed any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def stage(self, df: DataFrame, partitions: int | None = None) -> DataFrame:
        """Write and read again: cuts the lineage, survives lost executors, is computed once. ``partitions`` is the most
        files that the table is worth; the shuffle before is read by so many tasks."""
        path = fresh_dir(self.spark, self.label)
        (df.coalesce(partitions) if partitions else df).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            if id(table) in self.paths:
                remove(self.spark, self.paths.pop(id(table))[1])

    def drop_all(self) -> None:
        self.drop(*[table for table, _ in list(self.paths.values())])


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession, label: str):
    """Staged tables that end with the block."""
    held = Scratch(spark, label)
    try:
        yield held
    finally:
        held.drop_all()


def small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Mark a staged table for broadcasting if its counted rows are few enough, else leave it to a shuffle join."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of a table has, for helper columns beside columns of any name."""
    prefix = "_own"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return f"{prefix}_"


def buckets(rows: int, most: int = 65_536) -> int:
    return max(1, min(most, rows // ROWS_PER_BUCKET + 1))


def number_within(df: DataFrame, keys: list[str], order: list[Column], out: str, rows: int) -> DataFrame:
    """Number the rows of each key from 0 without gaps, also where one key holds most rows.

    A key is cut into hash buckets; a bucket's rows are numbered behind the exact counts of the buckets before it.
    Rows alike in all order columns are interchangeable. ``df`` is read twice, so hand in a staged table.
    """
    spread = df.withColumn("number_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets(rows))))
    by = [*keys, "number_bucket"]
    counts = spread.groupBy(*by).agg(F.count(F.lit(1)).alias("bucket_rows"))
    before = Window.partitionBy(*keys).orderBy("number_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, F.coalesce(F.sum("bucket_rows").over(before), F.lit(0)).alias("bucket_start"))
    numbered = spread.withColumn("number_in", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    same = [numbered[k].eqNullSafe(starts[k]) if k in keys else numbered[k] == starts[k] for k in by]
    joined = numbered.join(starts, same, "inner")
    number = F.col("bucket_start") + F.col("number_in") - 1
    return joined.select(*[numbered[c] for c in df.columns], number.cast("long").alias(out))


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends batches of ``SLICE_BYTES`` at most to Python; a smaller bound stays.

    Neither the executor's buffers nor the Python workers, which are reused and keep what they once needed, grow with
    the rows of a batch then.
    """
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= SLICE_BYTES:
        spark.conf.set(BATCH_SETTING, f"{SLICE_BYTES}b")


def sliced(kind: pa.DataType, function: Callable[..., list]) -> Callable[..., pa.Array]:
    """An Arrow function of whole batches from one of lists, which gets slices of bounded bytes."""

    def run(*columns: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays(list(columns), names=[str(i) for i in range(len(columns))])
        parts = [pa.array(function(*[c.to_pylist() for c in part.columns]), type=kind) for part in slices(batch)]
        return pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    return run


ARROW_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
    "array<array<long>>": pa.list_(pa.list_(pa.int64())), "array<int>": pa.list_(pa.int32()),
}
ROW = "_row"


def row_bytes(column: pa.Array) -> np.ndarray:
    """About the bytes that each value of a column takes."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        sizes = pc.binary_length(column)
    elif pa.types.is_list(column.type):
        sizes = pc.multiply(pc.list_value_length(column), 8)
    else:
        return np.full(len(column), 8, dtype=np.int64)
    return pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64) + 8


def slices(batch: pa.RecordBatch | pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch | pa.Array]:
    """Stretches of a batch of about ``limit`` bytes, none larger but for a single row."""
    if len(batch) == 0:
        return
    columns = batch.columns if isinstance(batch, pa.RecordBatch) else [batch]
    sizes = sum((row_bytes(c) for c in columns), np.zeros(len(batch), dtype=np.int64))
    ends = np.cumsum(sizes)
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def scan(df: DataFrame, keep: list[str], added: dict[str, str], start: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """Run Python over Arrow batches: the columns ``keep`` pass untouched, nulls and large ids included.

    A batch is taken in slices of bounded bytes, so that a worker holds the objects of few texts at a time.

    ``start`` runs once per task and returns the function from columns (lists) to the ``added`` columns. That function
    may return ``ROW``, the input row of each output row, to give several or no rows for one.
    """
    small_batches(df.sparkSession)
    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{c}` {kind}" for c, kind in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in (part for whole in batches for part in slices(whole)):
            read = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            out = work(read)
            kept = [batch.column(c) for c in keep]
            if ROW in out:
                rows = pa.array(np.asarray(out[ROW], dtype=np.int64))
                kept = [c.take(rows) for c in kept]
            made = [pa.array(out[c], type=ARROW_TYPES[kind]) for c, kind in added.items()]
            yield pa.RecordBatch.from_arrays(kept + made, names=[*keep, *added])

    return df.mapInArrow(run, schema)
