"""A sharded record log in a shared folder: batches that are published once, and a paced source with a position per shard.

A batch is a folder ``batch=N`` with a folder per shard; it counts once its job is committed (the ``_SUCCESS`` file). A
batch that is published again, as a stream does after a failure, is left alone if it counts already and written anew
if it does not, so a retry neither doubles nor loses records. What counts never changes, so a position in a shard is a
batch and a number of rows in it.

The source reads ``records`` rows at most of each shard per trigger. Its only state is the offset log of the sink's
checkpoint, which says where the next trigger starts, also after a restart.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..schemas import STREAM_RECORD

# The source travels to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH, SHARD, DONE = "batch=", "shard=", "_SUCCESS"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class Log:
    """The committed batches of a log."""

    def __init__(self, path: str):
        self.files, self.root = opened(path)

    def _names(self, path: str) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(info.base_name for info in found)

    def is_committed(self, batch: int) -> bool:
        info = self.files.get_file_info(f"{self.root}/{BATCH}{batch}/{DONE}")
        return info.type == fs.FileType.File

    def batches(self) -> list[int]:
        """Numbers of the committed batches, ascending."""
        numbers = [int(n.removeprefix(BATCH)) for n in self._names(self.root) if n.startswith(BATCH)]
        return sorted(n for n in numbers if self.is_committed(n))

    def shards(self, batch: int) -> list[int]:
        return sorted(int(n.removeprefix(SHARD)) for n in self._names(f"{self.root}/{BATCH}{batch}") if n.startswith(SHARD))

    def parts(self, batch: int, shard: int) -> list[str]:
        folder = f"{self.root}/{BATCH}{batch}/{SHARD}{shard}"
        return [f"{folder}/{n}" for n in self._names(folder) if n.endswith(".parquet")]

    def rows(self, batch: int, shard: int) -> int:
        """Rows of a shard in a batch, from the footers of its files."""
        return sum(pq.read_metadata(self.files.open_input_file(p)).num_rows for p in self.parts(batch, shard))

    def read(self, batch: int, shard: int, start: int, end: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
        """The rows from ``start`` to ``end`` in the order of the files."""
        at = 0
        for path in self.parts(batch, shard):
            file = pq.ParquetFile(self.files.open_input_file(path))
            n = file.metadata.num_rows
            if at + n > start and at < end:
                for group in file.iter_batches(columns=columns):
                    low, high = max(start - at, 0), min(end - at, group.num_rows)
                    if low < high:
                        yield group.slice(low, high - low)
                    at += group.num_rows
            else:
                at += n


@dataclass(frozen=True)
class Stretch(InputPartition):
    """Rows of one shard in one batch."""

    shard: int
    batch: int
    start: int
    end: int


class PacedReader(DataSourceStreamReader):
    """Offsets: shard to the batch and the rows of it that are read already."""

    def __init__(self, options: dict[str, str]):
        self.log = Log(options["path"])
        self.records = int(options["records"])
        self.latest = options.get("start", "earliest") == "latest"
        self.checkpoint = options["checkpoint"]

    def initialOffset(self) -> dict:  # noqa: N802
        """Of the shards there are: before their first record, or behind their last. Others start at their first."""
        batches = self.log.batches()
        if not self.latest or not batches:
            return {}
        known = {s for b in batches for s in self.log.shards(b)}
        return {str(s): {"batch": batches[-1], "row": self.log.rows(batches[-1], s)} for s in sorted(known)}

    def position(self) -> dict | None:
        """Where the next trigger starts: the last entry of the checkpoint's offset log."""
        files, root = opened(self.checkpoint)
        found = files.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
        logged = [int(info.base_name) for info in found if info.base_name.isdigit()]
        if not logged:
            return None
        with files.open_input_stream(f"{root}/offsets/{max(logged)}") as f:
            return json.loads(f.read().decode().splitlines()[2])

    def latestOffset(self) -> dict:  # noqa: N802
        """At most ``records`` rows of each shard further."""
        at = self.position()
        if at is None:
            at = self.initialOffset()
        batches = self.log.batches()
        out = dict(at)
        for shard in sorted({s for b in batches for s in self.log.shards(b)}):
            place = at.get(str(shard), {"batch": -1, "row": 0})
            left = self.records
            for batch in (b for b in batches if b >= place["batch"]):
                read = place["row"] if batch == place["batch"] else 0
                rows = self.log.rows(batch, shard)
                step = min(left, rows - read)
                if step > 0:
                    out[str(shard)] = {"batch": batch, "row": read + step}
                    left -= step
                if not left:
                    break
        return out

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for shard, last in sorted(end.items()):
            first = start.get(shard, {"batch": -1, "row": 0})
            for batch in (b for b in self.log.batches() if first["batch"] <= b <= last["batch"]):
                low = first["row"] if batch == first["batch"] else 0
                high = last["row"] if batch == last["batch"] else self.log.rows(batch, int(shard))
                if low < high:
                    out.append(Stretch(int(shard), batch, low, high))
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        stored = ["partition_key", "payload"]
        for batch in self.log.read(partition.batch, partition.shard, partition.start, partition.end, stored):
            shard = pa.array([partition.shard] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*stored, "shard"])


class PacedShards(DataSource):
    """``path`` of the log, ``checkpoint`` of the sink, ``records`` per shard and trigger, ``start``: earliest or latest."""

    @classmethod
    def name(cls) -> str:
        return "paced_shards"

    def schema(self) -> str:
        return f"{STREAM_RECORD}, shard INT"

    def streamReader(self, schema) -> PacedReader:  # noqa: N802
        return PacedReader(dict(self.options))


def read_paced(spark: SparkSession, path: str, checkpoint: str, records: int, start: str = "earliest") -> DataFrame:
    """A stream over a record log that takes at most ``records`` of each shard per trigger.

    ``checkpoint`` must be that of the sink the stream is written to.
    """
    spark.dataSource.register(PacedShards)
    reader = spark.readStream.format("paced_shards").option("path", path).option("checkpoint", checkpoint)
    return reader.option("records", records).option("start", start).load()


def publish_batch(records: DataFrame, path: str, batch: int) -> bool:
    """Write a batch of records (partition_key, payload, shard) unless it counts already; whether it was written."""
    if Log(path).is_committed(batch):
        return False
    records.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/{BATCH}{batch}")
    return True


def publish_once(records: DataFrame, path: str, checkpoint: str, pace: str | None = None) -> StreamingQuery:
    """Publish a stream of records batch by batch; a batch that is run again gives the same log."""
    trigger = {"processingTime": pace} if pace else {"availableNow": True}
    writer = records.writeStream.foreachBatch(lambda rows, batch: publish_batch(rows, path, batch) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
