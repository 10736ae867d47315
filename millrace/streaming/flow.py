"""Record stream: publish into shards, read all shards from the earliest record, append JSON lines.

The transport is an argument (``fmt`` and options), as message-bus connectors are separate jars; the
file source is the default. All sinks are exactly-once through their checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import contains_any_phrase
from ..operators.dump import checked_json
from ..schemas import STREAM_RECORD
from .codec import decode_payload, encode_payload


def read_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int | None = None, **options
) -> DataFrame:
    """A stream over a folder, from its earliest file on; the checkpoint of the sink keeps the position."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def to_records(df: DataFrame, shards: int, body: Column | None = None, shard: Column | None = None) -> DataFrame:
    """Partition key, gzipped JSON body, and the shard: ``shard`` or the one that the key falls into.

    The key is a checksum of the body, so a task that runs again gives every record the same key and shard.
    """
    payload = body if body is not None else F.to_json(F.struct(*df.columns))
    key = F.md5(F.coalesce(payload, F.lit("")))
    place = shard if shard is not None else F.pmod(F.xxhash64("partition_key"), F.lit(shards)).cast("int")
    return df.select("*", key.alias("partition_key"), encode_payload(payload).alias("payload")).select(
        "partition_key", "payload", place.alias("shard")
    )


def _start(writer, pace: str | None) -> StreamingQuery:
    trigger = {"processingTime": pace} if pace else {"availableNow": True}
    return writer.trigger(**trigger).start()


def publish(stream: DataFrame, path: str, checkpoint: str, shards: int = 2, pace: str | None = None) -> StreamingQuery:
    """Write records into shard folders. No shuffle: the hashed keys already spread the records."""
    writer = (
        to_records(stream, shards)
        .writeStream.format("parquet")
        .partitionBy("shard")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, pace)


def read_record_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    return read_stream(spark, path, f"{STREAM_RECORD}, shard INT", files_per_trigger=files_per_trigger)


def parse_records(records: DataFrame, schema: str, payload: str = "payload") -> DataFrame:
    """Columns ``body`` (text), ``record`` (struct) and ``is_decoded``; works on batches and streams."""
    decoded = records.withColumn("body", decode_payload(F.col(payload)))
    # An object, and valid as for dumps: nothing behind it, repeated keys allowed. A good one is parsed once, and filters
    # stay above the generator of one row.
    is_object = F.coalesce(F.col("body").rlike(r"^\s*\{"), F.lit(False))
    checked = decoded.select("*", is_object.alias("_is_object"), F.inline(F.array(checked_json(F.col("body")))))
    typed = F.try_variant_get("details", "$", f"struct<{schema}>")
    record = F.when(F.col("details").isNotNull(), typed).otherwise(F.from_json("body", schema))
    parsed = checked.withColumn("record", F.when(F.col("_is_object"), record))
    return parsed.withColumn("is_decoded", F.col("_is_object") & F.col("is_valid")).drop("_is_object", "details", "is_valid")


def consume(
    records: DataFrame, schema: str, path: str, checkpoint: str, pace: str | None = None, rejected: bool = False
) -> StreamingQuery:
    """Append the decoded records as JSON lines; with ``rejected`` the payloads that could not be read."""
    parsed = parse_records(records, schema)
    if rejected:
        rows = parsed.filter(~F.col("is_decoded")).select("partition_key", F.base64("payload").alias("payload"))
    else:
        rows = parsed.filter(F.col("is_decoded")).select("record.*")
    writer = rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer, pace)


def track_stream(df: DataFrame, text: str, phrases: list[str]) -> DataFrame:
    """Keep the rows that mention one of the phrases; the same on a batch and on a stream."""
    return df.filter(contains_any_phrase(F.col(text), phrases))
