"""Record streams over the events table. Each query runs to the end of its input and returns the sink's rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import (
    consume, decode_payload, encode_payload, parse_records, publish, read_record_stream, read_stream, to_records,
    track_stream,
)
from ..streaming.shards import publish_batch, publish_once, read_paced
from ..workspace import fresh_dir
from .registry import query, table, wide_table

RECORD = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
RECORD_COLUMNS = ["event_id", "user_id", "event_type", "value"]
EVENTS_SQL = "SELECT event_id, user_id, event_type, value FROM events"


def event_files(spark, sf):
    """The events as a folder of several files: what arrives at a stream source."""
    path = fresh_dir(spark, "arrivals")
    table(spark, sf, "events").select(*RECORD_COLUMNS).repartition(6).write.parquet(path)
    return path


def record_files(spark, sf, damage: bool = False):
    """The events as published records; with ``damage`` every eleventh payload is plain JSON, every
    thirteenth is cut, every seventeenth has text behind its JSON, every nineteenth repeats a key."""
    path = fresh_dir(spark, "shards")
    events = wide_table(spark, sf, "events", *RECORD_COLUMNS)
    if not damage:
        to_records(events, 2).write.partitionBy("shard").parquet(path)
        return path
    plain = F.to_json(F.struct(*RECORD_COLUMNS))
    twice = F.concat(F.lit('{"again":1,"again":2,'), F.substring(plain, 2, 1_000_000))
    body = F.when(F.col("event_id") % 17 == 0, F.concat(plain, F.lit(" garbage"))).when(
        F.col("event_id") % 19 == 0, twice
    ).otherwise(plain)
    packed = events.select("event_id", body.alias("body"), encode_payload(body).alias("payload"))
    cut = F.substring(F.col("payload"), 1, 20)
    payload = F.when(F.col("event_id") % 13 == 0, cut).when(
        F.col("event_id") % 11 == 0, F.encode(F.col("body"), "UTF-8")
    ).otherwise(F.col("payload"))
    packed.select(
        F.md5(F.col("event_id").cast("string")).alias("partition_key"), payload.alias("payload"),
        (F.col("event_id") % 2).cast("int").alias("shard"),
    ).write.partitionBy("shard").parquet(path)
    return path


@query("stream_ingest", EVENTS_SQL)
def _stream_ingest(spark, sf):
    """All files from the earliest on, two per micro-batch, into Parquet."""
    out = fresh_dir(spark, "ingested")
    stream = read_stream(spark, event_files(spark, sf), RECORD, files_per_trigger=2)
    writer = stream.writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", fresh_dir(spark, "position")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(RECORD).parquet(out)


BAD = "(event_id % 13 = 0 OR event_id % 17 = 0)"


@query("stream_decode", f"""
SELECT event_id, user_id, event_type, value, TRUE AS is_decoded FROM events WHERE NOT {BAD}
UNION ALL SELECT NULL, NULL, NULL, NULL, FALSE FROM events WHERE {BAD}""")
def _stream_decode(spark, sf):
    records = spark.read.parquet(record_files(spark, sf, damage=True))
    parsed = parse_records(records, RECORD)
    fields = [F.when(F.col("is_decoded"), F.col(f"record.{c}")).alias(c) for c in RECORD_COLUMNS]
    return parsed.select(*fields, "is_decoded")


@query("stream_publish", EVENTS_SQL)
def _stream_publish(spark, sf):
    """Publish into shards, then decode what the shards hold."""
    out = fresh_dir(spark, "published")
    stream = read_stream(spark, event_files(spark, sf), RECORD)
    publish(stream, out, fresh_dir(spark, "position"), shards=4).awaitTermination()
    records = spark.read.parquet(out)
    return records.select(F.from_json(decode_payload("payload"), RECORD).alias("r")).select("r.*")


@query("stream_sink_json", f"SELECT event_id, user_id, event_type, value FROM events WHERE NOT {BAD}")
def _stream_sink_json(spark, sf):
    """Consume all shards twice with one checkpoint: the second run finds nothing new."""
    source, out, position = record_files(spark, sf, damage=True), fresh_dir(spark, "captured"), fresh_dir(spark, "position")
    for _ in range(2):
        consume(read_record_stream(spark, source, 2), RECORD, out, position).awaitTermination()
    return spark.read.schema(RECORD).json(out)


@query("stream_rejects", f"SELECT md5(CAST(event_id AS VARCHAR)) AS partition_key FROM events WHERE {BAD}")
def _stream_rejects(spark, sf):
    source, out = record_files(spark, sf, damage=True), fresh_dir(spark, "rejected")
    consume(
        read_record_stream(spark, source), RECORD, out, fresh_dir(spark, "position"), rejected=True
    ).awaitTermination()
    return spark.read.schema("partition_key STRING, payload STRING").json(out).select("partition_key")


@query("stream_track", "SELECT event_id FROM events WHERE event_type IN ('click', 'signup')")
def _stream_track(spark, sf):
    out = fresh_dir(spark, "tracked")
    hits = track_stream(read_stream(spark, event_files(spark, sf), RECORD), "event_type", ["CLICK", "sign"])
    writer = hits.select("event_id").writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", fresh_dir(spark, "position")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id BIGINT").parquet(out)


SHARDS = 4


def event_records(events):
    """Records of the events, dealt over the shards by their number."""
    shard = F.pmod(F.col("event_id"), F.lit(SHARDS)).cast("int")
    return to_records(events.select(*RECORD_COLUMNS), SHARDS, F.to_json(F.struct(*RECORD_COLUMNS)), shard)


def shard_totals(rows):
    """Rows, sums and triggers per shard, of a few shards. Squares of some million numbers add up to more than a BIGINT
    holds, so they are added as decimals; the sum is a BIGINT where all shards' sums are, else DECIMAL(38,0)."""
    number = F.col("event_id").cast("decimal(19,0)")
    by_trigger = rows.groupBy("shard", "trigger").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.sum(number * number).alias("squares"),
    )
    totals = by_trigger.groupBy("shard").agg(
        F.sum("n").alias("n_rows"), F.sum("ids").alias("id_sum"), F.sum("squares").cast("decimal(38,0)").alias("square_sum"),
        F.count(F.lit(1)).alias("n_triggers"), F.max("n").alias("most_in_a_trigger"),
    )
    largest = totals.agg(F.max("square_sum").alias("most")).first()["most"]
    return totals.withColumn("square_sum", F.col("square_sum").cast("bigint")) if (largest or 0) < 1 << 63 else totals


@query("stream_paced", f"""
WITH pace AS (SELECT (count(*) + 11) // 12 AS records FROM events),
shards AS (SELECT CAST(event_id % {SHARDS} AS INTEGER) AS shard, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum,
 CAST(sum(event_id * event_id) AS BIGINT) AS square_sum FROM events GROUP BY 1)
SELECT shard, n_rows, id_sum, square_sum, CAST((n_rows + records - 1) // records AS BIGINT) AS n_triggers,
 least(n_rows, records) AS most_in_a_trigger FROM shards, pace""")
def _stream_paced(spark, sf):
    """Read a log of three batches, a twelfth of all records per shard and trigger. The query is started anew for every
    trigger, and goes on where its checkpoint says."""
    log, out, checkpoint = fresh_dir(spark, "log"), fresh_dir(spark, "paced"), fresh_dir(spark, "position")
    events = wide_table(spark, sf, "events", *RECORD_COLUMNS)
    for batch in range(3):
        publish_batch(event_records(events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == batch)), log, batch)
    records = -(-events.count() // 12)
    kept = "event_id BIGINT, shard INT, trigger BIGINT"

    def keep(rows, trigger):
        parsed = rows.select(F.from_json(decode_payload("payload"), RECORD).alias("r"), "shard")
        parsed.select("r.event_id", "shard", F.lit(trigger).cast("bigint").alias("trigger")).write.mode("overwrite").parquet(
            f"{out}/trigger-{trigger}"
        )

    while True:
        run = read_paced(spark, log, checkpoint, records).writeStream.foreachBatch(keep)
        run = run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        if not any(p["numInputRows"] for p in run.recentProgress):
            break
    rows = spark.read.schema(kept).option("recursiveFileLookup", "true").parquet(out)
    return shard_totals(rows)


@query("stream_publish_once", EVENTS_SQL)
def _stream_publish_once(spark, sf):
    """Publish from a stream; its first batch runs again, and a torn batch of an attempt before is there already."""
    log, checkpoint = fresh_dir(spark, "log"), fresh_dir(spark, "position")
    source = event_files(spark, sf)
    stream = read_stream(spark, source, RECORD, files_per_trigger=2)
    table(spark, sf, "events").limit(5).select(F.lit("torn").alias("partition_key"), F.lit(b"x").alias("payload")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{log}/batch=1/shard=0")
    publish_once(event_records(stream), log, checkpoint).awaitTermination()
    assert not publish_batch(event_records(spark.read.schema(RECORD).parquet(source)), log, 0)
    records = spark.read.parquet(log)
    return records.select(F.from_json(decode_payload("payload"), RECORD).alias("r")).select("r.*")
