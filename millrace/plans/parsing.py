"""Dump lines with a JSON field, built from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dump import (
    DETAIL_FIELDS, FLAT_RENAMES, accepted, clean_field_names, flat_details, infer_json_schema, json_is_valid, other_fields,
    parse_json_column, rejected, split_lines, typed_lines,
)
from ..sinks import write_bounded
from ..workspace import fresh_dir, stage
from .registry import query, table, wide_table

# Kinds of lines by event: good, double tab and a tab inside the JSON, cut JSON, four fields, no version,
# bad time, trailing text, odd field names. The same expression is SQL for both engines.
KIND = "event_id % 9"
DETAILS = f"""
CASE {KIND} WHEN 1 THEN '{{"k":' || chr(9) || CAST(user_id AS STRING) || '}}' WHEN 2 THEN '{{"'
 WHEN 6 THEN props || ' x'
 WHEN 7 THEN '{{"     _date": "' || event_type || '", "a b": 1, "ab": 2, "key": "/k/' || CAST(user_id AS STRING) || '"}}'
 WHEN 8 THEN '{{"title": "' || event_type || '", "revision": ' || CAST(user_id AS STRING)
   || ', "authors": [{{"key": "/a/' || CAST(event_id AS STRING) || '"}}], "type": {{"key": "/type/edition"}}}}'
 ELSE props END"""
TIME_TEXT = {
    "spark": f"CASE WHEN {KIND} = 5 THEN 'yesterday' ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") END",
}
VERSION = f"CASE WHEN {KIND} = 4 THEN ' ' ELSE CAST(user_id AS STRING) END"


def dump_lines(spark, sf):
    tab = F.lit("\t")
    events = wide_table(spark, sf, "events", "event_id", "event_type", "user_id", "ts", "props")
    gap = F.when(F.expr(KIND) == 1, "\t\t\t").otherwise("\t")
    line = F.concat(
        F.lit("/type/"), F.col("event_type"), gap, F.lit(" /books/"), F.col("event_id"), F.lit(" "), tab,
        F.expr(VERSION), tab, F.expr(TIME_TEXT["spark"]),
    )
    details = F.concat(tab, F.expr(DETAILS))
    return events.select(F.when(F.expr(KIND) == 3, line).otherwise(F.concat(line, details)).alias("value"))


def stored_lines(spark, sf):
    path = fresh_dir(spark, "dump")
    dump_lines(spark, sf).write.text(path)
    return spark.read.text(path)


LINES_SQL = f"""(SELECT event_id, {KIND} AS kind, '/type/' || event_type AS type,
 '/books/' || CAST(event_id AS VARCHAR) AS books_ol_number, {VERSION} AS version_text,
 CASE WHEN {KIND} = 5 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS upload_date,
 {DETAILS} AS book_details, user_id, event_type, ts FROM events)"""


@query("parse_split_line", f"""
SELECT CASE WHEN kind <> 3 THEN type END AS type, CASE WHEN kind <> 3 THEN books_ol_number END AS books_ol_number,
       CASE WHEN kind <> 3 THEN trim(version_text) END AS version, CASE WHEN kind <> 3 THEN upload_date END AS upload_date,
       CASE WHEN kind <> 3 THEN book_details END AS book_details, kind <> 3 AS is_wellformed FROM {LINES_SQL}""")
def _parse_split_line(spark, sf):
    return split_lines(stored_lines(spark, sf)).drop("value")


@query("json_valid", f"""
SELECT event_id, json_valid(book_details) AS is_valid_json FROM {LINES_SQL}""")
def _json_valid(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", json_is_valid(F.expr(DETAILS)).alias("is_valid_json")
    )


TYPED_SQL = f"""(SELECT type, books_ol_number, TRY_CAST(version_text AS INTEGER) AS version,
 strftime(CASE WHEN kind <> 5 THEN ts END, '%Y-%m-%d %H:%M:%S.%f') AS upload_time, book_details, kind, user_id, event_type,
 event_id FROM {LINES_SQL} WHERE kind NOT IN (2, 3, 6))"""


def with_time_text(df):
    return df.withColumn("upload_time", F.date_format("upload_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop(
        "upload_datetime"
    )


@query("parse_dump", f"""
SELECT type, books_ol_number, version, upload_time, book_details FROM {TYPED_SQL}""")
def _parse_dump(spark, sf):
    good = accepted(typed_lines(stored_lines(spark, sf)))
    return with_time_text(good).select("type", "books_ol_number", "version", "upload_time", "book_details")


@query("parse_dump_rejects", f"""
SELECT CASE WHEN kind = 3 THEN 'fields' ELSE 'json' END AS reason, count(*) AS n_lines
FROM {LINES_SQL} WHERE kind IN (2, 3, 6) GROUP BY 1""")
def _parse_dump_rejects(spark, sf):
    bad = rejected(typed_lines(stored_lines(spark, sf)))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


@query("json_infer_schema", """
SELECT * FROM (VALUES ('     _date', 'string'), ('a b', 'bigint'), ('ab', 'bigint'),
 ('authors', 'array<struct<key:string>>'), ('k', 'bigint'), ('key', 'string'), ('revision', 'bigint'),
 ('title', 'string'), ('type', 'struct<key:string>')) AS t(field, kind)""")
def _json_infer_schema(spark, sf):
    """The inferred schema as rows: field name and type."""
    schema = infer_json_schema(accepted(typed_lines(dump_lines(spark, sf))), "book_details", details="details")
    rows = [(field.name, field.dataType.simpleString()) for field in schema.fields]
    return spark.createDataFrame(rows, "field STRING, kind STRING")


@query("schema_rename", f"""
SELECT books_ol_number, CASE WHEN kind = 7 THEN event_type END AS field_date,
       CASE WHEN kind = 7 THEN CAST(1 AS BIGINT) END AS ab, CASE WHEN kind = 7 THEN CAST(2 AS BIGINT) END AS ab_2
FROM {TYPED_SQL}""")
def _schema_rename(spark, sf):
    good = accepted(typed_lines(stored_lines(spark, sf)))
    schema = infer_json_schema(good, "book_details")
    assert "field_date" in clean_field_names(schema).names
    parsed = parse_json_column(good, "book_details", schema, "d")
    return parsed.select("books_ol_number", "d.field_date", "d.ab", "d.ab_2")


@query("json_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _json_parse(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("json_serialise", """
SELECT event_id, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '","user":{"id":'
 || CAST(user_id AS VARCHAR) || '}}' AS body FROM events""")
def _json_serialise(spark, sf):
    body = F.to_json(F.struct("event_id", "event_type", F.struct(F.col("user_id").alias("id")).alias("user")))
    return table(spark, sf, "events").select("event_id", body.alias("body"))


# The flat columns that some kind of line fills, as SQL for the other engine; nested ones as JSON text.
FILLED = {
    "key": "CASE WHEN kind = 7 THEN '/k/' || CAST(user_id AS VARCHAR) END",
    "title": "CASE WHEN kind = 8 THEN event_type END",
    "revision": "CASE WHEN kind = 8 THEN user_id END",
    "authors": """CASE WHEN kind = 8 THEN '[{"key":"/a/' || CAST(event_id AS VARCHAR) || '"}]' END""",
    "book_details_parse_type": """CASE WHEN kind = 8 THEN '{"key":"/type/edition"}' END""",
}
FLAT_COLUMNS = [FLAT_RENAMES.get(name, name) for name in DETAIL_FIELDS]


@query("parse_dump_flat", f"""
SELECT type, books_ol_number, version, upload_time,
       {", ".join(f'{FILLED.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in FLAT_COLUMNS)}
FROM {TYPED_SQL}""")
def _parse_dump_flat(spark, sf):
    """All 76 columns of the job as they are stored, nested ones rendered as JSON."""
    path = fresh_dir(spark, "dump-flat")
    good = stage(accepted(typed_lines(stored_lines(spark, sf))), "dump-good")
    schema = infer_json_schema(good, "book_details", details="details")
    parsed = parse_json_column(good, "book_details", schema, "book_details_parse", details="details")
    flat = flat_details(parsed)
    write_bounded(flat, path, files=8, rows=good.count())
    stored = spark.read.schema(flat.schema).parquet(path)
    nested = {f.name: F.to_json(f.name) for f in stored.schema.fields if f.dataType.typeName() in ("struct", "array")}
    return with_time_text(stored.withColumns(nested))


WIDE = """'{"id' || CAST(event_id AS STRING) || '":' || CAST(user_id AS STRING) || ',"kind":"' || event_type || '"}'"""


@query("json_unbounded_keys", f"""
SELECT event_id, event_type AS kind, 'id' || CAST(event_id AS VARCHAR) AS other_name, CAST(user_id AS VARCHAR) AS other_value,
       'kind' AS columns FROM events""")
def _json_unbounded_keys(spark, sf):
    """Objects with an id as a name: only the field that all have becomes a column, the others go to a map."""
    rows = wide_table(spark, sf, "events", "event_id", "event_type", "user_id").select("event_id", F.expr(WIDE).alias("body"))
    held = stage(rows.withColumn("details", F.try_parse_json("body")), "wide")
    schema = infer_json_schema(held, "body", details="details", least_share=0.01)
    parsed = parse_json_column(held, "body", schema, "known", details="details")
    others = F.explode(other_fields(F.col("details"), schema)).alias("other_name", "other_value")
    return parsed.select("event_id", "known.kind", others, F.lit(",".join(schema.names)).alias("columns"))
