"""Tab-separated dump lines whose fifth field is JSON: split, validate, infer, flatten."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.common import let, strip
from ..functions.dates import lenient_timestamp

# The detail fields of the flat table, in order.
DETAIL_FIELDS = """
birth_date key last_modified name personal_name revision edition_name by_statement latest_revision
lc_classifications lccn notes pagination series subject_place subject_time subjects subtitle telephone
title_prefix translated_from translated_titles translation_of type type_key work author_names authors
string_author string_authors title full_title bio contact_email contact_person contact_title date death_date
description download_url edition first_publish_date genres id_wikidata intro isbn isbn_10 isbn_13 isbn_invalid
isbn_odd_length lang language language_code languages number_of_editions number_of_pages numer_of_pages
openlibrary original_isbn original_language original_languages price publish_country publish_date
publish_places publisher publishers purchase_url website website_name weight writers
""".split()
# A field renamed by its exact name, and a flat column whose name is already taken.
EXACT_RENAMES = {"     _date": "field_date"}
FLAT_RENAMES = {"type": "book_details_parse_type"}


def json_is_valid(text: Column) -> Column:
    """True for exactly one JSON value, false for a missing text too; repeated keys and NaN are accepted, single quotes are not.

    The parser stops behind the first value, so characters that follow it are caught by parsing the
    text once inside a list and once inside an object: no remainder fits into both.
    """
    strict = {"allowSingleQuotes": "false"}
    in_list = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", strict)
    in_object = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), "v STRING, _corrupt_record STRING", strict
    )
    return F.coalesce((F.size(in_list) == 1) & in_object["_corrupt_record"].isNull(), F.lit(False))


# Stands behind the text while it is parsed: only a text that is one whole value leaves it as the next one.
_END = "~end of text~"


def checked_json(text: Column) -> Column:
    """Struct of ``details``, the value as a VARIANT, and ``is_valid`` (see ``json_is_valid``).

    A valid text is parsed once. One that does not parse this way, as it is damaged, repeats a key or holds NaN, has
    no VARIANT and is looked at again for its validity only.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))

    def judge(value: Column) -> Column:
        whole = F.coalesce(F.try_variant_get(value, "$[1]", "string") == _END, F.lit(False)) & ~text.contains(_END)
        details = F.when(whole, F.try_variant_get(value, "$[0]", "variant"))
        return F.struct(details.alias("details"), F.when(whole, F.lit(True)).otherwise(json_is_valid(text)).alias("is_valid"))

    return let(F.try_parse_json(wrapped), judge)


LINE_FIELDS = ["type", "books_ol_number", "version", "upload_date", "book_details"]


def split_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Five fields per line, cut at runs of tabs; the fifth keeps its inner tabs.

    ``is_wellformed`` is false for a line with fewer fields, whose fields are then NULL. The fields come
    out of a generator of one row: filters stay above it, so a line is cut once, not once per use.
    """

    def record(parts: Column) -> Column:
        complete = F.size(parts) == len(LINE_FIELDS)
        fields = [F.when(complete, strip(F.get(parts, F.lit(i)))).alias(f) for i, f in enumerate(LINE_FIELDS)]
        return F.struct(*fields, F.coalesce(complete, F.lit(False)).alias("is_wellformed"))

    cut = F.transform(F.array(F.split(F.col(value), "\t+", len(LINE_FIELDS))), record)
    return lines.select("*", F.inline(cut))


def typed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Split lines with version and upload time typed (NULL where the text does not fit) and JSON checked; ``details`` is
    the JSON as a VARIANT, for the steps behind."""
    cut = split_lines(lines, value)
    # A generator of one row, as for the split: filters stay above it and the JSON is parsed once.
    checked = cut.select("*", F.inline(F.array(checked_json(F.col("book_details")))))
    return (
        checked.withColumn("upload_datetime", lenient_timestamp(F.col("upload_date")))
        .withColumn("version", F.col("version").try_cast("int"))
        .withColumnRenamed("is_valid", "is_valid_json")
        .drop("upload_date")
    )


def accepted(typed: DataFrame) -> DataFrame:
    # What the filter established need not be computed again for the column.
    return typed.filter(F.col("is_valid_json")).withColumn("is_valid_json", F.lit(True))


def rejected(typed: DataFrame, value: str = "value") -> DataFrame:
    """The lines that do not go on, with the reason."""
    reason = F.when(~F.col("is_wellformed"), "fields").otherwise("json")
    return typed.filter(~F.col("is_valid_json")).select(value, reason.alias("reason"))


# --- schema of a JSON column -----------------------------------------------------------------------


def _sql_type(variant_type: str) -> str:
    """Variant type text to a Spark type: numbers widen to DOUBLE or BIGINT, unknown and mixed are STRING."""
    pieces = re.split(r"(`(?:[^`]|``)*`)", variant_type)
    for i in range(0, len(pieces), 2):  # odd pieces are quoted field names
        piece = re.sub(r"DECIMAL\(\d+, ?\d+\)|FLOAT", "DOUBLE", pieces[i])
        piece = re.sub(r"OBJECT<>|\b(?:VOID|VARIANT)\b", "STRING", piece)
        pieces[i] = piece.replace("OBJECT<", "STRUCT<")
    return "".join(pieces)


# Fields in a smaller share of the rows stay out of an inferred schema, so data with ids as names has few columns.
LEAST_SHARE = 0.0005


def json_fields(df: DataFrame, column: str, details: str | None = None) -> DataFrame:
    """name, rows, kind (type text of the VARIANTs, NULL for objects without one) of every field, one row each.

    The names are brought together by a shuffle. Objects with repeated keys count as valid but have no VARIANT; their
    fields are counted as well.
    """
    value = F.col(details) if details else F.try_parse_json(column)
    rows = df.select(F.col(column).alias("_text"), value.alias("_value"))
    objects = rows.filter(F.col("_value").isNotNull()).select("_value")
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_value").outer())).filter("key IS NOT NULL")
    fields = fields.select(F.col("key").alias("name"), "value")
    repeated = rows.filter(F.col("_value").isNull() & F.col("_text").rlike(r"^\s*\{"))
    names = repeated.select(F.explode(F.json_object_keys("_text")).alias("name")).withColumn("value", F.lit(None).cast("variant"))
    return fields.union(names).groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("value").alias("kind"), F.count("value").alias("typed")
    )


def infer_json_schema(
    df: DataFrame, column: str, sampling_ratio: float = 1.0, seed: int = 7, details: str | None = None,
    least_share: float = LEAST_SHARE,
) -> StructType:
    """Schema of the JSON objects in a text column: the fields that at least ``least_share`` of the rows have.

    ``details`` names a column that holds the same objects as VARIANTs. What reaches the driver is bounded: there are no
    more such fields than fields in a row, divided by the share.
    """
    sampled = df if sampling_ratio >= 1.0 else df.sample(False, sampling_ratio, seed)
    least = least_share * sampled.count() if least_share else 0
    found = json_fields(sampled, column, details).filter(F.col("rows") >= F.lit(least)).orderBy("name").collect()
    kinds = [_sql_type(r["kind"] if r["typed"] and r["kind"] else "VOID") for r in found]
    if not found:
        return StructType()
    quoted = ", ".join(f"`{r['name'].replace('`', '``')}` {kind}" for r, kind in zip(found, kinds))
    return StructType.fromDDL(quoted)


def other_fields(details: Column, schema: StructType) -> Column:
    """The fields of an object that a schema leaves out, as a map from name to JSON text."""
    known = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
    every = F.try_variant_get(details, "$", "map<string,variant>")
    rest = F.map_filter(every, lambda name, _: ~F.array_contains(known, name))
    return F.transform_values(rest, lambda _, value: F.to_json(value))


def clean_field_names(schema: StructType, exact: dict[str, str] | None = None) -> StructType:
    """Exact renames, then white space out of the names, then a number behind a name that is taken.

    Names are compared without case, as columns are. Nested structs are treated alike.
    """
    renames = EXACT_RENAMES if exact is None else exact

    def clean(data_type):
        if isinstance(data_type, StructType):
            return clean_field_names(data_type, renames)
        if isinstance(data_type, ArrayType):
            return ArrayType(clean(data_type.elementType), data_type.containsNull)
        return data_type

    taken: set[str] = set()
    fields = []
    for field in schema.fields:
        base = "".join(renames.get(field.name, field.name).split()) or "field"
        name, n = base, 2
        while name.lower() in taken:
            name, n = f"{base}_{n}", n + 1
        taken.add(name.lower())
        fields.append(StructField(name, clean(field.dataType), field.nullable))
    return StructType(fields)


def _type_text(schema: StructType) -> str:
    """A struct type as text that quotes every name."""

    def text(kind) -> str:
        if isinstance(kind, StructType):
            return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {text(f.dataType)}" for f in kind.fields) + ">"
        if isinstance(kind, ArrayType):
            return f"array<{text(kind.elementType)}>"
        return kind.simpleString()

    return text(schema)


def parse_json_column(df: DataFrame, column: str, schema: StructType, out: str, details: str | None = None) -> DataFrame:
    """Parse with the names the JSON has, then cast the struct, by position, to the cleaned names.

    With ``details``, the column that holds the VARIANTs, only texts without one are parsed.
    """
    parsed = F.from_json(F.col(column), schema)
    if details:
        typed = F.try_variant_get(F.col(details), "$", _type_text(schema))
        parsed = F.when(F.col(details).isNotNull(), typed).otherwise(parsed)
    return df.withColumn(out, parsed.cast(clean_field_names(schema)))


def flat_details(parsed: DataFrame, struct: str = "book_details_parse", fields: list[str] | None = None) -> DataFrame:
    """The leading columns and one column per detail field; a field the data lacks is NULL."""
    present = {f.name for f in parsed.schema[struct].dataType.fields}
    details = [
        (F.col(struct)[name] if name in present else F.lit(None).cast("string")).alias(FLAT_RENAMES.get(name, name))
        for name in (fields or DETAIL_FIELDS)
    ]
    return parsed.select("type", "books_ol_number", "version", "upload_datetime", *details)
