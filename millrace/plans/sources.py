"""Round trips through every source and plain sink: write the table, read it back, return the rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.html import remove_html
from ..sinks import (
    cache_then_coalesce, insert_overwrite, write_bounded, write_csv, write_observed, write_one_record_files, write_orc,
)
from ..sources import (
    article_lines, create_external_csv, create_external_orc, html_articles, read_dataset, read_delimited,
    read_json_lines, read_lines, read_orc, read_table, read_wiki_xml, recompress_lines, row_range, use_database,
)
from ..workspace import fresh_dir
from .registry import query, table, wide_table
from .sales import sales_tables


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


LINES_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS uniq_id,
       CAST(l_quantity AS INTEGER) AS quantity FROM lineitem"""

ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS cust_id,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date, o_orderstatus AS shipping_date,
       o_orderpriority AS delivery_date, 'carrier' AS shipping_company FROM orders"""

PRODUCT_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS uniq_id, p_name AS product_name, p_brand AS manufacturer,
       CASE WHEN p_partkey % 41 <> 7 THEN p_retailprice END AS price, p_type AS description FROM part"""


def product_with_price(df):
    return df.withColumn("price", F.col("price").try_cast("double"))


@query("src_csv_schema", LINES_SQL)
def _src_csv_schema(spark, sf):
    root = fresh_dir(spark, "csv")
    write_csv(sales_tables(spark, sf)[2], root, "orders_product")
    return read_dataset(spark, root, "orders_product", "*.gz")


@query("src_csv_header", PRODUCT_SQL)
def _src_csv_header(spark, sf):
    root = fresh_dir(spark, "csv-header")
    write_csv(sales_tables(spark, sf)[3], root, "product", codec=None)
    return product_with_price(read_dataset(spark, root, "product", "*.csv"))


@query("src_orc", ORDERS_SQL)
def _src_orc(spark, sf):
    path = fresh_dir(spark, "orc")
    orders = sales_tables(spark, sf)[1]
    write_orc(orders, path)
    return read_orc(spark, f"{path}/*.orc", orders.schema.simpleString()[7:-1].replace(":", " "))


@query("src_orc_filter", f"SELECT * FROM ({ORDERS_SQL}) WHERE shipping_date <> 'F'")
def _src_orc_filter(spark, sf):
    path = fresh_dir(spark, "orc-filter")
    write_orc(sales_tables(spark, sf)[1], path)
    return read_orc(spark, f"{path}/*.orc").filter(~F.col("shipping_date").eqNullSafe("F"))


@query("src_json_infer", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events""")
def _src_json_infer(spark, sf):
    path = fresh_dir(spark, "json")
    props = F.from_json("props", "k BIGINT")
    table(spark, sf, "events").select("event_id", props.alias("props"), F.struct("event_type").alias("meta")).write.json(
        path
    )
    return read_json_lines(spark, path).select(
        "event_id", F.col("props.k").alias("k"), F.col("meta.event_type").alias("kind")
    )


@query("src_text_lines", "SELECT event_type || ',' || CAST(event_id AS VARCHAR) AS value FROM events")
def _src_text_lines(spark, sf):
    path = fresh_dir(spark, "lines")
    table(spark, sf, "events").select(F.concat_ws(",", "event_type", "event_id").alias("value")).write.text(path)
    return read_lines(spark, path)


@query("src_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _src_table(spark, sf):
    """A table of a database of its own; both leave the catalogue again, the files stay for the rows returned."""
    database, files = unique_name("sales"), fresh_dir(spark, "table")
    before = spark.catalog.currentDatabase()
    use_database(spark, database, fresh_dir(spark, "database"))
    try:
        rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
        rows.write.option("path", files).saveAsTable("customer")
        return read_table(spark, f"{database}.customer")
    finally:
        spark.sql(f"USE {before}")
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query("src_range", """
SELECT id FROM range((SELECT max(o_orderkey) + 1 FROM orders)) t(id) WHERE id NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderkey % 100 = 7""")
def _src_range(spark, sf):
    """The numbers up to the largest order key that no order has, beside some that orders have, negated."""
    keys = table(spark, sf, "orders").select("o_orderkey")
    numbers = row_range(spark, keys.agg(F.max("o_orderkey")).first()[0] + 1)
    missing = numbers.join(keys, numbers["id"] == keys["o_orderkey"], "left_anti")
    present = numbers.filter("id % 100 = 7").join(keys, numbers["id"] == keys["o_orderkey"], "left_semi")
    return missing.unionByName(present.select((-F.col("id")).alias("id")))


@query("ddl_external_csv", LINES_SQL)
def _ddl_external_csv(spark, sf):
    path, name = fresh_dir(spark, "external"), unique_name("orders_product")
    lines = sales_tables(spark, sf)[2]
    lines.write.option("sep", "|").option("header", True).csv(path)
    create_external_csv(spark, name, "order_id STRING, uniq_id STRING, quantity INT", path, header=True)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files of an external table stay
    return rows


@query("sink_csv_gz", f"{LINES_SQL} UNION ALL {LINES_SQL}")
def _sink_csv_gz(spark, sf):
    """Two appends to one folder: the union of both."""
    root = fresh_dir(spark, "csv-gz")
    lines = sales_tables(spark, sf)[2]
    write_csv(lines, root, "orders_product")
    write_csv(lines, root, "orders_product")
    return read_dataset(spark, root, "orders_product", "*.gz")


@query("sink_csv_single", PRODUCT_SQL)
def _sink_csv_single(spark, sf):
    path = fresh_dir(spark, "csv-single")
    product = sales_tables(spark, sf)[3]
    write_bounded(product, path, "csv", rows=table(spark, sf, "part").count(), sep="|", header=True)
    return product_with_price(read_delimited(spark, path, "uniq_id STRING, product_name STRING, manufacturer STRING, "
                                             "price STRING, description STRING", header=True))


@query("sink_orc", f"{ORDERS_SQL} UNION ALL SELECT * FROM ({ORDERS_SQL}) WHERE shipping_date = 'F'")
def _sink_orc(spark, sf):
    path = fresh_dir(spark, "orc-append")
    orders = sales_tables(spark, sf)[1]
    write_orc(orders, path, "overwrite")
    write_orc(orders.filter(F.col("shipping_date") == "F"), path, "append")
    return read_orc(spark, path)


@query("sink_parquet_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _sink_parquet_n(spark, sf):
    path = fresh_dir(spark, "parquet")
    write_bounded(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, files=4)
    return spark.read.parquet(path)


OBSERVED_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
 CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS cust FROM orders"""


@query("sink_observed", f"""
SELECT source, count(*) AS n_rows, CAST(sum(CAST(priority IS NULL AS INTEGER) + CAST(cust IS NULL AS INTEGER)) AS BIGINT) AS n_nulls,
 CAST(sum(coalesce(strlen(priority), 0)) AS BIGINT) AS n_bytes
FROM ({OBSERVED_SQL}), (SELECT unnest(['write', 'table']) AS source) GROUP BY source""")
def _sink_observed(spark, sf):
    """What a write says of its rows, next to the same numbers of the table read back."""
    path = fresh_dir(spark, "observed")
    table(spark, sf, "orders").createOrReplaceTempView("orders_to_write")
    rows = spark.sql(OBSERVED_SQL.replace("FROM orders", "FROM orders_to_write"))
    seen = write_observed(rows, path)
    nulls = F.col("priority").isNull().cast("int") + F.col("cust").isNull().cast("int")
    stored = spark.read.schema(rows.schema).parquet(path).agg(
        F.lit("table").alias("source"), F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("n_nulls"),
        F.sum(F.coalesce(F.octet_length("priority"), F.lit(0))).alias("n_bytes"),
    )
    written = [("write", seen["rows"], seen["nulls"], seen["bytes"])]
    return stored.unionByName(spark.createDataFrame(written, "source STRING, n_rows BIGINT, n_nulls BIGINT, n_bytes BIGINT"))


@query("exec_cache_coalesce", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS twice FROM orders")
def _exec_cache_coalesce(spark, sf):
    path = fresh_dir(spark, "coalesced")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("twice"))
    cache_then_coalesce(orders, path)
    return spark.read.orc(path)


@query("sink_record_per_file", "SELECT text AS value FROM benchmark")
def _sink_record_per_file(spark, sf):
    path = fresh_dir(spark, "records")
    write_one_record_files(table(spark, sf, "benchmark"), path, "text")
    return spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "\n$", "").alias("value"))


@query("sink_insert_overwrite", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _sink_insert_overwrite(spark, sf):
    """A partitioned table filled once; then one partition is replaced."""
    name, path = unique_name("orders_by_priority"), fresh_dir(spark, "insert")
    schema = "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING"
    create_external_orc(spark, name, schema, ["o_orderpriority"], path)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    insert_overwrite(orders, name, ["o_orderpriority"])
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    insert_overwrite(urgent.withColumn("o_totalprice", F.col("o_totalprice") + 1), name, ["o_orderpriority"])
    spark.sql(f"DROP TABLE {name}")
    return read_orc(spark, path, schema)


@query("job_recompress", "SELECT event_type || chr(9) || CAST(event_id AS VARCHAR) AS value FROM events")
def _job_recompress(spark, sf):
    source, target = fresh_dir(spark, "one-gzip"), fresh_dir(spark, "bzip2")
    lines = table(spark, sf, "events").select(F.concat_ws("\t", "event_type", "event_id").alias("value"))
    lines.write.option("compression", "gzip").text(source)
    recompress_lines(spark, source, target, "bzip2", lines_per_file=4000)
    return spark.read.text(target)


# --- articles --------------------------------------------------------------------------------------

ARTICLE_TOKENS_SQL = (
    "list_filter(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{Nl}}\\p{{No}}_]+'), "
    "lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))"
)


# Markup around every document, and the words of it that stay in the article.
WIKI_HEAD = (
    "{{one|{{two|{{three|{{four|{{five}}}}}}}}}} '''Bold''' [[File:x.jpg|thumb|left|a [[b|c]] d]] <ref name=q>note</ref> "
)
WIKI_TAIL = (
    "\n{| class=wikitable\n| cell {| inner |} more\n|}\n[[target|shown]] [[plain link]] [http://example.com/path label here]"
    " https://example.org/bare &nbsp;caf&eacute; [[Category:Things]]"
)
WIKI_TAIL_WORDS = "shown plain link label here café"


@query("job_article_text", f"""
SELECT title, array_to_string(w, ' ') AS line FROM
 (SELECT CAST(doc_id AS VARCHAR) AS title,
  {ARTICLE_TOKENS_SQL.format("('bold ' || replace(replace(text, '[', ' '), ']', ' ') || ' " + WIKI_TAIL_WORDS + "')")} AS w
  FROM documents WHERE doc_id % 10 < 7) WHERE len(w) >= 50""")
def _job_article_text(spark, sf):
    """Documents as a wiki XML dump with markup, talk pages, redirects and pages without a namespace, read back."""
    path = fresh_dir(spark, "wiki")
    kind = F.col("doc_id") % 10
    wiki = F.concat(F.lit(WIKI_HEAD), F.regexp_replace("text", r"[\[\]]", " "), F.lit(WIKI_TAIL))
    wiki = F.when(kind == 8, F.concat(F.lit("#REDIRECT [[x]] "), wiki)).otherwise(wiki)
    body = F.replace(F.replace(wiki, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    space = F.when(kind == 7, "<ns>1</ns>").when(kind.isin(6, 9), "").otherwise("<ns>0</ns>")
    number = F.col("doc_id").cast("string")
    title = F.when(kind == 9, F.concat(F.lit("Talk:"), number)).otherwise(number)
    page = F.concat(
        F.lit("<page><title>"), title, F.lit("</title>"), space, F.lit("<revision><text>"), body,
        F.lit("</text></revision></page>"),
    )
    documents = wide_table(spark, sf, "documents", "doc_id", "text")
    documents.select(page.alias("value")).write.text(path)  # as many files as tasks, no root tag
    return article_lines(read_wiki_xml(spark, path)).select("title", "line")


HTML_TEXT_SQL = r"""
array_to_string(list_filter(list_transform(string_split(regexp_replace(html,
 '(?s)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<[!?][A-Za-z][^>]*>|</?[A-Za-z](?:[^>=]|=[ \t\r\n]*"[^"]*"|=[ \t\r\n]*''[^'']*''|=)*>',
 chr(1), 'g'), chr(1)), lambda n: regexp_replace(n, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), lambda n: n <> ''), ' ')"""
DECODED_HTML_SQL = (
    f"replace(replace(replace(replace({HTML_TEXT_SQL}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"
)


@query("job_article_html", f"""
SELECT page_id, array_to_string(w, ' ') AS line FROM
 (SELECT page_id, {ARTICLE_TOKENS_SQL.format(DECODED_HTML_SQL)} AS w FROM pages) WHERE len(w) >= 50""")
def _job_article_html(spark, sf):
    return html_articles(wide_table(spark, sf, "pages", "page_id", "html")).select("page_id", "line")


@query("text_remove_html", f"SELECT page_id, {DECODED_HTML_SQL} AS clean FROM pages")
def _text_remove_html(spark, sf):
    return wide_table(spark, sf, "pages", "page_id", "html").select("page_id", remove_html(F.col("html")).alias("clean"))
