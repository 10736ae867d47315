"""Merge, skew profile, filters, counts, joins, samples and numbering on the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..datagen.sales import poisson_cuts
from ..functions.dates import add_days, add_years, lenient_date, lenient_timestamp
from ..functions.sales import clean_price, price_value, total_sales
from ..operators.grouping import group_cardinality, layout_advice, row_counts, union_sources
from ..operators.joins import join_by_merge, left_join_hot_right
from ..operators.keys import hot_values_by_median, key_counts, skew_profile, top_keys
from ..operators.merge import merge_chain, merge_sales
from ..operators.numbering import number_rows
from ..operators.sampling import pair_with_sample, sample_bernoulli, sample_by_hash, sample_with_replacement
from ..sources import read_delimited
from ..workspace import fresh_dir
from .registry import query, table

# A fair task at the scale of the test tables; the library default is for real ones.
TEST_ROWS_PER_TASK = 200


def sales_tables(spark, sf):
    """The given tables under the names and types of the sales schema: text keys, dates and prices."""
    text = lambda c: F.col(c).cast("string")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("row_id"), F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("name"), text("c_nationkey").alias("state"), text("c_custkey").alias("cust_id"),
    )
    orders = table(spark, sf, "orders").select(
        text("o_orderkey").alias("order_id"), text("o_custkey").alias("cust_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        F.col("o_orderstatus").alias("shipping_date"), F.col("o_orderpriority").alias("delivery_date"),
        F.lit("carrier").alias("shipping_company"),
    )
    lines = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("order_id"), text("l_partkey").alias("uniq_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    product = table(spark, sf, "part").select(
        text("p_partkey").alias("uniq_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("manufacturer"),
        # Some prices that are no numbers, as in a hand-kept catalogue.
        F.when(F.col("p_partkey") % 41 == 7, "n/a").otherwise(text("p_retailprice")).alias("price"),
        F.col("p_type").alias("description"),
    )
    return customer, orders, lines, product


MERGE_SQL = """
SELECT CAST(c_custkey AS INTEGER) AS row_id, c_name AS full_name, c_mktsegment AS name,
       CAST(c_nationkey AS VARCHAR) AS state, CAST(c_custkey AS VARCHAR) AS cust_id,
       CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS shipping_date, o_orderpriority AS delivery_date,
       CASE WHEN o_orderkey IS NOT NULL THEN 'carrier' END AS shipping_company,
       CAST(l_partkey AS VARCHAR) AS uniq_id, CAST(l_quantity AS INTEGER) AS quantity,
       p_name AS product_name, p_brand AS manufacturer,
       CASE WHEN p_partkey % 41 <> 7 THEN p_retailprice END AS price, p_type AS description,
       CASE WHEN p_partkey % 41 <> 7 THEN p_retailprice * CAST(l_quantity AS INTEGER) END AS total_sales,
       CAST(o_orderdate AS DATE) AS order_date
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
"""


@query("merge_sales", MERGE_SQL)
def _merge_sales(spark, sf):
    return merge_sales(*sales_tables(spark, sf))


HOT_LINES = "CASE WHEN l_linenumber = 1 THEN 1 ELSE l_orderkey END"

SKEWED_MERGE_SQL = """
SELECT c_name, cust, o_orderkey, order_cust, line_order, l_linenumber, l_partkey, p_name
FROM (SELECT c_name, {nulls} AS cust FROM customer) c
LEFT JOIN (SELECT o_orderkey, {orders} AS order_cust FROM orders) o ON cust = order_cust
LEFT JOIN (SELECT {lines} AS line_order, l_linenumber, l_partkey FROM lineitem) l ON o_orderkey = line_order
LEFT JOIN (SELECT p_partkey, p_name FROM part) p ON l_partkey = p_partkey"""

SKEWED_ORDERS = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE o_custkey END"
SOME_NULL_KEYS = "CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE c_custkey END"


def skewed_sides(spark, sf):
    """A third of the orders on one customer, and some customers without a key."""
    customers = table(spark, sf, "customer").select("c_name", F.expr(SOME_NULL_KEYS).alias("cust"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.expr(SKEWED_ORDERS).alias("order_cust")
    )
    return customers, orders


SKEW_JOIN_SQL = f"""
SELECT c_name, cust, o_orderkey, o_totalprice, order_cust
FROM (SELECT c_name, {SOME_NULL_KEYS} AS cust FROM customer) c
LEFT JOIN (SELECT o_orderkey, o_totalprice, {SKEWED_ORDERS} AS order_cust FROM orders) o ON cust = order_cust
"""


@query("join_skew_left", SKEW_JOIN_SQL)
def _join_skew_left(spark, sf):
    return left_join_hot_right(*skewed_sides(spark, sf), "cust", "order_cust", rows_per_task=TEST_ROWS_PER_TASK)


@query("merge_sales_skewed", SKEWED_MERGE_SQL.format(nulls=SOME_NULL_KEYS, orders=SKEWED_ORDERS, lines=HOT_LINES))
def _merge_sales_skewed(spark, sf):
    """The chain of joins with a hot customer, a hot order, and customers without a key."""
    customers, orders = skewed_sides(spark, sf)
    lines = table(spark, sf, "lineitem").select(F.expr(HOT_LINES).alias("line_order"), "l_linenumber", "l_partkey")
    merged = merge_chain(
        customers, orders.drop("o_totalprice"), lines, table(spark, sf, "part").select("p_partkey", "p_name"),
        ("cust", "order_cust"), ("o_orderkey", "line_order"), ("l_partkey", "p_partkey"), TEST_ROWS_PER_TASK,
    )
    return merged.drop("p_partkey")


@query("join_no_broadcast", """
SELECT l_orderkey, l_linenumber, l_partkey, p_name, l_quantity
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def _join_no_broadcast(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return join_by_merge(lines, parts, "l_partkey", "p_partkey").drop("p_partkey")


@query("sample_pairs", """
SELECT o_orderkey, s_suppkey, s_name FROM orders,
  (SELECT s_suppkey, s_name FROM supplier ORDER BY md5('pick' || CAST(s_suppkey AS VARCHAR)), s_suppkey LIMIT 3) s""")
def _sample_pairs(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return pair_with_sample(table(spark, sf, "orders").select("o_orderkey"), suppliers, "s_suppkey", 3, "pick")


# --- projections -----------------------------------------------------------------------------------


@query("proj_total_sales", """
SELECT l_orderkey, l_linenumber, p_retailprice * l_quantity AS total_sales
FROM lineitem JOIN part ON p_partkey = l_partkey""")
def _proj_total_sales(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast("string").alias("price"))
    joined = table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", total_sales(F.col("price"), F.col("l_quantity")).alias("total_sales")
    )


@query("proj_cast_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def _proj_cast_date(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", text.cast("date").alias("order_date"))


# Text that is a number, a decimal, a word or empty, by row.
VERSION_TEXT = (
    "CASE event_id % 4 WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN '' WHEN 2 THEN event_type "
    "ELSE CAST(-user_id AS STRING) END"
)


@query("proj_try_cast", f"SELECT event_id, TRY_CAST({VERSION_TEXT} AS INTEGER) AS version FROM events")
def _proj_try_cast(spark, sf):
    text = F.expr(VERSION_TEXT)
    return table(spark, sf, "events").select("event_id", text.try_cast("int").alias("version"))


@query("proj_try_timestamp", """
SELECT event_id, strftime(CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END, '%Y-%m-%d %H:%M:%S.%f') AS upload_time
FROM events""")
def _proj_try_timestamp(spark, sf):
    good = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, "").otherwise("no time")).otherwise(good)
    stamp = lenient_timestamp(text)
    return table(spark, sf, "events").select(
        "event_id", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("upload_time")
    )


@query("clean_price", """
SELECT p_partkey, CASE WHEN p_partkey % 10 <> 9 THEN p_retailprice END AS price FROM part""")
def _clean_price(spark, sf):
    number = F.col("p_retailprice").cast("string")
    text = F.when(F.col("p_partkey") % 10 == 9, F.concat(F.lit("£"), number, F.lit(" - £99"))).otherwise(
        F.concat(F.lit("£"), number)
    )
    return table(spark, sf, "part").select("p_partkey", clean_price(text).alias("price"))


@query("date_add_years", """
SELECT o_orderkey, CAST(CASE WHEN day(o_orderdate + INTERVAL 15 YEAR) <> day(o_orderdate)
  THEN o_orderdate + INTERVAL 15 YEAR + INTERVAL 1 DAY ELSE o_orderdate + INTERVAL 15 YEAR END AS DATE) AS moved
FROM orders""")
def _date_add_years(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", add_years(day, 15).alias("moved"))


@query("date_add_days", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS shipped FROM orders""")
def _date_add_days(spark, sf):
    days = (F.col("o_orderkey") % 15).cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey", add_days(F.col("o_orderdate").cast("date"), days).alias("shipped")
    )


# --- filters ---------------------------------------------------------------------------------------


@query("filter_lang", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def _filter_lang(spark, sf):
    return table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "lang")


HOT_DAY = "1998-10-03"


@query("filter_hot_cold", f"""
SELECT o_orderkey, CASE WHEN d = DATE '{HOT_DAY}' THEN 'hot' ELSE 'cold' END AS part
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)""")
def _filter_hot_cold(spark, sf):
    day = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate").cast("date"))
    dated = table(spark, sf, "orders").select("o_orderkey", day.alias("d"))
    is_hot = F.col("d").eqNullSafe(F.lit(HOT_DAY).cast("date"))
    hot, cold = dated.filter(is_hot), dated.filter(~is_hot)
    return hot.select("o_orderkey", F.lit("hot").alias("part")).unionByName(
        cold.select("o_orderkey", F.lit("cold").alias("part"))
    )


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%'")
def _filter_like(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").like("small%")).select("p_partkey", "p_name")


# --- aggregates ------------------------------------------------------------------------------------


def join_keys(spark, sf):
    """Every join key of the sales tables."""
    customer, orders, lines, part = (table(spark, sf, name) for name in ("customer", "orders", "lineitem", "part"))
    return {
        "customer.cust": (customer, F.col("c_custkey")),
        "orders.cust": (orders, F.col("o_custkey")),
        "orders.order": (orders, F.col("o_orderkey")),
        "orders.date": (orders, F.col("o_orderdate").cast("date")),
        "lines.order": (lines, F.col("l_orderkey")),
        "lines.product": (lines, F.col("l_partkey")),
        "product.product": (part, F.col("p_partkey")),
    }


KEY_COUNTS_SQL = """
SELECT 'customer.cust' AS source, CAST(c_custkey AS VARCHAR) AS k, count(*) AS n FROM customer GROUP BY 1, 2
UNION ALL SELECT 'orders.cust', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 1, 2
UNION ALL SELECT 'orders.order', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY 1, 2
UNION ALL SELECT 'orders.date', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), count(*) FROM orders GROUP BY 1, 2
UNION ALL SELECT 'lines.order', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem GROUP BY 1, 2
UNION ALL SELECT 'lines.product', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem GROUP BY 1, 2
UNION ALL SELECT 'product.product', CAST(p_partkey AS VARCHAR), count(*) FROM part GROUP BY 1, 2
"""


@query("skew_top_keys", f"""
SELECT source, k AS key, n AS rec_count FROM
  (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, k) AS r FROM ({KEY_COUNTS_SQL}))
WHERE r <= 5""")
def _skew_top_keys(spark, sf):
    parts = [
        top_keys(df, key.cast("string"), 5).select(F.lit(name).alias("source"), "key", "rec_count")
        for name, (df, key) in join_keys(spark, sf).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("skew_profile", f"""
WITH counts AS ({KEY_COUNTS_SQL}), med AS (
  SELECT source, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS max_rows,
         CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_rows
  FROM counts GROUP BY source)
SELECT source, n_keys, n_rows, max_rows, median_rows, max_rows / median_rows AS max_to_median,
       (SELECT count(*) FROM counts c WHERE c.source = med.source AND c.n > 5 * med.median_rows) AS n_hot_keys
FROM med""")
def _skew_profile(spark, sf):
    return skew_profile(join_keys(spark, sf))


@query("skew_hot_values", f"""
WITH counts AS (SELECT {SKEWED_ORDERS} AS key, count(*) AS rec_count FROM orders GROUP BY 1)
SELECT key, rec_count FROM counts WHERE rec_count > 5 * (SELECT quantile_cont(rec_count, 0.5) FROM counts)""")
def _skew_hot_values(spark, sf):
    return hot_values_by_median(table(spark, sf, "orders"), F.expr(SKEWED_ORDERS))


@query("skew_by_date", """
SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS rec_count FROM orders
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8""")
def _skew_by_date(spark, sf):
    return top_keys(table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), 8, "order_date")


@query("check_row_counts", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part""")
def _check_row_counts(spark, sf):
    return row_counts({name: table(spark, sf, name) for name in ("customer", "orders", "lineitem", "part")})


@query("count_distinct_dates", "SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates FROM orders")
def _count_distinct_dates(spark, sf):
    return table(spark, sf, "orders").agg(F.count_distinct(F.col("o_orderdate").cast("date")).alias("n_dates"))


@query("distinct_rows", """
SELECT DISTINCT c_mktsegment, c_nationkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date
FROM orders JOIN customer ON c_custkey = o_custkey""")
def _distinct_rows(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "c_mktsegment", "c_nationkey", "o_orderstatus", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("order_date"),
    ).distinct()


GROUP_KEY = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END"


@query("group_cardinality", f"""
SELECT count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS n_groups
FROM (SELECT {GROUP_KEY} AS k FROM lineitem)""")
def _group_cardinality(spark, sf):
    return group_cardinality(table(spark, sf, "lineitem"), F.expr(GROUP_KEY))


@query("group_count_filtered", """
SELECT o_orderpriority AS key, count(*) AS rec_count FROM orders
WHERE year(o_orderdate) >= 1998 AND o_orderkey % 13 <> 4 GROUP BY 1""")
def _group_count_filtered(spark, sf):
    # Comma-separated lines with m/d/yyyy dates, some of them bad; field 0 is the group, field 1 the date.
    day = F.when(F.col("o_orderkey") % 13 == 4, "Order Date").otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    lines = table(spark, sf, "orders").select(F.concat_ws(",", "o_orderpriority", day).alias("value"))
    fields = F.split("value", ",")
    dated = lines.select(
        F.get(fields, F.lit(0)).alias("k"), lenient_date(F.get(fields, F.lit(1)), "M/d/yyyy").alias("d")
    )
    return key_counts(dated.filter(F.year("d") >= 2020 - 22), "k")


@query("limit_n", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def _limit_n(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return parts.orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)


@query("layout_advice", """
WITH days AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n,
                     CAST(sum(length(o_orderpriority) + 24) AS BIGINT) AS b FROM orders GROUP BY 1),
months AS (SELECT date_trunc('month', d) AS d, sum(n) AS n, CAST(sum(b) AS BIGINT) AS b FROM days GROUP BY 1)
SELECT 'day' AS unit, count(DISTINCT d) AS n_values, min(b) AS min_bytes, max(b) AS max_bytes, avg(b) AS avg_bytes,
       avg(b) >= 2000 AS large_enough FROM days
UNION ALL SELECT 'month', count(DISTINCT d), min(b), max(b), avg(b), avg(b) >= 2000 FROM months""")
def _layout_advice(spark, sf):
    size = F.length("o_orderpriority") + F.lit(24)
    return layout_advice(table(spark, sf, "orders"), F.col("o_orderdate").cast("date"), size, 2000)


# --- samples, union, numbering ---------------------------------------------------------------------


@query("sample_hash", """
SELECT o_orderkey FROM orders
WHERE CAST('0x' || substr(md5('s1' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.1""")
def _sample_hash(spark, sf):
    return sample_by_hash(table(spark, sf, "orders"), F.col("o_orderkey"), 0.1, "s1").select("o_orderkey")


@query("sample_bernoulli")
def _sample_bernoulli(spark, sf):
    return sample_bernoulli(table(spark, sf, "orders"), 0.2, seed=11).select("o_orderkey")


@query("sample_replacement", f"""
SELECT o_orderkey FROM (SELECT o_orderkey, unnest(generate_series(1, n)) AS i FROM (
  SELECT o_orderkey, CAST(len(list_filter([{', '.join(f'CAST({c!r} AS DOUBLE)' for c in poisson_cuts(0.5))}],
    lambda c: c <= CAST('0x' || substr(md5('again:' || CAST(o_orderkey AS VARCHAR)), 1, 7) AS BIGINT) / 268435456.0::DOUBLE))
    AS BIGINT) AS n FROM orders))""")
def _sample_replacement(spark, sf):
    """With replacement: every row as often as a Poisson draw from its key says, on any engine."""
    return sample_with_replacement(table(spark, sf, "orders"), 0.5, F.col("o_orderkey"), "again").select("o_orderkey")


# Names as in hand-kept catalogues: separators, quotes and a line break inside.
ODD_NAME = "|| ', \"best\"; 1|2' || chr(10) || 'new'"


@query("set_union_all", f"""
SELECT 'part' AS catalogue, CAST(p_partkey AS VARCHAR) AS uniq_id, p_name {ODD_NAME} AS product_name,
       p_brand AS manufacturer, p_retailprice AS price FROM part
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name {ODD_NAME}, CAST(s_nationkey AS VARCHAR), s_acctbal
FROM supplier
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name {ODD_NAME}, c_mktsegment, c_acctbal FROM customer""")
def _set_union_all(spark, sf):
    """Three catalogue files with their own separators, headers and column names; one has a currency sign."""
    number = lambda c: F.col(c).cast("string")
    odd = lambda c: F.expr(f"{c} {ODD_NAME}")
    files = {
        "part": (",", True, "id STRING, title STRING, brand STRING, price STRING", [
            number("p_partkey"), odd("p_name"), F.col("p_brand"), F.concat(F.lit("£"), number("p_retailprice")),
        ]),
        "supplier": (";", True, "Id STRING, Label STRING, Brand STRING, List STRING", [
            number("s_suppkey"), odd("s_name"), number("s_nationkey"), number("s_acctbal"),
        ]),
        "customer": ("|", False, "asin STRING, name STRING, maker STRING, cost STRING", [
            number("c_custkey"), odd("c_name"), F.col("c_mktsegment"), number("c_acctbal"),
        ]),
    }
    parts = []
    target = ["catalogue", "uniq_id", "product_name", "manufacturer", "price"]
    for name, (sep, header, schema, columns) in files.items():
        path = fresh_dir(spark, f"catalogue-{name}")
        names = [field.split()[0] for field in schema.split(", ")]
        kept = table(spark, sf, name).select(*[c.alias(n) for c, n in zip(columns, names)])
        kept.write.options(sep=sep, header=header, quote='"', escape='"').csv(path)
        read = read_delimited(spark, path, schema, sep, header, escape='"', multi_line=True)
        price = clean_price(F.col(names[3])) if name == "part" else price_value(F.col(names[3]))
        read = read.select(F.lit(name).alias("src"), *names[:3], price.alias("amount"))
        parts.append((read, dict(zip(target, read.columns))))
    return union_sources(parts)


@query("row_number_per_key", f"""
SELECT o_orderkey, {SKEWED_ORDERS} AS cust,
       row_number() OVER (PARTITION BY {SKEWED_ORDERS} ORDER BY o_orderkey) AS row_num FROM orders""")
def _row_number_per_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.expr(SKEWED_ORDERS).alias("cust"))
    out = number_rows(orders, ["cust"], ["o_orderkey"], rows_per_task=TEST_ROWS_PER_TASK)
    return out


@query("row_number_global", """
SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS row_num FROM part""")
def _row_number_global(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return number_rows(parts, [], ["p_retailprice", "p_partkey"]).select("p_partkey", "row_num")


@query("row_number_text", """
SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment DESC, c_name) AS row_num FROM customer""")
def _row_number_text(spark, sf):
    """By text columns, one of them descending."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    return number_rows(customers, [], [F.desc("c_mktsegment"), "c_name"]).select("c_custkey", "row_num")
