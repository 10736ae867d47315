"""Partitioned layouts of the merged sales data by order date, and pruned counts on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.grouping import layout_files
from ..operators.keys import hot_values_by_median
from ..operators.merge import merge_chain
from ..sinks import (
    add_year_month, date_predicates, write_by_value, write_dynamic, write_skew_split, write_table_by_value, year_predicates,
)
from ..workspace import fresh_dir
from .registry import query, table

# The order date, with a fifth of the orders moved to one day and some orders without a date.
HOT_DAY = "1995-01-23"
SKEWED_DAY = (
    "CASE WHEN o_orderkey % 29 = 3 THEN NULL WHEN o_orderkey % 5 = 0 THEN DATE '1995-01-23' "
    "ELSE CAST(o_orderdate AS DATE) END"
)

MERGED_SQL = f"""
SELECT c_custkey, o_orderkey, l_linenumber, p_name, p_retailprice * l_quantity AS total_sales,
       {SKEWED_DAY} AS order_date
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey"""


def merged(spark, sf):
    rows = merge_chain(
        table(spark, sf, "customer").select("c_custkey"),
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
        table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"),
        ("c_custkey", "o_custkey"), ("o_orderkey", "l_orderkey"), ("l_partkey", "p_partkey"),
    )
    return rows.select(
        "c_custkey", "o_orderkey", "l_linenumber", "p_name",
        (F.col("p_retailprice") * F.col("l_quantity")).alias("total_sales"),
        F.expr(SKEWED_DAY).alias("order_date"),
    )


def stored_schema(df, *partitions: str) -> str:
    """The stored columns with the partition columns last; saves the pass that would infer them."""
    kinds = dict(df.dtypes)
    return ", ".join(f"{c} {kinds[c]}" for c in [*[c for c in df.columns if c not in partitions], *partitions])


def order_days(spark, sf):
    """What the dates are counted on: those of the orders, and for how many merged rows an order stands."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").count() / max(orders.count(), 1)
    return {"count_on": orders.select(F.expr(SKEWED_DAY).alias("order_date")), "rows_each": max(lines, 1.0)}


def order_months(spark, sf):
    days = order_days(spark, sf)
    return days | {"count_on": add_year_month(days["count_on"], F.col("order_date"))}


def write_days(spark, sf):
    """The merged table, one file per order date: path and schema."""
    path, rows = fresh_dir(spark, "by-day"), merged(spark, sf)
    write_by_value(rows, "order_date", path, **order_days(spark, sf))
    return path, stored_schema(rows, "order_date")


@query("layout_single_file", MERGED_SQL)
def _layout_single_file(spark, sf):
    path, schema = write_days(spark, sf)
    return spark.read.schema(schema).orc(path)


@query("layout_skew_split", MERGED_SQL)
def _layout_skew_split(spark, sf):
    """Find the hot dates in the orders, a narrow input, then write cold dates one file each and hot ones apart."""
    path, rows = fresh_dir(spark, "skew-split"), merged(spark, sf)
    days = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    hot = hot_values_by_median(days, F.expr(SKEWED_DAY), name="hot_key", least_rows=100)
    write_skew_split(rows, "order_date", path, hot, hot_files=4)
    return spark.read.schema(stored_schema(rows, "order_date")).orc(path)


YEAR_MONTH_SQL = f"""
SELECT *, CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month
FROM ({MERGED_SQL})"""


def write_year_month(spark, sf):
    """The merged table by year and month: path and schema."""
    path, rows = fresh_dir(spark, "year-month"), add_year_month(merged(spark, sf), F.col("order_date"))
    write_dynamic(rows, ["order_year", "order_month"], path, **order_months(spark, sf))
    return path, stored_schema(rows, "order_year", "order_month")


@query("layout_year_month", YEAR_MONTH_SQL)
def _layout_year_month(spark, sf):
    path, schema = write_year_month(spark, sf)
    return spark.read.schema(schema).orc(path)


@query("layout_files_measured")
def _layout_files_measured(spark, sf):
    """Files and bytes per year and month of the written layout; the tests hold them against the folder."""
    path, schema = write_year_month(spark, sf)
    return layout_files(spark.read.schema(schema).orc(path), "order_year", "order_month")


PRUNED_DAYS = [HOT_DAY, "1998-05-22", "2000-06-30"]
PRUNED_SQL = f"""
SELECT count(*) AS n_rows FROM ({MERGED_SQL}) WHERE order_date IN
({', '.join(f"DATE '{d}'" for d in PRUNED_DAYS)})"""


def fresh_table(spark, label):
    """A table name nobody has used yet, and the folder for it."""
    location = fresh_dir(spark, label)
    return location.rsplit("/", 1)[-1].replace("-", "_"), location


def days_table(spark, sf):
    """The merged table by order date as a table of the catalogue: its name."""
    name, location = fresh_table(spark, "days")
    write_table_by_value(merged(spark, sf), "order_date", name, location, **order_days(spark, sf))
    return name


def months_table(spark, sf):
    """The merged table by year and month as a table of the catalogue: its name."""
    name, location = fresh_table(spark, "months")
    rows = add_year_month(merged(spark, sf), F.col("order_date"))
    write_table_by_value(rows, ["order_year", "order_month"], name, location, **order_months(spark, sf))
    return name


def days_listed():
    return F.col("order_date").isin([F.lit(d).cast("date") for d in PRUNED_DAYS])


@query("pruned_count_date", PRUNED_SQL)
def _pruned_count_date(spark, sf):
    """On one file per date: the catalogue knows the folders of the days, and only these are listed and read."""
    return spark.table(days_table(spark, sf)).filter(days_listed()).agg(F.count(F.lit(1)).alias("n_rows"))


@query("pruned_count_year", PRUNED_SQL)
def _pruned_count_year(spark, sf):
    """On year and month folders, with the years alone."""
    return spark.table(months_table(spark, sf)).filter(year_predicates(PRUNED_DAYS)).agg(F.count(F.lit(1)).alias("n_rows"))


@query("pruned_count_ym", PRUNED_SQL)
def _pruned_count_ym(spark, sf):
    """On year and month folders, with years and months."""
    return spark.table(months_table(spark, sf)).filter(date_predicates(PRUNED_DAYS)).agg(F.count(F.lit(1)).alias("n_rows"))


@query("sink_dynamic_overwrite", """
SELECT event_id, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value, event_type FROM events""")
def _sink_dynamic_overwrite(spark, sf):
    """Write every partition, then rewrite one; the others must stay."""
    path = fresh_dir(spark, "dynamic")
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    write_dynamic(events, ["event_type"], path)
    clicks = events.filter(F.col("event_type") == "click").withColumn("value", F.col("value") * 2)
    write_dynamic(clicks, ["event_type"], path)
    return spark.read.orc(path)
