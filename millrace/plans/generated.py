"""Generated sales data: the rows of the given tables expanded into customers, orders and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..datagen import sales as gen
from .registry import query, table

END_YEAR = 2021


def _hex(digest: str, position: int, n: int | str) -> str:
    return f"CAST('0x' || substr({digest}, {position}, 7) AS BIGINT) % {n}"


def _choice(digest: str, position: int, choices: list[str]) -> str:
    items = ", ".join(f"'{c}'" for c in choices)
    return f"list_extract([{items}], CAST({_hex(digest, position, len(choices))} + 1 AS INTEGER))"


def _poisson(digest: str, position: int, mean: float) -> str:
    cuts = ", ".join(f"CAST({c!r} AS DOUBLE)" for c in gen.poisson_cuts(mean))
    u = f"(CAST('0x' || substr({digest}, {position}, 7) AS BIGINT) / 268435456.0::DOUBLE)"
    return f"CAST(len(list_filter([{cuts}], lambda c: c <= {u})) AS BIGINT)"


# --- customers -------------------------------------------------------------------------------------

H, P = "md5('customer:' || CAST(id AS VARCHAR))", "md5('person:' || CAST(id AS VARCHAR))"
CUSTOMERS_SQL = f"""
SELECT *, CAST(CASE WHEN day(born + INTERVAL 15 YEAR) <> day(born) THEN born + INTERVAL 15 YEAR + INTERVAL 1 DAY
                    ELSE born + INTERVAL 15 YEAR END AS DATE) AS joined FROM (
 SELECT id, {_choice(P, 1, gen.FIRST_NAMES)} AS name, {_choice(P, 8, gen.LAST_NAMES)} AS last,
  {_choice(P, 15, gen.GENDERS)} AS gender,
  CAST(({_hex(P, 22, 999)}) + 1 AS VARCHAR) || ' ' || {_choice(H, 22, gen.STREETS)} AS address,
  '555-' || lpad(CAST({_hex(P, 24, 10000000)} AS VARCHAR), 7, '0') AS telephone,
  {_choice(P, 5, gen.CITIES)} AS city, {_choice(P, 12, gen.STATES)} AS state,
  DATE '1940-01-01' + CAST({_hex(H, 1, gen.BIRTH_DAYS)} AS INTEGER) AS born,
  '3' || lpad(CAST(CAST('0x' || substr({H}, 8, 14) AS BIGINT) AS VARCHAR), 17, '0')
      || lpad(CAST(id AS VARCHAR), 12, '0') AS cust_id
 FROM (SELECT c_custkey AS id FROM customer))"""


def customers(spark, sf):
    return gen.customers(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")))


@query("gen_customers", f"""
SELECT CAST(id AS INTEGER) AS row_id, name || ' ' || last AS full_name, name, gender, address,
 lower(name) || '.' || lower(last) || CAST(id AS VARCHAR) || '@example.com' AS email, telephone, city, state,
 CAST(born AS VARCHAR) AS birth_date, cust_id, CAST(joined AS VARCHAR) AS user_create_date FROM ({CUSTOMERS_SQL})""")
def _gen_customers(spark, sf):
    return customers(spark, sf)


# --- orders ----------------------------------------------------------------------------------------


def _drawn_sql(label: str, mean: float) -> str:
    count = _poisson(f"md5('{label}:' || cust_id)", 1, mean)
    return f"""
SELECT cust_id, joined, md5('{label}:' || cust_id || ':' || CAST(i AS VARCHAR)) AS o
FROM (SELECT cust_id, joined, unnest(generate_series(1, {count})) AS i FROM ({CUSTOMERS_SQL}))"""


def _orders_sql(drawn: str, first: str, days: str) -> str:
    return f"""
SELECT order_id, cust_id, CAST(d AS VARCHAR) AS order_day, CAST(s - d AS BIGINT) AS shipping_gap,
       CAST(v - s AS BIGINT) AS delivery_gap, shipping_company FROM (
 SELECT *, s + CAST({_hex('order_id', 15, gen.DELIVERY_DAYS)} AS INTEGER) AS v FROM (
  SELECT *, d + CAST({_hex('order_id', 8, gen.SHIPPING_DAYS)} AS INTEGER) AS s FROM (
   SELECT o AS order_id, cust_id, {first} + CAST({_hex('o', 1, f'({days})')} AS INTEGER) AS d,
          {_choice('o', 22, gen.COMPANIES)} AS shipping_company FROM ({drawn}))))"""


def order_facts(orders):
    """Day and gaps instead of the three time texts."""
    day = lambda c: F.substring(c, 1, 10).cast("date")
    return orders.select(
        "order_id", "cust_id", F.substring("order_date", 1, 10).alias("order_day"),
        F.datediff(day("shipping_date"), day("order_date")).cast("bigint").alias("shipping_gap"),
        F.datediff(day("delivery_date"), day("shipping_date")).cast("bigint").alias("delivery_gap"),
        "shipping_company",
    )


FIRST_DAY = "make_date(year(joined), 1, 1)"


@query("gen_orders", _orders_sql(
    _drawn_sql("order", 30 * 0.1), FIRST_DAY, f"greatest(DATE '{END_YEAR}-12-31' - {FIRST_DAY} + 1, 1)"
))
def _gen_orders(spark, sf):
    return order_facts(gen.orders(customers(spark, sf), END_YEAR))


@query("gen_skew_orders", _orders_sql(_drawn_sql("skew", 10 * 0.1), "DATE '2020-01-01'", "1"))
def _gen_skew_orders(spark, sf):
    return order_facts(gen.skew_orders(customers(spark, sf), "2020-01-01"))


@query("gen_hot_customers", _orders_sql(
    """SELECT cust_id, md5('hot:' || cust_id || ':' || CAST(id AS VARCHAR)) AS o FROM
       (SELECT unnest(['901', '902', '903', '904']) AS cust_id, id FROM (SELECT o_orderkey AS id FROM orders))""",
    "DATE '2021-01-01'", "1",
))
def _gen_hot_customers(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return order_facts(gen.hot_customer_orders(ids, ["901", "902", "903", "904"], "2021-01-01"))


def _rounds_sql(table_name: str, key: str, label: str, rounds: int, mean: str | float) -> str:
    digest = f"md5('{label}:' || CAST({key} AS VARCHAR))"
    count = mean if isinstance(mean, str) else _poisson(digest, 1, mean)
    chosen = f"md5('{label}:' || CAST(k AS VARCHAR) || ':' || CAST(i AS VARCHAR))"
    return f"""
SELECT k, {_hex(chosen, 8, rounds)} AS round FROM
 (SELECT {key} AS k, unnest(generate_series(1, {count})) AS i FROM {table_name})"""


def _lines_sql(bought: str, offered: str) -> str:
    """Lines of orders and products that meet in a round."""
    key = "md5('line:' || CAST(b.k AS VARCHAR) || ':' || CAST(p.k AS VARCHAR) || ':' || CAST(p.round AS VARCHAR))"
    return f"""
SELECT b.k AS order_id, p.k AS uniq_id, CAST(({_hex(key, 1, 14)}) + 1 AS INTEGER) AS quantity
FROM ({bought}) b JOIN ({offered}) p ON b.round = p.round"""


BOUGHT_SQL = _rounds_sql("orders", "o_orderkey", "buy", 100, 100 * 0.001)
# The cumulated Poisson chances for a mean that depends on the number of products.
CUTS_SQL = """(SELECT list_transform(generate_series(0, 30), lambda k: exp(-m) *
 list_sum(list_transform(generate_series(0, k), lambda j: pow(m, j) / factorial(CAST(j AS INTEGER))))) AS cuts
 FROM (SELECT 100 * (8 / CAST(count(*) AS DOUBLE)) AS m FROM part))"""
OFFERS = (
    "CAST(len(list_filter(cuts, lambda c: c <= "
    "CAST('0x' || substr(md5('offer:' || CAST(p_partkey AS VARCHAR)), 1, 7) AS BIGINT) / 268435456.0::DOUBLE)) AS BIGINT)"
)


@query("gen_order_products", _lines_sql(BOUGHT_SQL, _rounds_sql(f"part, {CUTS_SQL}", "p_partkey", "offer", 100, OFFERS)))
def _gen_order_products(spark, sf):
    """The chance of a product follows from the size of the catalogue."""
    product = table(spark, sf, "part")
    return gen.order_lines(
        table(spark, sf, "orders"), product, product.count(), order_id="o_orderkey", uniq_id="p_partkey"
    )


@query("gen_order_products_fixed", _lines_sql(
    BOUGHT_SQL, _rounds_sql("supplier", "s_suppkey", "offer", 100, 100 * (8 / 1000))
))
def _gen_order_products_fixed(spark, sf):
    """With the expected catalogue size given, both engines draw the same lines."""
    return gen.order_lines(
        table(spark, sf, "orders"), table(spark, sf, "supplier"), 1000, order_id="o_orderkey", uniq_id="s_suppkey"
    )
