"""Customers, orders, order lines and products as one wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sales import price_value, total_sales
from ..workspace import fits_broadcast
from .joins import left_join_hot_right
from .keys import ROWS_PER_TASK, hot_salts


def merge_chain(
    customer: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    product: DataFrame,
    cust_key: tuple[str, str] = ("cust_id", "cust_id"),
    order_key: tuple[str, str] = ("order_id", "order_id"),
    product_key: tuple[str, str] = ("uniq_id", "uniq_id"),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Three left joins; column names must differ between the four tables.

    A catalogue measured as small is broadcast and moves no rows. A larger one is joined to the lines first, which are
    narrow then: a product belongs to its line, whatever the line is joined to, and joined last it would move the wide
    merged rows. Hot customers and hot orders are split by salts, after one counting job each that shuffles no keys. A
    hot product sits on the left side, where adaptive execution splits it.
    """
    placed = left_join_hot_right(customer, orders, *cust_key, rows_per_task=rows_per_task)
    if fits_broadcast(product):
        with_lines = left_join_hot_right(placed, lines, *order_key, rows_per_task=rows_per_task)
        return with_lines.join(F.broadcast(product), with_lines[product_key[0]] == product[product_key[1]], "left")
    bought = lines.join(product, lines[product_key[0]] == product[product_key[1]], "left")
    salts = hot_salts(lines, order_key[1], rows_per_task)
    return left_join_hot_right(placed, bought, *order_key, salts=salts)


def merge_sales(
    customer: DataFrame, orders: DataFrame, orders_product: DataFrame, product: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The 24-column sales table (schemas.MERGED plus ``order_date``)."""
    orders = orders.withColumnRenamed("cust_id", "order_cust_id")
    lines = orders_product.withColumnRenamed("order_id", "line_order_id")
    product = product.withColumnRenamed("uniq_id", "product_id")
    merged = merge_chain(
        customer, orders, lines, product,
        ("cust_id", "order_cust_id"), ("order_id", "line_order_id"), ("uniq_id", "product_id"), rows_per_task,
    )
    return merged.select(
        *customer.columns,
        "order_id", "shipping_date", "delivery_date", "shipping_company", "uniq_id", "quantity",
        "product_name", "manufacturer",
        price_value(F.col("price")).alias("price"),
        "description",
        total_sales(F.col("price"), F.col("quantity")).alias("total_sales"),
        F.col("order_date").try_cast("date").alias("order_date"),
    )
