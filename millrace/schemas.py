"""Schemas of the datasets, kept once so that writers and readers agree.

Prices are DOUBLE: text prices go through ``try_cast`` (functions.sales), never a strict cast.
"""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the sales tables.
CUSTOMER = (
    "row_id INT, full_name STRING, name STRING, gender STRING, address STRING, email STRING, "
    "telephone STRING, city STRING, state STRING, birth_date STRING, cust_id STRING, user_create_date STRING"
)
ORDERS = (
    "order_id STRING, cust_id STRING, order_date STRING, shipping_date STRING, "
    "delivery_date STRING, shipping_company STRING"
)
ORDERS_PRODUCT = "order_id STRING, uniq_id STRING, quantity INT"
PRODUCT = "uniq_id STRING, product_name STRING, manufacturer STRING, price STRING, description STRING"

# The merged sales table, without its partition column.
MERGED = (
    "row_id INT, full_name STRING, name STRING, gender STRING, address STRING, email STRING, "
    "telephone STRING, city STRING, state STRING, birth_date STRING, cust_id STRING, user_create_date STRING, "
    "order_id STRING, shipping_date STRING, delivery_date STRING, shipping_company STRING, uniq_id STRING, "
    "quantity INT, product_name STRING, manufacturer STRING, price DOUBLE, description STRING, total_sales DOUBLE"
)

# Pinned, because a sample of records need not show every nested field.
TWEET = (
    "id BIGINT, id_str STRING, created_at STRING, lang STRING, source STRING, text STRING, "
    "truncated BOOLEAN, timestamp_ms STRING, "
    "user STRUCT<id: BIGINT, id_str: STRING, name: STRING, screen_name: STRING, location: STRING, description: STRING>, "
    "extended_tweet STRUCT<full_text: STRING>, "
    "retweeted_status STRUCT<text: STRING, truncated: BOOLEAN, user: STRUCT<screen_name: STRING>, "
    "extended_tweet: STRUCT<full_text: STRING>>, "
    "quoted_status STRUCT<text: STRING, user: STRUCT<screen_name: STRING>, extended_tweet: STRUCT<full_text: STRING>>, "
    "place STRUCT<country: STRING, country_code: STRING>"
)

STREAM_RECORD = "partition_key STRING, payload BINARY"


@dataclass(frozen=True)
class Dataset:
    """How one delimited dataset is stored; shared by its writer and its reader."""

    schema: str
    header: bool = False
    sep: str = "|"


DATASETS = {
    "customer": Dataset(CUSTOMER),
    "orders": Dataset(ORDERS),
    "order_skew": Dataset(ORDERS),
    "orders_product": Dataset(ORDERS_PRODUCT),
    "product": Dataset(PRODUCT, header=True),
}


def dataset_path(root: str, name: str) -> str:
    """The one place that says where a dataset lives."""
    if name not in DATASETS:
        raise KeyError(name)
    return f"{root.rstrip('/')}/{name}"
