"""Price and quantity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_value(price: Column) -> Column:
    """Text that is no number gives NULL, also under ANSI mode."""
    return price.try_cast("double")


def total_sales(price: Column, quantity: Column) -> Column:
    return price_value(price) * quantity


def clean_price(price: Column, sign: str = "£") -> Column:
    return F.replace(price, F.lit(sign), F.lit("")).try_cast("double")
