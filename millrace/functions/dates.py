"""Date arithmetic of the order data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_years(day: Column, years: int) -> Column:
    """Same day in another year; 29 February lands on 1 March when there is no such day."""
    moved = F.add_months(day, 12 * years)
    return F.when(F.dayofmonth(moved) != F.dayofmonth(day), F.date_add(moved, 1)).otherwise(moved)


def add_days(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days)


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def lenient_date(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")
