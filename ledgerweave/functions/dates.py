"""Date expressions with the meaning the period rules need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(day: Column) -> Column:
    """``YYYY-MM``, for grouping; never for filters, which use date ranges."""
    return F.date_format(day, "yyyy-MM")


def year_key(day: Column) -> Column:
    return F.date_format(day, "yyyy")


def start_of_month(day: Column, offset: int = 0) -> Column:
    return F.add_months(F.trunc(day, "MM"), offset)


def days_before(day: Column, n: int) -> Column:
    return F.date_sub(day, n)


def start_of_week(day: Column) -> Column:
    """The Monday on or before the day."""
    return F.date_trunc("week", day).cast("date")
