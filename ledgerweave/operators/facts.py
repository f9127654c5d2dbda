"""Fact tables: transactions summed to one row per day or month and key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.measures import BY, income, row_count, spent


def _facts(df: DataFrame, day, by: Sequence[str]) -> DataFrame:
    return (df.groupBy(*by, day.alias("tx_date"), "category", "account")
            .agg(F.sum(spent(df)).alias("spent"),
                 F.sum(income(df)).alias("income"),
                 F.sum(row_count(df)).alias("n")))


def daily_facts(transactions: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """One row per tenant, day, category and account."""
    return _facts(transactions, F.col("tx_date"), by)


def monthly_facts(source: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """One row per tenant, month, category and account.

    ``source`` is raw transactions or daily facts.  ``tx_date`` holds the first
    day of the month, so periods made of whole months work on it unchanged.
    """
    return _facts(source, F.trunc("tx_date", "MM"), by)
