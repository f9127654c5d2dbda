"""Merchant lookups and recurring charges, on raw transactions or facts by merchant and month."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.measures import BY, double, is_expense, narrow, row_count, spent
from ledgerweave.operators.tally import Tally, tally
from ledgerweave.periods import resolve


def matches_any(column: str, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE over a list of patterns."""
    return reduce(lambda a, b: a | b, [F.col(column).ilike(p) for p in patterns])


def merchant_total_tally(tx: DataFrame, as_of, period, patterns: Sequence[str]) -> Tally:
    return Tally(resolve(period, as_of), {"n": row_count(tx), "spent": spent(tx)},
                 lambda s: [{"n": s("n").cast("long"), "spent": double(s("spent"))}],
                 is_expense(tx) & matches_any("description", patterns), frozenset("n"))


def merchant_total(tx: DataFrame, as_of, period, patterns: Sequence[str], *,
                   by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Number of purchases at matching merchants and their sum."""
    return tally(tx, merchant_total_tally(tx, as_of, period, patterns), by, tenants)


def recurring_charges(tx: DataFrame, as_of=None, period="all", *, min_months: int = 2,
                      always: Sequence[str] = ("Subscriptions",),
                      by: Sequence[str] = BY) -> DataFrame:
    """Merchants charged in at least ``min_months`` months, or ever in ``always``.

    Months are counted by grouping twice: the first round combines on the map
    side, so a merchant with very many rows never meets in one task.
    """
    rows = narrow(tx, as_of, None if period == "all" else period).where(is_expense(tx))
    monthly = (rows.groupBy(*by, "description", F.trunc("tx_date", "MM").alias("month"))
               .agg(F.sum(row_count(tx)).alias("n"), F.sum(spent(tx)).alias("total"),
                    F.max(F.col("category").isin(*always)).alias("fixed")))
    merchants = monthly.groupBy(*by, "description").agg(
        F.count("*").alias("months"),
        (double(F.sum("total")) / F.sum("n")).alias("avg_amount"),
        F.max("fixed").alias("fixed"))
    return (merchants.where((F.col("months") >= min_months) | F.col("fixed"))
            .select(*by, "description", "months", "avg_amount"))
