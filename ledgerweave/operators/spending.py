"""Spending totals, top lists and comparisons."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.measures import (
    BY, double, has_metric, is_expense, matching, metric, narrow, ratio, row_count, spent,
    with_tenants,
)
from ledgerweave.operators.ranking import top_k
from ledgerweave.operators.tally import Tally, tally
from ledgerweave.periods import Period, as_date, hull, resolve


def spend_total_tally(tx: DataFrame, as_of, period, *, category: str | None = None,
                      account: str | None = None) -> Tally:
    return Tally(resolve(period, as_of), {"spent": spent(tx)},
                 lambda s: [{"spent": double(s("spent"))}],
                 matching(is_expense(tx), category=category, account=account))


def spend_total(tx: DataFrame, as_of, period, *, category: str | None = None,
                account: str | None = None, by: Sequence[str] = BY,
                tenants: DataFrame | None = None) -> DataFrame:
    """Sum of the expenses in a period.

    Only tenants with a matching row appear, unless ``tenants`` lists them all;
    with ``by=()`` there is always one row, holding null over nothing.
    """
    return tally(tx, spend_total_tally(tx, as_of, period, category=category, account=account),
                 by, tenants)


def spend_totals(tx: DataFrame, as_of, slices: Mapping[str, Mapping[str, str]], *,
                 by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Many ``spend_total`` questions in one scan and one shuffle.

    ``slices`` maps a name to ``period`` and optional ``category``/``account``.
    The scan covers the hull of all the periods.
    """
    spans = {name: resolve(s["period"], as_of) for name, s in slices.items()}

    def matches(name):
        s = slices[name]
        hit = spans[name].contains("tx_date")
        for column in ("category", "account"):
            if s.get(column) is not None:
                hit = hit & (F.col(column) == s[column])
        return hit

    rows = tx.where(hull(*spans.values()).contains("tx_date")).where(is_expense(tx))
    sums = with_tenants(rows, tenants, by).groupBy(*by).agg(
        *[double(F.sum(F.when(matches(n), spent(tx)))).alias(f"_{i}")
          for i, n in enumerate(slices)])
    pairs = F.array(*[F.struct(F.lit(n).alias("slice"), F.col(f"_{i}").alias("spent"))
                      for i, n in enumerate(slices)])
    return sums.select(*by, F.explode(pairs).alias("p")).select(*by, "p.slice", "p.spent")


def top_categories(tx: DataFrame, as_of, period, k: int, *,
                   by: Sequence[str] = BY) -> DataFrame:
    rows = narrow(tx, as_of, period).where(is_expense(tx))
    totals = rows.groupBy(*by, "category").agg(F.sum(spent(tx)).alias("total"))
    ranked = top_k(totals, by, [F.desc("total"), F.asc("category")], k)
    return ranked.select(*by, "rank", "category", double(F.col("total")).alias("total"))


def compare_periods_tally(tx: DataFrame, as_of, a, b, *, measure: str = "spend",
                          category: str | None = None, account: str | None = None) -> Tally:
    pa, pb = resolve(a, as_of), resolve(b, as_of)
    value = metric(tx, measure)

    def rows(s):
        delta = s("a") - s("b")
        return [{"a": double(s("a")), "b": double(s("b")), "delta": double(delta),
                 "pct": ratio(delta, s("b")) * 100.0}]
    inside = pa.contains("tx_date") | pb.contains("tx_date")
    return Tally(hull(pa, pb), {"a": F.when(pa.contains("tx_date"), value),
                                "b": F.when(pb.contains("tx_date"), value)}, rows,
                 matching(inside & has_metric(tx, measure), category=category, account=account),
                 frozenset("ab"))


def compare_periods(tx: DataFrame, as_of, a, b, *, measure: str = "spend",
                    category: str | None = None, account: str | None = None,
                    by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Two periods side by side in one scan; a period without rows counts as 0."""
    return tally(tx, compare_periods_tally(tx, as_of, a, b, measure=measure, category=category,
                                           account=account), by, tenants)


def top_transactions(tx: DataFrame, as_of, period, k: int, *, by_abs: bool = False,
                     by: Sequence[str] = BY) -> DataFrame:
    """Largest expenses, or with ``by_abs`` the largest movements of either sign."""
    rows = narrow(tx, as_of, period)
    if not by_abs:
        rows = rows.where(is_expense(tx))
    size = F.abs(F.col("amount")) if by_abs else F.col("amount")
    order = [size.desc(), F.asc("tx_date"), F.asc("description"), F.asc("category"),
             F.asc("account"), F.asc("id")]
    return top_k(rows, by, order, k).select(
        *by, "rank", "id", "tx_date", "description", double(F.col("amount")).alias("amount"),
        "category", "account")


def avg_monthly_tally(tx: DataFrame, as_of, n: int, *, measure: str = "spend") -> Tally:
    return Tally(resolve(f"last_{n}_months", as_of), {"sum": metric(tx, measure)},
                 lambda s: [{"avg_amount": double(s("sum")) / F.lit(float(n))}],
                 has_metric(tx, measure))


def avg_monthly(tx: DataFrame, as_of, n: int, *, measure: str = "spend",
                by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Mean over the last ``n`` complete months; an empty month counts as 0."""
    return tally(tx, avg_monthly_tally(tx, as_of, n, measure=measure), by, tenants)


def daily_average_tally(tx: DataFrame, as_of, period="this_month") -> Tally:
    day_after = as_date(as_of) + dt.timedelta(days=1)
    whole = resolve(period, as_of)
    elapsed = Period(whole.start, min(whole.end or day_after, day_after))
    days = (elapsed.end - elapsed.start).days
    return Tally(elapsed, {"spent": spent(tx)}, lambda s: [{
        "spent": double(s("spent")), "days": F.lit(days).cast("long"),
        "per_day": F.try_divide(double(s("spent")), F.lit(float(days)))}], is_expense(tx))


def daily_average(tx: DataFrame, as_of, period="this_month", *,
                  by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Spending per elapsed day, up to and including ``as_of``."""
    return tally(tx, daily_average_tally(tx, as_of, period), by, tenants)


def transaction_count_tally(tx: DataFrame, as_of, period) -> Tally:
    return Tally(resolve(period, as_of), {"n": row_count(tx)},
                 lambda s: [{"n": s("n").cast("long")}], zeros=frozenset("n"))


def transaction_count(tx: DataFrame, as_of, period, *, by: Sequence[str] = BY,
                      tenants: DataFrame | None = None) -> DataFrame:
    """Number of transactions of either sign; 0 over nothing."""
    return tally(tx, transaction_count_tally(tx, as_of, period), by, tenants)


def half_split_tally(tx: DataFrame, as_of, period="last_month") -> Tally:
    early = F.dayofmonth("tx_date") <= 15
    return Tally(resolve(period, as_of), {"first": F.when(early, spent(tx)),
                                          "second": F.when(~early, spent(tx))},
                 lambda s: [{"first_half": double(s("first")), "second_half": double(s("second"))}],
                 is_expense(tx), frozenset(["first", "second"]))


def half_split(tx: DataFrame, as_of, period="last_month", *,
               by: Sequence[str] = BY, tenants: DataFrame | None = None) -> DataFrame:
    """Spending up to the 15th of the month and after it."""
    return tally(tx, half_split_tally(tx, as_of, period), by, tenants)


def period_totals(tx: DataFrame, as_of, periods: Sequence[str], *,
                  by: Sequence[str] = BY) -> DataFrame:
    """Rows, expenses and income of several periods in one scan."""
    spans = [resolve(p, as_of) for p in periods]
    hits = F.array_compact(F.array(*[F.when(s.contains("tx_date"), F.lit(p))
                                     for p, s in zip(periods, spans)]))
    rows = tx.where(hull(*spans).contains("tx_date"))
    return (rows.withColumn("period", F.explode(hits)).groupBy(*by, "period")
            .agg(F.sum(row_count(tx)).cast("long").alias("n"),
                 double(F.sum(spent(tx))).alias("spent"),
                 double(F.sum(metric(tx, "income"))).alias("income")))


def category_stats(tx: DataFrame, as_of, period, *, by: Sequence[str] = BY) -> DataFrame:
    """Count, mean, extremes and the largest purchase per month and category.

    Merchants are summed first: that round aggregates numbers only, which hashes
    without sorting, and leaves few rows to pick the largest purchase from.
    """
    rows = narrow(tx, as_of, period).where(is_expense(tx))
    keys = [*by, "month", "category"]
    per_merchant = (rows.groupBy(*by, F.date_format("tx_date", "yyyy-MM").alias("month"),
                                 "category", "description")
                    .agg(F.count("*").alias("n"), F.sum("amount").alias("total"),
                         F.min("amount").alias("least"), F.max("amount").alias("most")))
    return per_merchant.groupBy(*keys).agg(
        F.sum("n").alias("n"), double(F.sum("total")).alias("total"),
        (double(F.sum("total")) / F.sum("n")).alias("mean"),
        double(F.min("least")).alias("smallest"), double(F.max("most")).alias("largest"),
        F.max_by("description", F.struct("most", "description")).alias("largest_merchant"))
