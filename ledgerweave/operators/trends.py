"""Monthly trends and growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweave.operators.measures import (
    BY, double, has_metric, is_expense, matching, metric, metric_rows, narrow, ratio, spent,
    with_tenants, zero_if_null,
)
from ledgerweave.operators.ranking import top_k
from ledgerweave.operators.tally import Tally
from ledgerweave.periods import Period, as_date, hull, month_start, months_before, resolve


def _month_sum(first_day, value: Column) -> Column:
    month = Period(first_day, month_start(first_day, 1))
    return zero_if_null(F.sum(F.when(month.contains("tx_date"), value)))


def month_over_month(monthly: DataFrame, column: str, *, by: Sequence[str] = BY) -> DataFrame:
    """Adds ``delta``, the change against the tenant's previous row by month."""
    previous = F.lag(column).over(W.partitionBy(*by).orderBy("month"))
    return monthly.withColumn("delta", F.col(column) - previous)


def monthly_trend(tx: DataFrame, as_of, n: int, *, measure: str = "spend",
                  category: str | None = None, by: Sequence[str] = BY,
                  tenants: DataFrame | None = None) -> DataFrame:
    """The last ``n`` complete months with the change from month to month.

    One aggregate sums all months; exploding them gives every tenant a full
    spine, and keeps the partitioning the window needs.  Tenants without any
    matching row appear if ``tenants`` lists them.
    """
    months = months_before(as_date(as_of), n)
    value = metric(tx, measure)
    rows = metric_rows(
        narrow(tx, as_of, Period(months[0], month_start(months[-1], 1)), category), measure)
    sums = with_tenants(rows, tenants, by).groupBy(*by).agg(*[
        _month_sum(m, value).alias(f"_{i}") for i, m in enumerate(months)])
    spine = F.explode(F.array(*[
        F.struct(F.lit(f"{m:%Y-%m}").alias("month"), F.col(f"_{i}").alias("amount"))
        for i, m in enumerate(months)]))
    trend = sums.select(*by, spine.alias("m")).select(*by, "m.month", "m.amount")
    return (month_over_month(trend, "amount", by=by)
            .withColumn("amount", double(F.col("amount")))
            .withColumn("delta", double(F.col("delta"))))


def monthly_trend_tally(tx: DataFrame, as_of, n: int, *, measure: str = "spend",
                        category: str | None = None) -> Tally:
    """The trend as sums of one shared aggregate; neighbours give the changes."""
    months = months_before(as_date(as_of), n)
    value = metric(tx, measure)
    sums = {f"m{i}": F.when(Period(m, month_start(m, 1)).contains("tx_date"), value)
            for i, m in enumerate(months)}

    def rows(s):
        return [{"month": F.lit(f"{m:%Y-%m}"), "amount": double(s(f"m{i}")),
                 "delta": double(s(f"m{i}") - s(f"m{i - 1}")) if i else F.lit(None).cast("double")}
                for i, m in enumerate(months)]
    return Tally(Period(months[0], month_start(months[-1], 1)), sums, rows,
                 matching(has_metric(tx, measure), category=category), frozenset(sums))


def category_growth(tx: DataFrame, as_of, n: int, k: int, *,
                    by: Sequence[str] = BY) -> DataFrame:
    """Categories by growth from the first to the last of ``n`` complete months."""
    months = months_before(as_date(as_of), n)
    value = spent(tx)
    ends = [Period(m, month_start(m, 1)) for m in (months[0], months[-1])]
    rows = narrow(tx, as_of, hull(*ends)).where(is_expense(tx))
    rows = rows.where(ends[0].contains("tx_date") | ends[1].contains("tx_date"))
    sums = rows.groupBy(*by, "category").agg(_month_sum(months[0], value).alias("first"),
                                             _month_sum(months[-1], value).alias("last"))
    grown = sums.withColumn("growth", F.col("last") - F.col("first"))
    ranked = top_k(grown, by, [F.desc("growth"), F.asc("category")], k)
    return ranked.select(*by, "rank", "category", *[
        double(F.col(c)).alias(c) for c in ("first", "last", "growth")])


def spend_vs_baseline(tx: DataFrame, as_of, n: int = 3, *,
                      by: Sequence[str] = BY) -> DataFrame:
    """This month per category against the mean of the ``n`` months before."""
    now, before = resolve("this_month", as_of), resolve(f"last_{n}_months", as_of)
    rows = narrow(tx, as_of, hull(now, before)).where(is_expense(tx))
    sums = rows.groupBy(*by, "category").agg(
        double(zero_if_null(F.sum(F.when(now.contains("tx_date"), spent(tx))))).alias("current"),
        (double(zero_if_null(F.sum(F.when(before.contains("tx_date"), spent(tx)))))
         / F.lit(float(n))).alias("baseline"))
    return sums.withColumn("ratio", ratio(F.col("current"), F.col("baseline")))
