"""Spending against monthly budgets.

Budgets carry the tenant columns, so both sides join on (tenant, category).
They are not broadcast by hint: with one row per tenant and category they grow
with the tenants, and Spark broadcasts them by itself while they are small.
"""

from __future__ import annotations

import calendar
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweave.operators.measures import (
    BY, double, is_expense, narrow, ratio, spent, zero_if_null,
)
from ledgerweave.operators.ranking import top_k
from ledgerweave.periods import Period, as_date, month_start, months_before


def _by_category(tx: DataFrame, as_of, period, by: Sequence[str],
                 category: str | None = None) -> DataFrame:
    rows = narrow(tx, as_of, period, category).where(is_expense(tx))
    return rows.groupBy(*by, "category").agg(F.sum(spent(tx)).alias("_spent"))


def spend_vs_budget(tx: DataFrame, budgets: DataFrame, as_of, period="this_month", *,
                    by: Sequence[str] = BY) -> DataFrame:
    """Every category with spending, with its limit where one exists."""
    over = F.col("_spent") - F.col("monthly_limit")
    return (_by_category(tx, as_of, period, by)
            .join(budgets, [*by, "category"], "left")
            .select(*by, "category", double(F.col("_spent")).alias("spent"),
                    double(F.col("monthly_limit")).alias("limit"),
                    double(over).alias("over_by")))


def budget_status(tx: DataFrame, budgets: DataFrame, as_of, category: str | None = None, *,
                  by: Sequence[str] = BY) -> DataFrame:
    """Use of each budget this month; a budget nobody touched shows 0."""
    limits = budgets if category is None else budgets.where(F.col("category") == category)
    used = zero_if_null(F.col("_spent"))
    left = F.col("monthly_limit") - used
    return (limits.join(_by_category(tx, as_of, "this_month", by, category),
                        [*by, "category"], "left")
            .select(*by, "category", double(used).alias("spent"),
                    double(F.col("monthly_limit")).alias("limit"), double(left).alias("left"),
                    (ratio(used, F.col("monthly_limit")) * 100.0).alias("pct_used")))


def budget_ranking(tx: DataFrame, budgets: DataFrame, as_of, side: str = "all",
                   k: int | None = None, *, by: Sequence[str] = BY) -> DataFrame:
    """Budgets of this month by how far they are exceeded.

    ``side`` is ``over``, ``under`` or ``all``.
    """
    over = zero_if_null(F.col("_spent")) - F.col("monthly_limit")
    keep = {"over": F.col("_over") > 0, "under": F.col("_over") < 0, "all": F.lit(True)}[side]
    ranked = (budgets.join(_by_category(tx, as_of, "this_month", by), [*by, "category"], "left")
              .withColumn("_over", over).where(keep))
    if k is not None:
        ranked = top_k(ranked, by, [F.desc("_over"), F.asc("category")], k)
    return ranked.select(*by, "category",
                         double(zero_if_null(F.col("_spent"))).alias("spent"),
                         double(F.col("monthly_limit")).alias("limit"),
                         double(F.col("_over")).alias("over_by"))


def budget_pace(tx: DataFrame, budgets: DataFrame, as_of, *,
                by: Sequence[str] = BY) -> DataFrame:
    """This month's total against the part of the limits due by ``as_of``."""
    today = as_date(as_of)
    elapsed, days = float(today.day), float(calendar.monthrange(today.year, today.month)[1])
    limits = budgets.groupBy(*by).agg(F.sum("monthly_limit").alias("_limit"))
    used = (narrow(tx, as_of, "this_month").where(is_expense(tx))
            .groupBy(*by).agg(F.sum(spent(tx)).alias("_spent")))
    if by:
        joined = limits.join(used, list(by), "left")
    else:
        joined = limits.unionByName(used, allowMissingColumns=True).agg(
            F.max("_limit").alias("_limit"), F.max("_spent").alias("_spent"))
    spent_so_far = double(zero_if_null(F.col("_spent")))
    expected = double(F.col("_limit")) * F.lit(elapsed) / F.lit(days)
    return joined.select(*by, spent_so_far.alias("spent"), double(F.col("_limit")).alias("limit"),
                         expected.alias("expected_to_date"),
                         F.try_divide(spent_so_far, expected).alias("pace"))


def finance_summary(tx: DataFrame, budgets: DataFrame, as_of, period="this_month", *,
                    by: Sequence[str] = BY) -> DataFrame:
    """Spending per category plus one total row, whose category is null.

    The rollup runs over category sums, not over transactions, so expanding the
    grouping sets costs nothing.
    """
    sums = _by_category(tx, as_of, period, by)
    sets = (sums.rollup("category") if not by else
            sums.groupingSets([[*by, "category"], list(by)], *by, "category"))
    rolled = sets.agg(F.sum("_spent").alias("_spent"),
                      F.grouping("category").cast("int").alias("_total"))
    total = F.max(F.when(F.col("_total") == 1, F.col("_spent"))).over(W.partitionBy(*by))
    return (rolled.withColumn("_all", total)
            .join(budgets, [*by, "category"], "left")
            .select(*by, "category", double(F.col("_spent")).alias("spent"),
                    double(F.col("monthly_limit")).alias("limit"),
                    ratio(F.col("_spent"), F.col("_all")).alias("share")))


def savings_headroom(tx: DataFrame, budgets: DataFrame, as_of, n: int = 3,
                     k: int | None = None, *, by: Sequence[str] = BY) -> DataFrame:
    """How far a category's mean month lies above its limit.

    A category without a limit is measured against its own cheapest month.
    """
    months = months_before(as_date(as_of), n)
    per_month = [zero_if_null(F.sum(F.when(
        Period(m, month_start(m, 1)).contains("tx_date"), spent(tx)))) for m in months]
    rows = narrow(tx, as_of, Period(months[0], month_start(months[-1], 1))).where(is_expense(tx))
    stats = rows.groupBy(*by, "category").agg(
        (double(F.sum(spent(tx))) / F.lit(float(n))).alias("monthly_avg"),
        double(F.array_min(F.array(*per_month))).alias("_cheapest"))
    limit = double(F.col("monthly_limit"))
    out = (stats.join(budgets, [*by, "category"], "left")
           .withColumn("limit", limit)
           .withColumn("excess", F.col("monthly_avg") - F.coalesce(limit, F.col("_cheapest"))))
    if k is not None:
        out = top_k(out, by, [F.desc("excess"), F.asc("category")], k)
    return out.select(*by, "category", "monthly_avg", "limit", "excess")
