"""Income, net flow and extreme months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.measures import (
    BY, double, income, is_income, metric, metric_rows, narrow, ratio, spent,
)
from ledgerweave.operators.tally import Tally, tally
from ledgerweave.periods import resolve


def income_total_tally(tx: DataFrame, as_of, period) -> Tally:
    return Tally(resolve(period, as_of), {"income": income(tx)},
                 lambda s: [{"income": double(s("income"))}], is_income(tx))


def income_total(tx: DataFrame, as_of, period, *, by: Sequence[str] = BY,
                 tenants: DataFrame | None = None) -> DataFrame:
    return tally(tx, income_total_tally(tx, as_of, period), by, tenants)


def cash_flow_tally(tx: DataFrame, as_of, period) -> Tally:
    def rows(s):
        net = s("in") - s("out")
        return [{"income": double(s("in")), "spent": double(s("out")), "net": double(net),
                 "savings_rate": ratio(net, s("in"))}]
    return Tally(resolve(period, as_of), {"in": income(tx), "out": spent(tx)}, rows,
                 zeros=frozenset(["in", "out"]))


def cash_flow(tx: DataFrame, as_of, period, *, by: Sequence[str] = BY,
              tenants: DataFrame | None = None) -> DataFrame:
    """Income, spending, what is left and its share of the income.

    The rate is null where there is no income.
    """
    return tally(tx, cash_flow_tally(tx, as_of, period), by, tenants)


def extreme_month(tx: DataFrame, as_of, *, measure: str = "spend", which: str = "max",
                  by: Sequence[str] = BY) -> DataFrame:
    """Highest or lowest month of this year; the earlier month wins a tie."""
    rows = metric_rows(narrow(tx, as_of, "this_year"), measure)
    months = (rows.groupBy(*by, F.trunc("tx_date", "MM").alias("month"))
              .agg(F.sum(metric(tx, measure)).alias("amount")))
    sign = {"max": 1, "min": -1}[which]
    key = F.struct((F.col("amount") * sign).alias("a"),
                   F.datediff(F.lit("2100-01-01").cast("date"), F.col("month")).alias("d"))
    best = F.max_by(F.struct("month", "amount"), key)
    return (months.groupBy(*by).agg(best.alias("m"))
            .select(*by, F.date_format("m.month", "yyyy-MM").alias("month"),
                    double(F.col("m.amount")).alias("amount")))
