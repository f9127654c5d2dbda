"""Measures shared by the finance operators.

Every operator accepts raw transactions (signed ``amount``) or a fact table with
``spent``, ``income`` and ``n`` already summed per day or month.  The functions
here hide the difference, so the same operator text serves both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.periods import in_period

BY = ("user_id",)


def is_fact(df: DataFrame) -> bool:
    return "spent" in df.columns


def is_expense(df: DataFrame) -> Column:
    """Zero is neither expense nor income."""
    return F.expr("spent IS NOT NULL" if is_fact(df) else "amount > 0")


def is_income(df: DataFrame) -> Column:
    return F.expr("income IS NOT NULL" if is_fact(df) else "amount < 0")


def spent(df: DataFrame) -> Column:
    return F.expr("spent" if is_fact(df) else "CASE WHEN amount > 0 THEN amount END")


def income(df: DataFrame) -> Column:
    return F.expr("income" if is_fact(df) else "CASE WHEN amount < 0 THEN -amount END")


def row_count(df: DataFrame) -> Column:
    return F.col("n") if is_fact(df) else F.lit(1)


def metric(df: DataFrame, name: str) -> Column:
    """Per-row value of ``spend``, ``income`` or ``net`` to be summed."""
    if name == "spend":
        return spent(df)
    if name == "income":
        return income(df)
    if name == "net":
        return F.expr("coalesce(income, 0) - coalesce(spent, 0)" if is_fact(df) else "-amount")
    raise ValueError(f"unknown metric: {name!r}")


def has_metric(df: DataFrame, name: str) -> Column:
    """Whether a row can contribute to the metric."""
    return {"spend": is_expense, "income": is_income}.get(name, lambda _: F.lit(True))(df)


def metric_rows(df: DataFrame, name: str) -> DataFrame:
    """Keep only the rows that can contribute to the metric."""
    return df if name == "net" else df.where(has_metric(df, name))


def matching(condition: Column, **columns: str | None) -> Column:
    """The condition and equality with each given value; equality is case-sensitive."""
    for name, value in columns.items():
        if value is not None:
            condition = condition & (F.col(name) == value)
    return condition


def narrow(df: DataFrame, as_of, period=None, category: str | None = None,
           account: str | None = None) -> DataFrame:
    """Period, category and account filters; equality is case-sensitive."""
    if period is not None:
        df = df.where(in_period("tx_date", period, as_of))
    if category is not None:
        df = df.where(F.col("category") == category)
    if account is not None:
        df = df.where(F.col("account") == account)
    return df


def double(column: Column) -> Column:
    """Sums stay decimal, hence independent of partition order, until here."""
    return column.cast("double")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(double(a), double(b))


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def with_tenants(rows: DataFrame, tenants: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """The rows and one of nulls per listed tenant, as input of a grouped aggregate.

    A tenant without matching rows then gets what an ungrouped aggregate over nothing returns:
    null for a sum, 0 for a count of values.  No join is needed, and a null tenant
    counts as one.
    """
    if tenants is None or not by:
        return rows
    return rows.unionByName(tenants.select(*by), allowMissingColumns=True)
