import datetime as dt
from decimal import Decimal

from ledgerweave.schemas import TRANSACTIONS
import pytest
from pyspark.sql import functions as F

from ledgerweave import periods, schemas
from ledgerweave.operators import budgeting, cashflow, facts, merchants, spending, trends
from ledgerweave.operators import accounts as acc
from ledgerweave.operators.ranking import top_k

AS_OF = "2024-03-31"


def tx(spark, rows):
    data = [(u, i, dt.date.fromisoformat(d), desc, Decimal(a), c, ac)
            for i, (u, d, desc, a, c, ac) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.TRANSACTIONS)


def budgets(spark, rows):
    return spark.createDataFrame([(u, c, Decimal(x)) for u, c, x in rows], schemas.BUDGETS)


def test_periods():
    r = periods.resolve
    assert r("last_month", AS_OF) == periods.Period(dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    assert r("this_month", AS_OF) == periods.Period(dt.date(2024, 3, 1))
    assert r("last_30_days", AS_OF) == periods.Period(dt.date(2024, 3, 1))
    assert r("last_3_months", AS_OF) == periods.Period(dt.date(2023, 12, 1), dt.date(2024, 3, 1))
    assert r("same_month_last_year", "2024-02-29") == periods.Period(
        dt.date(2023, 2, 1), dt.date(2023, 3, 1))
    assert r("this_week", "2024-03-31") == periods.Period(dt.date(2024, 3, 25), dt.date(2024, 4, 1))
    assert r("last_week", "2024-04-01") == periods.Period(dt.date(2024, 3, 25), dt.date(2024, 4, 1))
    assert r("this_year", AS_OF) == periods.Period(dt.date(2024, 1, 1), dt.date(2025, 1, 1))
    with pytest.raises(ValueError):
        r("someday", AS_OF)


def test_month_edges_and_later_dates(spark):
    t = tx(spark, [(1, "2024-01-31", "a", "1", "G", "C"), (1, "2024-02-01", "a", "2", "G", "C"),
                   (1, "2024-02-29", "a", "4", "G", "C"), (1, "2024-03-01", "a", "8", "G", "C"),
                   (1, "2024-04-05", "a", "16", "G", "C"), (1, "2024-03-02", "a", "0", "G", "C"),
                   (1, "2024-03-02", "a", "-5", "Income", "C")])
    assert spending.spend_total(t, AS_OF, "last_month").first().spent == 6.0
    assert spending.spend_total(t, AS_OF, "this_month").first().spent == 24.0


def test_total_over_nothing_is_one_null_row(spark):
    t = tx(spark, [(1, "2024-03-02", "a", "-5", "Income", "C")])
    assert spending.spend_total(t, AS_OF, "this_month", by=()).collect() == [(None,)]
    tenants = spark.createDataFrame([(1,), (2,)], "user_id long")
    got = spending.spend_total(t, AS_OF, "this_month", tenants=tenants)
    assert sorted(tuple(r) for r in got.collect()) == [(1, None), (2, None)]


def test_worked_example_over_budget(spark):
    t = tx(spark, [(1, "2024-03-05", "Diner", "342.50", "Restaurants", "Credit Card")])
    b = budgets(spark, [(1, "Restaurants", "300"), (1, "Health", "150")])
    got = budgeting.budget_status(t, b, AS_OF, "Restaurants").first()
    assert (got.spent, got.limit, got.left) == (342.5, 300.0, -42.5)
    assert round(got.pct_used - 100) == 14
    over = budgeting.budget_ranking(t, b, AS_OF, "over").collect()
    assert [(r.category, r.over_by) for r in over] == [("Restaurants", 42.5)]
    under = budgeting.budget_ranking(t, b, AS_OF, "under").collect()
    assert [(r.category, r.spent, r.over_by) for r in under] == [("Health", 0.0, -150.0)]


def test_worked_example_savings_rate(spark):
    t = tx(spark, [(1, "2024-03-01", "Payroll", "-8400", "Income", "Checking"),
                   (1, "2024-03-09", "Rent", "6180", "Rent", "Checking"),
                   (2, "2024-03-09", "Rent", "10", "Rent", "Checking")])
    got = {r.user_id: r for r in cashflow.cash_flow(t, AS_OF, "this_month").collect()}
    assert got[1].net == 2220.0 and round(got[1].savings_rate * 100) == 26
    assert got[2].savings_rate is None


def test_spending_without_budget_stays(spark):
    t = tx(spark, [(1, "2024-03-05", "x", "5", "Rent", "C")])
    b = budgets(spark, [(1, "Health", "150")])
    got = budgeting.spend_vs_budget(t, b, AS_OF).first()
    assert (got.category, got.spent, got.limit) == ("Rent", 5.0, None)


def test_single_tenant(spark):
    rows = [(1, "2024-03-05", "x", "5", "A", "C"), (1, "2024-03-06", "y", "7", "B", "C"),
            (1, "2024-02-06", "y", "9", "B", "C")]
    t = tx(spark, rows).drop("user_id")
    b = budgets(spark, [(1, "A", "10"), (1, "B", "5")]).drop("user_id")
    assert [r.category for r in spending.top_categories(t, AS_OF, "this_month", 1, by=()).collect()
            ] == ["B"]
    pace = budgeting.budget_pace(t, b, AS_OF, by=()).first()
    assert (pace.spent, pace.limit, pace.expected_to_date) == (12.0, 15.0, 15.0)
    summary = budgeting.finance_summary(t, b, AS_OF, by=()).collect()
    assert {r.category: r.spent for r in summary} == {"A": 5.0, "B": 7.0, None: 12.0}
    trend = trends.monthly_trend(t, AS_OF, 2, by=()).collect()
    assert [(r.month, r.amount, r.delta) for r in trend] == [
        ("2024-01", 0.0, None), ("2024-02", 9.0, 9.0)]


def test_empty_months_count_as_zero(spark):
    t = tx(spark, [(1, "2024-02-05", "x", "30", "A", "C")])
    assert spending.avg_monthly(t, AS_OF, 3).first().avg_amount == 10.0
    assert [r.amount for r in trends.monthly_trend(t, AS_OF, 3).orderBy("month").collect()] == [
        0.0, 0.0, 30.0]


def test_extreme_month_tie_goes_to_the_earlier(spark):
    t = tx(spark, [(1, "2024-02-05", "x", "30", "A", "C"), (1, "2024-01-05", "x", "30", "A", "C")])
    for which in ("max", "min"):
        assert cashflow.extreme_month(t, AS_OF, which=which).first().month == "2024-01"


def test_daily_average_stops_at_as_of(spark):
    t = tx(spark, [(1, "2024-03-05", "x", "30", "A", "C"), (1, "2024-03-20", "x", "99", "A", "C")])
    got = spending.daily_average(t, "2024-03-10").first()
    assert (got.spent, got.days, got.per_day) == (30.0, 10, 3.0)


def test_merchants_ignore_case(spark):
    t = tx(spark, [(1, "2024-03-05", "AMAZON Mkt", "5", "S", "C"),
                   (1, "2024-03-05", "Other", "7", "S", "C")])
    got = merchants.merchant_total(t, AS_OF, "this_month", ["%amazon%"]).first()
    assert (got.n, got.spent) == (1, 5.0)
    t = tx(spark, [(1, "2024-01-05", "Gym", "5", "Health", "C"),
                   (1, "2024-02-05", "Gym", "7", "Health", "C"),
                   (1, "2024-02-05", "Netflix", "9", "Subscriptions", "C"),
                   (1, "2024-02-05", "Once", "9", "Shopping", "C")])
    got = {r.description: (r.months, r.avg_amount) for r in merchants.recurring_charges(t).collect()}
    assert got == {"Gym": (2, 6.0), "Netflix": (1, 9.0)}


def test_facts_answer_like_transactions(spark):
    rows = [(u, f"2024-{m:02d}-{d:02d}", "x", str((u * 7 + m * 3 + d) * (1 if d % 3 else -1)),
             "Income" if d % 3 == 0 else f"c{d % 4}", f"a{d % 2}")
            for u in (1, 2) for m in (1, 2, 3) for d in range(1, 29, 2)]
    t = tx(spark, rows)
    day, month = facts.daily_facts(t), facts.monthly_facts(facts.daily_facts(t))
    checks = [
        lambda s: spending.spend_total(s, AS_OF, "last_month"),
        lambda s: spending.top_categories(s, AS_OF, "last_3_months", 2),
        lambda s: spending.compare_periods(s, AS_OF, "this_month", "last_month", measure="net"),
        lambda s: cashflow.cash_flow(s, AS_OF, "this_year"),
        lambda s: cashflow.extreme_month(s, AS_OF, measure="net"),
        lambda s: trends.category_growth(s, AS_OF, 2, 3),
        lambda s: trends.spend_vs_baseline(s, AS_OF, 2),
        lambda s: spending.transaction_count(s, AS_OF, "last_month"),
        lambda s: acc.account_transfers(s, AS_OF, "a1", "this_month")]
    for check in checks:
        want = sorted(tuple(r) for r in check(t).collect())
        assert sorted(tuple(r) for r in check(day).collect()) == want
        assert sorted(tuple(r) for r in check(month).collect()) == want


def test_monthly_sums_add_up(spark):
    t = tx(spark, [(1, f"2024-{m:02d}-10", "x", f"{m}.{m}1", "A", "C") for m in range(1, 13)])
    total = spending.spend_total(t, AS_OF, "this_year").first().spent
    monthly = facts.monthly_facts(t).agg(F.sum("spent").cast("double").alias("s")).first().s
    assert monthly == total


@pytest.mark.parametrize("k", [3, 80, 1500])
def test_top_k_large_and_small(spark, k):
    df = spark.range(4000).select((F.col("id") % 2).alias("user_id"), "id")
    got = top_k(df, ["user_id"], [F.desc("id")], k)
    want = {u: [i for i in range(3999, -1, -1) if i % 2 == u][:k] for u in (0, 1)}
    for u in (0, 1):
        rows = got.where(F.col("user_id") == u).orderBy("rank").collect()
        assert [r.id for r in rows] == want[u]


def test_top_k_of_copies(spark):
    df = spark.range(300).select(F.lit(1).alias("user_id"), F.lit("same").alias("x"))
    got = top_k(df, ["user_id"], [F.asc("x")], 120)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 121))


def test_tenants_without_rows(spark):
    """Listed tenants get the row of an aggregate over nothing; no other tenant is lost."""
    rows = [(u, i, dt.date(2001, 5, 3), "Shop", Decimal("5.00"), "A", "x")
            for i, u in enumerate([1, None, 3])]
    tx = spark.createDataFrame(rows, TRANSACTIONS)
    tenants = spark.createDataFrame([(1,), (2,), (None,)], "user_id long")

    def got(op, *args):
        return {r[0]: tuple(r)[1:] for r in op(tx, "2001-06-15", *args, tenants=tenants).collect()}
    assert got(spending.transaction_count, "last_month") == {1: (1,), 2: (0,), 3: (1,), None: (1,)}
    assert got(spending.compare_periods, "last_month", "this_month")[2] == (0.0, 0.0, 0.0, None)
    assert got(spending.avg_monthly, 3)[2] == (None,)
    assert got(spending.daily_average)[2] == (None, 15, None)
    assert got(spending.half_split)[2] == (0.0, 0.0)
    assert got(cashflow.cash_flow, "last_month")[2] == (0.0, 0.0, 0.0, None)
    assert got(merchants.merchant_total, "last_month", ["sh%"])[2] == (0, None)
    assert got(acc.account_transfers, "x", "last_month")[2] == (None,)
    trend = trends.monthly_trend(tx, "2001-06-15", 2, tenants=tenants).where("user_id = 2")
    assert [tuple(r)[1:] for r in trend.orderBy("month").collect()] == [
        ("2001-04", 0.0, None), ("2001-05", 0.0, 0.0)]
    assert spending.transaction_count(tx, "2001-06-15", "this_week", by=()).first().n == 0
