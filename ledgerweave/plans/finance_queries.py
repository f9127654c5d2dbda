"""Finance queries over the star-schema view, each with its SQL statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerweave.operators import accounts as acc
from ledgerweave.operators import budgeting, cashflow, facts, merchants, spending, trends
from ledgerweave.plans import oracle_finance as sql
from ledgerweave.sources import star
from ledgerweave.sources.star import AS_OF

PERIODS = list(sql.PERIODS)
TENANTS = "SELECT DISTINCT user_id FROM accounts"
SLICES = {
    "last_month": {"period": "last_month"},
    "standard_last_month": {"period": "last_month", "category": "STANDARD"},
    "small_this_month": {"period": "this_month", "category": "SMALL"},
    "last_30_days": {"period": "last_30_days"},
    "medium_this_year": {"period": "this_year", "category": "MEDIUM"},
    "large_this_week": {"period": "this_week", "category": "LARGE"},
    "building_this_month": {"period": "this_month", "account": "BUILDING"},
    "unknown_category": {"period": "this_month", "category": "Rent"},
}


def _tx(op, *args, **kwargs):
    return lambda spark, d: op(star.transactions(spark, d), AS_OF, *args, **kwargs)


def _every(op, *args, **kwargs):
    """With a row for every tenant, as an aggregate over nothing has one too."""
    return lambda spark, d: op(star.transactions(spark, d), AS_OF, *args,
                               tenants=star.accounts(spark, d), **kwargs)


def _budget(op, *args, **kwargs):
    return lambda spark, d: op(star.transactions(spark, d), star.budgets(spark, d), AS_OF,
                               *args, **kwargs)


def _facts(build):
    def run(spark, d):
        return (build(star.transactions(spark, d))
                .withColumn("spent", F.col("spent").cast("double"))
                .withColumn("income", F.col("income").cast("double")))
    return run


def _budget_on_facts(spark, d):
    """The same operator over monthly facts in place of raw transactions."""
    tx = facts.monthly_facts(star.transactions(spark, d))
    return budgeting.budget_ranking(tx, star.budgets(spark, d), AS_OF, "over")


QUERIES = {
    "spend_total": (_tx(spending.spend_total, "last_month"), sql.spend_total("last_month")),
    "spend_total_category": (
        _tx(spending.spend_total, "last_month", category="STANDARD"),
        sql.spend_total("last_month", "STANDARD")),
    "spend_total_account": (
        _tx(spending.spend_total, "this_month", account="BUILDING"),
        sql.spend_total("this_month", None, "BUILDING")),
    "spend_totals": (
        lambda spark, d: spending.spend_totals(
            star.transactions(spark, d), AS_OF, SLICES, tenants=star.accounts(spark, d)),
        sql.spend_totals(SLICES)),
    "top_categories": (_tx(spending.top_categories, "last_month", 5),
                       sql.top_categories("last_month", 5)),
    "compare_periods": (
        _every(spending.compare_periods, "this_month", "last_month"),
        sql.every_tenant(sql.compare_periods("this_month", "last_month"),
                         a=0, b=0, delta=0, pct=None)),
    "compare_periods_income": (
        _every(spending.compare_periods, "this_month", "same_month_last_year", measure="income"),
        sql.every_tenant(sql.compare_periods("this_month", "same_month_last_year", "income"),
                         a=0, b=0, delta=0, pct=None)),
    "compare_weeks_account": (
        _every(spending.compare_periods, "this_week", "last_week", account="BUILDING"),
        sql.every_tenant(sql.compare_periods("this_week", "last_week", "spend", "BUILDING"),
                         a=0, b=0, delta=0, pct=None)),
    "top_transactions": (_tx(spending.top_transactions, "last_month", 5),
                         sql.top_transactions("last_month", 5)),
    "top_movements": (_tx(spending.top_transactions, "last_month", 3, by_abs=True),
                      sql.top_transactions("last_month", 3, True)),
    "avg_monthly": (
        _every(spending.avg_monthly, 3),
        sql.every_tenant(sql.avg_monthly(3),
                         avg_amount=None)),
    "avg_monthly_income": (
        _every(spending.avg_monthly, 3, measure="income"),
        sql.every_tenant(sql.avg_monthly(3, "income"),
                         avg_amount=None)),
    "daily_average": (
        _every(spending.daily_average),
        sql.every_tenant(sql.DAILY_AVERAGE,
                         spent=None, days=15, per_day=None)),
    "transaction_count": (
        _every(spending.transaction_count, "last_month"),
        sql.every_tenant(sql.transaction_count("last_month"),
                         n=0)),
    "half_split": (
        _every(spending.half_split),
        sql.every_tenant(sql.HALF_SPLIT,
                         first_half=0, second_half=0)),
    "period_totals": (_tx(spending.period_totals, PERIODS), sql.period_totals(PERIODS)),
    "category_stats": (_tx(spending.category_stats, "this_year"), sql.CATEGORY_STATS),
    "spend_vs_budget": (_budget(budgeting.spend_vs_budget), sql.SPEND_VS_BUDGET),
    "budget_status": (_budget(budgeting.budget_status, "LARGE"), sql.budget_status("LARGE")),
    "budget_status_all": (_budget(budgeting.budget_status), sql.budget_status()),
    "budget_ranking": (_budget(budgeting.budget_ranking), sql.budget_ranking("all")),
    "budget_ranking_over": (_budget(budgeting.budget_ranking, "over", 1),
                            sql.budget_ranking("over", 1)),
    "budget_ranking_under": (_budget(budgeting.budget_ranking, "under"),
                             sql.budget_ranking("under")),
    "budget_ranking_on_facts": (_budget_on_facts, sql.budget_ranking("over")),
    "budget_pace": (_budget(budgeting.budget_pace), sql.BUDGET_PACE),
    "income_total": (_tx(cashflow.income_total, "last_month"), sql.income_total("last_month")),
    "cash_flow": (
        _every(cashflow.cash_flow, "last_3_months"),
        sql.every_tenant(sql.cash_flow("last_3_months"),
                         income=0, spent=0, net=0, savings_rate=None)),
    "monthly_trend": (_every(trends.monthly_trend, 3), sql.monthly_trend(tenants=TENANTS)),
    "monthly_trend_category": (_every(trends.monthly_trend, 3, category="LARGE"),
                               sql.monthly_trend("spend", "LARGE", TENANTS)),
    "monthly_trend_net": (_every(trends.monthly_trend, 3, measure="net"),
                          sql.monthly_trend("net", tenants=TENANTS)),
    "category_growth": (_tx(trends.category_growth, 3, 2), sql.category_growth(2)),
    "spend_vs_baseline": (_tx(trends.spend_vs_baseline, 3), sql.SPEND_VS_BASELINE),
    "merchant_total": (
        _every(merchants.merchant_total, "this_month", ["%Widget%", "red %"]),
        sql.every_tenant(sql.merchant_total("this_month", ["%Widget%", "red %"]),
                         n=0, spent=None)),
    "recurring_charges": (_tx(merchants.recurring_charges, always=("ECONOMY",), min_months=40),
                          sql.recurring_charges(40, ("ECONOMY",))),
    "extreme_month": (_tx(cashflow.extreme_month), sql.extreme_month("spend", "max")),
    "extreme_month_lowest": (_tx(cashflow.extreme_month, which="min"),
                             sql.extreme_month("spend", "min")),
    "extreme_month_net": (_tx(cashflow.extreme_month, measure="net"),
                          sql.extreme_month("net", "max")),
    "account_balance": (lambda spark, d: acc.account_balance(star.accounts(spark, d), "BUILDING"),
                        sql.account_balance("BUILDING")),
    "account_transfers": (
        _every(acc.account_transfers, "HOUSEHOLD", "this_month"),
        sql.every_tenant(sql.account_transfers("HOUSEHOLD", "this_month"),
                         transferred=None)),
    "account_activity": (_tx(acc.account_activity, "MACHINERY", "this_week"),
                         sql.account_activity("MACHINERY", "this_week")),
    "finance_summary": (_budget(budgeting.finance_summary), sql.finance_summary("this_month")),
    "savings_headroom": (_budget(budgeting.savings_headroom), sql.savings_headroom()),
    "daily_facts": (_facts(facts.daily_facts), sql.facts("day")),
    "monthly_facts": (_facts(facts.monthly_facts), sql.facts("month")),
}

QUERIES = {name: (run, sql.BASE + statement) for name, (run, statement) in QUERIES.items()}
