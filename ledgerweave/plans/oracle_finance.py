"""SQL statements of the finance queries, for a check in another engine."""

from __future__ import annotations

# The star schema seen as finance tables; as_of is Friday 2001-06-15.
BASE = """
WITH transactions AS (
  SELECT CAST(c_nationkey AS BIGINT) AS user_id,
         l_orderkey * 8 + l_linenumber AS id,
         CAST(l_shipdate AS DATE) AS tx_date,
         p_name AS description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END
              AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'Income' ELSE p_type END AS category,
         c_mktsegment AS account
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey),
accounts AS (
  SELECT CAST(c_nationkey AS BIGINT) AS user_id, c_mktsegment AS name, c_mktsegment AS type,
         CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS balance
  FROM customer GROUP BY c_nationkey, c_mktsegment),
budgets AS (
  SELECT user_id, category,
         CAST(FLOOR(CAST(SUM(amount) AS DOUBLE) / 82.0) AS DECIMAL(18,2)) AS monthly_limit
  FROM transactions WHERE amount > 0 AND category <> 'PROMO'
  GROUP BY user_id, category)
"""

PERIODS = {
    "last_month": "tx_date >= DATE '2001-05-01' AND tx_date < DATE '2001-06-01'",
    "this_month": "tx_date >= DATE '2001-06-01'",
    "this_year": "tx_date >= DATE '2001-01-01' AND tx_date < DATE '2002-01-01'",
    "last_30_days": "tx_date >= DATE '2001-05-16'",
    "this_week": "tx_date >= DATE '2001-06-11' AND tx_date < DATE '2001-06-18'",
    "last_week": "tx_date >= DATE '2001-06-04' AND tx_date < DATE '2001-06-11'",
    "last_3_months": "tx_date >= DATE '2001-03-01' AND tx_date < DATE '2001-06-01'",
    "same_month_last_year": "tx_date >= DATE '2000-06-01' AND tx_date < DATE '2000-07-01'",
}

SPENT = "CASE WHEN amount > 0 THEN amount END"
INCOME = "CASE WHEN amount < 0 THEN -amount END"
METRICS = {"spend": SPENT, "income": INCOME, "net": "-amount"}


def where(period, category=None, account=None):
    parts = [PERIODS[period]]
    if category:
        parts.append(f"category = '{category}'")
    if account:
        parts.append(f"account = '{account}'")
    return " AND ".join(parts)


def every_tenant(statement, **columns):
    """The statement's rows, and for each other tenant one with the given values."""
    values = ", ".join(f'COALESCE(s."{c}", {v}) AS "{c}"' if v is not None else f's."{c}"'
                       for c, v in columns.items())
    return f"""SELECT u.user_id, {values} FROM (
      SELECT user_id FROM accounts UNION SELECT user_id FROM transactions) u
      LEFT JOIN ({statement}) s ON s.user_id = u.user_id"""


def spend_total(period, category=None, account=None):
    return f"""SELECT user_id, CAST(SUM(amount) AS DOUBLE) AS spent FROM transactions
      WHERE amount > 0 AND {where(period, category, account)} GROUP BY user_id"""


def spend_totals(slices):
    cases = " UNION ALL ".join(
        f"""SELECT u.user_id, '{name}' AS slice, CAST(SUM(t.amount) AS DOUBLE) AS spent
        FROM (SELECT DISTINCT user_id FROM accounts) u
        LEFT JOIN (SELECT * FROM transactions WHERE amount > 0 AND
          {where(s['period'], s.get('category'), s.get('account'))}) t ON u.user_id = t.user_id
        GROUP BY u.user_id""" for name, s in slices.items())
    return cases


def top_categories(period, k):
    return f"""SELECT user_id, rank, category, CAST(total AS DOUBLE) AS total FROM (
      SELECT user_id, category, total, CAST(row_number() OVER (
        PARTITION BY user_id ORDER BY total DESC, category) AS INTEGER) AS rank
      FROM (SELECT user_id, category, SUM(amount) AS total FROM transactions
            WHERE amount > 0 AND {where(period)} GROUP BY user_id, category))
      WHERE rank <= {k}"""


def compare_periods(a, b, measure="spend", account=None):
    value = METRICS[measure]
    flow = {"spend": "amount > 0", "income": "amount < 0", "net": "TRUE"}[measure]
    acc = f" AND account = '{account}'" if account else ""
    return f"""SELECT user_id, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b,
      CAST(a - b AS DOUBLE) AS delta,
      CAST(a - b AS DOUBLE) / NULLIF(CAST(b AS DOUBLE), 0) * 100.0 AS pct
      FROM (SELECT user_id,
        COALESCE(SUM(CASE WHEN {PERIODS[a]} THEN {value} END), 0) AS a,
        COALESCE(SUM(CASE WHEN {PERIODS[b]} THEN {value} END), 0) AS b
        FROM transactions WHERE (({PERIODS[a]}) OR ({PERIODS[b]})) AND {flow}{acc}
        GROUP BY user_id)"""


def top_transactions(period, k, by_abs=False):
    size = "abs(amount)" if by_abs else "amount"
    sign = "" if by_abs else "amount > 0 AND "
    return f"""SELECT user_id, rank, id, tx_date, description, CAST(amount AS DOUBLE) AS amount,
      category, account FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY {size} DESC, tx_date,
        description, category, account, id) AS INTEGER) AS rank
      FROM transactions WHERE {sign}{where(period)}) WHERE rank <= {k}"""


def avg_monthly(n, measure="spend"):
    flow = {"spend": "amount > 0", "income": "amount < 0"}[measure]
    return f"""SELECT user_id, CAST(SUM({METRICS[measure]}) AS DOUBLE) / {n}.0::DOUBLE AS avg_amount
      FROM transactions WHERE {flow} AND {where(f'last_{n}_months')} GROUP BY user_id"""


DAILY_AVERAGE = """SELECT user_id, CAST(SUM(amount) AS DOUBLE) AS spent, CAST(15 AS BIGINT) AS days,
  CAST(SUM(amount) AS DOUBLE) / 15.0::DOUBLE AS per_day FROM transactions
  WHERE amount > 0 AND tx_date >= DATE '2001-06-01' AND tx_date <= DATE '2001-06-15'
  GROUP BY user_id"""

_USED = f"""(SELECT user_id, category, SUM(amount) AS spent FROM transactions
  WHERE amount > 0 AND {PERIODS['this_month']} GROUP BY user_id, category)"""

_STATUS = f"""SELECT b.user_id, b.category, COALESCE(s.spent, 0) AS spent, b.monthly_limit
  FROM budgets b LEFT JOIN {_USED} s ON b.user_id = s.user_id AND b.category = s.category"""

SPEND_VS_BUDGET = f"""SELECT s.user_id, s.category, CAST(s.spent AS DOUBLE) AS spent,
  CAST(b.monthly_limit AS DOUBLE) AS "limit",
  CAST(s.spent - b.monthly_limit AS DOUBLE) AS over_by
  FROM {_USED} s LEFT JOIN budgets b ON b.user_id = s.user_id AND b.category = s.category"""


def budget_status(category=None):
    only = f"WHERE category = '{category}'" if category else ""
    return f"""SELECT user_id, category, CAST(spent AS DOUBLE) AS spent,
      CAST(monthly_limit AS DOUBLE) AS "limit", CAST(monthly_limit - spent AS DOUBLE) AS "left",
      CAST(spent AS DOUBLE) / CAST(monthly_limit AS DOUBLE) * 100.0 AS pct_used
      FROM ({_STATUS}) {only}"""


def budget_ranking(side, k=None):
    keep = {"over": "spent > monthly_limit", "under": "spent < monthly_limit", "all": "TRUE"}[side]
    cap = f"WHERE r <= {k}" if k else ""
    return f"""SELECT user_id, category, CAST(spent AS DOUBLE) AS spent,
      CAST(monthly_limit AS DOUBLE) AS "limit", CAST(spent - monthly_limit AS DOUBLE) AS over_by
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id
              ORDER BY spent - monthly_limit DESC, category) AS r
            FROM ({_STATUS}) WHERE {keep}) {cap}"""


BUDGET_PACE = f"""SELECT user_id, spent, "limit", "limit" * 15.0::DOUBLE / 30.0::DOUBLE AS expected_to_date,
  spent / ("limit" * 15.0::DOUBLE / 30.0::DOUBLE) AS pace
  FROM (SELECT l.user_id, CAST(COALESCE(s.spent, 0) AS DOUBLE) AS spent,
          CAST(l.total AS DOUBLE) AS "limit"
    FROM (SELECT user_id, SUM(monthly_limit) AS total FROM budgets GROUP BY user_id) l
    LEFT JOIN (SELECT user_id, SUM(amount) AS spent FROM transactions
      WHERE amount > 0 AND {PERIODS['this_month']} GROUP BY user_id) s ON l.user_id = s.user_id)"""


def income_total(period):
    return f"""SELECT user_id, CAST(-SUM(amount) AS DOUBLE) AS income FROM transactions
      WHERE amount < 0 AND {where(period)} GROUP BY user_id"""


def cash_flow(period):
    return f"""SELECT user_id, CAST(i AS DOUBLE) AS income, CAST(s AS DOUBLE) AS spent,
      CAST(i - s AS DOUBLE) AS net,
      CAST(i - s AS DOUBLE) / NULLIF(CAST(i AS DOUBLE), 0) AS savings_rate
      FROM (SELECT user_id, COALESCE(SUM({INCOME}), 0) AS i, COALESCE(SUM({SPENT}), 0) AS s
            FROM transactions WHERE {where(period)} GROUP BY user_id)"""


def monthly_trend(measure="spend", category=None, tenants=None):
    cat = f" AND category = '{category}'" if category else ""
    flow = {"spend": "amount > 0", "income": "amount < 0", "net": "TRUE"}[measure]
    months = ["2001-03", "2001-04", "2001-05"]
    return monthly_trend_over(months, METRICS[measure], f"{flow}{cat}", tenants)


def monthly_trend_over(months, value, condition, tenants=None):
    first, last = months[0], months[-1]
    tenants = tenants or f"""SELECT DISTINCT user_id FROM transactions WHERE {condition}
              AND strftime(tx_date, '%Y-%m') BETWEEN '{first}' AND '{last}'"""
    spine = ", ".join(f"('{m}')" for m in months)
    return f"""SELECT user_id, month, CAST(amount AS DOUBLE) AS amount,
      CAST(amount - lag(amount) OVER (PARTITION BY user_id ORDER BY month) AS DOUBLE) AS delta
      FROM (SELECT u.user_id, m.month, COALESCE(SUM(t.v), 0) AS amount
        FROM ({tenants}) u
        CROSS JOIN (SELECT * FROM (VALUES {spine}) AS v(month)) m
        LEFT JOIN (SELECT user_id, strftime(tx_date, '%Y-%m') AS month, {value} AS v
                   FROM transactions WHERE {condition}) t
          ON t.user_id = u.user_id AND t.month = m.month
        GROUP BY u.user_id, m.month)"""


def category_growth(k):
    return f"""SELECT user_id, rank, category, CAST(f AS DOUBLE) AS "first", CAST(l AS DOUBLE) AS "last",
      CAST(l - f AS DOUBLE) AS growth FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY l - f DESC, category)
        AS INTEGER) AS rank FROM (
        SELECT user_id, category,
          SUM(CASE WHEN strftime(tx_date, '%Y-%m') = '2001-03' THEN amount ELSE 0 END) AS f,
          SUM(CASE WHEN strftime(tx_date, '%Y-%m') = '2001-05' THEN amount ELSE 0 END) AS l
        FROM transactions
        WHERE amount > 0 AND strftime(tx_date, '%Y-%m') IN ('2001-03', '2001-05')
        GROUP BY user_id, category)) WHERE rank <= {k}"""


def merchant_total(period, patterns):
    like = " OR ".join(f"description ILIKE '{p}'" for p in patterns)
    return f"""SELECT user_id, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS spent
      FROM transactions WHERE amount > 0 AND {where(period)} AND ({like}) GROUP BY user_id"""


def recurring_charges(min_months, always):
    names = ", ".join(f"'{a}'" for a in always)
    return f"""SELECT user_id, description, COUNT(DISTINCT date_trunc('month', tx_date)) AS months,
      CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_amount
      FROM transactions WHERE amount > 0 GROUP BY user_id, description
      HAVING COUNT(DISTINCT date_trunc('month', tx_date)) >= {min_months}
          OR bool_or(category IN ({names}))"""


def transaction_count(period):
    return f"""SELECT user_id, COUNT(*) AS n FROM transactions
      WHERE {where(period)} GROUP BY user_id"""


def extreme_month(measure, which):
    flow = {"spend": "amount > 0", "income": "amount < 0", "net": "TRUE"}[measure]
    order = "DESC" if which == "max" else "ASC"
    return f"""SELECT user_id, month, CAST(amount AS DOUBLE) AS amount FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY amount {order}, month) AS r
      FROM (SELECT user_id, strftime(tx_date, '%Y-%m') AS month, SUM({METRICS[measure]}) AS amount
            FROM transactions WHERE {flow} AND {where('this_year')} GROUP BY 1, 2))
      WHERE r = 1"""


HALF_SPLIT = f"""SELECT user_id,
  CAST(SUM(CASE WHEN day(tx_date) <= 15 THEN amount ELSE 0 END) AS DOUBLE) AS first_half,
  CAST(SUM(CASE WHEN day(tx_date) > 15 THEN amount ELSE 0 END) AS DOUBLE) AS second_half
  FROM transactions WHERE amount > 0 AND {PERIODS['last_month']} GROUP BY user_id"""


def account_balance(account=None):
    only = f"WHERE name = '{account}'" if account else ""
    return f"SELECT user_id, name, CAST(balance AS DOUBLE) AS balance FROM accounts {only}"


def account_transfers(account, period):
    return f"""SELECT user_id, CAST(SUM(abs(amount)) AS DOUBLE) AS transferred
      FROM transactions WHERE {where(period, None, account)} GROUP BY user_id"""


def account_activity(account, period):
    return f"""SELECT user_id, id, tx_date, description, CAST(amount AS DOUBLE) AS amount,
      category, account FROM transactions WHERE {where(period, None, account)}"""


def finance_summary(period):
    return f"""SELECT r.user_id, r.category, CAST(r.spent AS DOUBLE) AS spent,
      CAST(b.monthly_limit AS DOUBLE) AS "limit",
      CAST(r.spent AS DOUBLE) / CAST(r.total AS DOUBLE) AS share
      FROM (SELECT *, MAX(CASE WHEN g = 1 THEN spent END) OVER (PARTITION BY user_id) AS total
        FROM (SELECT user_id, category, SUM(amount) AS spent, GROUPING(category) AS g
          FROM transactions WHERE amount > 0 AND {where(period)}
          GROUP BY GROUPING SETS ((user_id, category), (user_id)))) r
      LEFT JOIN budgets b ON b.user_id = r.user_id AND b.category = r.category"""


def savings_headroom(k=None):
    cap = f"WHERE r <= {k}" if k else ""
    return f"""SELECT user_id, category, monthly_avg, "limit", excess FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY excess DESC, category) AS r
      FROM (SELECT s.user_id, s.category, monthly_avg, CAST(b.monthly_limit AS DOUBLE) AS "limit",
        monthly_avg - COALESCE(CAST(b.monthly_limit AS DOUBLE), CAST(cheapest AS DOUBLE)) AS excess
        FROM (SELECT user_id, category, CAST(SUM(amount) AS DOUBLE) / 3.0::DOUBLE AS monthly_avg,
            LEAST(SUM(CASE WHEN month(tx_date) = 3 THEN amount ELSE 0 END),
                  SUM(CASE WHEN month(tx_date) = 4 THEN amount ELSE 0 END),
                  SUM(CASE WHEN month(tx_date) = 5 THEN amount ELSE 0 END)) AS cheapest
          FROM transactions WHERE amount > 0 AND {where('last_3_months')}
          GROUP BY user_id, category) s
        LEFT JOIN budgets b ON b.user_id = s.user_id AND b.category = s.category)) {cap}"""


SPEND_VS_BASELINE = f"""SELECT user_id, category, "current", baseline,
  "current" / NULLIF(baseline, 0) AS ratio FROM (
  SELECT user_id, category,
    CAST(SUM(CASE WHEN {PERIODS['this_month']} THEN amount ELSE 0 END) AS DOUBLE) AS "current",
    CAST(SUM(CASE WHEN {PERIODS['last_3_months']} THEN amount ELSE 0 END) AS DOUBLE)
      / 3.0::DOUBLE AS baseline
  FROM transactions WHERE amount > 0 AND tx_date >= DATE '2001-03-01'
  GROUP BY user_id, category)"""


def period_totals(periods):
    return " UNION ALL ".join(
        f"""SELECT user_id, '{p}' AS period, COUNT(*) AS n, CAST(SUM({SPENT}) AS DOUBLE) AS spent,
        CAST(SUM({INCOME}) AS DOUBLE) AS income FROM transactions WHERE {PERIODS[p]}
        GROUP BY user_id""" for p in periods)


CATEGORY_STATS = f"""SELECT user_id, strftime(tx_date, '%Y-%m') AS month, category, COUNT(*) AS n,
  CAST(SUM(amount) AS DOUBLE) AS total, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS mean,
  CAST(MIN(amount) AS DOUBLE) AS smallest, CAST(MAX(amount) AS DOUBLE) AS largest,
  (array_agg(description ORDER BY amount DESC, description DESC))[1] AS largest_merchant
  FROM transactions WHERE amount > 0 AND {PERIODS['this_year']} GROUP BY 1, 2, 3"""


def facts(grain):
    return f"""SELECT user_id, CAST(date_trunc('{grain}', tx_date) AS DATE) AS tx_date, category,
      account, CAST(SUM({SPENT}) AS DOUBLE) AS spent, CAST(SUM({INCOME}) AS DOUBLE) AS income,
      COUNT(*) AS n FROM transactions GROUP BY 1, 2, 3, 4"""
