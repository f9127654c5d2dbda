"""Prompt texts.  All texts in this module are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweave.functions.jsontext import indented_rows
from ledgerweave.functions.text import fill_template

SYSTEM_PROMPT = (
    "You are a private finance coach. "
    "All data is processed locally on the user's device."
)

TABLE_TEXT = """
Table: transactions
  id          INTEGER PRIMARY KEY
  date        TEXT              -- YYYY-MM-DD
  description TEXT              -- merchant / payee name
  amount      REAL              -- positive = expense, negative = income/credit
  category    TEXT              -- Groceries, Restaurants, Rent, Utilities,
                                --   Transport, Entertainment, Shopping, Health,
                                --   Subscriptions, Income, Other
  account     TEXT              -- Checking, Savings, Credit Card

Table: accounts
  name    TEXT PRIMARY KEY      -- Checking, Savings, Credit Card
  type    TEXT
  balance REAL

Table: budgets
  category      TEXT PRIMARY KEY
  monthly_limit REAL            -- monthly spending limit in dollars
"""

SQL_TEMPLATE = """\
You are a SQLite expert. Write one SQL query to answer the question below.

Schema:
{schema}

Question: "{question}"

Rules:
- Use strftime('%Y-%m', date) to group by month
- "last month"  -> WHERE date >= date('now','start of month','-1 month')
                   AND date  <  date('now','start of month')
- "this month"  -> WHERE date >= date('now','start of month')
- "this year"   -> WHERE strftime('%Y', date) = strftime('%Y', 'now')
- "last N days" -> WHERE date >= date('now', '-N days')
- Positive amounts are expenses; negative amounts are income / credits
- For spending totals: SUM(amount) WHERE amount > 0
- Always include ORDER BY date DESC or ORDER BY total DESC where useful
- Return ONLY the SQL query, no explanation, no markdown fences
"""

#: The tables as ``plans.adhoc`` offers them, and rules in the SQL that it runs.
SPARK_TABLE_TEXT = """
Table: transactions
  id          BIGINT
  tx_date     DATE
  description STRING            -- merchant / payee name
  amount      DECIMAL(18,2)     -- positive = expense, negative = income/credit
  category    STRING
  account     STRING

Table: accounts
  name    STRING
  type    STRING
  balance DECIMAL(18,2)

Table: budgets
  category      STRING
  monthly_limit DECIMAL(18,2)   -- monthly spending limit in dollars
"""

SPARK_SQL_TEMPLATE = """\
You are a Spark SQL expert. Write one SQL query to answer the question below.

Schema:
{schema}

Question: "{question}"

Rules:
- Today is DATE'{as_of}'; never use current_date() or now()
- Use date_format(tx_date, 'yyyy-MM') to group by month
- "last month"  -> WHERE tx_date >= add_months(trunc(DATE'{as_of}', 'MM'), -1)
                   AND tx_date <  trunc(DATE'{as_of}', 'MM')
- "this month"  -> WHERE tx_date >= trunc(DATE'{as_of}', 'MM')
- "this year"   -> WHERE tx_date >= trunc(DATE'{as_of}', 'YEAR')
- "last N days" -> WHERE tx_date >= date_sub(DATE'{as_of}', N)
- Positive amounts are expenses; negative amounts are income / credits
- For spending totals: SUM(amount) WHERE amount > 0
- Always include ORDER BY tx_date DESC or ORDER BY total DESC where useful
- Return ONLY the SQL query, no explanation, no markdown fences
"""

ANSWER_TEMPLATE = """\
The user asked: "{question}"

SQL used:
{sql}

Data returned:
{results}
{budget_section}
Give a brief, specific finance coaching response using only the numbers above.
"""

ANNOTATION_TEMPLATE = """\
You are writing gold-standard coaching responses for a private finance AI coach.

## Examples of perfect responses

Q: "How much did I spend on restaurants last month?"
Data: total $342.50, budget $300/month
GOOD: "You spent $342.50 on restaurants last month, which puts you $42.50 over \
your $300 budget — about 14% above target. The data shows most of the overage \
came from weekend dinners, so trying to cook at home on one of those weekend \
nights would likely bring you back on track next month."

Q: "Am I saving money this month?"
Data: income $8,400, spending $6,180, net +$2,220
GOOD: "You're ahead this month — $8,400 in income against $6,180 in spending \
leaves a $2,220 surplus, a savings rate of about 26%. If you want to put that \
surplus to work, moving it to a savings account before the end of the month \
prevents it from disappearing into discretionary spending."

---

## Context for this example

Question: {question}

SQL executed:
{sql}

Data returned:
{results}
{context_section}
## Baseline model answer
{llama_answer}

---

## Your task

Rewrite the baseline answer to gold-standard quality:
1. Lead with the key number(s) directly from the data.
2. Add context: compare to budget, prior period, or a benchmark.
3. Close with one concrete, actionable next step.

Rules:
- 3-5 sentences. Flowing prose — no bullet points, no headers.
- Warm and specific, like a knowledgeable friend.
- Only use numbers visible in the data above. Never invent values.
- Never give tax, investment, or legal advice.

Write ONLY the response text (no preamble, no sign-off):"""

BUDGET_HEADER = "Budget limits:"
BUDGET_LINE = "  {category}: ${limit}/month"

# How many rows an answering and an annotating model get to see.
ANSWER_ROWS, ANNOTATION_ROWS = 15, 10


def sql_prompt(question: Column, template: str = SQL_TEMPLATE, schema: str = TABLE_TEXT) -> Column:
    return fill_template(template, schema=F.lit(schema), question=question)


def spark_sql_prompt(question: Column, as_of: str, template: str = SPARK_SQL_TEMPLATE,
                     schema: str = SPARK_TABLE_TEXT) -> Column:
    """A prompt for a query that ``plans.adhoc.run_query`` runs, with dates relative to ``as_of``."""
    return fill_template(template, schema=F.lit(schema), question=question, as_of=F.lit(str(as_of)))


def answer_prompt(question: Column, sql: Column, rows: str, budget_section: Column,
                  template: str = ANSWER_TEMPLATE) -> Column:
    """``rows`` names a list of JSON objects; the first 15 are shown."""
    return fill_template(template, question=question, sql=sql, budget_section=budget_section,
                         results=indented_rows(rows, ANSWER_ROWS))


def annotation_prompt(question: Column, sql: Column, rows: str, context: Column,
                      baseline: Column, template: str = ANNOTATION_TEMPLATE) -> Column:
    """``rows`` names a list of JSON objects; the first 10 are shown."""
    return fill_template(template, question=question, sql=sql, context_section=context,
                         llama_answer=baseline,
                         results=indented_rows(rows, ANNOTATION_ROWS))
