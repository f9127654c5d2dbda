"""The question bank and the operators that answer its questions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerweave.functions import prompts


@dataclass(frozen=True)
class Call:
    """One operator with its parameters."""
    operator: str
    params: tuple[tuple[str, object], ...]

    @property
    def text(self) -> str:
        return f"{self.operator}({', '.join(f'{k}={v!r}' for k, v in self.params)})"


@dataclass(frozen=True)
class Question:
    text: str
    calls: tuple[Call, ...]

    @property
    def binding(self) -> str:
        return "; ".join(c.text for c in self.calls)


def call(operator: str, **params) -> Call:
    return Call(operator, tuple(sorted(params.items())))


def _spend(**p):
    return (call("spend_total", **p),)


def _trend(measure="spend", n=3, category=None):
    return (call("monthly_trend", measure=measure, n=n, category=category),)


_HEADROOM = (call("savings_headroom", n=3),)
COFFEE = ("%starbucks%", "%coffee%", "%cafe%", "%espresso%")
DELIVERY = ("%doordash%", "%uber eats%", "%grubhub%", "%delivery%")

# The questions in their order.  The operators behind them are
# defaults and may be replaced.
_BANK = (
    ("How much did I spend last month in total?", _spend(period="last_month")),
    ("What were my top 5 spending categories last month?",
     (call("top_categories", period="last_month", k=5),)),
    ("How much did I spend on groceries last month?",
     _spend(period="last_month", category="Groceries")),
    ("How much did I spend on restaurants last month?",
     _spend(period="last_month", category="Restaurants")),
    ("How much did I spend on entertainment this month?",
     _spend(period="this_month", category="Entertainment")),
    ("What was my total spending this month so far?", _spend(period="this_month")),
    ("How does my spending this month compare to last month?",
     (call("compare_periods", a="this_month", b="last_month"),)),
    ("What were my biggest purchases last month?",
     (call("top_transactions", period="last_month", k=5),)),
    ("How much have I spent on subscriptions this month?",
     _spend(period="this_month", category="Subscriptions")),
    ("What did I spend the most on last week?",
     (call("top_categories", period="last_week", k=1),)),
    ("How much did I spend on transport this month?",
     _spend(period="this_month", category="Transport")),
    ("How much did I spend on health and wellness this month?",
     _spend(period="this_month", category="Health")),
    ("What was my total spending in the last 30 days?", _spend(period="last_30_days")),
    ("How much did I spend on shopping last month?",
     _spend(period="last_month", category="Shopping")),
    ("What are my top 3 spending categories over the past 3 months?",
     (call("top_categories", period="last_3_months", k=3),)),
    ("How much did I spend on utilities last month?",
     _spend(period="last_month", category="Utilities")),
    ("How much have I spent on rent this year?", _spend(period="this_year", category="Rent")),
    ("What is my average monthly spending over the past 3 months?",
     (call("avg_monthly", measure="spend", n=3),)),
    ("How much did I spend last week in total?", _spend(period="last_week")),
    ("What is my daily average spending this month?",
     (call("daily_average", period="this_month"),)),
    ("Am I over budget on restaurants this month?",
     (call("budget_status", category="Restaurants"),)),
    ("How close am I to my grocery budget this month?",
     (call("budget_status", category="Groceries"),)),
    ("Which categories am I over budget in this month?", (call("budget_ranking", side="over"),)),
    ("How much do I have left in my entertainment budget?",
     (call("budget_status", category="Entertainment"),)),
    ("Am I on track with my overall spending this month?", (call("budget_pace"),)),
    ("How does my restaurant spending compare to my budget?",
     (call("budget_status", category="Restaurants"),)),
    ("How much have I spent vs my transport budget this month?",
     (call("budget_status", category="Transport"),)),
    ("Which spending category is furthest over budget?",
     (call("budget_ranking", side="over", k=1),)),
    ("Am I under budget in any categories this month?", (call("budget_ranking", side="under"),)),
    ("How much of my subscription budget have I used?",
     (call("budget_status", category="Subscriptions"),)),
    ("How much did I earn last month?", (call("income_total", period="last_month"),)),
    ("What is my income vs spending this month?", (call("cash_flow", period="this_month"),)),
    ("Am I saving money this month or spending more than I earn?",
     (call("cash_flow", period="this_month"),)),
    ("What is my savings rate this month?", (call("cash_flow", period="this_month"),)),
    ("How much have I saved this year?", (call("cash_flow", period="this_year"),)),
    ("What is my average monthly income over the past 3 months?",
     (call("avg_monthly", measure="income", n=3),)),
    ("How does my income this month compare to last month?",
     (call("compare_periods", a="this_month", b="last_month", measure="income"),)),
    ("How much went into savings this month?",
     (call("account_transfers", account="Savings", period="this_month"),)),
    ("Has my spending been going up or down over the past 3 months?", _trend()),
    ("How has my restaurant spending trended over the past 3 months?",
     _trend(category="Restaurants")),
    ("Is my grocery spending increasing or decreasing?", _trend(category="Groceries")),
    ("How has my total monthly spending changed over the past 3 months?", _trend()),
    ("Which category has grown the most in spending over the past 3 months?",
     (call("category_growth", n=3, k=1),)),
    ("Am I spending more on subscriptions than I was 3 months ago?",
     _trend(n=4, category="Subscriptions")),
    ("How has my savings trend looked over the past 3 months?", _trend(measure="net")),
    ("Is my transport spending going up or down?", _trend(category="Transport")),
    ("What is my 3-month trend for total spending?", _trend()),
    ("How much have I spent at coffee shops this month?",
     (call("merchant_total", period="this_month", patterns=COFFEE),)),
    ("How many times did I order food delivery last month?",
     (call("merchant_total", period="last_month", patterns=DELIVERY),)),
    ("What was my most expensive single purchase last month?",
     (call("top_transactions", period="last_month", k=1),)),
    ("How much have I spent on Amazon this month?",
     (call("merchant_total", period="this_month", patterns=("%amazon%",)),)),
    ("What are my recurring subscriptions and how much do they cost?",
     (call("recurring_charges", always=("Subscriptions",), min_months=2),)),
    ("How much did I spend at restaurants this week?",
     _spend(period="this_week", category="Restaurants")),
    ("What was my largest transaction last month?",
     (call("top_transactions", period="last_month", k=1, by_abs=True),)),
    ("How many transactions did I make last month?",
     (call("transaction_count", period="last_month"),)),
    ("How much have I spent at grocery stores this week?",
     _spend(period="this_week", category="Groceries")),
    ("How does this month's spending compare to the same month last year?",
     (call("compare_periods", a="this_month", b="same_month_last_year"),)),
    ("What was my highest spending month this year?",
     (call("extreme_month", measure="spend", which="max"),)),
    ("What was my lowest spending month this year?",
     (call("extreme_month", measure="spend", which="min"),)),
    ("How does my spending this week compare to last week?",
     (call("compare_periods", a="this_week", b="last_week"),)),
    ("Which month this year did I save the most?",
     (call("extreme_month", measure="net", which="max"),)),
    ("How much did I spend in the first half vs second half of last month?",
     (call("half_split", period="last_month"),)),
    ("How much is on my credit card right now?", (call("account_balance", account="Credit Card"),)),
    ("How much have I spent on my credit card this month?",
     _spend(period="this_month", account="Credit Card")),
    ("What is my checking account balance?", (call("account_balance", account="Checking"),)),
    ("How much did I transfer to savings this month?",
     (call("account_transfers", account="Savings", period="this_month"),)),
    ("What transactions hit my checking account this week?",
     (call("account_activity", account="Checking", period="this_week"),)),
    ("How does my credit card spending this month compare to last month?",
     (call("compare_periods", a="this_month", b="last_month", account="Credit Card"),)),
    ("Where am I wasting the most money?", _HEADROOM),
    ("What is one spending habit I should change based on my data?", _HEADROOM),
    ("Am I living within my means based on the last 3 months?",
     (call("cash_flow", period="last_3_months"),)),
    ("What category should I try to cut back on?", _HEADROOM),
    ("Based on my spending patterns, how much could I realistically save extra per month?",
     _HEADROOM),
    ("Am I spending too much on eating out?", (call("budget_status", category="Restaurants"),)),
    ("What does my data say about my financial health?",
     (call("finance_summary", period="this_month"),)),
    ("What are my biggest financial risks based on my spending?",
     (call("finance_summary", period="this_month"),)),
    ("How can I improve my savings rate based on my data?",
     (call("cash_flow", period="this_month"), *_HEADROOM)),
    ("What is the one change that would have the biggest positive impact on my finances?",
     _HEADROOM),
    ("Give me a summary of my finances this month.",
     (call("finance_summary", period="this_month"),)),
    ("How am I doing financially this month?", (call("finance_summary", period="this_month"),)),
    ("Is my spending normal this month?", (call("spend_vs_baseline", n=3),)),
    ("Walk me through where my money went last month.",
     (call("finance_summary", period="last_month"),)),
    ("How have I been spending lately?", _trend()),
    ("Am I on track financially?", (call("budget_pace"),)),
    ("What does my financial data look like recently?",
     (call("finance_summary", period="last_3_months"),)),
    ("Give me a financial health check.", (call("finance_summary", period="this_month"),)),
    ("How does my month look so far?", (call("finance_summary", period="this_month"),)),
    ("What should I be watching in my spending right now?",
     (call("budget_ranking", side="all"), call("spend_vs_baseline", n=3))),
)

QUESTIONS = tuple(Question(text, calls) for text, calls in _BANK)


def rename(questions: Sequence[Question], names: dict[str, str]) -> tuple[Question, ...]:
    """The bank with category, account and merchant names replaced."""
    def swap(value):
        if isinstance(value, tuple):
            return tuple(names.get(v, v) for v in value)
        return names.get(value, value)
    return tuple(Question(q.text, tuple(
        Call(c.operator, tuple((k, swap(v)) for k, v in c.params)) for c in q.calls))
        for q in questions)


@dataclass(frozen=True)
class Domain:
    """What a data set is made of: questions, their operators, and prompt texts."""
    questions: tuple[Question, ...] = QUESTIONS
    system_prompt: str = prompts.SYSTEM_PROMPT
    answer_template: str = prompts.ANSWER_TEMPLATE
    annotation_template: str = prompts.ANNOTATION_TEMPLATE

    def __post_init__(self):
        for name in ("questions", "system_prompt", "answer_template", "annotation_template"):
            if not getattr(self, name):
                raise ValueError(f"a domain needs {name}")
        for template, fields in ((self.answer_template,
                                  ("question", "sql", "results", "budget_section")),
                                 (self.annotation_template,
                                  ("question", "sql", "results", "context_section",
                                   "llama_answer"))):
            missing = [f for f in fields if "{" + f + "}" not in template]
            if missing:
                raise ValueError(f"a template lacks {', '.join(missing)}")
        unbound = [q.text for q in self.questions if not q.calls]
        if unbound:
            raise ValueError(f"no operator for: {unbound[0]}")


def question_frame(spark: SparkSession, questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """The bank as rows, numbered from 1."""
    rows = [(i, q.text, q.binding) for i, q in enumerate(questions, 1)]
    return spark.createDataFrame(rows, "q_no int, question string, binding string")
