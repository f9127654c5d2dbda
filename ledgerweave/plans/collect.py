"""Answers to a question bank for every tenant, as raw training examples.

Each distinct operator call runs once for all tenants and all questions that share it.
Transactions are read once for the whole bank: one aggregate writes daily facts, facts by
merchant and month, and the single rows of the periods whose rows are asked for.  Calls
that make sums per tenant share one aggregate over these facts, and lists of the same
kind share one window whatever their lengths.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import prompts
from ledgerweave.functions.chat import message_columns, prepend_system
from ledgerweave.functions.jsontext import json_object, json_value
from ledgerweave.functions.text import whole_dollars
from ledgerweave.operators import accounts as acc
from ledgerweave.operators import budgeting, cashflow, facts, merchants, spending, trends
from ledgerweave.operators.measures import BY, double, income, is_expense, spent
from ledgerweave.operators.ranking import top_k
from ledgerweave.operators.tally import tallies
from ledgerweave.periods import Period, hull, resolve
from ledgerweave.plans.completion import complete
from ledgerweave.plans.resume import FETCHED, STORED, outcome, pending
from ledgerweave.sources.questions import Call, Domain, Question
from ledgerweave.sources.shared import shared_dir, write_through

_CALLS_PER_JOB = 8
_MONTHLY = ("this_month", "last_month", "this_year", "same_month_last_year", "last_3_months")


# Columns of the working set beside the tenant's and the sums; null where a kind has none.
_KEYS = ("tx_date", "category", "account", "description", "id", "amount")
_BY_MERCHANT = ("merchant_total", "recurring_charges")
_BY_ROW = ("top_transactions", "account_activity")


@dataclass
class Tables:
    """The tables of one run; the working set is written on first use.

    ``register`` lists the tenants.  Without it they are those with an account and those with
    a transaction in any of the calls' periods.
    """
    transactions: DataFrame
    accounts: DataFrame
    budgets: DataFrame
    as_of: str
    by: Sequence[str] = BY
    register: DataFrame | None = None
    calls: tuple[Call, ...] | None = None

    def covering(self, calls: Sequence[Call]) -> Tables:
        """The same tables with a working set for the calls."""
        return self if self.calls is not None else replace(self, calls=tuple(calls))

    def only(self, tenants: DataFrame) -> Tables:
        """The same tables with the rows of the given tenants, one row each."""
        keys = tenants.withColumnsRenamed({c: f"_of_{c}" for c in self.by})
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in self.by]
        kept = [t.join(keys, same, "left_semi") if same else t
                for t in (self.transactions, self.accounts, self.budgets)]
        return replace(self, transactions=kept[0], accounts=kept[1], budgets=kept[2],
                       register=tenants)

    @cached_property
    def working_set(self) -> DataFrame:
        """Facts and single rows in one table, by ``kind``; the only scan of transactions."""
        path = shared_dir(self.transactions.sparkSession)
        made = working_set(self)
        made.write.partitionBy("kind").parquet(path)
        return made.sparkSession.read.schema(made.schema).parquet(path)

    def _of_kind(self, kind: str, *columns: str) -> DataFrame:
        return self.working_set.where(F.col("kind") == kind).select(*self.by, *columns)

    @cached_property
    def daily(self) -> DataFrame:
        return self._of_kind("day", "tx_date", "category", "account", "spent", "income", "n")

    @cached_property
    def monthly(self) -> DataFrame:
        return write_through(facts.monthly_facts(self.daily, self.by))

    @cached_property
    def by_merchant(self) -> DataFrame:
        return self._of_kind("merchant", "tx_date", "category", "description", "spent", "income", "n")

    @cached_property
    def single_rows(self) -> DataFrame:
        rows = self._of_kind("row", *_KEYS, "n")
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
        return rows.select(*self.by, *_KEYS, copies.alias("_copy")).drop("_copy")

    @cached_property
    def tenants(self) -> DataFrame:
        if self.register is not None:
            return self.register.select(*self.by).distinct()
        seen = self._of_kind("tenant")
        return write_through(self.accounts.select(*self.by).unionByName(seen).distinct())

    def source(self, params: dict) -> DataFrame:
        """Monthly facts where every period is made of whole months."""
        spans = [params[k] for k in ("period", "a", "b") if k in params]
        return self.monthly if all(s in _MONTHLY for s in spans) else self.daily


def _span(tables: Tables, calls: Sequence[Call]) -> Period | None:
    """The days that the periods of these calls cover; None without calls."""
    spans = [resolve(dict(c.params).get("period", "all"), tables.as_of) for c in calls]
    return hull(*spans) if spans else None


def working_set(tables: Tables) -> DataFrame:
    """Transactions summed by several sets of keys at once: tenant, kind, ``_KEYS`` and sums."""
    tx, calls = tables.transactions, tables.calls or ()
    merchant = [c for c in calls if c.operator in _BY_MERCHANT]
    single = [c for c in calls if c.operator in _BY_ROW]
    whole = all(dict(c.params).get("period", "all") in (*_MONTHLY, "all") for c in merchant)

    def kind(name: str, on: Column, **keys: Column) -> Column:
        fields = [keys.get(c, F.lit(None)).cast(tx.schema[c].dataType).alias(c) for c in _KEYS]
        return F.when(on, F.struct(F.lit(name).alias("kind"), *fields))
    spans = {"day": Period(facts_start(calls, tables.as_of)), "merchant": _span(tables, merchant),
             "row": _span(tables, single)}
    spans = {name: p for name, p in spans.items() if p is not None}
    inside = {name: p.contains("tx_date") for name, p in spans.items()}
    date = F.trunc("tx_date", "MM") if whole else F.col("tx_date")
    kinds = [kind("day", inside["day"], **{c: F.col(c) for c in ("tx_date", "category", "account")})]
    if merchant:
        kinds.append(kind("merchant", inside["merchant"] & is_expense(tx), tx_date=date,
                          category=F.col("category"), description=F.col("description")))
    if single:
        kinds.append(kind("row", inside["row"], **{c: F.col(c) for c in _KEYS}))
    if tables.register is None:
        kinds.append(kind("tenant", F.lit(True)))
    rows = tx.where(hull(*spans.values()).contains("tx_date")).select(
        *tables.by, spent(tx).alias("_spent"), income(tx).alias("_income"),
        F.explode(F.array_compact(F.array(*kinds))).alias("_k"))
    return (rows.select(*tables.by, "_spent", "_income", "_k.*")
            .groupBy(*tables.by, "kind", *_KEYS)
            .agg(F.sum("_spent").alias("spent"), F.sum("_income").alias("income"),
                 F.count("*").alias("n")))


def facts_start(calls: Sequence[Call], as_of: str) -> dt.date:
    """First day any of the calls looks at; "this year" is the least."""
    names = {"this_year"}
    for c in calls:
        p = dict(c.params)
        names |= {p[k] for k in ("period", "a", "b") if k in p}
        if "n" in p:
            names.add(f"last_{p['n']}_months")
    return min(resolve(name, as_of).start for name in names)


def _sorted(order: Sequence[str]) -> list[Column]:
    """``"name"`` or ``"name desc"`` as sort columns."""
    pairs = [(o.split() + ["asc"])[:2] for o in order]
    return [getattr(F.col(name), direction)() for name, direction in pairs]


def _on_facts(op: Callable, *order: str):
    def run(t: Tables, p: dict):
        return op(t.source(p), t.as_of, by=t.by, **p), _sorted(order)
    return run


def _on_budgets(op: Callable, *order: str):
    def run(t: Tables, p: dict):
        return op(t.source(p), t.budgets, t.as_of, by=t.by, **p), _sorted(order)
    return run


def _balance(t: Tables, p: dict):
    return acc.account_balance(t.accounts, by=t.by, **p), []


def _recurring(t: Tables, p: dict):
    return (merchants.recurring_charges(t.by_merchant, t.as_of, by=t.by, **p),
            _sorted(["avg_amount desc", "description"]))


# Sums per tenant, which share one aggregate over daily facts.  They have a row for every tenant.
TALLIES: dict[str, Callable] = {
    "spend_total": spending.spend_total_tally,
    "compare_periods": spending.compare_periods_tally,
    "avg_monthly": spending.avg_monthly_tally,
    "daily_average": spending.daily_average_tally,
    "transaction_count": spending.transaction_count_tally,
    "half_split": spending.half_split_tally,
    "income_total": cashflow.income_total_tally,
    "cash_flow": cashflow.cash_flow_tally,
    "account_transfers": acc.account_transfers_tally,
    "monthly_trend": trends.monthly_trend_tally,
}

# The other operators with the order of their rows; none means one row per tenant.
OPERATORS: dict[str, Callable] = {
    "budget_ranking": _on_budgets(budgeting.budget_ranking, "over_by desc", "category"),
    "budget_pace": _on_budgets(budgeting.budget_pace),
    "finance_summary": _on_budgets(budgeting.finance_summary, "category asc_nulls_first"),
    "savings_headroom": _on_budgets(budgeting.savings_headroom, "excess desc", "category"),
    "extreme_month": _on_facts(cashflow.extreme_month),
    "category_growth": _on_facts(trends.category_growth, "rank"),
    "spend_vs_baseline": _on_facts(trends.spend_vs_baseline, "current desc", "category"),
    "recurring_charges": _recurring,
    "account_balance": _balance,
}


def _top_categories(tables: Tables, calls: Sequence[Call], cap: int) -> DataFrame:
    """The rows of all top lists of categories: one aggregate and one window."""
    by, tx = list(tables.by), tables.daily
    asked = [(c, dict(c.params)) for c in calls]
    spans = [resolve(p["period"], tables.as_of) for _, p in asked]
    sums = (tx.where(hull(*spans).contains("tx_date")).where(is_expense(tx))
            .groupBy(*by, "category").agg(*[
                F.sum(F.when(s.contains("tx_date"), spent(tx))).alias(f"_{i}")
                for i, s in enumerate(spans)]))
    tagged = F.explode(F.array(*[
        F.struct(F.lit(c.text).alias("call"), F.lit(p["k"]).alias("k"), F.col(f"_{i}").alias("sum"))
        for i, (c, p) in enumerate(asked)]))
    rows = sums.select(*by, "category", tagged.alias("_t")).select(*by, "category", "_t.*")
    ranked = top_k(rows.where("sum is not null"), [*by, "call"], [F.desc("sum"), F.asc("category")],
                   min(cap, max(p["k"] for _, p in asked)))
    shown = ranked.where(F.col("rank") <= F.col("k")).withColumn("total", double(F.col("sum")))
    return shown.select(*by, "call", "rank", json_object(shown.schema, ["category", "total"])
                        .alias("row"), "category")


def _single_rows(tables: Tables, calls: Sequence[Call], cap: int) -> DataFrame:
    """Lists of transactions of any length, order and period: one window."""
    by, tx = list(tables.by), tables.single_rows
    day = F.datediff("tx_date", F.lit("1970-01-01").cast("date")).cast("decimal(18,2)")
    amount = F.col("amount").cast("decimal(18,2)")
    tags = []
    for c in calls:
        p = dict(c.params)
        on = resolve(p["period"], tables.as_of).contains("tx_date")
        if c.operator == "account_activity":
            on, order, k = on & (F.col("account") == p["account"]), (day, amount), p.get("cap") or cap
        elif p.get("by_abs"):
            order, k = (F.abs(amount).cast("decimal(18,2)"), (-day).cast("decimal(18,2)")), p["k"]
        else:
            on, order, k = on & (amount > 0), (amount, (-day).cast("decimal(18,2)")), p["k"]
        tags.append(F.when(on, F.struct(
            F.lit(c.text).alias("call"), F.lit(min(k, cap)).alias("k"), order[0].alias("first"),
            order[1].alias("second"))))
    rows = tx.select("*", F.explode(F.array_compact(F.array(*tags))).alias("_t")).select(
        *tx.columns, "_t.*")
    order = [F.desc("first"), F.desc("second"), *[F.asc(c) for c in ("description", "category",
                                                                      "account", "id")]]
    most = max(min(dict(c.params).get("k") or cap, cap) for c in calls)
    ranked = top_k(rows, [*by, "call"], order, most).where(F.col("rank") <= F.col("k"))
    shown = ranked.select(*by, "call", "rank", "id", "tx_date", "description",
                          double(F.col("amount")).alias("amount"), "category", "account")
    names = ["id", "tx_date", "description", "amount", "category", "account"]
    return shown.select(*by, "call", "rank", json_object(shown.schema, names).alias("row"), "category")


def _branch(df: DataFrame, order: Sequence[Column], by: Sequence[str], cap: int,
            call: Column) -> DataFrame:
    """Result rows as JSON with their rank and the call they answer."""
    category = F.col("category") if "category" in df.columns else F.lit(None).cast("string")
    names = [c for c in df.columns if c not in (*by, "rank")]
    if not order:
        df = df.withColumn("rank", F.lit(1))
    elif "rank" not in df.columns:
        df = top_k(df, by, order, cap)
    return df.where(F.col("rank") <= cap).select(
        *by, call.alias("call"), "rank", json_object(df.schema, names).alias("row"),
        category.alias("category"))


def _branches(tables: Tables, calls: Sequence[Call], cap: int) -> Iterator[DataFrame]:
    """The calls' rows; calls that can share a scan, an aggregate or a window do."""
    by, none = list(tables.by), F.lit(None).cast("string").alias("category")

    def of(*operators: str) -> list[Call]:
        return [c for c in calls if c.operator in operators]
    for source, rules in (("daily", TALLIES), ("by_merchant", {"merchant_total": merchants.merchant_total_tally})):
        if of(*rules):
            tx = getattr(tables, source)
            named = {c.text: rules[c.operator](tx, tables.as_of, **dict(c.params)) for c in of(*rules)}
            yield tallies(tx, named, by, tables.tenants).select(*by, "call", "rank", "row", none)
    if of("top_categories"):
        yield _top_categories(tables, of("top_categories"), cap)
    if of(*_BY_ROW):
        yield _single_rows(tables, of(*_BY_ROW), cap)
    statuses = {dict(c.params)["category"]: c.text for c in of("budget_status")}
    if statuses:
        status = budgeting.budget_status(tables.monthly, tables.budgets, tables.as_of, by=by)
        wanted = status.where(F.col("category").isin(*statuses))
        texts = F.create_map(*[F.lit(x) for pair in statuses.items() for x in pair])
        yield _branch(wanted, (), by, cap, texts[F.col("category")])
    for c in of(*OPERATORS):
        df, order = OPERATORS[c.operator](tables, dict(c.params))
        yield _branch(df, order, by, cap, F.lit(c.text))


def distinct_calls(questions: Sequence[Question]) -> list[Call]:
    return list(dict.fromkeys(c for q in questions for c in q.calls))


def answer_rows(tables: Tables, questions: Sequence[Question], cap: int = FETCHED) -> DataFrame:
    """Rows of all bindings of the bank: tenant, binding, part, rank, row, category.

    The calls' rows are written a few calls at a time, which keeps each job's
    plan small, and read back as one table.
    """
    uses = {(c.text, q.binding, part) for q in questions for part, c in enumerate(q.calls)}
    calls = distinct_calls(questions)
    tables = tables.covering(calls)
    spark = tables.transactions.sparkSession
    path, schema = shared_dir(spark), None
    branches = list(_branches(tables, calls, cap))
    for at in range(0, len(branches), _CALLS_PER_JOB):
        rows = reduce(DataFrame.unionByName, branches[at:at + _CALLS_PER_JOB])
        rows.write.mode("append").parquet(path)
        schema = rows.schema
    bindings = spark.createDataFrame(sorted(uses), "call string, binding string, part int")
    return (spark.read.schema(schema).parquet(path)
            .join(F.broadcast(bindings), "call").drop("call"))


def gather_rows(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per tenant and binding with its row list and result categories.

    The cap bounds the list.
    """
    ordered = F.array_sort(F.collect_list(F.struct("part", "rank", "row")))
    return (rows.groupBy(*by, "binding")
            .agg(ordered["row"].alias("rows"),
                 F.array_sort(F.collect_set(F.when(F.col("category") != "", F.col("category"))))
                 .alias("categories")))


def budget_context(examples: DataFrame, budgets: DataFrame, key: Sequence[str],
                   by: Sequence[str] = BY) -> DataFrame:
    """Adds ``context_section``: the limits of an example's ``categories`` as text.

    Empty where no category has a budget.  Lines are in alphabetical order.
    """
    wanted = examples.select(*dict.fromkeys([*key, *by]),
                             F.explode(F.array_distinct("categories")).alias("category"))
    line = F.concat(F.lit("  "), F.col("category"), F.lit(": $"),
                    whole_dollars(F.col("monthly_limit")), F.lit("/month"))
    text = F.concat(F.lit(prompts.BUDGET_HEADER + "\n"), F.array_join(
        F.array_sort(F.collect_list(F.struct("category", line.alias("line"))))["line"], "\n"),
        F.lit("\n\n"))
    found = wanted.join(budgets, [*by, "category"]).groupBy(*key).agg(text.alias("_context"))
    return (examples.join(found, list(key), "left")
            .withColumn("context_section", F.coalesce("_context", F.lit(""))).drop("_context"))


def tenant_questions(tenants: DataFrame, questions: Sequence[Question]) -> DataFrame:
    """Every tenant with every question of the bank."""
    bank = F.from_json(
        F.lit(json.dumps([{"q_no": i, "question": q.text, "binding": q.binding}
                          for i, q in enumerate(questions, 1)])),
        "array<struct<q_no:int,question:string,binding:string>>")
    return tenants.select("*", F.explode(bank).alias("_q")).select(*tenants.columns, "_q.*")


def collect_answers(tables: Tables, domain: Domain, done: DataFrame | None = None,
                    cap: int = FETCHED) -> DataFrame:
    """One row per tenant and question that is not done yet.

    Columns: tenant, ``q_no``, ``question``, ``sql`` (the operator calls),
    ``rows``, ``context_section``, ``full_prompt``, ``error`` and ``outcome``.  What is done
    is taken away first: only questions and tenants with something left are worked out, and
    with a register of tenants a run with nothing left reads no transactions.
    """
    by, questions = list(tables.by), domain.questions
    tables = tables.covering(distinct_calls(questions))
    work = tenant_questions(tables.tenants, questions)
    if done is not None:
        work = write_through(pending(work, done, [c for c in (*by, "question") if c in done.columns]))
        left = {r["question"] for r in work.select("question").distinct().collect()}
        questions = [q for q in questions if q.text in left]
        tables = replace(tables.only(write_through(work.select(*by).distinct())),
                         calls=tuple(distinct_calls(questions)))
    if questions:
        gathered = gather_rows(answer_rows(tables, questions, cap), by)
        answered = budget_context(gathered, tables.budgets, [*by, "binding"], by)
    else:
        answered = work.select(*by, "binding").limit(0).withColumns({
            "rows": F.array().cast("array<string>"), "context_section": F.lit("")})
    rows = F.coalesce("rows", F.array().cast("array<string>"))
    full = (work.join(answered, [*by, "binding"], "left")
            .select(*by, "q_no", "question", F.col("binding").alias("sql"), rows.alias("rows"),
                    F.coalesce("context_section", F.lit("")).alias("context_section"),
                    F.lit("").alias("error")))
    prompt = prompts.answer_prompt(F.col("question"), F.col("sql"), "rows",
                                   F.col("context_section"), domain.answer_template)
    has_rows = F.size("rows") > 0
    return (full.withColumn("full_prompt", F.when(has_rows, prompt).otherwise(""))
            .withColumn("outcome", outcome(F.col("error"), F.col("rows"))))


def with_chat(df: DataFrame, prompt: str, system: str, name: str) -> DataFrame:
    """Adds a prompt with its system text as a JSON message list, as chat functions take it."""
    user = F.array(F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content")))
    return (df.withColumn("_messages", prepend_system(user, F.lit(system)))
            .withColumn(name, json_value("_messages", message_columns())).drop("_messages"))


def baseline_answers(answers: DataFrame, domain: Domain, fn: Callable, **options) -> DataFrame:
    """Adds a model's ``answer`` to rows with an outcome of ``ok``.

    A failed call keeps rows, context and prompt, and sets ``error``.
    """
    ready = answers.where(F.col("outcome") == "ok").drop("error")
    asked = with_chat(ready, "full_prompt", domain.system_prompt, "_chat")
    got = (complete(asked, "_chat", fn, error="_error", **options).drop("_chat")
           .withColumn("error", F.coalesce("_error", F.lit("")))
           .withColumn("answer", F.coalesce("answer", F.lit(""))).drop("_error"))
    rest = (answers.where(F.col("outcome") != "ok").withColumn("answer", F.lit("")))
    return got.unionByName(rest).withColumn("outcome", outcome(F.col("error"), F.col("rows")))


def raw_examples(answers: DataFrame, by: Sequence[str] = BY, answer: Column | None = None,
                 stored: int = STORED) -> DataFrame:
    """The answers worth keeping, with at most ``stored`` rows each."""
    text = F.lit("") if answer is None else answer
    return (answers.where(F.col("outcome") == "ok")
            .select(*by, "question", "sql", F.slice("rows", 1, stored).alias("rows"),
                    F.coalesce("context_section", F.lit("")).alias("context_section"),
                    F.coalesce("full_prompt", F.lit("")).alias("full_prompt"),
                    text.alias("llama_answer"), F.lit("").alias("gold_answer")))
