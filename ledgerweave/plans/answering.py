"""Answers to questions that come with their own query text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions.prompts import answer_prompt
from ledgerweave.functions.text import clean_sql_text
from ledgerweave.functions.jsontext import json_object
from ledgerweave.plans.adhoc import run_query
from ledgerweave.plans.collect import baseline_answers, budget_context
from ledgerweave.plans.resume import FETCHED, outcome
from ledgerweave.sources.questions import Domain
from ledgerweave.sources.shared import shared_dir, write_through

NO_SQL = "LLM returned no SQL"
_ROWS = "q_no int, rank long, row string"


def _write_rows(spark: SparkSession, sql: str, q_no: int, tables: Mapping[str, DataFrame],
                cap: int, path: str) -> str:
    """Adds a text's rows, numbered in their order, to a table; returns what went wrong."""
    result = run_query(spark, sql, tables, cap)
    if result.rows is None:
        return result.error
    try:       # the cap leaves one partition, in which ids follow the order
        (result.rows.select(json_object(result.rows.schema).alias("row"))
         .select(F.lit(q_no).alias("q_no"), F.monotonically_increasing_id().alias("rank"), "row")
         .write.mode("append").parquet(path))
        return ""
    except Exception as problem:  # noqa: BLE001 - a text that fails while running is a result too
        return f"SQL error: {str(problem).splitlines()[0]}"


def answer_questions(spark: SparkSession, texts: Sequence[tuple[str, str]],
                     tables: Mapping[str, DataFrame], budgets: DataFrame, domain: Domain,
                     cap: int = FETCHED, *, tenant: Mapping[str, object] | None = None,
                     fn: Callable | None = None, **options) -> DataFrame:
    """Runs each question's query text, prepares its prompt and has it answered.

    ``texts`` is a question bank with one query text per question, as a model wrote it.  Each
    query adds at most ``cap`` rows to one table that the answers are put together from; only
    texts and errors pass the driver.  A missing text or a failing query becomes an error
    outcome and does not stop the others.

    With ``tenant``, such as ``{"user_id": 7}``, texts see the tables and budgets of that tenant
    alone, without its column.  With ``fn``, answers to the prompts are added as ``answer``;
    ``options`` go to ``complete``.
    """
    def own(df: DataFrame) -> DataFrame:
        for column, value in (tenant or {}).items():
            if column in df.columns:
                df = df.where(F.col(column).eqNullSafe(F.lit(value))).drop(column)
        return df
    tables, budgets = {name: own(df) for name, df in tables.items()}, own(budgets)
    given = spark.createDataFrame([(i, q, s) for i, (q, s) in enumerate(texts, 1)],
                                  "q_no int, question string, text string")
    cleaned = given.select("q_no", "question", clean_sql_text(F.col("text")).alias("sql")).collect()
    path = shared_dir(spark)
    spark.createDataFrame([], _ROWS).write.parquet(path)
    asked = [(r["q_no"], r["question"], r["sql"],
              _write_rows(spark, r["sql"], r["q_no"], tables, cap, path) if r["sql"] else NO_SQL)
             for r in cleaned]
    bank = spark.createDataFrame(asked, "q_no int, question string, sql string, error string")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "row")))
    gathered = (spark.read.schema(_ROWS).parquet(path).groupBy("q_no")
                .agg(ordered["row"].alias("rows")))       # the cap bounds the list
    none = F.array().cast("array<string>")
    answers = bank.join(gathered, "q_no", "left").withColumn("rows", F.coalesce("rows", none))
    named = F.transform("rows", lambda r: F.get_json_object(r, "$.category"))
    answers = answers.withColumn("categories", F.filter(named, lambda c: F.coalesce(c, F.lit("")) != ""))
    with_context = budget_context(answers, budgets, ["q_no"], ())
    prompt = answer_prompt(F.col("question"), F.col("sql"), "rows",
                           F.col("context_section"), domain.answer_template)
    ready = (with_context.drop("categories")
             .withColumn("full_prompt", F.when(F.size("rows") > 0, prompt).otherwise(""))
             .withColumn("outcome", outcome(F.col("error"), F.col("rows"))))
    return ready if fn is None else baseline_answers(write_through(ready), domain, fn, **options)
