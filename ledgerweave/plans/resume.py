"""What is left to do, and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows fetched per answer, shown to the answering model, and stored.
ANSWER_CAPS = FETCHED, SHOWN, STORED = 200, 15, 10


def pending(work: DataFrame, done: DataFrame, key: Sequence[str] = ("question",)) -> DataFrame:
    """Work whose key is not done yet.

    ``done`` is read once: a key that is twice in ``work`` is done twice.  A null
    key in ``done`` removes nothing.
    """
    return work.join(done.select(*key).distinct(), list(key), "left_anti")


def outcome(error: Column, rows: Column) -> Column:
    """An error counts before missing rows."""
    return (F.when(F.coalesce(error, F.lit("")) != "", "error")
            .when(F.coalesce(F.size(rows), F.lit(0)) < 1, "no_data").otherwise("ok"))


def collect_summary(outcomes: DataFrame) -> DataFrame:
    """Counts of new, skipped and failed questions.

    ``outcome`` is ``ok``, ``error``, ``no_data`` or ``already_done``.
    """
    kind = (F.when(F.col("outcome") == "ok", "new").when(F.col("outcome") == "error", "errors")
            .otherwise("skipped"))
    return outcomes.groupBy(kind.alias("result")).agg(F.count("*").alias("n"))


def annotate_summary(statuses: DataFrame) -> DataFrame:
    """Counts of annotated, skipped and failed examples."""
    kind = (F.when(F.col("status") == "ok", "annotated").when(F.col("status") == "error", "errors")
            .otherwise("skipped"))
    return statuses.groupBy(kind.alias("result")).agg(F.count("*").alias("n"))
