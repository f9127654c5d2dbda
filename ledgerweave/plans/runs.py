"""The three phases as resumable runs over folders of JSON lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.chat import training_rows
from ledgerweave.plans import splitting
from ledgerweave.plans.annotate import annotate, training_records
from ledgerweave.plans.collect import Tables, baseline_answers, collect_answers, raw_examples
from ledgerweave.plans.resume import annotate_summary, collect_summary, pending
from ledgerweave.schemas import RAW_EXAMPLE, TRANSACTIONS
from ledgerweave.sources.jsonl import (
    annotated_questions, done_questions, read_records, read_strict,
)
from ledgerweave.sources.questions import Domain
from ledgerweave.sources.shared import write_through
from ledgerweave.sources.sinks import (
    append_raw_examples, append_training_records, write_splits,
)


def tenant_fields(by: Sequence[str], schema: T.StructType = TRANSACTIONS) -> list[T.StructField]:
    return [schema[name] for name in by]


def existing_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The lines of an earlier run, in whatever folders below, or None before the first."""
    try:
        return spark.read.option("recursiveFileLookup", True).text(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_collect(tables: Tables, domain: Domain, path: str, fn: Callable | None = None,
                **options) -> DataFrame:
    """Appends raw examples for all questions not in ``path`` yet; returns the run's counts.

    ``fn`` writes baseline answers.  Answers are written once before they are
    used, so no call to ``fn`` is repeated for the counts.
    """
    spark = tables.transactions.sparkSession
    lines = existing_lines(spark, path)
    done = None
    if lines is not None:
        fields = tenant_fields(tables.by, tables.transactions.schema)
        done = write_through(done_questions(lines, fields))
    answers = collect_answers(tables, domain, done)
    if fn is None:
        answers = answers.withColumn("answer", F.lit(""))
    else:
        answers = baseline_answers(answers, domain, fn, **options)
    answers = write_through(answers)
    append_raw_examples(raw_examples(answers, tables.by, F.col("answer")), path)
    outcomes = answers.select("outcome")
    if done is not None:
        bank = spark.createDataFrame([(q.text,) for q in domain.questions], "question string")
        old = done.join(F.broadcast(bank), "question")
        outcomes = outcomes.unionByName(old.select(F.lit("already_done").alias("outcome")))
    return collect_summary(outcomes)


def run_annotate(spark: SparkSession, raw_path: str, path: str, domain: Domain, fn: Callable,
                 tenant: Sequence[T.StructField] = (), *, chunks: int = 1, **options) -> DataFrame:
    """Appends training records for all raw examples not in ``path`` yet; returns the counts.

    The work is done in ``chunks`` jobs, each of which adds its lines before the next one
    starts.  A run that is killed loses the calls of one chunk; the next run leaves out
    what the finished ones have written, so no line is added twice.
    """
    names = [f.name for f in tenant]
    key = [*names, "question"]
    raw, _ = read_records(spark.read.text(raw_path), T.StructType([*tenant, *RAW_EXAMPLE.fields]))
    lines = existing_lines(spark, path)
    done = None if lines is None else write_through(annotated_questions(lines, tenant))
    work = raw if done is None else pending(raw, done, key)
    number = F.pmod(F.xxhash64(*key), F.lit(chunks))
    parts = []
    for chunk in range(chunks):
        some = work.where(number == chunk) if chunks > 1 else work
        annotated = write_through(annotate(some, domain, fn, **options))
        append_training_records(training_records(annotated, domain, names), path)
        parts.append(annotated.select("status"))
    statuses = reduce(DataFrame.unionByName, parts)
    if done is not None:
        old = raw.join(done, key, "left_semi")
        statuses = statuses.unionByName(old.select(F.lit("already_done").alias("status")))
    return annotate_summary(statuses)


def run_prepare(spark: SparkSession, path: str, folder: str, *, seed: int = splitting.SEED,
                valid_share: float = splitting.VALID_SHARE) -> DataFrame:
    """Splits the training records of ``path`` into folders of JSON lines; returns the counts.

    A record's place in the shuffle comes from its whole text, and lines are written in
    shuffled order.
    """
    rows = training_rows(read_strict(spark.read.text(path)))
    keyed = rows.withColumn("_key", F.to_json("messages"))
    split = splitting.split_records(keyed, ["_key"], seed=seed, valid_share=valid_share)
    write_splits(split, folder, [splitting.shuffle_hash(["_key"], seed), "_key"])
    return splitting.split_counts(spark.read.text(folder))
