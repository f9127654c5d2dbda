"""Raw examples to training records through a user's annotator function."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.chat import training_messages
from ledgerweave.functions.prompts import annotation_prompt
from ledgerweave.plans.completion import complete
from ledgerweave.plans.resume import pending
from ledgerweave.sources.questions import Domain


def with_prompts(raw: DataFrame, domain: Domain) -> DataFrame:
    return raw.withColumn("annotation_prompt", annotation_prompt(
        F.col("question"), F.col("sql"), "rows", F.col("context_section"),
        F.col("llama_answer"), domain.annotation_template))


def annotate(raw: DataFrame, domain: Domain, fn: Callable, done: DataFrame | None = None,
             key: Sequence[str] = ("question",), **options) -> DataFrame:
    """Examples not done yet with ``gold_answer`` and ``status`` ``ok`` or ``error``.

    Calls cost money and run at least once: write the result before using it.
    """
    work = raw if done is None else pending(raw, done, key)
    asked = with_prompts(work.drop("gold_answer"), domain)
    answered = complete(asked, "annotation_prompt", fn, answer="gold_answer", **options)
    return answered.withColumn("status", F.when(F.col("gold_answer").isNull(), "error")
                               .otherwise("ok"))


def training_records(annotated: DataFrame, domain: Domain, tenant: Sequence[str] = ()) -> DataFrame:
    """Chat records of the annotated examples; failed ones are left for the next run.

    Tenant columns go into the metadata.
    """
    messages = training_messages(F.lit(domain.system_prompt), F.col("question"),
                                 F.col("full_prompt"), F.col("gold_answer"))
    return (annotated.where(F.col("status") == "ok")
            .select(messages.alias("messages"),
                    F.struct(*tenant, "question", "sql").alias("metadata")))
