"""Readers of JSON lines, tolerant and strict.

Each takes lines in a ``value`` column, as ``spark.read.text`` or
``spark.readStream.text`` gives them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.jsontext import strict_record
from ledgerweave.functions.text import strip
from ledgerweave.schemas import OPEN_RECORD, RAW_EXAMPLE


def _record(schema: T.StructType) -> Column:
    return strict_record(F.col("value"), schema.simpleString())


def done_questions(lines: DataFrame, tenant: Sequence[T.StructField] = ()) -> DataFrame:
    """Distinct questions of earlier output; unusable lines are passed over.

    ``tenant`` gives the tenant columns written beside each question.
    """
    record = _record(T.StructType([*tenant, RAW_EXAMPLE["question"]]))
    names = [f.name for f in tenant] + ["question"]
    return (lines.select(record.alias("r")).select(*[f"r.{n}" for n in names])
            .where(F.col("question").isNotNull()).distinct())


def annotated_questions(lines: DataFrame, tenant: Sequence[T.StructField] = ()) -> DataFrame:
    """Distinct non-empty questions remembered by earlier training records."""
    shape = T.StructType([*OPEN_RECORD.fields, T.StructField("metadata", T.StructType(
        [*tenant, T.StructField("question", T.StringType())]))])
    rows = lines.select(_record(shape).alias("r"))
    first = F.try_element_at("r.messages", F.lit(1))
    return (rows.select(*[F.col(f"r.metadata.{f.name}") for f in tenant],
                        first["_question"].cast("string").alias("question"))
            .where(F.coalesce(F.col("question"), F.lit("")) != "").distinct())


def read_records(lines: DataFrame, schema: T.StructType = RAW_EXAMPLE,
                 key: str = "question") -> tuple[DataFrame, DataFrame]:
    """Usable records, and the lines that are none with the reason."""
    parsed = lines.select("value", _record(schema).alias("r"))
    good = parsed.where(F.col("r")[key].isNotNull()).select("r.*")
    reason = F.when(F.col("r").isNull(), "malformed").otherwise(f"no {key}")
    rejects = (parsed.where(F.col("r")[key].isNull())
               .select("value", reason.alias("reason")))
    return good, rejects


def read_strict(lines: DataFrame, schema: T.StructType = OPEN_RECORD) -> DataFrame:
    """Records of all non-blank lines; a malformed one fails the job.

    Missing messages count as an empty list.
    """
    parsed = lines.where(strip(F.col("value")) != "").select("value", _record(schema).alias("r"))
    problem = F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))).cast("boolean")
    checked = parsed.where(F.when(F.col("r").isNotNull(), F.lit(True)).otherwise(problem))
    empty = F.array().cast(schema["messages"].dataType)
    return checked.select(F.coalesce("r.messages", empty).alias("messages"))
