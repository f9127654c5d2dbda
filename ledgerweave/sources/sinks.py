"""JSON-lines output: appended ledgers and split files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.chat import messages_line, record_line
from ledgerweave.functions.jsontext import json_string, json_value
from ledgerweave.schemas import RAW_EXAMPLE

SPLITS = ("train", "valid", "test")


def raw_example_line(schema: T.StructType) -> Column:
    """A raw example as one JSON line; ``rows`` are JSON objects already.

    Columns beside those of a raw example, such as the tenant's, come first.
    """
    def text(name):
        return F.concat(F.lit(f'"{name}": '), json_string(f"coalesce({name}, '')"))
    known = set(RAW_EXAMPLE.names)
    tenant = [F.concat(F.lit(f'"{f.name}": '), json_value(f.name, f.dataType))
              for f in schema.fields if f.name not in known]
    rows = F.concat(F.lit('"rows": ['), F.array_join("rows", ", "), F.lit("]"))
    parts = [*tenant, text("question"), text("sql"), rows, text("context_section"),
             text("full_prompt"), text("llama_answer"), text("gold_answer")]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def append_raw_examples(examples: DataFrame, path: str, mode: str = "append") -> None:
    """Adds lines to the ledger, or replaces it; a failed job adds none."""
    line = raw_example_line(examples.schema)
    examples.select(line.alias("value")).write.mode(mode).text(path)


def append_training_records(records: DataFrame, path: str, mode: str = "append") -> None:
    line = record_line(records.schema["metadata"].dataType)
    records.select(line.alias("value")).write.mode(mode).text(path)


def write_splits(rows: DataFrame, folder: str, order: Sequence[Column | str] = ()) -> None:
    """One folder of JSON lines per split: ``split=train``, ``split=valid``, ``split=test``.

    ``rows`` has one row per record and split.  With ``order``, lines follow it from file to
    file by name and within each file; ranges of it are written side by side.
    """
    line = messages_line(rows.schema["messages"].dataType)
    keys = [f"_o{i}" for i in range(len(order))]
    laid = rows.select("split", line.alias("value"),
                       *[(F.col(o) if isinstance(o, str) else o).alias(k) for k, o in zip(keys, order)])
    if keys:
        laid = laid.repartitionByRange("split", *keys).sortWithinPartitions("split", *keys)
    laid.drop(*keys).write.mode("overwrite").partitionBy("split").text(folder)


def answer_sizes(examples: DataFrame) -> DataFrame:
    """Row count and answer length per question."""
    keys = [c for c in ("user_id", "question") if c in examples.columns]
    return examples.select(*keys, F.size("rows").alias("n_rows"),
                           F.char_length("gold_answer").alias("answer_chars"))
