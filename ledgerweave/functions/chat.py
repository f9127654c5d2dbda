"""Chat records: building, cleaning and rendering message lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.gather import gather_ordered
from ledgerweave.functions.jsontext import json_value, string_sql
from ledgerweave.schemas import TRAINING_RECORD

# Fixed value: the bookkeeping key carried by system messages.
QUESTION_KEY = "_question"
MIN_MESSAGES = 2

METADATA = TRAINING_RECORD["metadata"].dataType


def message(role: str, content: Column, question: Column | None = None) -> Column:
    note = F.lit(None).cast("string") if question is None else question
    return F.struct(F.lit(role).alias("role"), content.alias("content"),
                    note.alias(QUESTION_KEY))


def training_messages(system: Column, question: Column, user: Column, answer: Column) -> Column:
    """System, user and assistant message; the first remembers its question."""
    return F.array(message("system", system, question), message("user", user),
                   message("assistant", answer))


def chat_records(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation with its turns as an ordered message list."""
    turn = F.struct(F.col(role).alias("role"), F.col(text).alias("content"))
    return gather_ordered(turns, [key], order, turn, "messages")


def strip_question_key(messages: Column) -> Column:
    """Drops the bookkeeping key from open messages and keeps every other key."""
    return F.transform(messages, lambda m: F.map_filter(m, lambda k, _: k != QUESTION_KEY))


def enough_messages(messages: Column, least: int = MIN_MESSAGES) -> Column:
    return F.size(messages) >= least


def training_rows(records: DataFrame) -> DataFrame:
    """Cleaned messages of the records that are long enough; metadata is dropped."""
    return (records.select(strip_question_key(F.col("messages")).alias("messages"))
            .where(enough_messages(F.col("messages"))))


def prepend_system(messages: Column, system: Column) -> Column:
    """A leading system message, unless its text is empty."""
    first = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    return F.when(F.coalesce(system, F.lit("")) != "", F.concat(first, messages)).otherwise(messages)


def chat_text(messages: Column, begin: str = "<|im_start|>", split: str = "\n",
              end: str = "<|im_end|>\n") -> Column:
    """Messages as one training text.  The role markers belong to the tokenizer."""
    def turn(m: Column) -> Column:
        return F.concat(F.lit(begin), m["role"].cast("string"), F.lit(split),
                        m["content"].cast("string"), F.lit(end))
    return F.array_join(F.transform(messages, turn), "")


def record_line(metadata: T.StructType = METADATA) -> Column:
    """A training record, with ``messages`` and ``metadata``, as one JSON line.

    The bookkeeping key is written only where it is set.
    """
    note = (f"CASE WHEN m.{QUESTION_KEY} IS NULL THEN '' ELSE "
            f"concat(', \"{QUESTION_KEY}\": ', {string_sql(f'm.{QUESTION_KEY}')}) END")
    one = (f"concat('{{\"role\": ', {string_sql('m.role')}, ', \"content\": ', "
           f"{string_sql('m.content')}, {note}, '}}')")
    messages = F.expr(f"array_join(transform(messages, m -> {one}), ', ')")
    return F.concat(F.lit('{"messages": ['), messages, F.lit('], "metadata": '),
                    json_value("metadata", metadata), F.lit("}"))


def messages_line(data_type: T.DataType) -> Column:
    """A split record, ``messages`` only, as one JSON line."""
    return F.concat(F.lit('{"messages": '), json_value("messages", data_type), F.lit("}"))


def message_columns(fields: Sequence[str] = ("role", "content")) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
