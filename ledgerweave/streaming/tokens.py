"""Responses put together again from logged stream chunks.

Input rows are ``(request_id, seq, raw_line)``.  Chunks are joined in two
rounds: first inside runs of sequence numbers, then per request, where only one
finished text per run is left.  No window or join runs over a whole request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.gather import segment_of
from ledgerweave.functions.jsontext import strict_record
from ledgerweave.functions.text import strip

# Fixed values of the event-line protocol.
EVENT_PREFIX = "data: "
STOP_LINE = "[DONE]"


def _runs(chunks: DataFrame, event: Column, keep_stop: bool) -> DataFrame:
    """Joined text per request and run of sequence numbers, and whether it stops there.

    ``event`` has a token ``t`` and a stop flag ``s``.  Lines with neither are
    left out by the aggregate: a filter would parse every line a second time.
    """
    rows = chunks.select("request_id", "seq", event.alias("e"))
    item = F.expr("CASE WHEN e.t <> '' THEN struct(seq, e.t AS t) END")
    runs = rows.groupBy("request_id", segment_of(F.col("seq")).alias("segment")).agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.min(F.expr("CASE WHEN e.s THEN seq END")).alias("stop"))
    last = F.coalesce(F.col("stop"), F.lit(2**63 - 1))
    kept = F.filter("items", lambda i: i["seq"] <= last if keep_stop else i["seq"] < last)
    return runs.select("request_id", "segment", F.array_join(kept["t"], "").alias("text"),
                       F.col("stop").isNotNull().alias("stops"))


def _join_runs(runs: DataFrame) -> DataFrame:
    whole = runs.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.struct("segment", "text"))).alias("runs"),
        F.min(F.when(F.col("stops"), F.col("segment"))).alias("stop"))
    last = F.coalesce(F.col("stop"), F.lit(2**63 - 1))
    kept = F.filter("runs", lambda r: r["segment"] <= last)
    return whole.select("request_id", F.array_join(kept["text"], "").alias("text"))


def _may_hold(text: Column, key: str) -> Column:
    """False for text that cannot be JSON with this key, so that it need not be parsed."""
    return F.contains(text, F.lit(key)) | F.contains(text, F.lit("\\u"))


def event_token(raw_line: Column) -> Column:
    """Token ``t`` and stop flag ``s`` of an event line; other lines have neither."""
    record = "struct<choices:array<struct<delta:struct<content:string>>>>"

    def read(line: Column) -> Column:
        data = F.substring(line, F.lit(len(EVENT_PREFIX) + 1), F.lit(2**31 - 1))
        token = F.get(strict_record(data, record)["choices"], F.lit(0))["delta"]["content"]
        return F.when(line.startswith(EVENT_PREFIX), F.struct(
            F.when(_may_hold(data, "content"), token).alias("t"),
            (line == EVENT_PREFIX + STOP_LINE).alias("s")))
    return F.transform(F.array(strip(raw_line)), read)[0]


def object_token(raw_line: Column) -> Column:
    """Token ``t`` and done flag ``s`` of a line holding one JSON object."""
    record = strict_record(raw_line, "struct<message:struct<content:string>,done:string>")
    return F.transform(F.array(record), lambda r: F.struct(
        r["message"]["content"].alias("t"),
        (~F.coalesce(r["done"], F.lit("false")).isin("false", "0", "0.0", "", "[]", "{}"))
        .alias("s")))[0]


def reassemble_events(chunks: DataFrame) -> DataFrame:
    """Text of each request logged as event lines, up to its stop line."""
    return _join_runs(_runs(chunks, event_token(F.col("raw_line")), keep_stop=False))


def reassemble_objects(chunks: DataFrame) -> DataFrame:
    """Text of each request logged as object lines; the last line's token counts."""
    return _join_runs(_runs(chunks, object_token(F.col("raw_line")), keep_stop=True))


def first_with_tokens(first: DataFrame, second: DataFrame) -> DataFrame:
    """The first source's text where it gave any token, else the second's."""
    a, b = first.alias("a"), second.alias("b")
    text = F.coalesce(F.nullif(F.col("a.text"), F.lit("")), F.col("b.text"), F.lit(""))
    return (a.join(b, F.col("a.request_id") == F.col("b.request_id"), "full_outer")
            .select(F.coalesce("a.request_id", "b.request_id").alias("request_id"),
                    text.alias("text")))
