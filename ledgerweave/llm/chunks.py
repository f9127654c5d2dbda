"""Passages that documents share, found by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is larger than
at all ``REACH`` bytes before and not smaller than at those behind.  The rule looks at
its neighbourhood only, so an insertion moves chunk ends nowhere else.  Chunks longer
than ``LONGEST`` bytes are cut at multiples of it from their start.  Chunks count as
equal when digest (64 bits) and length agree; the document with the smallest id keeps
a chunk, later documents repeat it.  Runs of repeated chunks of at least ``min_words``
words in all are reported, so that stray short repeats leave a document alone.

Repeats within one document are no repeats across documents and stay.  Null and empty
texts have no chunks; rows with a null id repeat nothing and are repeated by nothing.
Rows that share an id count as one document, each text with its own runs.  A text is read
to its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerweave.llm import words
from ledgerweave.sources.shared import write_through

WINDOW = 32
REACH = 14
LONGEST = 256
MIN_WORDS = 20

_GEAR = words.mix(np.arange(1000, 1256, dtype=np.uint64)).astype(np.uint32)
CHUNK = ("doc_id long, text_key long, seq int, start long, n_bytes int, n_words int, "
         "digest long")


def gear_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes with WINDOW spare places before each text, and the place of each byte."""
    text = np.repeat(np.arange(1, len(at)), np.diff(at))
    place = np.arange(len(data)) + text * WINDOW
    g = np.zeros(len(data) + len(at) * WINDOW, dtype=np.uint32)
    g[place] = _GEAR[data]
    for s in (1, 2, 4, 8, 16):
        g[s:] += g[:-s] << np.uint32(s)
    real = np.zeros(len(g), dtype=bool)
    real[place] = True
    g[~real] = 0
    return g, place


def _most(g: np.ndarray, n: int) -> np.ndarray:
    """The largest of the n values from each place on."""
    out, have = g, 1
    while have < n:
        more = min(have, n - have)
        out = np.maximum(out, np.append(out[more:], np.zeros(more, g.dtype)))
        have += more
    return out


def chunk_ends(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The end of every chunk of a block, ascending; each text ends one."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    g, place = gear_hashes(data, at)
    span = _most(g, REACH)
    before = np.append(np.zeros(REACH, g.dtype), span[:-REACH])
    behind = np.append(span[1:], np.zeros(1, g.dtype))
    cut = (g > before) & (g >= behind)
    ends = np.unique(np.concatenate((np.flatnonzero(cut[place]) + 1, at[1:][np.diff(at) > 0])))
    starts = np.append(0, ends[:-1])
    more = (ends - starts - 1) // LONGEST
    if not more.any():
        return ends
    row = np.repeat(np.arange(len(ends)), more)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(more) - more, more) + 1
    return np.unique(np.concatenate((ends, starts[row] + nth * LONGEST)))


def chunks(docs: DataFrame) -> DataFrame:
    """One row of CHUNK per chunk of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in words.blocks(batches, "text"):
            ends = chunk_ends(data, at)
            starts = np.append(0, ends[:-1])[:len(ends)]
            row = np.searchsorted(at, starts, "right") - 1
            first = np.searchsorted(starts, at[:-1])
            word, _ = words.spans(~words.BLANK[data], at)
            n_words = np.searchsorted(word, ends) - np.searchsorted(word, starts)
            digest = words.run_hashes(data, starts, ends).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)),
                 part.column("text_key").take(pa.array(row)),
                 pa.array((np.arange(len(ends)) - first[row]).astype(np.int32)),
                 pa.array(starts - at[row]), pa.array((ends - starts).astype(np.int32)),
                 pa.array(n_words.astype(np.int32)), pa.array(digest)],
                ["doc_id", "text_key", "seq", "start", "n_bytes", "n_words", "digest"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_key"), "text")
    return rows.where("doc_id is not null and text != ''").mapInArrow(run, CHUNK)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, start, n_bytes, n_words, first_doc_id): one row per repeated run.

    ``start`` counts bytes from 0; ``first_doc_id`` is the smallest id with a chunk of the run.
    """
    table = write_through(chunks(docs))
    shared = (table.groupBy("digest", "n_bytes")
              .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .where("first < last").select("digest", "n_bytes", "first"))
    found = table.join(shared, ["digest", "n_bytes"]).where("doc_id > first")
    order = Window.partitionBy("doc_id", "text_key").orderBy("seq")
    return (found.withColumn("run", F.col("seq") - F.dense_rank().over(order))
            .dropDuplicates(["doc_id", "text_key", "seq"])
            .groupBy("doc_id", "text_key", "run")
            .agg(F.min("start").alias("start"), F.sum("n_bytes").alias("n_bytes"),
                 F.sum("n_words").alias("n_words"), F.min("first").alias("first_doc_id"))
            .where(F.col("n_words") >= min_words).drop("run"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated runs cut out of ``text``; other columns stay as they are."""
    runs = (repeats(docs, min_words).groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_list(F.struct("start", "n_bytes"))).alias("_runs"))
            .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_runs"))

    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, runs in zip(text.to_pylist(), spans.to_pylist()):
            if t is not None and runs:
                raw, at, kept = t.encode(), 0, []
                for r in runs:
                    kept.append(raw[at:r["start"]])
                    at = r["start"] + r["n_bytes"]
                t = b"".join([*kept, raw[at:]]).decode(errors="ignore")
            out.append(t)
        return pa.array(out, pa.string())
    joined = docs.join(write_through(runs), (F.col("doc_id") == F.col("_id"))
                       & (F.xxhash64("text") == F.col("_key")), "left")
    return joined.withColumn("text", F.arrow_udf(cut, "string")("text", "_runs")).select(docs.columns)


def op5_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage that an earlier document has as well."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeats(docs).select("doc_id", "start", "n_bytes", "n_words", "first_doc_id")
