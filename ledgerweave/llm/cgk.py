"""Benchmark decontamination: texts that hold a passage within a small edit distance of an item.

Distance is counted in words (runs of letters and digits, A-Z lower-cased), up to
``1 - similarity`` of the item's words.  The CGK embedding walks along a word sequence:
at each step it writes the current word and moves on or stays, as a random bit of step
and word says.  Sequences with few edits agree in most steps, so the words written at
a few sampled steps are an LSH key.  ``repetitions`` follow from the recall wanted per
window; a passage has several windows that match, and every hit is verified by the
exact edit distance.  Windows of an item's size start at every word of a text.  Their keys
are looked up in tables of the items' keys, one a repetition; only what shares a key there
is a candidate.  A window is not walked if it holds fewer words of every item of its size
than a match must have, which loses nothing.  ``audit`` measures the recall of the keys
against a search without them.

Benchmark items are read in parts of at most ``PART_BYTES`` (one scan of the texts
each), so what a task holds does not grow with the benchmark.  Items of fewer than
``min_words`` words identify nothing and match nothing; null items and null or empty
texts match nothing; repeated rows are judged alike.  A text of any length is read to
its end.  All columns of the documents are kept; names cannot clash because findings
come in one column named by the caller.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerweave.llm import words
from ledgerweave.llm.memory import handing_back_each

SIMILARITY = 0.8
RECALL = 0.99
SAMPLES = 2
MIN_WORDS = 5
PART_BYTES = 32 << 20

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[48:58] = _TOKEN[97:123] = _TOKEN[128:] = True
_FILTER_BITS = 20
RARE = 8


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of letter and digit runs, and per text the offset of its first (n + 1)."""
    low = words.LOWER[data]
    starts, ends = words.spans(_TOKEN[low], at)
    return words.run_hashes(low, starts, ends), np.searchsorted(starts, at)


def embedded(hashes: np.ndarray, start: np.ndarray, steps: np.ndarray, turn: int) -> np.ndarray:
    """LSH keys: the words that the walks from ``start`` write at their ``steps`` (rows)."""
    at, key = start.copy(), np.zeros(len(start), dtype=np.uint64)
    last = len(hashes) - 1
    for t in range(int(steps.max(initial=-1)) + 1):
        for row in steps:
            now = row == t
            key[now] = words.mix(key[now] * np.uint64(0x9E3779B97F4A7C15) + hashes[at[now]])
        move = (hashes[at] >> np.uint64((t + 11 * turn) % 64)) & np.uint64(1)
        at = np.minimum(at + move.astype(np.int64), last)
    return key


def distances(pattern: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The least edit distance of the pattern to any stretch of each row of ``texts``."""
    n = len(pattern)
    step = np.arange(n + 1)
    row = np.broadcast_to(step, (len(texts), n + 1)).copy()
    best = row[:, -1].copy()
    for j in range(texts.shape[1]):
        new = row + 1
        new[:, 0] = 0
        np.minimum(new[:, 1:], row[:, :-1] + (texts[:, j:j + 1] != pattern), out=new[:, 1:])
        row = np.minimum.accumulate(new - step, axis=1) + step
        np.minimum(best, row[:, -1], out=best)
    return best


def _sized_keys(hashes: np.ndarray, start: np.ndarray, sizes: np.ndarray, part: np.ndarray,
                turn: int) -> np.ndarray:
    """Keys of the windows at ``start``, sampled at these parts of their walks; sizes apart."""
    steps = (part[:, None] * 1.6 * sizes).astype(np.int64)
    return words.mix(embedded(hashes, start, steps, turn) + sizes.astype(np.uint64))


class Index:
    """The words of benchmark items and the keys of their embeddings."""

    def __init__(self, ids: list, texts: list[str], similarity: float = SIMILARITY,
                 recall: float = RECALL, min_words: int = MIN_WORDS):
        hashes, of = tokens(*words.text_array(pa.array(texts, pa.string())))
        whole = [hashes[of[i]:of[i + 1]] for i in range(len(of) - 1)]
        kept = [i for i, w in enumerate(whole) if len(w) >= max(1, min_words)]
        self.ids, self.items = [ids[i] for i in kept], [whole[i] for i in kept]
        sizes = np.array([len(w) for w in self.items], dtype=np.int64)
        self.sizes = sizes
        self.edits = np.floor(sizes * (1 - similarity) + 1e-9).astype(np.int64)
        self.reach = sizes + self.edits
        self._post()
        # an edit puts the walks out of step for about three steps until they meet again
        agree = max(0.2, 3 * similarity - 2) ** SAMPLES
        turns = max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))
        draw = np.random.default_rng(1)
        flat = np.concatenate([*self.items, np.zeros(1, np.uint64)])
        start = np.cumsum(sizes) - sizes
        self.turns = []
        for turn in range(turns):
            part = np.sort((np.arange(SAMPLES) + draw.random(SAMPLES)) / SAMPLES)
            keys = _sized_keys(flat, start, sizes, part, turn)
            order = np.argsort(keys, kind="stable")
            self.turns.append((part, keys[order], order))

    def _post(self) -> None:
        """Which items have a word, by vocabulary; rare words only where they are enough."""
        distinct = [np.unique(w) for w in self.items]
        self.vocabulary, times = np.unique(np.concatenate([*distinct, np.zeros(0, np.uint64)]),
                                           return_counts=True)
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.vocabulary & np.uint64((1 << _FILTER_BITS) - 1)] = True
        need, pairs = [], []
        for i, (w, d) in enumerate(zip(self.items, distinct)):
            place = np.searchsorted(self.vocabulary, d)
            rare = times[place] <= RARE
            enough = int(rare[np.searchsorted(d, w)].sum()) - self.edits[i]
            if enough >= max(3, 0.25 * len(w)):
                place = place[rare]
            else:
                enough = len(w) - self.edits[i]
            need.append(enough)
            pairs.append(np.stack([place, np.full(len(place), i)]))
        place, item = np.concatenate([*pairs, np.zeros((2, 0), np.int64)], axis=1)
        order = np.argsort(place, kind="stable")
        self.need, self.post_item = np.array(need, dtype=np.int64), item[order]
        self.post_at = np.searchsorted(place[order], np.arange(len(self.vocabulary) + 1))

    def windows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, start) of each window with as many words of the item as any match has."""
        at = np.flatnonzero(self.filter[hashes & np.uint64((1 << _FILTER_BITS) - 1)])
        place = np.searchsorted(self.vocabulary, hashes[at]).clip(max=len(self.vocabulary) - 1)
        same = self.vocabulary[place] == hashes[at]
        at, place = at[same], place[same]
        times = self.post_at[place + 1] - self.post_at[place]
        row = np.repeat(np.arange(len(at)), times)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        hit = np.sort((self.post_item[self.post_at[place[row]] + nth] << 32) | at[row])
        item, first = hit >> 32, np.arange(len(hit))
        last = first + self.need[item] - 1
        full = last < len(hit)
        first, last, item = first[full], last[full], item[full]
        near = (hit[last] >> 32 == item) & (hit[last] - hit[first] < self.reach[item])
        first, last, item = hit[first[near]] & 0xFFFFFFFF, hit[last[near]] & 0xFFFFFFFF, item[near]
        low = np.maximum(last - self.reach[item] + 1, 0)
        many = first - low + 1
        start = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found = np.unique((np.repeat(item, many) << 32) | start)
        return found >> 32, found & 0xFFFFFFFF

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, slot) of the items whose key a window has; a slot is as wide as the edits."""
        item, start = self.windows(hashes)
        window = np.unique((self.sizes[item] << 32) | start)
        size, start = window >> 32, window & 0xFFFFFFFF
        found = [np.zeros((2, 0), np.int64)]
        for turn, (part, keys, order) in enumerate(self.turns if len(start) else []):
            key = _sized_keys(hashes, start, size, part, turn)
            low = np.searchsorted(keys, key, "left")
            many = np.searchsorted(keys, key, "right") - low
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item = order[np.repeat(low, many) + nth]
            found.append(self._slots(item, np.repeat(start, many)))
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))

    def _slots(self, item: np.ndarray, start: np.ndarray) -> np.ndarray:
        return np.unique(np.stack([item, start // np.maximum(1, self.edits[item])]), axis=1)

    def leaks(self, hashes: np.ndarray, of: np.ndarray,
              by_keys: bool = True) -> list[list[tuple[int, int, int]]]:
        """Per text of a block, (item, edits, first word) of each item found."""
        found: list[dict[int, tuple[int, int]]] = [{} for _ in range(len(of) - 1)]
        if len(hashes) and self.items:
            item, slot = self.candidates(hashes) if by_keys else self._slots(*self.windows(hashes))
            for i in np.unique(item):
                self._verify(int(i), slot[item == i], hashes, of, found)
        return [[(i, d, s) for i, (d, s) in sorted(x.items())] for x in found]

    def _verify(self, i: int, slots: np.ndarray, hashes: np.ndarray, of: np.ndarray,
                found: list[dict[int, tuple[int, int]]]) -> None:
        item, edits = self.items[i], int(self.edits[i])
        slot = max(1, edits)
        text = np.searchsorted(of, slots * slot, "right") - 1
        # the first word of a slot may belong to the text before; look at both
        slots, text = np.concatenate([slots, slots]), np.concatenate(
            [text, np.minimum(np.searchsorted(of, slots * slot + slot - 1, "right") - 1,
                              len(of) - 2)])
        first = np.maximum(slots * slot - edits, of[text])
        width = len(item) + 3 * edits + 2
        last = np.minimum(first + width, of[text + 1])
        at = first[:, None] + np.arange(width)
        inside = at < last[:, None]
        window = np.where(inside, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
        common = (np.isin(window, item) & inside).sum(axis=1) >= len(item) - edits
        for a in range(0, int(common.sum()), 2048):
            some = np.flatnonzero(common)[a:a + 2048]
            for k, d in zip(some, distances(item, window[some])):
                if d <= edits:
                    t, got = int(text[k]), (int(d), int(first[k] - of[text[k]]))
                    found[t][i] = min(found[t].get(i, got), got)


LEAK = "array<struct<item_id: long, item_words: long, edits: long, near_word: long>>"


def leaks(text: str | Column, benchmark: DataFrame, similarity: float = SIMILARITY,
          recall: float = RECALL, min_words: int = MIN_WORDS, by_keys: bool = True) -> Column:
    """A column with the items found in a text; empty where there are none.

    ``by_keys=False`` verifies every window that is not dropped, as ``audit`` does.
    """
    text = F.col(text) if isinstance(text, str) else text
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text") \
        .where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / PART_BYTES))
    found = []
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()
        index = Index([r[0] for r in rows], [r[1] for r in rows], similarity, recall, min_words)
        found.append(_finder(spark.sparkContext.broadcast(index), by_keys)(text))
    return F.concat(*found)


def _finder(shared, by_keys):
    def find(text: pa.Array) -> pa.Array:
        index, out = shared.value, []
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        for _, data, at in words.blocks(iter([batch]), "text"):
            for got in index.leaks(*tokens(data, at), by_keys):
                out.append([{"item_id": index.ids[i], "item_words": len(index.items[i]),
                             "edits": d, "near_word": s} for i, d, s in got])
        return pa.array(out, pa.list_(pa.struct([
            ("item_id", pa.int64()), ("item_words", pa.int64()), ("edits", pa.int64()),
            ("near_word", pa.int64())])))
    return F.arrow_udf(handing_back_each(find), LEAK)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    return docs.where(F.size(leaks("text", benchmark, **options)) == 0)


def audit(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row: pairs of text and item within the distance, and how many the keys find."""
    both = docs.select(leaks("text", benchmark, **options).alias("keyed"),
                       leaks("text", benchmark, by_keys=False, **options).alias("whole"))
    return (both.agg(F.coalesce(F.sum(F.size("whole")), F.lit(0)).alias("pairs"),
                     F.coalesce(F.sum(F.size(F.array_intersect("keyed.item_id", "whole.item_id"))),
                                F.lit(0)).alias("found"))
            .withColumn("recall", F.when(F.col("pairs") > 0, F.col("found") / F.col("pairs"))))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item found in it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return (docs.select("doc_id", F.explode(leaks("text", benchmark)).alias("leak"))
            .select("doc_id", "leak.*"))
