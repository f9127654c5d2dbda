"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

A sketch has 128 registers.  A shingle's hash picks a register by its first 7 bits;
the register keeps, of the smallest rest, the number of leading zeros (6 bits) and
the 10 bits behind the first one (mantissa).  Documents with equal sets form a class
first; one representative of each class goes on.  Bands of registers are bucket keys;
an empty register takes the value of another one chosen by a fixed rule, so short
texts have full bands.  The number of registers in a band is the largest for which a
pair exactly at the threshold is missed with a probability below one in a million.

Within a bucket all representatives are compared with the smallest one; these candidates
pass the collision-corrected estimate of the Jaccard similarity (at 4.5 standard
deviations) and are then confirmed on the full sets of both whole texts.  Those that met
the same smallest one but are still in different components are compared with each other
in tiles of bounded size, so no candidate is left out, and a group of any number of near
copies never becomes rows for all its pairs.

Texts without words, null texts and rows with a null id link with nothing.  Rows that
share an id count as one document, which has the links of all its texts.  Input
columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerweave.llm import words
from ledgerweave.llm.components import components
from ledgerweave.llm.memory import handing_back, handing_back_each
from ledgerweave.sources.shared import write_through

BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
MISSED = 1e-6
DEVIATIONS = 4.5
BLOCK = 256
TILE_BYTES = 4 << 20
SALTS = 16

_U = np.uint64
SKETCH = "doc_id long, n long, d1 long, d2 long, registers binary"


def band_rows(similarity: float) -> int:
    """Registers per band: the most that keep the chance of a miss below MISSED."""
    for rows in range(8, 1, -1):
        if (1 - similarity ** rows) ** (REGISTERS // rows) < MISSED:
            return rows
    return 1


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, REGISTERS) registers of sorted shingle sets; 0 is an empty one."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    if not len(flat):
        return out
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = row * REGISTERS + (flat >> _U(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))     # sorted, so the first is the smallest
    rest = flat[first] << _U(BUCKET_BITS)
    zeros = 53 - np.frexp((rest >> _U(11)).astype(np.float64))[1]
    shift = np.minimum(zeros + 1, 63).astype(np.uint64)
    mantissa = (rest << shift) >> _U(64 - MANTISSA)
    out.reshape(-1)[place[first]] = ((zeros + 1) << MANTISSA) | mantissa.astype(np.int64)
    return out


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers in which an empty one repeats another, found by a fixed order of places."""
    out, todo = regs.copy(), np.flatnonzero(((regs == 0).any(axis=1)) & (regs.any(axis=1)))
    place, turn = np.arange(REGISTERS, dtype=np.uint64), 0
    while len(todo):
        turn += 1
        other = words.mix(place * _U(0x9E3779B97F4A7C15) + _U(turn)) >> _U(64 - BUCKET_BITS)
        mine = out[todo]
        out[todo] = np.where(mine == 0, regs[todo][:, other.astype(np.int64)], mine)
        todo = todo[(out[todo] == 0).any(axis=1)]
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity of register rows, corrected for chance matches, and its deviation."""
    used = ((a > 0) | (b > 0)).sum(axis=1).clip(1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    k = np.arange(40)[:, None]

    def chances(n: np.ndarray) -> np.ndarray:
        load = n / REGISTERS
        return np.exp(-load * 0.5 ** (k + 1)) - np.exp(-load * 0.5 ** k)
    chance = (chances(na) * chances(nb)).sum(axis=0) / (1 << MANTISSA)
    return (same / used - chance) / (1 - chance), used


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """One row of SKETCH per row of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in words.blocks(batches, "text"):
            hashes, of = words.words(data, at)
            sets = [words.shingles(hashes[of[i]:of[i + 1]], size) for i in range(len(of) - 1)]
            digests = np.array([[s.sum(dtype=np.uint64), words.mix(s ^ _U(size)).sum(
                dtype=np.uint64)] for s in sets], dtype=np.uint64).reshape(-1, 2).view(np.int64)
            regs = registers(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()),
                 pa.array([r.tobytes() for r in regs], pa.binary())],
                ["doc_id", "n", "d1", "d2", "registers"])
    return docs.mapInArrow(lambda b: handing_back(run(b)), SKETCH)


def band_keys(reps: DataFrame, rows: int) -> DataFrame:
    """(key, rep, n) for every band of every representative."""
    bands = REGISTERS // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = filled(_matrix(batch.column("registers")))[:, :bands * rows]
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(regs), bands))
            for j in range(rows):
                key = words.mix(key * _U(0x9E3779B97F4A7C15)
                                + regs[:, j::rows].astype(np.uint64) + _U(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)),
                 batch.column("rep").take(pa.array(np.repeat(np.arange(len(regs)), bands))),
                 batch.column("n").take(pa.array(np.repeat(np.arange(len(regs)), bands)))],
                ["key", "rep", "n"])
    return reps.mapInArrow(lambda b: handing_back(run(b)), "key long, rep long, n long")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16)
    return flat.reshape(-1, REGISTERS)


def _sets(text: pa.Array, size: int) -> Iterator[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    for _, data, at in words.blocks(iter([batch]), "text"):
        hashes, of = words.words(data, at)
        for i in range(len(of) - 1):
            yield words.shingles(hashes[of[i]:of[i + 1]], size)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of (doc_id, text).

    Links join documents with 100 * intersection >= percent * union of their sets of
    ``size``-word shingles.  ``component_id`` is the smallest id reachable.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = write_through(sketches(docs, size))
    found = sketch.where("n > 0 and doc_id is not null")
    # a set of one document is its own class; a set of very many is spread over salts
    classes = (found.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"),
                                                  F.max("doc_id").alias("last"))
               .where("rep < last").drop("last"))
    classed = (_salted(sketch, "doc_id").join(_all_salts(classes), ["n", "d1", "d2", "salt"], "left")
               .withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))))
    member = write_through(classed.select("doc_id", "n", "rep"))
    reps = write_through(classed.where("n > 0 and rep = doc_id").select("rep", "n", "registers"))
    keys = write_through(band_keys(reps, band_rows(percent / 100)))
    shared = keys.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
    buckets = write_through(keys.join(shared.where("first < last"), "key")
                            .select("key", "rep", "n", "first").distinct())
    texts = write_through(docs.join(buckets.select(F.col("rep").alias("doc_id")).distinct(),
                                    "doc_id", "left_semi"))

    tested = write_through(_pairs(buckets.where("rep != first"), "first", "rep"))
    links = write_through(_confirmed(tested, reps, texts, size, percent))
    parts = components(links)
    links = links.union(_within_groups(tested_groups(buckets), parts, texts, size, percent))
    parts = components(links)
    return (member.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _salted(rows: DataFrame, by: str) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))


def _all_salts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                        F.lit(SALTS - 1).cast("long"))))


def tested_groups(buckets: DataFrame) -> DataFrame:
    """(first, rep): who was compared with which smallest member of a bucket."""
    return buckets.where("rep != first").select("first", "rep").distinct()


def _within_groups(groups: DataFrame, parts: DataFrame, texts: DataFrame, size: int,
                   percent: int) -> DataFrame:
    """Links among those compared with the same first one but not yet in one component.

    A group is cut into blocks of about BLOCK members or TILE_BYTES of text, whichever is
    less, and each pair of blocks is a tile of its own, so a task holds two blocks at most.  A tile counts all intersections in a
    matrix product and returns a star for each of its components, not its pairs.
    """
    state = write_through(groups.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
                          .select("first", "rep", F.coalesce("component", "rep").alias("part")))
    open_ = (state.groupBy("first").agg(F.count("*").alias("members"), F.min("part").alias("x"),
                                        F.max("part").alias("y")).where("x < y"))
    state = write_through(_salted(state, "rep").join(_all_salts(open_.select("first", "members")),
                                                     ["first", "salt"]).drop("salt"))
    width = (state.select("first", "rep", "members").join(
        texts.select(F.col("doc_id").alias("rep"), F.octet_length("text").alias("bytes")), "rep")
        .groupBy("first").agg(F.max("members").alias("members"), F.sum("bytes").alias("bytes")))
    cut = width.select("first", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(
        F.col("bytes") / TILE_BYTES)).alias("blocks"))
    mine = F.pmod(F.xxhash64("rep"), "blocks")
    tiles = (_salted(state, "rep").join(_all_salts(cut), ["first", "salt"]).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("blocks - 1"))))
             .select("first", F.least("mine", "other").alias("i"),
                     F.greatest("mine", "other").alias("j"), "rep"))
    rows = write_through(tiles.join(texts.withColumnRenamed("doc_id", "rep"), "rep"))

    def link(table: pa.Table) -> pa.Table:
        rep = table.column("rep").to_numpy()
        sets = list(_sets(table.column("text").combine_chunks(), size))
        root = _joined(_intersections(sets), np.array([len(s) for s in sets]), percent, rep)
        far = root != rep
        return pa.table({"a": root[far], "b": rep[far]})
    linked = handing_back_each(link)
    return write_through(rows.groupBy("first", "i", "j").applyInArrow(
        lambda table: linked(table), "a long, b long"))


def _intersections(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections; elements of one set only are left out."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    new = np.cumsum(times > 1) - 1
    again = times[column] > 1
    row, column = row[again], new[column[again]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, last, width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out


def _joined(both: np.ndarray, n: np.ndarray, percent: int, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each member reaches over links."""
    linked = (both > 0) & (100 * both >= percent * (n[:, None] + n[None, :] - both))
    np.fill_diagonal(linked, True)
    root = ids.copy()
    while True:
        least = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (least == root).all():
            return root
        root = least


def _pairs(rows: DataFrame, one: str, other: str) -> DataFrame:
    return rows.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int
               ) -> DataFrame:
    """The pairs whose sets are similar enough: by estimate first, then on the whole texts."""
    least = percent / 100

    def likely(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        got, used = estimate(_matrix(a), _matrix(b), na.to_numpy(), nb.to_numpy())
        slack = DEVIATIONS * np.sqrt(least * (1 - least) / used) + 1 / used
        return pa.array(got >= least - slack)

    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(_sets(a, size), _sets(b, size)):
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    def side(x: str) -> DataFrame:
        return reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"),
                           F.col("registers").alias(f"r_{x}"))

    def text(x: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t_{x}"))
    alike = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    close = F.arrow_udf(handing_back_each(likely), "boolean")("r_a", "r_b", "n_a", "n_b")
    picked = write_through(pairs.join(side("a"), "a").join(side("b"), "b").where(alike)
                           .where(close).select("a", "b").distinct())
    same = F.arrow_udf(handing_back_each(similar), "boolean")("t_a", "t_b")
    return picked.join(text("a"), "a").join(text("b"), "b").where(same).select("a", "b").distinct()


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, size=3, percent=85)
