"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Two words at most one edit apart have equal or adjacent lengths and letter counts whose squared
distance is at most two.  Words of a length and of the next one meet in blocks: at the
shorter length L, either the first or the last L // 2 letters of both are the same, because
one edit cannot touch both halves.  In a block the squared distances of all letter counts
come from one matrix product; pairs at two or less are verified letter by letter.  A pair
whose first halves agree counts in that block only, so none counts twice, and a
block returns counts and the best partner per word, not its pairs.  Blocks of more than
``BLOCK`` words are cut by a hash into parts, and every two parts meet in a task of their own.

``corpus_words`` turns documents into words: maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in
lower case, one letter deleted where a hash of document and run says so, counted.  Null and
empty texts have no words; a null id counts as empty text; repeated rows count each
time; texts and runs of any length are read to their end.  Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerweave.sources.shared import write_through

LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_ONE_IN = 31
RATIO = 10
BLOCK = 1024
BLOCK_BYTES = 4 << 20


def corpus_words(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``length`` letters that occur ``count`` times."""
    run = rf"[A-Za-zÀ-ÿ]{{{length},}}+"
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"),
                       F.explode(F.regexp_extract_all("text", F.lit(run), F.lit(0))).alias("w"))
    low = F.when(F.lower("w") == F.col("w"), F.col("w")).otherwise(
        F.translate("w", string.ascii_uppercase, string.ascii_lowercase))
    hashed = runs.select(low.alias("w"), "of").withColumn("h", F.crc32(F.concat("of", F.lit(":"), "w")))
    at = F.expr("int(h % char_length(w))")
    less = F.concat(F.expr("left(w, int(h % char_length(w)))"), F.substring("w", at + 2, F.length("w")))
    word = F.when(F.col("h") % DELETE_ONE_IN == 0, less).otherwise(F.col("w"))
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count))


def blocks(words: DataFrame) -> DataFrame:
    """(size, side, part, word, n): each word under its halves, as shorter and as longer one."""
    halves = []
    for less in (0, 1):
        size = F.char_length("word") - less
        half = F.expr(f"int((char_length(word) - {less}) div 2)")
        halves += [F.struct(size.alias("size"), F.lit(True).alias("front"),
                            F.substring("word", F.lit(1), half).alias("part")),
                   F.struct(size.alias("size"), F.lit(False).alias("front"),
                            F.expr(f"right(word, int((char_length(word) - {less}) div 2))").alias("part"))]
    return words.select("word", "n", F.explode(F.array(*halves)).alias("b")).select("b.*", "word", "n")


def tiles(placed: DataFrame) -> DataFrame:
    """Adds the two parts (i, j) that meet in a tile and the word's own part ``mine``."""
    keys = ["size", "front", "part"]
    most = F.greatest(F.lit(16), F.least(F.lit(BLOCK), F.expr(f"{BLOCK_BYTES} div (size + 1)")))
    large = (placed.groupBy(*keys).agg(F.count("*").alias("members"))
             .withColumn("parts", F.ceil(F.col("members") / most)).where("parts > 1")
             .select(*keys, "parts"))
    rows = placed.join(large, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("word"), "parts").cast("int")
    rows = rows.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)))
    return rows.select(*keys, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                       "mine", "word", "n")


_NEAR = "word string, n_near long, best struct<less: long, form: string>"


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the one of largest n."""
    keys = ["size", "front", "part", "i", "j"]
    placed = write_through(blocks(words))
    laid = (tiles(placed).repartition(*keys)
            .sortWithinPartitions(*keys, "mine", F.char_length("word"), "word"))
    found = laid.mapInArrow(_meet, _NEAR)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        ends = np.append(_changes(table), table.num_rows)
        yield from _tables(table, ends[:-1])
        rest = table.slice(ends[-2])
    if rest is not None and rest.num_rows:
        yield from _tables(rest, np.array([0, rest.num_rows]))


def _changes(table: pa.Table) -> np.ndarray:
    """Where a tile starts."""
    new = np.zeros(table.num_rows, dtype=bool)
    for name in ("size", "front", "part", "i", "j"):
        values = table.column(name).combine_chunks()
        codes = (values.dictionary_encode().indices if name in ("part", "front") else values
                 ).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    new[:1] = True
    return np.flatnonzero(new)


def _tables(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The near words of the tiles between the edges."""
    made: list[list] = [[], [], [], []]
    lone = np.diff(edges) < 2
    if len(edges) > 1 and not lone.all():
        words = table.column("word").to_pylist()
        n, mine = table.column("n").to_numpy(), table.column("mine").to_numpy()
        size, j = table.column("size").to_numpy(), table.column("j").to_numpy()
        i, front = table.column("i").to_numpy(), table.column("front").to_numpy()
        for a, b in zip(edges[:-1][~lone], edges[1:][~lone]):
            split = a + int(np.searchsorted(mine[a:b], j[a])) if i[a] < j[a] else a
            x, y = ((words[a:split], words[split:b]) if split > a else (words[a:b], None))
            if i[a] < j[a] and split == a:
                continue                 # one of the two parts is empty
            left, right = near_pairs(x, y, int(size[a]), bool(front[a]))
            left, right = left + a, right + (split if y is not None else a)
            _best(words, n, np.concatenate((left, right)), np.concatenate((right, left)), made)
    if made[0]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(made[0], pa.string()), pa.array(made[1], pa.int64()),
             pa.StructArray.from_arrays([pa.array(made[2], pa.int64()), pa.array(made[3], pa.string())],
                                        ["less", "form"])], ["word", "n_near", "best"])


def _best(words: list[str], n: np.ndarray, one: np.ndarray, other: np.ndarray, made: list[list]) -> None:
    """Adds each word's number of partners and its partner of largest n, then smallest text."""
    if not len(one):
        return
    partners: dict[int, list[int]] = {}
    for a, b in zip(one.tolist(), other.tolist()):
        partners.setdefault(a, []).append(b)
    for a, near in partners.items():
        less, form = min((-int(n[b]), words[b]) for b in near)
        for column, value in zip(made, (words[a], len(near), less, form)):
            column.append(value)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row of Latin-1 codes; 0 is no letter."""
    used, place = np.unique(codes, return_inverse=True)
    out = np.zeros((len(codes), len(used)), np.float32)
    row = np.repeat(np.arange(len(codes)), codes.shape[1])
    np.add.at(out, (row, place.reshape(-1)), 1)
    return out[:, used > 0]


def _codes(words: list[str], width: int) -> np.ndarray:
    flat = np.array([w.encode("latin-1") for w in words], dtype=f"S{max(1, width)}")
    return flat.view(np.uint8).reshape(len(words), -1)


def near_pairs(x: list[str], y: list[str] | None, size: int, front: bool
               ) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and ``y`` (or both in ``x``) of words exactly one edit apart.

    All words have ``size`` letters or one more; of a pair, one has ``size``.  Pairs with
    equal first halves are left to the block in which those meet.
    """
    whole = _codes(x + (y or []), size + 1)
    counts = letter_counts(whole)
    mine, theirs = (counts[:len(x)], counts[len(x):]) if y is not None else (counts, counts)
    square = (counts ** 2).sum(axis=1)
    sides = (square[:len(x)], square[len(x):]) if y is not None else (square, square)
    distance = sides[0][:, None] + sides[1][None, :] - 2 * (mine @ theirs.T)
    if y is None:
        distance[np.tril_indices(len(x))] = 9
    a, b = np.nonzero(distance <= 2)
    left, right = whole[a], whole[b + (len(x) if y is not None else 0)]
    long_a, long_b = left[:, -1] > 0, right[:, -1] > 0
    keep = ~(long_a & long_b)
    if not front:
        keep &= (left[:, :size // 2] != right[:, :size // 2]).any(axis=1)
    swap = long_a & ~long_b                  # the shorter one first
    first = np.where(swap[:, None], right, left)[:, :size]
    second = np.where(swap[:, None], left, right)
    same = first == second[:, :size]
    replaced = (~same).sum(axis=1) == 1
    ahead = np.where(same.all(axis=1), size, (~same).argmax(axis=1))
    behind = first == second[:, 1:]
    back = np.where(behind.all(axis=1), size, (~behind[:, ::-1]).argmax(axis=1))
    keep &= np.where(long_a | long_b, ahead + back >= size, replaced)
    return a[keep], b[keep]


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following forms ends.  Forms grow in n, so they do."""
    hops = write_through(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = write_through(hops.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if hops.where("moved").isEmpty():
            return hops.select("word", "root")
        hops = hops.select("word", "root")


def spelling_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents.

    ``form`` is the near word of largest n (of equal ones the smallest by code points) if
    that is at least ``ratio`` times the word's; ``root`` follows forms to the last.
    """
    words = write_through(corpus_words(docs.select("doc_id", "text")))
    near = near_words(words)
    likely = -F.col("best.less") >= ratio * F.col("n")
    found = write_through(words.join(near, "word", "left").select(
        "word", F.when(likely, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(likely, -F.col("best.less")).alias("form_n")))
    ends = roots(found.where("form is not null"))
    return (found.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
