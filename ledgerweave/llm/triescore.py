"""Log probabilities of whole texts under a bigram model kept as an Elias-Fano trie.

Level 0 is the vocabulary: sorted word hashes with counts; a word's rank is its id.
Level 1 has, for each context, a pointer to its successors (monotone, Elias-Fano), the
successors as one monotone sequence of context * size + word (Elias-Fano), one quantised
probability per successor, and the weight that the context leaves to the level below.
A lookup goes to the context's range by its pointers and searches the successor there.
Levels lie as files in the shared folder and are memory-mapped by the tasks (read whole
where the folder is no local mount); shards are ranges of context ids, so their number
follows the tokens and no task, nor the driver, holds a level.

Probability: absolute discounting with three discounts estimated per shard from counts of
counts, interpolated with (c + 1) / (N + V + 1).  A probability is rounded down to a grid of
256 logarithms, and what rounding and discounts leave is the weight of the level below, so
the probabilities of all words after a context sum up to 1.

Tokens are lower-cased (A-Z) words and one end per text.  The first token's context is a
begin mark.  Null and empty texts are one end.  Rows with a null id are never learned from
and are scored.  With nothing to learn from, N = V = 0 and every token has probability 1.
Words are told apart by 64-bit hashes; a vocabulary has fewer than 2**31 words.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerweave.llm import words
from ledgerweave.sources.shared import shared_dir, write_through

BLOCK_BYTES = 2 << 20
GATHERED = 4 << 20          # tokens a task counts before it passes them on
WORDS_PER_FILE = 2 << 20
TOKENS_PER_FILE = 4 << 20
BEGIN, END, FIRST = 0, 1, 2
STEP, LOWEST = 8.0 / 255, -8.0

_U = np.uint64
_SIGN = _U(1 << 63)


# files in the shared folder

def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return None if "://" in uri else uri


def save(uri: str, arrays: list[np.ndarray]) -> None:
    """Writes arrays one after the other; complete or not at all, alike on every attempt."""
    sizes = np.array([len(arrays), *[x for a in arrays for x in (a.dtype.itemsize, a.nbytes)]],
                     dtype="<i8")
    data = [sizes.tobytes()]
    for a in arrays:
        data += [a.tobytes(), b"\0" * (-a.nbytes % 8)]
    if (path := _local(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.writelines(data)
        os.replace(part, path)
        return
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        for d in data:
            f.write(d)
    system.move(part, path)


def load(uri: str) -> list[np.ndarray]:
    """The arrays of a file as unsigned integers of their width, mapped where that is possible."""
    if (path := _local(uri)) is not None:
        raw = np.memmap(path, np.uint8, "r")
    else:
        from pyarrow import fs
        system, path = fs.FileSystem.from_uri(uri)
        with system.open_input_file(path) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    n = int(raw[:8].view("<i8")[0])
    sizes, at, out = raw[8:8 + 16 * n].view("<i8"), 8 + 16 * n, []
    for width, size in sizes.reshape(n, 2):
        out.append(raw[at:at + size].view(f"<u{width}"))
        at += size + (-size % 8)
    return out


# Elias-Fano

class EliasFano:
    """An ascending sequence: low bytes as they are, the rest in unary with select."""

    def __init__(self, meta: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.n, self.width = int(meta[0]), int(meta[1])       # width: low bytes
        self.low, self.high = low.reshape(-1, max(1, self.width))[:self.n], high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate(([0], np.cumsum(ones)))
        self.zeros = np.arange(len(high) + 1) * 64 - self.ones

    @staticmethod
    def pack(values: np.ndarray, top: int) -> list[np.ndarray]:
        """The arrays of an ascending sequence of values below ``top``."""
        n = len(values)
        cost = [8 * w * n + n + (top >> (8 * w)) for w in range(8)]
        width = int(np.argmin(cost))
        values = values.astype(np.uint64)
        low = values.view(np.uint8).reshape(n, 8)[:, :max(1, width)]
        high = np.zeros((n + (top >> (8 * width)) + 1) // 64 + 1, dtype="<u8")
        at = (values >> _U(8 * width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(len(high) * 64, dtype=bool)
        bits[at] = True
        high = np.packbits(bits, bitorder="little").view("<u8")
        return [np.array([n, width], "<u8"), np.ascontiguousarray(low).reshape(-1), high]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.int64)
        for k in range(self.width):
            out |= self.low[at, k].astype(np.int64) << (8 * k)
        return out

    def values(self) -> np.ndarray:
        bits = np.unpackbits(self.high.view(np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[:self.n] - np.arange(self.n)
        return (high << (8 * self.width)) | self._lows(np.arange(self.n))

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """The place of the k-th one (or zero)."""
        word = np.minimum(np.searchsorted(before, k, "right") - 1, len(self.high) - 1)
        rest, bits = k - before[word], self.high[word]
        bits = ~bits if flip else bits
        at = np.zeros(len(k), dtype=np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count((bits >> at.astype(np.uint64)) & _U((1 << half) - 1))
            far = rest >= low
            rest = rest - np.where(far, low, 0)
            at += np.where(far, half, 0)
        return word * 64 + at

    def access(self, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros(0, np.int64)
        high = self._select(at, self.ones, False) - at
        return (high << (8 * self.width)) | self._lows(at)

    def find(self, x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The place of each x within [first, last), or -1."""
        if not len(x) or not self.n:
            return np.full(len(x), -1)
        high, low = x >> (8 * self.width), x & ((1 << (8 * self.width)) - 1)
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, True)
                         - np.maximum(high - 1, 0), 0)
        a = np.maximum(begin, first)
        end = np.minimum(self._select(high, self.zeros, True) - high, last)
        b = end.copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            less = open_ & (self._lows(np.minimum(mid, self.n - 1)) < low)
            a, b = np.where(less, mid + 1, a), np.where(open_ & ~less, mid, b)
        hit = a < end
        hit &= self._lows(np.minimum(a, self.n - 1)) == low
        return np.where(hit, a, -1)


# learning

def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
    return key[first], np.add.reduceat(count[order], first) if len(first) else count


def _signed(hashes: np.ndarray) -> np.ndarray:
    """Hashes as numbers whose order is that of the files."""
    return hashes.view(np.int64)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, times) of the texts, counted in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, n = [], [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(keys, counts)],
                                              ["word", "times"])
        for _, data, at in words.blocks(batches, "text", BLOCK_BYTES):
            hashes, _ = words.words(data, at)
            key, count = np.unique(_signed(hashes), return_counts=True)
            keys.append(key)
            counts.append(count.astype(np.int64))
            n += len(key)
            if n > GATHERED:
                yield rows()
                keys, counts, n = [], [], 0
        if n:
            yield rows()
    return (docs.select("text").mapInArrow(run, "word long, times long")
            .groupBy("word").agg(F.sum("times").alias("times")))


class Vocabulary:
    """Ids and counts of words, from the files of level 0."""

    def __init__(self, path: str, bits: int, base: list[int], ends: int, tokens: int):
        self.path, self.bits, self.base = path, bits, base
        self.ends, self.tokens = ends, tokens
        self.size = base[-1] + (ends > 0)                     # V
        self.files: dict[int, tuple[np.ndarray, np.ndarray]] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"files": None}

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of ascending (signed) distinct words."""
        if self.files is None:
            self.files = {}
        ids, counts = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        shard = (hashes.view(np.uint64) ^ _SIGN) >> _U(64 - self.bits) if self.bits else \
            np.zeros(len(hashes), np.uint64)
        edges = np.searchsorted(shard, np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(edges)):
            if self.base[s + 1] == self.base[s]:
                continue
            if s not in self.files:
                key, count = load(f"{self.path}/words-{s}")
                self.files[s] = (key.view("<i8"), count)
            key, count = self.files[s]
            mine = hashes[edges[s]:edges[s + 1]]
            at = np.minimum(np.searchsorted(key, mine), len(key) - 1)
            hit = key[at] == mine
            ids[edges[s]:edges[s + 1]] = np.where(hit, at + self.base[s] + FIRST, -1)
            counts[edges[s]:edges[s + 1]] = np.where(hit, count[at], 0)
        return ids, counts


def learn_vocabulary(docs: DataFrame, path: str) -> Vocabulary:
    """Writes level 0 of the texts."""
    found = write_through(_word_counts(docs))
    n, tokens = found.agg(F.count("*"), F.coalesce(F.sum("times"), F.lit(0))).first()
    ends = docs.count()
    bits = max(0, (n // WORDS_PER_FILE)).bit_length()
    top = F.expr(f"shiftrightunsigned(word ^ {-(1 << 63)}L, {64 - bits})") if bits else F.lit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in _by_shard(batches):
            key, count = (table.column(c).to_numpy() for c in ("word", "times"))
            save(f"{path}/words-{part}", [key.astype("<i8"), count.astype("<u8")])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()),
                                              pa.array([len(key)], pa.int64())], ["shard", "n"])
    rows = found.withColumn("shard", top.cast("long"))
    sizes = (rows.repartition("shard").sortWithinPartitions("shard", "word")
             .mapInArrow(run, "shard long, n long").collect())      # one row per file
    n_of = dict((r["shard"], r["n"]) for r in sizes)
    base = np.concatenate(([0], np.cumsum([n_of.get(s, 0) for s in range(1 << bits)]))).tolist()
    return Vocabulary(path, bits, base, ends, tokens + ends)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard; shards follow one another and are of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            shard = batch.column("shard").to_numpy()
            if held and held[0].column("shard")[0].as_py() != shard[0]:
                yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)
                held = []
            n = int(np.searchsorted(shard, shard[0], "right"))
            held.append(batch.slice(0, n))
            batch = batch.slice(n)
    if held:
        yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)


def _tokens(data: np.ndarray, at: np.ndarray, vocabulary: Vocabulary
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: context id, id, count; and per text the offset of its first (n + 1)."""
    hashes, of = words.words(data, at)
    distinct, place = np.unique(_signed(hashes), return_inverse=True)
    ids, counts = vocabulary.lookup(distinct)
    n = len(hashes) + len(of) - 1
    start = of + np.arange(len(of))
    word = np.ones(n, dtype=bool)
    word[start[1:] - 1] = False
    token, count = np.full(n, END), np.full(n, vocabulary.ends)
    token[word], count[word] = ids[place], counts[place]
    context = np.concatenate(([BEGIN], token[:-1]))
    context[start[:-1]] = BEGIN
    return context, token, count, start


class Shards:
    """Which file of level 1 has a context, and the numbers that all tasks share."""

    def __init__(self, path: str, vocabulary: Vocabulary, parts: int):
        self.path, self.vocabulary, self.parts = path, vocabulary, parts
        self.size = vocabulary.base[-1] + FIRST               # ids are below it
        self.edge = [-(-self.size * p // parts) for p in range(parts + 1)]


def learn_pairs(docs: DataFrame, shards: Shards) -> DataFrame:
    """Writes level 1 of the texts; one row per file."""
    keys_at = np.array(shards.edge, dtype=np.int64) * shards.size

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            key, count = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(key, keys_at)
            for p in np.flatnonzero(np.diff(edges)):
                a, b = edges[p], edges[p + 1]
                packed = EliasFano.pack(key[a:b] - keys_at[p], int(keys_at[p + 1] - keys_at[p]))
                more = np.flatnonzero(count[a:b] > 1)
                columns = [*packed, more.astype("<u4"), count[a:b][more].astype("<u4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()),
                     *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                    ["shard", "meta", "low", "high", "more", "times"])
        for _, data, at in words.blocks(batches, "text", BLOCK_BYTES):
            context, token, _, _ = _tokens(data, at, shards.vocabulary)
            held.append(context * shards.size + token)
            n += len(token)
            if n > GATHERED:
                yield from rows()
                held, n = [], 0
        if n:
            yield from rows()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in _by_shard(batches):
            keys, counts = [], []
            for row in table.to_pylist():
                key = EliasFano(np.frombuffer(row["meta"], "<u8"), np.frombuffer(
                    row["low"], np.uint8), np.frombuffer(row["high"], "<u8")).values()
                count = np.ones(len(key), dtype=np.int64)
                count[np.frombuffer(row["more"], "<u4")] = np.frombuffer(row["times"], "<u4")
                keys.append(key)
                counts.append(count)
            key, count = _summed(keys, counts)
            save(f"{shards.path}/pairs-{part}",
                 level(key, count, shards.edge[part + 1] - shards.edge[part], shards.size))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()),
                                              pa.array([len(key)], pa.int64())], ["shard", "n"])
    pieces = docs.select("text").mapInArrow(
        gather, "shard long, meta binary, low binary, high binary, more binary, times binary")
    return write_through(pieces.repartition(shards.parts, "shard").sortWithinPartitions("shard")
                         .mapInArrow(build, "shard long, n long"))


def discounts(count: np.ndarray) -> np.ndarray:
    """What counts of 1, 2 and at least 3 lose, estimated from counts of counts."""
    n = [float((count == k).sum()) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y for k in (1, 2, 3)]
    return np.array([min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), out)])


def level(key: np.ndarray, count: np.ndarray, contexts: int, size: int) -> list[np.ndarray]:
    """The arrays of one file: pointers, successors, quantised probabilities, weights below."""
    context = key // size
    pointer = np.searchsorted(context, np.arange(contexts + 1))
    total = np.bincount(context, weights=count, minlength=contexts)
    lost = discounts(count)[np.minimum(count, 3) - 1] if len(count) else np.zeros(0)
    p = np.maximum(count - lost, 1e-9) / total[context]
    code = np.floor((np.log10(p) - LOWEST) / STEP).clip(0, 255).astype(np.uint8)
    kept = np.bincount(context, weights=grid()[code], minlength=contexts)
    return [*EliasFano.pack(pointer, len(key) + 1), *EliasFano.pack(key, contexts * size), code,
            np.where(total > 0, 1.0 - kept, 1.0).clip(0).astype("<f4").view("<u4")]


def grid() -> np.ndarray:
    """The probabilities of the codes; the lowest code stands for nothing."""
    out = 10.0 ** (LOWEST + STEP * np.arange(256))
    out[0] = 0.0
    return out


# scoring

class Scorer:
    """Probabilities after contexts, from the mapped files of level 1."""

    def __init__(self, shards: Shards):
        self.shards, self.grid = shards, grid()
        self.files: dict[int, tuple] = {}

    def _file(self, part: int) -> tuple:
        if part not in self.files:
            arrays = load(f"{self.shards.path}/pairs-{part}")
            self.files[part] = (EliasFano(*arrays[0:3]), EliasFano(*arrays[3:6]), arrays[6],
                                arrays[7].view("<f4"))
        return self.files[part]

    def pairs(self, context: np.ndarray, token: np.ndarray, has: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
        """For ascending contexts: the kept probability of the token, and the weight below."""
        kept, below = np.zeros(len(context)), np.ones(len(context))
        edges = np.searchsorted(context, self.shards.edge)
        for part in np.flatnonzero(np.diff(edges)):
            if not has[part]:
                continue
            some = slice(edges[part], edges[part + 1])
            pointers, successors, code, weight = self._file(part)
            c = context[some] - self.shards.edge[part]
            distinct, place = np.unique(c, return_inverse=True)
            first = pointers.access(distinct)[place]
            last = pointers.access(distinct + 1)[place]
            at = successors.find(c * self.shards.size + np.maximum(token[some], 0), first, last)
            hit = (at >= 0) & (token[some] >= 0)
            kept[some] = np.where(hit, self.grid[code[np.maximum(at, 0)]] if len(code) else 0, 0)
            below[some] = weight[c]
        return kept, below

    def block(self, data: np.ndarray, at: np.ndarray, has: np.ndarray) -> list[np.ndarray]:
        """n_tokens, n_known, base score and score of each text of a block."""
        v = self.shards.vocabulary
        context, token, count, start = _tokens(data, at, v)
        p1 = (count + 1) / (v.tokens + v.size + 1)
        pair = np.where(context >= 0, context * (self.shards.size + 1) + token + 1, -1)
        distinct, place = np.unique(pair, return_inverse=True)
        one, other = np.divmod(distinct, self.shards.size + 1)
        known = distinct >= 0
        kept, below = np.zeros(len(distinct)), np.ones(len(distinct))
        kept[known], below[known] = self.pairs(one[known], other[known] - 1, has)
        p = kept[place] + below[place] * p1

        def sums(x: np.ndarray) -> np.ndarray:
            # every text has its end token; sums of their own keep equal texts equal
            return np.add.reduceat(x.astype(float), start[:-1]) if len(start) > 1 else np.zeros(0)
        return [np.diff(start), sums(count > 0), sums(np.log10(p1)), sums(np.log10(p))]


def learn(docs: DataFrame) -> tuple[Shards, np.ndarray]:
    """The model of the texts of ``docs``, and which of its files hold anything."""
    path = shared_dir(docs.sparkSession)
    vocabulary = learn_vocabulary(docs, path)
    shards = Shards(path, vocabulary, max(1, vocabulary.tokens // TOKENS_PER_FILE))
    has = np.zeros(shards.parts, dtype=bool)
    for r in learn_pairs(docs, shards).collect():      # one row per file
        has[r["shard"]] = True
    return shards, has


def score(docs: DataFrame, model: tuple[Shards, np.ndarray], text: str = "text") -> DataFrame:
    """All rows with a struct ``lm``: n_tokens, n_known, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # paths and shard edges only

    def run(text: pa.Array) -> pa.Array:
        shards, has = shared.value
        scorer, out = _scorer(shards), []
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        for _, data, at in words.blocks(iter([batch]), "text", BLOCK_BYTES):
            out.append(scorer.block(data, at, has))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 4
        return pa.StructArray.from_arrays(
            [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)),
             pa.array(columns[2]), pa.array(columns[3])],
            ["n_tokens", "n_known", "base_score", "score"])
    kind = "n_tokens long, n_known long, base_score double, score double"
    return docs.withColumn("lm", F.arrow_udf(run, kind)(F.col(text)))


_scorers: dict[str, Scorer] = {}


def _scorer(shards: Shards) -> Scorer:
    """One scorer per process and model, so that files are mapped once."""
    if shards.path not in _scorers:
        _scorers.clear()
        _scorers[shards.path] = Scorer(shards)
    return _scorers[shards.path]


def held_out(doc_id: str, folds: int = 7, fold: int = 2) -> Column:
    """Whether crc32 of the id as text falls into the fold; rows without an id do."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(True))


def op7_elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs.where(~held_out("doc_id")))
    return score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lm.n_tokens", "lm.n_known",
        F.lit(model[0].vocabulary.tokens).cast("long").alias("train_tokens"),
        "lm.base_score", "lm.score")
