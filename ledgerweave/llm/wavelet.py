"""Token ids of whole texts in compressed wavelet-matrix files, written and read by Spark.

Each task tokenizes its texts in order and packs the ids of about ``SHARD_TOKENS``
tokens into one file record: a header (document ids, lengths, the sorted alphabet) and
one bit-plane per bit of an id's rank in the alphabet, compressed.  ``WaveletMatrix``
answers access, rank, count and occurrence lookup from the planes alone.

Order: ascending (id, hash of text) over all records, or the order of the input rows
when ``order`` is False.  A null or empty text is one end id; a null id is kept and
sorts first; repeated rows are written once each.  A text of any length is one
document of one record.  Other columns are not read.

Texts are cut for speed at places where the vocabulary's own rule splits as well, so the
ids are those of the whole text.  A string of an added token becomes that token.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerweave.llm.memory import handing_back
from ledgerweave.sources.shared import shared_dir

VOCABULARY = "byte_bpe_50k.json"
END = 2
SHARD_TOKENS = 2 << 20
PARTITION_BYTES = 24 << 20
BLOCK_BYTES = 4 << 20
KNOWN_BYTES = 3 << 20
GROUP = 300
SPAN = 4096

# Bytes that may be white space to the vocabulary's rule; white space beyond ASCII; and the
# letters and stops between which it splits.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_WIDE_LEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
_WIDE_BLANK = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
                         b"|\xe2\x81\x9f|\xe3\x80\x80")
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,;:!?")] = True

_MAGIC = b"LWWM1\0\0\0"


class WaveletMatrix:
    """A sequence of symbols below 2**depth as bit-planes, most significant first."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes            # packed bits, padded to whole words
        self.words = [p.view("<u8") for p in planes]
        self.before = [np.concatenate(([0], np.cumsum(np.bitwise_count(w).astype(np.int64))))
                       for w in self.words]        # ones before each 64-bit word
        self.zeros = [n - int(b[-1]) for b in self.before]

    @classmethod
    def build(cls, codes: np.ndarray, depth: int) -> WaveletMatrix:
        planes, n = [], len(codes)
        for shift in range(depth - 1, -1, -1):
            bit = (codes & codes.dtype.type(1 << shift)) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(np.append(packed, np.zeros(-len(packed) % 8, np.uint8)))
            if shift:
                codes = np.concatenate((np.compress(~bit, codes), np.compress(bit, codes)))
        return cls(n, planes)

    def _bits(self, k: int) -> np.ndarray:
        return np.unpackbits(self.planes[k], bitorder="little", count=self.n).view(bool)

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        part = np.append(self.words[k], np.uint64(0))[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[k][word] + np.bitwise_count(part)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the positions."""
        at, out = np.asarray(at, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for k in range(len(self.planes)):
            bit = (self.words[k][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            ones = self._ones(k, at)
            at = np.where(bit > 0, self.zeros[k] + ones, at - ones)
            out = (out << 1) | bit.astype(np.int64)
        return out

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        a, b = np.zeros(1, np.int64), np.full(1, end, np.int64)
        for k in range(len(self.planes)):
            x, y = self._ones(k, a), self._ones(k, b)
            if symbol >> (len(self.planes) - 1 - k) & 1:
                a, b = self.zeros[k] + x, self.zeros[k] + y
            else:
                a, b = a - x, b - y
        return int(a[0]), int(b[0])

    def rank(self, symbol: int, end: int) -> int:
        """How often the symbol stands before position ``end``."""
        a, b = self._range(symbol, end)
        return b - a

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def occurrences(self, symbol: int) -> np.ndarray:
        """The positions of the symbol in ascending order (select of every rank)."""
        a, b = self._range(symbol, self.n)
        at = np.arange(a, b)
        for k in range(len(self.planes) - 1, -1, -1):
            bits = self._bits(k)
            if symbol >> (len(self.planes) - 1 - k) & 1:
                at = np.flatnonzero(bits)[at - self.zeros[k]]
            else:
                at = np.flatnonzero(~bits)[at]
        return at

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        depth = len(self.planes)
        codes = np.zeros(self.n, np.uint16 if depth <= 16 else np.uint32)
        for k in range(depth - 1, -1, -1):
            bits = self._bits(k)
            codes[self.zeros[k]:] |= codes.dtype.type(1 << (depth - 1 - k))
            out = np.empty_like(codes)
            out[~bits], out[bits] = codes[:self.zeros[k]], codes[self.zeros[k]:]
            codes = out
        return codes


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """One file record: header, document table, alphabet and planes, each part compressed."""
    import zstandard
    used = np.zeros(int(ids.max(initial=0)) + 1, dtype=bool)
    used[ids] = True
    alphabet = np.flatnonzero(used).astype("<u4")
    rank = np.zeros(len(used), dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    rank[alphabet] = np.arange(len(alphabet))
    matrix = WaveletMatrix.build(rank[ids], max(0, len(alphabet) - 1).bit_length())
    parts = [np.array([d or 0 for d in doc_ids], "<i8"),
             np.array([d is None for d in doc_ids], np.uint8), lengths.astype("<u4"),
             np.diff(alphabet, prepend=np.uint32(0)).astype("<u4"), *matrix.planes]
    squeeze = zstandard.ZstdCompressor(level=1)
    packed = [squeeze.compress(p.tobytes()) for p in parts]
    sizes = struct.pack(f"<{len(packed)}Q", *map(len, packed))
    return _MAGIC + struct.pack("<QI", len(ids), len(packed)) + sizes + b"".join(packed)


class Shard:
    """A record read back: its documents and, by rank in the alphabet, its wavelet matrix."""

    def __init__(self, record: bytes):
        import zstandard
        if record[:8] != _MAGIC:
            raise ValueError("not a token record")
        n, count = struct.unpack_from("<QI", record, 8)
        sizes = struct.unpack_from(f"<{count}Q", record, 20)
        at, parts, inflate = 20 + 8 * count, [], zstandard.ZstdDecompressor()
        for size in sizes:
            parts.append(np.frombuffer(inflate.decompress(record[at:at + size]), np.uint8))
            at += size
        ids, nulls, self.lengths = parts[0].view("<i8"), parts[1], parts[2].view("<u4")
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, nulls)]
        self.alphabet = np.cumsum(parts[3].view("<u4"), dtype=np.uint32)
        self.matrix = WaveletMatrix(n, parts[4:])

    def tokens(self) -> np.ndarray:
        return self.alphabet[self.matrix.decode()]

    def access(self, at: np.ndarray) -> np.ndarray:
        return self.alphabet[self.matrix.access(at)]

    def _symbol(self, token: int) -> int | None:
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else None

    def count(self, token: int) -> int:
        s = self._symbol(token)
        return 0 if s is None else self.matrix.count(s)

    def occurrences(self, token: int) -> np.ndarray:
        s = self._symbol(token)
        return np.zeros(0, np.int64) if s is None else self.matrix.occurrences(s)


class Encoder:
    """Ids of whole texts; what repeats within a block of text is tokenized once.

    The vocabulary's rule always splits before a blank that stands between two characters
    other than white space, around such a line feed, and between an ASCII letter and a
    following stop.  A block is cut at these places, its distinct pieces go to the tokenizer
    many at a time, and the bytes that each id stands for tell where a piece ends.  The pieces
    met last, up to ``KNOWN_BYTES`` of them, are known to the next block, so memory is bounded
    by that and a block.  A text that holds an added token or white space beyond ASCII is
    encoded as a whole.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [t.encode() for t in added]
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        self.n_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.known = (pa.array([], pa.binary()), _lists(np.zeros(0, self.kind), []))

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and their numbers."""
        given = [text.encode() if text else b"" for text in texts]
        whole = {i: np.array(self._whole([texts[i]])[0], self.kind)
                 for i, text in enumerate(given) if self._odd(text)}
        plain = [b"" if i in whole else text for i, text in enumerate(given)]
        edges = np.concatenate(([0], np.cumsum([len(p) for p in plain], dtype=np.int64)))
        ids, lengths = np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        if edges[-1]:
            ids, lengths = self._block(np.frombuffer(b"".join(plain), np.uint8), edges)
        upto, last, made = np.cumsum(lengths), np.array([end], self.kind), []
        for i, b in enumerate(upto):
            made += [whole.get(i, ids[b - lengths[i]:b]), last]
            if i in whole:
                lengths[i] = len(whole[i])
        return np.concatenate(made or [last[:0]]), lengths + 1

    def _odd(self, text: bytes) -> bool:
        return (any(t in text for t in self.added)
                or not text.isascii() and any(t in text for t in _WIDE_LEADS)
                and _WIDE_BLANK.search(text) is not None)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _block(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts between the edges and how many each has, piece by piece."""
        cuts = _cuts(data, edges)
        parts, a = [], 0
        while a < len(cuts) - 1:         # at most BLOCK_BYTES at a time, within a text as well
            b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + BLOCK_BYTES, "right")) - 1)
            parts.append(self._pieces(data[cuts[a]:cuts[b]], cuts[a:b + 1] - cuts[a]))
            a = b
        counts = np.concatenate([c for _, c in parts])
        before = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(cuts, edges)]
        return np.concatenate([i for i, _ in parts]), np.diff(before)

    def _pieces(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [
            None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        ids = self._ids(pieces.dictionary)
        counts = pa.compute.list_value_length(ids).to_numpy()
        return (ids.take(pieces.indices).flatten().to_numpy(),
                counts[pieces.indices.to_numpy()].astype(np.int64))

    def _ids(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of distinct pieces, which are known from now on."""
        old, old_ids = self.known
        place = pa.compute.index_in(pieces, value_set=old).fill_null(-1).to_numpy()
        new = place < 0
        learned = self._learn(pieces.take(pa.array(np.flatnonzero(new))))
        ids = pa.concat_arrays([learned, old_ids]).take(
            pa.array(np.where(new, np.cumsum(new) - 1, len(learned) + place)))
        unmet = np.ones(len(old), dtype=bool)
        unmet[place[~new]] = False
        kept, room = [], KNOWN_BYTES
        for some, its, at in ((pieces, ids, np.arange(len(pieces))),
                              (old, old_ids, np.flatnonzero(unmet))):
            size = np.cumsum(pa.compute.binary_length(some).to_numpy()[at], dtype=np.int64)
            at = at[:np.searchsorted(size, room, "right")]
            room -= int(size[:len(at)].max(initial=0))
            kept.append((some.take(pa.array(at)), its.take(pa.array(at))))
        self.known = tuple(map(pa.concat_arrays, zip(*kept)))
        return ids

    def _learn(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of distinct pieces from the tokenizer."""
        if not len(pieces):
            return _lists(np.zeros(0, self.kind), [])
        width = pa.compute.binary_length(pieces).to_numpy().astype(np.int64)
        data, ends = np.frombuffer(pieces.buffers()[2], np.uint8)[:width.sum()], np.cumsum(width)
        blank = _SPACE[data]
        open_, shut = ~blank[ends - width], ~blank[ends - 1]
        second = ~blank[np.minimum(ends - width + 1, len(data) - 1)] & (width > 1)
        spaced = (data[ends - width] == 0x20) & second & shut    # cut by its own blank
        lone = np.flatnonzero(~(spaced | (open_ & shut)))
        groups, texts = [[x] for x in lone], pieces.take(pa.array(lone)).to_pylist()
        for which, glue in ((spaced, b""), (open_ & shut, b"\n")):
            which = np.flatnonzero(which)
            groups += [which[i:i + GROUP] for i in range(0, len(which), GROUP)]
            texts += [_joined(pieces.take(pa.array(which[i:i + GROUP])), glue)
                      for i in range(0, len(which), GROUP)]
        counts, found = np.zeros(len(pieces), np.int64), []
        for which, text, got in zip(groups, texts, self._whole([t.decode() for t in texts])):
            ids = np.array(got, self.kind)
            if len(which) == 1:
                counts[which] = len(ids)
            else:
                glued = len(text) > width[which].sum()     # a line feed between two: an id of its own
                last = np.cumsum(width[which] + glued) - glued
                upto = np.searchsorted(np.cumsum(self.n_bytes[ids]), last) + 1
                n = np.diff(upto, prepend=0)
                if glued:
                    n[1:] -= 1
                    ids = np.delete(ids, upto[:-1])
                counts[which] = n
            found.append(ids)
        order = np.concatenate([np.asarray(g, np.int64) for g in groups])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _lists(np.concatenate(found), counts[order]).take(pa.array(back))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """The ids in lists of so many each, one list after the other."""
    ends = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))


def _joined(pieces: pa.Array, glue: bytes) -> bytes:
    width = pa.compute.binary_length(pieces).to_numpy().astype(np.int64)
    data = bytes(pieces.buffers()[2])[:int(width.sum())]
    if not glue:
        return data
    return np.insert(np.frombuffer(data, np.uint8), np.cumsum(width)[:-1], glue[0]).tobytes()


def _cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Ends of texts and the places within texts where the vocabulary's rule splits for sure."""
    cut = np.zeros(len(data) + 1, dtype=bool)
    blank = _SPACE[data]
    lone = blank[1:-1] & ~blank[:-2] & ~blank[2:]
    at = np.flatnonzero(lone) + 1
    cut[edges] = True
    at = at[~cut[at] & ~cut[at + 1]]                           # neighbours of other texts
    cut[at[(data[at] == 0x20) | (data[at] == 0x0A)]] = True
    cut[at[data[at] == 0x0A] + 1] = True
    cut[1:-1] |= _STOP[data[1:]] & _ASCII_LETTER[data[:-1]]
    return np.flatnonzero(cut)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


RECORD = "part long, seq long, n_tokens long, record binary"


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END,
                 order: bool = True) -> None:
    """Writes (doc_id, text) as records below ``path``; (part, seq) is their order."""
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if order:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
        rows = (rows.repartitionByRange(max(1, -(-size // PARTITION_BYTES)), *keys)
                .sortWithinPartitions(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq = Encoder(vocabulary), 0
        ids, doc_ids, lengths, n = [], [], [], 0

        def record() -> pa.RecordBatch:
            whole = np.concatenate(ids)
            made = pack(whole, doc_ids, np.concatenate(lengths))
            part = TaskContext.get().partitionId()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()),
                 pa.array([len(whole)], pa.int64()), pa.array([made], pa.binary())],
                ["part", "seq", "n_tokens", "record"])
        for batch in batches:
            width = np.cumsum(pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy())
            a = 0
            while a < batch.num_rows:        # texts of at most BLOCK_BYTES, or one
                before = int(width[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(width, before + BLOCK_BYTES, "right")))
                some, a = batch.slice(a, b - a), b
                got, each = encoder.encode(some.column("text").to_pylist(), end)
                ids.append(got)
                lengths.append(each)
                doc_ids += some.column("doc_id").to_pylist()
                n += len(got)
                if n >= SHARD_TOKENS:
                    yield record()
                    seq, ids, doc_ids, lengths, n = seq + 1, [], [], [], 0
        if n:
            yield record()
    rows.mapInArrow(lambda b: handing_back(run(b)), RECORD).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the records below ``path``, in their order.

    doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of its ids as
    little-endian unsigned 32-bit integers, and (part, seq) of the record.
    """
    records = spark.read.schema(RECORD).parquet(path)
    base = _starts(records.select("part", "seq", "n_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, record in zip(*(batch.column(c).to_pylist()
                                           for c in ("part", "seq", "record"))):
                shard = Shard(record)
                ids = shard.tokens().astype("<u4", copy=False)
                at = np.concatenate(([0], np.cumsum(shard.lengths, dtype=np.int64)))
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
                k = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, part)), pa.array(np.full(k, seq)),
                     pa.array(shard.doc_ids, pa.int64()), pa.array(at[:-1]),
                     pa.array(shard.lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])
    found = records.select("part", "seq", "record").mapInArrow(
        lambda b: handing_back(run(b)), "part long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (found.join(base, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens",
                    "ids_crc32", "part", "seq"))


def _starts(sizes: DataFrame) -> DataFrame:
    """(part, seq, base): tokens before each record, from one row per record.

    Sums run within a part, over the parts of a span and over the spans, so no task sorts
    all records.
    """
    def before(rows: DataFrame, order: str, *by: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(f"of_{order}", F.coalesce(F.sum("n_tokens").over(window), F.lit(0)))
    parts = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
             .withColumn("span", F.expr(f"part div {SPAN}")))
    spans = before(parts.groupBy("span").agg(F.sum("n_tokens").alias("n_tokens")), "span")
    parts = before(parts, "part", "span").join(spans.select("span", "of_span"), "span")
    return (before(sizes, "seq", "part").join(parts.select("part", "of_part", "of_span"), "part")
            .select("part", "seq", F.expr("of_span + of_part + of_seq").alias("base")))


def op6_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
