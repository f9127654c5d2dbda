"""Words, lower-cased bytes and 64-bit hashes of whole Arrow text columns, without a loop per word.

A word is a run of bytes other than the blank and the five control characters
0x09 to 0x0D; A-Z count as a-z.  Hashes depend on the bytes only, never on the
process, so results of different tasks can be joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_STEP = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """step**i and its inverse for i below n, modulo 2**64."""
    size = max(BLOCK_BYTES, 1 << max(0, n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        made = []
        for base in (_STEP, _INVERSE):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _powers[size] = (made[0], made[1])
    return _powers[size]


def text_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of at most ``limit`` text bytes (or one row) with their bytes and offsets."""
    for batch in batches:
        data, at = text_array(batch.column(column))
        first, n = 0, batch.num_rows
        while first < n:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            last = min(last, n)
            yield (batch.slice(first, last - first), data[at[first]:at[last]],
                   at[first:last + 1] - at[first])
            first = last


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``; a run never crosses an offset in ``at``."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, dtype=bool)
    cut[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run ``data[start:end]``; runs are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block and, per text, the offset of its first word (n + 1)."""
    low = LOWER[data]
    starts, ends = spans(~BLANK[low], at)
    return run_hashes(low, starts, ends), np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct ``size``-word shingles of one text, sorted; a shorter text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < size:
        out = np.full(1, n, dtype=np.uint64)
        for h in hashes:
            out = mix(out * _STEP + h)
        return out
    total = np.full(n - size + 1, size, dtype=np.uint64)
    for j in range(size):
        total = total * _STEP + hashes[j:n - size + 1 + j]
    return np.unique(mix(total))
