"""Bigram scores against counts by hand, packed sequences and edge cases."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerweave.llm import triescore

SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()),
                    ("source", pa.string()), ("n_chars", pa.int64())])


def folder(tmp_path, texts):
    n = len(texts)
    pq.write_table(pa.table([list(range(n)), texts, ["en"] * n, ["s"] * n, [1] * n], schema=SCHEMA),
                   tmp_path / "documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("n, top", [(0, 10), (1, 5), (1000, 10**6), (5000, 6000)])
def test_packed_sequences_give_back_their_values(n, top):
    values = np.sort(np.random.default_rng(n).choice(top, n, replace=False)).astype(np.int64)
    packed = triescore.EliasFano(*triescore.EliasFano.pack(values, top))
    assert (packed.values() == values).all()
    assert (packed.access(np.arange(n)) == values).all()
    if n:
        low = np.zeros(n, int)
        assert (packed.find(values, low, low + n) == np.arange(n)).all()


def test_counts_and_base_equal_hand(spark, tmp_path):
    texts = ["The cat sat", None, "", "the dog sat on the cat", "a b\tc " * 400, "unseen only", "The cat sat"]
    texts += [f"the cat w{i % 5} sat" for i in range(30)]
    got = {r.doc_id: r for r in triescore.op7_elias_fano_trie(spark, folder(tmp_path, texts)).collect()}
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\0"] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    count = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, size = sum(count.values()), len(count)
    assert sorted(got) == list(range(len(texts)))
    for i, ws in enumerate(tokens):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(ws), total)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(
            sum(math.log10((count[w] + 1) / (total + size + 1)) for w in ws), rel=1e-9)
        assert math.isfinite(r.score) and r.score <= 0
    assert got[0].score == got[6].score


def test_no_documents(spark, tmp_path):
    assert triescore.op7_elias_fano_trie(spark, folder(tmp_path, [])).count() == 0
