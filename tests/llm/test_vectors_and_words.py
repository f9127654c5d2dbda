"""Whitening, license scan and spelling variants against brute force and at the edges."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import licenses, spelling, whitening

VECTORS = "vec_id long, embedding array<double>"


# op11

def whitened_by_hand(vectors):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return x, n, total, e[::-1], u[:, ::-1]


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((300, 20)) @ rng.standard_normal((20, 20))).tolist()
    vectors += vectors[:100] + [vectors[0]] * 50
    df = spark.createDataFrame(list(enumerate(vectors)), VECTORS).withColumn("x", F.lit("clash"))
    got = whitening.whiten(df).toPandas()
    x, n, total, e, u = whitened_by_hand(vectors)
    assert n == 300 and len(got) == 16 * len(vectors) and set(got.n) == {300}
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = (x - total / n) @ u[:, :16] / np.sqrt(e[:16])
    sign = np.sign((table * want).sum(axis=0))
    assert np.abs(table - want * sign).max() < 1e-9
    share = got.groupby("component").explained.first().to_numpy()
    assert np.abs(share / (e[:16] / e.sum()) - 1).max() < 1e-10
    far = got.groupby("vec_id").deviation.first()
    assert far.tolist() == ((n * x - total) ** 2).sum(axis=1).tolist()
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0, 2.0]), (2, [0.0, 3.0, 2.0]), (None, [0.0, 3.0, 2.0]), (3, None), (4, [nan, 1.0, 1.0]),
            (5, [inf, 1.0, 1.0]), (6, [None, 1.0, 1.0]), (7, [1.0]), (8, []), (1, [0.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, VECTORS)
    got = [tuple(r)[:4] for r in whitening.whiten(df).collect()]
    # one direction has variance; two distinct vectors, 128 apart
    assert Counter(got) == Counter([(1, 1, 2, 128 ** 2)] * 2 + [(2, 1, 2, 128 ** 2), (None, 1, 2, 128 ** 2)])
    for nothing in (df.limit(0), df.where("vec_id = 1"), df.where("vec_id = 8"), df.where("vec_id = 3")):
        assert whitening.whiten(nothing).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], VECTORS)
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} == {None}


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    b = rng.standard_normal((12, 5))
    a = b @ b.T                              # rank 5
    factor, order = whitening.pivoted_cholesky(a)
    assert factor.shape == (12, 5)
    assert np.abs(factor @ factor.T - a[np.ix_(order, order)]).max() < 1e-10
    turned = whitening.rotated(factor)
    norms = (turned ** 2).sum(axis=0)
    assert np.abs(turned.T @ turned - np.diag(norms)).max() < 1e-10 * norms.max()
    assert np.allclose(norms, np.linalg.eigvalsh(a)[::-1][:5])


# op12

def words_by_hand(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_by_hand(text):
    words, places, labels = words_by_hand(text), [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"),
                          ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


TEXTS = [
    None, "", "  \n", "license", "MIT License", "mit-license. MIT\nLICENSE", " (mit) license mit license mit license ",
    "commit license", "mit licenses", "GNU General Public License, version 3.", "general public",
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "a cc by nc 4",
    "This work is licensed under the GNU General Public License, version 3.", "MÍT License é mit lıcense",
    "x " * 40_000 + "Released under the MIT License. " + "y " * 40_000, "the license of mit " * 3000,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: none", "KMIT İ License mit license 2mit license",
]


def test_license_base_equals_hand(spark):
    df = spark.createDataFrame([(i, t, "?") for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string")
    got = licenses.scan(df).orderBy("doc_id").collect()
    assert [tuple(r)[2:7] for r in got] == [base_by_hand(t) for t in TEXTS]
    for r in got:
        mine = set(r["base_labels"].split(",")) - {""}
        every = set(r["labels"].split(",")) - {""}
        assert mine <= every and (r["score"] > 0) == bool(every) and 0 <= r["score"] <= 1


def test_license_templates(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {TEXTS[r["doc_id"]]: r["labels"] for r in licenses.scan(df).collect()}
    assert got["Licensed under CC BY-NC 4.0."] == "cc-by-nc-4.0"
    assert got[TEXTS[11]] == "apache,apache-2.0" and got[TEXTS[14]] == "gpl,gpl-3.0"
    assert got[TEXTS[18]] == "mit" and got[TEXTS[19]] == "bsd"
    for clean in ("license", "a cc by nc 4", "general public", "commit license", "the license of mit " * 3000, None):
        assert got[clean] == ""


def test_license_edges(spark):
    schema = "doc_id long, text string, n_words string, _x int"
    df = spark.createDataFrame([(None, "MIT License", "a", 1), (1, "MIT License", "b", 1),
                                (1, "nothing", None, None)], schema)
    got = licenses.scan(df)
    assert got.columns == ["doc_id", "text", "_x", *licenses.RESULTS]
    assert Counter((r["doc_id"], r["labels"]) for r in got.collect()) == Counter(
        [(None, "mit"), (1, "mit"), (1, "")])
    assert licenses.scan(df.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# op13

def variants_by_hand(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    words = {w: n for w, n in counts.items() if n >= 2}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    near = defaultdict(list)
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def misspelt(seed):
    rng = random.Random(seed)
    letters, out = "abcdeéñ", []
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(12)]
    for k, stem in enumerate(stems):
        out += [stem] * (400 if k % 3 == 0 else 30)
        for _ in range(25):
            at, how, c = rng.randrange(len(stem)), rng.randrange(3), rng.choice(letters)
            word = stem[:at] + (c if how else "") + stem[at + (how < 2):]
            out += [word] * rng.choice([1, 2, 3, 30])
    rng.shuffle(out)
    return [(i, " ".join(out[i::40]).title() if i % 5 == 0 else " ".join(out[i::40])) for i in range(40)]


@pytest.mark.parametrize("block", [1024, 16])
def test_variants_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    docs = misspelt(block) + [(None, "Straßenbahn straßenbahn"), (99, None), (98, ""),
                              (97, "abcdefg, abcdefgh×abcdefg÷abcdefgh " * 20 + "q" * 5000 + " " + "q" * 5000
                               + " " + "q" * 5001 + " " + "q" * 5001)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1))
    got = [tuple(r) for r in spelling.spelling_variants(df).collect()]
    want = variants_by_hand(docs)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(x[1] and x[2] != x[1] for x in want)      # a chain of forms


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "once only words")], "doc_id long, text string")
    assert spelling.spelling_variants(df).count() == 0
    assert spelling.spelling_variants(df.limit(0)).count() == 0


# pipeline

def test_near_duplicate_stage(spark):
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a b c d e f", "en", "s", 1), (2, "A b c d e f", "en", "t", 1), (3, "b c d e f g", "en", "s", 1),
            (3, "x y z", "en", "s", 1), (3, "x y z", "en", "s", 1), (4, "x y z", None, "s", 1),
            (None, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (5, None, "en", "s", None),
            (6, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, schema)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert got.columns == df.columns
    kept = sorted((r["doc_id"] for r in got.collect() if r["doc_id"] is not None))
    assert kept == [1, 3, 5, 6] and got.where("doc_id is null").count() == 2
    again = corpus_pipeline.drop_near_duplicates(spark, df.orderBy(F.desc("text")), "")
    assert ({tuple(r) for r in got.collect()} == {tuple(r) for r in again.collect()})
    assert corpus_pipeline.drop_near_duplicates(spark, df.limit(0), "").count() == 0


def test_pipeline_stages_keep_clean_documents(spark):
    import corpus_pipeline
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.write_through(stage(spark, docs, sf_dir))
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] > 0.5 * sizes[0]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).orderBy("start").collect()
    assert len(out) == sizes[-1]
    at = 0
    for r in out:
        assert r["start"] == at and r["n_tokens"] >= 1
        at += r["n_tokens"]
