import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerweave.plans import splitting
from ledgerweave.plans.splitting import split_sizes
from ledgerweave.sources import sinks


def expected(n):
    """Split of keys 0..n-1 by brute force."""
    order = sorted(range(n), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), str(k)))
    n_valid = max(1, int(n * 0.15))
    n_test = max(1, min(5, n_valid))
    if n - n_valid - n_test < 5:
        return {"train": sorted(order), "valid": sorted(order[:min(3, n)]),
                "test": sorted(order[:min(2, n)])}
    return {"valid": sorted(order[:n_valid]), "test": sorted(order[n_valid:n_valid + n_test]),
            "train": sorted(order[n_valid + n_test:])}


def splits(df, key="k"):
    got = {}
    for r in df.collect():
        got.setdefault(r["split"], []).append(r[key])
    return {s: sorted(v) for s, v in got.items()}


@pytest.mark.parametrize("n", [1, 2, 6, 7, 20, 100, 1000])
def test_split_by_brute_force(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    assert splits(splitting.split_records(df, ["k"])) == expected(n)


def test_nothing_to_split(spark):
    with pytest.raises(ValueError):
        splitting.split_records(spark.range(0), ["id"])


def test_independent_of_partitions(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    one = splits(splitting.split_records(df.coalesce(1), ["k"]))
    many = splits(splitting.split_records(df.repartition(13), ["k"]))
    assert one == many


@pytest.mark.parametrize("copies,others", [(40, 60), (90, 10), (100, 0), (5, 0)])
def test_copies_across_a_cut(spark, copies, others):
    """Many equal records: each split still has its exact size, and none is lost."""
    keys = ["same"] * copies + [f"k{i}" for i in range(others)]
    df = spark.createDataFrame([(k, {"role": k}) for k in keys], "k string, m map<string,string>")
    got = splits(splitting.split_records(df, ["k"]))
    size = split_sizes(len(keys))
    assert {s: len(v) for s, v in got.items()} == {
        "train": size.train, "valid": size.valid, "test": size.test}
    if not size.overlapping:
        assert sorted(sum(got.values(), [])) == sorted(keys)
    order = sorted(keys, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert got["valid"] == sorted(order[:size.valid])


def test_same_key_other_content(spark):
    """Equal keys on different records: nothing is lost."""
    df = spark.createDataFrame([("same", i) for i in range(50)], "k string, v int")
    got = splitting.split_records(df, ["k"])
    assert sorted(r.v for r in got.collect()) == list(range(50))
    assert got.where("split = 'valid'").count() == 7


def test_positions(spark):
    keys = ["same"] * 30 + [f"k{i}" for i in range(70)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    order = sorted(keys, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    got = splitting.shuffled_positions(df, ["k"]).orderBy("position").collect()
    assert [(r.k, r.position) for r in got] == [(k, i) for i, k in enumerate(order, 1)]
    assert [r.k for r in splitting.shuffled(df, ["k"]).collect()] == order


def test_blocks_of_copies(spark, monkeypatch):
    monkeypatch.setattr(splitting, "_BLOCK", 7)
    df = spark.createDataFrame([("same",)] * 100, "k string")
    assert splitting.split_counts(splitting.split_records(df, ["k"])).where(
        "split = 'valid'").first().n == 15
    got = splitting.shuffled_positions(df, ["k"]).agg(F.sum("position"), F.count("*")).first()
    assert tuple(got) == (5050, 100)


def test_positions_in_longer_buckets(spark, monkeypatch):
    """More digits than the driver's sums have: offsets come from a window below each prefix."""
    monkeypatch.setattr(splitting, "_BLOCK", 3)
    monkeypatch.setattr(splitting, "_PREFIX", 1)
    keys = [f"k{i % 300}" for i in range(900)] + ["hot"] * 50
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    order = sorted(keys, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    got = splitting.shuffled_positions(df, ["k"]).orderBy("position").collect()
    assert splitting._bucket_digits(len(keys)) == 3
    assert [(r.k, r.position) for r in got] == [(k, i) for i, k in enumerate(order, 1)]
    assert splitting.shuffled_positions(df.limit(0), ["k"]).count() == 0


def test_labels_move_no_records(spark):
    """Away from the cuts a record gets its label where it is."""
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = splitting.split_records(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_files_are_in_shuffled_order(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("k"), F.array(F.struct(
        F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))).alias("messages"))
    split = splitting.split_records(df, ["k"])
    sinks.write_splits(split.repartition(7), str(tmp_path / "out"), [splitting.shuffle_hash(["k"]), "k"])
    place = {r.k: r.position for r in splitting.shuffled_positions(df, ["k"]).collect()}
    every = []
    for name in ("valid", "test", "train"):
        files = sorted((tmp_path / "out" / f"split={name}").glob("part-*"))
        lines = [json.loads(x) for f in files for x in f.read_text().splitlines()]
        every += [place[int(x["messages"][0]["content"])] for x in lines]
    assert every == list(range(1, 2001))
