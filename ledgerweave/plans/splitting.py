"""Seeded shuffle and three-way split without moving the records.

A record's place in the shuffled order is the rank of ``md5(seed:key)``.  The
split needs only the hash values at two ranks.  They are found by counting
records per hash prefix: each round returns at most 65,536 counts, whatever the
data, and fixes four more hex digits.  Labelling is then a comparison per row.
Rounds read the hashes from a table that the first one has written, not the records.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweave.sources.shared import write_through

# Fixed values of the split rule.
SEED = 42
VALID_SHARE = 0.15
MAX_TEST = 5
TINY_TRAIN = 5
TINY_VALID, TINY_TEST = 3, 2

_DIGITS = 4
_BLOCK = 100_000
_HASH = "_hash"
_PREFIX = 3          # hex digits of the sums that pass the driver


@dataclass(frozen=True)
class SplitSizes:
    valid: int
    test: int
    train: int
    overlapping: bool


def split_sizes(n: int, valid_share: float = VALID_SHARE) -> SplitSizes:
    """Sizes for ``n`` records.  Where fewer than 5 would be left for training,
    all of them train and the first few are also validation and test records."""
    if n == 0:
        raise ValueError("no valid examples to split")
    valid = max(1, int(n * valid_share))
    test = max(1, min(MAX_TEST, valid))
    if n - valid - test < TINY_TRAIN:
        return SplitSizes(min(TINY_VALID, n), min(TINY_TEST, n), n, True)
    return SplitSizes(valid, test, n - valid - test, False)


def shuffle_hash(key: Sequence[str], seed: int = SEED) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return F.md5(text)


@dataclass(frozen=True)
class Cut:
    """Place of a rank: every smaller hash comes before it, and of the records
    with exactly this hash the first ``within``."""
    hash: str
    within: int


def _count_prefixes(hashed: DataFrame, prefix: str) -> list[tuple[str, int]]:
    rows = hashed.where(F.col(_HASH).startswith(prefix)) if prefix else hashed
    size = len(prefix) + _DIGITS
    counts = rows.groupBy(F.substring(_HASH, 1, size).alias("p")).count()
    return sorted((r["p"], r["count"]) for r in counts.collect())


def find_cuts(hashed: DataFrame, ranks_of) -> tuple[int, list[Cut]]:
    """Number of records, and the cuts at the ranks that ``ranks_of(n)`` names.

    Records with equal hashes beyond the prefix are only told apart while a
    prefix holds more than the records wanted; with distinct keys two or three
    rounds suffice.
    """
    hashed = write_through(hashed.select(_HASH))
    cache: dict[str, list[tuple[str, int]]] = {"": _count_prefixes(hashed, "")}
    n = sum(c for _, c in cache[""])
    cuts = []
    for rank in ranks_of(n):
        prefix, left = "", rank
        while len(prefix) < 32:
            if prefix not in cache:
                cache[prefix] = _count_prefixes(hashed, prefix)
            for p, count in cache[prefix]:
                if left < count:
                    prefix = p
                    break
                left -= count
            else:
                prefix = "g"  # sorts after every hash: the rank is the end
                break
            if left == 0:
                break
        cuts.append(Cut(prefix, left if len(prefix) == 32 else 0))
    return n, cuts


def _labels(sizes: SplitSizes, position: Column) -> Column:
    """Split labels of a 0-based position."""
    if sizes.overlapping:
        return F.array_compact(F.array(
            F.lit("train"), F.when(position < sizes.valid, "valid"),
            F.when(position < sizes.test, "test")))
    label = (F.when(position < sizes.valid, "valid")
             .when(position < sizes.valid + sizes.test, "test").otherwise("train"))
    return F.array(label)


def split_records(records: DataFrame, key: Sequence[str], *, seed: int = SEED,
                  valid_share: float = VALID_SHARE) -> DataFrame:
    """Records with their ``split``; in the tiny case a record is in several.

    Records with equal keys are taken as copies of each other.  Rows away from
    the cuts are labelled where they are.  Only copies that lie across a cut are
    collapsed to one row with a count, numbered, and spread out again.
    """
    hashed = records.withColumn(_HASH, shuffle_hash(key, seed))
    sizes: list[SplitSizes] = []

    def ranks(n):
        sizes.append(split_sizes(n, valid_share))
        s = sizes[0]
        return sorted([s.valid, s.test] if s.overlapping else [s.valid, s.valid + s.test])

    _, cuts = find_cuts(hashed, ranks)
    size = sizes[0]
    first, second = cuts
    h = F.col(_HASH)
    # A position inside each of the three stretches stands for all of its rows.
    marks = sorted({size.valid, size.test} if size.overlapping else {size.valid,
                                                                     size.valid + size.test})
    low, high = marks[0] - 1, marks[-1]
    middle = marks[-1] - 1
    position = F.when(h < first.hash, low).when(h < second.hash, middle).otherwise(high)
    out = hashed.withColumn("split", F.explode(_labels(size, position)))
    shared = {c.hash for c in cuts if c.within}
    if not shared:
        return out.drop(_HASH)
    apart = out.where(~h.isin(*shared))
    bases = F.lit(None).cast("long")
    for c, rank in zip(cuts, ranks_of_size(size)):
        if c.within:
            bases = F.when(h == c.hash, F.lit(rank - c.within)).otherwise(bases)
    copies = hashed.where(h.isin(*shared))
    content = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    groups = copies.groupBy(_HASH, content.alias("_content")).agg(
        F.any_value(F.struct(*records.columns)).alias("_record"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(_HASH).orderBy("_content").rowsBetween(
        W.unboundedPreceding, -1))
    numbered = (groups.withColumn("_first", bases + F.coalesce(before, F.lit(0)))
                .withColumn("_last", F.col("_first") + F.col("_n") - 1))
    spread = _number_copies(numbered, "_at", spread_out=True)
    labelled = spread.select("_record.*", F.explode(_labels(size, F.col("_at"))).alias("split"))
    return apart.drop(_HASH).unionByName(labelled)


def _number_copies(df: DataFrame, name: str, spread_out: bool) -> DataFrame:
    """A row per number from ``_first`` to ``_last``, in blocks.

    ``spread_out`` shuffles the blocks, so very many copies of one row are
    written by many tasks.
    """
    blocks = df.withColumn("_block", F.explode(F.sequence("_first", "_last", F.lit(_BLOCK))))
    if spread_out:
        blocks = blocks.repartition("_block")
    end = F.least(F.col("_block") + _BLOCK - 1, F.col("_last"))
    return blocks.withColumn(name, F.explode(F.sequence(F.col("_block"), end)))


def ranks_of_size(size: SplitSizes) -> list[int]:
    return sorted([size.valid, size.test] if size.overlapping
                  else [size.valid, size.valid + size.test])


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("n"))


def shuffled(records: DataFrame, key: Sequence[str], *, seed: int = SEED) -> DataFrame:
    """Records in shuffled order, by a distributed range sort."""
    return (records.withColumn(_HASH, shuffle_hash(key, seed))
            .orderBy(_HASH, *key).drop(_HASH))


def shuffled_positions(records: DataFrame, key: Sequence[str], *, seed: int = SEED) -> DataFrame:
    """Every key with its 1-based place in the shuffled order.

    Keys are counted first, so copies of a key collapse before the shuffle.  The
    rank is the number of records in smaller hash buckets plus the rank inside the
    bucket.  There are about as many buckets as blocks of ``_BLOCK`` records, so
    none grows with the data; those below one hash prefix are summed up in one
    window, and at most 4,096 sums of prefixes pass the driver.
    """
    h = shuffle_hash(key, seed)
    keys = write_through(records.groupBy(*key).agg(F.count("*").alias("_n")).withColumn(_HASH, h))
    digits = _bucket_digits(keys.agg(F.sum("_n")).first()[0] or 0)
    keys = keys.withColumn("_bucket", F.substring(_HASH, 1, digits))
    inside = F.sum("_n").over(W.partitionBy("_bucket").orderBy(_HASH, *key).rowsBetween(
        W.unboundedPreceding, W.currentRow))
    ranked = (keys.withColumn("_inside", inside).join(_offsets(keys, digits), "_bucket")
              .withColumn("_last", F.col("_offset") + F.col("_inside"))
              .withColumn("_first", F.col("_last") - F.col("_n") + 1)
              .select(*key, "_n", "_first", "_last"))
    few = _number_copies(ranked.where(F.col("_n") <= _BLOCK), "position", spread_out=False)
    many = _number_copies(ranked.where(F.col("_n") > _BLOCK), "position", spread_out=True)
    return few.unionByName(many).select(*key, "position")


def _bucket_digits(n: int) -> int:
    """Hex digits of a hash that leave about ``_BLOCK`` records to a bucket."""
    digits = _PREFIX
    while n > _BLOCK * 16 ** digits:
        digits += 1
    return digits


def _offsets(keys: DataFrame, digits: int) -> DataFrame:
    """Number of records before each bucket."""
    sizes = keys.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    prefix = F.substring("_bucket", 1, _PREFIX)
    total, before = 0, []
    for p, size in sorted(tuple(r) for r in keys.groupBy(F.substring(_HASH, 1, _PREFIX))
                          .agg(F.sum("_n")).collect()):
        before.append((p, total))
        total += size
    places = keys.sparkSession.createDataFrame(before, "_prefix string, _before long")
    if digits == _PREFIX:
        return sizes.join(F.broadcast(places), sizes["_bucket"] == places["_prefix"]).select(
            "_bucket", F.col("_before").alias("_offset"))
    within = F.sum("_size").over(W.partitionBy("_prefix").orderBy("_bucket").rowsBetween(
        W.unboundedPreceding, -1))
    return (sizes.withColumn("_prefix", prefix).join(F.broadcast(places), "_prefix")
            .withColumn("_offset", F.col("_before") + F.coalesce(within, F.lit(0)))
            .select("_bucket", "_offset"))
