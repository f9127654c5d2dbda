"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated n times, where n inverts the Poisson distribution of
mean rate(s) at a number that is a hash of seed and id.  The rate is the wanted share of
characters over the present one.  A mean above ``MEAN`` is drawn as the sum of
several independent draws, so the table of a source stays short at any rate.  Copies
are then spread at random over partitions and ordered at random within.

Without weights, a source's share is its size to the power ``temperature``.  Sources
missing from given weights get no share and vanish; sources without a character keep
each document once.  A null source is a source of its own.  Rows that share an id
are repeated alike; a null id counts as the text ``null``.  Columns named ``copy`` and
``order_key`` are replaced, all others kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerweave.sources.shared import write_through

MEAN = 4.0
TERMS = 40
SEED = 17
TEMPERATURE = 0.5
SALTS = 64
_DIGITS = 13


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that is a hash of the parts."""
    return (F.conv(F.substring(_digest(*parts), 1, _DIGITS), 16, 10).cast("double")
            / F.lit(float(16 ** _DIGITS)))


def _digest(*parts: Column | str | int) -> Column:
    text = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *text).cast("binary"))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None,
          temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate): how often a document of the source is wanted on average.

    The rate is null where the source has no character: its documents stay as they are.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length("text")).cast("double").alias("chars"))
    sizes = sizes.withColumn("chars", F.coalesce("chars", F.lit(0.0)))
    if weights is None:
        wanted = F.pow("chars", F.lit(temperature))
    else:
        wanted = F.lit(0.0)
        for name, weight in weights.items():
            wanted = F.when(F.col("source").eqNullSafe(F.lit(name)), float(weight)).otherwise(wanted)
    sizes = sizes.withColumn("wanted", F.when(F.col("chars") > 0, wanted).otherwise(0.0))
    totals = sizes.agg(F.sum("chars").alias("c"), F.sum("wanted").alias("w")).first()
    share = F.col("wanted") / F.lit(totals["w"] or 1.0)
    return sizes.select("source", F.when(
        F.col("chars") > 0, F.lit(totals["c"] or 0.0) * share / F.col("chars")).alias("rate"))


def _tables(rates: DataFrame) -> DataFrame:
    """Adds the number of draws and the distribution function of one draw."""
    ks = F.sequence(F.lit(0), F.lit(TERMS))
    mean = F.col("rate") / F.col("draws")
    term = lambda k: F.aggregate(F.sequence(F.lit(1), k + 1), F.lit(1.0), lambda p, i: F.when(
        i <= k, p * F.col("mean") / i).otherwise(p))
    total = lambda k: F.aggregate(F.slice("terms", 1, k + 1), F.lit(0.0), lambda s, t: s + t)
    return (rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN)).cast("int"))
            .withColumn("mean", mean).withColumn("terms", F.transform(ks, term))
            .withColumn("below", F.transform(ks, lambda k: F.exp(-F.col("mean")) * total(k)))
            .select("source", "rate", "draws", "below"))


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None,
              temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Every document as often as drawn, with ``copy`` (from 1) and ``order_key``, shuffled."""
    columns = [c for c in docs.columns if c not in ("copy", "order_key")]
    tables = write_through(_tables(rates(docs, weights, temperature)))
    tables = tables.select(F.struct("source").alias("_of"), "rate", "draws", "below")
    keyed = docs.select(*columns, F.struct("source").alias("_of"))
    # Spark broadcasts a short table by its size; beyond that, salts spread a hot source.
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = tables.withColumn("_salt", F.explode(salts))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in docs.columns if c in ("doc_id", "text")]), F.lit(SALTS))
    drawn = keyed.withColumn("_salt", salt).join(salted, ["_of", "_salt"])
    of = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    one = lambda j: F.size(F.filter("below", lambda c: c <= uniform(seed, of, j.cast("string"))))
    times = F.when(F.col("rate").isNull(), 1).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda n, j: n + one(j)))
    copies = (drawn.withColumn("_times", times).where("_times > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
              .withColumn("order_key", _digest(seed, of, F.col("copy").cast("string"), "order")))
    return (copies.repartition("order_key", "copy").sortWithinPartitions("order_key")
            .select(*columns, "copy", "order_key"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = f"""
WITH sizes AS (
  SELECT source, CAST(coalesce(sum(length(text)), 0) AS DOUBLE) AS chars
  FROM documents GROUP BY source),
wanted AS (
  SELECT source, chars, CASE WHEN chars > 0 THEN pow(chars, {TEMPERATURE}) ELSE 0.0 END AS w
  FROM sizes),
rates AS (
  SELECT source, CASE WHEN chars > 0
    THEN (SELECT sum(chars) FROM wanted) * (w / (SELECT sum(w) FROM wanted)) / chars
    END AS rate FROM wanted),
draws AS (
  SELECT source, rate, CAST(greatest(1, ceil(rate / {MEAN})) AS INTEGER) AS draws FROM rates),
steps AS (
  SELECT source, draws, rate / draws AS mean, k,
    CASE WHEN k = 0 THEN 1.0 ELSE (
      SELECT product(rate / draws / i) FROM range(1, k + 1) r(i)) END AS term
  FROM draws, range(0, {TERMS + 1}) t(k)),
below AS (
  SELECT source, draws, k, exp(-mean) * sum(term) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM steps),
lists AS (
  SELECT source, draws, list(upto ORDER BY k) AS below FROM below GROUP BY source, draws),
numbers AS (
  SELECT d.*, coalesce(CAST(doc_id AS VARCHAR), 'null') AS of, draws, below,
    rate IS NULL AS once
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source
  JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
times AS (
  SELECT * EXCLUDE (draws, below, once), CASE WHEN once THEN 1 ELSE list_sum(list_transform(range(1, draws + 1), lambda j:
    len(list_filter(below, lambda c: c <= CAST(('0x' || substr(md5('{SEED}:' || of || ':'
      || CAST(j AS VARCHAR)), 1, {_DIGITS})) AS UBIGINT) / {float(16 ** _DIGITS)!r})))) END AS n
  FROM numbers),
copies AS (SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS c FROM times WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(c AS INTEGER) AS copy,
  md5('{SEED}:' || of || ':' || CAST(c AS VARCHAR) || ':order') AS order_key
FROM copies
"""
