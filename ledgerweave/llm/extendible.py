"""Shards of bounded bytes by extendible hashing.

A document's hash is the first 60 bits of the MD5 of its id.  The directory is a set of
hash prefixes: a bucket holds the documents with its prefix, and only a bucket over the
byte limit is split on one more bit, until all fit.  A bucket of one hash value (one
document, or rows that share an id) cannot be split; it is cut into overflow shards at the
limit, in the order of row digests, and only a single row over the limit makes a larger
shard.

The directory comes from counts per prefix of ``LEVEL`` bits, summed up over all shorter
prefixes; buckets that are still too large there are counted again on the next
bits, so no step gathers documents.  Null and empty texts have 0 bytes; a null id is
hashed as ``null``.  Empty input gives no rows.  Columns named ``shard``, ``depth`` and
``n_bytes`` are replaced, all others kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerweave.sources.shared import write_through

BITS = 60
LEVEL = 12
LIMIT = 64 << 20


def hashed(doc_id: str) -> Column:
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column | int) -> Column:
    """The first bits of ``_hash`` as a number; Spark shifts by columns only in SQL."""
    return F.expr(f"shiftright(_hash, {BITS} - {bits})")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix): the buckets for rows of (_hash, n_bytes)."""
    found, left = None, rows.withColumn("_base", F.lit(0).cast("long"))
    for top in range(0, BITS, LEVEL):
        low = min(BITS, top + LEVEL)
        cells = write_through(left.groupBy(_prefix(low).alias("cell"))
                              .agg(F.sum("n_bytes").alias("b")))
        levels = F.explode(F.sequence(F.lit(0 if top == 0 else top + 1), F.lit(low)))
        sums = (cells.withColumn("depth", levels)
                .groupBy("depth", F.expr(f"shiftright(cell, {low} - depth)").alias("prefix"))
                .agg(F.sum("b").alias("b")))
        fits = (F.col("b") <= limit) | (F.col("depth") == BITS)
        # the shortest prefix that fits: its parent does not, and so no shorter one does
        parent = sums.where(F.col("b") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_up"))
        first = sums.where(fits).withColumn("_up", F.expr("shiftright(prefix, 1)"))
        root = F.col("depth") == (0 if top == 0 else top + 1)
        new = write_through(first.where(root).select("depth", "prefix").union(
            first.where(~root).join(parent, ["depth", "_up"], "left_semi")
            .select("depth", "prefix")))
        found = new if found is None else found.union(new)
        large = cells.where(F.col("b") > limit).select("cell")
        if low == BITS or large.isEmpty():
            break
        left = left.withColumn("cell", _prefix(low)).join(large, "cell", "left_semi").drop("cell")
    return found


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All rows with ``shard`` (prefix bits, and ``+n`` for overflow), ``depth``, ``n_bytes``."""
    columns = [c for c in docs.columns if c not in ("shard", "depth", "n_bytes")]
    keyed = docs.select(*columns, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
                        .alias("n_bytes"), hashed("doc_id").alias("_hash"))
    light = keyed.select("_hash", "n_bytes")
    buckets = write_through(directory(light, limit))
    depths = buckets.select("depth").distinct().orderBy("depth").collect()   # at most BITS + 1
    at = F.explode(F.array(*[F.lit(r["depth"]) for r in depths] or [F.lit(0)]))
    ids = write_through(light.groupBy("_hash").agg(F.sum("n_bytes").alias("_b"))
                        .withColumn("depth", at).withColumn("prefix", _prefix("depth"))
                        .join(buckets, ["depth", "prefix"]).select("_hash", "depth", "_b"))
    name = F.when(F.col("depth") == 0, "").otherwise(F.expr(
        f"substring(lpad(bin(_hash), {BITS}, '0'), 1, depth)"))
    if ids.where(F.col("_b") > limit).isEmpty():
        placed = keyed.join(ids, "_hash").withColumn("shard", name)
        return placed.select(*columns, "shard", "depth", "n_bytes")
    # a hash value over the limit: rows over half of it alone, the others by running bytes
    placed = keyed.withColumn("_t", F.xxhash64("text")).join(ids, "_hash").withColumn("shard", name)
    large, order = F.col("n_bytes") * 2 > limit, Window.partitionBy("_hash").orderBy("_t")
    over = placed.where(F.col("_b") > limit)
    before = F.coalesce(F.sum("n_bytes").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    alone = over.where(large).withColumn("shard", F.concat(
        "shard", F.lit("+row"), F.row_number().over(order).cast("string")))
    cut = over.where(~large).withColumn("shard", F.concat(
        "shard", F.lit("+"), F.floor(before * 2 / limit).cast("string")))
    return (placed.where(F.col("_b") <= limit).unionByName(alone).unionByName(cut)
            .select(*columns, "shard", "depth", "n_bytes"))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Writes a folder per shard, each by one task."""
    placed = shards(docs, limit)
    placed.repartition("shard").write.partitionBy("shard").parquet(path)


def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shards(docs, OP4_LIMIT).select("doc_id", "shard", "depth", "n_bytes")


OP4_LIMIT = 1 << 20

OP4_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, CAST(('0x' || substr(md5(
    coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, {BITS // 4})) AS BIGINT) AS h FROM documents),
buckets AS (
  SELECT depth, h >> ({BITS} - depth) AS prefix, sum(n_bytes) AS b
  FROM docs, range(0, {BITS + 1}) t(depth) GROUP BY ALL),
fits AS (
  SELECT doc_id, h, n_bytes, min(depth) AS depth
  FROM (SELECT row_number() OVER () AS r, * FROM docs) d JOIN buckets
  ON prefix = h >> ({BITS} - depth) AND (b <= {OP4_LIMIT} OR depth = {BITS})
  GROUP BY r, doc_id, h, n_bytes)
SELECT doc_id, substr(lpad(bin(h), {BITS}, '0'), 1, CAST(depth AS INTEGER)) AS shard,
  CAST(depth AS INTEGER) AS depth, CAST(n_bytes AS BIGINT) AS n_bytes
FROM fits
"""
