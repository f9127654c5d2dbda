"""A training corpus from raw documents: five stages, each a table that the next one reads.

language ID -> near-dedup -> benchmark decontamination -> mixing sources -> token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of documents.  Null texts and texts without a letter go at the first stage; a
document with a null id links with nothing and stays.  Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerweave.llm import cgk, hyperminhash, langid, poisson, wavelet
from ledgerweave.sources.shared import shared_dir, write_through


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets ``lang`` to the predicted language; documents without one (``und``) go."""
    judged = langid.predict(docs, langid.fit(docs))
    kept = judged.where(F.col("lang_pred") != langid.UNDETERMINED)
    return kept.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8) stays.

    Of rows with one id, the one whose text has the smallest digest stays.
    """
    gone = hyperminhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    left = docs.join(write_through(gone), "doc_id", "left_anti").select(docs.columns)
    repeated = write_through(docs.where("doc_id is not null").groupBy("doc_id").count()
                             .where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return left
    one = (left.join(repeated, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("row"))
           .groupBy("row.doc_id").agg(F.min_by("row", F.struct(
               F.md5("row.text"), F.xxhash64("row"))).alias("row")).select("row.*"))
    return left.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit distance go."""
    return cgk.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by drawn counts and shuffled."""
    return poisson.replicate(docs).select(docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet-matrix files in the order of ``docs``; returns their index."""
    path = shared_dir(spark)
    wavelet.write_tokens(docs, path, order=False)
    return wavelet.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]

#: The stages are models, sketches and files, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir))
    return docs
