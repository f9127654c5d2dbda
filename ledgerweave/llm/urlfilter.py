"""URL verdicts: explicit rules first, gradient-boosted trees on lexical features otherwise.

A rule is (allow or block, host/path).  It fits its host and all subdomains if the URL's
path starts with the rule's path; the longest that fits wins.  Other URLs get the
verdict of boosted trees over length, depth, digit ratio, entropy, parameter counts and
the allow rates of host suffixes and first folders among labelled URLs.  Trees
are fitted on about ``SAMPLE_ROWS`` distinct labelled URLs, chosen by a hash, so that
no URL fills the sample however often it is repeated.

A null URL or one without ``://`` has an empty host and path and fits no rule.  Repeated
rows are judged alike.  With no labelled URL the verdict is ``allow``; with one kind of
label it is that label.  Columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerweave.llm import words
from ledgerweave.sources.shared import write_through

SAMPLE_ROWS = 20_000
TREES, DEPTH = 10, 4
PRIOR = 5.0

#: Verdict, host and path prefix of each rule of the registered query.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
FEATURES = ("length depth digits letters_up entropy params host_length labels hyphens "
            "has_query has_fragment").split()
SUFFIXES = ("top", "domain", "folder")


def host_of(url: str) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")


def ruled(urls: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """Adds host, path, rule and the rule's verdict; both are null where no rule fits."""
    out = urls.withColumns({"host": host_of(url), "path": path_of(url)})
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return out.withColumns({"rule": rule, "verdict": verdict})


def _entropy(text: pa.Array) -> pa.Array:
    """Bits per byte of each text."""
    data, at = words.text_array(text)
    n = len(at) - 1
    row = np.repeat(np.arange(n), np.diff(at))
    out = np.zeros(n)
    for a in range(0, n, 4096):      # a table of 4,096 x 256 counts at a time
        b = min(n, a + 4096)
        some = slice(at[a], at[b])
        count = np.bincount((row[some] - a) * 256 + data[some], minlength=(b - a) * 256)
        count = count.reshape(b - a, 256)
        share = count / np.maximum(1, count.sum(axis=1, keepdims=True))
        out[a:b] = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    return pa.array(out)


def _lexical(urls: DataFrame, url: str) -> DataFrame:
    """The features of FEATURES as ``_f_`` columns and the suffix keys as ``_k_`` columns."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.lit(1), F.length(u))
    count = lambda c, of=u: F.length(of) - F.length(F.translate(of, c, ""))
    values = [F.length(u), count("/", F.col("path")), count(string.digits) / n,
              count(string.ascii_uppercase) / n, F.arrow_udf(_entropy, "double")(F.col(url)),
              F.when(u.contains("?"), 1 + count("&")).otherwise(0), F.length("host"),
              count(".", F.col("host")) + 1, count("-"), u.contains("?"), u.contains("#")]
    keys = {"top": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2),
            "folder": F.regexp_extract("path", r"^/([^/]*)", 1)}
    return urls.withColumns({f"_f_{k}": v.cast("double") for k, v in zip(FEATURES, values)}
                            ).withColumns({f"_k_{k}": keys[k] for k in SUFFIXES})


def _with_rates(rows: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    """Adds the allow rate of each suffix; ``stats`` has no more rows than the sample has keys."""
    for k in SUFFIXES:
        mine = stats.where(F.col("kind") == k).select(
            F.col("key").alias(f"_k_{k}"), F.col("rate").alias(f"_f_{k}_rate"))
        rows = rows.join(F.broadcast(mine), f"_k_{k}", "left").withColumn(
            f"_f_{k}_rate", F.coalesce(f"_f_{k}_rate", F.lit(prior)))
    return rows


def judge(urls: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]],
          url: str = "url", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All rows with host, path, rule and verdict.

    ``labelled`` has (url, label) with the labels allow and block; other labels are not used.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    known = (labelled.where("url is not null and label in ('allow', 'block')")
             .select("url", (F.col("label") == "allow").cast("double").alias("_label"))
             .distinct())
    total = known.count()
    if total > sample_rows:       # distinct, so their hashes spread evenly
        known = known.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30))
                            < int((1 << 30) * sample_rows / total))
    base = ruled(known, []).drop("rule", "verdict")
    sample = write_through(_lexical(base, "url").coalesce(4))
    share = sample.agg(F.avg("_label")).first()[0]
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    out = ruled(urls.select(keep), rules, url)
    if share is None or share in (0.0, 1.0):
        only = "block" if share == 0.0 else "allow"
        return out.withColumn("verdict", F.coalesce("verdict", F.lit(only)))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_k_{k}").alias("key"))
                                for k in SUFFIXES])).alias("s")
    stats = write_through(sample.select(kinds, "_label").groupBy("s.kind", "s.key").agg(
        ((F.sum("_label") + PRIOR * share) / (F.count("*") + PRIOR)).alias("rate")))
    names = [f"_f_{k}" for k in FEATURES] + [f"_f_{k}_rate" for k in SUFFIXES]
    vector = VectorAssembler(inputCols=names, outputCol="_features")
    model = GBTClassifier(featuresCol="_features", labelCol="_label", predictionCol="_allow", maxIter=TREES,
                          maxDepth=DEPTH, seed=7)
    fitted = model.fit(vector.transform(write_through(_with_rates(sample, stats, share).coalesce(2))))
    fitted.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    scored = fitted.transform(vector.transform(_with_rates(_lexical(out, url), stats, share)))
    method = F.when(F.col("_allow") > 0.5, "allow").otherwise("block")
    return (scored.withColumn("verdict", F.coalesce("verdict", method))
            .select(*keep, "host", "path", "rule", "verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages; the pages that a rule decides are the labelled URLs."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labelled = ruled(pages, RULES).where("verdict is not null").select(
        "url", F.col("verdict").alias("label"))
    return judge(pages, labelled, RULES).select("page_id", "host", "path", "rule", "verdict")
