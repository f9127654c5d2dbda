"""Language of whole texts: the family first, then one against one within the family.

Every classifier is a linear support vector machine (squared hinge, L2) over the
frequencies of hashed letter trigrams.  A linear score of frequencies is a mean of
weights over the text, so prediction gathers weights along the bytes and needs no
feature vectors.  The model is fitted on a bounded, hash-ordered sample
(``sample_rows`` in all); everything else is done for every row.

Null text, text without a letter and an empty training set give ``und`` with score
0.  Null ``lang`` rows are not learned from.  Repeated rows are judged alike, other
columns are kept, and a text of any length is read to its end.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerweave.llm import words
from ledgerweave.llm.memory import handing_back_each
from ledgerweave.sources.shared import write_through

UNDETERMINED = "und"
SAMPLE_ROWS = 1600
BITS = 12
BUCKETS = 1 << BITS

#: Languages by family; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "turkic": "tr az kk ky uz tk tt",
    "uralic": "fi et hu",
    "semitic": "ar he am mt",
    "indic": "hi ur bn pa gu mr ne",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
    "sinitic": "zh yue wuu",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

# ASCII letters in lower case and all bytes of other scripts stay, the rest is a blank.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True
_FOLD = np.where(_LETTER[words.LOWER], words.LOWER, 0x20).astype(np.uint32)


def trigram_buckets(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at each byte; BUCKETS where none starts or its middle is blank."""
    fold = _FOLD[data]
    out = np.full(len(data), BUCKETS, dtype=np.int32)
    if len(data) < 3:
        return out
    key = fold[:-2] | (fold[1:-1] << np.uint32(8)) | (fold[2:] << np.uint32(16))
    out[:-2] = (key * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    out[:-2][fold[1:-1] == 0x20] = BUCKETS
    full = at[1:][at[1:] > at[:-1]]
    out[full - 1] = BUCKETS
    out[np.maximum(full - 2, 0)] = BUCKETS
    return out


def _frequencies(text: pa.Array) -> pa.Array:
    """The trigram frequencies of each text as float32 bytes."""
    out = []
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    for _, data, at in words.blocks(iter([batch]), "text"):
        buckets = trigram_buckets(data, at)
        for a, b in itertools.pairwise(at):
            counts = np.bincount(buckets[a:b], minlength=BUCKETS + 1)[:BUCKETS]
            out.append((counts / max(1, counts.sum())).astype(np.float32).tobytes())
    return pa.array(out, pa.binary())


def _fit_svm(x: np.ndarray, positive: np.ndarray, rounds: int = 150, strength: float = 1e-4
             ) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the squared hinge loss, by accelerated gradients."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    share = share.astype(np.float32)
    spread = x.std(axis=0) + 1e-4
    z = x / spread
    step = 1.0 / (2.0 * float(np.einsum('i,ij,ij->', share, z, z)) + 2.0 + strength)
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    b = c = 0.0
    for k in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (z @ v + c)) * y * share
        w_next = v + step * (2.0 * (slack @ z) - strength * v)
        b_next = c + step * 2.0 * float(slack.sum())
        pull = k / (k + 3.0)
        v, c = w_next + pull * (w_next - w), b_next + pull * (b_next - b)
        w, b = w_next, b_next
    return (w / spread).astype(np.float32), float(b)


@dataclass
class Model:
    """Languages, their families, and one weight row and bias per classifier."""

    families: list[str]
    languages: list[list[str]]       # by family
    weights: np.ndarray              # families (when over one), then the pairs of each family
    bias: np.ndarray

    def margins(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        buckets = trigram_buckets(data, at)
        total = np.zeros(len(data) + 1)

        def sums(weights: np.ndarray) -> np.ndarray:
            np.cumsum(weights[buckets], out=total[1:])
            return total[at[1:]] - total[at[:-1]]
        counted = np.ones(BUCKETS + 1)
        counted[BUCKETS] = 0
        n = np.maximum(1.0, sums(counted))
        out = np.empty((len(self.bias), len(at) - 1))
        for k, (row, bias) in enumerate(zip(self.weights, self.bias)):
            out[k] = sums(np.append(row, np.float32(0))) / n + bias
        return out

    def decide(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each text.  Votes first, then the sum of the margins."""
        n = margins.shape[1]
        sure = lambda m: 1.0 / (1.0 + np.exp(-2.0 * np.clip(m, -30, 30)))
        k = len(self.families) if len(self.families) > 1 else 0
        family = margins[:k].argmax(axis=0) if k else np.zeros(n, dtype=int)
        score = sure(margins[:k].max(axis=0)) if k else np.ones(n)
        lang = np.empty(n, dtype=object)
        for f, codes in enumerate(self.languages):
            votes = np.zeros((len(codes), n))
            weakest = np.full((len(codes), n), np.inf)
            for i, j in itertools.combinations(range(len(codes)), 2):
                m = margins[k]
                k += 1
                squashed = np.tanh(m) / (4.0 * len(codes))
                votes[i] += (m >= 0) + squashed
                votes[j] += (m < 0) - squashed
                weakest[i], weakest[j] = np.minimum(weakest[i], m), np.minimum(weakest[j], -m)
            best = votes.argmax(axis=0)
            mine = family == f
            lang[mine] = np.array(codes, dtype=object)[best[mine]]
            if len(codes) > 1:
                score[mine] *= sure(weakest[best, np.arange(n)])[mine]
        return lang.tolist(), score


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts, shared evenly among the languages, in hash order."""
    ids = docs.where("lang is not null and text is not null and doc_id is not null")
    counts = write_through(ids.groupBy("lang").count())
    each = max(1, rows // max(1, counts.count()))
    order = Window.partitionBy("lang").orderBy("key", "doc_id")
    some = F.pmod("key", F.greatest(F.lit(1), F.expr(f"count div {4 * each}"))) == 0
    chosen = (ids.select("lang", "doc_id", F.xxhash64("doc_id").alias("key"))
              .join(counts, "lang").where(some)        # about 4 * each ids of a language
              .withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= each))
    return ids.join(F.broadcast(chosen.select("lang", "doc_id").distinct()),
                    ["lang", "doc_id"], "left_semi")


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from ``text`` and ``lang`` of at most ``rows`` rows of ``docs``."""
    vector = F.arrow_udf(handing_back_each(_frequencies), "binary")
    got = (training_sample(docs, rows).where(has_letter("text")).limit(2 * rows)
           .select("lang", vector("text").alias("x")).collect())
    labels = np.array([r["lang"] for r in got], dtype=object)
    x = np.empty((len(got), BUCKETS), dtype=np.float32)
    for i, r in enumerate(got):
        x[i] = np.frombuffer(r["x"], dtype=np.float32)
    del got
    names: dict[str, list[str]] = {}
    for code in sorted(set(labels)):
        names.setdefault(FAMILY_OF.get(code, code), []).append(code)
    families = sorted(names)
    of = np.array([FAMILY_OF.get(code, code) for code in labels], dtype=object)
    made = [_fit_svm(x, of == f) for f in families] if len(families) > 1 else []
    for f in families:
        for one, other in itertools.combinations(names[f], 2):
            both = (labels == one) | (labels == other)
            made.append(_fit_svm(x[both], labels[both] == one))
    return Model(families, [names[f] for f in families],
                 np.array([w for w, _ in made], dtype=np.float32).reshape(-1, BUCKETS),
                 np.array([b for _, b in made]))


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row; columns so named are replaced.

    A text is judged once, also where a filter on the result follows: Spark would repeat a
    deterministic function below the filter, in a second Python worker of each task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if not model.families:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})

    def judge(text: pa.Array) -> pa.Array:
        names, scores = [], []
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        for _, data, at in words.blocks(iter([batch]), "text"):
            lang, score = shared.value.decide(shared.value.margins(data, at))
            names += lang
            scores.append(score)
        score = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)],
                                          ["lang", "score"])

    once = F.arrow_udf(handing_back_each(judge), "lang string, score double").asNondeterministic()
    found = once(F.col("text"))
    judged = docs.withColumn("_judged", F.struct(found.alias("v"), has_letter("text").alias("ok")))
    return judged.withColumns({
        "lang_pred": F.when(F.col("_judged.ok"), F.col("_judged.v.lang"))
        .otherwise(UNDETERMINED),
        "score": F.when(F.col("_judged.ok"), F.col("_judged.v.score")).otherwise(0.0),
    }).drop("_judged")


def held_out(doc_id: str, folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id as text falls into the fold; rows without an id do."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(True))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out("doc_id")))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"))
