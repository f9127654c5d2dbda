"""Licences named or quoted in whole texts, found by a positional index of rare words.

Base labels come from phrases: every place where a phrase's words stand one after the
other.  The method adds labels of its own from templates, the wordings of licence
notices.  Their postings say at which places a template has a word.  Of each template a
file's ``RARE`` words of highest IDF are looked up; a file word at place i and a posting at place p
agree on the relative position i - p.  Where at least ``AGREE`` of the wanted words agree on
one position, the template may stand there, and it does if all its mandatory key phrases
stand within ``SLACK`` words of that window.  IDF comes from the number of all documents
that hold a word.

The only things on the driver are the templates and the document counts of their words.
Everything else is one expression per row, so no row moves: hot sources, repeated rows,
null ids and rows that share an id make no difference.  Null and empty texts have no
words, no label and score 0; texts of any length are read to their end; an empty
table gives none.  Columns named like a result are replaced, all others kept.
"""

from __future__ import annotations

import json
import math
import string
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RARE = 6
AGREE = 0.75
SLACK = 4

#: Between words: every ASCII character but digits and lower-case letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The phrases that give base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Template:
    """A licence notice in lower-case words, with the phrases it must hold."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def wanted(self) -> int:
        """How many rare words are looked up."""
        return min(RARE, len(set(self.words)))

    @property
    def need(self) -> int:
        """How many of them must agree on one position."""
        return max(2, math.ceil(AGREE * self.wanted))


#: Wordings of common licence notices.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files the software to deal in the software "
             "without restriction", ("permission is hereby granted free of charge",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0",
             ("apache license version 2 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2",
             ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3",
             ("gnu general public license version 3",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms "
             "of the gnu general public license as published by the free software foundation",
             ("gnu general public license", "free software foundation")),
    Template("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public "
             "license as published by the free software foundation",
             ("gnu lesser general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license v 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met",
             ("source and binary forms", "with or without modification")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or "
             "without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
)

RESULTS = "n_words n_base first_word last_word base_labels labels score".split()


def split_words(text: str = "text") -> Column:
    """The words of a text; an empty string at an end stands for what is before or behind."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.split(low, _BETWEEN)


def _vocabulary(templates: Sequence[Template], phrases: Mapping[str, str]) -> list[str]:
    texts = [t.text for t in templates] + [p for t in templates for p in t.phrases] + list(phrases)
    return sorted({w for text in texts for w in text.split()})


def _literals(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def document_counts(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """(word, documents): how many documents hold each word of the vocabulary."""
    held = F.array_intersect(split_words(), _literals(vocabulary))
    return (docs.select(F.explode(held).alias("word")).groupBy("word")
            .agg(F.count("*").alias("documents")))


def _index(templates: Sequence[Template], counts: Mapping[str, int]) -> Column:
    """The templates as an array of structs: words by falling IDF and the places of each."""
    made = []
    for t in templates:
        posts: dict[str, list[int]] = {}
        for at, word in enumerate(t.words):
            posts.setdefault(word, []).append(at)
        made.append({"label": t.label, "words": sorted(posts, key=lambda w: (counts.get(w, 0), w)),
                     "posts": posts, "length": len(t.words), "need": t.need, "wanted": t.wanted,
                     "phrases": list(t.phrases)})
    return F.from_json(F.lit(json.dumps(made)), "array<struct<label: string, words: array<string>, "
                       "posts: map<string, array<int>>, length: int, need: int, wanted: int, "
                       "phrases: array<string>>>")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _places(phrase: str, words: Column) -> Column:
    """Where the phrase's words stand, counted in ``words``."""
    first, *rest = phrase.split()

    def stands(i: Column) -> Column:
        fits = F.get(words, i) == first
        for k, word in enumerate(rest, 1):
            fits = fits & (F.coalesce(F.get(words, i + k), F.lit("")) == word)
        return fits
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)


def _anchors(template: Column, held: Column) -> Column:
    """The file's words of the template with the highest IDF."""
    mine = F.filter(template["words"], lambda w: F.array_contains(held, w))
    return F.slice(mine, F.lit(1), template["wanted"])


def _agreement(template: Column, words: Column, held: Column, where: Column) -> Column:
    """The largest share of wanted words that agree at a place where the template stands."""
    def shares(anchors: Column) -> Column:
        mine = F.filter(where, lambda i: F.array_contains(anchors, F.get(words, i)))
        # relative position and number of the word in one long
        votes = F.flatten(F.transform(mine, lambda i: F.transform(
            template["posts"][F.get(words, i)],
            lambda p: (i - p).cast("long") * 64 + F.array_position(anchors, F.get(words, i)) - 1)))
        return _bound(F.sort_array(F.transform(F.array_distinct(votes),
                                               lambda v: F.shiftright(v, 6).cast("int"))), best)

    def best(spots: Column) -> Column:
        enough = F.array_distinct(F.filter(
            spots, lambda s, k: F.get(spots, k + template["need"] - 1) == s))
        fits = F.filter(enough, lambda s: F.forall(template["phrases"], lambda p: F.contains(
            _window(template, words, s), F.concat(F.lit(" "), p, F.lit(" ")))))
        agree = F.transform(fits, lambda s: F.size(F.filter(spots, lambda x: x == s)))
        return F.coalesce(F.array_max(agree) / template["wanted"], F.lit(0.0))
    return _bound(_anchors(template, held), shares)


def _window(template: Column, words: Column, spot: Column) -> Column:
    start = F.greatest(spot - SLACK, F.lit(0))
    part = F.slice(words, start + 1, template["length"] + 2 * SLACK)
    return F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" "))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
         phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Adds the columns of RESULTS to every row of ``docs``, which has ``text``.

    ``first_word`` and ``last_word`` are the first and last place of a base phrase.  ``score``
    is 1 where there is one, else the largest share of rare words that agree for a
    template that is verified, else 0.
    """
    vocabulary = _vocabulary(templates, phrases)
    counts = {r["word"]: r["documents"] for r in document_counts(docs, vocabulary).collect()}
    index = _index(templates, counts)
    kept = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(*kept, split_words().alias("_words"))
    rows = rows.select("*", F.array_intersect("_words", _literals(vocabulary)).alias("_held"))

    words, held = F.col("_words"), F.col("_held")
    before = (F.get(words, F.lit(0)) == "").cast("int")
    behind = ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
    of_phrase = {p: F.when(F.array_contains(held, p.split()[0]) & F.array_contains(held, p.split()[-1]),
                           _places(p, words)).otherwise(F.array().cast("array<int>")) for p in phrases}
    base = F.array(*[F.struct(F.lit(label).alias("label"), of_phrase[p].alias("places"))
                     for p, label in phrases.items()])
    likely = F.filter(index, lambda t: F.size(_anchors(t, held)) >= t["need"])
    licence = F.filter(F.sequence(F.lit(0), F.size(words) - 1),
                       lambda i: F.array_contains(held, F.get(words, i)))
    judged = _bound(licence, lambda where: F.transform(F.col("_likely"), lambda t: F.struct(
        t["label"].alias("label"), _agreement(t, words, held, where).alias("share"))))
    rows = rows.select("*", base.alias("_base"), likely.alias("_likely"))
    rows = rows.select(
        "*", F.flatten(F.transform("_base", lambda b: b["places"])).alias("_places"),
        F.transform(F.filter("_base", lambda b: F.size(b["places"]) > 0),
                    lambda b: b["label"]).alias("_named"),
        F.when(F.size("_likely") > 0, F.filter(judged, lambda t: t["share"] > 0))
        .otherwise(F.array().cast("array<struct<label: string, share: double>>")).alias("_found"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    best = F.array_max(F.transform("_found", lambda t: t["share"]))
    return rows.select(
        *kept, (F.size(words) - before - behind).cast("long").alias("n_words"),
        F.size("_places").cast("long").alias("n_base"),
        (F.array_min("_places") - before).cast("long").alias("first_word"),
        (F.array_max("_places") - before).cast("long").alias("last_word"),
        listed(F.col("_named")).alias("base_labels"),
        listed(F.concat("_named", F.transform("_found", lambda t: t["label"]))).alias("labels"),
        F.when(F.size("_places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", *RESULTS)


def _values(rows: Sequence[str]) -> str:
    return ", ".join(f"({r})" for r in rows)


def _list(items: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


OP12_SQL = f"""
WITH phrases(label, p) AS (VALUES {_values([f"'{k}', {_list(p.split())}" for p, k in PHRASES.items()])}),
templates(t, label, tw, need, wanted, must) AS (VALUES {_values([
    f"{i}, '{t.label}', {_list(t.words)}, {t.need}, {t.wanted}, {_list(t.phrases)}"
    for i, t in enumerate(TEMPLATES)])}),
texts AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words FROM documents),
posts AS (SELECT t, unnest(tw) AS w, unnest(range(len(tw))) AS place FROM templates),
vocabulary AS (SELECT DISTINCT w FROM posts UNION SELECT DISTINCT unnest(p) FROM phrases),
tokens AS MATERIALIZED (SELECT doc_id, w, i FROM (SELECT doc_id, unnest(words) AS w,
    unnest(range(len(words))) AS i FROM texts) WHERE w IN (SELECT w FROM vocabulary)),
counts AS (SELECT w, COUNT(DISTINCT doc_id) AS documents FROM tokens GROUP BY w),
base AS (SELECT doc_id, label, i FROM phrases, tokens JOIN texts USING (doc_id)
  WHERE w = p[1] AND words[i + 1 : i + len(p)] = p),
held AS (SELECT DISTINCT doc_id, t, w, documents FROM tokens JOIN posts USING (w) JOIN counts USING (w)),
anchors AS (SELECT doc_id, t, w FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, t
    ORDER BY documents, w) AS k FROM held) JOIN templates USING (t) WHERE k <= wanted),
spots AS (SELECT doc_id, t, i - place AS spot, COUNT(DISTINCT w) AS agree
  FROM anchors JOIN tokens USING (doc_id, w) JOIN posts USING (t, w) GROUP BY ALL),
verified AS (SELECT doc_id, label, agree / CAST(wanted AS DOUBLE) AS share
  FROM spots JOIN templates USING (t) JOIN texts USING (doc_id)
  WHERE agree >= need AND list_bool_and(list_transform(must, lambda m: contains(' ' || array_to_string(
    words[greatest(spot - {SLACK}, 0) + 1 : greatest(spot - {SLACK}, 0) + len(tw) + {2 * SLACK}], ' ')
    || ' ', ' ' || m || ' ')))),
named AS (SELECT doc_id, COUNT(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT * FROM verified UNION ALL SELECT doc_id, label, 1.0 FROM base) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN named USING (doc_id) LEFT JOIN every USING (doc_id)
"""
