"""License scan: TF-IDF cosine to templates, inherited along directories.

Every line of a text (a header) and the whole text (a licence file) are
compared with licence templates by the cosine of sparse TF-IDF vectors.  There
are two collections, each with weights of its own: ``TEMPLATES``, one notice a
licence, with the document frequency of lines, and ``full_forms()``, other
notices and full licence texts, with that of whole texts and 1 + ln(tf) for tf, so a text
is not close to a long licence by "the" and "of".

A document takes the best of its lines and its whole text; a document that is a
licence file as a whole also covers its directory, and documents without a
licence of their own inherit from the nearest ancestor directory that has one.

Terms are runs of a-z and 0-9 after lower-casing A-Z.  The document frequency
of a term is the number of lines (texts) of the corpus that hold it; words that
no template of the collection holds weigh like a term that no line holds.

A line reaches the threshold only with a key term of a template: the terms of
least weight whose squares sum to less than the squared threshold are not
enough (Cauchy-Schwarz).  So texts are first searched for key terms, and only
those that hold one are taken apart: an exact filter.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from functools import cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.common import stored, work_folder

THRESHOLD = 0.6

# Notices of public licences, by SPDX id.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose is hereby granted."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_NC, _ND, _SA = "NonCommercial", "NoDerivatives", "ShareAlike"
_CC = {"": "Attribution", "-NC": f"Attribution-{_NC}", "-ND": f"Attribution-{_ND}", "-SA": f"Attribution-{_SA}",
       "-NC-ND": f"Attribution-{_NC}-{_ND}", "-NC-SA": f"Attribution-{_NC}-{_SA}"}
_FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licences")


@cache
def full_forms() -> list[tuple[str, str]]:
    """Other notices of the same and more licences, and the full texts of the
    folder ``licences``; a licence may have several."""
    forms = [
        ("CC-BY-4.0", "Licensed under CC BY 4.0."),
        ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
        ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
        ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
        ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
        ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
        ("ISC", "Released under the ISC License."),
        ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
        ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
        ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
        ("Unlicense", "Released under the Unlicense."),
        ("Zlib", "Released under the zlib License."),
    ]
    forms += [(f"CC-BY{k}-4.0", f"This work is licensed under a Creative Commons {v} 4.0 International License.")
              for k, v in _CC.items() if k]
    for name in sorted(os.listdir(_FOLDER)):
        with open(os.path.join(_FOLDER, name), encoding="utf-8") as f:
            forms.append((name.removesuffix(".txt"), f.read()))
    return forms


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER)))


def _words(line) -> F.Column:
    return F.filter(F.split(F.translate(line, _UPPER, _LOWER), "[^a-z0-9]+"), lambda w: w != "")


def _idf(n_lines: int, held: int) -> float:
    return math.log((1 + n_lines) / (1 + held)) + 1


class Weights:
    """IDF of the template terms, unit template vectors and key terms."""

    def __init__(self, templates: list[tuple[str, str]], n_lines: int, held: dict[str, int], threshold: float,
                 damped: bool = False):
        """``damped``: 1 + ln(tf) for tf."""
        terms = [(name, _terms(text)) for name, text in templates]
        self.damped = damped
        self.idf = {t: _idf(n_lines, held.get(t, 0)) for _, ts in terms for t in ts}
        self.other = _idf(n_lines, 0)
        self.vectors: list[tuple[str, dict[str, float]]] = []
        key: set[str] = set()
        for name, ts in terms:
            v = {t: (1 + math.log(n) if damped else n) * self.idf[t] for t, n in Counter(ts).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            v = {t: x / norm for t, x in v.items()}
            self.vectors.append((name, v))
            room = threshold ** 2 * (1 - 1e-9)
            # Any order is exact; terms common in the corpus first leave rare key terms.
            for t, x in sorted(v.items(), key=lambda p: (1000 * held.get(p[0], 0) <= n_lines, p[1], p[0])):
                room -= x * x
                if room <= 0:
                    key.add(t)
        self.key_terms = sorted(key)

    def tf(self, column: str) -> F.Column:
        return 1 + F.log(column) if self.damped else F.col(column)


def line_statistics(docs: DataFrame, vocabulary: list[str], text_col: str) -> tuple[int, dict[str, int]]:
    """(lines with a word, lines that hold each term) over all texts."""
    words = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).select(_words("line").alias("w"))
    vocab = F.array(*map(F.lit, vocabulary))
    # The empty string stands for the line itself.
    rows = words.where(F.size("w") > 0).select(
        F.explode(F.concat(F.array_intersect("w", vocab), F.array(F.lit("")))).alias("term"))
    held = {r.term: r["count"] for r in rows.groupBy("term").count().collect()}  # at most one row per term
    return held.pop("", 0), held


def text_statistics(docs: DataFrame, vocabulary: list[str], text_col: str) -> tuple[int, dict[str, int]]:
    """(texts with a word, texts that hold each term); a vocabulary too long
    for an array per row is joined."""
    terms = docs.sparkSession.createDataFrame([(t,) for t in ["", *vocabulary]], "term string")
    words = docs.select(_words(text_col).alias("w")).where(F.size("w") > 0)
    rows = words.select(F.explode(F.concat(F.array_distinct("w"), F.array(F.lit("")))).alias("term"))
    held = {r.term: r["count"] for r in rows.join(F.broadcast(terms), "term").groupBy("term").count().collect()}
    return held.pop("", 0), held


def similarities(docs: DataFrame, weights: Weights, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(id, unit, license, similarity) of the lines (unit 0 up) and whole
    texts (unit -1) that reach the threshold."""
    spark = docs.sparkSession
    if len(weights.key_terms) > 100:
        holds_key = F.arrays_overlap(_words(text_col), F.array(*map(F.lit, weights.key_terms)))
    else:
        holds_key = F.translate(text_col, _UPPER, _LOWER).rlike("(^|[^a-z0-9])(" + "|".join(weights.key_terms) + ")([^a-z0-9]|$)")
    hit = docs.where(holds_key & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Rows that repeat an id are texts of their own, equal rows one text that
    # counts as often as it stands there.  The texts move once; all that follows
    # is worked out where they are.
    hit = hit.groupBy("id", F.xxhash64("text").alias("t")).agg(F.first("text").alias("text"), F.count("*").alias("m"))
    whole = F.array(F.struct(F.lit(-1).alias("unit"), _words("text").alias("words")))
    lines = F.transform(F.split("text", "\n"), lambda line, k: F.struct(k.alias("unit"), _words(line).alias("words")))
    units = (hit.select("id", "t", "m", F.inline(F.concat(whole, lines)))
             .where(F.exists("words", lambda w: w.isin(weights.key_terms))))
    counts = _term_counts(units, "words").select("id", "t", "unit", "term", (F.col("n") * F.col("m")).alias("tf"))
    # Every template term stands in the table once for the norm and once for each
    # template that holds it; other terms count for the norm alone.
    rows = [(t, None, None, x, None) for t, x in sorted(weights.idf.items())]
    rows += [(t, k, name, weights.idf[t], v[t]) for k, (name, v) in enumerate(weights.vectors) for t in v]
    table = spark.createDataFrame(rows, "term string, template int, license string, idf double, weight double")
    tf = weights.tf("tf")
    part = (F.when(F.col("template").isNotNull(), tf * F.col("idf") * F.col("weight"))
            .when(F.col("idf").isNull(), tf * weights.other ** 2).otherwise((tf * F.col("idf")) ** 2))
    sums = (counts.join(F.broadcast(table), "term", "left")
            .groupBy("id", "t", "unit", "template", "license").agg(F.sum(part).alias("total")))
    squares = F.max(F.when(F.col("template").isNull(), F.col("total"))).over(Window.partitionBy("id", "t", "unit"))
    return (sums.withColumn("norm", F.sqrt(squares)).where(F.col("template").isNotNull())
            .select("id", "unit", "license", (F.col("total") / F.col("norm")).alias("similarity"))
            .where(F.col("similarity") >= threshold))


def _term_counts(rows: DataFrame, words: str) -> DataFrame:
    """``rows`` with a row for each different (term, n) of their ``words``."""
    sorted_rows = rows.withColumn("_sorted", F.sort_array(words)).drop(words)
    word = F.col("_sorted")
    first = sorted_rows.withColumn("_first", F.filter(  # places at which a term begins
        F.sequence(F.lit(0), F.size(word) - 1), lambda k: (k == 0) | (F.get(word, k) != F.get(word, k - 1))))
    end = lambda k: F.coalesce(F.get(F.col("_first"), k + 1), F.size(word))
    return first.select(*[c for c in rows.columns if c != words], F.inline(F.transform(
        "_first", lambda at, k: F.struct(F.get(word, at).alias("term"), (end(k) - at).alias("n")))))


def _best(rows: DataFrame, *key: str) -> DataFrame:
    """Highest similarity per key (rounded, so ties are ties), then the
    smaller licence id."""
    best = F.min(F.struct((-F.round("similarity", 6)).alias("s"), "license")).alias("best")
    return rows.groupBy(*key).agg(best).select(*key, (-F.col("best.s")).alias("similarity"),
                                               F.col("best.license").alias("license"))


def _parent(path: F.Column) -> F.Column:
    """The directory of a path; the root is the empty string."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(docs: DataFrame, path: F.Column, id_col: str = "doc_id", text_col: str = "text",
         templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
         folder: str | None = None, forms: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per document: ``id_col``, ``license`` (null: none found),
    ``similarity`` (rounded to 6 digits; null if none), ``origin`` (own,
    inherited or none) and ``licence_dir`` (the directory it came from).

    Null, empty and wordless texts have no licence of their own; a null path
    is the root directory; rows with a null id only inherit.  Among a
    directory's licence files the most similar counts, ties by licence id.  Rows that repeat an id share
    the best licence of their texts.  Other columns play no part.
    ``templates`` alone leave out ``full_forms()``."""
    folder = folder or work_folder(docs.sparkSession, "license")
    forms = forms if forms is not None else [] if templates else full_forms()
    templates = templates or TEMPLATES
    vocabulary = sorted({t for _, text in templates for t in _terms(text)})
    weights = Weights(templates, *line_statistics(docs, vocabulary, text_col), threshold)
    found = similarities(docs, weights, threshold, id_col, text_col)
    if forms:
        vocabulary = sorted({t for _, text in forms for t in _terms(text)})
        weights = Weights(forms, *text_statistics(docs, vocabulary, text_col), threshold, damped=True)
        found = found.union(similarities(docs, weights, threshold, id_col, text_col))
    found = stored(found, f"{folder}/found")
    own = _best(found, "id")
    files = _best(found.where("unit = -1"), "id")
    rows = docs.select(F.col(id_col).alias("id"), _parent(F.coalesce(path.cast("string"), F.lit(""))).alias("dir"))
    # Licence files by directory, and for every directory the nearest of its
    # ancestors (itself first) that has one.
    held = _best(files.join(rows, "id"), "dir").select(F.col("dir").alias("up"), "similarity", "license")
    dirs = rows.select("dir").distinct()
    parts = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.concat(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
        F.array(F.lit("")))).alias("up")).distinct()
    nearest = ups.join(held, "up").groupBy("dir").agg(
        F.max(F.struct(F.length("up").alias("n"), "up", "license", "similarity")).alias("near"))
    given = nearest.select("dir", F.col("near.up").alias("from_dir"), F.col("near.license").alias("dir_license"),
                           F.col("near.similarity").alias("dir_similarity"))
    return (rows.join(own, "id", "left").join(given, "dir", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("license", "dir_license").alias("license"),
        F.coalesce("similarity", "dir_similarity").alias("similarity"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited")
         .otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("licence_dir")))


def report(docs: DataFrame) -> DataFrame:
    """Licences of all documents (``op5``); a document's path is its source
    and id."""
    return scan(docs, F.concat_ws("/", "source", F.col("doc_id").cast("string")))
