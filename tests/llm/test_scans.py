import hashlib
import math
import random

from cases import DOCS, crowded, docs, empty
from conftest import SF_SMALL
from oracle_compare import compare
from pyspark.sql import functions as F

from basketflow.llm import license_scan, queries, secret_forest


def hexes(k, n=40):
    return hashlib.sha512(str(k).encode()).hexdigest()[:n]


def corpus():
    rng = random.Random(1)
    words = ["alpha", "benefit", "consider", "different", "everything", "following", "government", "however"]
    rows, planted = [], {}
    for k in range(120):
        body = [" ".join(rng.choices(words, k=12)) for _ in range(3)]
        if k % 3 == 0:
            planted[k] = hexes(k)
            body.insert(1, f'my token = "{planted[k]}" {rng.choice(words)}')
        if k % 4 == 0:
            body.append(f"mail {words[k % 8]}.{k % 100}@mail{k % 9}.example.com and {10 ** 15 + k}")
        rows.append((k, "\n".join(body), "en", "src/a" if k % 2 else "src/test", None))
    return rows, planted


def test_forest_finds_planted_secrets_and_spares_the_rest(spark):
    rows, planted = corpus()
    frame = docs(spark, rows)
    found = secret_forest.scan(frame, path_col="source").cache()
    text = {r[0]: r[1] for r in rows}
    got = found.collect()
    assert all(text[r.id][r.start:r.end] == r.candidate for r in got)
    assert {(r.id, r.candidate) for r in got if r.is_secret} == set(planted.items())
    masked = {r.doc_id: r.text for r in secret_forest.redact(frame, found).collect()}
    assert masked == {k: t.replace(planted[k], secret_forest.MASK) if k in planted else t for k, t in text.items()}


def test_scan_is_native(spark):
    frame = queries.queries()["op3_secret_forest"](spark, SF_SMALL)
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secret_scan_of_awkward_rows(spark):
    frame = crowded(docs(spark)).withColumn("text", F.when(F.col("doc_id") == 1, F.concat(
        F.lit('api_key: "'), F.lit(hexes(5)), F.lit('" x '), F.col("text"), F.lit(' token="'), F.lit(hexes(6)))).otherwise(
        F.col("text")))
    found = secret_forest.scan(frame)
    assert {(r.id, r.candidate) for r in found.collect()} == {(1, hexes(5)), (1, hexes(6))}
    out = secret_forest.redact(frame, found.withColumn("is_secret", F.lit(True)))
    assert out.columns == frame.columns and out.count() == len(DOCS)
    assert out.where("doc_id = 1").first().text.count(secret_forest.MASK) == 2
    assert secret_forest.scan(empty(spark)).count() == 0


def test_secrets_of_rows_without_an_id_or_with_a_repeated_one_are_masked(spark):
    rows = [(i, f'{"x " * k}api_key: "{hexes(k)}" end', None, None, None) for k, i in enumerate((None, None, 7, 7))]
    frame = docs(spark, rows)
    out = secret_forest.redact(frame, secret_forest.scan(frame)).collect()
    wanted = [(i, f'{"x " * k}api_key: "{secret_forest.MASK}" end') for k, i in enumerate((None, None, 7, 7))]
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted((i or 0, t) for i, t in wanted)


def test_labels_of_one_class_need_no_forest(spark):
    rows = [(1, f'password = "{hexes(1)}"', None, None, None), (2, f"sha {hexes(2)} here", None, None, None)]
    found = {r.candidate: r.is_secret for r in secret_forest.scan(docs(spark, rows)).collect()}
    assert found == {hexes(1): True, hexes(2): False}


def test_licences_match_sql(spark):
    name = "op5_license_tfidf"
    r = compare(spark, SF_SMALL, name, queries.queries()[name], queries.oracle_sql()[name])
    assert r["cols_match"] and r["hash_match"]


def test_nearest_ancestor_directory(spark):
    mit = "Released under the MIT License."
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [(1, mit, "a/LICENSE"), (2, "some code here", "a/x.py"), (3, "more code", "a/b/c/y.py"),
            (4, apache, "a/b/LICENSE"), (5, "deep code", "a/b/c/d/z.py"), (6, "other text", "q/r.py"),
            (7, f"code of my own\n{mit.upper()}\nand so on and on", "a/b/own.py"), (8, "top", None), (9, "root", "top.txt")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r.doc_id: (r.license, r.origin, r.licence_dir) for r in license_scan.scan(frame, F.col("path")).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "inherited", "a/b"),
                   4: ("Apache-2.0", "own", None), 5: ("Apache-2.0", "inherited", "a/b"), 6: (None, "none", None),
                   7: ("MIT", "own", None), 8: (None, "none", None), 9: (None, "none", None)}
    root = frame.withColumn("path", F.when(F.col("doc_id") == 1, F.lit("LICENSE")).otherwise(F.col("path")))
    got = {r.doc_id: (r.license, r.licence_dir) for r in license_scan.scan(root, F.col("path")).collect()}
    assert got[6] == got[8] == got[9] == ("MIT", "") and got[3] == ("Apache-2.0", "a/b")


def test_every_licence_line_of_the_documents_is_found(spark):
    kinds = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    wanted = {}
    for r in table.where(F.col("text").rlike("(?i)licen[cs]e")).collect():
        lines = {line for line in r.text.split("\n") if "icense" in line}
        assert lines <= set(kinds)
        wanted[r.doc_id] = {kinds[line] for line in lines}
    assert set().union(*wanted.values()) == set(kinds.values())
    got = {r.doc_id: r for r in license_scan.report(table).collect()}
    assert all(got[i].origin == "own" and got[i].license in names for i, names in wanted.items())


def test_full_texts_and_wrapped_notices_are_own_and_cover_their_directory(spark):
    full = {name: text for name, text in license_scan.full_forms() if len(text) > 500}
    rows = [(k, f"Copyright (c) 2019 A. Person\n\n{text}", f"{name}/LICENSE") for k, (name, text) in enumerate(full.items())]
    rows += [(100 + k, "some code here", f"{name}/x.py") for k, name in enumerate(full)]
    rows += [(200, "Licensed under\nthe Apache License,\nVersion 2.0.", "wrapped/NOTICE"),
             (201, "Licensed under CC BY 4.0.", "short/NOTICE"), (202, "the of and to the the a of the", "prose/a.txt")]
    rows += [(300 + k, f"the story of a house number {k} and the road to it", "prose/b.txt") for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r.doc_id: (r.license, r.origin) for r in license_scan.scan(frame, F.col("path")).collect()}
    for k, name in enumerate(full):
        assert got[k] == (name, "own") and got[100 + k] == (name, "inherited")
    assert got[200] == ("Apache-2.0", "own") and got[201] == ("CC-BY-4.0", "own")
    assert {got[i] for i in (202, *range(300, 600))} == {(None, "none")}


def test_licences_of_awkward_rows(spark):
    frame = crowded(docs(spark))
    rows = license_scan.scan(frame, F.col("source")).collect()
    assert len(rows) == len(DOCS) and {r.origin for r in rows} == {"none"}
    assert license_scan.report(empty(spark)).count() == 0
    plan = license_scan.report(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_texts_of_candidates_move_once_and_their_terms_never(spark):
    rows = [(k, f"line {k} of it\nReleased under the MIT License.\nand the end", "en", "a", None) for k in range(40)]
    frame = docs(spark, rows + rows[:7])
    for templates, damped in ((license_scan.TEMPLATES, False), (license_scan.full_forms(), True)):
        weights = license_scan.Weights(templates, 100, {"the": 40, "of": 40}, 0.6, damped)
        found = license_scan.similarities(frame, weights, 0.6, "doc_id", "text")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        # Against plain sums; equal rows count as often as they stand there.
        wanted = set()
        for i, text, *_ in rows:
            for unit, part in [(-1, text), *enumerate(text.split("\n"))]:
                terms = license_scan._terms(part)
                m = 2 if i < 7 else 1
                tf = {t: 1 + math.log(m * terms.count(t)) if damped else m * terms.count(t) for t in terms}
                norm = math.sqrt(sum((n * weights.idf[t]) ** 2 if t in weights.idf else n * weights.other ** 2
                                     for t, n in tf.items()))
                for name, vector in weights.vectors:
                    near = sum(tf.get(t, 0) * weights.idf[t] * x for t, x in vector.items()) / norm
                    if near >= 0.6:
                        wanted.add((i, unit, name, round(near, 9)))
        assert {(r.id, r.unit, r.license, round(r.similarity, 9)) for r in found.collect()} == wanted and wanted
