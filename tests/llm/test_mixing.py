"""Pivotal rounding of copies: targets against plain Python, words kept by
every trade, one residual a source, reruns."""

import re

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, cycle=(1, 2, 3), cap=3):
    """Water filling by the statement: share, stop, reshare."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    held = set()
    while True:
        free = sum(w for s, w in weight.items() if s not in held)
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in held)
        share = {s: cap * sizes[s] if s in held else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in held and share[s] > cap * sizes[s]}
        if not above:
            return share
        held |= above


def corpus(spark, n=900):
    """A hot source, a tiny one that hits the cap, a null one, a long text."""
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else None if i % 7 == 1 else f"s{i % 5}"
        rows.append((i, " ".join(["w"] * (1 + (i * 37) % 90)), "en", source, 0))
    rows += [(n, "one two", "en", "a-tiny", 0), (n + 1, "w " * 3000, "en", "s1", 0), (n + 2, None, "en", "s2", 0),
             (n + 3, "", "en", "empty", 0)]
    return cases.docs(spark, rows), rows


def test_trade_keeps_words_and_leaves_one():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 50, 400):
        size = np.sort(rng.integers(0, 500, n))[::-1]
        p = rng.random(n)
        got = mixing.trade(size, p, rng, False)
        open_ = (got > 0) & (got < 1)
        assert open_.sum() <= 1
        assert np.dot(size, got) == pytest.approx(np.dot(size, p), abs=1e-4)
        assert ((mixing.trade(size, p, rng, True) % 1) == 0).all()


def test_trade_keeps_expected_copies():
    size, p = np.array([90, 40, 40, 7, 3]), np.array([.2, .5, .9, .4, .3])
    rng = np.random.default_rng(1)
    mean = np.mean([mixing.trade(size, p, rng, False) for _ in range(20000)], axis=0)
    assert np.abs(mean - p).max() < 0.02


def test_mix_against_plain_targets(spark):
    docs, rows = corpus(spark)
    got = {r.doc_id: r for r in mixing.report(docs).collect()}
    assert set(got) == {r[0] for r in rows}
    sizes, longest, taken = {}, {}, {}
    for i, text, _, source, _ in rows:
        n = words(text)
        assert got[i].size == n
        sizes[source] = sizes.get(source, 0) + n
        longest[source] = max(longest.get(source, 0), n)
        taken[source] = taken.get(source, 0) + got[i].taken
        assert got[i].taken in (0, n, 2 * n, 3 * n)
    want = plain_targets(sizes)
    assert want["a-tiny"] == 6 and taken["a-tiny"] == 6  # the cap
    for i, _, _, source, _ in rows:
        assert got[i].source_size == sizes[source]
        assert got[i].target == pytest.approx(want[source])
    for source, target in want.items():
        assert abs(taken[source] - target) <= longest[source]  # less than one document
    assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.05)


def test_tree_of_small_blocks_and_reruns(spark):
    docs, rows = corpus(spark)
    mixed = mixing.mix(docs, block_rows=8)
    first = sorted(map(tuple, mixed.select("id", "copies", "source", "size", "target").collect()))
    by = {}
    for i, c, s, n, t in first:
        by.setdefault((s, t), []).append((n, c))
    for (s, t), found in by.items():
        assert abs(sum(n * c for n, c in found) - t) <= max(n for n, _ in found)
    again = mixing.mix(docs.repartition(13, F.rand(3)), block_rows=8)
    assert first == sorted(map(tuple, again.select("id", "copies", "source", "size", "target").collect()))
    other = mixing.mix(docs, block_rows=8, seed=9)
    assert first != sorted(map(tuple, other.select("id", "copies", "source", "size", "target").collect()))


def test_given_weights(spark):
    docs, rows = corpus(spark)
    weights = spark.createDataFrame([("hot", 1.0), ("s1", 1.0)], "source string, weight double")
    by = {r.source: r for r in mixing.mix(docs, weights).groupBy("source")
          .agg(F.max("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    total = sum(words(r[1]) for r in rows)
    assert by["hot"].target + by["s1"].target == pytest.approx(total)
    assert by["s2"].target == 0 and by["s2"].taken == 0
    assert by[None].taken == 0


def test_awkward_rows(spark):
    docs = cases.crowded(cases.docs(spark))
    got = mixing.report(docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    rows = got.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in cases.DOCS)
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
    assert {r["size"] for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.report(cases.empty(spark)).collect() == []
    big = 2 ** 60 + 7  # ids beside a null one keep all their digits
    one = mixing.report(cases.docs(spark, [(big, "a b c", "en", "s", 5), (None, "a b", "en", "s", 3)])).collect()
    assert {r.doc_id for r in one} == {big, None}


def test_repeated_rows_share_the_copies(spark, monkeypatch):
    rows = [(1, "same words here", "en", "s", 0)] * 50 + [(2, "w " * 400, "en", "t", 0)] * 2
    docs = cases.docs(spark, rows)
    counts = {}
    monkeypatch.setattr(mixing, "SPREAD", 16)  # several tasks write the rows of one unit
    for r in mixing.report(docs).collect():
        counts.setdefault(r.doc_id, []).append(r.taken)
    assert len(counts[1]) == 50 and len(counts[2]) == 2
    assert max(counts[1]) - min(counts[1]) <= 3  # one copy apart


def test_take_gives_the_texts(spark):
    docs, _ = corpus(spark, 120)
    mixed = mixing.mix(docs)
    got = mixing.take(docs, mixed)
    assert got.columns == [*docs.columns, "copy"]
    want = {r.id: r.copies for r in mixed.collect() if r.copies}
    have = {}
    for r in got.collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + 1
    assert have == want
