import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import ann, queries

SF = "/root/testdata/sf0.01"


def brute(rows, asks, k):
    """{query: [(id, score)]} over clean rows [(id, vector)]."""
    out = {}
    for q, v in rows:
        if asks(q):
            scored = sorted((-float((np.array(v) * np.array(x)).sum()), i) for i, x in rows if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def by_query(found, column="vec_id"):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r[column], r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in
            spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = by_query(queries.queries()["op1_multiprobe_hashing"](spark, SF))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want)
    vec = dict(rows)
    hits = 0
    for q, found in got.items():
        assert q not in dict(found)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
        for i, s in found:
            assert s == pytest.approx(float((np.array(vec[q]) * np.array(vec[i])).sum()), abs=1e-12)
        hits += len(set(dict(found)) & set(dict(want[q])))
    assert hits / sum(map(len, want.values())) >= 0.9


def test_norms_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(8) * rng.choice([0.1, 1, 5])).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies, above k
    rows += [(7, rows[7][1])]  # a row twice
    bad = [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [1.0] * 7), (2004, [float("inf")] * 8),
           (2005, [None] + [1.0] * 7), (None, [1.0] * 8)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>") \
        .withColumn("id", F.lit("clash")).withColumn("vec", F.lit(1)).withColumn("key", F.lit(2))
    asks = lambda q: q % 10 == 0
    want = brute(sorted(dict(rows).items()), asks, 5)
    for block in (16_384, 16):  # whole buckets, and buckets split into blocks
        got = by_query(ann.nearest(frame, F.col("vec_id") % 10 == 0, k=5, block_rows=block))
        assert set(got) == set(want)
        same = sum(len(set(dict(got[q])) & set(dict(want[q]))) for q in want)
        assert same / sum(map(len, want.values())) >= 0.9
        # The copies come in order of their ids.
        for found in got.values():
            ids = [i for i, _ in found if i == 7 or 1000 <= i < 1060]
            assert ids == sorted(ids)


def test_probe_order_is_by_score():
    rng = np.random.default_rng(0)
    f = rng.random(4)
    probes = ann.probe_order(f, 81)
    cost = [sum((f[j] if s < 0 else 1 - f[j]) ** 2 for j, s in p) for p in probes]
    assert len({tuple(sorted(p)) for p in probes}) == 81  # all of 3^4, each once
    assert cost == sorted(cost)


def test_few_rows_and_none(spark):
    two = spark.createDataFrame([(0, [1.0, 2.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert by_query(ann.report(two)) == {0: [(3, 4.0)]}
    assert ann.report(two.where("vec_id < 0")).count() == 0
    assert ann.report(two.where("vec_id = 0")).count() == 0


def test_longest_vectors_outside_the_sample(spark, monkeypatch):
    """Four vectors twenty times as long as the others, which the fit's sample
    doesn't hold: recall stays, and every query gets its 20 rows."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    long = 20 * x[:4] / 1.0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001 + 2 * i, v.tolist()) for i, v in enumerate(long)]
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 256)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(ann.nearest(frame, F.col("vec_id") % 20 == 0))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want) and all(len(f) == 20 for f in got.values())
    same = sum(len(set(dict(got[q])) & set(dict(want[q]))) for q in want)
    assert same / (20 * len(want)) >= 0.9


def test_short_answers_are_finished_exactly(spark, monkeypatch):
    """Tables that find next to nothing: all answers come from the exact pass."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows + rows[:3], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "fit", lambda sample, *_: ann.Hashes(6, 24, 4.0, 12, 7))
    monkeypatch.setattr(ann, "ASK_ROWS", 4)  # several blocks
    monkeypatch.setattr(ann, "WIDTH", 0.05)
    got = by_query(ann.report(frame))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}


def test_answers_of_a_query_do_not_grow_with_the_number_of_groups(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((4096, 16)).astype(np.float32))]
    made, best_of = [], ann._nearest_of

    def counted(answers, k):
        made.append(answers.count())
        return best_of(answers, k)

    monkeypatch.setattr(ann, "_nearest_of", counted)
    answers, found = {}, {}
    for block in (16_384, 64):  # one group a table, and 64
        made.clear()
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        found[block] = by_query(ann.nearest(frame, F.col("vec_id") % 100 == 0, k=10, block_rows=block))
        answers[block] = sum(made)
    # The same rows; four rounds with some 3 * k distinct answers each.
    assert found[64] == found[16_384]
    assert answers[64] < 6 * answers[16_384]
