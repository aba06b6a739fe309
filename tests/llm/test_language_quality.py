import tracemalloc

import numpy as np
import pytest
from cases import DOCS, crowded, docs, empty
from pyspark.sql import functions as F

from basketflow.llm import common, cotrain, langid, queries
from basketflow.llm.linear import gram_bins, row_counts, row_means

SF = "/root/testdata/sf0.01"


def test_gram_means_are_the_product_of_counts_and_weights():
    data = np.frombuffer("abc de éé zz".encode(), np.uint8)
    offs = np.array([0, 0, 5, 6, len(data)])
    bins = gram_bins(data, offs, np.arange(256, dtype=np.uint8), 3, 64)
    w = np.random.default_rng(0).standard_normal((64, 3)).astype(np.float32)
    assert np.allclose(row_counts(bins, offs, 64) @ w, row_means(w, bins, offs), atol=1e-6)
    again = gram_bins(data[:5], np.array([0, 5]), np.arange(256, dtype=np.uint8), 3, 64)
    assert (again == bins[:5]).all()  # grams don't look into the next row


def test_codewords_are_apart():
    for n in range(2, 12):
        c = langid.codewords(n)
        apart = min((c[a] != c[b]).sum() for a in range(n) for b in range(a))
        assert apart >= 2 ** (n - 2) if n <= 6 else apart >= 5


def test_held_out_accuracy(spark):
    found = queries.queries()["op2_output_codes"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [r for r in rows if r.held_out]
    assert 0.1 < len(held) / len(rows) < 0.3
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    decoder = langid.fit(known)
    got = {(r.doc_id, r.text): r for r in langid.predict(crowded(docs(spark)), decoder).collect()}
    assert [got[i, t].lang_pred for i, t, *_ in DOCS if i in (2, 3, 4, 7)] == ["und"] * 4
    assert all(got[i, t].score == 0 for i, t, *_ in DOCS if i in (2, 3, 4, 7))
    assert got[9, DOCS[9][1]].lang_pred != "und"
    assert langid.report(empty(spark)).count() == 0
    # No labels: no language is known; one label: it is the only answer.
    none = langid.report(docs(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    one = langid.report(docs(spark).withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in one.collect()} == {"und", "en"}


def test_ambiguous_is_flagged(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("lang in ('en', 'fr')")
    half = {r.lang: r.text for r in known.where("length(text) between 900 and 1100").collect()}
    mixed = spark.createDataFrame([(k, half["en"][:k] + " " + half["fr"][:800 - k]) for k in range(100, 800, 20)],
                                  "doc_id long, text string")
    p = langid.predict(mixed, langid.fit(known)).collect()
    assert {"en", "fr"} == {r.lang_pred for r in p}
    sure = [r for r in p if not r.ambiguous]
    assert all(r.score >= 0.6 for r in sure)


def test_quality_scores_follow_the_labels(spark):
    found = queries.queries()["op9_cotraining"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.25
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_views_teach_each_other():
    """The metadata view sees no labelled row that tells; it learns from the
    rows that the text view is sure of."""
    rng = np.random.default_rng(0)
    n = 2000
    truth = rng.integers(0, 2, n)
    text = np.stack((truth + 0.05 * rng.standard_normal(n), 1 - truth + 0.05 * rng.standard_normal(n)), 1).astype(np.float32)
    meta = np.zeros((n, 4), np.float32)
    meta[np.arange(n), truth] = 1
    meta[:200] = [0, 0, 1, 0]  # the labelled rows have metadata of their own
    label = np.where(np.arange(n) < 200, truth, -1)
    views = cotrain.cotrain(text, meta, label, ["m"])
    margin = views.meta.margins(meta[200:])[:, 0]
    assert ((margin > 0) == (truth[200:] > 0)).mean() > 0.95


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (7, 0), (8, 1), (8, None), (None, 1), (6, 0), (99, 1)],
                                   "doc_id long, quality int")
    frame = crowded(docs(spark))
    views = cotrain.fit(frame, labels, ["source", "lang", "n_chars"])
    rows = cotrain.score(frame, views).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.quality_score <= 1 for r in rows)
    none = cotrain.score(frame, cotrain.fit(frame, labels.where("quality = 1"), ["source"])).collect()
    assert all(r.kept and r.quality_score is None for r in none)
    assert cotrain.score(empty(spark), views).count() == 0
    assert cotrain.fit(empty(spark), labels, ["source"]) is None


@pytest.mark.parametrize("meta", [[], ["lang"]])
def test_few_metadata(spark, meta):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    frame = docs(spark)
    assert cotrain.score(frame, cotrain.fit(frame, labels, meta)).count() == len(DOCS)


def test_every_unlabelled_document_teaches(spark):
    """A metadata value that no labelled document and only the last of many
    unlabelled ones carry is learnt from what their texts say."""
    good = "The committee has read the report and found that the river was clean in spring. "
    bad = "buy now !!! click click click $$$ win win win 1234 5678 "
    rows = [(k, (good if k % 2 else bad) * (3 + k % 4), "en", "known", 0) for k in range(120)]
    rows += [(1000 + k, (good if k % 2 else bad) * (2 + k % 5), "en", "known", 0) for k in range(2200)]
    rows += [(9000 + k, (good if k % 2 else bad) * (2 + k % 5), "en", "fine" if k % 2 else "spam", 0) for k in range(400)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)], "doc_id long, quality int")
    frame = docs(spark, rows)
    views = cotrain.fit(frame, labels, ["source"])

    def margins(views):  # the labelled rows tell the metadata view nothing, so its calibration is flat
        return views.meta.margins(cotrain.meta_features([("fine",), ("spam",)], ["m0"]))[:, 0]

    fine, spam = margins(views)
    assert fine > spam + 1
    fine, spam = margins(cotrain.fit(frame.where("doc_id < 9000"), labels, ["source"]))
    assert abs(fine - spam) < 1e-3  # without those documents the values tell nothing
    again = cotrain.fit(frame.repartition(5), labels, ["source"])
    assert np.allclose(again.text.weights, views.text.weights, atol=1e-3)


def test_a_repeated_id_counts_once(spark):
    rows = [(1, f"text {k}", "en", "s", 0) for k in range(500)] + [(k, "words of all kinds", "en", "t", 0) for k in range(2, 40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)], "doc_id long, quality int")
    frame = docs(spark, rows)
    assert cotrain.score(frame, cotrain.fit(frame, labels, ["source"])).count() == len(rows)


def test_scores_against_a_plain_version(spark):
    """Every document's score worked out row by row from the same weights."""
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    meta = ["source", "lang", "n_chars"]
    views = cotrain.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels, meta)
    for r in cotrain.score(frame, views).collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        at = np.array([0, len(data)])
        x = cotrain._text_features(data, at)
        m = cotrain.meta_features([(r.source, r.lang, r.n_chars)], ["m0", "m1", "m2"])
        t, o, s = views.scores(views.text.margins(x)[:, 0], views.meta.margins(m)[:, 0])
        assert np.allclose([r.text_score, r.meta_score, r.quality_score], [t[0], o[0], s[0]], atol=1e-4)


def test_sums_of_sure_rows_make_no_matrix_of_all_rows():
    """Sums as of dense features, in a memory that follows the texts: many
    short rows took 12 bytes a row and feature, half a gigabyte here."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    rng = np.random.default_rng(5)
    texts = ["", "a", " ", "a\n\nb\r\na\n", "A a A\ta", None, "é\x00!"]
    texts += [" ".join(rng.choice(["river", "win", "$$$", "1234", "Été"], 8)) for _ in range(20000)]
    lang = [["en", "fr", None][k % 3] for k in range(len(texts))]
    n_chars = [None if t is None else len(t) for t in texts]
    group = rng.integers(0, cotrain.GROUPS, len(texts)).astype(np.int32)

    def view(width):
        w = rng.standard_normal((width, 1)).astype(np.float32)
        return SimpleNamespace(weights=w, bias=np.zeros(1, np.float32), margins=lambda x: x @ w)

    views = [(view(w), (20.0, 0.0)) for w in cotrain.WIDTHS]
    batch = pa.RecordBatch.from_pydict({"text": texts, "m0": lang, "m1": n_chars, "group": group})
    list(cotrain.words(np.zeros(1 << 20, np.uint8), np.array([0, 1 << 20]), cotrain._SPACES))  # its tables stay
    tracemalloc.start()
    found = cotrain.judged([batch], views, ["m0", "m1"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    x = cotrain._text_features(*cotrain.text_buffer(pa.array(texts)))
    m = cotrain.meta_features(list(zip(lang, n_chars)), ["m0", "m1"])
    classes = cotrain.confident(views, [v.margins(f)[:, 0] for (v, _), f in zip(views, (x, m))])
    for v, f in enumerate((x, m)):
        assert 0 < (classes[v] >= 0).sum()
        for c in (0, 1):
            for g in range(cotrain.GROUPS):
                at = (classes[v] == c) & (group == g)
                assert abs(found.n[v, c, g] - at.sum()) <= 1  # a margin may lie on the bound
                if found.n[v, c, g] == at.sum():
                    assert np.allclose(found.x[v][c, g], f[at].sum(0, dtype=float), atol=1e-2)


def test_words_of_a_chunk_take_little_memory_and_are_the_same_in_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.choice(np.frombuffer(b"abcdefgXYZ  \n\xc3", np.uint8), common.CHUNK_BYTES)
    cuts = np.sort(rng.integers(0, len(data), 900))
    offs = np.concatenate(([0, 0], cuts, cuts[-3:-1], [len(data)]))
    offs.sort()
    table = common.byte_table(" \n")
    monkeypatch.setattr(common, "_POWERS", {})
    tracemalloc.start()
    found = common.words(data, offs, table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20  # powers and sums of the whole chunk took more than twice as much
    monkeypatch.setattr(common, "WORD_BYTES", len(data))
    whole = common.words(data, offs, table)
    assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(found, whole))
