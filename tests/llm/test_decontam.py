import random

import numpy as np
import pytest
from cases import DOCS, crowded, docs, empty
from conftest import SF_SMALL
from oracle_compare import compare

from basketflow.llm import decontam, queries

WORD = __import__("re").compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window=13):
    w = words_of(text)
    hit, names, phrases = set(), set(), {}
    for name, item in items:
        v = words_of(item)
        k = min(window, len(v))
        for i in range(len(v) - k + 1 if k else 0):
            phrases.setdefault(tuple(v[i:i + k]), set()).add(str(name))
    for k in {len(p) for p in phrases}:
        for j in range(len(w) - k + 1):
            if found := phrases.get(tuple(w[j:j + k])):
                hit.update(range(j, j + k))
                names |= found
    return len(w), len(hit), sorted(names)


def items_df(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def rows_of(found):
    return [(r.n_words, sum(s.end_word - s.start_word for s in r.spans), list(r["items"])) for r in found.collect()]


def test_fm_index_against_plain_search():
    rng = np.random.default_rng(0)
    for alphabet in (2, 3, 40):
        text = rng.integers(1, alphabet, 400)
        text[rng.integers(0, 400, 20)] = 0
        text[[0, -1]] = 0
        index = decontam.FMIndex(text, alphabet)
        for size in (1, 2, 5):
            pats = np.array([text[i:i + size] for i in range(400 - size) if (text[i:i + size] > 0).all()])
            lo, hi = index.search(pats, np.full(len(pats), size))
            for p, a, b in zip(pats, lo, hi):
                want = [i for i in range(401 - size) if (text[i:i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_matches_sql(spark):
    name = "op4_fm_decontamination"
    r = compare(spark, SF_SMALL, name, queries.queries()[name], queries.oracle_sql()[name])
    assert r["cols_match"] and r["hash_match"]


ITEMS = [(10, "the quick brown fox jumps over the lazy dog and runs away from the big"), (2, "Chien paresseux"),
         (3, None), (None, "lorem"), (4, "..."), (5, "ipsum dolor sit amet lorem ipsum dolor sit amet lorem ipsum dolor sit amet")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_awkward_rows_against_brute_force(spark, block_bytes):
    items = [i for i in ITEMS if i[0] is not None]
    found = decontam.contamination_spans(crowded(docs(spark)), items_df(spark, ITEMS), block_bytes=block_bytes)
    got = {(r.doc_id, r.text): (r.n_words, sum(s.end_word - s.start_word for s in r.spans), list(r["items"]))
           for r in found.collect()}
    assert found.count() == len(DOCS)
    for row in DOCS:
        if row[0] != 5:
            assert got[row[0], row[1]] == brute(row[1], items), row
    # All but the first word and the last stand in a window.
    assert got[5, DOCS[4][1]] == (45001, 44999, ["5"])


def test_random_texts_against_brute_force(spark):
    random.seed(5)
    vocab = ["a", "bb", "Cc", "dé", "e1"]
    texts = [(i, " ".join(random.choices(vocab, k=random.randint(0, 60))), None, None, None) for i in range(80)]
    items = [(i, " ".join(random.choices(vocab, k=random.randint(1, 7)))) for i in range(12)]
    found = decontam.contamination_spans(docs(spark, texts).coalesce(1), items_df(spark, items), window=4)
    assert rows_of(found) == [brute(t[1], items, 4) for t in texts]


def test_spans_are_cut_out(spark):
    rows = [(1, "Keep this. Chien, PARESSEUX! And that ü chien paresseux", None, None, None), (2, "nothing", None, None, None)]
    found = decontam.contamination_spans(docs(spark, rows), items_df(spark, [(2, "chien paresseux")]))
    got = {r.doc_id: r.t for r in found.select("doc_id", decontam.without_spans().alias("t")).collect()}
    assert got == {1: "Keep this. ! And that ü ", 2: "nothing"}


def test_empty_tables(spark):
    assert decontam.report(empty(spark), items_df(spark, ITEMS)).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontam.report(docs(spark), none).collect()} == {0}
