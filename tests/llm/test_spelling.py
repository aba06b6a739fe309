"""Spelling variants: generated neighbourhoods and results against a plain
edit distance over all pairs, and the SQL statement."""

import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
from conftest import SF_SMALL
from oracle_compare import compare

from basketflow.llm import queries, spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def plain_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_groups(words, ratio=10):
    by = {w: [v for v in words if v != w and abs(len(v) - len(w)) <= 1 and near(w, v)] for w in words}
    best = {w: min(by[w], key=lambda v: (-words[v], v)) if by[w] else None for w in words}
    form = {w: b if b and words[b] >= ratio * words[w] else None for w, b in best.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(by[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_neighbourhoods_hold_every_near_word():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeàÿ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    words = sorted({*words, "aaaa", "aaa", "aaaaa", "aabaa", "abbb", "abb"})
    for k in (2, 6, 24):
        column = pa.array(words)
        symbols, sums, n = spelling.reduced(column, k)
        own = spelling.mix64(sums[:, -1]).view(np.int64)
        row, code = spelling.neighbourhood(symbols, sums, n, k)
        generated = set(zip(row.tolist(), code.tolist()))
        for i, a in enumerate(words):
            for j, b in enumerate(words[:i]):
                met = (i, own[j]) in generated or (j, own[i]) in generated
                assert met or not near(a, b), (a, b)


def test_words_of_one_length_share_a_batch():
    column = pa.array(["x" * n for n in (7, 300_000, 8, 7, 400_000, 9)])
    parts = [r.tolist() for r in spelling.alike(column)]
    assert sorted(sum(parts, [])) == [0, 1, 2, 3, 4, 5] and [1] in parts and [4] in parts


def corpus(n=60):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefghilmnorstuéü") for _ in range(rng.randint(7, 11))) for _ in range(40)]
    rows = []
    for doc in range(n):
        text = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.12)), 39)]
            if rng.random() < 0.15:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + "x" + w[k:], w[:k] + "Q" + w[k + 1:]])
            text.append(w if rng.random() < 0.8 else w.upper())
        rows.append((doc, " ".join(text), "en", "s", 0))
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    got = spelling.report(cases.docs(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_groups(plain_words(rows))
    assert sum(1 for r in want if r[1]) > 20
    assert rows_of(got) == want


def test_chains_ties_and_one_symbol(spark):
    # a chain of three steps, a tie of forms, and no near word at all
    words = {"abcdefgh": 5000, "abcdefgx": 400, "abcdefyx": 30, "abcdezyx": 2, "mnopqrst": 50, "mnopqrsv": 50,
             "mnopqrsu": 3, "zzzzzzzz": 9, "zzzzzzzzz": 9, "éééééééé": 4, "éééééééè": 40}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.group_variants(df).select("word", "form", "root", "n", "n_near", "form_n")
    want = plain_groups(words)
    assert rows_of(got) == want
    roots = {r[0]: r[2] for r in want}
    assert roots["abcdezyx"] == "abcdefgh" and roots["mnopqrsu"] == "mnopqrst"


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    words = plain_words(corpus())
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    monkeypatch.setattr(spelling.code_filter, "__defaults__", (4096,))
    monkeypatch.setattr(spelling, "symbols_for", lambda n, shortest: 2)  # and words that share reduced words
    got = spelling.group_variants(df).select("word", "form", "root", "n", "n_near", "form_n")
    assert rows_of(got) == plain_groups(words)


def test_awkward_rows(spark):
    long = "y" * 50_000
    rows = [*cases.DOCS, (20, f"{long} {long}z", "en", "s", 1), (21, f"{long} {long}z", "en", "s", 1)]
    got = spelling.report(cases.crowded(cases.docs(spark, rows)))
    assert rows_of(got) == plain_groups(plain_words(rows))
    assert spelling.report(cases.empty(spark)).collect() == []


def test_sql(spark):
    name = "op11_reduced_alphabet"
    found = compare(spark, SF_SMALL, name, queries.queries()[name], queries.oracle_sql()[name])
    assert found["cols_match"] and found["hash_match"], found
