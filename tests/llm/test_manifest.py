"""Merkle manifest: places against a plain postorder, proofs against a plain
tree, and the SQL statement."""

import hashlib
import zlib

import cases
import pytest
from conftest import SF_SMALL
from oracle_compare import compare
from pyspark.sql import functions as F

from basketflow.llm import manifest, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_levels(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k:k + 2])) for k in range(0, len(last), 2)])
    return levels


def plain_postorder(n):
    """(level, index) of all nodes of a tree in order of completion."""
    top = manifest.height(n)
    out = []

    def visit(level, index):
        if level:
            for child in (2 * index, 2 * index + 1):
                if child << (level - 1) < n:
                    visit(level - 1, child)
        out.append((level, index))

    visit(top, 0)
    return out


def plain_leaf(doc_id, text, lang, source, n_chars):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(field, (doc_id, source, lang, n_chars, text))))


def plain_manifest(rows):
    """doc_id -> sorted digest rows of the contract."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[g] = plain_levels([plain_leaf(*r) for r in groups[g]])
    top = plain_levels([trees[g][-1][0] for g in order])
    root = top[-1][0]
    out = []
    for t, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = []
            for levels, k in ((trees[g], i), (top, t)):
                for level in levels[:-1]:
                    steps.append((k & 1, level[k ^ 1] if k ^ 1 < len(level) else ""))
                    k >>= 1
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            acc = plain_leaf(*r[:4], r[4] + 1) if hit else plain_leaf(*r)
            for odd, s in steps:
                acc = sha(s + acc if odd else acc + s)
            out.append((r[0], plain_leaf(*r), trees[g][-1][0], root, sha("".join(s for _, s in steps)), acc, acc == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_places_are_a_postorder():
    for n in [*range(1, 70), 127, 128, 129, 1000]:
        for at, (level, index) in enumerate(plain_postorder(n)):
            assert manifest.place(level, index, n) == at
        assert manifest.subtree(manifest.height(n), n) == len(plain_postorder(n))


def test_builder_writes_in_that_order():
    for n in (1, 2, 3, 5, 8, 13, 64, 100):
        leaves = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
        levels = plain_levels([d.hex() for d in leaves])
        log = manifest.complete(leaves, manifest.height(n))
        for at, (level, index) in enumerate(plain_postorder(n)):
            assert log[32 * at:32 * at + 32].hex() == levels[level][index]


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_against_a_plain_tree(spark, levels):
    rows = [(k, f"text {k}", ("en", "fr", None, "de")[k % 4] if k % 9 else "en", f"s{k % 3}", None if k % 5 == 0 else k)
            for k in range(83)]
    got = manifest.report(cases.docs(spark, rows).repartition(5), levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain_manifest(rows)
    assert rows_of(got) == want
    assert {r[-1] for r in want} == {True, False}


def test_log_holds_every_node_once_in_order(spark):
    rows = [(k, f"text {k}", "en" if k % 3 else "fr", "s", k) for k in range(60)]
    digest = manifest.leaf_digest([F.col(c) for c in manifest.FIELDS])
    made = manifest.build(cases.docs(spark, rows), digest, levels=2)
    entries = manifest.log_entries(made.groups, 2).collect()
    for tree, n in (("=en", 40), ("=fr", 20)):
        mine = sorted((r.place, r.level, r.position, bytes(r.digest).hex()) for r in entries if r.tree == tree)
        leaves = sorted((r for r in rows if f"={r[2]}" == tree), key=lambda r: r[0])
        levels = plain_levels([plain_leaf(*r) for r in leaves])
        assert [(p, lv, k) for p, lv, k, _ in mine] == [(p, lv, k) for p, (lv, k) in enumerate(plain_postorder(n))]
        assert all(levels[lv][k] == d for _, lv, k, d in mine)


def test_proofs_detect_any_change(spark):
    rows = [(k, f"text {k}", "en", "s", k) for k in range(20)]
    made = manifest.build(cases.docs(spark, rows), manifest.leaf_digest([F.col(c) for c in manifest.FIELDS]), levels=2)
    for r in manifest.proofs(made).collect():
        assert manifest.fold(bytes(r.digest), bytes(r.path)) == made.root
        assert manifest.fold(hashlib.sha256(bytes(r.digest)).digest(), bytes(r.path)) != made.root


def test_awkward_rows(spark):
    got = manifest.report(cases.crowded(cases.docs(spark).withColumn("kept_lang", F.col("lang")))
                          .withColumn("position", F.lit(0)).withColumn("tree", F.lit("x")), 2)
    assert rows_of(got) == plain_manifest(cases.DOCS)
    assert manifest.report(cases.empty(spark)).collect() == []
    one = manifest.report(cases.docs(spark, [(4, "only", None, None, 4)])).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == sha("")


def test_equal_rows_fill_many_tasks(spark):
    rows = [(7, "same", "en", "s", 4)] * 300 + [(k, "other", "en", "s", k) for k in range(40)]
    assert rows_of(manifest.report(cases.docs(spark, rows), 4)) == plain_manifest(rows)


def test_sql(spark):
    name = "op13_postorder_manifest"
    found = compare(spark, SF_SMALL, name, queries.queries()[name], queries.oracle_sql()[name])
    assert found["cols_match"] and found["hash_match"], found
