import random
import re

from cases import DOCS, LONG, crowded, docs, empty
from conftest import SF_SMALL
from oracle_compare import compare

from basketflow.llm import near_dup, queries
from basketflow.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = WORD.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)], i == least[find(k)]) for k, (i, s) in enumerate(sets))


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_matches_sql(spark):
    name = "op7_tensored_minhash"
    r = compare(spark, SF_SMALL, name, queries.queries()[name], queries.oracle_sql()[name])
    assert r["cols_match"] and r["hash_match"]


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_groups_of_near_copies_against_brute_force(spark):
    """Large buckets with links, near misses and chains."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for size, n, edits in ((150, 120, 9), (60, 60, 3), (400, 40, 20), (30, 20, 2)):
        texts += family(rng, " ".join(word() for _ in range(size)), n, edits)
    chain = [word() for _ in range(200)]
    for _ in range(30):  # each link changes a little
        chain = chain[:]
        chain[rng.randrange(200)] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(word() for _ in range(rng.randint(1, 50))) for _ in range(60)]
    texts += texts[:40]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100))
    got = result(near_dup.near_duplicates(docs(spark, [(i, t, None, None, None) for i, t in rows]), shingle=3, percent=85))
    assert got == brute(rows, 3, 85)
    got = result(near_dup.near_duplicates(docs(spark, [(i, t, None, None, None) for i, t in rows]), shingle=5, percent=80))
    assert got == brute(rows, 5, 80)


def test_awkward_rows(spark):
    found = near_dup.near_duplicates(crowded(docs(spark)), shingle=3, percent=85).collect()
    assert len(found) == len(DOCS)
    by = {r.doc_id: r for r in found}
    assert by[8].component_id == 1 and not by[8].kept and by[1].kept
    assert [by[i].n_shingles for i in (2, 3)] == [0, 0] and by[2].kept and by[3].kept
    assert by[4].n_shingles == 0 and by[5].n_shingles == len(shingles(LONG, 3))
    assert by[None].component_id is None and by[None].kept
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_chain_and_a_star(spark, tmp_path):
    rows = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = components(spark.createDataFrame(rows, "a long, b long"), f"file://{tmp_path}/graph")
    roots = {}
    for r in found.collect():
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [200, 301]


def test_rows_without_ids(spark):
    frame = crowded(docs(spark))
    some = spark.createDataFrame([(1,), (6,), (77,)], "id long")
    left = near_dup.without_ids(frame, some)
    assert left.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 2, 3, 4, 5, 7, 8, 9]
    assert near_dup.without_ids(frame, some.where("id < 0")).count() == len(DOCS)


def test_groups_follow_the_threshold():
    for percent in (70, 80, 85, 95):
        assert near_dup.miss_rate(percent / 100, near_dup.groups_for(percent)) <= 1e-4


def test_isolated_pairs_just_over_the_threshold(spark):
    rng = random.Random(11)
    rows = []
    for k in range(1200):  # every edit in the middle changes five of 196 shingles
        a = [f"p{k}w{i}" for i in range(200)]
        b = a[:]
        for e in range(4):
            b[10 + 40 * e + rng.randrange(30)] = f"q{k}e{e}"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    frame = docs(spark, [(i, t, None, None, None) for i, t in rows])
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame, shingle=5, percent=80).collect()}
    both = [len(shingles(a, 5) & shingles(b, 5)) for (_, a), (_, b) in zip(rows[::2], rows[1::2])]
    assert all(0.8 <= n / (2 * 196 - n) <= 0.82 for n in both)
    assert all(got[2 * k + 1] == 2 * k for k in range(1200))
