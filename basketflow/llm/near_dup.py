"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its word shingles.  Two small collections of hashes,
each of ``m`` groups of ``r`` minima, take the place of ``m * m`` independent
bands: the key of table (i, j) pairs group i of the first collection with
group j of the second, so ``m * m`` tables of ``2 * r`` minima cost only
``2 * m * r`` minima.  Two documents of similarity s share a table with
probability (1 - (1 - s^r)^m)^2.  ``m`` follows the threshold, so that a pair at
it is missed less than once in 10,000 times (``MISS``): with r = 3, m = 11 at
0.85 (0.6 in 10,000) and m = 14 at 0.80 (0.9 in 10,000).

Links are confirmed on the full sets.  No step forms all pairs of a bucket:

1. documents with the same set are one class (its smallest id stands for it);
   the sets themselves are worked out again, in a second scan, only for classes
   that share a bucket with another one (told by a filter of bounded size, so
   no text is moved);
2. only hash groups that at least two classes share are paired into keys;
3. in each bucket every class is compared with the bucket's smallest class,
   and linked classes are merged into components;
4. buckets that still hold several components and more than one untried pair
   are finished exactly, between different components only: in a small bucket
   (``SMALL`` classes at most) by its untried pairs, in a larger one by a join
   of its classes on the rarest shingles of their sets (the prefix that two
   sets of the wanted similarity must share), with size and position bounds.

So every link within a bucket counts, and a bucket's work stays near its size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import byte_table, chunks, mix64, ship_package, stored, text_buffer, words, work_folder
from basketflow.llm.graph import components

MINIMA = 3  # r
MISS = 1e-4  # greatest share of pairs at the threshold that share no table
FILTER_BITS = 1 << 26  # bound of the filter that is sent to all tasks (8 MB)
SMALL = 12  # classes of a bucket whose pairs are tried one by one
# Words are [^\x20\x09-\x0D]+ after lower-casing A-Z.
WORD_TABLE = byte_table({0x20, *range(0x09, 0x0E)})

_STEP = np.uint64(0x9FB21C651E98DF25)


def miss_rate(similarity: float, m: int) -> float:
    """Share of pairs of this similarity that share no table."""
    return 1 - (1 - (1 - similarity ** MINIMA) ** m) ** 2


def groups_for(percent: int) -> int:
    """The smallest m that keeps to ``MISS`` at a threshold."""
    m = 1
    while miss_rate(percent / 100, m) > MISS:
        m += 1
    return m


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, end to end, and row
    offsets.  Fewer words than ``size`` make one shingle; none make none."""
    _, _, h, by_row = words(data, offs, WORD_TABLE)
    runs = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        runs = runs * _STEP + h[k:k + len(runs)]
    runs = mix64(runs)
    rows = []
    for a, b in zip(by_row[:-1].tolist(), by_row[1:].tolist()):
        if b - a >= size:
            s = np.sort(runs[a:b - size + 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            rows.append(s[keep])
        elif b > a:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = one * _STEP + h[k]
            rows.append(mix64(one + np.uint64(b - a)))
        else:
            rows.append(h[:0])
    return np.concatenate(rows), np.cumsum([0] + [len(s) for s in rows])


def hash_groups(sets: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """(rows, 2m) keys of the hash groups of non-empty sets."""
    n = len(at) - 1
    keys = np.zeros((2 * m, n), np.uint64)
    seeds = np.random.default_rng(20240607).integers(0, 1 << 63, (2, 2 * m * MINIMA), dtype=np.uint64)
    xor, times = seeds * np.uint64(2) + np.uint64(1)
    for k in range(2 * m * MINIMA):
        low = np.minimum.reduceat((sets ^ xor[k]) * times[k], at[:-1])
        g = k // MINIMA
        keys[g] = mix64(keys[g] + low + np.uint64(k))
    return keys.T


def _sign(size: int, m: int):
    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(1))
            for i, j in chunks(offs):
                sets, at = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], size)
                n = at[1:] - at[:-1]
                some = np.flatnonzero(n)
                keys = np.zeros((j - i, 2 * m), np.uint64)
                if len(some):
                    keys[some] = hash_groups(sets, np.append(at[some], at[-1]), m)
                raw = sets.tobytes()
                marks = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest()
                         for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                lists = pa.ListArray.from_arrays(np.where(np.arange(j - i + 1), 1, 0).cumsum().astype(np.int32)
                                                 * np.int32(2 * m), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(marks, pa.binary()), lists],
                    names=["id", "n", "mark", "keys"])
    return run


def _sets(size: int, wanted):
    """Sets of the rows whose hash (third column) is in the filter."""
    def run(batches):
        for batch in batches:
            keep = passes(wanted.value, batch.column(2))
            if not keep.any():
                continue
            batch = batch.filter(pa.array(keep))
            data, offs = text_buffer(batch.column(1))
            for i, j in chunks(offs):
                sets, at = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(at.astype(np.int32), pa.array(sets.view(np.int64)))],
                    names=["node", "shingles"])
    return run


def passes(bits: np.ndarray, hashes: pa.Array) -> np.ndarray:
    """Which of the id hashes are in the filter."""
    h = hashes.to_numpy().view(np.uint64)
    mask = np.uint64(len(bits) * 64 - 1)
    keep = np.ones(len(h), bool)
    for place in (h & mask, (h >> np.uint64(32)) & mask):
        keep &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return keep


def id_filter(ids: DataFrame, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Bit filter (64-bit words) that holds every ``id``: two bits each among
    16 per id, or among ``most_bits`` if that is less.  Others pass rarely; in
    a full filter all pass, which costs time and changes no result."""
    n = ids.count()
    bits = min(most_bits, 1 << max(12, (16 * n - 1).bit_length() if n else 0))
    h = F.xxhash64("id")
    places = F.array(h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)))
    words_of = (ids.select(F.explode(places).alias("p"))
                .select(F.shiftright("p", 6).alias("word"),
                        F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
                .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toPandas()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.uint64)
    out[words_of["word"].to_numpy(np.int64)] = words_of["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, folder: str | None = None) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles`` (set size),
    ``component_id`` (smallest id reachable over links, itself included) and
    ``kept`` (it is that id).  Documents are linked if
    100 * |A and B| >= percent * |A or B|.

    Null, empty and wordless texts have empty sets and are linked with
    nothing; rows with a null id are linked with nothing and kept.  Ids are
    expected to be unique: rows that repeat one are returned each, and their
    texts may share a component.  Other columns play no part."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or work_folder(spark, "near-dup")
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = text.schema["id"].dataType.simpleString()

    # 1. Signatures, and classes of equal sets.
    m = groups_for(percent)
    signed = stored(text.mapInArrow(_sign(shingle, m), f"id {id_type}, n long, mark binary, keys array<long>"),
                    f"{folder}/signed")
    linked = signed.where("n > 0 and id is not null")
    classes = stored(linked.groupBy("mark").agg(F.min(F.struct("id", "n", "keys")).alias("least"))
                     .select("mark", F.col("least.id").alias("node"), F.col("least.n").alias("n"),
                             F.col("least.keys").alias("keys")), f"{folder}/classes")
    sizes = classes.select("node", "n")

    # 2. Table keys from hash groups that several classes share.
    groups = classes.select("node", F.posexplode("keys").alias("place", "key"))
    shared = groups.groupBy("place", "key").agg(F.count("*").alias("c")).where("c > 1")
    own = (groups.join(shared, ["place", "key"], "left_semi").groupBy("node")
           .agg(F.collect_list(F.struct("place", "key")).alias("all")))  # at most 2m entries
    first = F.filter("all", lambda g: g["place"] < m)
    second = F.filter("all", lambda g: g["place"] >= m)
    tables = stored(own.select("node", F.explode(first).alias("u"), second.alias("vs"))
                    .select("node", "u", F.explode("vs").alias("v"))
                    .select("node", F.xxhash64("u.place", "u.key", "v.place", "v.key").alias("key")),
                    f"{folder}/tables")

    # 3. Every class against the smallest class of each of its buckets.
    hubs = tables.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1")
    stars = stored(tables.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
                   .distinct(), f"{folder}/stars")
    wanted = spark.sparkContext.broadcast(
        id_filter(stars.select(F.col("a").alias("id")).union(stars.select("b")).distinct()))
    sets = stored(text.select("id", "text", F.xxhash64("id").alias("h")).where("id is not null")
                  .mapInArrow(_sets(shingle, wanted), f"node {id_type}, shingles array<long>"), f"{folder}/sets")
    links = confirm(stars, sizes, sets, percent, f"{folder}/star-links")
    roots = components(links, f"{folder}/star-components")

    # 4. Buckets that hold several components; with two classes nothing is
    # left to try.
    where = tables.join(roots, "node", "left").select("node", "key", F.coalesce("root", "node").alias("root"))
    mixed = (where.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"))
             .where("lo <> hi and c > 2").select("key", "c"))
    rest = stored(where.join(mixed, "key"), f"{folder}/mixed")
    large = rest.where(F.col("c") > SMALL).select("node", "root").distinct()
    more = confirm(bucket_pairs(rest.where(F.col("c") <= SMALL)).union(
        prefix_pairs(sets.join(large, "node"), percent, f"{folder}/prefix")).distinct(), sizes, sets, percent,
        f"{folder}/more-links")
    roots = components(links.union(more), f"{folder}/components")

    # The smallest id of each component, back to all rows.
    least = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    of_class = (classes.select("mark", "node").join(roots, "node", "left").join(least, "root", "left")
                .select("mark", F.coalesce("component_id", "node").alias("component_id")))
    component = F.coalesce("component_id", "id")
    return (signed.select("id", "n", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("mark")).alias("mark"))
            .join(of_class, "mark", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.col("id").eqNullSafe(component).alias("kept")))


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (column ``id``, distinct).
    Only rows that pass the bit filter of ``ids`` are moved to meet them; a
    null id stays."""
    ship_package(docs.sparkSession)
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(ids))

    def tag(batches):
        for batch in batches:
            found = pa.array(passes(bits.value, batch.column("__h")))
            yield batch.append_column("__maybe", found)

    tagged = docs.withColumn("__h", F.xxhash64(id_col))
    tagged = tagged.mapInArrow(tag, T.StructType([*tagged.schema.fields, T.StructField("__maybe", T.BooleanType())]))
    rest = tagged.where("__maybe").join(ids.select(F.col("id").alias("__id")), F.col(id_col) == F.col("__id"), "left_anti")
    return tagged.where("not __maybe").unionByName(rest).select(docs.columns)


def confirm(pairs: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, path: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.  Sizes that are
    too different rule most pairs out before any set is moved."""
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}")), side)
    near = pairs.where(F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")).select("a", "b").distinct()
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    alike = 100 * both >= percent * (F.size("sa") + F.size("sb") - both)
    return stored(near.join(b, "b").join(a, "a").where(alike).select("a", "b").distinct(), path)


def bucket_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of different roots in small buckets (node, key, root), without
    the bucket's smallest class, which has been compared with all others."""
    groups = (rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("node", "root"))).alias("all"))  # SMALL at most
              .select(F.slice("all", F.lit(2), F.lit(SMALL)).alias("all")).distinct())
    firsts = groups.select("all", F.posexplode("all").alias("k", "x"))
    both = firsts.select("x", F.explode(F.slice("all", F.col("k") + 2, F.lit(SMALL))).alias("y"))
    return both.where("x.root <> y.root").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def prefix_pairs(rows: DataFrame, percent: int, folder: str) -> DataFrame:
    """Pairs of different roots that can be similar enough, exactly: the sets
    of such a pair share one of their rarest shingles (``rows``: node, root,
    shingles)."""
    tokens = rows.select("node", F.explode("shingles").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("c"))
    # Of n shingles, all but ceil(percent * n / 100) - 1 are the prefix.
    keep = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)).cast("int") + 1
    # Shingles of one set only match nothing, but they take places.
    ordered = (tokens.join(often, "token").groupBy("node")
               .agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("all"))  # one set's shingles
               .withColumn("n", F.size("all")).join(rows.select("node", "root"), "node"))
    prefix = (ordered.select("node", "root", "n", F.posexplode(F.slice("all", F.lit(1), keep)).alias("at", "t"))
              .where("t.c > 1").select("node", "root", "n", "at", F.col("t.token").alias("token")))
    prefix = stored(prefix, f"{folder}-tokens")
    a, b = prefix.alias("a"), prefix.alias("b")
    total = F.col("a.n") + F.col("b.n")
    reach = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    return (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node"))
                   & (F.col("a.root") != F.col("b.root"))
                   & (F.least("a.n", "b.n") * 100 >= percent * F.greatest("a.n", "b.n"))
                   & (reach * (100 + percent) >= percent * total))
            .select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct())


def report(docs: DataFrame) -> DataFrame:
    """The ``op7`` contract: three words, 85 percent."""
    return near_duplicates(docs, shingle=3, percent=85)
