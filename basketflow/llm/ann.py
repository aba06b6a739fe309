"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Every vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the largest
norm, and a query is scaled to norm M with 0 there: then the smallest distance
is the largest inner product.  A table hashes with K functions
floor((a.x + b) / w), a drawn from the 2-stable (normal) distribution.  A query
visits its own bucket and perturbed ones, one step down or up in some of the
functions, in the order of their estimated success: the summed squared distances
to the crossed borders.  Candidates of all tables are merged and ranked by
their exact inner product in double precision.

Scale: the rows of a table are spread by bucket, buckets above ``BLOCK_ROWS``
are split into blocks that each get the bucket's queries, and a task answers
with at most ``k`` rows per query and block.  Tables of more than a block are
searched in rounds of growing parts of the rows; what a query has found bounds
the answers of the next round.  A query that finds fewer rows than there are gets the rest by an exact
pass over all rows, in blocks of such queries.  Of exact copies only the k + 1
smallest ids can ever be among k nearest (ties go to the smaller id), so the
others are set aside before hashing, by a limit that acts before the shuffle.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.common import mix64, ship_package, stored, work_folder

TABLES = 12
PROBES = 64
WIDTH = 2.0  # of a slot, in units of M
TARGET = 0.95  # share of near neighbours that the fit asks for
MOST_FUNCTIONS = 24
SAMPLE_ROWS = 2048  # bound of the sample that the fit reads
BLOCK_ROWS = 16_384
ASK_ROWS = 512  # about so many short-answered queries are compared with all rows at once


def probe_order(fraction: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """Perturbations of one hash, best first: lists of (function, step).

    ``fraction``: place within the slot, 0 to 1, by function.  The 2K border
    distances are sorted; perturbation sets grow from the best one by shifting
    or extending their last member, off a heap, and sets that step both ways
    in one function are passed over."""
    K = len(fraction)
    steps = sorted([(float(fraction[j]) ** 2, j, -1) for j in range(K)]
                   + [(float(1 - fraction[j]) ** 2, j, 1) for j in range(K)])
    found: list[list[tuple[int, int]]] = [[]]
    heap = [(steps[0][0], (0,))]
    while heap and len(found) < probes:
        score, members = heapq.heappop(heap)
        last = members[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (score - steps[last][0] + steps[last + 1][0], members[:-1] + (last + 1,)))
            heapq.heappush(heap, (score + steps[last + 1][0], members + (last + 1,)))
        chosen = [steps[m][1:] for m in members]
        if len({j for j, _ in chosen}) == len(chosen):
            found.append(chosen)
    return found


class Hashes:
    """The tables' functions and their bucket keys."""

    def __init__(self, dim: int, functions: int, norm: float, tables: int, seed: int):
        rng = np.random.default_rng(seed)
        self.K, self.tables, self.norm = functions, tables, norm
        self.width = WIDTH * norm
        self.a = rng.standard_normal((dim + 1, tables * functions))
        self.b = rng.random(tables * functions) * self.width
        self.odd = rng.integers(0, 1 << 62, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(1), 0))
        return np.concatenate((x, rest[:, None]), 1)

    def aim(self, q: np.ndarray) -> np.ndarray:
        q = q * (self.norm / np.sqrt((q * q).sum(1)))[:, None]
        return np.concatenate((q, np.zeros((len(q), 1))), 1)

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """(rows, tables, K) real-valued places; their floor is the slot."""
        return ((lifted @ self.a + self.b) / self.width).reshape(len(lifted), self.tables, self.K)

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """Bucket keys (int64) of integer slots (..., tables, K)."""
        part = slots.astype(np.int64).view(np.uint64) * self.odd
        table = np.arange(slots.shape[-2], dtype=np.uint64) + np.uint64(1)
        return mix64(part.sum(-1, dtype=np.uint64) + mix64(table)).view(np.int64)

    def probes(self, lifted: np.ndarray, n: int) -> np.ndarray:
        """(rows, tables * n) keys to visit (fewer probes: the first again)."""
        at = self.places(lifted)
        base = np.floor(at)
        out = np.empty((len(at), self.tables, n), np.int64)
        for r in range(len(at)):
            steps = np.zeros((n, self.tables, self.K))
            for t in range(self.tables):
                for p, moved in enumerate(probe_order(at[r, t] - base[r, t], n)):
                    for j, step in moved:
                        steps[p, t, j] = step
            out[r] = self.keys(base[r] + steps).T
        return out.reshape(len(at), -1)


def fit(sample: np.ndarray, n_rows: int, k: int, seed: int = 7, tables: int = TABLES, probes: int = PROBES,
        norm: float | None = None) -> Hashes:
    """Choose the number of functions: the most with which the estimated share
    of near neighbours found stays at ``TARGET``.  ``norm``: the largest norm
    of all rows (without it, of the sample).

    Near neighbours of the sample are its pairs at the distance at which a
    query has its k nearest among all ``n_rows`` rows."""
    norm = norm or float(np.sqrt((sample * sample).sum(1).max()))
    dim = sample.shape[1]
    asked = sample[:64]
    near = max(1, min(len(sample) - 1, round(k * len(sample) / max(n_rows, 1))))
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    best = np.argpartition(-scores, near - 1, 1)[:, :near] if len(sample) > 1 else np.zeros((len(asked), 0), int)
    low, high = 1, MOST_FUNCTIONS + 1  # the share falls as functions are added: halve the range
    while high - low > 1:
        h = Hashes(dim, (low + high) // 2, norm, tables, seed)
        keys = h.keys(np.floor(h.places(h.lift(sample))))
        ask = h.probes(h.aim(asked), probes).reshape(len(asked), tables, -1)
        hit = [(keys[b][:, :, None] == a[None]).any((1, 2)).mean() for a, b in zip(ask, best) if len(b)]
        low, high = (h.K, high) if hit and np.mean(hit) >= TARGET else (low, h.K)
    return Hashes(dim, low, norm, tables, seed)


def _vectors(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def usable(vec: str) -> F.Column:
    """Not null, not zero, every component a finite number."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec).isNotNull() & ~bad & F.exists(vec, lambda x: x != 0)


def rounds_of(n_rows: int, block_rows: int) -> list[tuple[int, int]]:
    """Ranges of a hash between 0 and 2^30, one a round: about a block of rows
    at most, then three times as many as before."""
    ends = [1 << 30]
    while n_rows * ends[0] > block_rows << 30:
        ends.insert(0, ends[0] // 4)
    return list(zip([0, *ends], ends))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            tables: int = TABLES, probes: int = PROBES, block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """The ``k`` nearest rows found for every row for which ``is_query`` (a
    condition) holds: query_id, rank (from 1), ``id_col``, score; never the
    query's own id, ties to the smaller id.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows with a null id or a length other than the commonest.
    Rows that repeat an id count once, by their best score.  An empty table
    gives no rows; other columns play no part."""
    spark = vectors.sparkSession
    ship_package(spark)
    folder = work_folder(spark, "ann")
    clean = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                            F.coalesce(is_query, F.lit(False)).alias("asks"))
             .where(usable("vec") & F.col("id").isNotNull()))
    sizes = clean.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), "dim").limit(1).collect()
    result = f"query_id long, rank int, {id_col} long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    dim = sizes[0].dim
    copy = Window.partitionBy("vec").orderBy("id")
    points = stored(clean.where(F.size("vec") == dim).withColumn("copy", F.dense_rank().over(copy))
                    .where(F.col("copy") <= k + 1).select("id", "vec").distinct(), f"{folder}/points")
    queries = clean.where(F.size("vec") == dim).where("asks").select("id", "vec")
    n_rows = points.count()
    norm = points.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).first()[0]
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))  # about twice the sample meets in one place
    share = min(1 << 30, 1024 + (2 * SAMPLE_ROWS << 30) // max(n_rows, 1))
    sample = points.where(place < share).orderBy(place, "id").limit(SAMPLE_ROWS).collect()
    if len(sample) < 2:  # hardly any rows
        sample = points.limit(SAMPLE_ROWS).collect()
    h = fit(np.array([r.vec for r in sample], float), n_rows, k, seed, tables, probes, float(np.sqrt(norm)))

    def keys_only(batches):
        for batch in batches:
            keys = h.keys(np.floor(h.places(h.lift(_vectors(batch, "vec", dim).astype(float))))).reshape(-1)
            yield pa.RecordBatch.from_pydict({"key": keys})

    hot = stored(points.mapInArrow(keys_only, "key long").groupBy("key").agg(F.count("*").alias("n"))
                 .where(F.col("n") > block_rows)
                 .select("key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), f"{folder}/hot")
    split = not hot.isEmpty()

    def as_bytes(x: np.ndarray) -> pa.Array:
        raw = np.ascontiguousarray(x, "<f8" if x.dtype == np.float64 else "<f4")
        return pa.array([r.tobytes() for r in raw], pa.binary())

    def hash_points(batches):
        for batch in batches:
            x = _vectors(batch, "vec", dim)
            keys = h.keys(np.floor(h.places(h.lift(x.astype(float))))).reshape(-1)
            row = pa.array(np.repeat(np.arange(len(x)), tables))
            table = pa.array(np.tile(np.arange(tables, dtype=np.int32), len(x)))
            yield pa.RecordBatch.from_arrays([table, pa.array(keys), batch.column("id").take(row),
                                              as_bytes(x).take(row)], names=["table", "key", "id", "vec"])

    def hash_queries(batches):
        for batch in batches:
            x = _vectors(batch, "vec", dim)
            for i in range(0, len(x), 256):
                part = x[i:i + 256]
                keys = h.probes(h.aim(part.astype(float)), probes)
                lists = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * np.int32(keys.shape[1]),
                                                 pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, len(part)), as_bytes(part), lists],
                                                 names=["id", "vec", "keys"])

    asked = stored(queries.mapInArrow(hash_queries, "id long, vec binary, keys array<long>"), f"{folder}/asked")
    empty = F.array().cast("array<struct<key:long,block:int>>")
    kind = F_TYPE[vectors.schema[vec_col].dataType.elementType.typeName()]

    # The rows are searched in rounds, about a block of them first and then three
    # times as many as in all rounds before.  From the second on, a query brings
    # the score of the k-th row that it has found: a task answers with rows that
    # reach it, of which there are some 3 * k in a round, however many tasks.
    found = None
    for low, high in rounds_of(n_rows, block_rows):
        spread = max(1, -(-n_rows * (high - low) // (block_rows << 30)))  # groups of buckets of a table
        # A group is of one table, so a point stands in it once.
        group = F.col("table") * F.lit(spread) + F.pmod(F.xxhash64("key", "block"), F.lit(spread))
        of_round = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30))
        hashed = (points.where((of_round >= low) & (of_round < high))
                  .mapInArrow(hash_points, "table int, key long, id long, vec binary"))
        if found is None:
            aimed = asked.withColumn("bound", F.lit(float("-inf")))
        else:
            reached = (found.groupBy(F.col("query_id").alias("_id")).agg(F.min("score").alias("_least"), F.count("*").alias("_n"))
                       .where(F.col("_n") >= k))
            aimed = (asked.join(reached, F.col("id") == F.col("_id"), "left")
                     .withColumn("bound", F.coalesce("_least", F.lit(float("-inf")))))
        visits = aimed.select("id", "vec", "bound", F.posexplode("keys").alias("at", "key")).select(
            "id", "vec", "bound", "key", (F.col("at") / probes).cast("int").alias("table"))
        if split:
            hashed = hashed.join(hot, "key", "left").withColumn(
                "block", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
            visits = visits.join(hot, "key", "left").withColumn(
                "block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        else:
            hashed, visits = hashed.withColumn("block", F.lit(0)), visits.withColumn("block", F.lit(0))
        # A query goes once to each group, with the buckets it visits there.
        goes = (visits.select(group.alias("g"), "id", "vec", "bound", F.struct("key", "block").alias("bucket"))
                .groupBy("g", "id", "vec", "bound").agg(F.collect_list("bucket").alias("buckets")))  # at most tables * probes
        rows = (hashed.select(group.alias("g"), F.lit(0).alias("kind"), "id", "vec", F.lit(0.0).alias("bound"),
                              F.array(F.struct("key", "block")).alias("buckets"))
                .union(goes.select("g", F.lit(1), "id", "vec", "bound", F.coalesce("buckets", empty))))
        answers = (rows.repartition("g").sortWithinPartitions("g", "kind")
                   .mapInArrow(_rank(dim, k, kind), "query_id long, id long, score double"))
        if found is not None:
            answers = answers.union(found.select("query_id", "id", "score"))
        found = stored(_nearest_of(answers, k), f"{folder}/found-{high}")

    # Queries with fewer rows than there are.
    most = points.select("id").distinct().count() - 1
    n_found = found.groupBy(F.col("query_id").alias("_id")).agg(F.count("*").alias("_n"))
    short = stored(queries.join(n_found, F.col("id") == F.col("_id"), "left")
                   .where(F.coalesce("_n", F.lit(0)) < min(k, most)).select("id", "vec"), f"{folder}/short")
    blocks = -(-short.count() // ASK_ROWS)
    parts = [found]
    for b in range(blocks):
        some = short.where(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == b).collect()  # about ASK_ROWS rows
        if some:
            ask = spark.sparkContext.broadcast((np.array([r.id for r in some]), np.array([r.vec for r in some], float)))
            parts.append(stored(points.mapInArrow(_compare(dim, k, ask), "query_id long, id long, score double"),
                                f"{folder}/exact-{b}"))
    if len(parts) > 1:
        found = _nearest_of(reduce(DataFrame.union, [parts[0].select("query_id", "id", "score"), *parts[1:]]), k)
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _nearest_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of (query_id, id, score) with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def _best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best ids by score, then by id, each by its best score."""
    best = np.lexsort((ids, -scores))
    best = best[np.sort(np.unique(ids[best], return_index=True)[1])][:k]
    return ids[best], scores[best]


def _compare(dim: int, k: int, ask):
    """Exact scores of the asked queries against all rows; a task answers with
    its ``k`` best rows of each query."""
    def run(batches):
        query_ids, q = ask.value
        found = [(np.zeros(0, np.int64), np.zeros(0))] * len(q)
        for batch in batches:
            x, ids = _vectors(batch, "vec", dim).astype(float), batch.column("id").to_numpy()
            for r, (own, one) in enumerate(zip(query_ids, q)):
                score = (x * one).sum(1)  # summed as for the candidates
                other = ids != own
                found[r] = _best_of(np.append(found[r][0], ids[other]), np.append(found[r][1], score[other]), k)
        for own, (ids, score) in zip(query_ids, found):
            if len(ids):
                yield pa.RecordBatch.from_pydict({"query_id": np.full(len(ids), own), "id": ids, "score": score})
    return run


F_TYPE = {"float": "<f4", "double": "<f8"}


def _rank(dim: int, k: int, kind: str):
    """Within a group: exact scores of the points in the visited buckets."""

    def top(ids, x, x4, order_keys, repeated, query_id, q, buckets, bound):
        lo = np.searchsorted(order_keys, buckets, "left")
        hi = np.searchsorted(order_keys, buckets, "right")
        on = hi > lo
        if not on.any():
            return None
        change = np.zeros(len(ids) + 1, np.int32)
        np.add.at(change, lo[on], 1)
        np.add.at(change, hi[on], -1)
        at = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        at = at[ids[at] != query_id]
        if not len(at):
            return None
        rough, least = x4[at] @ q.astype(np.float32), bound
        if len(at) > k and not repeated:
            least = max(least, np.partition(rough, len(at) - k)[len(at) - k])
        if least > -np.inf:
            # Rounding to 32 bits can't hide one of the k nearest.
            slack = 1e-5 * float(np.abs(q).sum()) * float(np.abs(x4[at]).max())
            at = at[~(rough < least - slack)]
        score = (x[at].astype(float) * q).sum(1)
        on = ~(score < bound)
        at, score = at[on], score[on]
        if not len(at):
            return None
        best = np.lexsort((ids[at], -score))
        if repeated:  # an id with several vectors counts by the best
            best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])]
        best = best[:k]
        return ids[at][best], score[best]

    def run(batches):
        now, pieces, points = None, [], None
        for batch in batches:
            group = batch.column("g").to_numpy()
            is_query = batch.column("kind").to_numpy()
            ids = batch.column("id").to_numpy()
            bounds = batch.column("bound").to_numpy()
            vec = np.frombuffer(b"".join(batch.column("vec").to_pylist()), kind).reshape(-1, dim)
            lists = batch.column("buckets")
            ends = lists.offsets.to_numpy()
            both = lists.values
            keys = both.field("key").to_numpy().view(np.uint64)
            keys = mix64(keys ^ both.field("block").to_numpy().astype(np.uint64)).view(np.int64)
            out_q, out_i, out_s = [], [], []
            cuts = np.flatnonzero(np.diff(group) | np.diff(is_query)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
                if a == b:
                    continue
                if group[a] != now:
                    now, pieces, points = group[a], [], None
                if not is_query[a]:
                    pieces.append((keys[ends[a:b]], ids[a:b], vec[a:b]))
                    continue
                if points is None and pieces:
                    all_keys, all_ids, x = (np.concatenate(c) for c in zip(*pieces))
                    order = np.argsort(all_keys, kind="stable")
                    points = (all_ids[order], x[order], x[order].astype(np.float32), all_keys[order],
                              len(np.unique(all_ids)) < len(all_ids))
                    pieces = []
                if points is None:
                    continue
                for r in range(a, b):
                    found = top(*points, ids[r], vec[r].astype(float), np.unique(keys[ends[r]:ends[r + 1]]),
                                bounds[r])
                    if found is not None:
                        out_q.append(np.full(len(found[0]), ids[r]))
                        out_i.append(found[0])
                        out_s.append(found[1])
            if out_q:
                yield pa.RecordBatch.from_pydict({"query_id": np.concatenate(out_q), "id": np.concatenate(out_i),
                                                  "score": np.concatenate(out_s)})
    return run


def report(vectors: DataFrame) -> DataFrame:
    """The ``op1`` contract: queries are the ids divisible by 20."""
    return nearest(vectors, F.col("vec_id") % 20 == 0)
