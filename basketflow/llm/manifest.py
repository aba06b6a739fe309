"""Merkle manifest of a dataset as a postorder append log.

The rows of a group (here: a language), in order of id, are the leaves of a
binary tree; the roots of the groups, in order of group, are the leaves of one
more tree, whose root stands for the dataset.  A node is the sha256 of its
children's digests as hex text; the last node of an odd level has one child.

Trees are built by aligned builders: a builder takes ``2 ** LEVELS``
consecutive leaves that start at a multiple of that number, so its nodes are
nodes of the whole tree whatever the other builders hold.  It appends every
node to its log segment when the node is complete, which is postorder.  The
segments' roots are the leaves of the next tier of builders, until one is left.

No node needs an index: a subtree's size follows from its number of leaves, so
the place of every node in the log is a closed form (``place``), for a segment
as for the log of a whole tree.  A proof takes a leaf's siblings from the
places in its segment and appends the path of the segment's root, which is the
same for all leaves below and comes from the next tier.

Defined cases: a null field is ``-``; a null group is a group of its own, the
first; rows without id come first in their group; rows of equal id stand in
order of their digests, equal rows are leaves of their own; an empty table has
no tree, no root and no proofs.  Columns beside the fields are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import numbered, ship_package, stored, work_folder

LEVELS = 12  # a builder takes 2 ** LEVELS leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = 33  # bytes of a path's step: 1 for the side, 32 for the sibling
NONE, RIGHT, LEFT = 0, 1, 2  # side of the sibling


def leaf_digest(fields: list[F.Column]) -> F.Column:
    """sha256 over the fields: ``-`` if null, else UTF-8 bytes, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in texts]), 256))


def node(children: bytes) -> bytes:
    return hashlib.sha256(children.hex().encode()).digest()


def height(leaves: int) -> int:
    return max(0, leaves - 1).bit_length()


def subtree(level: int, leaves: int) -> int:
    """Nodes of a subtree of that height over so many leaves."""
    return sum(-(-leaves >> h) for h in range(level + 1))


def place(level: int, index: int, leaves: int) -> int:
    """Place of a node in the log of a tree: the nodes complete before its
    first leaf, and its own subtree, which it ends."""
    first = index << level
    return 2 * first - first.bit_count() + subtree(level, min(1 << level, leaves - first)) - 1


@lru_cache(maxsize=4 * LEVELS)
def places(level: int, leaves: int) -> np.ndarray:
    """Places of all nodes of a level (most segments are full ones)."""
    return np.array([place(level, k, leaves) for k in range(-(-leaves >> level))])


def complete(digests: list[bytes], top: int) -> bytes:
    """The log segment of a builder: all nodes up to height ``top`` in the
    order in which they are complete."""
    log: list[bytes] = []
    waiting: list[bytes] = [b""] * (top + 1)

    def put(level: int, digest: bytes) -> None:
        log.append(digest)
        while level < top and waiting[level]:
            digest = node(waiting[level] + digest)
            waiting[level] = b""
            level += 1
            log.append(digest)
        if level < top:
            waiting[level] = digest

    for d in digests:
        put(0, d)
    for level in range(top):  # the last run of a level may hold one node
        if waiting[level]:
            digest, waiting[level] = node(waiting[level]), b""
            put(level + 1, digest)
    return b"".join(log)


def builder_height(tree_leaves: int, levels: int) -> int:
    return levels if tree_leaves > 1 << levels else height(tree_leaves)


def builder_leaves(tree_leaves: int, block: int, levels: int) -> int:
    return min(1 << levels, tree_leaves - (block << levels))


def steps(nodes: bytes, leaves: int, top: int, above: bytes) -> list[bytes]:
    """Path of every leaf of a segment: its siblings, by their places, then
    the path of the segment's root."""
    n = np.arange(leaves)
    log = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    out = np.zeros((leaves, top, STEP), np.uint8)
    for level in range(top):
        own = n >> level
        sibling = own ^ 1
        there = (sibling << level) < leaves
        out[:, level, 0] = np.where(there, np.where(own & 1, LEFT, RIGHT), NONE)
        out[there, level, 1:] = log[places(level, leaves)[sibling[there]]]
    return [row.tobytes() + above for row in out]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for k in range(0, len(path), STEP):
        side, sibling = path[k], path[k + 1:k + STEP]
        leaf = node(leaf if side == NONE else leaf + sibling if side == RIGHT else sibling + leaf)
    return leaf


def siblings(path: bytes) -> bytes:
    """The siblings of a path as hex text, end to end."""
    return b"".join(path[k + 1:k + STEP] for k in range(0, len(path), STEP) if path[k]).hex().encode()


# -- trees ---------------------------------------------------------------------

_SEGMENT = "tree string, block long, leaves long, nodes binary"


def _build(levels: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("position")
        leaves = block["leaves"][0].as_py()
        nodes = complete(block["digest"].to_pylist(), builder_height(leaves, levels))
        return pa.table({"tree": block["tree"].slice(0, 1), "block": pa.array([block["block"][0].as_py()], pa.int64()),
                         "leaves": pa.array([leaves], pa.int64()), "nodes": pa.array([nodes], pa.binary())})
    return run


def build_trees(leaves: DataFrame, folder: str, levels: int = LEVELS) -> list[DataFrame]:
    """Log segments by tier from ``tree``, ``position``, ``leaves`` (of the
    tree) and ``digest``: (tree, block, leaves of the tier's tree, nodes)."""
    tiers: list[DataFrame] = []
    ship_package(leaves.sparkSession)
    while True:
        placed = leaves.select("tree", "position", "leaves", "digest", F.shiftright("position", levels).alias("block"))
        tiers.append(stored(placed.groupBy("tree", "block").applyInArrow(_build(levels), _SEGMENT),
                            f"{folder}/tier-{len(tiers)}"))
        leaves = tiers[-1].where(F.col("leaves") > 1 << levels).select(
            "tree", F.col("block").alias("position"),
            F.ceil(F.col("leaves") / F.lit(1 << levels)).cast("long").alias("leaves"), _root_of("nodes").alias("digest"))
        if leaves.isEmpty():
            return tiers


def _root_of(nodes: str) -> F.Column:
    return F.substring(F.col(nodes), -32, 32)


def roots(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, digest): a tree ends in the tier where one builder holds it."""
    ends = [t.where(F.col("leaves") <= 1 << levels).select("tree", _root_of("nodes").alias("digest")) for t in tiers]
    return reduce(DataFrame.unionByName, ends)


def segment_paths(tiers: list[DataFrame], above: DataFrame | None, levels: int = LEVELS) -> DataFrame:
    """The lowest tier's segments with ``above``, the path of their roots.
    ``above`` (tree, path) leads on from the trees' roots."""
    down = None  # (tree, block, above) of the tier at hand
    for k in range(len(tiers) - 1, -1, -1):
        tier = tiers[k]
        top = tier.where(F.col("leaves") <= 1 << levels)
        if above is not None:
            top = top.join(above.select(F.col("tree").alias("_tree"), F.col("path").alias("above")),
                           F.col("tree") == F.col("_tree")).drop("_tree")
        else:
            top = top.withColumn("above", F.lit(b"").cast("binary"))
        found = top
        if down is not None:
            found = found.unionByName(tier.join(down, ["tree", "block"]))
        if k:
            down = found.mapInArrow(_leaf_paths(levels), "tree string, block long, above binary")
    return found


def _leaf_paths(levels: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                m = builder_leaves(row["leaves"], row["block"], levels)
                paths = steps(row["nodes"], m, builder_height(row["leaves"], levels), row["above"])
                first = row["block"] << levels
                yield pa.RecordBatch.from_pydict({"tree": [row["tree"]] * m,
                                                  "block": pa.array(range(first, first + m), pa.int64()),
                                                  "above": pa.array(paths, pa.binary())})
    return run


# -- manifest ------------------------------------------------------------------

@dataclass
class Manifest:
    """``leaves``: (tree, id, digest, position, leaves) and what else was
    kept; ``groups``, ``top``: log segments by tier of the groups' trees and
    of the tree over them; ``subroots``: (tree, digest, position); ``root``."""

    leaves: DataFrame
    groups: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: bytes | None
    levels: int


def tree_name(group: F.Column) -> F.Column:
    """Names sort like the groups: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def build(rows: DataFrame, digest: F.Column, group: str = "lang", id_col: str = "doc_id", keep: dict | None = None,
          levels: int = LEVELS, folder: str | None = None) -> Manifest:
    """Build the manifest of ``rows``; ``keep`` names further columns that
    stay beside the leaves."""
    spark: SparkSession = rows.sparkSession
    folder = folder or work_folder(spark, "manifest")
    leaves = rows.select(tree_name(F.col(group)).alias("tree"), F.col(id_col).alias("id"), digest.alias("digest"),
                         *[c.alias(name) for name, c in (keep or {}).items()])
    placed = stored(numbered(leaves, "tree", ["id", "digest"], f"{folder}/order")
                    .withColumnRenamed("group_rows", "leaves"), f"{folder}/leaves")
    groups = build_trees(placed, f"{folder}/groups", levels)
    subroots = numbered(roots(groups, levels).withColumn("all", F.lit("all")), "all", ["tree"], f"{folder}/subroots")
    subroots = stored(subroots.withColumnRenamed("group_rows", "leaves"), f"{folder}/subroots/placed")
    top = build_trees(subroots.select(F.col("all").alias("tree"), "position", "leaves", "digest"), f"{folder}/top", levels)
    root = roots(top, levels).first()  # one row
    return Manifest(placed, groups, top, subroots, bytes(root.digest) if root else None, levels)


def proofs(manifest: Manifest, folder: str | None = None) -> DataFrame:
    """The leaves with ``path`` (from the leaf to the root: ``STEP`` bytes a
    level) and ``subroot``.  A block of leaves meets the one row of its
    segment; nothing grows with a group."""
    levels = manifest.levels
    spark = manifest.leaves.sparkSession
    folder = folder or work_folder(spark, "proofs")
    tops = segment_paths(manifest.top, None, levels).mapInArrow(_leaf_paths(levels), "tree string, block long, above binary")
    ordered = manifest.subroots.select("tree", "position", F.col("digest").alias("subroot"))
    group_paths = stored(tops.select(F.col("block").alias("position"), F.col("above").alias("path"))
                         .join(ordered, "position").select("tree", "path", "subroot"), f"{folder}/groups")
    segments = segment_paths(manifest.groups, group_paths, levels)
    segments = stored(segments.join(group_paths.select(F.col("tree").alias("_tree"), "subroot"),
                                    F.col("tree") == F.col("_tree")).drop("_tree"), f"{folder}/segments")
    blocks = manifest.leaves.withColumn("block", F.shiftright("position", levels))
    out = F.struct(*manifest.leaves.columns).alias("x")
    schema = blocks.select(out).schema["x"].dataType.add("path", "binary").add("subroot", "binary")

    def extract(rows: pa.Table, segment: pa.Table) -> pa.Table:
        rows, one = rows.sort_by("position").drop_columns(["block"]), segment.to_pylist()[0]
        m = builder_leaves(one["leaves"], one["block"], levels)
        paths = steps(one["nodes"], m, builder_height(one["leaves"], levels), one["above"])
        return (rows.append_column("path", pa.array(paths, pa.binary()))
                .append_column("subroot", pa.array([one["subroot"]] * m, pa.binary())))

    return blocks.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block")).applyInArrow(extract, schema)


def log_entries(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """The whole log of each tree, one row per node: ``tree``, ``place`` in
    completion order, ``level``, ``position`` in its level, ``digest``."""
    parts = []
    for k, tier in enumerate(tiers):
        def run(batches, base=k * levels, lowest=k == 0):
            for batch in batches:
                for row in batch.to_pylist():
                    m, top = builder_leaves(row["leaves"], row["block"], levels), builder_height(row["leaves"], levels)
                    found = [(level, i) for level in range(0 if lowest else 1, top + 1) for i in range(-(-m >> level))]
                    nodes = row["nodes"]
                    at = [place(level, i, m) for level, i in found]
                    yield pa.RecordBatch.from_pydict({
                        "tree": [row["tree"]] * len(found), "level": pa.array([base + x for x, _ in found], pa.int32()),
                        "position": pa.array([(row["block"] << (levels - x)) + i for x, i in found], pa.int64()),
                        "digest": pa.array([nodes[32 * a:32 * a + 32] for a in at], pa.binary())})
        parts.append(tier.mapInArrow(run, "tree string, level int, position long, digest binary"))
    nodes = reduce(DataFrame.unionByName, parts)
    sizes = tiers[0].select(F.col("tree").alias("_tree"), "leaves").distinct()
    return (nodes.join(sizes, F.col("tree") == F.col("_tree"))
            .withColumn("place", _place_of(F.col("level"), F.col("position"), F.col("leaves")))
            .select("tree", "place", "level", "position", "digest"))


def _place_of(level: F.Column, index: F.Column, leaves: F.Column) -> F.Column:
    """``place`` as an expression."""
    first = F.expr("shiftleft(position, level)")
    inside = F.least(F.expr("shiftleft(1L, level)"), leaves - first)
    size = F.aggregate(F.sequence(F.lit(0), level), F.lit(0).cast("long"),
                       lambda s, h: s + F.ceil(inside / F.pow(F.lit(2.0), h)).cast("long"))
    return first * 2 - F.bit_count(first) + size - 1


def checked(rows: DataFrame, leaf: str, path: str, root: bytes) -> DataFrame:
    """``rows`` with ``folded`` (the root that ``leaf`` and ``path`` lead to),
    ``proof_sha256`` (of the siblings' hex text) and ``verified``."""
    schema = F.struct(*rows.columns, F.lit(b"").cast("binary").alias("folded"), F.lit("").alias("proof_sha256"))
    schema = rows.select(schema.alias("x")).schema["x"].dataType
    names = [*rows.columns, "folded", "proof_sha256"]
    a, b = names.index(leaf), names.index(path)

    def run(batches):
        for batch in batches:
            paths = batch.column(b).to_pylist()
            folded = [fold(x, p) for x, p in zip(batch.column(a).to_pylist(), paths)]
            proof = [hashlib.sha256(siblings(p)).hexdigest() for p in paths]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folded, pa.binary()), pa.array(proof)],
                                             names=names)

    return rows.mapInArrow(run, schema).withColumn("verified", F.col("folded") == F.lit(root))


def report(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The ``op13`` contract.  Documents whose id's crc32 is divisible by 7 are
    tampered with after the manifest was built (1 more character)."""
    fields = [F.col(c) for c in FIELDS]
    more = [F.try_add(f, F.lit(1).cast("long")) if c == "n_chars" else f for c, f in zip(FIELDS, fields)]
    hit = F.col("n_chars").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0)
    made = build(docs, leaf_digest(fields), keep={"now": F.when(hit, leaf_digest(more))}, levels=levels)
    rows = proofs(made).withColumn("now", F.coalesce("now", "digest"))
    found = checked(rows, "now", "path", made.root or b"")

    def text(c: str) -> F.Column:
        return F.lower(F.hex(c))

    return found.select(F.col("id").alias("doc_id"), text("digest").alias("leaf"), text("subroot").alias("subroot"),
                        F.lit((made.root or b"").hex()).alias("root"), "proof_sha256",
                        text("folded").alias("folded_root"), "verified")
