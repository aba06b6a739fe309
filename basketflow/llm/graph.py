"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); equal roots mean the
    same component.

    Every node hooks onto the neighbour of smallest priority (a hash of the
    node), if that is smaller than its own; the links are then drawn between
    the hooked nodes, and so on until none is left.  Each round at least
    halves the nodes of a component in expectation and is written to
    ``folder``, so no lineage grows.  A node with very many links is only
    ever a minimum that is summed map-side."""
    rank = F.xxhash64("node")
    edges = stored(links.where("a <> b").select("a", "b").distinct(), f"{folder}/links-0")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(hooks) + 1
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            edges.select(F.col("b"), F.col("a")))
        best = both.groupBy("node").agg(F.min(F.struct(F.xxhash64("other").alias("rank"), "other")).alias("best"))
        hook = best.select("node", F.when(F.col("best.rank") < rank, F.col("best.other"))
                           .otherwise(F.col("node")).alias("root"))
        hooks.append(stored(hook, f"{folder}/hooks-{k}"))
        a = hooks[-1].select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = hooks[-1].select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(edges.join(a, "a").join(b, "b").where("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                       f"{folder}/links-{k}")
    if not hooks:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = hooks[0]
    for hook in hooks[1:]:
        step = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return stored(found, f"{folder}/roots")
