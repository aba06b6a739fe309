"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words; a document of a source is copied
``target / source words`` times on average.  The whole part of that is certain,
the fraction is rounded dependently: two documents with fractional copies trade
mass (words) at random, until one of them has a whole number of copies; the
other one goes on to the next trade.  A trade keeps the expected copies of both
and the words of the two together, so at the end a source's words miss its
target by less than one document, and no document gains more than one copy.

The trades are a reduction tree.  A source's documents are dealt by hash to
blocks of about ``BLOCK``; a block is traded down by one task to at most one
fractional document; the blocks' residuals meet in blocks again, and so on.
Within a block large documents come first, so that what is left is mostly a
small one.  Only the last residual of a source is rounded on its own, to the
nearer side.  Every draw depends on ``seed``, source and block alone: reruns
agree, however the rows are partitioned.

Defined cases: a null text has size 0; a null source is a source of its own
(the last one); documents without words are copied too, and take no words; rows
that repeat id, source and text are one unit of the rounding, whose copies are
spread evenly over the rows; empty tables give no rows; a source without a
weight has the target 0; columns other than id, source and text are not read.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import numbered, ship_package, stored, work_folder

BLOCK = 4096  # documents that one task trades at once
CAP = 3  # most copies of a document, and so of a source
SALTS = 16  # parts of a source in the join with the table of sources
SPREAD = 1 << 16  # rows of one unit that one task writes
WORD = r"[^\x20\x09-\x0D]+"
_EDGE = 1e-9  # a fraction this close to a whole number is one


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def units_of(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, source, text): ``size`` in words, a ``hash``
    of the text and the number of ``rows``."""
    return (docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        word_count(text_col).alias("size"), F.xxhash64(text_col).alias("hash"))
            .groupBy("id", "source", "size", "hash").agg(F.count("*").alias("rows")))


def source_sizes(units: DataFrame) -> DataFrame:
    return units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                       F.count("*").alias("n_units"))


def cyclic_weights(sources: DataFrame, folder: str, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights that repeat over the sources in code-point order, null last."""
    placed = numbered(sources.withColumn("unnamed", F.col("source").isNull()).withColumn("all", F.lit(0)),
                      "all", ["unnamed", "source"], folder)
    table = F.array(*[F.lit(float(w)) for w in cycle])
    return placed.withColumn("weight", table[F.pmod("position", F.lit(len(cycle))).cast("int")]).select(
        *sources.columns, "weight")


def capped_targets(sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``target`` per source: shares by ``weight`` of all words, at most
    ``cap`` times the source's words; what is above is shared by weight among
    the others, until none is above.  Each round is one sum over the sources;
    the set of capped sources only grows."""
    limit = F.col("source_size") * F.lit(cap)
    total = sources.agg(F.sum("source_size").cast("double")).first()[0] or 0.0
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > limit
        s = sources.agg(F.sum(F.when(~above, F.col("weight"))).alias("free"),
                        F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)).alias("held"),
                        F.count_if(above).alias("capped")).first()
        if s.capped == capped or not s.free:
            break
        level, capped = (total - s.held) / s.free, s.capped
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit).cast("double"))


def trade(size: np.ndarray, p: np.ndarray, rng: np.random.Generator, last: bool) -> np.ndarray:
    """Pivotal rounding of the fractions ``p`` in order: all but at most one
    become 0 or 1, sum(size * p) stays.  With ``last`` that one is rounded to
    the nearer side."""
    p = p.copy()
    draws = rng.random(len(p)).tolist()
    held = -1  # the document that is still fractional
    for k in range(len(p)):
        if p[k] < _EDGE or p[k] > 1 - _EDGE:
            p[k] = round(p[k])
        elif size[k] == 0:
            p[k] = draws[k] < p[k]
        elif held < 0:
            held = k
        else:
            a, b, x, y = float(size[held]), float(size[k]), float(p[held]), float(p[k])
            up, down = min(1 - x, y * b / a), min(x, (1 - y) * b / a)  # what the held one may gain or lose
            if draws[k] * (up + down) < down:
                x, y = x + up, y - up * a / b
            else:
                x, y = x - down, y + down * a / b
            p[held], p[k] = x, y
            whole = [v < _EDGE or v > 1 - _EDGE for v in (x, y)]
            for i, w in zip((held, k), whole):
                if w:
                    p[i] = round(p[i])
            held = held if not whole[0] else k if not whole[1] else -1
    if last and held >= 0:
        p[held] = float(p[held] >= 0.5)
    return p


def _trade_blocks(level: int, last: bool, seed: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("size", "descending"), ("id", "ascending"), ("hash", "ascending")])
        name = block["source"][0].as_py()
        rng = np.random.default_rng([seed, level, block["block"][0].as_py(),
                                     0 if name is None else 1 + zlib.crc32(str(name).encode())])
        p = trade(block["size"].to_numpy(), block["p"].to_numpy(), rng, last)
        return block.set_column(block.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))
    return run


def round_copies(units: DataFrame, folder: str, block_rows: int = BLOCK, seed: int = 0) -> DataFrame:
    """``units`` with an expected number of ``copies`` (and ``n_units``, the
    units of their source), rounded to whole ``copies``."""
    ship_package(units.sparkSession)
    whole = F.floor(F.col("copies") + F.lit(_EDGE))
    parts = units.select("*", whole.alias("whole"), F.greatest(F.col("copies") - whole, F.lit(0.0)).alias("p"))
    columns = parts.columns
    key = F.xxhash64("id", "size", "hash", F.lit(seed))
    blocks = F.ceil(F.col("n_units") / F.lit(block_rows)).cast("long")
    left = parts.withColumn("block", F.pmod(key, blocks)).withColumn("blocks", blocks)
    done, level = [], 0
    most = units.agg(F.max("n_units")).first()[0] or 0
    most = -(-most // block_rows)
    while True:
        last = most <= 1
        # Whole numbers of copies need no trade.
        settled = F.col("p") < _EDGE
        traded = stored(left.where(~settled).groupBy("source", "block")
                        .applyInArrow(_trade_blocks(level, last, seed), left.schema), f"{folder}/traded-{level}")
        if level == 0:
            done.append(left.where(settled).withColumn("p", F.lit(0.0)).select(columns))
        done.append(traded.where("p = 0 or p = 1").select(columns))
        if last:
            break
        left = (traded.where("p > 0 and p < 1").withColumn("block", F.expr(f"block div {block_rows}"))
                .withColumn("blocks", F.ceil(F.col("blocks") / F.lit(block_rows)).cast("long")))
        most, level = -(-most // block_rows), level + 1
    return reduce(DataFrame.unionByName, done).withColumn("copies", (F.col("whole") + F.col("p")).cast("long")).drop("whole", "p")


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", cap: int = CAP, block_rows: int = BLOCK, seed: int = 0,
        folder: str | None = None) -> DataFrame:
    """The mix as units: ``id``, ``source``, ``size``, ``hash`` (of the text),
    ``rows`` that repeat it, ``source_size``, ``target`` and ``copies`` (of
    all its rows together).  ``weights`` (source, weight) tells the shares;
    without it 1, 2, 3 repeat over the sources."""
    folder = folder or work_folder(docs.sparkSession, "mixing")
    units = stored(units_of(docs, id_col, source_col, text_col), f"{folder}/units")
    sources = stored(source_sizes(units), f"{folder}/sizes")
    if weights is None:
        sources = cyclic_weights(sources, folder)
    else:
        given = weights.select(F.col("source").alias("named"), F.col("weight").cast("double").alias("weight"))
        sources = (sources.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
                   .withColumn("weight", F.coalesce("weight", F.lit(0.0))))
    targets = stored(capped_targets(stored(sources, f"{folder}/weights"), cap), f"{folder}/targets")
    # The hot source's units meet its row in many tasks.
    salted = targets.select(F.col("source").alias("named"), "source_size", "n_units", "target",
                            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    part = F.pmod("hash", F.lit(SALTS)).cast("int")
    expected = F.least(F.col("rows") * F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)),
                       F.col("rows") * F.lit(float(cap)))
    placed = (units.withColumn("salt", part)
              .join(salted, F.col("source").eqNullSafe(F.col("named")) & (F.col("salt") == F.col("part")))
              .select("id", "source", "size", "hash", "rows", "source_size", "target", "n_units",
                      expected.alias("copies")))
    return round_copies(stored(placed, f"{folder}/placed"), folder, block_rows, seed).drop("n_units")


def per_row(mixed: DataFrame) -> DataFrame:
    """One row per input row, with its own ``copies``: a unit's copies are
    spread evenly over its rows."""
    n = F.col("rows")

    def rows_of(units: DataFrame, first: F.Column, last: F.Column) -> DataFrame:
        row = units.withColumn("row", F.explode(F.sequence(first, last)))
        extra = (F.col("row") < F.pmod("copies", n)).cast("long")
        return row.withColumn("copies", F.expr("copies div rows") + extra).drop("row", "rows", "chunk")

    few = rows_of(mixed.where(n <= SPREAD), F.lit(0).cast("long"), n - 1)
    many = (mixed.where(n > SPREAD).withColumn("chunk", F.explode(F.sequence(F.lit(0), ((n - 1) / SPREAD).cast("int"))))
            .repartition("id", "hash", "chunk"))
    start = F.col("chunk").cast("long") * SPREAD
    return few.unionByName(rows_of(many, start, F.least(start + SPREAD, n) - 1))


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source",
         text_col: str = "text") -> DataFrame:
    """The mixed documents: the columns of ``docs`` and ``copy`` (from 1), one
    row per copy.  Of rows that repeat id, source and text any one stands for
    all."""
    name = "_copies"
    wanted = mixed.where("copies > 0").select(F.col("id").alias("_id"), F.col("source").alias("_source"),
                                              F.col("hash").alias("_hash"), F.col("copies").alias(name))
    keyed = docs.withColumn("_key", F.xxhash64(text_col)).dropDuplicates([id_col, source_col, "_key"])
    met = keyed.join(wanted, keyed[id_col].eqNullSafe(F.col("_id")) & keyed[source_col].eqNullSafe(F.col("_source"))
                     & (F.col("_key") == F.col("_hash")))
    return met.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(name))).alias("copy"))


def report(docs: DataFrame) -> DataFrame:
    """The ``op12`` contract: one row per document."""
    return per_row(mix(docs)).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                     (F.col("size") * F.col("copies")).alias("taken"))
