"""Skew-safe building blocks for ordered-sequence features.

Windows partitioned by a user (or a user x product pair) put the whole group
into one task.  A single heavy key can hold a large share of all rows, so the
three sequence operators the features need are expressed without such
windows:

* ``blocked_running_sum`` — running sum along a per-key sequence, computed
  inside fixed-size blocks of the sequence plus the totals of the earlier
  blocks (a two-level prefix sum).  No group is larger than one block; the
  per-key window only sees one row per block.
* ``dense_rank_desc`` — dense rank of a value within a group, computed on the
  distinct (group, value) pairs and joined back.
* ``run_starts`` — the first element of each run of consecutive sequence
  numbers (gaps and islands), found by an anti join with the sequence
  shifted by one: a join on unique keys, so it spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1024


def sequence_block(order_col: str, block_rows: int = BLOCK_ROWS) -> Column:
    """Block number of a 1-based sequence number."""
    return F.floor((F.col(order_col) - 1) / F.lit(block_rows)).cast("long")


def blocked_running_sum(df: DataFrame, key: str, order_col: str, value: Column,
                        out: str, block_rows: int = BLOCK_ROWS,
                        key_sums: dict[str, Column] | None = None,
                        key_maxes: dict[str, Column] | None = None) -> DataFrame:
    """Add ``out`` = SUM(value) OVER (PARTITION BY key ORDER BY order_col).

    The frame is the default RANGE frame (ties included), which blocks
    preserve because a block is a function of ``order_col``.  ``key`` must
    not be NULL.  Rows without a position (NULL ``order_col``) must have a
    ``value`` of 0; they are spread over blocks of their own, so that they
    count in ``key_sums`` and ``key_maxes``.

    ``key_sums`` / ``key_maxes`` map output names to expressions that are
    summed / maximised over all rows of the key.  They are aggregated per
    block and combined over the blocks of the key, then attached to every
    row with the block offsets: per-key bounds travel with the rows without
    a join on the (possibly skewed) key alone.
    """
    key_sums = key_sums or {}
    key_maxes = key_maxes or {}
    unplaced = -1 - F.pmod(F.xxhash64(*df.columns), F.lit(block_rows))
    blocked = (df.withColumn("_blk", F.coalesce(sequence_block(order_col, block_rows), unplaced))
               .withColumn("_val", value))
    in_block = Window.partitionBy(key, "_blk").orderBy(order_col)
    blocked = blocked.withColumn("_in_block", F.sum("_val").over(in_block))

    totals = blocked.groupBy(key, "_blk").agg(
        F.sum("_val").alias("_blk_total"),
        *[F.sum(expr).alias(f"_s_{name}") for name, expr in key_sums.items()],
        *[F.max(expr).alias(f"_m_{name}") for name, expr in key_maxes.items()])
    earlier = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    offsets = totals.select(
        key, "_blk",
        F.coalesce(F.sum("_blk_total").over(earlier), F.lit(0)).alias("_before"),
        *[F.sum(f"_s_{name}").over(whole).alias(name) for name in key_sums],
        *[F.max(f"_m_{name}").over(whole).alias(name) for name in key_maxes])
    return (blocked.join(offsets, [key, "_blk"])
            .withColumn(out, F.col("_in_block") + F.col("_before"))
            .drop("_blk", "_val", "_in_block", "_before"))


def dense_rank_desc(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY group ORDER BY value DESC)`` as long.

    Ranks are computed over the distinct (group, value) pairs only: a group
    whose values sum to N has at most sqrt(2N) distinct positive values, so
    the ranking window stays small however many rows share the group.
    Rows with a NULL group form their own group, as in SQL.
    """
    levels = df.select(F.col(group).alias("_rank_group"), F.col(value).alias("_rank_value")).distinct()
    ranked = levels.withColumn(
        out, F.dense_rank().over(
            Window.partitionBy("_rank_group").orderBy(F.col("_rank_value").desc())).cast("long"))
    cond = (F.col(group).eqNullSafe(F.col("_rank_group"))) & (F.col(value).eqNullSafe(F.col("_rank_value")))
    return df.join(ranked, cond, "left").drop("_rank_group", "_rank_value")


def run_starts(rows: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Rows whose predecessor (same keys, ``order_col`` - 1) is absent."""
    previous = rows.select(*keys, (F.col(order_col) + 1).alias(order_col))
    return rows.join(previous, [*keys, order_col], "left_anti")
