"""Small column helpers.  Everything is a built-in expression, so it stays
inside whole-stage code generation; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_lines() -> Column:
    """``COUNT(*)`` as a long."""
    return F.count(F.lit(1))


def nullif_zero(col: Column) -> Column:
    """Division guard: a zero denominator becomes NULL (so the ratio is NULL)."""
    return F.nullif(col, F.lit(0))


def rate(numerator: Column, denominator: Column) -> Column:
    """Ratio as double.  No guard: a zero denominator raises in ANSI mode,
    exactly where the model has no guard either."""
    return numerator.cast("double") / denominator.cast("double")


def as_flag(condition: Column) -> Column:
    """Boolean -> 1/0 integer; a NULL condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def flag_max(condition: Column) -> Column:
    """Aggregate: 1 if the condition holds on any row of the group."""
    return F.max(as_flag(condition))


def share_of(condition: Column) -> Column:
    """Aggregate: share of rows on which the condition holds."""
    return F.avg(as_flag(condition).cast("double"))


def avg_double(col: Column) -> Column:
    """Mean as double (NULLs skipped)."""
    return F.avg(col.cast("double"))


def mode_of_counts(counts: DataFrame, keys: list[str], value: str, n: str, out: str) -> DataFrame:
    """Per ``keys``: the ``value`` of the largest summed count ``n``, the
    smallest one on ties, NULL values skipped (NULL if there are no others).

    Works on counts by key and value, never on rows.  The sums by key and
    value are dealt by key once; the largest count is found in two steps that
    both stay where the rows are: the smallest value of every count, and of
    these the value of the largest count.  Counts are compared as they are, so
    nothing can overflow that the counts themselves don't."""
    by_value = counts.groupBy(*keys, value).agg(F.sum(n).alias("_n")).repartition(*keys)
    return best_value(by_value, keys, value, "_n", out)


def best_value(by_value: DataFrame, keys: list[str], value: str, n: str, out: str) -> DataFrame:
    """The mode from one row per ``keys`` and ``value``: two hash aggregations,
    without an exchange where ``by_value`` is dealt by ``keys``."""
    known = F.when(F.col(value).isNotNull(), F.col(n)).otherwise(F.lit(-1).cast("long")).alias("_k")
    levels = by_value.select(*keys, value, known).groupBy(*keys, "_k").agg(F.min(value).alias("_v"))
    return levels.groupBy(*keys).agg(F.max_by("_v", "_k").alias(out))


def significant(col: Column, digits: int = 12) -> Column:
    """Rounded to so many significant digits."""
    return F.when(col.isNotNull(), F.format_string(f"%.{digits - 1}e", col).cast("double"))
