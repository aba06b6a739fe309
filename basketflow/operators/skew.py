"""Joins on keys that may hold a large share of all rows.

Which keys are heavy is found once, from counts that are stored anyway
(``heavy_keys``): those with more rows than ``limit``, of which there are at most
``MOST_HEAVY``, because their rows add up to the whole.  ``salted_join`` cuts a
heavy key's rows into parts of about ``limit`` rows and repeats the few matching
rows of the other side, one for each part, so no task meets a heavy key as a
whole, whatever AQE makes of the partition sizes.  Without heavy keys it is the
plain join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_HEAVY = 1000  # bound of the number of heavy keys, and so of what is broadcast
PART_ROWS = 1_000_000  # rows of one key that a task may meet at least


def heavy_keys(counts: DataFrame, keys: list[str], n: str, part_rows: int = PART_ROWS,
               most: int = MOST_HEAVY) -> DataFrame:
    """(keys, ``parts``) of the keys with more than ``limit`` rows, at most
    ``most`` of them.  ``counts`` holds the number of rows ``n`` of each key."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    limit = max(part_rows, total // most + 1)
    return counts.where(F.col(n) > limit).select(*keys, F.ceil(F.col(n) / F.lit(limit)).cast("int").alias("parts"))


@dataclass(frozen=True)
class Heavy:
    """A bounded list of heavy keys and the parts they are cut into."""

    schema: T.StructType | None = None
    rows: tuple = ()

    @classmethod
    def of(cls, found: DataFrame) -> "Heavy":
        """From a ``heavy_keys`` table (at most ``MOST_HEAVY`` rows)."""
        return cls(found.schema, tuple(tuple(r) for r in found.collect()))


NONE = Heavy()


def _with_parts(df: DataFrame, keys: list[str], heavy: Heavy) -> DataFrame:
    named = T.StructType([T.StructField(f"_heavy_{f.name}", f.dataType) for f in heavy.schema])
    table = df.sparkSession.createDataFrame(list(heavy.rows), named)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys])
    return (df.join(F.broadcast(table), same, "left").withColumn("_parts", F.coalesce("_heavy_parts", F.lit(1)))
            .drop(*named.names))


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], heavy: Heavy, spread: list[str], how: str = "left",
                null_safe: bool = False) -> DataFrame:
    """``big`` joined with ``small`` (few rows per key) on ``keys``.

    ``spread`` names columns of ``big`` that tell a key's rows apart: their
    hash deals a heavy key's rows to its parts.  Rows with a NULL key, if they
    are heavy, are dealt like any other key's; whether NULL meets NULL is up
    to ``null_safe``."""
    if not heavy.rows:
        if not null_safe:
            return big.join(small, keys, how)
        big, small = big.withColumn("_salt", F.lit(0)), small.withColumn("_salt", F.lit(0))
    else:
        big = _with_parts(big, keys, heavy).withColumn(
            "_salt", F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int")).drop("_parts")
        small = _with_parts(small, keys, heavy).withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        if not null_safe:
            return big.join(small, [*keys, "_salt"], how).drop("_salt")
    other = small.withColumnsRenamed({k: f"_other_{k}" for k in [*keys, "_salt"]})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in [*keys, "_salt"]])
    return big.join(other, same, how).drop(*[f"_other_{k}" for k in [*keys, "_salt"]], "_salt")
