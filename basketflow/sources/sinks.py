"""Table sinks: Parquet tables that are replaced as a whole, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from basketflow.sources.store import hadoop


def _split(path: str) -> tuple[str, str]:
    folder, name = path.rstrip("/").rsplit("/", 1)
    return folder, name


def _aside(spark: SparkSession, path: str) -> list[str]:
    """Replaced versions of the table that are still there.  Their names start
    with a dot, so no reader takes them for data."""
    make, fs = hadoop(spark, path)
    folder, name = _split(path)
    return sorted(f.getPath().toString() for f in fs.globStatus(make(f"{folder}/.{name}-replaced-*")) or [])


def recover(spark: SparkSession, path: str) -> None:
    """Put the replaced version back, if a writer was lost between taking it
    away and publishing the new one."""
    make, fs = hadoop(spark, path)
    if not fs.exists(make(path)):
        for old in _aside(spark, path)[:1]:
            fs.rename(make(old), make(path))


def write_table(df: DataFrame, path: str, observe: dict[str, Column] | None = None) -> dict:
    """Create-table-as-select: replace the table at ``path`` (idempotent
    rebuild).  Returns what was observed while the rows were written.

    The new version is written in full beside the old one, which stays
    readable until then; a build that fails or is killed leaves it as it was.
    Publishing is two renames by the driver: the old version aside, the new one
    into its place.  If the driver is lost between the two, ``read_table`` and
    the next ``write_table`` put the old version back.  (On stores without
    renames these copy; the order is the same.)"""
    spark = df.sparkSession
    make, fs = hadoop(spark, path)
    folder, name = _split(path)
    fresh, old = (f"{folder}/.{name}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "replaced"))
    seen = None
    if observe:
        seen = Observation()
        df = df.observe(seen, *[c.alias(n) for n, c in observe.items()])
    try:
        df.write.parquet(fresh)
    except BaseException:
        fs.delete(make(fresh), True)
        raise
    metrics = dict(seen.get) if seen else {}
    recover(spark, path)
    if fs.exists(make(path)) and not fs.rename(make(path), make(old)):
        raise OSError(f"cannot replace {path}")
    if not fs.rename(make(fresh), make(path)):
        recover(spark, path)
        raise OSError(f"cannot publish {path}")
    for replaced in _aside(spark, path):
        fs.delete(make(replaced), True)
    return metrics


def read_table(spark: SparkSession, path: str) -> DataFrame:
    recover(spark, path)
    return spark.read.parquet(path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Materialise ``df`` and continue from the stored copy (cuts lineage)."""
    write_table(df, path)
    return read_table(df.sparkSession, path)
