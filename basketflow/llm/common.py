"""Helpers shared by the training-data operators: the shared work folder,
shipping the package to executors, and vectorised word tables over Arrow text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.session import ensure_checkpoint_dir

# Text is cut into chunks of about this many bytes inside a task (a longer
# text is a chunk of its own), so temporary arrays stay small.
CHUNK_BYTES = 2 << 20
# Words are found in blocks of rows of about this many bytes: a byte takes some
# forty in temporary arrays.
WORD_BYTES = 1 << 18

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were not started
    with it on their path (one small zip per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="basketflow-zip-"), "basketflow_llm_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, one per call, so
    that runs never read each other's tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start
    from the stored table, whatever executors are lost."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ROWS_OF_PARTITION = 33  # bits that monotonically_increasing_id keeps for a partition's rows


def numbered(rows: DataFrame, group: str, order: list[str], folder: str) -> DataFrame:
    """``rows`` with ``position`` (from 0, by ``order``, nulls first) among the
    rows of equal ``group`` (null is a group) and ``group_rows``, their number.

    Rows are dealt by ranges of (group, order), so a large group fills many
    tasks; rows equal in both are dealt by their place in the input.  What meets
    in one place is one row per group and range.  ``rows`` must not hold
    columns named ``_*``."""
    keys = [F.col(c).asc_nulls_first() for c in [group, *order, "_place"]]
    dealt = stored(rows.withColumn("_place", F.monotonically_increasing_id())
                   .repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .drop("_place").withColumn("_at", F.monotonically_increasing_id()), f"{folder}/dealt")
    dealt = dealt.withColumn("_range", F.shiftright("_at", _ROWS_OF_PARTITION))
    runs = dealt.groupBy("_range", F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("_range").alias("_run"), "_group", "_first",
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                       F.sum("_n").over(whole).alias("group_rows"))
    return (dealt.join(runs, (F.col("_range") == F.col("_run")) & F.col(group).eqNullSafe(F.col("_group")))
            .withColumn("position", F.col("_before") + F.col("_at") - F.col("_first"))
            .select(*rows.columns, "position", "group_rows"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (of UTF-8 for text) and row offsets (int64, n + 1) of a string or
    binary column; null rows are empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    large = pa.large_binary() if binary else pa.large_string()
    if column.type != large:
        column = column.cast(large)
    if column.null_count:
        column = column.fill_null(b"" if binary else "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges of at most ``limit`` bytes (or one row)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def byte_table(separators: str | set[int], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(is word byte, folded byte) by byte value; A-Z fold to a-z."""
    word = np.ones(256, bool)
    word[[b if isinstance(b, int) else ord(b) for b in separators]] = False
    fold = np.arange(256, dtype=np.uint64)
    if lower:
        fold[65:91] += 32
    return word, fold


_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:  # a single very long text does not stay cached
            _POWERS[base] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(data: np.ndarray, offs: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
    """Word starts, ends (byte positions), 64-bit hashes of the folded words
    and word offsets by row (n + 1).  No word crosses rows.

    The hash is a polynomial over the folded bytes, taken for every word of a
    block at once from one running sum: (S[end] - S[start]) / R^start modulo
    2^64."""
    if len(data) <= WORD_BYTES or len(offs) == 2:
        return _block_words(data, offs, table)
    starts, ends, hashes, by_row, found = [], [], [], [np.zeros(1, np.int64)], 0
    for i, j in chunks(offs, WORD_BYTES):
        s, e, h, own = _block_words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], table)
        starts.append(s + offs[i])
        ends.append(e + offs[i])
        hashes.append(h)
        by_row.append(own[1:] + found)
        found += len(s)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes), np.concatenate(by_row)


def _block_words(data: np.ndarray, offs: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
    is_word, fold = table
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    inside = is_word[data]
    first = np.zeros(n + 1, bool)  # first byte of a row
    first[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    running = np.zeros(n + 1, np.uint64)
    np.cumsum((fold[data] + np.uint64(1)) * _powers(_R, n), out=running[1:])
    h = (running[e] - running[s]) * _powers(_R_INVERSE, n)[s]
    h = mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return s, e, h, np.searchsorted(s, offs)


def word_hashes(text: str, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    return words(data, np.array([0, len(data)]), table)[2]
