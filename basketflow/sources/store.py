"""Stored tables that are derived once and reused while nothing has changed.

A folder is keyed by the state of the input files (path, length and
modification time of every file, through the Hadoop file system)
and by a digest of the package source.  Changed input or code leads to another
folder; nothing is ever overwritten.  Every writer writes a copy of its own and
then publishes it: a small file names the finished copy, its schema,
its layout and what was observed while it was written.  Readers take the first
copy that is published.  Two applications that build the same table at the same
time therefore write two equal copies and agree on one.

Tables that are resolved once stay resolved: as long as the input state is the
same, a process neither reads a schema nor plans a source again (``once``).
"""

from __future__ import annotations

import hashlib
import json
import os
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.session import ensure_checkpoint_dir

V = TypeVar("V")

_CODE_VERSION: list[str] = []


def code_version() -> str:
    """Digest of the package sources."""
    if not _CODE_VERSION:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        digest = hashlib.sha1()
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), "rb") as fh:
                        digest.update(name.encode() + fh.read())
        _CODE_VERSION.append(digest.hexdigest()[:12])
    return _CODE_VERSION[0]


FEW_FILES = 1000
# Hadoop's Path class and file systems by application and scheme: looking them
# up anew costs more than listing the files.
_HADOOP: dict[tuple[str, str], tuple] = {}


def hadoop(spark: SparkSession, path: str) -> tuple:
    """(Path class, file system) for ``path``."""
    sc = spark.sparkContext
    key = (sc.applicationId, path.split("//", 1)[0] + path.split("//", 1)[1].split("/", 1)[0] if "://" in path else "")
    if key not in _HADOOP:
        make = sc._jvm.org.apache.hadoop.fs.Path
        _HADOOP[key] = make, make(path).getFileSystem(sc._jsc.hadoopConfiguration())
    return _HADOOP[key]


def _few_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]] | None:
    """(path, length, modification time) of the files at ``path``, listed by
    the driver; None if there are more than ``FEW_FILES``."""
    make, fs = hadoop(spark, path)
    found = []

    def add(f) -> None:
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))

    for top in fs.globStatus(make(path)) or []:
        if top.isFile():
            add(top)
            continue
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext() and len(found) <= FEW_FILES:
            add(files.next())
    return sorted(found) if len(found) <= FEW_FILES else None


def input_state(spark: SparkSession, path: str) -> str:
    """Digest of the files at ``path`` (a file, a folder or a pattern).  A few
    files are listed by the driver, many by a Spark job that returns one row."""
    few = _few_files(spark, path)
    if few is not None:
        return hashlib.sha1(repr(few).encode()).hexdigest()
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.xxhash64("path", "length", F.unix_micros("modificationTime")).alias("h")))
    state = files.agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("a"),
                      F.bit_xor("h").alias("b")).first()
    return f"{state.n}:{state.a}:{state.b}"


def folder_of(spark: SparkSession, kind: str, paths: list[str], *parts: str) -> str:
    """The shared folder for tables derived from these input paths now."""
    state = "|".join([kind, code_version(), *parts, *paths, *(input_state(spark, p) for p in paths)])
    key = hashlib.sha1(state.encode()).hexdigest()[:20]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketflow-{kind}/{key}"


@dataclass(frozen=True)
class Published:
    """What a writer says about its finished copy."""

    copy: str
    schema: str
    partition_by: str | None = None
    bucket_by: str | None = None
    buckets: int = 0
    metrics: dict = field(default_factory=dict)


def published_copy(spark: SparkSession, folder: str) -> Published | None:
    """The first published copy of a table, if there is one."""
    make, fs = hadoop(spark, folder)
    if not fs.exists(make(f"{folder}/published")):
        return None
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString
    found = []
    for f in fs.listStatus(make(f"{folder}/published")):  # one small file per writer
        if not f.getPath().getName().startswith("."):
            stream = fs.open(f.getPath())
            found.append(Published(**json.loads(text(stream, "UTF-8"))))
            stream.close()
    return min(found, key=lambda p: p.copy, default=None)


# Handles of stored tables that this process has resolved, and what was built
# from them.  A folder's content never changes, so a handle stays valid.
_RESOLVED: dict[tuple[SparkSession, str], tuple[DataFrame, Published]] = {}
_ONCE: dict[tuple[SparkSession, str, str], object] = {}
# One writer per process: queries that are submitted from several threads
# wait for each other instead of building a table twice.
STORE_LOCK = threading.RLock()


def once(spark: SparkSession, kind: str, folder: str, build: Callable[[], V]) -> V:
    """``build()``, called once per session for a keyed folder."""
    key = (spark, kind, folder)
    with STORE_LOCK:
        if key not in _ONCE:
            _ONCE[key] = build()
        return _ONCE[key]


def _table_name(path: str) -> str:
    return f"basketflow_{hashlib.sha1(path.encode()).hexdigest()[:20]}"


def open_copy(spark: SparkSession, folder: str, made: Published) -> DataFrame:
    """The copy as a DataFrame, by its published schema (no file is read).  A
    bucketed copy is entered in the session's catalogue, from which Spark
    knows how it is laid out."""
    path, schema = f"{folder}/{made.copy}", T.StructType.fromJson(json.loads(made.schema))
    if not made.bucket_by:
        return spark.read.schema(schema).parquet(path)
    name, quoted = _table_name(path), path.replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{made.bucket_by}`) "
              f"SORTED BY (`{made.bucket_by}`) INTO {made.buckets} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)


# Spark's own removal of a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files when it ends.  Else they
    stay until the driver's JVM happens to collect the plans, so a query over a
    fresh store would hold the exchanges of all the tables it stores at once."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, old)


def write_copy(df: DataFrame, folder: str, partition_by: str | None = None, bucket_by: str | None = None,
               observe: dict[str, Column] | None = None) -> Published:
    """Write a new copy of a table and say what it is (not yet published).

    ``observe`` names aggregates that are taken while the rows are written.
    They stand directly before the write, so every output partition counts
    once, also if a task runs again."""
    spark = df.sparkSession
    copy, buckets, seen = uuid.uuid4().hex, 0, None
    schema = df.schema.json()
    if bucket_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(buckets, bucket_by)
    if observe:
        seen = Observation()
        df = df.observe(seen, *[c.alias(name) for name, c in observe.items()])
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    path = f"{folder}/{copy}"
    with shuffles_removed(spark):
        if bucket_by:
            (writer.format("parquet").bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", path)
             .saveAsTable(_table_name(path)))
        else:
            writer.parquet(path)
    return Published(copy, schema, partition_by, bucket_by, buckets, dict(seen.get) if seen else {})


def publish(spark: SparkSession, folder: str, made: Published) -> None:
    """Name the finished copy.  The file appears under its name when it is
    complete."""
    make, fs = hadoop(spark, folder)
    hidden = make(f"{folder}/published/.{made.copy}")
    out = fs.create(hidden)
    out.write(bytearray(json.dumps(made.__dict__).encode()))
    out.close()
    if not fs.rename(hidden, make(f"{folder}/published/{made.copy}")):
        raise OSError(f"cannot publish {folder}")


def _resolve(spark: SparkSession, folder: str, build: Callable[[], DataFrame] | None, **layout) -> tuple[DataFrame, Published]:
    key = (spark, folder)
    with STORE_LOCK:
        if key not in _RESOLVED:
            if published_copy(spark, folder) is None:
                publish(spark, folder, write_copy(build(), folder, **layout))
            made = published_copy(spark, folder)
            _RESOLVED[key] = open_copy(spark, folder, made), made
        return _RESOLVED[key]


def materialise(spark: SparkSession, folder: str, build: Callable[[], DataFrame], **layout) -> DataFrame:
    """The table stored at ``folder``, written from ``build()`` first if no
    published copy is there (``layout`` as for ``write_copy``)."""
    return _resolve(spark, folder, build, **layout)[0]


def observed(spark: SparkSession, folder: str) -> dict:
    """What was observed while the table at ``folder`` was written (it must
    have been materialised)."""
    return _resolve(spark, folder, None)[1].metrics
