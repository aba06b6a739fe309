"""Corpus pipeline: quality, near-duplicates, contamination, secrets, tokens.

``run`` applies the ``STAGES`` to ``documents`` in order; each stage's result is
written as Parquet in the shared folder and read back as the next one's input,
so a lost executor costs at most the running stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import bpe, cotrain, decontam, near_dup, secret_forest
from basketflow.llm.common import stored, work_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    meta = ["source", "lang", "n_chars"]
    views = cotrain.fit(docs, _table(spark, sf_dir, "labels"), meta)
    return cotrain.score(docs, views).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles,
    similarity 0.8): the one with the smallest id.  Rows that repeat an id stay
    or go together."""
    found = near_dup.near_duplicates(docs, shingle=5, percent=80)
    dropped = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct(),
                     work_folder(spark, "dropped"))
    return near_dup.without_ids(docs, dropped)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go (a twentieth of the words or more stands in
    benchmark passages); passages in other documents are cut out."""
    found = decontam.contamination_spans(docs, _table(spark, sf_dir, "benchmark"))
    clean = found.where(~F.coalesce(decontam.is_contaminated(F.col("n_words"), decontam.hit_words()), F.lit(False)))
    return clean.withColumn("text", decontam.without_spans()).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    return secret_forest.redact(docs, secret_forest.scan(docs, path_col="source"))


# Python workers live on through all stages with what they once took, beside a
# JVM that takes its whole heap: words that one holds at a time.
HELD_WORDS = 50_000


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The whole texts as BPE ids (little-endian unsigned 32-bit integers)."""
    rows = docs.select("doc_id", "source", "lang", "text")
    lexicon = bpe.build_lexicon(rows, public_tokenizers.path("byte_bpe_50k.json"), held=HELD_WORDS)
    return bpe.encode(rows, lexicon, remember=HELD_WORDS).select("doc_id", "source", "lang",
                                            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("tokens", tokens)]

# The classifiers and the tokenizer are not SQL: the stages are tested against
# brute-force versions.
ORACLE_SQL = None


# Whole texts go to the Python workers in batches of so many rows: a batch stands
# in the JVM and in the worker, once on the way in and once on the way out.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    before = spark.conf.get(_BATCH)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    finally:
        spark.conf.set(_BATCH, before)
    return docs
