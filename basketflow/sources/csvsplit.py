"""CSV records with line ends inside quoted fields, read by many tasks.

Spark splits a CSV file at line ends only if no field holds one; otherwise one
task reads the whole file.  Here the file is read as lines, by splits.  A line
end ends a record if the quotes before it, from the start of the file, are even
in number (a doubled quote inside a field counts twice and changes nothing).
So every split is counted on its own, a prefix sum over the splits (one row
each) tells the parity at the start of every split, and a running sum inside a
split tells it for every line.  Lines that are records by themselves - nearly
all - are parsed as they are; only the lines of longer records, which may begin
in one split and end in a later one, are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLIT = ["_file", "_start"]  # a split: its file and first byte
_ORDER = ["_start", "_line"]  # of the lines of a file


def _quotes(column: str) -> Column:
    return F.length(column) - F.length(F.replace(F.col(column), F.lit('"'), F.lit("")))


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the files with their split and order.  A line belongs to
    the split in which it starts, and a split is read by one task in order, so
    a counter that grows within a task orders its lines."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_start"),
                        F.monotonically_increasing_id().alias("_line"), _quotes("value").alias("_quotes"))


def marked_lines(lines: DataFrame) -> DataFrame:
    """Lines with ``_first`` (it starts a record), ``_whole`` (it is one) and
    ``_record``, the (split, line) at which its record starts."""
    in_split = Window.partitionBy(*_SPLIT).orderBy("_line")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    up_to = in_split.rowsBetween(Window.unboundedPreceding, 0)
    # Parity at the start of every split, from the quotes of those before it.
    splits = lines.groupBy(*_SPLIT).agg(F.sum("_quotes").alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(*_SPLIT, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_quotes_before"))
    at = lines.join(splits, _SPLIT)
    quotes = F.col("_quotes_before") + F.coalesce(F.sum("_quotes").over(before), F.lit(0))
    at = at.withColumn("_first", F.pmod(quotes, F.lit(2)) == 0)
    at = at.withColumn("_whole", F.col("_first") & (F.pmod("_quotes", F.lit(2)) == 0))
    own = F.last(F.when(F.col("_first"), F.struct("_start", "_line")), ignorenulls=True).over(up_to)
    return at.withColumn("_record", own).drop("_quotes_before")


def records(lines: DataFrame) -> DataFrame:
    """One row per CSV record: ``_file``, ``_start``, ``_line`` (where it
    starts) and its ``text``."""
    marked = marked_lines(lines)
    whole = marked.where("_whole").select("_file", *_ORDER, F.col("value").alias("text"))
    parts = marked.where("not _whole")
    # The head of a split may go on with a record of an earlier one: the last
    # record start of the splits before it.
    starts = parts.groupBy(*_SPLIT).agg(F.max(F.when(F.col("_first"), F.struct("_start", "_line"))).alias("_last"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(*_SPLIT, F.last("_last", ignorenulls=True).over(earlier).alias("_open"))
    parts = parts.join(starts, _SPLIT).withColumn("_record", F.coalesce("_record", "_open"))
    joined = (parts.groupBy("_file", "_record")
              .agg(F.sort_array(F.collect_list(F.struct("_start", "_line", "value"))).alias("_lines"))
              .select("_file", F.col("_record._start").alias("_start"), F.col("_record._line").alias("_line"),
                      F.array_join(F.transform("_lines", lambda x: x["value"]), "\n").alias("text")))
    return whole.unionByName(joined)


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The CSV files at ``path`` (header row in each, quotes doubled inside
    quoted fields, rows that don't fit fail the read), by many tasks."""
    found = records(split_lines(spark, path))
    # The header is the first record of its file.
    heads = found.groupBy("_file").agg(F.min(F.struct("_start", "_line")).alias("_head"))
    body = found.join(heads, "_file").where(F.struct("_start", "_line") != F.col("_head"))
    text = F.rtrim(F.col("text"), F.lit("\r"))
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"'}
    parsed = body.where(F.length(text) > 0).select(
        F.from_csv(text, F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)), options).alias("r"))
    return parsed.select("r.*")
