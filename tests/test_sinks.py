"""A table is replaced as a whole: a build that fails or is killed leaves the
old version readable."""

import os

import pytest
from pyspark.sql import functions as F

from basketflow.sources import sinks


def ids(spark, path):
    return sorted(r.id for r in sinks.read_table(spark, path).collect())


def test_replacement(spark, tmp_path):
    path = str(tmp_path / "out" / "t")
    sinks.write_table(spark.range(3), path)
    assert ids(spark, path) == [0, 1, 2]
    seen = sinks.write_table(spark.range(5, 7), path, {"rows": F.count(F.lit(1)), "most": F.max("id")})
    assert ids(spark, path) == [5, 6] and seen == {"rows": 2, "most": 6}
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [5, 6]  # by any reader
    assert os.listdir(tmp_path / "out") == ["t"]  # nothing is left behind


def test_a_failed_build_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.write_table(spark.range(10, 13).withColumn("id", F.expr("id div (id - 12)")), path)
    assert ids(spark, path) == [0, 1, 2]
    assert os.listdir(tmp_path) == ["t"]


def test_a_table_may_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    sinks.write_table(sinks.read_table(spark, path).select((F.col("id") + 10).alias("id")), path)
    assert ids(spark, path) == [10, 11, 12]


@pytest.mark.parametrize("moment", ["before the publish", "between the renames"])
def test_a_killed_build_leaves_the_old_table(spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)

    class Killed(BaseException):
        pass

    make, fs = sinks.hadoop(spark, path)

    class Dying:
        """A file system whose user is lost at a moment."""

        def __getattr__(self, name):
            return getattr(fs, name)

        def rename(self, a, b):
            if moment == "before the publish" or "-new-" in a.toString():
                raise Killed
            return fs.rename(a, b)

    monkeypatch.setattr(sinks, "hadoop", lambda *_: (make, Dying()))
    with pytest.raises(Killed):
        sinks.write_table(spark.range(5, 9), path)
    monkeypatch.undo()
    assert os.path.exists(path) == (moment == "before the publish")
    assert ids(spark, path) == [0, 1, 2]  # put back, if it was taken away
    sinks.write_table(spark.range(5, 9), path)
    assert ids(spark, path) == [5, 6, 7, 8]
