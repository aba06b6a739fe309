"""CSV records with line ends in quoted fields: many tasks give what one task
gives."""

import random

import pytest
from pyspark.sql import types as T

from basketflow.sources.csvsplit import read_split_csv, records, split_lines

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("n", T.IntegerType())])


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def by_one_task(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).option("header", True).option("mode", "FAILFAST")
                      .option("quote", '"').option("escape", '"').option("multiLine", True).csv(path).collect()), key=str)


def write(path, n, seed, end="\n", last=True):
    rnd = random.Random(seed)
    rows = ["id,name,n"]
    for k in range(n):
        name = rnd.choice(["plain", "", '""', '"a, b"', '"two\nlines"', '"""quoted"" and\n\nmore"', '"' + "x\n" * 60 + '"',
                           '"ends with a line end\n"', '"\nstarts"', '"5"" tart"', "déjà vu"])
        rows.append(f"{k},{name},{rnd.choice(['', k])}")
    path.write_text(end.join(rows) + (end if last else ""), newline="")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_one_task_read(spark, tmp_path, small_splits, seed):
    path = tmp_path / "in.csv"
    write(path, 200, seed, last=seed != 2)
    lines = split_lines(spark, str(path))
    assert lines.rdd.getNumPartitions() > 20  # not one task
    got = sorted(map(tuple, read_split_csv(spark, str(path), SCHEMA).collect()), key=str)
    assert got == by_one_task(spark, str(path)) and len(got) == 200


def test_several_files_and_carriage_returns(spark, tmp_path, small_splits):
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        write(tmp_path / f"{k}.csv", 40, 10 + k, end)
    got = sorted(map(tuple, read_split_csv(spark, str(tmp_path / "*.csv"), SCHEMA).collect()), key=str)
    assert got == by_one_task(spark, str(tmp_path / "*.csv")) and len(got) == 120


def test_one_field_over_many_splits(spark, tmp_path, small_splits):
    text = "\n".join(f"line {k}" for k in range(500))
    path = tmp_path / "in.csv"
    path.write_text(f'id,name,n\n1,"{text}",1\n2,b,2\n')
    got = {r.id: r.name for r in read_split_csv(spark, str(path), SCHEMA).collect()}
    assert got == {1: text, 2: "b"}
    assert records(split_lines(spark, str(path))).count() == 3


def test_empty_and_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,name,n\n")
    assert read_split_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect() == []
    assert read_split_csv(spark, str(tmp_path / "b.csv"), SCHEMA).collect() == []


def test_rows_that_do_not_fit_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,n\n1,x,not a number\n")
    with pytest.raises(Exception):
        read_split_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()
