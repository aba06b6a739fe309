"""Skew-safe sequence operators equal their window-function definitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from basketflow.operators.sequence import blocked_running_sum, dense_rank_desc, run_starts


def _rows(seed=7, users=12, max_len=40):
    rnd = random.Random(seed)
    out = []
    for u in range(users):
        n = rnd.randint(1, max_len)
        for k in range(1, n + 1):
            out.append((u, k, rnd.choice([None, 0, 1, 2, 5, 30])))
    return out


def test_blocked_running_sum_matches_window(spark):
    df = spark.createDataFrame(_rows(), "user_id long, seq int, v int")
    w = Window.partitionBy("user_id").orderBy("seq")
    expected = df.withColumn("want", F.sum(F.coalesce("v", F.lit(0))).over(w)) \
        .withColumn("want_max", F.max("seq").over(Window.partitionBy("user_id")))
    for block in (1, 3, 7, 1024):
        got = blocked_running_sum(df, "user_id", "seq", F.coalesce("v", F.lit(0)), "got", block,
                                  key_maxes={"got_max": F.col("seq")})
        cmp = got.join(expected, ["user_id", "seq"])
        assert cmp.count() == df.count()
        assert cmp.filter("got != want OR got_max != want_max").count() == 0


def test_blocked_running_sum_range_ties(spark):
    # Equal sequence numbers are peers of the RANGE frame.
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 2, 3), (1, 3, 4)], "k long, s int, v int")
    got = {(r["s"], r["v"]): r["c"] for r in
           blocked_running_sum(df, "k", "s", F.col("v"), "c", 2).collect()}
    assert got == {(1, 1): 1, (2, 2): 6, (2, 3): 6, (3, 4): 10}


def test_dense_rank_desc_matches_window(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([None, 1, 2, 3]), rnd.randint(1, 6)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, g int, n long")
    want = df.withColumn("want", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("n"))))
    got = dense_rank_desc(df, "g", "n", "got")
    cmp = got.join(want.select("id", "want"), "id")
    assert cmp.count() == 200
    assert cmp.filter("got != want").count() == 0


def test_run_starts_give_gaps_and_islands_streak(spark):
    rnd = random.Random(11)
    rows = []
    for u in range(30):
        last = rnd.randint(1, 15)
        for k in range(1, last + 1):
            if rnd.random() < 0.6 or k == last:
                rows.append((u, 1, k, last))
    df = spark.createDataFrame(rows, "user_id long, product_id long, order_number int, last int")
    starts = run_starts(df, ["user_id", "product_id"], "order_number")
    latest = starts.groupBy("user_id").agg(F.max("order_number").alias("s"), F.max("last").alias("last"))
    got = {r["user_id"]: r["last"] - r["s"] + 1 for r in latest.collect()}
    expected = {}
    for u in range(30):
        mine = sorted(k for (uu, _, k, _) in rows if uu == u)
        last = max(mine)
        streak, k = 0, last
        while k in mine:
            streak, k = streak + 1, k - 1
        expected[u] = streak
    assert got == expected


def test_blocked_running_sum_rows_without_position(spark):
    """They count in the key's sums and move nobody's running sum."""
    rows = [(1, 1, 5), (1, 2, 6), (1, None, 0), (1, None, 0), (2, None, 0)]
    df = spark.createDataFrame(rows, "k long, s int, v int").withColumn("row", F.monotonically_increasing_id())
    got = blocked_running_sum(df, "k", "s", F.col("v"), "c", 2, key_sums={"n": F.lit(1)})
    assert sorted((r["k"], r["s"] or 0, r["n"], r["c"]) for r in got.collect() if r["s"]) == [(1, 1, 4, 5), (1, 2, 4, 11)]
    assert {(r["k"], r["n"]) for r in got.collect()} == {(1, 4), (2, 1)}


def test_filters_and_projection_reach_the_scan(spark, small_sources):
    from basketflow.operators import product
    df = product.p06_product_first_order_count(small_sources)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scan) == 1
    assert "EqualTo(order_number,1)" in scan[0]                  # pushed into Parquet
    assert "ReadSchema: struct<product_id:bigint,order_number:int>" in scan[0]  # 2 of ~20 columns
