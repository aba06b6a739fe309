"""Most frequent values from counts of any size."""

import random
from collections import Counter

import pytest

from basketflow.functions import best_value, mode_of_counts

BIG = 2 ** 31


@pytest.mark.parametrize("type_", ["int", "long", "string"])
def test_against_plain_counts(spark, type_):
    rnd = random.Random(7)
    rows = [(rnd.randrange(40), rnd.choice([None, *range(5)]), rnd.randrange(1, 4)) for _ in range(600)] + [(99, None, 3)]
    df = spark.createDataFrame(rows, "k int, v int, n long").selectExpr("k", f"cast(v as {type_}) v", "n")
    want = {}
    for k in {r[0] for r in rows}:
        counts = Counter()
        for key, v, n in rows:
            if key == k and v is not None:
                counts[v] += n
        want[k] = min(counts, key=lambda v: (-counts[v], v)) if counts else None
    got = {r.k: r.m for r in mode_of_counts(df, ["k"], "v", "n", "m").collect()}
    assert got == {k: str(v) if type_ == "string" and v is not None else v for k, v in want.items()}


def test_counts_above_two_to_the_31(spark):
    rows = [(1, 3, 2 * BIG), (1, 2, 2 * BIG), (1, 9, BIG), (1, None, 9 * BIG),
            (2, -5, 2 ** 62), (2, 4, 2 ** 62 - 1), (3, 2 ** 31 - 1, 5), (3, -2 ** 31, 5)]
    df = spark.createDataFrame(rows, "k int, v int, n long")
    got = {r.k: r.m for r in mode_of_counts(df, ["k"], "v", "n", "m").collect()}
    assert got == {1: 2, 2: -5, 3: -2 ** 31}


def test_no_exchange_where_rows_are_dealt_by_key(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, v int, n long").repartition("k")
    plan = best_value(df, ["k"], "v", "n", "m")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "SortAggregate" not in plan
