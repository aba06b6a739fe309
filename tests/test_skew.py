"""A user holding most of the orders: results stay exact, and no window
partition spans all of a user's orders or all of a pair's lines."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketflow.operators import skew
from basketflow.plans import facts, mldataset, tables
from basketflow.plans.pipeline import stored_sources
from basketflow.sources.readers import Sources
from basketflow.sources.schema import SCHEMAS

HOT_ORDERS = 3000


@pytest.fixture(scope="module")
def hot(spark):
    rnd = random.Random(5)
    orders, prior = [], []
    oid = 0
    for user, n_orders in [(0, HOT_ORDERS)] + [(u, rnd.randint(2, 6)) for u in range(1, 21)]:
        seen = set()
        for k in range(1, n_orders + 1):
            oid += 1
            gap = None if k == 1 else Decimal(rnd.choice([0, 1, 3, 7, 30]))
            orders.append((oid, user, "prior", k, rnd.randint(0, 6), rnd.randint(0, 23), gap))
            basket = [p for p in (1, 2, 3) if rnd.random() < (0.9 if p == 1 else 0.3)] or [4]
            for pos, p in enumerate(basket, 1):
                prior.append((oid, p, pos, (user, p) in seen))
                seen.add((user, p))

    def df(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])
    return Sources(
        aisles=df("aisles", [(1, "a")]), departments=df("departments", [(1, "d")]),
        orders=df("orders", orders),
        products=df("products", [(p, f"p{p}", 1, 1) for p in (1, 2, 3, 4)]),
        order_products_prior=df("order_products_prior", prior),
        order_products_train=df("order_products_train", []),
    ), orders, prior


def test_blocked_timeline_is_exact(hot):
    src, _, _ = hot
    got = facts.order_timeline(src, block_rows=64)
    w = Window.partitionBy("user_id").orderBy("order_number")
    want = src.orders.select("order_id", F.sum(F.coalesce("days_since_prior_order", F.lit(0))).over(w)
                             .alias("want"))
    cmp = got.join(want, "order_id")
    assert cmp.count() == src.orders.count()
    assert cmp.filter("cumulative_days != want").count() == 0
    hot_row = got.filter("user_id = 0").select("user_max_order_number", "user_total_orders").first()
    assert tuple(hot_row) == (HOT_ORDERS, HOT_ORDERS)


def test_streaks_match_brute_force(hot):
    src, orders, prior = hot
    number = {o[0]: (o[1], o[3]) for o in orders}
    bought = {}
    for oid, p, _, _ in prior:
        u, k = number[oid]
        bought.setdefault((u, p), set()).add(k)
    last = {}
    for _, u, _, k, _, _, _ in orders:
        last[u] = max(last.get(u, 0), k)
    want = {}
    for (u, p), ks in bought.items():
        k, s = last[u], 0
        while k in ks:
            s, k = s + 1, k - 1
        want[(u, p)] = s
    t = tables.user_product_feature(src)
    got = {(r["user_id"], r["product_id"]): r["user_product_current_streak"]
           for r in t.select("user_id", "product_id", "user_product_current_streak").collect()}
    assert got == want


def _windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    # "Window [exprs], [partition keys], [order keys]"
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan)


def test_no_window_spans_a_whole_user(hot):
    src, _, _ = hot
    found = _windows(facts.order_timeline(src))
    assert len(found) >= 2
    for parts, order in found:
        keys = [k.split("#")[0] for k in parts.split(", ")]
        if keys == ["user_id"]:
            # the only per-user window runs over block totals (one row per block)
            assert order.startswith("_blk") or order == ""
        else:
            assert keys == ["user_id", "_blk"]


def test_no_window_over_pair_lines(hot):
    src, _, _ = hot
    upf = tables.user_product_feature(src)
    for parts, _ in _windows(upf):
        keys = [k.split("#")[0] for k in parts.split(", ")]
        assert keys != ["user_id", "product_id"]


@pytest.fixture(scope="module")
def wide(spark):
    """A user with 1,800 products; twenty users with one or two."""
    orders = [(k, 0, "prior", k, 1, 1, None if k == 1 else Decimal(1)) for k in (1, 2, 3)]
    prior = [(k, 600 * k + j, j, False) for k in (1, 2, 3) for j in range(1, 601)]
    for u in range(1, 21):
        orders.append((100 + u, u, "prior", 1, 1, 1, None))
        prior += [(100 + u, 601 + j, j, False) for j in range(1, 2 + u % 2)]

    def df(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])
    return Sources(
        aisles=df("aisles", [(1, "a")]), departments=df("departments", [(1, "d")]), orders=df("orders", orders),
        products=df("products", [(p, f"p{p}", 1, 1) for p in sorted({line[1] for line in prior})]),
        order_products_prior=df("order_products_prior", prior),
        order_products_train=df("order_products_train", []))


def test_aqe_splits_the_heavy_user_join(spark, wide):
    src = wide
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        upf = tables.user_product_feature(src)
        upf.collect()  # same query execution, so the final adaptive plan is visible
        plan = upf._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _spread(df, key):
    """Rows of a key in each output partition."""
    rows = df.withColumn("_p", F.spark_partition_id()).where(key).groupBy("_p").count().collect()
    return [r["count"] for r in rows]


@pytest.fixture
def plain_shuffles(spark):
    """Shuffle joins whose partitions AQE neither splits nor merges."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_heavy_keys_are_few_and_found(spark):
    counts = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") < 3, 10 ** 6).otherwise(10).alias("n"))
    found = {r.k: r.parts for r in skew.heavy_keys(counts, ["k"], "n", part_rows=100, most=50).collect()}
    assert set(found) == {0, 1, 2} and all(10 < p <= 50 for p in found.values())
    even = spark.range(5000).select(F.col("id").alias("k"), F.lit(10 ** 7).alias("n"))
    assert skew.heavy_keys(even, ["k"], "n", part_rows=100, most=50).count() == 0  # none stands out
    assert skew.heavy_keys(counts.limit(0), ["k"], "n").count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_the_plain_one(spark, plain_shuffles, how, null_safe):
    if how == "left_semi" and null_safe:
        pytest.skip("not used")
    rows = [(1, k) for k in range(900)] + [(None, k) for k in range(500)] + [(k % 50, k) for k in range(100)] + [(77, 1)]
    big = spark.createDataFrame(rows, "k int, x int")
    small = spark.createDataFrame([(k, k * 10) for k in range(50)] + [(None, -1)], "k int, y int")
    heavy = skew.Heavy.of(skew.heavy_keys(big.groupBy("k").count(), ["k"], "count", part_rows=100, most=20))
    assert {r[0] for r in heavy.rows} == {1, None}
    got = skew.salted_join(big, small, ["k"], heavy, ["x"], how, null_safe)
    want = skew.salted_join(big, small, ["k"], skew.NONE, ["x"], how, null_safe)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert max(_spread(got, "k = 1")) < 450
    if how == "left":
        assert max(_spread(got, "k is null")) < 300


def test_heavy_user_is_dealt_without_aqe(spark, wide, plain_shuffles):
    """The pair table of a user with 1,800 of 1,830 pairs, AQE skew join off."""
    src = stored_sources(spark, wide)
    plain = sorted(map(str, tables.user_product_feature(src, facts.Facts.derive(src)).collect()))
    fx = facts.shared_facts(src, part_rows=100)
    assert [r[0] for r in fx.heavy_users.rows] == [0] and not fx.heavy_products.rows
    joined = tables.user_product_feature(src, fx)
    assert sorted(map(str, joined.collect())) == plain
    # In the join on users no task holds the user as a whole.
    per_user = fx.baskets.groupBy("user_id").agg(F.sum("basket_size").alias("k"))
    parts = _spread(skew.salted_join(fx.pairs, per_user, ["user_id"], fx.heavy_users, ["product_id"]), "user_id = 0")
    assert sum(parts) == 1800 and len(parts) > 4 and max(parts) < 900


def test_heavy_pair_and_product_are_dealt_without_aqe(spark, hot, plain_shuffles):
    """Product 1 is in nearly every order of a user with 3,000."""
    src, _, _ = hot
    src = stored_sources(spark, src)
    fx = facts.shared_facts(src, part_rows=500)
    assert (0, 1) in {r[:2] for r in fx.heavy_pairs.rows} and 1 in {r[0] for r in fx.heavy_product_lines.rows}
    uf, pf, upf = tables.user_feature(src, fx), tables.product_feature(src, fx), tables.user_product_feature(src, fx)
    ml = mldataset.ml_dataset(src)
    salted = mldataset.ml_dataset_final(ml, uf, pf, upf, fx)
    want = mldataset.ml_dataset_final(ml, uf, pf, upf)
    assert salted.columns == want.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, want.collect()))
    parts = _spread(salted, "user_id = 0 and product_id = 1")
    assert len(parts) >= 3 and max(parts) < 0.6 * sum(parts)
