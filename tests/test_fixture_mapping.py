"""The star-schema adapter reproduces the measured fixture sizes (FIXTURES.md section 4, sf0.001)."""

from pyspark.sql import functions as F


def test_table_sizes(small_sources):
    s = small_sources
    by_set = {r["eval_set"]: r["count"] for r in s.orders.groupBy("eval_set").count().collect()}
    assert by_set == {"prior": 1350, "train": 75, "test": 75}
    assert s.order_products_prior.count() == 4466
    assert s.order_products_prior.filter("reordered").count() == 3043
    assert s.order_products_train.count() == 247
    assert s.orders.select("user_id").distinct().count() == 150
    assert s.products.count() == 10
    assert s.orders.filter(F.col("days_since_prior_order") == 0).count() == 1
    lines = s.order_products_prior.select("order_id").union(s.order_products_train.select("order_id"))
    assert s.orders.join(lines, "order_id", "left_anti").count() == 100  # 75 test orders and 25 without lines


def test_orders_are_numbered_densely(small_sources):
    o = small_sources.orders
    per_user = o.groupBy("user_id").agg(F.count("*").alias("n"), F.max("order_number").alias("m"),
                                        F.count_distinct("order_number").alias("d"))
    assert per_user.filter("n != m OR n != d").count() == 0
    assert o.filter("order_number = 1 AND days_since_prior_order IS NOT NULL").count() == 0


def test_pair_statistics(small_sources):
    from basketflow.plans.facts import shared_facts
    p = shared_facts(small_sources).pairs
    assert p.count() == 1423
    assert p.filter("in_first = 1 AND in_last = 1").count() == 165
    assert p.filter("in_first = 1 AND in_second = 1").count() == 160


def test_streaks_and_mode_ties(small_sources):
    from basketflow.plans import tables
    uf = tables.user_feature(small_sources)
    assert uf.filter("user_total_orders = 1").count() == 1
    upf = tables.user_product_feature(small_sources)
    assert upf.filter("user_product_current_streak >= 2").count() == 162
    d = small_sources.orders.filter("eval_set = 'prior'").groupBy("user_id", "order_dow").count()
    ties = (d.groupBy("user_id").agg(F.max("count").alias("m")).join(d, "user_id")
            .filter("count = m").groupBy("user_id").count().filter("count > 1"))
    assert ties.count() == 57
