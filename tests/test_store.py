"""Stored tables: resolved once while nothing changes, laid out by order, and
counted while they are written."""

import os
import re
import shutil
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketflow import registry
from basketflow.operators import quality
from basketflow.plans import facts, mldataset, tables
from basketflow.plans.pipeline import stored_sources
from basketflow.sources import fixtures, store
from conftest import SF_SMALL


def exchanges(df, of=None):
    """Exchanged columns of the plan's shuffles (those that hold ``of``)."""
    lines = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in x
             and "BroadcastExchange" not in x]
    return [x for x in lines if of is None or of in x]


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_a_second_load_is_a_lookup(spark, small_sources):
    fixtures.load_star_schema(spark, SF_SMALL)
    took = []
    for _ in range(5):
        t0 = time.perf_counter()
        again = fixtures.load_star_schema(spark, SF_SMALL)
        took.append(time.perf_counter() - t0)
    assert again is small_sources
    assert min(took) < 0.05, took


def test_changed_files_are_loaded_again(spark, tmp_path):
    for name in fixtures.STAR_TABLES:
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path)
    first = fixtures.load_star_schema(spark, str(tmp_path))
    assert fixtures.load_star_schema(spark, str(tmp_path)) is first
    orders = pq.read_table(f"{SF_SMALL}/orders.parquet").slice(0, 100)
    (tmp_path / "orders.parquet").unlink()
    pq.write_table(orders, tmp_path / "orders.parquet")
    second = fixtures.load_star_schema(spark, str(tmp_path))
    assert second.home != first.home and second.orders.count() == 100 < first.orders.count()


def test_a_copy_carries_its_schema_and_layout(spark, tmp_path):
    df = spark.range(50).select("id", (F.col("id") % 7).alias("k"), F.lit("x").alias("part"))
    folder = str(tmp_path / "t")
    store.publish(spark, folder, store.write_copy(df, folder, bucket_by="k"))
    made = store.published_copy(spark, folder)
    back = store.open_copy(spark, folder, made)
    assert back.schema.simpleString() == df.schema.simpleString() and made.bucket_by == "k"
    assert not exchanges(back.groupBy("k").count())
    assert back.groupBy("k").count().count() == 7
    other = str(tmp_path / "p")
    store.publish(spark, other, store.write_copy(df, other, partition_by="part"))
    assert store.open_copy(spark, other, store.published_copy(spark, other)).where("part = 'x'").count() == 50


def test_lines_meet_their_orders_without_an_exchange(spark, small_sources, no_broadcast):
    src = small_sources
    timeline = facts.shared_facts(src).timeline
    # Only orders move, by order_id; lines and their sums stay where they are.
    moved = exchanges(facts.order_lines(src, timeline))
    assert len(moved) == 1 and "order_id" in moved[0]
    assert not exchanges(facts.order_baskets(facts.shared_facts(src).lines))
    assert not exchanges(src.order_products_prior.join(src.orders, "order_id"))
    for table in ("order_products_prior", "order_products_train"):
        keys = quality.PRIMARY_KEYS[table]
        assert not exchanges(getattr(src, table).groupBy(*keys).count())
    # What key_checks moves are one-row sums, orders, catalogues, and the line
    # sums of users with several train baskets.
    plan = exchanges(quality.key_checks(src), "product_id")
    assert all("user_id" in x or "hashpartitioning(product_id" in x for x in plan), plan
    assert len(mldataset.ml_dataset(src).columns) == 15


def test_row_checks_are_counted_while_writing(spark, small_sources):
    src = small_sources
    tables.shared_tables(src)
    for name, build in (("user_feature", tables.user_feature), ("product_feature", tables.product_feature),
                        ("user_product_feature", tables.user_product_feature)):
        seen = tables.seen_while_written(src, name)
        want = build(src).agg(*[c.alias(k) for k, c in quality.observed_counts(name).items()]).first().asDict()
        assert seen == want
    uf, pf, upf = tables.shared_tables(src)
    report = {False: quality.user_product_feature_checks(upf, uf, pf, src),
              True: quality.user_product_feature_checks(upf, uf, pf, src, tables.seen_while_written(src, "user_product_feature"))}
    rows = {k: sorted(map(tuple, r.collect())) for k, r in report.items()}
    assert rows[True] == rows[False]
    # The table is read for its keys and shares only.
    read = {k: re.findall(r"ReadSchema: struct<([^>]*)", r._jdf.queryExecution().executedPlan().toString())
            for k, r in report.items()}
    of_table = [x for x in read[True] if "user_product_order_share" in x]
    assert of_table and set(of_table) == {"user_id:bigint,product_id:bigint,user_product_order_share:double"}
    assert any("user_product_days_since_last_order" in x or "..." in x for x in read[False])


def test_seen_counts_of_bad_rows_fire(spark, small_sources, tmp_path):
    from basketflow.sources.sinks import read_table, write_table
    uf, _, _ = tables.shared_tables(small_sources)
    bad = uf.withColumn("user_reorder_rate", F.lit(2.0))
    seen = write_table(bad, str(tmp_path / "uf"), quality.observed_counts("user_feature"))
    back = read_table(spark, str(tmp_path / "uf"))
    report = {r["check"]: r["bad_rows"] for r in quality.user_feature_checks(back, small_sources, seen).collect()}
    assert report["user_rates_in_unit_interval"] == uf.count() == seen[quality.ROWS]
    assert report["user_grain"] == 0


def test_plan_only_sources_have_no_counts(small_sources):
    plan = type(small_sources)(**small_sources.as_dict())
    assert tables.seen_while_written(plan, "user_feature") is None
    assert stored_sources(plan.orders.sparkSession, small_sources) is small_sources


def test_the_dataset_is_not_exchanged_for_the_product_table(spark, small_sources, no_broadcast, monkeypatch):
    """The stored product table is sent to the joined rows of 60 columns, which
    were exchanged by product; too many products are joined as before."""
    fx, ml = facts.shared_facts(small_sources), mldataset.ml_dataset(small_sources)
    sent = mldataset.ml_dataset_final(ml, *tables.shared_tables(small_sources), fx)
    monkeypatch.setattr(mldataset, "SENT_PRODUCTS", 0)
    dealt = mldataset.ml_dataset_final(ml, *tables.shared_tables(small_sources), fx)
    by_product = [len([x for x in exchanges(t) if re.search(r"hashpartitioning\(product_id#\d+L?, \d+\)", x)])
                  for t in (sent, dealt)]
    assert by_product[0] == by_product[1] - 2  # neither the rows nor the table
    assert sent.columns == dealt.columns
    assert sorted(map(str, sent.collect())) == sorted(map(str, dealt.collect()))


def test_the_final_dataset_exchanges_each_row_once(spark, small_sources, no_broadcast, monkeypatch):
    """Lines and many pairs meet dealt by user, where the user table is too: no
    row is exchanged with the columns of another table, or with names."""
    fx, made = facts.shared_facts(small_sources), tables.shared_tables(small_sources)
    plain = registry.TABLE_BUILDERS["t6_ml_dataset_final"](small_sources)
    assert any(re.search(r"hashpartitioning\(user_id#\d+L, product_id#\d+L", x) for x in exchanges(plain))
    monkeypatch.setattr(mldataset, "DEALT_PAIRS", 0, raising=False)
    dealt = registry.TABLE_BUILDERS["t6_ml_dataset_final"](small_sources)
    by_user = [x for x in exchanges(dealt) if re.search(r"hashpartitioning\(user_id", x)]
    assert len(by_user) == 2 and not any("product_id" in x for x in by_user)
    want = registry.presented(mldataset.ml_dataset_final(mldataset.ml_dataset(small_sources), *made))
    assert plain.columns == dealt.columns == want.columns
    rows = sorted(map(str, want.collect()))
    assert sorted(map(str, plain.collect())) == rows == sorted(map(str, dealt.collect()))
    assert not fx.heavy_user_lines.rows


def test_lines_without_a_user_or_a_pair_stay(spark, small_sources, monkeypatch):
    """Rows without a user meet no table, lines may lack their pair, and a user
    with many lines is left to the join by pair."""
    uf, _, upf = tables.shared_tables(small_sources)
    lines = spark.createDataFrame([(1, None, 1), (2, None, 1), (3, 5, 1), (4, 5, 1), (5, 5, 2), (6, 6, 2)],
                                  "order_id long, user_id long, product_id long")
    pairs = spark.createDataFrame([(None, 1, 9), (5, 1, 7), (6, 1, 8)], "user_id long, product_id long, n long")
    users = spark.createDataFrame([(None, 3), (5, 4)], "user_id long, m long")
    fx = facts.shared_facts(small_sources)
    want = [(1, None, 1, None, None), (2, None, 1, None, None), (3, 5, 1, 7, 4), (4, 5, 1, 7, 4), (5, 5, 2, None, 4),
            (6, 6, 2, None, None)]
    monkeypatch.setattr(mldataset, "DEALT_PAIRS", 0, raising=False)
    got = mldataset._with_features(lines, users, pairs, fx).select("order_id", "user_id", "product_id", "n", "m")
    assert sorted(map(tuple, got.collect())) == want
    heavy = facts.FactsOnDemand(small_sources, 1)
    assert heavy.heavy_user_lines.rows
    assert "Window" not in mldataset._with_features(lines, uf, upf, heavy)._jdf.queryExecution().executedPlan().toString()


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    """The exchanges of all the tables that a query stores were on disk at once."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    dirs = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before, conf = files(), spark.conf.get(store.CLEANUP, None)
    for layout in ({}, {"bucket_by": "k"}):
        rows = spark.range(5000, numPartitions=3).selectExpr("id % 50 AS k", "id").groupBy("k").agg(F.max("id").alias("m"))
        assert store.materialise(spark, f"{tmp_path}/{len(layout)}", lambda r=rows: r, **layout).collect()
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(store.CLEANUP, None) == conf


def test_rounded_values_are_rounded_before_they_meet_the_lines(spark, small_sources, no_broadcast, monkeypatch):
    """The writing of 95 columns was a method too large for the JVM to compile,
    with text made of doubles for each line in it."""
    monkeypatch.setattr(mldataset, "DEALT_PAIRS", 0, raising=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = registry.queries()["t6_ml_dataset_final"](spark, SF_SMALL).select("*")
        plan = table._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    last = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)][-1]
    assert 0 < last < 7600
    per_line = plan.toString().split("SortMergeJoin")[0].split("BroadcastHashJoin")[0]
    assert "format_string" not in per_line and "format_string" in plan.toString()
