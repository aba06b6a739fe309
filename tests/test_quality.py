"""Data-quality checks: clean data passes, one corrupted row fires a check."""

import pytest
from pyspark.sql import functions as F

from basketflow.operators import quality
from basketflow.plans import tables


def _bad(report):
    return {r["check"]: r["bad_rows"] for r in report.collect() if r["bad_rows"]}


def test_checks_on_fixture(small_sources):
    """All pass but the bound of 30 days, which the fixture's gaps exceed."""
    src = small_sources
    uf, pf = tables.user_feature(src), tables.product_feature(src)
    upf = tables.user_product_feature(src)
    report = (quality.key_checks(src).unionByName(quality.reference_checks(src))
              .unionByName(quality.user_feature_checks(uf, src))
              .unionByName(quality.product_feature_checks(pf, src))
              .unionByName(quality.user_product_feature_checks(upf, uf, pf, src)))
    assert _bad(report) == {"user_domain_bounds": 149}
    assert report.count() == 36  # 6 key, 1 label, 6 reference, 5 + 5 + 12 table checks and their verdict
    rest = report.filter(F.col("check") != "user_domain_bounds")
    assert quality.enforce(rest).filter("check = 'ok'").first()["bad_rows"] == 0


def test_duplicate_line_fires_key_check(small_sources):
    src = small_sources
    dup = src.order_products_prior.unionByName(src.order_products_prior.limit(1))
    broken = type(src)(**{**src.as_dict(), "order_products_prior": dup})
    assert _bad(quality.key_checks(broken)) == {"key_order_products_prior": 2}


def test_orphan_product_fires_reference_check(small_sources):
    src = small_sources
    products = src.products.filter(F.col("product_id") != src.products.first()["product_id"])
    broken = type(src)(**{**src.as_dict(), "products": products})
    assert "ref_order_products_prior_product_id" in _bad(quality.reference_checks(broken))


def test_rate_out_of_range_fires(small_sources):
    uf = tables.user_feature(small_sources)
    first = uf.first()["user_id"]
    corrupted = uf.withColumn("user_reorder_rate",
                              F.when(F.col("user_id") == first, F.lit(1.5)).otherwise(F.col("user_reorder_rate")))
    bad = _bad(quality.user_feature_checks(corrupted, small_sources))
    assert bad == {"user_rates_in_unit_interval": 1, "user_domain_bounds": 149}
    with pytest.raises(quality.DataQualityError):
        quality.enforce(quality.user_feature_checks(corrupted, small_sources))


def test_streak_longer_than_count_fires(small_sources):
    upf = tables.user_product_feature(small_sources)
    corrupted = upf.withColumn("user_product_current_streak", F.col("user_product_order_count") + 1)
    bad = _bad(quality.user_product_feature_checks(corrupted, tables.user_feature(small_sources),
                                                   tables.product_feature(small_sources), small_sources))
    assert bad.get("user_product_domain_bounds", 0) > 0
    assert bad["ok"] == 1  # one failed check


def test_repeated_label_fires_key_check(spark, small_sources):
    src = small_sources
    line = src.order_products_train.join(src.orders.select("order_id", "user_id"), "order_id").first()
    order = src.orders.filter(F.col("order_id") == line["order_id"]).withColumn("order_id", F.lit(10 ** 9).cast("long"))
    again = src.order_products_train.filter((F.col("order_id") == line["order_id"])
                                            & (F.col("product_id") == line["product_id"])) \
        .withColumn("order_id", F.lit(10 ** 9).cast("long"))
    broken = type(src)(**{**src.as_dict(), "orders": src.orders.unionByName(order),
                          "order_products_train": src.order_products_train.unionByName(again)})
    assert _bad(quality.key_checks(broken)) == {"key_train_labels": 2}
