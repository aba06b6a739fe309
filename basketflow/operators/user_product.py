"""User x product features up01-up14, each a stand-alone query.

All of them are projections of the ``pairs`` fact (one aggregation of the
order lines by user and product), sometimes joined to a per-user or
per-product total.  Joins on ``user_id`` or ``product_id`` alone are the only
places where a heavy key concentrates rows; ``salted_join`` deals those to
several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions import as_flag, nullif_zero, rate
from basketflow.operators.skew import salted_join
from basketflow.plans import facts
from basketflow.sources.readers import Sources

PAIR = ["user_id", "product_id"]


def _pairs(src: Sources) -> DataFrame:
    return facts.shared_facts(src).pair_counts


def _user_line_totals(src: Sources) -> DataFrame:
    return facts.shared_facts(src).baskets.groupBy("user_id").agg(F.sum("basket_size").alias("user_line_count"))


def pair_span(pairs: DataFrame) -> DataFrame:
    """Days from the pair's first to its last order on the user's timeline."""
    return pairs.withColumn("span_days", (F.col("cum_last") - F.col("cum_first")).cast("double"))


def up01_user_product_avg_cart_position(src: Sources) -> DataFrame:
    return _pairs(src).select(*PAIR, F.col("avg_cart").alias("user_product_avg_cart_position"))


def up02_user_order_tempo(src: Sources) -> DataFrame:
    return _pairs(src).select(*PAIR, F.col("avg_gap").alias("user_order_tempo"))


def up03_user_product_repurchase_interval(src: Sources) -> DataFrame:
    spans = pair_span(_pairs(src)).filter(F.col("span_days").isNotNull())
    return spans.select(
        *PAIR, F.col("span_days").alias("user_product_days_from_first_to_last"),
        (F.col("span_days") / nullif_zero(F.col("n") - 1).cast("double"))
        .alias("user_product_avg_repurchase_interval"))


def up04_user_product_order_share(src: Sources) -> DataFrame:
    fx = facts.shared_facts(src)
    met = salted_join(fx.pair_counts, _user_line_totals(src), ["user_id"], fx.heavy_users, ["product_id"], "inner", null_safe=True)
    return met.select(
        *PAIR, F.col("n").alias("user_product_order_count"),
        rate(F.col("n"), F.col("user_line_count")).alias("user_product_order_share"))


def up05_user_product_order_rates(src: Sources) -> DataFrame:
    since_first = (F.col("user_max_order_number") - F.col("first_no") + 1).cast("long")
    return _pairs(src).filter(F.col("user_total_orders").isNotNull()).select(
        *PAIR, F.col("n").alias("user_product_order_count"),
        rate(F.col("n"), F.col("user_total_orders")).alias("user_product_order_rate_overall"),
        since_first.alias("product_orders_since_first_purchase"),
        rate(F.col("n"), since_first).alias("user_product_order_rate_since_first"))


def up06_user_share_of_product_orders(src: Sources) -> DataFrame:
    fx = facts.shared_facts(src)
    totals = fx.pair_sizes.groupBy("product_id").agg(F.sum("n").alias("product_line_count"))
    return salted_join(fx.pair_sizes, totals, ["product_id"], fx.heavy_products, ["user_id"], "inner").select(
        *PAIR, rate(F.col("n"), F.col("product_line_count")).alias("user_share_of_product_orders"))


def up07_user_product_reorder_after_first_count(src: Sources) -> DataFrame:
    return (_pairs(src).filter((F.col("in_first") == 1) & (F.col("n_reorders") > 0) & F.col("user_id").isNotNull())
            .select("product_id", "user_id",
                    F.col("n_reorders").alias("user_product_reorder_after_first_count")))


def up08_user_product_reorder_rate(src: Sources) -> DataFrame:
    """The model meets reorders and totals by an equality of users, so pairs
    without a user have no reorders."""
    reorders = F.when(F.col("user_id").isNotNull(), F.col("n_reorders")).otherwise(F.lit(0))
    return _pairs(src).select(
        "product_id", "user_id", F.nullif(reorders, F.lit(0)).alias("user_product_reorder_count"),
        rate(reorders, F.col("n")).alias("user_product_reorder_rate"))


def up09_user_product_in_first_and_last(src: Sources) -> DataFrame:
    return _pairs(src).select(
        "product_id", "user_id",
        as_flag((F.col("in_first") == 1) & (F.col("in_last") == 1)).alias("product_in_first_and_last"))


def up10_user_product_orders_since_last(src: Sources) -> DataFrame:
    return (_pairs(src).filter(F.col("user_max_order_number").isNotNull())
            .select(*PAIR, (F.col("user_max_order_number") - F.col("last_no")).cast("long")
                    .alias("user_product_orders_since_last")))


def up11_user_product_in_last_order(src: Sources) -> DataFrame:
    return _pairs(src).select(*PAIR, F.col("in_last").alias("user_product_in_last_order"))


def up12_user_product_current_streak(src: Sources) -> DataFrame:
    rows = facts.shared_facts(src).pairs
    return (facts.current_streak(rows).filter(F.col("current_streak").isNotNull())
            .select(*PAIR, F.col("current_streak").alias("user_product_current_streak")))


def order_trend(pairs_with_halves: DataFrame) -> DataFrame:
    """Second-half buying rate minus first-half buying rate."""
    second = rate(F.col("n_second_half"), nullif_zero(F.col("second_half_orders")))
    first = rate(F.col("n_first_half"), nullif_zero(F.col("first_half_orders")))
    return pairs_with_halves.withColumn("user_product_order_trend", second - first)


def _user_halves(src: Sources) -> DataFrame:
    timeline = facts.shared_facts(src).timeline.filter(F.col("is_prior"))
    return timeline.groupBy("user_id").agg(
        F.count_if(F.col("in_first_half")).alias("first_half_orders"),
        F.count_if(F.col("in_second_half")).alias("second_half_orders"))


def up13_user_product_order_trend(src: Sources) -> DataFrame:
    fx = facts.shared_facts(src)
    p = fx.pair_counts.filter(F.col("user_max_order_number").isNotNull())
    met = salted_join(p, _user_halves(src), ["user_id"], fx.heavy_users, ["product_id"], "inner")
    return order_trend(met).select(*PAIR, "user_product_order_trend")


def up14_user_product_days_since_last_order(src: Sources) -> DataFrame:
    p = _pairs(src).filter(F.col("cum_last").isNotNull() & F.col("user_cumulative_days").isNotNull())
    return p.select(*PAIR, (F.col("user_cumulative_days") - F.col("cum_last")).cast("double")
                    .alias("user_product_days_since_last_order"))


OPERATORS = {
    "up01_user_product_avg_cart_position": up01_user_product_avg_cart_position,
    "up02_user_order_tempo": up02_user_order_tempo,
    "up03_user_product_repurchase_interval": up03_user_product_repurchase_interval,
    "up04_user_product_order_share": up04_user_product_order_share,
    "up05_user_product_order_rates": up05_user_product_order_rates,
    "up06_user_share_of_product_orders": up06_user_share_of_product_orders,
    "up07_user_product_reorder_after_first_count": up07_user_product_reorder_after_first_count,
    "up08_user_product_reorder_rate": up08_user_product_reorder_rate,
    "up09_user_product_in_first_and_last": up09_user_product_in_first_and_last,
    "up10_user_product_orders_since_last": up10_user_product_orders_since_last,
    "up11_user_product_in_last_order": up11_user_product_in_last_order,
    "up12_user_product_current_streak": up12_user_product_current_streak,
    "up13_user_product_order_trend": up13_user_product_order_trend,
    "up14_user_product_days_since_last_order": up14_user_product_days_since_last_order,
}
