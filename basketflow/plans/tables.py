"""Feature tables t1-t3 with the NULL policy of the materialised tables.

Each table is a handful of aggregations over the shared facts, joined on
the table's key: every joined side holds one row per key, so the joins
are co-partitioned merges of aggregated data, not fact-sized shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.constants import DAYS_PER_WEEK, PERCENT
from basketflow.functions import as_flag, avg_double, nullif_zero, rate
from basketflow.operators.product import popularity_ranks
from basketflow.operators.quality import observed_counts
from basketflow.operators.skew import salted_join
from basketflow.operators.user import known_reorder_rate, order_profile, reorder_diversity
from basketflow.operators.user_product import order_trend
from basketflow.plans import facts
from basketflow.plans.facts import Facts, shared_facts
from basketflow.sources import store
from basketflow.sources.readers import Sources
from basketflow.sources.schema import (
    PRODUCT_FEATURE_COLUMNS, USER_FEATURE_COLUMNS, USER_PRODUCT_FEATURE_COLUMNS,
)


def user_feature(src: Sources, fx: Facts | None = None) -> DataFrame:
    """t1: one row per user with a prior order (29 columns).

    Prior orders without a user give one row without a user, which meets no
    feature (the model joins by an equality of users): NULLs, and 0 in the two
    counts that are 0 for users without such products."""
    fx = fx or shared_facts(src)
    orders = fx.timeline.filter(F.col("is_prior"))
    timing = order_profile(orders)
    timing = timing.select("user_id", *[F.when(F.col("user_id").isNotNull(), F.col(c)).alias(c)
                                        for c in timing.columns if c != "user_id"])
    b = fx.baskets
    baskets = b.groupBy("user_id").agg(
        avg_double(F.col("basket_size")).alias("user_avg_basket_size"),
        F.stddev_samp(F.col("basket_size").cast("double")).alias("user_basket_size_stddev"),
        known_reorder_rate().alias("user_reorder_rate"),
        F.sum("basket_reorders").alias("user_total_reorders"),
        F.sum(F.when(F.col("is_last"), F.col("basket_size"))).alias("user_last_product_count"),
        F.sum(F.when(F.col("is_first"), F.col("basket_size"))).alias("user_first_product_count"))
    diversity = reorder_diversity(
        fx.pair_counts, src.products,
        first_second=F.count_if((F.col("in_first") == 1) & (F.col("in_second") == 1)),
        first_last=F.count_if((F.col("in_first") == 1) & (F.col("in_last") == 1)))
    t = timing.join(baskets, "user_id", "left").join(diversity, "user_id", "left")
    t = (t.withColumn("user_total_reorders", F.coalesce("user_total_reorders", F.lit(0)).cast("long"))
         .withColumn("user_last_product_count", F.col("user_last_product_count").cast("long"))
         .withColumn("user_first_product_count", F.col("user_first_product_count").cast("long"))
         .withColumn("user_products_in_first_and_second",
                     F.when(F.col("user_total_orders") >= 2, F.coalesce("first_second", F.lit(0))))
         .withColumn("user_products_in_first_and_last", F.coalesce("first_last", F.lit(0))))
    return t.select(*USER_FEATURE_COLUMNS)


def product_feature(src: Sources, fx: Facts | None = None) -> DataFrame:
    """t2: one row per product with a prior line (36 columns)."""
    fx = fx or shared_facts(src)
    pl = F.col
    line_side = fx.product_lines.select(
        "product_id",
        rate(pl("r"), nullif_zero(pl("n_known_flags"))).alias("product_reorder_rate"),
        pl("n").alias("product_order_count"),
        pl("r").alias("product_reorder_count"),
        pl("n_first").alias("product_first_order_count"),
        pl("avg_gap").alias("product_avg_days_between_orders"),
        pl("mode_dow").alias("product_preferred_order_day"),
        pl("mode_hour").alias("product_preferred_order_hour"),
        pl("avg_cart").alias("product_avg_cart_position"),
        pl("avg_relative_cart").alias("product_avg_cart_position_relative_basket_size"),
        pl("n_first_cart_first").alias("product_first_cart_first_order_count"),
        pl("n_first_cart_first_users").alias("_fcfo_users"),
        pl("n_last").alias("product_last_orders_count"),
    ).withColumn("product_first_order_reorder_count",
                 F.when(F.col("product_first_order_count") > 0, F.col("product_reorder_count"))
                 .otherwise(F.lit(0)).cast("long"))

    totals = line_side.agg(F.sum("product_first_cart_first_order_count").alias("_fcfo_total"),
                           F.sum("_fcfo_users").alias("_fcfo_users_total"))
    line_side = (line_side.crossJoin(F.broadcast(totals))
                 .withColumn("product_first_cart_first_order_pct",
                             F.when(F.col("product_first_cart_first_order_count") > 0,
                                    F.col("product_first_cart_first_order_count") * PERCENT
                                    / F.col("_fcfo_total").cast("double")))
                 .withColumn("product_first_cart_first_order_user_pct",
                             F.when(F.col("product_first_cart_first_order_count") > 0,
                                    F.col("_fcfo_users") * PERCENT / F.col("_fcfo_users_total").cast("double"))))

    # Users are counted without the pairs that have none.
    p = fx.pair_counts
    user = F.col("user_id").isNotNull()
    rebought = (F.col("n_reorders") > 0) & user
    in_first, in_last = (F.col("in_first") == 1) & user, F.col("in_last") == 1
    first_cart = (F.col("first_cart_in_first") == 1) & user
    on_timeline = F.col("cum_first").isNotNull() & F.col("cum_last").isNotNull()
    span = F.when(on_timeline, (F.col("cum_last") - F.col("cum_first")).cast("double"))
    freq = (F.col("n") - 1).cast("double") / F.nullif(span, F.lit(0.0))
    n_first, n_first_re = F.count_if(in_first), F.count_if(in_first & rebought)
    n_fc, n_fc_re = F.count_if(first_cart), F.count_if(first_cart & rebought)
    pair_side = p.groupBy("product_id").agg(
        F.avg(span).alias("product_avg_days_from_first_to_last_order"),
        F.avg(freq).alias("product_order_frequency"),
        (F.avg(freq) * DAYS_PER_WEEK).alias("product_order_per_week"),
        F.count("user_id").alias("product_unique_user_count"),
        F.count_if(rebought).alias("product_unique_reorder_user_count"),
        rate(F.count_if(rebought), nullif_zero(F.count("user_id"))).alias("product_user_reorder_rate"),
        n_first.alias("product_first_order_user_count"),
        n_first_re.alias("product_first_order_reorder_user_count"),
        F.when(n_first > 0, rate(n_first_re, n_first)).alias("product_first_order_reorder_rate"),
        F.count_if(in_first & (F.col("in_second") == 1)).alias("product_repeat_user_count"),
        n_fc.alias("product_first_cart_first_order_user_count"),
        n_fc_re.alias("product_first_order_first_cart_reorder_user_count"),
        F.when(n_fc > 0, rate(n_fc_re, n_fc)).alias("product_first_order_first_cart_reorder_rate"),
        (F.max("in_first") * F.max("in_last")).cast("int").alias("product_in_first_and_last"),
        F.count_if(in_first & in_last).alias("product_users_in_first_and_last"),
    )

    dims = _product_dimension_features(fx.product_lines.select("product_id", "n", "r"), src.products)
    t = line_side.join(pair_side, "product_id", "left").join(dims, "product_id", "left")
    return t.select(*PRODUCT_FEATURE_COLUMNS)


def _product_dimension_features(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Aisle/department averages, reorder rates and popularity ranks for the
    ordered products, from per-product line counts ``n`` and reorders ``r``."""
    cat = counts.join(products.select("product_id", "aisle_id", "department_id"), "product_id")
    out = cat.select("product_id", "aisle_id", "department_id")
    for group, avg_name, rate_name in (
            ("aisle_id", "aisle_avg_product_order_count", "aisle_product_reorder_rate"),
            ("department_id", "department_avg_product_order_count", "department_product_reorder_rate")):
        g = cat.groupBy(group).agg(avg_double(F.col("n")).alias(avg_name),
                                   rate(F.sum("r"), F.sum("n")).alias(rate_name))
        g = g.withColumnRenamed(group, "_grp")
        # The average is a window over the group (NULL groups included); the
        # reorder rate is an equality join (a NULL group matches nothing).
        out = (out.join(g, out[group].eqNullSafe(F.col("_grp")), "left")
               .withColumn(rate_name, F.when(F.col(group).isNotNull(), F.col(rate_name)))
               .drop("_grp"))
    ranks = popularity_ranks(counts, products)
    return out.join(ranks, "product_id", "left").drop("aisle_id", "department_id")


def user_product_feature(src: Sources, fx: Facts | None = None) -> DataFrame:
    """t3: one row per (user, product) pair of the prior lines (19 columns).

    Lines without a user give pairs without a user, which meet no feature (the
    model joins by an equality of users): NULLs, and a streak of 0."""
    fx = fx or shared_facts(src)
    timeline = fx.timeline.filter(F.col("is_prior"))
    users = timeline.groupBy("user_id").agg(
        F.count_if(F.col("in_first_half")).alias("first_half_orders"),
        F.count_if(F.col("in_second_half")).alias("second_half_orders"))
    user_lines = fx.baskets.groupBy("user_id").agg(F.sum("basket_size").alias("user_line_count"))
    product_lines = fx.product_lines.select("product_id", F.col("n").alias("product_line_count"))
    keys = ["user_id", "product_id"]
    # The per-user side is combined first (both parts are one row per user)
    # so the pair data meets it in a single join.  Heavy users and products are
    # dealt to several tasks; AQE's skew-join handling stays for the rest.
    per_user = users.join(user_lines, "user_id", "full")
    t = salted_join(fx.pairs, per_user, ["user_id"], fx.heavy_users, ["product_id"])
    t = salted_join(t, product_lines, ["product_id"], fx.heavy_products, ["user_id"])
    t = order_trend(facts.current_streak(t))
    n, umax = F.col("n"), F.col("user_max_order_number")
    span = (F.col("cum_last") - F.col("cum_first")).cast("double")
    since_first = (umax - F.col("first_no") + 1).cast("long")
    t = t.select(
        "user_id", "product_id",
        F.col("avg_cart").alias("user_product_avg_cart_position"),
        F.col("avg_gap").alias("user_product_order_tempo"),
        n.alias("user_product_order_count"),
        rate(n, F.col("user_line_count")).alias("user_product_order_share"),
        rate(n, F.col("product_line_count")).alias("user_share_of_product_orders"),
        F.when(n >= 2, span).alias("user_product_days_from_first_to_last"),
        (span / nullif_zero(n - 1).cast("double")).alias("user_product_avg_repurchase_interval"),
        rate(n, F.col("user_total_orders")).alias("user_product_order_rate_overall"),
        since_first.alias("user_product_orders_since_first_purchase"),
        rate(n, since_first).alias("user_product_order_rate_since_first"),
        F.when(F.col("in_first") == 1, F.col("n_reorders")).alias("user_product_reorder_after_first_count"),
        as_flag((F.col("in_first") == 1) & (F.col("in_last") == 1)).alias("user_product_in_first_and_last"),
        (umax - F.col("last_no")).cast("long").alias("user_product_orders_since_last"),
        F.col("in_last").alias("user_product_in_last_order"),
        F.coalesce(F.col("current_streak"), F.lit(0).cast("long")).alias("user_product_current_streak"),
        "user_product_order_trend",
        (F.col("user_cumulative_days") - F.col("cum_last")).cast("double")
        .alias("user_product_days_since_last_order"),
    )
    always = ("user_id", "product_id", "user_product_current_streak")
    return t.select(*[F.col(c) if c in always else F.when(F.col("user_id").isNotNull(), F.col(c)).alias(c)
                      for c in USER_PRODUCT_FEATURE_COLUMNS])


def shared_tables(src: Sources) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three feature tables, stored once in the folder that is keyed by
    the state of the sources' files, and read back (later jobs - the final
    dataset, the checks - start from the written tables).  Their row checks
    are counted while they are written.  Plan-only sources get unmaterialised
    plans."""
    fx = shared_facts(src)
    builders = {"user_feature": user_feature, "product_feature": product_feature,
                "user_product_feature": user_product_feature}
    if src.home is None:
        return tuple(build(src, fx) for build in builders.values())
    spark = src.orders.sparkSession
    return tuple(store.materialise(spark, f"{src.home}/_tables/{name}", lambda b=build: b(src, fx), observe=observed_counts(name))
                 for name, build in builders.items())


def seen_while_written(src: Sources, table: str) -> dict | None:
    """Counts of the row checks of a stored feature table; None for plans."""
    if src.home is None:
        return None
    return store.observed(src.orders.sparkSession, f"{src.home}/_tables/{table}")
