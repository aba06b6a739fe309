"""User features u01-u15, each a stand-alone query keyed by ``user_id``.

Order-level features aggregate the user's prior orders; line-level ones
aggregate per-order baskets (``order_baskets``: lines grouped by order on
data already clustered by order); product-set features aggregate the
``pairs`` fact.  Distinct counts of departments and aisles, and modes, are taken
from sums by user and value.  These are few per user and are dealt by user once,
so nothing keeps a set or a map per user, and no group-by after that needs an
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.constants import (
    AFTERNOON_HOURS, DAYS_PER_WEEK, EVENING_HOURS, MORNING_HOURS, NIGHT_HOURS, WEEKEND_DAYS,
)
from basketflow.functions import avg_double, best_value, count_lines, nullif_zero, rate, share_of
from basketflow.plans import facts
from basketflow.sources.readers import Sources


def _prior_orders(src: Sources) -> DataFrame:
    return src.orders.filter(F.col("eval_set") == "prior")


def _baskets(src: Sources) -> DataFrame:
    """One row per order with prior lines (the stored ``baskets`` fact)."""
    return facts.shared_facts(src).baskets


def basket_stats(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("user_id").agg(
        avg_double(F.col("basket_size")).alias("user_avg_basket_size"),
        F.stddev_samp(F.col("basket_size").cast("double")).alias("user_basket_size_stddev"))


def u01_user_basket_size(src: Sources) -> DataFrame:
    return basket_stats(_baskets(src))


def u02_user_total_orders(src: Sources) -> DataFrame:
    return _prior_orders(src).groupBy("user_id").agg(count_lines().alias("user_total_orders"))


def u03_user_reorder_rate(src: Sources) -> DataFrame:
    return _baskets(src).groupBy("user_id").agg(
        known_reorder_rate().alias("user_reorder_rate"))


def known_reorder_rate() -> F.Column:
    """Share of reordered lines among those whose flag is known (NULL if none)."""
    return rate(F.sum("basket_reorders"), nullif_zero(F.sum("basket_known_flags")))


def u04_user_total_reorders(src: Sources) -> DataFrame:
    return (_baskets(src).groupBy("user_id").agg(F.sum("basket_reorders").alias("user_total_reorders"))
            .filter(F.col("user_total_reorders") > 0))


def gap_sum() -> F.Column:
    return F.sum(F.col("days_since_prior_order")).cast("double")


def preferred(prior_orders: DataFrame, column: str, out: str) -> DataFrame:
    """The user's most frequent value of ``column``, the smallest on ties.  A
    user whose values are all unknown has a row, without a value."""
    counts = prior_orders.groupBy("user_id", column).agg(count_lines().alias("n"))
    return best_value(counts.repartition("user_id"), ["user_id"], column, "n", out)


def preferred_day(prior_orders: DataFrame) -> DataFrame:
    return preferred(prior_orders, "order_dow", "user_preferred_order_day")


def order_timing(prior_orders: DataFrame) -> DataFrame:
    """The order-level user features but the modes, in one aggregation."""
    hour, dow = F.col("order_hour_of_day"), F.col("order_dow")
    weekend = dow.isin(*WEEKEND_DAYS)
    orders_minus_one = (count_lines() - 1).cast("double")
    return prior_orders.groupBy("user_id").agg(
        count_lines().alias("user_total_orders"),
        avg_double(F.col("days_since_prior_order")).alias("user_avg_days_between_orders"),
        share_of(hour.between(*MORNING_HOURS)).alias("user_morning_order_rate"),
        share_of(hour.between(*AFTERNOON_HOURS)).alias("user_afternoon_order_rate"),
        share_of(hour.between(*EVENING_HOURS)).alias("user_evening_order_rate"),
        share_of(hour.between(*NIGHT_HOURS[0]) | hour.between(*NIGHT_HOURS[1])).alias("user_night_order_rate"),
        share_of(weekend).alias("user_weekend_order_rate"),
        share_of(~weekend).alias("user_weekday_order_rate"),
        gap_sum().alias("user_total_days_active"),
        (orders_minus_one / nullif_zero(gap_sum() / float(DAYS_PER_WEEK))).alias("user_orders_per_week"),
        (orders_minus_one / nullif_zero(gap_sum())).alias("user_order_frequency"),
    )


def order_profile(prior_orders: DataFrame) -> DataFrame:
    """``order_timing`` and both modes from one pass over the orders.

    The orders are summed by user, day and hour; a user's sums (days x hours
    at most) are dealt by user once, and everything else is grouped where
    they are: each sum stands once under its day and once under its hour,
    every value has its count, and of those follow modes and shares."""
    sums = prior_orders.groupBy("user_id", "order_dow", "order_hour_of_day").agg(
        count_lines().alias("n"), F.sum("days_since_prior_order").alias("gaps"),
        F.count("days_since_prior_order").alias("n_gaps")).repartition("user_id")
    day, hour = F.lit("day"), F.lit("hour")
    under = F.inline(F.array(F.struct(day.alias("kind"), F.col("order_dow").alias("value")),
                             F.struct(hour.alias("kind"), F.col("order_hour_of_day").alias("value"))))
    by_value = sums.select("user_id", "n", "gaps", "n_gaps", under).groupBy("user_id", "kind", "value").agg(
        *[F.sum(c).alias(c) for c in ("n", "gaps", "n_gaps")])

    def counted(kind: F.Column, condition: F.Column) -> F.Column:
        return F.sum(F.when((F.col("kind") == kind) & condition, F.col("n")).otherwise(F.lit(0).cast("long")))

    value = F.col("value")
    weekend = value.isin(*WEEKEND_DAYS)
    shares = {"user_morning_order_rate": counted(hour, value.between(*MORNING_HOURS)),
              "user_afternoon_order_rate": counted(hour, value.between(*AFTERNOON_HOURS)),
              "user_evening_order_rate": counted(hour, value.between(*EVENING_HOURS)),
              "user_night_order_rate": counted(hour, value.between(*NIGHT_HOURS[0]) | value.between(*NIGHT_HOURS[1])),
              "user_weekend_order_rate": counted(day, weekend),
              "user_weekday_order_rate": counted(day, ~weekend)}
    # The smallest value of every count, then the value of the largest count.
    rank = F.when(value.isNotNull(), F.col("n")).otherwise(F.lit(-1).cast("long"))
    levels = by_value.withColumn("rank", rank).groupBy("user_id", "kind", "rank").agg(
        F.min("value").alias("value"), F.sum("n").alias("n"), F.sum("gaps").alias("gaps"),
        F.sum("n_gaps").alias("n_gaps"), *[c.alias(name) for name, c in shares.items()])

    def once(c: str) -> F.Column:  # every sum stands under its day and its hour
        return F.sum(F.when(F.col("kind") == day, F.col(c)))

    def mode(kind: F.Column) -> F.Column:
        return F.max_by("value", F.when(F.col("kind") == kind, F.col("rank")))

    whole = levels.groupBy("user_id").agg(
        once("n").alias("n"), once("gaps").cast("double").alias("gaps"), once("n_gaps").alias("n_gaps"),
        mode(day).alias("user_preferred_order_day"), mode(hour).alias("user_preferred_order_hour"),
        *[F.sum(name).alias(name) for name in shares])
    n, gaps = F.col("n"), F.col("gaps")
    before = (n - 1).cast("double")
    return whole.select(
        "user_id", n.alias("user_total_orders"),
        rate(gaps, nullif_zero(F.col("n_gaps"))).alias("user_avg_days_between_orders"),
        *[rate(F.col(name), n).alias(name) for name in shares],
        gaps.alias("user_total_days_active"),
        (before / nullif_zero(gaps / float(DAYS_PER_WEEK))).alias("user_orders_per_week"),
        (before / nullif_zero(gaps)).alias("user_order_frequency"),
        "user_preferred_order_day", "user_preferred_order_hour")


def u05_user_avg_days_between_orders(src: Sources) -> DataFrame:
    return order_timing(_prior_orders(src)).select("user_id", "user_avg_days_between_orders")


def u06_user_preferred_order_day(src: Sources) -> DataFrame:
    return preferred_day(_prior_orders(src))


def u07_user_order_hour_profile(src: Sources) -> DataFrame:
    return order_profile(_prior_orders(src)).select(
        "user_id", "user_preferred_order_hour", "user_morning_order_rate", "user_afternoon_order_rate",
        "user_evening_order_rate", "user_night_order_rate")


def u08_user_weekend_weekday_rate(src: Sources) -> DataFrame:
    return order_timing(_prior_orders(src)).select("user_id", "user_weekend_order_rate",
                                                   "user_weekday_order_rate")


def u09_user_orders_per_week(src: Sources) -> DataFrame:
    return order_timing(_prior_orders(src)).select("user_id", "user_total_days_active", "user_orders_per_week")


def u10_user_order_frequency(src: Sources) -> DataFrame:
    return order_timing(_prior_orders(src)).select("user_id", "user_order_frequency")


def reorder_diversity(pairs: DataFrame, products: DataFrame, **extra: F.Column) -> DataFrame:
    """Distinct departments, aisles and products per user, overall and among
    the reordered ones (a pair counts as reordered if any line is).  Only
    catalogue products count; users without one get NULL counts.  Pairs
    without a user count, but never as reordered (the model meets the two
    sides by an equality of users).

    The pairs are summed once by user, department and aisle, and these sums
    (departments x aisles at most) dealt by user; each stands once under its
    department and once under its aisle, and distinct counts are counts of the
    sums by value, taken where they are.  ``extra`` sums over all of the user's
    pairs ride along (their columns must be on ``pairs``)."""
    catalogue = products.select("product_id", "department_id", "aisle_id", F.lit(True).alias("_known"))
    rows = pairs.join(catalogue, "product_id", "left").withColumn("_known", F.coalesce(F.col("_known"), F.lit(False)))
    rebought = F.col("_known") & (F.col("n_reorders") > 0) & F.col("user_id").isNotNull()
    sums = rows.groupBy("user_id", "department_id", "aisle_id").agg(
        F.count_if(F.col("_known")).alias("known"), F.count_if(rebought).alias("again"),
        *[expr.alias(name) for name, expr in extra.items()]).repartition("user_id")
    department, aisle = F.lit("department"), F.lit("aisle")
    under = F.inline(F.array(F.struct(department.alias("kind"), F.col("department_id").alias("value")),
                             F.struct(aisle.alias("kind"), F.col("aisle_id").alias("value"))))
    by_value = sums.select("user_id", "known", "again", *extra, under).groupBy("user_id", "kind", "value").agg(
        *[F.sum(c).alias(c) for c in ("known", "again", *extra)])

    def distinct(kind: F.Column, count: str) -> F.Column:
        return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull() & (F.col(count) > 0))

    def once(c: str) -> F.Column:  # every sum stands under its department and its aisle
        return F.sum(F.when(F.col("kind") == department, F.col(c)))

    per_user = by_value.groupBy("user_id").agg(
        once("known").alias("user_total_unique_products"), once("again").alias("user_reordered_unique_products"),
        distinct(department, "known").alias("user_unique_department_count"),
        distinct(department, "again").alias("user_reordered_department_count"),
        distinct(aisle, "known").alias("user_unique_aisle_count"),
        distinct(aisle, "again").alias("user_reordered_aisle_count"),
        *[once(name).alias(name) for name in extra])
    known = F.col("user_total_unique_products") > 0

    def if_known(name: str) -> F.Column:
        return F.when(known, F.col(name)).alias(name)

    return per_user.select(
        "user_id",
        if_known("user_unique_department_count"), if_known("user_unique_aisle_count"),
        if_known("user_total_unique_products"),
        if_known("user_reordered_department_count"), if_known("user_reordered_aisle_count"),
        if_known("user_reordered_unique_products"),
        F.when(known, rate(F.col("user_reordered_unique_products"), F.col("user_total_unique_products")))
        .alias("user_reorder_diversity_rate"),
        *extra.keys())


def u11_user_reorder_diversity(src: Sources) -> DataFrame:
    d = reorder_diversity(facts.shared_facts(src).pair_counts, src.products) \
        .filter(F.col("user_total_unique_products").isNotNull())
    # Stand-alone form: the reordered department/aisle counts are NULL when
    # the user reordered nothing.
    none = F.col("user_reordered_unique_products") == 0
    return (d.withColumn("user_reordered_department_count",
                         F.when(~none, F.col("user_reordered_department_count")))
            .withColumn("user_reordered_aisle_count", F.when(~none, F.col("user_reordered_aisle_count")))
            .orderBy("user_id"))


def u12_user_last_product_count(src: Sources) -> DataFrame:
    lines = facts.shared_facts(src).lines
    return (lines.filter(F.col("is_last")).groupBy("user_id")
            .agg(F.count("product_id").alias("user_last_product_count")))


def u13_user_first_product_count(src: Sources) -> DataFrame:
    return (facts.shared_facts(src).lines.filter(F.col("order_number") == 1).groupBy("user_id")
            .agg(F.count("product_id").alias("user_first_product_count")))


def u14_user_products_in_first_and_second(src: Sources) -> DataFrame:
    pairs = facts.shared_facts(src).pair_counts
    both = (F.col("in_first") == 1) & (F.col("in_second") == 1) & F.col("user_id").isNotNull()
    return (pairs.filter(both).groupBy("user_id")
            .agg(count_lines().alias("user_products_in_first_and_second")))


def u15_user_products_in_first_and_last(src: Sources) -> DataFrame:
    pairs = facts.shared_facts(src).pair_counts
    return (pairs.filter((F.col("in_first") == 1) & (F.col("in_last") == 1)).groupBy("user_id")
            .agg(count_lines().alias("user_products_in_first_and_last")))


OPERATORS = {
    "u01_user_basket_size": u01_user_basket_size,
    "u02_user_total_orders": u02_user_total_orders,
    "u03_user_reorder_rate": u03_user_reorder_rate,
    "u04_user_total_reorders": u04_user_total_reorders,
    "u05_user_avg_days_between_orders": u05_user_avg_days_between_orders,
    "u06_user_preferred_order_day": u06_user_preferred_order_day,
    "u07_user_order_hour_profile": u07_user_order_hour_profile,
    "u08_user_weekend_weekday_rate": u08_user_weekend_weekday_rate,
    "u09_user_orders_per_week": u09_user_orders_per_week,
    "u10_user_order_frequency": u10_user_order_frequency,
    "u11_user_reorder_diversity": u11_user_reorder_diversity,
    "u12_user_last_product_count": u12_user_last_product_count,
    "u13_user_first_product_count": u13_user_first_product_count,
    "u14_user_products_in_first_and_second": u14_user_products_in_first_and_second,
    "u15_user_products_in_first_and_last": u15_user_products_in_first_and_last,
}
