"""Data-quality checks as Spark aggregations.

The row checks of a table are conditional counts (``observed_counts`` names them by
table).  They can be taken while the table is written (``store.write_copy``,
``sinks.write_table``); the checks then get them as ``seen`` and read the table
only for what needs a grouping or a join.  Without ``seen`` they are one
aggregation of the table.  Comparisons with other tables add an aggregation or
an anti join each.  A report is ``(check, bad_rows)``.  A condition that evaluates to NULL passes, as
in SQL.  ``enforce`` raises on any non-zero count; the report itself has one
row per check, never per data row.

The conditions below are fixed values: they must equal the checks of the
modelled workload.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.constants import CHECK_TOLERANCE
from basketflow.sources.readers import Sources
from basketflow.sources.schema import FOREIGN_KEYS, PRIMARY_KEYS

TOLERANCE = CHECK_TOLERANCE


class DataQualityError(AssertionError):
    """Raised by ``enforce`` with the failing checks."""


def _any(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _outside(col: str, lo: float, hi: float) -> Column:
    return ~F.col(col).between(lo, hi)


ROWS = "_rows"


def _row_counts(conditions: dict[str, Column]) -> dict[str, Column]:
    """The aggregates behind a table's row checks, and its number of rows."""
    return {ROWS: F.count(F.lit(1)), **{name: F.count_if(c) for name, c in conditions.items()}}


def _report(df: DataFrame, conditions: dict[str, Column], seen: dict | None) -> DataFrame:
    """A row per row check, from what was seen or by one aggregation."""
    if seen is not None:
        return df.sparkSession.createDataFrame([(name, int(seen[name])) for name in conditions],
                                               "check string, bad_rows long")
    wide = df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])
    return _rows(wide, list(conditions))


def _row_count(df: DataFrame, seen: dict | None) -> DataFrame:
    return _count(df) if seen is None else df.sparkSession.createDataFrame([(int(seen[ROWS]),)], "k long")


def _rows(wide: DataFrame, names: list[str]) -> DataFrame:
    return wide.unpivot([], names, "check", "bad_rows").select(
        "check", F.col("bad_rows").cast("long").alias("bad_rows"))


def _difference(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """|a - b| for two one-row, one-column counts (summed with signs, so the
    two never meet in a product)."""
    signed = a.select(F.col(a.columns[0]).alias("v")).union(b.select(-F.col(b.columns[0])))
    return signed.agg(F.abs(F.sum("v")).cast("long").alias("bad_rows")).select(F.lit(name).alias("check"), "bad_rows")


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("k"))


def _user_conditions() -> dict[str, Column]:
    c = F.col
    return {
        "user_subset_counts": _any(
            c("user_reordered_unique_products") > c("user_total_unique_products"),
            c("user_reordered_department_count") > c("user_unique_department_count"),
            c("user_reordered_aisle_count") > c("user_unique_aisle_count"),
            c("user_reordered_unique_products") > c("user_total_reorders"),
            c("user_products_in_first_and_second") > c("user_first_product_count"),
            c("user_products_in_first_and_last") > c("user_first_product_count"),
            c("user_products_in_first_and_last") > c("user_last_product_count")),
        "user_rates_in_unit_interval": _any(*[_outside(x, 0, 1) for x in (
            "user_reorder_rate", "user_reorder_diversity_rate", "user_morning_order_rate",
            "user_afternoon_order_rate", "user_evening_order_rate", "user_night_order_rate",
            "user_weekend_order_rate", "user_weekday_order_rate")]),
        "user_partition_rates_sum_to_one": _any(
            F.abs(c("user_morning_order_rate") + c("user_afternoon_order_rate") + c("user_evening_order_rate")
                  + c("user_night_order_rate") - 1) > TOLERANCE,
            F.abs(c("user_weekend_order_rate") + c("user_weekday_order_rate") - 1) > TOLERANCE),
        "user_domain_bounds": _any(
            c("user_total_orders") < 1, c("user_avg_basket_size") < 1, c("user_total_unique_products") < 1,
            _outside("user_preferred_order_day", 0, 6), _outside("user_preferred_order_hour", 0, 23),
            _outside("user_avg_days_between_orders", 0, 30)),
    }


def user_feature_checks(uf: DataFrame, src: Sources, seen: dict | None = None) -> DataFrame:
    # One row per user; COUNT(DISTINCT) leaves a missing user out, as the model
    # does, so a row without a user counts as a difference.
    users = _count(src.orders.filter((F.col("eval_set") == "prior") & F.col("user_id").isNotNull())
                   .select("user_id").distinct())
    return (_difference("user_grain", _row_count(uf, seen), users)
            .unionByName(_report(uf, _user_conditions(), seen)))


def _product_conditions() -> dict[str, Column]:
    c = F.col
    return {
        "product_subset_counts": _any(
            c("product_reorder_count") > c("product_order_count"),
            c("product_first_order_count") > c("product_order_count"),
            c("product_unique_reorder_user_count") > c("product_unique_user_count"),
            c("product_first_order_reorder_user_count") > c("product_first_order_user_count"),
            c("product_first_order_first_cart_reorder_user_count") > c("product_first_cart_first_order_user_count"),
            c("product_repeat_user_count") > c("product_first_order_user_count"),
            c("product_users_in_first_and_last") > c("product_unique_user_count"),
            c("product_first_cart_first_order_user_count") > c("product_first_order_user_count")),
        "product_rates_in_unit_interval": _any(*[_outside(x, 0, 1) for x in (
            "product_reorder_rate", "product_user_reorder_rate", "product_first_order_reorder_rate",
            "product_first_order_first_cart_reorder_rate", "aisle_product_reorder_rate",
            "department_product_reorder_rate")]),
        "product_pct_in_range": _any(_outside("product_first_cart_first_order_pct", 0, 100),
                                     _outside("product_first_cart_first_order_user_pct", 0, 100)),
        "product_domain_bounds": _any(
            c("product_avg_cart_position") < 1,
            _outside("product_avg_cart_position_relative_basket_size", 0, 1),
            ~c("product_in_first_and_last").isin(0, 1),
            _outside("product_preferred_order_day", 0, 6), _outside("product_preferred_order_hour", 0, 23),
            c("department_product_popularity") < 1, c("aisle_product_popularity") < 1),
    }


def product_feature_checks(pf: DataFrame, src: Sources, seen: dict | None = None) -> DataFrame:
    products = _count(src.order_products_prior.select("product_id").distinct())
    return (_difference("product_grain", _row_count(pf, seen), products)
            .unionByName(_report(pf, _product_conditions(), seen)))


def _user_product_conditions() -> dict[str, Column]:
    c = F.col

    def open_unit(col: str) -> Column:
        return (c(col) <= 0) | (c(col) > 1)

    n = c("user_product_order_count")
    return {
        "user_product_rates_in_open_unit": _any(*[open_unit(x) for x in (
            "user_product_order_rate_overall", "user_product_order_rate_since_first",
            "user_product_order_share", "user_share_of_product_orders")]),
        "user_product_recency_consistency":
            (c("user_product_orders_since_last") == 0) != (c("user_product_in_last_order") == 1),
        "user_product_span_nulls": ((n == 1) & c("user_product_days_from_first_to_last").isNotNull())
            | ((n >= 2) & c("user_product_days_from_first_to_last").isNull()),
        "user_product_interval_times_count": (n >= 2) & (F.abs(
            c("user_product_avg_repurchase_interval") * (n - 1) - c("user_product_days_from_first_to_last"))
            > TOLERANCE),
        "user_product_domain_bounds": _any(
            n < 1, n > c("user_product_orders_since_first_purchase"),
            c("user_product_current_streak") < 0, c("user_product_current_streak") > n,
            c("user_product_orders_since_last") < 0, c("user_product_days_since_last_order") < 0,
            c("user_product_reorder_after_first_count").isNotNull()
            & (c("user_product_reorder_after_first_count") > n - 1),
            ~c("user_product_in_first_and_last").isin(0, 1), ~c("user_product_in_last_order").isin(0, 1)),
        "user_product_first_last_implies_last":
            (c("user_product_in_first_and_last") == 1) & (c("user_product_in_last_order") == 0),
    }


def user_product_feature_checks(upf: DataFrame, uf: DataFrame, pf: DataFrame, src: Sources,
                                seen: dict | None = None) -> DataFrame:
    source_pairs = (src.order_products_prior.join(src.orders.select("order_id", "user_id"), "order_id")
                    .select("user_id", "product_id").distinct())
    missing_users = _count(upf.select("user_id").filter("user_id is not null").distinct()
                           .join(uf.select("user_id"), "user_id", "left_anti"))
    missing_products = _count(upf.select("product_id").distinct().join(pf.select("product_id"), "product_id", "left_anti"))
    # One aggregation of the table by pair, then by user, then as a whole,
    # gives rows, distinct pairs, users, share sums and, unless they were seen
    # when the table was written, the row conditions.
    conditions = _user_product_conditions()
    counts = {name: F.count_if(cond).alias(name) for name, cond in conditions.items()} if seen is None else {}
    by_pair = upf.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("user_product_order_share").alias("_share"), *counts.values())
    by_user = by_pair.groupBy("user_id").agg(
        F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_pairs"), F.sum("_share").alias("_share"),
        *[F.sum(name).alias(name) for name in counts])
    whole = by_user.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_pairs"), F.lit(0)).alias("_pairs"),
        F.count("user_id").alias("_users"),
        F.count_if(F.abs(F.col("_share") - 1) > TOLERANCE).alias("user_product_share_sums"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts])
    whole = whole.withColumn("user_product_grain", F.col("_rows") - F.col("_pairs"))
    named = ["user_product_grain", "user_product_share_sums", *counts]
    # Comparisons with other tables: this side's counts, and the others' as
    # rows of the same shape with a minus sign.
    ours = whole.unpivot([], ["_rows", "_users"], "check", "v")
    label = F.when(F.col("check") == "_rows", "user_product_coverage").otherwise("user_product_user_count")
    theirs = (_count(source_pairs).select(F.lit("user_product_coverage").alias("check"), (-F.col("k")).alias("v"))
              .union(_count(uf).select(F.lit("user_product_user_count"), -F.col("k"))))
    compared = (ours.select(label.alias("check"), "v").union(theirs)
                .groupBy("check").agg(F.abs(F.sum("v")).cast("long").alias("bad_rows")))
    report = reduce(DataFrame.unionByName, [
        _rows(whole, named), *([] if seen is None else [_report(upf, conditions, seen)]), compared,
        missing_users.select(F.lit("user_product_users_in_user_feature").alias("check"), F.col("k").alias("bad_rows")),
        missing_products.select(F.lit("user_product_products_in_product_feature").alias("check"),
                                F.col("k").alias("bad_rows"))])
    return _with_verdict(report)


def _with_verdict(report: DataFrame) -> DataFrame:
    """The report with a last row ``ok`` that counts the failed checks (0:
    all passed)."""
    flag = report.select("check", "bad_rows", (F.col("bad_rows") != 0).cast("long").alias("failed"))
    rolled = flag.rollup("check").agg(F.sum("bad_rows").alias("bad_rows"), F.sum("failed").alias("failed"))
    return rolled.select(F.coalesce("check", F.lit("ok")).alias("check"),
                         F.when(F.col("check").isNull(), F.col("failed")).otherwise(F.col("bad_rows")).alias("bad_rows"))


def observed_counts(table: str) -> dict[str, Column]:
    """What is counted while a feature table is written."""
    return _row_counts({"user_feature": _user_conditions, "product_feature": _product_conditions,
                        "user_product_feature": _user_product_conditions}[table]())


def _repeated_labels(src: Sources) -> DataFrame:
    """Train lines whose user has the product in several train lines.

    Lines are summed by order and product first, where they are stored.  Only
    the sums of users with several train baskets must meet by user and product;
    a user with one basket has that order's sums."""
    baskets = src.order_products_train.groupBy("order_id").agg(F.count(F.lit(1)).alias("_lines"))
    orders = (src.orders.filter("user_id is not null").select("order_id", "user_id")
              .join(baskets, "order_id").select("order_id", "user_id"))
    several = (orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
               .select(F.col("user_id").alias("_user"), (F.col("_n") > 1).alias("several")))
    orders = orders.join(several, F.col("user_id") == F.col("_user")).drop("_user")
    sums = (src.order_products_train.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("k"))
            .join(orders, "order_id"))
    met = sums.filter("several").groupBy("user_id", "product_id").agg(F.sum("k").alias("k"))
    return (sums.filter("not several").select("k").unionByName(met.select("k")).filter("k > 1")
            .agg(F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("bad_rows")))


def key_checks(src: Sources) -> DataFrame:
    """Primary keys: duplicate or NULL key rows per table; and the train lines
    whose user has the product in several train baskets (``ml_dataset`` takes
    a label to be unique)."""
    parts = [_repeated_labels(src).select(F.lit("key_train_labels").alias("check"), "bad_rows")]
    for table, keys in PRIMARY_KEYS.items():
        df = getattr(src, table)
        null_key = _any(*[F.col(k).isNull() for k in keys])
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.count_if(null_key).alias("z"))
               .agg(F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0))
                    + F.coalesce(F.sum("z"), F.lit(0))))
        parts.append(dup.select(F.lit(f"key_{table}").alias("check"),
                                F.col(dup.columns[0]).cast("long").alias("bad_rows")))
    return reduce(DataFrame.unionByName, parts)


def reference_checks(src: Sources) -> DataFrame:
    """Foreign keys: child rows whose (non-NULL) key has no parent row."""
    parts = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        kids = getattr(src, child).filter(F.col(col).isNotNull())
        parents = getattr(src, parent).select(F.col(pcol).alias(col))
        # Lines and orders are stored by order; other keys are few, so the
        # rows are summed by key before they meet the parents.
        counted = kids.groupBy(col).agg(F.count(F.lit(1)).alias("k"))
        orphans = counted.join(parents, col, "left_anti").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("bad_rows"))
        parts.append(orphans.select(F.lit(f"ref_{child}_{col}").alias("check"),
                                    F.col("bad_rows").cast("long")))
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame) -> DataFrame:
    """Raise ``DataQualityError`` if any check counts a bad row.  The report
    has one row per check, so collecting it is bounded."""
    failed = [(r["check"], r["bad_rows"]) for r in report.filter(F.col("bad_rows") != 0).collect()]
    if failed:
        raise DataQualityError("; ".join(f"{name}: {bad}" for name, bad in failed))
    return report


def _q_user(src: Sources) -> DataFrame:
    from basketflow.plans import tables
    uf, _, _ = tables.shared_tables(src)
    return user_feature_checks(uf, src, tables.seen_while_written(src, "user_feature"))


def _q_product(src: Sources) -> DataFrame:
    from basketflow.plans import tables
    _, pf, _ = tables.shared_tables(src)
    return product_feature_checks(pf, src, tables.seen_while_written(src, "product_feature"))


def _q_user_product(src: Sources) -> DataFrame:
    from basketflow.plans import tables
    uf, pf, upf = tables.shared_tables(src)
    return user_product_feature_checks(upf, uf, pf, src, tables.seen_while_written(src, "user_product_feature"))


CHECK_QUERIES = {
    "q_user_feature_checks": _q_user,
    "q_product_feature_checks": _q_product,
    "q_user_product_feature_checks": _q_user_product,
    "q_key_checks": key_checks,
    "q_reference_checks": reference_checks,
}
