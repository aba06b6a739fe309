"""ML dataset t4-t6: prior order lines with order and product attributes,
the optional train label and the three feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions import as_flag
from basketflow.operators.skew import NONE, salted_join
from basketflow.plans.facts import Facts, FactsOnDemand, shared_facts
from basketflow.sources.readers import Sources
from basketflow.sources.schema import ML_DATASET_COLUMNS

SENT_PRODUCTS = 400_000  # rows of 36 columns: about 130 MB in memory
DEALT_PAIRS = 2_000_000  # pairs from which tables are not small enough to leave them to the planner


def _with_catalogue(lines: DataFrame, src: Sources) -> DataFrame:
    """Attach product, department and aisle names (inner joins: products
    outside the dimension tables are not part of the dataset).

    Each dimension is joined on its own: the size of a stored table is a good
    estimate, that of joined ones is not, and it decides the broadcast."""
    return _with_groups(lines.join(src.products, "product_id"), src)


def _with_groups(products: DataFrame, src: Sources) -> DataFrame:
    return products.join(src.departments, "department_id").join(src.aisles, "aisle_id")


def ml_dataset(src: Sources, with_target: bool = False) -> DataFrame:
    """t4 (and t5 with ``with_target``): one row per prior order line.

    The day gap stays NULL on first orders and ``reordered`` stays boolean,
    which is what the model's sentinel/cast round trip ends with.  The label
    is 1 when the user's train basket holds the product with a known flag.
    The label side is joined as it is (not de-duplicated), so a user with
    several train baskets repeats the line once per matching basket.

    t4 does not join the labels: the model joins them and drops the column
    again, which leaves a line once only if no user has a product in two train
    baskets.  ``key_checks`` counts the lines that break this."""
    lines = _with_catalogue(src.order_products_prior.join(src.orders, "order_id"), src)
    cols = list(ML_DATASET_COLUMNS)
    if with_target:
        train = (src.order_products_train.join(src.orders.select("order_id", "user_id"), "order_id")
                 .select("user_id", "product_id", F.col("reordered").isNotNull().alias("_in_train")))
        heavy = shared_facts(src).heavy_pairs if src.home else NONE
        lines = (salted_join(lines, train, ["user_id", "product_id"], heavy, ["order_id"])
                 .withColumn("target_variable", as_flag(F.col("_in_train"))))
        cols.append("target_variable")
    return lines.select(*cols)


def ml_dataset_final(ml: DataFrame, user_feature: DataFrame, product_feature: DataFrame,
                     user_product_feature: DataFrame, fx: Facts | FactsOnDemand | None = None) -> DataFrame:
    """t6: the line dataset with the three feature tables (95 columns).

    Column order follows chained USING joins: the last join keys first.  ``fx``
    tells the heavy users, pairs and products, which are dealt to several
    tasks.  The product table, one row per product, is joined last: if it is
    stored and has at most ``SENT_PRODUCTS`` rows, it is sent to the joined rows,
    which would else be exchanged by product at their widest."""
    joined = _with_features(ml, user_feature, user_product_feature, fx)
    if isinstance(fx, FactsOnDemand) and product_feature.count() <= SENT_PRODUCTS:
        joined = joined.join(F.broadcast(product_feature), "product_id", "left")
    else:
        products = fx.heavy_product_lines if fx else NONE
        joined = salted_join(joined, product_feature, ["product_id"], products, ["order_id"])
    return joined.select(*_final_columns(ml.columns, user_feature, product_feature, user_product_feature))


def final_of_sources(src: Sources, user_feature: DataFrame, product_feature: DataFrame,
                     user_product_feature: DataFrame, fx: Facts | FactsOnDemand) -> DataFrame:
    """t6 from the sources: the lines are exchanged without the names of their
    products, which are sent to the joined rows together with the product table,
    if both have at most ``SENT_PRODUCTS`` rows."""
    if not isinstance(fx, FactsOnDemand) or max(src.products.count(), product_feature.count()) > SENT_PRODUCTS:
        return ml_dataset_final(ml_dataset(src), user_feature, product_feature, user_product_feature, fx)
    lines = src.order_products_prior.join(src.orders, "order_id")
    lines = lines.select(*[c for c in ML_DATASET_COLUMNS if c in lines.columns])
    joined = _with_features(lines, user_feature, user_product_feature, fx)
    products = _with_groups(src.products, src).join(product_feature, "product_id", "left")
    return (joined.join(F.broadcast(products), "product_id")
            .select(*_final_columns(ML_DATASET_COLUMNS, user_feature, product_feature, user_product_feature)))


def _with_features(lines: DataFrame, user_feature: DataFrame, user_product_feature: DataFrame,
                   fx: Facts | FactsOnDemand | None) -> DataFrame:
    """Lines with the tables by pair and by user.

    Many pairs are dealt by user, as the lines and the user table are: each row is
    exchanged once, and the widest rows are not exchanged at all.  That needs
    users with few lines; where one has many, the user table is joined to the
    pair table, which has every (user, product) of the lines, and the lines are
    dealt by pair (a line without a user meets neither table in either order)."""
    keys = ["user_id", "product_id"]
    if isinstance(fx, FactsOnDemand) and user_product_feature.count() > DEALT_PAIRS and not fx.heavy_user_lines.rows:
        own, given = (F.struct(*[c for c in t.columns if c not in keys]) for t in (lines, user_product_feature))
        line_type, pair_type = (t.select(c).schema[0].dataType for t, c in ((lines, own), (user_product_feature, given)))
        rows = lines.select(*keys, own.alias("_line"), F.lit(None).cast(pair_type).alias("_pair"))
        pairs = user_product_feature.dropna(subset=keys).select(*keys, F.lit(None).cast(line_type).alias("_line"),
                                                                given.alias("_pair"))
        # A join by (user, product) would deal both by both keys, whereas the rows of a
        # window may be dealt by one of them.  The pair, of which there is one, stands first.
        met = (Window.partitionBy(*keys).orderBy(F.col("_pair").isNull())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        joined = (pairs.unionByName(rows).repartition("user_id").withColumn("_pair", F.first("_pair").over(met))
                  .where(F.col("_line").isNotNull()).select(*keys, "_line.*", "_pair.*"))
        return joined.join(user_feature, "user_id", "left")
    users, pairs = (fx.heavy_users, fx.heavy_pairs) if fx else (NONE, NONE)
    return salted_join(lines, salted_join(user_product_feature, user_feature, ["user_id"], users, ["product_id"]),
                       keys, pairs, ["order_id"])


def _final_columns(line_columns, user_feature: DataFrame, product_feature: DataFrame,
                   user_product_feature: DataFrame) -> list[str]:
    keys = ["user_id", "product_id"]
    return (keys + [c for c in line_columns if c not in keys] + [c for c in user_feature.columns if c != "user_id"]
            + [c for c in product_feature.columns if c != "product_id"]
            + [c for c in user_product_feature.columns if c not in keys])
