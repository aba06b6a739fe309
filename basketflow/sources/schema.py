"""Schemas of the six input tables and column lists of the output tables.

Ids are ``LongType`` so that int64 keys fit; the day gap keeps two decimals.
``reordered`` is boolean in the model; CSV files carry it as 0/1 and are read
through ``CSV_READ_SCHEMAS`` (integer) before the cast.
"""

from __future__ import annotations

from pyspark.sql import types as T

GAP_TYPE = T.DecimalType(10, 2)

AISLES = T.StructType([
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("aisle", T.StringType(), True),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.IntegerType(), False),
    T.StructField("department", T.StringType(), True),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("eval_set", T.StringType(), True),
    T.StructField("order_number", T.IntegerType(), True),
    T.StructField("order_dow", T.IntegerType(), True),
    T.StructField("order_hour_of_day", T.IntegerType(), True),
    T.StructField("days_since_prior_order", GAP_TYPE, True),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("aisle_id", T.IntegerType(), True),
    T.StructField("department_id", T.IntegerType(), True),
])

ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("add_to_cart_order", T.IntegerType(), True),
    T.StructField("reordered", T.BooleanType(), True),
])

SCHEMAS = {
    "aisles": AISLES,
    "departments": DEPARTMENTS,
    "orders": ORDERS,
    "products": PRODUCTS,
    "order_products_prior": ORDER_PRODUCTS,
    "order_products_train": ORDER_PRODUCTS,
}


def _csv_variant(schema: T.StructType) -> T.StructType:
    """CSV files store booleans as 0/1, which the CSV reader will not parse
    as boolean; read them as integers and cast afterwards."""
    return T.StructType([
        T.StructField(f.name, T.IntegerType() if isinstance(f.dataType, T.BooleanType) else f.dataType,
                      f.nullable)
        for f in schema.fields
    ])


CSV_READ_SCHEMAS = {name: _csv_variant(s) for name, s in SCHEMAS.items()}

# Primary keys (checked, not enforced) and foreign keys of the model.
PRIMARY_KEYS = {
    "aisles": ["aisle_id"],
    "departments": ["department_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "order_products_prior": ["order_id", "product_id"],
    "order_products_train": ["order_id", "product_id"],
}

FOREIGN_KEYS = [
    ("products", "aisle_id", "aisles", "aisle_id"),
    ("products", "department_id", "departments", "department_id"),
    ("order_products_prior", "order_id", "orders", "order_id"),
    ("order_products_prior", "product_id", "products", "product_id"),
    ("order_products_train", "order_id", "orders", "order_id"),
    ("order_products_train", "product_id", "products", "product_id"),
]

# Doubles whose last digits depend on the order in which rows are summed: a
# standard deviation and means of ratios.  All other doubles are quotients of
# exact sums.
ORDER_DEPENDENT_COLUMNS = frozenset({
    "user_basket_size_stddev", "product_avg_cart_position_relative_basket_size",
    "product_order_frequency", "product_order_per_week",
})

# Output column order of the materialised tables (fixed values).
ML_DATASET_COLUMNS = [
    "order_id", "user_id", "eval_set", "order_number", "order_dow",
    "order_hour_of_day", "days_since_prior_order", "product_id", "product_name",
    "department_id", "department", "aisle_id", "aisle", "add_to_cart_order",
    "reordered",
]

USER_FEATURE_COLUMNS = [
    "user_id", "user_avg_basket_size", "user_basket_size_stddev",
    "user_total_orders", "user_reorder_rate", "user_total_reorders",
    "user_avg_days_between_orders", "user_preferred_order_day",
    "user_preferred_order_hour", "user_morning_order_rate",
    "user_afternoon_order_rate", "user_evening_order_rate",
    "user_night_order_rate", "user_weekend_order_rate",
    "user_weekday_order_rate", "user_total_days_active", "user_orders_per_week",
    "user_order_frequency", "user_unique_department_count",
    "user_unique_aisle_count", "user_total_unique_products",
    "user_reordered_department_count", "user_reordered_aisle_count",
    "user_reordered_unique_products", "user_reorder_diversity_rate",
    "user_last_product_count", "user_first_product_count",
    "user_products_in_first_and_second", "user_products_in_first_and_last",
]

PRODUCT_FEATURE_COLUMNS = [
    "product_id", "product_reorder_rate", "product_order_count",
    "aisle_avg_product_order_count", "department_avg_product_order_count",
    "product_reorder_count", "product_first_order_count",
    "product_avg_days_between_orders",
    "product_avg_days_from_first_to_last_order", "product_order_frequency",
    "product_order_per_week", "product_preferred_order_day",
    "product_preferred_order_hour", "product_unique_user_count",
    "product_unique_reorder_user_count", "product_user_reorder_rate",
    "product_avg_cart_position",
    "product_avg_cart_position_relative_basket_size",
    "aisle_product_reorder_rate", "department_product_reorder_rate",
    "product_first_order_reorder_count", "product_first_order_user_count",
    "product_first_order_reorder_user_count",
    "product_first_order_reorder_rate", "product_repeat_user_count",
    "product_first_cart_first_order_count",
    "product_first_cart_first_order_pct",
    "product_first_cart_first_order_user_pct",
    "product_first_cart_first_order_user_count",
    "product_first_order_first_cart_reorder_user_count",
    "product_first_order_first_cart_reorder_rate", "product_in_first_and_last",
    "product_last_orders_count", "product_users_in_first_and_last",
    "department_product_popularity", "aisle_product_popularity",
]

USER_PRODUCT_FEATURE_COLUMNS = [
    "user_id", "product_id", "user_product_avg_cart_position",
    "user_product_order_tempo", "user_product_order_count",
    "user_product_order_share", "user_share_of_product_orders",
    "user_product_days_from_first_to_last",
    "user_product_avg_repurchase_interval", "user_product_order_rate_overall",
    "user_product_orders_since_first_purchase",
    "user_product_order_rate_since_first",
    "user_product_reorder_after_first_count", "user_product_in_first_and_last",
    "user_product_orders_since_last", "user_product_in_last_order",
    "user_product_current_streak", "user_product_order_trend",
    "user_product_days_since_last_order",
]
