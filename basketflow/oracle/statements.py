"""Oracle statements: one DuckDB SQL text per registered query.

Each feature is a *part*: a SELECT over the prelude relations (and possibly
other parts), with its output columns.  Parts are unrounded; only the final
projection of a statement rounds the doubles that depend on the order of
summation, like the Spark registry does.  Tables and checks are composed from
the parts.

Output names, their order and the check conditions are fixed values: they are
the definition that is being tested.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from basketflow.oracle.prelude import MAPPING_CTES, MODEL_CTES
from basketflow.sources.schema import (
    ML_DATASET_COLUMNS, ORDER_DEPENDENT_COLUMNS, PRODUCT_FEATURE_COLUMNS, USER_FEATURE_COLUMNS,
    USER_PRODUCT_FEATURE_COLUMNS,
)


@dataclass(frozen=True)
class Part:
    sql: str
    cols: str  # comma separated
    deps: tuple[str, ...] = field(default_factory=tuple)

    def columns(self) -> list[str]:
        return [item.strip() for item in self.cols.split(",")]


def _mode(key: str, value: str, source: str, alias: str) -> str:
    """Most frequent value per key, smallest value on ties; NULL only if the
    key has no other value."""
    return f"""SELECT {key}, {value} AS {alias} FROM (
      SELECT {key}, {value},
             ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {value} IS NULL, COUNT(*) DESC, {value}) AS pick
      FROM {source} GROUP BY {key}, {value}) WHERE pick = 1"""


P: dict[str, Part] = {}

# ---------------------------------------------------------------- products
P["p01"] = Part("""SELECT product_id, AVG(CAST(reordered AS INTEGER)) AS product_reorder_rate
  FROM bf_prior GROUP BY product_id""", "product_id, product_reorder_rate")
P["p02"] = Part("""SELECT product_id, COUNT(*) AS product_order_count FROM bf_prior GROUP BY product_id""",
                "product_id, product_order_count")
for key, grp, out in (("p03", "aisle_id", "aisle_avg_product_order_count"),
                      ("p04", "department_id", "department_avg_product_order_count")):
    P[key] = Part(f"""SELECT product_id, {grp}, AVG(CAST(k AS DOUBLE)) OVER (PARTITION BY {grp}) AS {out} FROM (
      SELECT l.product_id, c.{grp}, COUNT(*) AS k FROM bf_prior l JOIN bf_products c ON c.product_id = l.product_id
      GROUP BY l.product_id, c.{grp})""", f"product_id, {grp}, {out}")
P["p05"] = Part("""SELECT product_id, COUNT(*) AS product_reorder_count FROM bf_prior WHERE reordered
  GROUP BY product_id""", "product_id, product_reorder_count")
P["p06"] = Part("""SELECT product_id, COUNT(*) AS product_first_order_count FROM bf_lines WHERE order_number = 1
  GROUP BY product_id""", "product_id, product_first_order_count")
P["p07"] = Part("""SELECT product_id, AVG(CAST(days_since_prior_order AS DOUBLE)) AS product_avg_days_between_orders
  FROM bf_lines GROUP BY product_id""", "product_id, product_avg_days_between_orders")
P["pair_span"] = Part("""SELECT pb.user_id, pb.product_id, pb.n,
      CAST(cl.cum_days - cf.cum_days AS DOUBLE) AS span
  FROM bf_pair_base pb
  JOIN bf_cum cf ON cf.user_id = pb.user_id AND cf.order_number = pb.first_no
  JOIN bf_cum cl ON cl.user_id = pb.user_id AND cl.order_number = pb.last_no""", "user_id, product_id, n, span")
P["p08"] = Part("""SELECT product_id, AVG(span) AS product_avg_days_from_first_to_last_order,
      AVG(CAST(n - 1 AS DOUBLE) / NULLIF(span, 0)) AS product_order_frequency,
      AVG(CAST(n - 1 AS DOUBLE) / NULLIF(span, 0)) * 7 AS product_order_per_week
  FROM pair_span GROUP BY product_id""",
                "product_id, product_avg_days_from_first_to_last_order, product_order_frequency, "
                "product_order_per_week", ("pair_span",))
P["p09"] = Part(_mode("product_id", "order_dow", "bf_lines", "product_preferred_order_day"),
                "product_id, product_preferred_order_day")
P["p10"] = Part(_mode("product_id", "order_hour_of_day", "bf_lines", "product_preferred_order_hour"),
                "product_id, product_preferred_order_hour")
P["p11"] = Part("""SELECT l.product_id, COUNT(DISTINCT o.user_id) AS product_unique_user_count,
      CASE WHEN BOOL_OR(l.reordered) THEN COUNT(DISTINCT o.user_id) FILTER (WHERE l.reordered) END
        AS product_unique_reorder_user_count,
      CAST(COUNT(DISTINCT o.user_id) FILTER (WHERE l.reordered) AS DOUBLE) / COUNT(DISTINCT o.user_id)
        AS product_user_reorder_rate
  FROM bf_prior l LEFT JOIN bf_orders o ON o.order_id = l.order_id GROUP BY l.product_id""",
                "product_id, product_unique_user_count, product_unique_reorder_user_count, "
                "product_user_reorder_rate")
P["p12"] = Part("""SELECT product_id, AVG(add_to_cart_order) AS product_avg_cart_position FROM bf_prior
  GROUP BY product_id""", "product_id, product_avg_cart_position")
P["p13"] = Part("""SELECT product_id,
      AVG(CAST(add_to_cart_order AS DOUBLE) / basket) AS product_avg_cart_position_relative_basket_size
  FROM (SELECT product_id, add_to_cart_order, COUNT(*) OVER (PARTITION BY order_id) AS basket FROM bf_prior)
  GROUP BY product_id""", "product_id, product_avg_cart_position_relative_basket_size")
for key, grp, out in (("p14", "aisle_id", "aisle_product_reorder_rate"),
                      ("p15", "department_id", "department_product_reorder_rate")):
    P[key] = Part(f"""SELECT c.product_id, g.r AS {out} FROM bf_products c LEFT JOIN (
      SELECT d.{grp}, CAST(COUNT(*) FILTER (WHERE l.reordered) AS DOUBLE) / COUNT(*) AS r
      FROM bf_prior l JOIN bf_products d ON d.product_id = l.product_id GROUP BY d.{grp}) g
    ON g.{grp} = c.{grp}""", f"product_id, {out}")
P["p16"] = Part("""SELECT product_id, COUNT(*) AS product_first_order_reorder_count FROM bf_prior
  WHERE reordered AND product_id IN (SELECT product_id FROM bf_lines WHERE order_number = 1)
  GROUP BY product_id""", "product_id, product_first_order_reorder_count")
P["p17"] = Part("""SELECT f.product_id, COUNT(*) AS product_first_order_user_count,
      COUNT(*) FILTER (WHERE pb.n_re > 0) AS product_first_order_reorder_user_count,
      CAST(COUNT(*) FILTER (WHERE pb.n_re > 0) AS DOUBLE) / COUNT(*) AS product_first_order_reorder_rate
  FROM bf_first_pairs f JOIN bf_pair_base pb ON pb.user_id = f.user_id AND pb.product_id = f.product_id
  GROUP BY f.product_id""",
                "product_id, product_first_order_user_count, product_first_order_reorder_user_count, "
                "product_first_order_reorder_rate")
P["p18"] = Part("""SELECT product_id, COUNT(user_id) AS product_repeat_user_count FROM (
    SELECT user_id, product_id FROM bf_first_pairs INTERSECT SELECT user_id, product_id FROM bf_second_pairs)
  GROUP BY product_id""", "product_id, product_repeat_user_count")
P["p19"] = Part("""SELECT product_id, k AS product_first_cart_first_order_count,
      CAST(k AS DOUBLE) * 100.0 / CAST(SUM(k) OVER () AS DOUBLE) AS product_first_cart_first_order_pct
  FROM (SELECT product_id, COUNT(*) AS k FROM bf_lines WHERE order_number = 1 AND add_to_cart_order = 1
        GROUP BY product_id)""", "product_id, product_first_cart_first_order_count, "
                                 "product_first_cart_first_order_pct")
P["p20"] = Part("""SELECT product_id, k AS product_first_cart_first_order_user_count,
      CAST(k AS DOUBLE) * 100.0 / CAST(SUM(k) OVER () AS DOUBLE) AS product_first_cart_first_order_user_pct
  FROM (SELECT product_id, COUNT(user_id) AS k FROM bf_lines WHERE order_number = 1 AND add_to_cart_order = 1
        GROUP BY product_id)""", "product_id, product_first_cart_first_order_user_count, "
                                 "product_first_cart_first_order_user_pct")
P["first_cart_pairs"] = Part("""SELECT DISTINCT user_id, product_id FROM bf_lines
  WHERE order_number = 1 AND add_to_cart_order = 1""", "user_id, product_id")
P["p21"] = Part("""SELECT f.product_id, COUNT(*) AS product_first_cart_first_order_user_count,
      COUNT(*) FILTER (WHERE pb.n_re > 0) AS product_first_order_reorder_user_count,
      CAST(COUNT(*) FILTER (WHERE pb.n_re > 0) AS DOUBLE) / COUNT(*) AS product_first_order_reorder_rate
  FROM first_cart_pairs f JOIN bf_pair_base pb ON pb.user_id = f.user_id AND pb.product_id = f.product_id
  GROUP BY f.product_id""",
                "product_id, product_first_cart_first_order_user_count, product_first_order_reorder_user_count, "
                "product_first_order_reorder_rate", ("first_cart_pairs",))
P["p22"] = Part("""SELECT d.product_id,
      CASE WHEN d.product_id IN (SELECT product_id FROM bf_first_pairs)
            AND d.product_id IN (SELECT product_id FROM bf_last_pairs) THEN 1 ELSE 0 END
        AS product_in_first_and_last
  FROM (SELECT DISTINCT product_id FROM bf_prior) d""", "product_id, product_in_first_and_last")
P["p23"] = Part("""SELECT l.product_id, COUNT(*) AS product_last_orders_count
  FROM bf_lines l JOIN bf_user_bounds b ON b.user_id = l.user_id AND l.order_number = b.max_no
  GROUP BY l.product_id""", "product_id, product_last_orders_count")
P["p24"] = Part("""SELECT product_id, COUNT(*) AS product_users_in_first_and_last FROM (
    SELECT user_id, product_id FROM bf_first_pairs INTERSECT SELECT user_id, product_id FROM bf_last_pairs)
  GROUP BY product_id""", "product_id, product_users_in_first_and_last")
P["p25"] = Part("""SELECT k.product_id,
      CAST(DENSE_RANK() OVER (PARTITION BY c.department_id ORDER BY k.n DESC) AS BIGINT)
        AS department_product_popularity,
      CAST(DENSE_RANK() OVER (PARTITION BY c.aisle_id ORDER BY k.n DESC) AS BIGINT) AS aisle_product_popularity
  FROM (SELECT product_id, COUNT(*) AS n FROM bf_prior GROUP BY product_id) k
  JOIN bf_products c ON c.product_id = k.product_id""",
                "product_id, department_product_popularity, aisle_product_popularity")

# ------------------------------------------------------ user x product
P["up01"] = Part("""SELECT user_id, product_id, AVG(add_to_cart_order) AS user_product_avg_cart_position
  FROM bf_lines GROUP BY user_id, product_id""", "user_id, product_id, user_product_avg_cart_position")
P["up02"] = Part("""SELECT user_id, product_id, AVG(CAST(days_since_prior_order AS DOUBLE)) AS user_order_tempo
  FROM bf_lines GROUP BY user_id, product_id""", "user_id, product_id, user_order_tempo")
P["up03"] = Part("""SELECT user_id, product_id, span AS user_product_days_from_first_to_last,
      span / NULLIF(n - 1, 0) AS user_product_avg_repurchase_interval FROM pair_span""",
                 "user_id, product_id, user_product_days_from_first_to_last, "
                 "user_product_avg_repurchase_interval", ("pair_span",))
P["up04"] = Part("""SELECT user_id, product_id, n AS user_product_order_count,
      CAST(n AS DOUBLE) / CAST(SUM(n) OVER (PARTITION BY user_id) AS DOUBLE) AS user_product_order_share
  FROM bf_pair_base""",
                 "user_id, product_id, user_product_order_count, user_product_order_share")
P["up05"] = Part("""SELECT pb.user_id, pb.product_id, pb.n AS user_product_order_count,
      CAST(pb.n AS DOUBLE) / b.total_orders AS user_product_order_rate_overall,
      CAST(b.max_no - pb.first_no + 1 AS BIGINT) AS product_orders_since_first_purchase,
      CAST(pb.n AS DOUBLE) / (b.max_no - pb.first_no + 1) AS user_product_order_rate_since_first
  FROM bf_pair_base pb JOIN bf_user_bounds b ON b.user_id = pb.user_id""",
                 "user_id, product_id, user_product_order_count, user_product_order_rate_overall, "
                 "product_orders_since_first_purchase, user_product_order_rate_since_first")
P["up06"] = Part("""SELECT user_id, product_id,
      CAST(n AS DOUBLE) / CAST(SUM(n) OVER (PARTITION BY product_id) AS DOUBLE) AS user_share_of_product_orders
  FROM bf_pair_base""", "user_id, product_id, user_share_of_product_orders")
P["up07"] = Part("""SELECT pb.product_id, pb.user_id, pb.n_re AS user_product_reorder_after_first_count
  FROM bf_pair_base pb JOIN bf_first_pairs f ON f.user_id = pb.user_id AND f.product_id = pb.product_id
  WHERE pb.n_re > 0""", "product_id, user_id, user_product_reorder_after_first_count")
P["up08"] = Part("""SELECT t.product_id, t.user_id, NULLIF(r.n_re, 0) AS user_product_reorder_count,
      CAST(COALESCE(r.n_re, 0) AS DOUBLE) / t.n AS user_product_reorder_rate
  FROM bf_pair_base t LEFT JOIN bf_pair_base r ON r.product_id = t.product_id AND r.user_id = t.user_id""",
                 "product_id, user_id, user_product_reorder_count, user_product_reorder_rate")
P["both_first_last"] = Part("""SELECT user_id, product_id FROM bf_first_pairs
  INTERSECT SELECT user_id, product_id FROM bf_last_pairs""", "user_id, product_id")
P["up09"] = Part("""SELECT pb.product_id, pb.user_id,
      CAST(CASE WHEN x.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS product_in_first_and_last
  FROM bf_pair_base pb LEFT JOIN both_first_last x ON x.user_id = pb.user_id AND x.product_id = pb.product_id""",
                 "product_id, user_id, product_in_first_and_last", ("both_first_last",))
P["up10"] = Part("""SELECT pb.user_id, pb.product_id, CAST(b.max_no - pb.last_no AS BIGINT) AS user_product_orders_since_last
  FROM bf_pair_base pb JOIN bf_user_bounds b ON b.user_id = pb.user_id""",
                 "user_id, product_id, user_product_orders_since_last")
P["up11"] = Part("""SELECT pb.user_id, pb.product_id,
      CAST(CASE WHEN x.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS user_product_in_last_order
  FROM bf_pair_base pb LEFT JOIN bf_last_pairs x ON x.user_id = pb.user_id AND x.product_id = pb.product_id""",
                 "user_id, product_id, user_product_in_last_order")
P["up12"] = Part("""SELECT r.user_id, r.product_id, CAST(r.len AS BIGINT) AS user_product_current_streak FROM (
      SELECT user_id, product_id, COUNT(*) AS len, MAX(order_number) AS run_end FROM (
        SELECT user_id, product_id, order_number,
               order_number - ROW_NUMBER() OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS island
        FROM bf_lines) GROUP BY user_id, product_id, island) r
  JOIN bf_user_bounds b ON b.user_id = r.user_id AND r.run_end = b.max_no""",
                 "user_id, product_id, user_product_current_streak")
P["up13"] = Part("""SELECT ph.user_id, ph.product_id,
      CAST(ph.late AS DOUBLE) / NULLIF(h.late, 0) - CAST(ph.early AS DOUBLE) / NULLIF(h.early, 0)
        AS user_product_order_trend
  FROM (SELECT l.user_id, l.product_id,
               COUNT(*) FILTER (WHERE l.order_number <= b.max_no / 2.0) AS early,
               COUNT(*) FILTER (WHERE l.order_number > b.max_no / 2.0) AS late
        FROM bf_lines l JOIN bf_user_bounds b ON b.user_id = l.user_id GROUP BY l.user_id, l.product_id) ph
  JOIN (SELECT o.user_id,
               COUNT(*) FILTER (WHERE o.order_number <= b.max_no / 2.0) AS early,
               COUNT(*) FILTER (WHERE o.order_number > b.max_no / 2.0) AS late
        FROM bf_prior_orders o JOIN bf_user_bounds b ON b.user_id = o.user_id GROUP BY o.user_id) h
    ON h.user_id = ph.user_id""", "user_id, product_id, user_product_order_trend")
P["up14"] = Part("""SELECT pb.user_id, pb.product_id,
      CAST(cu.cum_days - cp.cum_days AS DOUBLE) AS user_product_days_since_last_order
  FROM bf_pair_base pb JOIN bf_user_bounds b ON b.user_id = pb.user_id
  JOIN bf_cum cu ON cu.user_id = pb.user_id AND cu.order_number = b.max_no
  JOIN bf_cum cp ON cp.user_id = pb.user_id AND cp.order_number = pb.last_no""",
                 "user_id, product_id, user_product_days_since_last_order")

# ------------------------------------------------------------------ users
P["u01"] = Part("""SELECT user_id, AVG(CAST(k AS DOUBLE)) AS user_avg_basket_size, STDDEV_SAMP(k) AS user_basket_size_stddev
  FROM (SELECT user_id, order_id, COUNT(*) AS k FROM bf_lines GROUP BY user_id, order_id) GROUP BY user_id""",
                "user_id, user_avg_basket_size, user_basket_size_stddev")
P["u02"] = Part("""SELECT user_id, COUNT(*) AS user_total_orders FROM bf_prior_orders GROUP BY user_id""",
                "user_id, user_total_orders")
P["u03"] = Part("""SELECT user_id, AVG(CAST(reordered AS INTEGER)) AS user_reorder_rate FROM bf_lines
  GROUP BY user_id""", "user_id, user_reorder_rate")
P["u04"] = Part("""SELECT user_id, COUNT(*) AS user_total_reorders FROM bf_lines WHERE reordered
  GROUP BY user_id""", "user_id, user_total_reorders")
P["timing"] = Part("""SELECT user_id,
      AVG(CAST(days_since_prior_order AS DOUBLE)) AS user_avg_days_between_orders,
      AVG(CASE WHEN order_hour_of_day BETWEEN 6 AND 11 THEN 1 ELSE 0 END) AS user_morning_order_rate,
      AVG(CASE WHEN order_hour_of_day BETWEEN 12 AND 17 THEN 1 ELSE 0 END) AS user_afternoon_order_rate,
      AVG(CASE WHEN order_hour_of_day BETWEEN 18 AND 20 THEN 1 ELSE 0 END) AS user_evening_order_rate,
      AVG(CASE WHEN order_hour_of_day BETWEEN 21 AND 23 OR order_hour_of_day BETWEEN 0 AND 5 THEN 1 ELSE 0 END)
        AS user_night_order_rate,
      AVG(CASE WHEN order_dow IN (0, 6) THEN 1 ELSE 0 END) AS user_weekend_order_rate,
      AVG(CASE WHEN order_dow NOT IN (0, 6) THEN 1 ELSE 0 END) AS user_weekday_order_rate,
      CAST(SUM(days_since_prior_order) AS DOUBLE) AS user_total_days_active,
      CAST(COUNT(*) - 1 AS DOUBLE) / NULLIF(CAST(SUM(days_since_prior_order) AS DOUBLE) / 7.0, 0)
        AS user_orders_per_week,
      CAST(COUNT(*) - 1 AS DOUBLE) / NULLIF(CAST(SUM(days_since_prior_order) AS DOUBLE), 0)
        AS user_order_frequency
  FROM bf_prior_orders GROUP BY user_id""",
                   "user_id, user_avg_days_between_orders, user_morning_order_rate, "
                   "user_afternoon_order_rate, user_evening_order_rate, user_night_order_rate, "
                   "user_weekend_order_rate, user_weekday_order_rate, user_total_days_active, "
                   "user_orders_per_week, user_order_frequency")
P["u05"] = Part("SELECT user_id, user_avg_days_between_orders FROM timing", "user_id, user_avg_days_between_orders",
                ("timing",))
P["u06"] = Part(_mode("user_id", "order_dow", "bf_prior_orders", "user_preferred_order_day"),
                "user_id, user_preferred_order_day")
P["hour_mode"] = Part(_mode("user_id", "order_hour_of_day", "bf_prior_orders", "user_preferred_order_hour"),
                      "user_id, user_preferred_order_hour")
P["u07"] = Part("""SELECT t.user_id, h.user_preferred_order_hour, t.user_morning_order_rate,
      t.user_afternoon_order_rate, t.user_evening_order_rate, t.user_night_order_rate
  FROM timing t JOIN hour_mode h ON h.user_id IS NOT DISTINCT FROM t.user_id""",
                "user_id, user_preferred_order_hour, user_morning_order_rate, user_afternoon_order_rate, "
                "user_evening_order_rate, user_night_order_rate", ("timing", "hour_mode"))
P["u08"] = Part("SELECT user_id, user_weekend_order_rate, user_weekday_order_rate FROM timing",
                "user_id, user_weekend_order_rate, user_weekday_order_rate", ("timing",))
P["u09"] = Part("SELECT user_id, user_total_days_active, user_orders_per_week FROM timing",
                "user_id, user_total_days_active, user_orders_per_week", ("timing",))
P["u10"] = Part("SELECT user_id, user_order_frequency FROM timing", "user_id, user_order_frequency", ("timing",))
P["u11"] = Part("""SELECT t.user_id, t.user_unique_department_count, t.user_unique_aisle_count,
      t.user_total_unique_products, r.user_reordered_department_count, r.user_reordered_aisle_count,
      COALESCE(r.user_reordered_unique_products, 0) AS user_reordered_unique_products,
      CAST(COALESCE(r.user_reordered_unique_products, 0) AS DOUBLE) / t.user_total_unique_products
        AS user_reorder_diversity_rate
  FROM (SELECT l.user_id, COUNT(DISTINCT c.department_id) AS user_unique_department_count,
               COUNT(DISTINCT c.aisle_id) AS user_unique_aisle_count,
               COUNT(DISTINCT l.product_id) AS user_total_unique_products
        FROM bf_lines l JOIN bf_products c ON c.product_id = l.product_id GROUP BY l.user_id) t
  LEFT JOIN (SELECT l.user_id, COUNT(DISTINCT c.department_id) AS user_reordered_department_count,
                    COUNT(DISTINCT c.aisle_id) AS user_reordered_aisle_count,
                    COUNT(DISTINCT l.product_id) AS user_reordered_unique_products
             FROM bf_lines l JOIN bf_products c ON c.product_id = l.product_id WHERE l.reordered
             GROUP BY l.user_id) r ON r.user_id = t.user_id""",
                "user_id, user_unique_department_count, user_unique_aisle_count, user_total_unique_products, "
                "user_reordered_department_count, user_reordered_aisle_count, user_reordered_unique_products, "
                "user_reorder_diversity_rate")
P["u12"] = Part("""SELECT l.user_id, COUNT(*) AS user_last_product_count
  FROM bf_lines l JOIN bf_user_bounds b ON b.user_id = l.user_id AND l.order_number = b.max_no
  GROUP BY l.user_id""", "user_id, user_last_product_count")
P["u13"] = Part("""SELECT user_id, COUNT(*) AS user_first_product_count FROM bf_lines WHERE order_number = 1
  GROUP BY user_id""", "user_id, user_first_product_count")
P["u14"] = Part("""SELECT f.user_id, COUNT(*) AS user_products_in_first_and_second
  FROM bf_first_pairs f JOIN bf_second_pairs s ON s.user_id = f.user_id AND s.product_id = f.product_id
  GROUP BY f.user_id""", "user_id, user_products_in_first_and_second")
P["u15"] = Part("""SELECT user_id, COUNT(*) AS user_products_in_first_and_last FROM both_first_last
  GROUP BY user_id""", "user_id, user_products_in_first_and_last", ("both_first_last",))

# ----------------------------------------------------------------- tables
_T1_DEPS = ("u01", "u02", "u03", "u04", "timing", "u06", "hour_mode", "u11", "u12", "u13", "u14",
            "both_first_last", "u15")
P["t1"] = Part("""SELECT s.user_id, u01.user_avg_basket_size, u01.user_basket_size_stddev, u02.user_total_orders,
      u03.user_reorder_rate, COALESCE(u04.user_total_reorders, 0) AS user_total_reorders,
      tm.user_avg_days_between_orders, u06.user_preferred_order_day, hour_mode.user_preferred_order_hour,
      tm.user_morning_order_rate, tm.user_afternoon_order_rate, tm.user_evening_order_rate,
      tm.user_night_order_rate, tm.user_weekend_order_rate, tm.user_weekday_order_rate,
      tm.user_total_days_active, tm.user_orders_per_week, tm.user_order_frequency,
      u11.user_unique_department_count, u11.user_unique_aisle_count, u11.user_total_unique_products,
      CASE WHEN u11.user_id IS NOT NULL THEN COALESCE(u11.user_reordered_department_count, 0) END
        AS user_reordered_department_count,
      CASE WHEN u11.user_id IS NOT NULL THEN COALESCE(u11.user_reordered_aisle_count, 0) END
        AS user_reordered_aisle_count,
      u11.user_reordered_unique_products, u11.user_reorder_diversity_rate,
      u12.user_last_product_count, u13.user_first_product_count,
      CASE WHEN u02.user_total_orders >= 2 THEN COALESCE(u14.user_products_in_first_and_second, 0) END
        AS user_products_in_first_and_second,
      COALESCE(u15.user_products_in_first_and_last, 0) AS user_products_in_first_and_last
  FROM (SELECT DISTINCT user_id FROM bf_prior_orders) s
  LEFT JOIN u01 ON u01.user_id = s.user_id LEFT JOIN u02 ON u02.user_id = s.user_id
  LEFT JOIN u03 ON u03.user_id = s.user_id LEFT JOIN u04 ON u04.user_id = s.user_id
  LEFT JOIN timing tm ON tm.user_id = s.user_id LEFT JOIN u06 ON u06.user_id = s.user_id
  LEFT JOIN hour_mode ON hour_mode.user_id = s.user_id LEFT JOIN u11 ON u11.user_id = s.user_id
  LEFT JOIN u12 ON u12.user_id = s.user_id LEFT JOIN u13 ON u13.user_id = s.user_id
  LEFT JOIN u14 ON u14.user_id = s.user_id LEFT JOIN u15 ON u15.user_id = s.user_id""", ", ".join(USER_FEATURE_COLUMNS), _T1_DEPS)

_T2_DEPS = ("p01", "p02", "p03", "p04", "p05", "p06", "p07", "pair_span", "p08", "p09", "p10", "p11", "p12",
            "p13", "p14", "p15", "p16", "p17", "p18", "p19", "p20", "first_cart_pairs", "p21", "p22", "p23",
            "p24", "p25")
_T2_JOINS = "\n".join(f"  LEFT JOIN {d} ON {d}.product_id = s.product_id"
                      for d in _T2_DEPS if d not in ("pair_span", "first_cart_pairs"))
P["t2"] = Part(f"""SELECT s.product_id, p01.product_reorder_rate, p02.product_order_count,
      p03.aisle_avg_product_order_count, p04.department_avg_product_order_count,
      COALESCE(p05.product_reorder_count, 0) AS product_reorder_count,
      COALESCE(p06.product_first_order_count, 0) AS product_first_order_count,
      p07.product_avg_days_between_orders, p08.product_avg_days_from_first_to_last_order,
      p08.product_order_frequency, p08.product_order_per_week, p09.product_preferred_order_day,
      p10.product_preferred_order_hour, p11.product_unique_user_count,
      COALESCE(p11.product_unique_reorder_user_count, 0) AS product_unique_reorder_user_count,
      p11.product_user_reorder_rate, p12.product_avg_cart_position,
      p13.product_avg_cart_position_relative_basket_size, p14.aisle_product_reorder_rate,
      p15.department_product_reorder_rate,
      COALESCE(p16.product_first_order_reorder_count, 0) AS product_first_order_reorder_count,
      COALESCE(p17.product_first_order_user_count, 0) AS product_first_order_user_count,
      COALESCE(p17.product_first_order_reorder_user_count, 0) AS product_first_order_reorder_user_count,
      p17.product_first_order_reorder_rate,
      COALESCE(p18.product_repeat_user_count, 0) AS product_repeat_user_count,
      COALESCE(p19.product_first_cart_first_order_count, 0) AS product_first_cart_first_order_count,
      p19.product_first_cart_first_order_pct, p20.product_first_cart_first_order_user_pct,
      COALESCE(p21.product_first_cart_first_order_user_count, 0) AS product_first_cart_first_order_user_count,
      COALESCE(p21.product_first_order_reorder_user_count, 0) AS product_first_order_first_cart_reorder_user_count,
      p21.product_first_order_reorder_rate AS product_first_order_first_cart_reorder_rate,
      p22.product_in_first_and_last,
      COALESCE(p23.product_last_orders_count, 0) AS product_last_orders_count,
      COALESCE(p24.product_users_in_first_and_last, 0) AS product_users_in_first_and_last,
      p25.department_product_popularity, p25.aisle_product_popularity
  FROM (SELECT DISTINCT product_id FROM bf_prior) s
{_T2_JOINS}""", ", ".join(PRODUCT_FEATURE_COLUMNS), _T2_DEPS)

_T3_DEPS = ("up01", "up02", "up04", "up06", "pair_span", "up03", "up05", "up07", "both_first_last", "up09",
            "up10", "up11", "up12", "up13", "up14")
_T3_JOINS = "\n".join(f"  LEFT JOIN {d} ON {d}.user_id = k.user_id AND {d}.product_id = k.product_id"
                      for d in _T3_DEPS if d not in ("pair_span", "both_first_last"))
P["t3"] = Part(f"""SELECT k.user_id, k.product_id, up01.user_product_avg_cart_position,
      up02.user_order_tempo AS user_product_order_tempo, up04.user_product_order_count,
      up04.user_product_order_share, up06.user_share_of_product_orders,
      CASE WHEN k.n >= 2 THEN up03.user_product_days_from_first_to_last END
        AS user_product_days_from_first_to_last,
      up03.user_product_avg_repurchase_interval, up05.user_product_order_rate_overall,
      up05.product_orders_since_first_purchase AS user_product_orders_since_first_purchase,
      up05.user_product_order_rate_since_first,
      CASE WHEN fp.user_id IS NOT NULL THEN COALESCE(up07.user_product_reorder_after_first_count, 0) END
        AS user_product_reorder_after_first_count,
      up09.product_in_first_and_last AS user_product_in_first_and_last,
      up10.user_product_orders_since_last, up11.user_product_in_last_order,
      COALESCE(up12.user_product_current_streak, 0) AS user_product_current_streak,
      up13.user_product_order_trend, up14.user_product_days_since_last_order
  FROM bf_pair_base k
  LEFT JOIN bf_first_pairs fp ON fp.user_id = k.user_id AND fp.product_id = k.product_id
{_T3_JOINS}""", ", ".join(USER_PRODUCT_FEATURE_COLUMNS), _T3_DEPS)

_ML_COLS = ", ".join(ML_DATASET_COLUMNS)
_ML_FROM = """FROM bf_orders o JOIN bf_prior l ON l.order_id = o.order_id
  JOIN (SELECT p.product_id, p.product_name, d.department_id, d.department, a.aisle_id, a.aisle
        FROM bf_products p JOIN bf_departments d ON d.department_id = p.department_id
        JOIN bf_aisles a ON a.aisle_id = p.aisle_id) c ON c.product_id = l.product_id"""
_ML_SELECT = """SELECT o.order_id, o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day,
      o.days_since_prior_order, c.product_id, c.product_name, c.department_id, c.department, c.aisle_id,
      c.aisle, l.add_to_cart_order, l.reordered"""
P["t4"] = Part(f"{_ML_SELECT}\n  {_ML_FROM}", _ML_COLS)
P["t5"] = Part(f"""{_ML_SELECT},
      CAST(CASE WHEN tt.label IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS target_variable
  {_ML_FROM}
  LEFT JOIN (SELECT o2.user_id, t.product_id, t.reordered AS label
             FROM bf_train t JOIN bf_orders o2 ON o2.order_id = t.order_id) tt
    ON tt.user_id = o.user_id AND tt.product_id = l.product_id""", _ML_COLS + ", target_variable")


def _t6_cols() -> str:
    keys = {"user_id", "product_id"}
    cols = [c for c in P["t4"].cols.split(", ")]
    for name in ("t1", "t2", "t3"):
        cols += [c for c in P[name].cols.split(", ") if c not in keys]
    return ", ".join(cols)


P["t6"] = Part("""SELECT * FROM t4 LEFT JOIN t1 USING (user_id) LEFT JOIN t2 USING (product_id)
  LEFT JOIN t3 USING (user_id, product_id)""", _t6_cols(), ("t4", "t1", "t2", "t3"))

# ----------------------------------------------------------------- checks
P["q_user"] = Part("""SELECT 'user_grain' AS "check",
      CAST(ABS((SELECT COUNT(*) FROM t1) - (SELECT COUNT(DISTINCT user_id) FROM bf_prior_orders)) AS BIGINT)
        AS bad_rows
  UNION ALL SELECT 'user_subset_counts', COUNT(*) FILTER (WHERE
      user_reordered_unique_products > user_total_unique_products
      OR user_reordered_department_count > user_unique_department_count
      OR user_reordered_aisle_count > user_unique_aisle_count
      OR user_reordered_unique_products > user_total_reorders
      OR user_products_in_first_and_second > user_first_product_count
      OR user_products_in_first_and_last > user_first_product_count
      OR user_products_in_first_and_last > user_last_product_count) FROM t1
  UNION ALL SELECT 'user_rates_in_unit_interval', COUNT(*) FILTER (WHERE
      user_reorder_rate NOT BETWEEN 0 AND 1 OR user_reorder_diversity_rate NOT BETWEEN 0 AND 1
      OR user_morning_order_rate NOT BETWEEN 0 AND 1 OR user_afternoon_order_rate NOT BETWEEN 0 AND 1
      OR user_evening_order_rate NOT BETWEEN 0 AND 1 OR user_night_order_rate NOT BETWEEN 0 AND 1
      OR user_weekend_order_rate NOT BETWEEN 0 AND 1 OR user_weekday_order_rate NOT BETWEEN 0 AND 1) FROM t1
  UNION ALL SELECT 'user_partition_rates_sum_to_one', COUNT(*) FILTER (WHERE
      ABS(user_morning_order_rate + user_afternoon_order_rate + user_evening_order_rate
          + user_night_order_rate - 1) > 1e-9
      OR ABS(user_weekend_order_rate + user_weekday_order_rate - 1) > 1e-9) FROM t1
  UNION ALL SELECT 'user_domain_bounds', COUNT(*) FILTER (WHERE
      user_total_orders < 1 OR user_avg_basket_size < 1 OR user_total_unique_products < 1
      OR user_preferred_order_day NOT BETWEEN 0 AND 6 OR user_preferred_order_hour NOT BETWEEN 0 AND 23
      OR user_avg_days_between_orders NOT BETWEEN 0 AND 30) FROM t1""", "check, bad_rows", ("t1",) + _T1_DEPS)
P["q_product"] = Part("""SELECT 'product_grain' AS "check",
      CAST(ABS((SELECT COUNT(*) FROM t2) - (SELECT COUNT(DISTINCT product_id) FROM bf_prior)) AS BIGINT)
        AS bad_rows
  UNION ALL SELECT 'product_subset_counts', COUNT(*) FILTER (WHERE
      product_reorder_count > product_order_count OR product_first_order_count > product_order_count
      OR product_unique_reorder_user_count > product_unique_user_count
      OR product_first_order_reorder_user_count > product_first_order_user_count
      OR product_first_order_first_cart_reorder_user_count > product_first_cart_first_order_user_count
      OR product_repeat_user_count > product_first_order_user_count
      OR product_users_in_first_and_last > product_unique_user_count
      OR product_first_cart_first_order_user_count > product_first_order_user_count) FROM t2
  UNION ALL SELECT 'product_rates_in_unit_interval', COUNT(*) FILTER (WHERE
      product_reorder_rate NOT BETWEEN 0 AND 1 OR product_user_reorder_rate NOT BETWEEN 0 AND 1
      OR product_first_order_reorder_rate NOT BETWEEN 0 AND 1
      OR product_first_order_first_cart_reorder_rate NOT BETWEEN 0 AND 1
      OR aisle_product_reorder_rate NOT BETWEEN 0 AND 1 OR department_product_reorder_rate NOT BETWEEN 0 AND 1)
    FROM t2
  UNION ALL SELECT 'product_pct_in_range', COUNT(*) FILTER (WHERE
      product_first_cart_first_order_pct NOT BETWEEN 0 AND 100
      OR product_first_cart_first_order_user_pct NOT BETWEEN 0 AND 100) FROM t2
  UNION ALL SELECT 'product_domain_bounds', COUNT(*) FILTER (WHERE
      product_avg_cart_position < 1 OR product_avg_cart_position_relative_basket_size NOT BETWEEN 0 AND 1
      OR product_in_first_and_last NOT IN (0, 1) OR product_preferred_order_day NOT BETWEEN 0 AND 6
      OR product_preferred_order_hour NOT BETWEEN 0 AND 23 OR department_product_popularity < 1
      OR aisle_product_popularity < 1) FROM t2""", "check, bad_rows", ("t2",) + _T2_DEPS)
P["q_user_product_checks"] = Part("""SELECT 'user_product_grain' AS "check",
      CAST(ABS((SELECT COUNT(*) FROM t3) - (SELECT COUNT(DISTINCT (user_id, product_id)) FROM t3)) AS BIGINT)
        AS bad_rows
  UNION ALL SELECT 'user_product_coverage', CAST(ABS((SELECT COUNT(*) FROM t3)
      - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, product_id FROM bf_lines))) AS BIGINT)
  UNION ALL SELECT 'user_product_user_count', CAST(ABS((SELECT COUNT(DISTINCT user_id) FROM t3)
      - (SELECT COUNT(*) FROM t1)) AS BIGINT)
  UNION ALL SELECT 'user_product_users_in_user_feature', COUNT(*)
    FROM (SELECT DISTINCT user_id FROM t3) x WHERE x.user_id NOT IN (SELECT user_id FROM t1)
  UNION ALL SELECT 'user_product_products_in_product_feature', COUNT(*)
    FROM (SELECT DISTINCT product_id FROM t3) x WHERE x.product_id NOT IN (SELECT product_id FROM t2)
  UNION ALL SELECT 'user_product_rates_in_open_unit', COUNT(*) FILTER (WHERE
      user_product_order_rate_overall <= 0 OR user_product_order_rate_overall > 1
      OR user_product_order_rate_since_first <= 0 OR user_product_order_rate_since_first > 1
      OR user_product_order_share <= 0 OR user_product_order_share > 1
      OR user_share_of_product_orders <= 0 OR user_share_of_product_orders > 1) FROM t3
  UNION ALL SELECT 'user_product_share_sums', COUNT(*) FROM (
      SELECT user_id, SUM(user_product_order_share) AS s FROM t3 GROUP BY user_id) WHERE ABS(s - 1) > 1e-9
  UNION ALL SELECT 'user_product_recency_consistency', COUNT(*) FILTER (WHERE
      (user_product_orders_since_last = 0) <> (user_product_in_last_order = 1)) FROM t3
  UNION ALL SELECT 'user_product_span_nulls', COUNT(*) FILTER (WHERE
      (user_product_order_count = 1 AND user_product_days_from_first_to_last IS NOT NULL)
      OR (user_product_order_count >= 2 AND user_product_days_from_first_to_last IS NULL)) FROM t3
  UNION ALL SELECT 'user_product_interval_times_count', COUNT(*) FILTER (WHERE user_product_order_count >= 2
      AND ABS(user_product_avg_repurchase_interval * (user_product_order_count - 1)
              - user_product_days_from_first_to_last) > 1e-9) FROM t3
  UNION ALL SELECT 'user_product_domain_bounds', COUNT(*) FILTER (WHERE
      user_product_order_count < 1 OR user_product_order_count > user_product_orders_since_first_purchase
      OR user_product_current_streak < 0 OR user_product_current_streak > user_product_order_count
      OR user_product_orders_since_last < 0 OR user_product_days_since_last_order < 0
      OR (user_product_reorder_after_first_count IS NOT NULL
          AND user_product_reorder_after_first_count > user_product_order_count - 1)
      OR user_product_in_first_and_last NOT IN (0, 1) OR user_product_in_last_order NOT IN (0, 1)) FROM t3
  UNION ALL SELECT 'user_product_first_last_implies_last', COUNT(*) FILTER (WHERE
      user_product_in_first_and_last = 1 AND user_product_in_last_order = 0) FROM t3""",
                           "check, bad_rows", ("t1", "t2", "t3") + _T1_DEPS + _T2_DEPS + _T3_DEPS)

P["q_user_product"] = Part("""SELECT "check", bad_rows FROM q_user_product_checks
  UNION ALL SELECT 'ok', COUNT(*) FILTER (WHERE bad_rows <> 0) FROM q_user_product_checks""", "check, bad_rows",
                           ("q_user_product_checks",))

_KEYS = (("aisles", "bf_aisles", ("aisle_id",)), ("departments", "bf_departments", ("department_id",)),
         ("orders", "bf_orders", ("order_id",)), ("products", "bf_products", ("product_id",)),
         ("order_products_prior", "bf_prior", ("order_id", "product_id")),
         ("order_products_train", "bf_train", ("order_id", "product_id")))
P["q_keys"] = Part("\n  UNION ALL ".join(
    f"""SELECT 'key_{name}' AS "check", CAST(COALESCE(SUM(CASE WHEN k > 1 THEN k ELSE 0 END), 0)
      + COALESCE(SUM(z), 0) AS BIGINT) AS bad_rows
    FROM (SELECT COUNT(*) AS k, COUNT(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in cols)}) AS z
          FROM {rel} GROUP BY {', '.join(cols)})""" for name, rel, cols in _KEYS) + """
  UNION ALL SELECT 'key_train_labels', CAST(COALESCE(SUM(CASE WHEN k > 1 THEN k ELSE 0 END), 0) AS BIGINT)
    FROM (SELECT COUNT(*) AS k FROM bf_train t JOIN bf_orders o ON o.order_id = t.order_id
          WHERE o.user_id IS NOT NULL GROUP BY o.user_id, t.product_id)""", "check, bad_rows")
_REFS = (("products", "bf_products", "aisle_id", "bf_aisles"), ("products", "bf_products", "department_id", "bf_departments"),
         ("order_products_prior", "bf_prior", "order_id", "bf_orders"),
         ("order_products_prior", "bf_prior", "product_id", "bf_products"),
         ("order_products_train", "bf_train", "order_id", "bf_orders"),
         ("order_products_train", "bf_train", "product_id", "bf_products"))
P["q_refs"] = Part("\n  UNION ALL ".join(
    f"""SELECT 'ref_{name}_{col}' AS "check", COUNT(*) AS bad_rows FROM {rel} x
    WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{col} = x.{col})"""
    for name, rel, col, parent in _REFS), "check, bad_rows")


# ------------------------------------------------------------- statements
def _ordered_deps(key: str) -> list[str]:
    seen: list[str] = []

    def visit(k: str) -> None:
        for d in P[k].deps:
            visit(d)
        if k not in seen:
            seen.append(k)
    visit(key)
    return seen


def statement(key: str, base: bool = True) -> str:
    """Full DuckDB statement for part ``key``.  Without ``base`` the six
    ``bf_`` input tables are expected to exist."""
    ctes = ",\n".join(f"{k} AS (\n{P[k].sql}\n)" for k in _ordered_deps(key))
    given = f"{MAPPING_CTES.strip()},\n" if base else ""
    cols = ", ".join(f"CAST(printf('%.11e', {c}) AS DOUBLE) AS {c}" if c in ORDER_DEPENDENT_COLUMNS
                     else ('"check"' if c == "check" else c) for c in P[key].columns())
    return f"WITH {given}{MODEL_CTES.strip()},\n{ctes}\nSELECT {cols} FROM {key}"


QUERY_PARTS = {
    "p01_product_reorder_rate": "p01", "p02_product_order_count": "p02",
    "p03_aisle_avg_product_order_count": "p03", "p04_department_avg_product_order_count": "p04",
    "p05_product_reorder_count": "p05", "p06_product_first_order_count": "p06",
    "p07_product_avg_days_between_orders": "p07", "p08_product_order_span_frequency": "p08",
    "p09_product_preferred_order_day": "p09", "p10_product_preferred_order_hour": "p10",
    "p11_product_user_reorder_rate": "p11", "p12_product_avg_cart_position": "p12",
    "p13_product_avg_cart_position_relative_basket_size": "p13", "p14_aisle_product_reorder_rate": "p14",
    "p15_department_product_reorder_rate": "p15", "p16_product_first_order_reorder_count": "p16",
    "p17_product_first_order_reorder_rate": "p17", "p18_product_repeat_user_count": "p18",
    "p19_product_first_cart_first_order": "p19", "p20_product_first_cart_first_order_users": "p20",
    "p21_product_first_cart_reorder_rate": "p21", "p22_product_in_first_and_last": "p22",
    "p23_product_last_orders_count": "p23", "p24_product_users_in_first_and_last": "p24",
    "p25_product_popularity_ranks": "p25",
    "up01_user_product_avg_cart_position": "up01", "up02_user_order_tempo": "up02",
    "up03_user_product_repurchase_interval": "up03", "up04_user_product_order_share": "up04",
    "up05_user_product_order_rates": "up05", "up06_user_share_of_product_orders": "up06",
    "up07_user_product_reorder_after_first_count": "up07", "up08_user_product_reorder_rate": "up08",
    "up09_user_product_in_first_and_last": "up09", "up10_user_product_orders_since_last": "up10",
    "up11_user_product_in_last_order": "up11", "up12_user_product_current_streak": "up12",
    "up13_user_product_order_trend": "up13", "up14_user_product_days_since_last_order": "up14",
    "u01_user_basket_size": "u01", "u02_user_total_orders": "u02", "u03_user_reorder_rate": "u03",
    "u04_user_total_reorders": "u04", "u05_user_avg_days_between_orders": "u05",
    "u06_user_preferred_order_day": "u06", "u07_user_order_hour_profile": "u07",
    "u08_user_weekend_weekday_rate": "u08", "u09_user_orders_per_week": "u09",
    "u10_user_order_frequency": "u10", "u11_user_reorder_diversity": "u11",
    "u12_user_last_product_count": "u12", "u13_user_first_product_count": "u13",
    "u14_user_products_in_first_and_second": "u14", "u15_user_products_in_first_and_last": "u15",
    "t1_user_feature": "t1", "t2_product_feature": "t2", "t3_user_product_feature": "t3",
    "t4_ml_dataset": "t4", "t5_target_variable": "t5", "t6_ml_dataset_final": "t6",
    "q_user_feature_checks": "q_user", "q_product_feature_checks": "q_product",
    "q_user_product_feature_checks": "q_user_product", "q_key_checks": "q_keys",
    "q_reference_checks": "q_refs",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(part) for name, part in QUERY_PARTS.items()}
