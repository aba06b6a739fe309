"""The fixture mapping in DuckDB SQL (same rules as
``basketflow.sources.fixtures``) plus helper relations of the basket model.

Canonical tables get a ``bf_`` prefix so they never shadow the star-schema
views (``orders`` is a view of the star schema).  ``MAPPING_CTES`` give the six
inputs (``BASE_TABLES``), ``MODEL_CTES`` what the statements derive from them.
"""

BASE_TABLES = {"aisles": "bf_aisles", "departments": "bf_departments", "orders": "bf_orders",
               "products": "bf_products", "order_products_prior": "bf_prior", "order_products_train": "bf_train"}

MAPPING_CTES = """
bf_aisles AS (
  SELECT CAST(n_nationkey AS INTEGER) AS aisle_id, n_name AS aisle FROM nation),
bf_departments AS (
  SELECT CAST(r_regionkey AS INTEGER) AS department_id, r_name AS department FROM region),
bf_products AS (
  SELECT s.s_suppkey AS product_id, s.s_name AS product_name,
         CAST(s.s_nationkey AS INTEGER) AS aisle_id, CAST(n.n_regionkey AS INTEGER) AS department_id
  FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey),
bf_basket AS (
  SELECT l_orderkey AS order_id, l_suppkey AS product_id, MIN(l_linenumber) AS first_line
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
bf_seq AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
         ROW_NUMBER() OVER w AS rn,
         LAG(CAST(o_orderdate AS DATE)) OVER w AS prev_date,
         COUNT(*) OVER (PARTITION BY o_custkey) AS n_orders
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)),
bf_orders AS (
  SELECT order_id, user_id,
         CASE WHEN rn = n_orders AND n_orders >= 2
              THEN CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'test' END
              ELSE 'prior' END AS eval_set,
         CAST(rn AS INTEGER) AS order_number,
         CAST(dayofweek(order_date) AS INTEGER) AS order_dow,
         CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', prev_date, order_date) AS DECIMAL(10,2)) AS days_since_prior_order
  FROM bf_seq),
bf_all_lines AS (
  SELECT b.order_id, b.product_id,
         CAST(ROW_NUMBER() OVER (PARTITION BY b.order_id ORDER BY b.first_line, b.product_id) AS INTEGER)
           AS add_to_cart_order,
         o.user_id, o.order_number, o.eval_set
  FROM bf_basket b JOIN bf_orders o ON o.order_id = b.order_id),
bf_flagged AS (
  SELECT order_id, product_id, add_to_cart_order, eval_set,
         order_number > MIN(order_number) OVER (PARTITION BY user_id, product_id) AS reordered
  FROM bf_all_lines),
bf_prior AS (
  SELECT order_id, product_id, add_to_cart_order, reordered FROM bf_flagged WHERE eval_set = 'prior'),
bf_train AS (
  SELECT order_id, product_id, add_to_cart_order, reordered FROM bf_flagged WHERE eval_set = 'train')
"""

MODEL_CTES = """
bf_lines AS (
  SELECT l.order_id, l.product_id, l.add_to_cart_order, l.reordered, o.user_id, o.eval_set,
         o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order
  FROM bf_prior l JOIN bf_orders o ON o.order_id = l.order_id),
bf_prior_orders AS (
  SELECT * FROM bf_orders WHERE eval_set = 'prior'),
bf_user_bounds AS (
  SELECT user_id, COUNT(*) AS total_orders, MAX(order_number) AS max_no
  FROM bf_prior_orders GROUP BY user_id),
bf_cum AS (
  SELECT user_id, order_number,
         SUM(COALESCE(days_since_prior_order, 0)) OVER (PARTITION BY user_id ORDER BY order_number) AS cum_days
  FROM bf_prior_orders),
bf_pair_base AS (
  SELECT user_id, product_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE reordered) AS n_re,
         MIN(order_number) AS first_no, MAX(order_number) AS last_no
  FROM bf_lines GROUP BY user_id, product_id),
bf_first_pairs AS (
  SELECT DISTINCT user_id, product_id FROM bf_lines WHERE order_number = 1),
bf_second_pairs AS (
  SELECT DISTINCT user_id, product_id FROM bf_lines WHERE order_number = 2),
bf_last_pairs AS (
  SELECT DISTINCT l.user_id, l.product_id
  FROM bf_lines l JOIN bf_user_bounds b ON b.user_id = l.user_id AND l.order_number = b.max_no)
"""
