"""Hand-built micro cases with values worked out by hand.

User 1: five prior orders (gaps -, 7, 0, 3, 10) and a train order; product
100 is in orders 1,2,3,5 (streak broken at 4), 200 in 1,4, 300 in 2,4,5.
User 2: a single prior order.  User 3: one prior order, the other is train.
Product 400 is in the catalogue but never ordered.  Hour mode of user 1 is a
tie (8 and 22 twice each).
"""

from decimal import Decimal

import pytest

from basketflow.operators import product, user, user_product
from basketflow.plans import tables
from basketflow.sources.readers import Sources
from basketflow.sources.schema import SCHEMAS

ORDERS = [
    # order, user, set, number, dow, hour, gap
    (11, 1, "prior", 1, 0, 8, None), (12, 1, "prior", 2, 1, 8, 7), (13, 1, "prior", 3, 1, 13, 0),
    (14, 1, "prior", 4, 2, 22, 3), (15, 1, "prior", 5, 6, 22, 10), (16, 1, "train", 6, 3, 9, 5),
    (21, 2, "prior", 1, 4, 4, None),
    (31, 3, "prior", 1, 5, 12, None), (32, 3, "train", 2, 5, 12, 2),
]
PRIOR = [
    (11, 100, 1, False), (11, 200, 2, False), (12, 100, 1, True), (12, 300, 2, False), (13, 100, 1, True),
    (14, 300, 1, True), (14, 200, 2, True), (15, 100, 1, True), (15, 300, 2, True),
    (21, 200, 1, False), (31, 300, 1, False),
]
TRAIN = [(16, 100, 1, True), (32, 300, 1, True)]


@pytest.fixture(scope="module")
def micro(spark):
    def df(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])
    orders = [(o, u, s, n, d, h, None if g is None else Decimal(g)) for o, u, s, n, d, h, g in ORDERS]
    return Sources(
        aisles=df("aisles", [(1, "a1"), (2, "a2"), (3, "a3")]),
        departments=df("departments", [(10, "d10"), (20, "d20")]),
        orders=df("orders", orders),
        products=df("products", [(100, "p100", 1, 10), (200, "p200", 1, 10), (300, "p300", 2, 20),
                                 (400, "p400", 3, 20)]),
        order_products_prior=df("order_products_prior", PRIOR),
        order_products_train=df("order_products_train", TRAIN),
    )


def _by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in df.collect()}


def test_user_product_table(micro):
    t = _by(tables.user_product_feature(micro), "user_id", "product_id")
    assert len(t) == 5
    a = t[(1, 100)]
    assert a["user_product_order_count"] == 4
    assert a["user_product_days_from_first_to_last"] == 20.0
    assert a["user_product_avg_repurchase_interval"] == pytest.approx(20 / 3)
    assert a["user_product_current_streak"] == 1          # order 4 breaks the run
    assert a["user_product_order_trend"] == pytest.approx(2 / 3 - 2 / 2)
    assert a["user_product_order_tempo"] == pytest.approx(17 / 3)  # NULL gap skipped
    assert a["user_product_in_first_and_last"] == 1
    assert a["user_product_reorder_after_first_count"] == 3
    b = t[(1, 200)]
    assert b["user_product_current_streak"] == 0 and b["user_product_in_last_order"] == 0
    assert b["user_product_orders_since_last"] == 1
    assert b["user_product_days_since_last_order"] == 10.0
    c = t[(1, 300)]
    assert c["user_product_current_streak"] == 2
    assert c["user_product_days_from_first_to_last"] == 13.0
    assert c["user_product_reorder_after_first_count"] is None   # not in the first order
    assert c["user_product_order_trend"] == pytest.approx(2 / 3 - 1 / 2)  # odd max: order 3 is second half
    one = t[(2, 200)]
    assert one["user_product_days_from_first_to_last"] is None   # single purchase
    assert one["user_product_avg_repurchase_interval"] is None
    assert one["user_product_order_trend"] is None               # empty first half
    assert t[(3, 300)]["user_product_in_first_and_last"] == 1    # only other order is train


def test_stand_alone_variants_keep_their_null_policy(micro):
    span = _by(user_product.up03_user_product_repurchase_interval(micro), "user_id", "product_id")
    assert span[(2, 200)]["user_product_days_from_first_to_last"] == 0.0
    streak = _by(user_product.up12_user_product_current_streak(micro), "user_id", "product_id")
    assert set(streak) == {(1, 100), (1, 300), (2, 200), (3, 300)}
    assert streak[(1, 300)]["user_product_current_streak"] == 2


def test_user_table(micro):
    t = _by(tables.user_feature(micro), "user_id")
    u = t[1]
    assert u["user_total_orders"] == 5
    assert u["user_avg_basket_size"] == pytest.approx(1.8)
    assert u["user_basket_size_stddev"] == pytest.approx(0.2 ** 0.5)
    assert u["user_reorder_rate"] == pytest.approx(6 / 9)
    assert u["user_preferred_order_day"] == 1
    assert u["user_preferred_order_hour"] == 8                   # tie 8/22 -> smallest
    assert u["user_morning_order_rate"] == pytest.approx(0.4)
    assert u["user_night_order_rate"] == pytest.approx(0.4)
    assert u["user_weekend_order_rate"] == pytest.approx(0.4)
    assert u["user_avg_days_between_orders"] == pytest.approx(5.0)
    assert u["user_total_days_active"] == 20.0
    assert u["user_orders_per_week"] == pytest.approx(1.4)
    assert u["user_order_frequency"] == pytest.approx(0.2)
    assert (u["user_unique_department_count"], u["user_unique_aisle_count"], u["user_total_unique_products"]) \
        == (2, 2, 3)
    assert u["user_reorder_diversity_rate"] == 1.0
    assert (u["user_last_product_count"], u["user_first_product_count"]) == (2, 2)
    assert (u["user_products_in_first_and_second"], u["user_products_in_first_and_last"]) == (1, 1)
    assert t[2]["user_basket_size_stddev"] is None
    assert t[2]["user_orders_per_week"] is None
    assert t[2]["user_products_in_first_and_second"] is None     # fewer than two orders
    assert t[2]["user_reordered_department_count"] == 0
    assert t[3]["user_total_orders"] == 1


def test_user_stand_alone(micro):
    d = _by(user.u11_user_reorder_diversity(micro), "user_id")
    assert d[2]["user_reordered_department_count"] is None       # stand-alone: NULL, table: 0
    assert _by(user.u04_user_total_reorders(micro), "user_id").keys() == {1}


def test_product_table(micro):
    t = _by(tables.product_feature(micro), "product_id")
    assert set(t) == {100, 200, 300}                             # 400 never ordered
    p = t[100]
    assert p["product_order_count"] == 4
    assert p["product_reorder_rate"] == 0.75
    assert p["product_first_order_count"] == 1
    assert p["product_preferred_order_day"] == 1
    assert p["product_in_first_and_last"] == 1
    assert p["product_last_orders_count"] == 1
    assert p["product_users_in_first_and_last"] == 1
    assert p["aisle_product_reorder_rate"] == pytest.approx(4 / 7)
    assert p["department_product_popularity"] == 1
    assert t[200]["department_product_popularity"] == 2
    assert t[300]["product_first_order_reorder_rate"] == pytest.approx(0.0)


def test_catalogue_product_never_ordered(micro):
    rates = _by(product.p14_aisle_product_reorder_rate(micro), "product_id")
    assert rates[400]["aisle_product_reorder_rate"] is None      # its aisle has no lines
    assert len(rates) == 4
