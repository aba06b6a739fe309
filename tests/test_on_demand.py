"""A query stores what it reads, and nothing else."""

import datetime
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__
from basketflow.plans import facts
from basketflow.sources import fixtures

LOADED = {"basket", "lines", "orders", "order_products_prior"}


@pytest.fixture
def folder(tmp_path):
    orders = [(o, o % 5, datetime.datetime(2020, 1, 1 + o % 28)) for o in range(60)]
    lines = [(o, (o * 7 + n * 3) % 8, n) for o in range(60) for n in range(1, 4)]
    for name, columns, rows in (
            ("orders", ("o_orderkey", "o_custkey", "o_orderdate"), orders),
            ("lineitem", ("l_orderkey", "l_suppkey", "l_linenumber"), lines),
            ("supplier", ("s_suppkey", "s_name", "s_nationkey"), [(s, f"s{s}", s % 3) for s in range(8)]),
            ("nation", ("n_nationkey", "n_name", "n_regionkey"), [(n, f"n{n}", n % 2) for n in range(3)]),
            ("region", ("r_regionkey", "r_name"), [(r, f"r{r}") for r in range(2)])):
        table = pa.table(dict(zip(columns, map(list, zip(*rows)))))
        pq.write_table(table, str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def stored_for(spark, folder, query):
    """Names of the tables and facts that are stored once the query has run."""
    rows = queries()[query](spark, folder).collect()
    home = fixtures.star_schema_on_demand(spark, folder).home.removeprefix("file:")
    found = set(os.listdir(home))
    inner = set(os.listdir(f"{home}/_facts")) if "_facts" in found else set()
    return rows, found - {"_facts"}, inner


def queries():
    return __spark_entry__.queries()


def test_order_feature_reads_orders_alone(spark, folder):
    rows, tables, inner = stored_for(spark, folder, "u05_user_avg_days_between_orders")
    assert rows and tables == {"orders"} and not inner


def test_line_feature_needs_no_facts(spark, folder):
    rows, tables, inner = stored_for(spark, folder, "p06_product_first_order_count")
    assert rows and tables == LOADED and not inner


def test_pair_share_needs_sizes_alone(spark, folder):
    rows, tables, inner = stored_for(spark, folder, "up06_user_share_of_product_orders")
    assert rows and tables == LOADED and {n.split("-")[0] for n in inner} == {"pair_sizes", "heavy_products"}


def test_pair_recency_needs_no_runs(spark, folder):
    rows, tables, inner = stored_for(spark, folder, "up10_user_product_orders_since_last")
    assert rows and tables == LOADED and inner == {"timeline", "lines", "pair_counts"}


def test_user_table_needs_no_product_statistics(spark, folder):
    rows, _, inner = stored_for(spark, folder, "t1_user_feature")
    assert rows and inner == {"timeline", "lines", "baskets", "pair_counts"}


def test_a_pair_is_stored_once(spark, folder):
    """Checks: pairs whose run is plain are not joined and stored again."""
    rows, _, inner = stored_for(spark, folder, "q_user_product_feature_checks")
    assert rows and "pair_counts" in inner and "runs" in inner and not inner & {"pairs", "pair_sizes"}


def test_sizes_equal_counts(spark, folder):
    fx = facts.shared_facts(fixtures.load_star_schema(spark, folder))
    plain = sorted(map(str, fx.pair_counts.select("user_id", "product_id", "n").collect()))
    assert plain and plain == sorted(map(str, fx.pair_sizes.collect()))


def test_lines_are_dealt_by_pair_as_they_are(spark, folder):
    fx = facts.shared_facts(fixtures.load_star_schema(spark, folder))
    plan = facts.pairs(fx.lines)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange " in x]
    assert len(exchanges) == 1 and "REPARTITION" in exchanges[0]
    assert "Aggregate" not in plan[plan.index("Exchange "):]
