"""Every registered query equals its DuckDB oracle (row count, columns,
order-insensitive value hash) on sf0.001.  The driver runs the same check at
sf0.01."""

import pytest

import __spark_entry__ as entry
from basketflow import registry
from basketflow.oracle import oracle_sql
from conftest import SF_SMALL
from oracle_compare import compare, duckdb_connection

QUERIES = registry.queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 65


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


def test_entry_registers_the_library_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 19
    assert df.count() == 1423
