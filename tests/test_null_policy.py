"""NULL users, flags, days, hours and gaps: every query over hand-made tables
equals its DuckDB statement over the same tables.  (A product that only orders
without a user hold is left out: the model divides by its 0 buyers.)"""

from decimal import Decimal

import pytest

from basketflow import registry
from basketflow.oracle.prelude import BASE_TABLES
from basketflow.oracle.statements import QUERY_PARTS, statement
from basketflow.sources.readers import Sources
from basketflow.sources.schema import SCHEMAS
from oracle_compare import digest

ORDERS = [
    # order, user, set, number, dow, hour, gap
    (11, 1, "prior", 1, 0, 8, None), (12, 1, "prior", 2, 1, 8, 40), (13, 1, "prior", 3, 1, 13, 0),
    (14, 1, "prior", 4, None, 22, 3), (15, 1, "prior", 5, 6, 22, None), (16, 1, "train", 6, 3, 9, 5),
    (21, 2, "prior", 1, 4, 4, None), (22, 2, "prior", 2, 4, None, 9),  # 22 has no lines
    (31, 3, "prior", 1, 5, 12, None), (32, 3, "train", 2, 5, 12, 2),
    (41, None, "prior", 1, 2, 9, 20), (42, None, "prior", 1, 2, 9, None), (43, None, "prior", 2, 3, 10, 5),
    (44, None, "train", 3, 3, 10, 5), (51, 5, "prior", 1, None, None, None), (61, 6, "test", 1, 1, 1, None),
]
PRIOR = [
    (11, 100, 1, False), (11, 200, 2, None), (12, 100, 1, True), (12, 300, 2, None), (13, 100, 1, True),
    (14, 300, 1, True), (14, 200, 2, None), (15, 100, 1, True), (15, 300, 2, True),
    (21, 200, 1, None), (31, 300, 1, False), (31, 500, 2, False),
    (41, 100, 1, False), (41, 600, 2, None), (42, 100, 1, True), (42, 600, 2, False), (43, 100, 1, True), (31, 600, 3, None),
    (43, 300, 2, None), (51, 200, 1, False), (51, 700, None, False),
]
TRAIN = [(16, 100, 1, True), (16, 200, 2, None), (32, 300, 1, False), (44, 100, 1, True)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = {
        "aisles": [(1, "a1"), (2, "a2"), (3, None)],
        "departments": [(10, "d10"), (20, "d20")],
        "orders": [(*o[:6], None if o[6] is None else Decimal(o[6])) for o in ORDERS],
        # 500 has no aisle, 700 no department; 400 is never ordered.
        "products": [(100, "p100", 1, 10), (200, "p200", 1, 10), (300, "p300", 2, 20), (400, "p400", 3, 20),
                     (500, None, None, 20), (600, "p600", 2, 10), (700, "p700", 3, None)],
        "order_products_prior": PRIOR, "order_products_train": TRAIN,
    }
    return rows, Sources(**{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()})


@pytest.fixture(scope="module")
def con(tables):
    import duckdb
    con = duckdb.connect()
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "decimal(10,2)": "DECIMAL(10,2)"}
    for name, view in BASE_TABLES.items():
        cols = ", ".join(f"{f.name} {kinds[f.dataType.simpleString()]}" for f in SCHEMAS[name].fields)
        con.execute(f"CREATE TABLE {view} ({cols})")
        con.executemany(f"INSERT INTO {view} VALUES ({', '.join('?' * len(SCHEMAS[name].fields))})", tables[0][name])
    return con


@pytest.mark.parametrize("name", sorted(QUERY_PARTS))
def test_matches_statement(tables, con, name):
    df = registry.presented(registry.all_operators()[name](tables[1]))
    got = [tuple(r) for r in df.collect()]
    res = con.execute(statement(QUERY_PARTS[name], base=False))
    columns = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(columns)
    order = [df.columns.index(c) for c in columns]
    assert digest(columns, [tuple(r[i] for i in order) for r in got]) == digest(columns, want), (got, want)
