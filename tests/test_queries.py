"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver tables")


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_small}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    return float(value) if isinstance(value, (int, float)) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(shown, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_small, duck, name):
    got = QUERIES[name](spark, sf_small)
    result = duck.execute(ORACLE[name])
    want = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(got.columns, got.collect()) == want
    assert want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_gives_rows(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 1000
