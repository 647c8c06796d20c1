"""Every registered query gives the rows of its reference SQL."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from bazaarlake import catalog

RAW = "region nation customer supplier part orders lineitem events".split()
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(r[i] for i in order) for r in data]
    return [columns[i] for i in order], sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    want = _sorted([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
