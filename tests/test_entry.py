from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as e
from sitegrain.catalog import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return repr([plain(x) for x in v])
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def test_entry_gives_rows(spark):
    assert e.entry(spark).count() > 0


def test_names():
    assert set(SQL) <= set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = sorted(tuple(map(plain, r)) for r in frame.select(*columns).collect())
    if name in SQL:
        want = duck.sql(SQL[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
