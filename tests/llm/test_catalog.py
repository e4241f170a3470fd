import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as e
from sitegrain.llm.catalog import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def test_every_query_function_is_registered():
    found = {n for p in Path(e.__file__).parent.glob("sitegrain/llm/*.py") for n in re.findall(r"^def (p\d+_\w+)\(spark", p.read_text(), re.M)}
    assert found and set(QUERIES) == found and found <= set(e.queries())
    assert set(SQL) <= found and set(SQL) <= set(e.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
