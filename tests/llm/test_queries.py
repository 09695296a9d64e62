"""The queries that have SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from regwatch.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.execute(queries.ORACLES[name])
    assert columns == sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    rows = sorted(tuple(map(str, (r[k] for k in at))) for r in want.fetchall())
    assert sorted(tuple(map(str, r)) for r in got.select(columns).collect()) == rows
