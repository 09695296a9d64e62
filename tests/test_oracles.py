"""Every query that has SQL against DuckDB on the smallest tables; the optional text operators test themselves."""

import glob
import os

import duckdb
import pytest

from regwatch.plans import registered

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registered()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(x):
    if str(x) in ("None", "NaT", "nan", "<NA>"):
        return "~"
    return f"{x:.9g}" if isinstance(x, float) else str(x).replace(" 00:00:00", "")


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(plain, r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = rows(QUERIES[name](spark, FOLDER).toPandas())
    spark.catalog.clearCache()
    assert got == rows(duck.sql(ORACLES[name]).df())
