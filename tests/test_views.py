"""Views are made once, and no table that grows goes through the driver."""

import pytest

from regwatch.plans import fixtures

FOLDER = "/root/testdata/sf0.001"
BEHIND = ("raw_snapshots", "runs", "snapshots", "entities", "companies", "inserts")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_behind_a_view_stay_kept(spark):
    spark.catalog.clearCache()
    for _ in range(2):
        fixtures.view(spark, FOLDER, "inserts").count()
        fixtures.view(spark, FOLDER, "feed")
        assert [x for x in BEHIND if not fixtures._views[next(k for k in fixtures._views if k[-2:] == (FOLDER, x))].storageLevel.useMemory] == []
        spark.catalog.clearCache()


@pytest.mark.parametrize("name", ["raw_snapshots", "inserts", "spells", "feed", "company_snapshots"])
def test_growing_tables_are_not_broadcast(spark, name):
    spark.catalog.clearCache()
    text = plan(fixtures.view(spark, FOLDER, name))
    spark.catalog.clearCache()
    for part in text.split("BroadcastExchange")[1:]:
        first = part.split("Location:")[1].split("]")[0] if "Location:" in part else ""
        assert not any(f"/{t}.parquet" in first for t in ("customer", "supplier", "part", "orders"))
