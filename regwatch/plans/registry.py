"""All registered queries, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of views: it is called with a loader ``v(name)`` and returns a DataFrame. The name is its
    own; sql is its twin, in which ``{view}`` stands for a view."""

    def register(f):
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(lambda x: view(spark, sf_dir, x))
        if sql:
            ORACLES[name] = with_views(sql)
        return f

    return register
