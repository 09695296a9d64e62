"""Writers of feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.feed import FEED, short_feed


def write_feed(df: DataFrame, path: str) -> None:
    """The feed's columns, in their order, as CSV with a header."""
    df.select(*FEED).write.option("header", True).csv(path)


def write_json_feed(df: DataFrame, path: str) -> None:
    """The feed as JSON rows under short keys; null values are written."""
    short_feed(df).write.option("ignoreNullFields", False).json(path)


def write_json_ledger(df: DataFrame, path: str) -> None:
    """A ledger of ``short_ledger`` as JSON rows, candidates and labels nested; null values are written."""
    df.write.option("ignoreNullFields", False).json(path)
