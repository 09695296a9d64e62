"""Views over the test tables, and the registered queries with their SQL."""

from __future__ import annotations


def registered() -> tuple[dict, dict]:
    """Queries by name, and the SQL of those that have it."""
    from . import change_queries, feed_queries, io_queries, match_queries, quality_queries, text_queries  # noqa: F401
    from .registry import ORACLES, QUERIES

    return QUERIES, ORACLES
