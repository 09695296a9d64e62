"""Connected components of an edge table, by alternating large and small stars.

Defined results: edges with a null end and loops count for nothing; repeated edges count once; an empty table gives an
empty result; further columns are ignored. There are no ties: a component is named after its least node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (those above it, or it and those below) hang on the least of node and neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        out = both.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a < b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component (its least node) of all nodes with an edge; edges: a, b (long)."""
    now = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    mark = None
    for _ in range(rounds):
        now = cut(_star(_star(now, True), False))
        got = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if got == mark:
            break
        mark = got
    else:
        raise RuntimeError("the components have not settled")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
