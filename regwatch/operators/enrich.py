"""Filling of missing postcodes from a second source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, Params


def backfill_candidates(entities: DataFrame, as_of: Column, p: Params = DEFAULT) -> DataFrame:
    """Entities without a postcode of their own that were never looked up, or not lately; one that was filled from the second
    source is looked up again as well."""
    due = F.col("postcode_checked_at").isNull() | (F.datediff(as_of, "postcode_checked_at") >= p.backfill_days)
    return entities.where(F.col("post_code").isNull() & due)


def apply_backfill(entities: DataFrame, lookup: DataFrame, as_of: Column) -> DataFrame:
    """entities with postcode_live filled where the own postcode is absent; the check is stamped either way."""
    found = lookup.select("entity_id", F.col("post_code").alias("__found"), F.lit(True).alias("__checked"))
    rows = entities.join(found, "entity_id", "left")
    due = F.col("post_code").isNull() & F.col("__checked")
    filled = F.when(due, F.coalesce("__found", "postcode_live")).otherwise(F.col("postcode_live"))
    return rows.withColumn("postcode_live", filled).withColumn("postcode_checked_at", F.when(due, as_of).otherwise(F.col("postcode_checked_at"))).drop("__found", "__checked")


def postcode_source(bulk: Column, live: Column) -> Column:
    return F.when(bulk.isNotNull(), "bulk").when(live.isNotNull(), "live_api")


def backfill_runs(before: DataFrame, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per publisher the entities checked and resolved; and a row for each entity."""
    events = before.where("post_code is null").select("entity_id", "publisher").join(lookup.select("entity_id", "post_code"), "entity_id").select("publisher", "entity_id", F.col("post_code").isNotNull().alias("resolved"))
    runs = events.groupBy("publisher").agg(F.count("*").alias("checked"), F.count_if("resolved").alias("resolved")).withColumn("status", F.lit("ok"))
    return runs, events
