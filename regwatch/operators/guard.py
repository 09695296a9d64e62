"""Spike guard over runs (G1-G6): a size trigger, then a re-issue test on the events themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import overlap_key
from ..params import DEFAULT, Params
from .cdc import DATE


def trailing(column: str, rows: int) -> tuple[Column, Column]:
    """Median and number of the last ``rows`` earlier rows of a publisher."""
    w = Window.partitionBy("publisher").orderBy(DATE).rowsBetween(-rows, -1)
    return F.percentile(column, 0.5).over(w), F.count(column).over(w)


def trailing_median(runs: DataFrame, column: str, rows: int = DEFAULT.trailing_rows) -> DataFrame:
    median, n = trailing(column, rows)
    return runs.withColumn("trailing_median", median).withColumn("trailing_rows", n)


def spike_trigger(runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """runs (publisher, date, insert_count) with ``triggered`` and ``trigger_reason``; the first rule that fits decides."""
    n, median = F.col("insert_count"), F.col("trailing_median")
    large = n > p.spike_absolute
    quiet = (F.col("trailing_rows") < p.spike_history) | (n < p.spike_floor) | (median == 0)
    steep = n > p.spike_ratio * median
    reason = F.when(large, F.format_string("%d inserts exceed the absolute limit of " + str(p.spike_absolute), n)).when(
        ~quiet & steep, F.format_string("%d inserts exceed " + f"{p.spike_ratio:g}" + " times the median of %.1f", n, median)
    )
    return trailing_median(runs, "insert_count", p.trailing_rows).withColumn("triggered", F.coalesce(large | (~quiet & steep), F.lit(False))).withColumn("trigger_reason", reason)


def reissue_overlap(events: DataFrame, entities: DataFrame) -> DataFrame:
    """Share of each run's INSERTs that a DELETE of the same run matches by name and postcode keys; absent keys match
    each other. entities: publisher, entity_id, business_name, post_code."""
    keys = ["publisher", DATE, "__name", "__code"]
    known = entities.select("publisher", "entity_id", overlap_key(F.col("business_name")).alias("__name"), overlap_key(F.col("post_code")).alias("__code"))
    named = events.join(known, ["publisher", "entity_id"], "left").na.fill("", ["__name", "__code"])
    deletes = named.where("event_type = 'DELETE'").select(*keys).distinct().withColumn("__hit", F.lit(1))
    inserts = named.where("event_type = 'INSERT'").join(deletes, keys, "left")
    return inserts.groupBy("publisher", DATE).agg((F.count("__hit") / F.count("*")).alias("reissue_overlap"))


def run_verdict(triggered: DataFrame, overlap: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """quarantined or batch_publication of each triggered run; overlap is null elsewhere."""
    share = F.when(F.col("triggered"), F.coalesce("reissue_overlap", F.lit(0.0)))
    rows = triggered.join(overlap, ["publisher", DATE], "left").withColumn("reissue_overlap", share)
    rows = rows.withColumn("quarantined", F.col("triggered") & (F.col("reissue_overlap") >= p.reissue_overlap))
    text = F.when(F.col("triggered"), F.concat(F.col("trigger_reason"), F.lit("; "), F.when(F.col("quarantined"), "re-issue").otherwise("batch"), F.format_string(" (overlap %.2f)", F.col("reissue_overlap"))))
    return rows.withColumn("batch_publication", F.col("triggered") & ~F.col("quarantined")).withColumn("quarantine_reason", text)


def flag_events(events: DataFrame, verdict: DataFrame) -> DataFrame:
    """events with ``quarantined``, set on INSERTs alone."""
    rows = events.join(verdict.select("publisher", DATE, F.col("quarantined").alias("__q")), ["publisher", DATE], "left")
    return rows.withColumn("quarantined", F.coalesce(F.col("__q") & (F.col("event_type") == "INSERT"), F.lit(False))).drop("__q")


def reevaluate_quarantines(verdict: DataFrame, events: DataFrame, entities: DataFrame, p: Params = DEFAULT, apply: bool = True) -> DataFrame:
    """Quarantined runs judged again; applied to all rows, or only the rows that would change. The reason keeps what
    stands before its first semicolon, so doing it twice changes nothing."""
    fresh = reissue_overlap(events, entities).withColumnRenamed("reissue_overlap", "__share")
    rows = verdict.join(fresh, ["publisher", DATE], "left")
    again = F.col("quarantined")
    share = F.when(again, F.coalesce("__share", F.lit(0.0))).otherwise(F.col("reissue_overlap"))
    rows = rows.withColumn("__was", again).withColumn("reissue_overlap", share)
    keep = F.when(F.col("__was"), F.col("reissue_overlap") >= p.reissue_overlap).otherwise(F.col("quarantined"))
    base = F.split("quarantine_reason", ";")[0]
    text = F.when(F.col("__was"), F.concat(base, F.lit("; "), F.when(keep, "re-issue").otherwise("batch"), F.format_string(" (overlap %.2f)", F.col("reissue_overlap")))).otherwise(F.col("quarantine_reason"))
    rows = rows.withColumn("quarantine_reason", text).withColumn("batch_publication", F.col("batch_publication") | (F.col("__was") & ~keep)).withColumn("quarantined", keep)
    if not apply:
        rows = rows.where("__was and not quarantined")
    return rows.drop("__was", "__share")
