"""Monitoring of runs and state (Q1-Q16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from .cdc import DATE
from .guard import trailing


def new_records(diff_runs: DataFrame, since: Column, until: Column) -> DataFrame:
    rows = diff_runs.where(F.col(DATE).between(since, until) & ~F.col("quarantined"))
    return rows.groupBy("publisher").agg(F.sum("insert_count").alias("new_records"))


def classification_ratio(classifications: DataFrame, since: Column, until: Column) -> DataFrame:
    return classifications.where(F.col("insert_date").between(since, until)).groupBy("classification", "confidence").agg(F.count("*").alias("n"))


def extract_ages(publishers: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Days since each publisher's latest extract of a successful run; null if there is none."""
    last = runs.where((F.col("status") == "ok") & (F.col(DATE) <= as_of)).groupBy("publisher").agg(F.max("extract_date").alias("extract_date"))
    return publishers.select("publisher").join(last, "publisher", "left").withColumn("age_days", F.datediff(as_of, "extract_date"))


def parse_failure_rate(runs: DataFrame, date: Column) -> DataFrame:
    return runs.where(F.col(DATE) == date).agg(F.count_if(F.col("status") != "ok").alias("failed"), F.count("*").alias("attempted"))


def extract_cadence(runs: DataFrame) -> DataFrame:
    """Median gap between a publisher's successive distinct extract dates, and their number."""
    dates = runs.where("status = 'ok' and extract_date is not null").select("publisher", "extract_date").distinct()
    gap = F.datediff("extract_date", F.lag("extract_date").over(Window.partitionBy("publisher").orderBy("extract_date")))
    return dates.withColumn("gap", gap).groupBy("publisher").agg(F.percentile("gap", 0.5).alias("cadence_days"), F.count("*").alias("extracts"))


def staleness(publishers: DataFrame, runs: DataFrame, as_of: Column, p: Params = DEFAULT) -> DataFrame:
    """Publishers that are stale against their own cadence, or against a fixed age while they have too little history."""
    rows = extract_ages(publishers, runs, as_of).join(extract_cadence(runs), "publisher", "left")
    age = F.col("age_days")
    known = (age >= p.stale_least_days) & (age > p.stale_ratio * F.col("cadence_days"))
    return rows.withColumn("stale", F.coalesce(F.when(F.coalesce("extracts", F.lit(0)) < p.cadence_history, age > p.stale_fallback_days).otherwise(known), F.lit(False)))


def count_deviation(runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Runs whose item count is far from the median of the publisher's earlier ones, up or down."""
    median, n = trailing("item_count", p.trailing_rows)
    rows = runs.where("status = 'ok' and item_count is not null").select("publisher", DATE, "item_count", median.alias("median"), n.alias("history"))
    far = F.abs(F.col("item_count") - F.col("median")) / F.col("median")
    judged = (F.col("item_count") >= p.deviation_floor) & (F.col("history") >= p.deviation_history) & (F.col("median") != 0)
    return rows.withColumn("deviation", F.when(judged, F.round(far, 6))).withColumn("deviates", F.coalesce(F.col("deviation") > p.deviation_ratio, F.lit(False)))


def missing_publishers(publishers: DataFrame, runs: DataFrame, manifest: DataFrame, date: Column) -> DataFrame:
    """Publishers without a run on the date, with the failure that the manifest names."""
    rows = publishers.select("publisher").join(runs.where(F.col(DATE) == date), "publisher", "left_anti")
    return rows.join(manifest.select("publisher", "failure"), "publisher", "left").withColumn("reason", F.coalesce("failure", F.lit("no run"))).drop("failure")


def parse_alerts(runs: DataFrame, date: Column, p: Params = DEFAULT) -> DataFrame:
    ratio = F.col("skipped_records") / F.nullif("item_count", F.lit(0))
    alert = F.when(F.col("status") != "ok", "failed").when(ratio > p.skipped_ratio, "skipped")
    return runs.where(F.col(DATE) == date).withColumn("alert", alert).where("alert is not null").select("publisher", DATE, "alert")


def feed_run_check(company_runs: DataFrame, date: Column) -> DataFrame:
    """One row: whether the company feed ran on the date, and how it went."""
    status = company_runs.where(F.col(DATE) == date).agg(F.max("status").alias("status"))
    return status.select(date.alias(DATE), F.coalesce("status", F.lit("missing")).alias("status"), (F.coalesce("status", F.lit("missing")) != "ok").alias("alert"))


#: The fields by which a canary is known: its column, the column of what is expected, and the name in the list of mismatches.
CANARY_FIELDS = (("publisher", "publisher", "publisher"), ("business_name", "expected_name", "name"), ("business_id", "expected_business_id", "business_id"))


def canary_check(entities: DataFrame, canaries: DataFrame, fields: tuple = CANARY_FIELDS) -> DataFrame:
    """Canaries (entity_id, publisher, expected_name, expected_business_id) that are missing or differ in what should never
    change, with the list of what differs. The entity is looked up by its id alone, so one that moved is no missing one.
    An id that several publishers have is fine if one of them agrees in all."""
    there = entities.select("entity_id", *(F.col(c).alias(f"__{c}") for c, _, _ in fields), F.lit(True).alias("__there"))
    rows = canaries.join(there, "entity_id", "left")
    differs = lambda c, want, name: F.when(F.col("__there") & ~F.col(f"__{c}").eqNullSafe(F.col(want)), name)
    wrong = F.array_compact(F.array(F.when(F.col("__there").isNull(), "missing"), *(differs(*f) for f in fields)))
    least = rows.withColumn("mismatches", wrong).groupBy("entity_id", "publisher").agg(F.min(F.struct(F.size("mismatches").alias("n"), F.array_join("mismatches", ",").alias("mismatches"))).alias("x"))
    return least.where("x.n > 0").select("entity_id", "publisher", "x.mismatches")


def flagged_runs(diff_runs: DataFrame, publishers: DataFrame, date: Column) -> DataFrame:
    rows = diff_runs.where((F.col(DATE) == date) & (F.col("quarantined") | F.col("batch_publication"))).join(publishers.select("publisher"), "publisher")
    text = F.format_string("%d inserts, overlap %.0f%%", "insert_count", F.col("reissue_overlap") * 100)
    return rows.select("publisher", "insert_count", "quarantined", text.alias("text")).orderBy(F.desc("insert_count"), "publisher")


def collect_alerts(publishers: DataFrame, runs: DataFrame, diff_runs: DataFrame, company_runs: DataFrame, entities: DataFrame, canaries: DataFrame, manifest: DataFrame, date: Column, p: Params = DEFAULT) -> DataFrame:
    """All alerts of a date as (kind, subject, detail); staleness and deviation only of publishers that ran well."""
    fine = runs.where((F.col(DATE) == date) & (F.col("status") == "ok")).select("publisher")
    one = lambda kind, df, subject, detail: df.select(F.lit(kind).alias("kind"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail"))
    c = F.col
    parts = [
        one("stale", staleness(publishers, runs, date, p).where("stale").join(fine, "publisher", "left_semi"), c("publisher"), c("age_days")),
        one("deviation", count_deviation(runs, p).where(c("deviates") & (c(DATE) == date)).join(fine, "publisher", "left_semi"), c("publisher"), c("item_count")),
        one("missing", missing_publishers(publishers, runs, manifest, date), c("publisher"), c("reason")),
        one("parse", parse_alerts(runs, date, p), c("publisher"), c("alert")),
        one("company_feed", feed_run_check(company_runs, date).where("alert"), c("status"), c("status")),
        one("canary", canary_check(entities, canaries), c("entity_id"), c("mismatches")),
        one("flagged", flagged_runs(diff_runs, publishers, date), c("publisher"), c("text")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def weekly_totals(diff_runs: DataFrame, date: Column) -> DataFrame:
    """Inserts, updates and deletes of the seven days to the date, by publisher and in all (publisher null)."""
    rows = diff_runs.where(F.col(DATE).between(F.date_sub(date, 6), date))
    return rows.rollup("publisher").agg(*(F.sum(f"{k}_count").alias(f"{k}s") for k in ("insert", "update", "delete")))


def oldest_extracts(publishers: DataFrame, runs: DataFrame, date: Column, n: int = 15) -> DataFrame:
    """The n publishers of the oldest extracts, those never collected first."""
    return extract_ages(publishers, runs, date).orderBy(F.desc_nulls_first("age_days"), "publisher").limit(n)


def stage_completeness(expected: DataFrame, ledger: DataFrame, date: Column) -> DataFrame:
    """done, unfinished or never started, for each expected stage; ledger: stage, run_date, finished."""
    rows = ledger.where(F.col("run_date") == date).groupBy("stage").agg(F.bool_or(F.col("finished")).alias("__done"))
    state = F.when(F.col("__done"), "done").when(F.col("__done").isNotNull(), "unfinished").otherwise("never started")
    return expected.select("stage").join(rows, "stage", "left").select("stage", state.alias("state"))


def publication_cadence(diff_runs: DataFrame, since: Column, until: Column, burst: float = 0.8) -> DataFrame:
    """Per publisher the share of the window's inserts on its largest day, the days without any, and whether it bursts."""
    rows = diff_runs.where(F.col(DATE).between(since, until)).groupBy("publisher").agg(F.max("insert_count").alias("largest"), F.sum("insert_count").alias("total"), F.count_if(F.col("insert_count") == 0).alias("empty_days"))
    share = F.round(F.col("largest") / F.nullif("total", F.lit(0)), 6)
    return rows.withColumn("largest_share", share).withColumn("bursts", F.coalesce(share >= burst, F.lit(False)))


def fleet_cadence(cadence: DataFrame) -> DataFrame:
    return cadence.agg(F.percentile("largest_share", 0.5).alias("median_share"), F.avg(F.col("bursts").cast("double")).alias("bursting"))
