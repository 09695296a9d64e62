"""Delivery windows, gates and digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from . import feed
from .cdc import DATE


def complete_dates(runs: DataFrame, publishers: DataFrame, p: Params = DEFAULT) -> DataFrame:
    total = publishers.agg(F.count("*").alias("__total"))
    rows = runs.where("status = 'ok'").groupBy(DATE).agg(F.countDistinct("publisher").alias("__ok"))
    return rows.join(F.broadcast(total)).where(F.col("__ok") >= p.complete_share * F.col("__total")).select(DATE)


def last_complete_date(runs: DataFrame, publishers: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return complete_dates(runs, publishers, p).agg(F.max(DATE).alias("last_complete_date"))


def last_reportable_date(runs: DataFrame, publishers: DataFrame, diff_runs: DataFrame, events: DataFrame, classifications: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The latest of the last candidate dates that is complete, has its diffs, and whose good INSERTs are classified."""
    total = publishers.agg(F.count("*").alias("__total"))
    recent = complete_dates(runs, publishers, p).orderBy(F.desc(DATE)).limit(p.candidate_dates)
    diffed = diff_runs.groupBy(DATE).agg(F.countDistinct("publisher").alias("__n")).join(F.broadcast(total)).where(F.col("__n") >= p.complete_share * F.col("__total"))
    open_ = events.where("event_type = 'INSERT' and not quarantined").withColumn("insert_date", F.col(DATE)).join(classifications.select("entity_id", "insert_date"), ["entity_id", "insert_date"], "left_anti")
    fine = recent.join(diffed.select(DATE), DATE, "left_semi").join(open_.select(DATE).distinct(), DATE, "left_anti")
    return fine.agg(F.max(DATE).alias("last_reportable_date"))


def last_issue(issues: DataFrame) -> DataFrame:
    return issues.groupBy("subscriber_id").agg(F.max(F.struct("until", "issue_id")).alias("x")).select("subscriber_id", F.col("x.issue_id").alias("issue_id"), F.col("x.until").alias("until"))


def next_windows(subscribers: DataFrame, issues: DataFrame, until: DataFrame) -> DataFrame:
    """since, until and state (owed, already_current, no_date) of every active subscriber's next issue."""
    end = until.select(F.col(until.columns[0]).alias("__end"))
    rows = subscribers.where("active").join(last_issue(issues), "subscriber_id", "left").join(F.broadcast(end))
    since = F.date_add(F.coalesce("until", "started_date"), 1)
    state = F.when(F.col("__end").isNull(), "no_date").when(since > F.col("__end"), "already_current").otherwise("owed")
    return rows.select("subscriber_id", since.alias("since"), F.col("__end").alias("until"), state.alias("state"))


def issue_gaps(issues: DataFrame) -> DataFrame:
    """Issues that do not begin on the day after the one before ended."""
    before = F.lag("until").over(Window.partitionBy("subscriber_id").orderBy("until", "issue_id"))
    return issues.withColumn("expected_since", F.date_add(before, 1)).where("expected_since is not null and since <> expected_since").select("subscriber_id", "issue_id", "since", "expected_since")


def unsent_issues(issues: DataFrame) -> DataFrame:
    return issues.where("sent_date is null")


def subscriber_status(subscribers: DataFrame, issues: DataFrame) -> DataFrame:
    return subscribers.where("active").join(last_issue(issues), "subscriber_id", "left")


def cumulative_counts(rows: DataFrame, keys: list[str], date: str) -> DataFrame:
    """keys, date and n: how many rows of the keys there are up to each date that has any."""
    daily = rows.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(F.count("*").alias("__n"))
    return daily.select(*keys, date, F.sum("__n").over(Window.partitionBy(*keys).orderBy(date)).alias("n"))


def counts_until(counts: DataFrame, asked: DataFrame, keys: list[str], date: str) -> DataFrame:
    """asked (keys, date, and more) with n of the last date that is not after its own, 0 before the first: counts and
    questions stand in one order of dates, and the last count goes along, so no question meets more than its answer."""
    there = counts.withColumn("__kind", F.lit(0))
    both = there.unionByName(asked.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy(date, "__kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("n", F.coalesce(F.last("n", ignorenulls=True).over(so_far), F.lit(0))).where("__kind = 1").drop("__kind")


def report_for_all(subscribers: DataFrame, windows: DataFrame, territories: DataFrame, records: DataFrame) -> DataFrame:
    """For every subscriber with a window the number of records within it by what became of them (null: kept).
    territories: territory, publisher.

    A record is judged once for each audience. What a window holds is the difference of two running counts of a
    publisher, so subscribers never meet records.
    """
    owed = windows.where("state = 'owed'").join(subscribers.select("subscriber_id", "territory", "audience"), "subscriber_id")
    audience, kept = F.explode(F.array(*(F.lit(a) for a in feed.AUDIENCES))).alias("audience"), F.lit("")
    judged = records.select("*", audience).withColumn("reason_removed", F.coalesce(feed.removal_reason(F.col("audience"), F.lit(True)), kept))
    keys = ["publisher", "audience", "reason_removed"]
    counts = cumulative_counts(judged, keys, "first_seen_date")
    ends = F.explode(F.array(F.struct(F.col("until").alias("first_seen_date"), F.lit(1).alias("sign")), F.struct(F.date_sub("since", 1).alias("first_seen_date"), F.lit(-1).alias("sign")))).alias("end")
    reasons = F.explode(F.array(kept, *(F.lit(r) for r in feed.REASONS))).alias("reason_removed")
    asked = owed.join(territories, "territory").select("subscriber_id", "publisher", "audience", ends).select("subscriber_id", "publisher", "audience", "end.*", reasons)
    rows = counts_until(counts, asked, keys, "first_seen_date").groupBy("subscriber_id", "reason_removed").agg(F.sum(F.col("sign") * F.col("n")).alias("n"))
    return rows.where("n > 0").select("subscriber_id", F.nullif("reason_removed", kept).alias("reason_removed"), "n")


def demand_counts(rows: DataFrame, territories: DataFrame, until: Column) -> DataFrame:
    """Venues of each (territory, audience) in the last 7 and 28 days. rows: publisher, audience, first_seen_date. They are
    counted by publisher before those meet their territories."""
    inside = rows.where(F.col("first_seen_date").between(F.date_sub(until, 27), until)).groupBy("publisher", "audience")
    counts = inside.agg(F.count_if(F.col("first_seen_date") >= F.date_sub(until, 6)).alias("days_7"), F.count("*").alias("days_28"))
    return counts.join(territories, "publisher").groupBy("territory", "audience").agg(F.sum("days_7").alias("days_7"), F.sum("days_28").alias("days_28"))


def send_gate(batch: DataFrame, demand: DataFrame) -> DataFrame:
    """send, widen, hold or unresolved for each lead (lead_id, territory, wider, audience, stored_28, resolved)."""
    own = demand.select("territory", "audience", F.col("days_28").alias("__own"))
    wide = demand.select(F.col("territory").alias("wider"), "audience", F.col("days_28").alias("__wide"))
    rows = batch.join(own, ["territory", "audience"], "left").join(wide, ["wider", "audience"], "left").na.fill(0, ["__own", "__wide"])
    decision = F.when(~F.col("resolved"), "unresolved").when(F.col("__own") > 0, "send").when(F.col("wider").isNotNull() & (F.col("__wide") > 0), "widen").otherwise("hold")
    note = F.when(F.col("resolved") & (F.col("stored_28") != F.col("__own")), F.format_string("stored %d, now %d", "stored_28", "__own")).otherwise("")
    return rows.select("lead_id", "territory", "audience", decision.alias("decision"), F.col("__own").alias("days_28"), note.alias("note"))


def diverse_top_k(rows: DataFrame, k: int, group: list[str], council: str = "council") -> DataFrame:
    """k rows of each group, spread over councils: new openings, then takeovers of unknown predecessor, then named ones.
    If there is a named takeover, the first two classes share k - 1 places and named ones fill up; places that nobody
    takes go to whoever is next."""
    c = F.col
    kind = F.when(c("status") == "New opening", 0).when(F.coalesce(c("previously"), F.lit("")) == "", 1).otherwise(2)
    turn = F.row_number().over(Window.partitionBy(*group, "__kind", council).orderBy("venue", "entity_id"))
    place = F.row_number().over(Window.partitionBy(*group, "__kind").orderBy("__turn", council, "venue", "entity_id"))
    whole = Window.partitionBy(*group)
    # Nobody is picked behind k rows of one class, nor behind k of one class and council: before a shuffle each task keeps that many.
    rows = rows.withColumn("__kind", kind).withColumn("__turn", turn).where(c("__turn") <= k).withColumn("__place", place).where(c("__place") <= k)
    rows = rows.withColumn("__named", F.max((c("__kind") == 2).cast("int")).over(whole))
    plain = F.row_number().over(Window.partitionBy(*group, c("__kind") == 2).orderBy("__kind", "__place"))
    late = (c("__kind") < 2) & (plain > k - c("__named"))
    final = F.row_number().over(Window.partitionBy(*group).orderBy("__late", "__kind", "__place"))
    return rows.withColumn("__late", late).withColumn("pick", final).where(c("pick") <= k).drop("__kind", "__turn", "__place", "__named", "__late")


def split_counts(picks: DataFrame, group: list[str]) -> DataFrame:
    new = F.col("status") == "New opening"
    return picks.groupBy(*group).agg(F.count_if(new).alias("new"), F.count_if(~new).alias("takeover"), F.countDistinct("council").alias("councils"))
