"""Queries of monitoring (Q1-Q16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..params import Params
from .change_queries import ALL, DIFF, events_sql, judged_runs
from .registry import query

c = F.col
DAY = "(select max(collection_date) - 2 from {runs})"
P = Params(deviation_ratio=0.1)


def day(v, back: int = 2):
    """A date near the end of the runs, as a literal: the query's argument."""
    last = v("runs").agg(F.max("collection_date")).first()[0]
    return F.date_sub(F.lit(last), back)


def manifest(v):
    return v("register_publishers").where("publisher = 'silent'").select("publisher", F.lit("timeout").alias("failure"))


def company_runs(v):
    return v("company_snapshots").groupBy("collection_date").agg(F.lit("ok").alias("status"))


def identified(v):
    return v("entities").withColumn("business_id", F.concat(F.lit("B"), c("entity_id").cast("string")))


def canaries(v):
    """Every third entity and one that is not there: of some the name, of some the publisher, of some the business id is expected to be another."""
    rows = v("entities").where("entity_id % 3 = 0")
    name = F.when(c("entity_id") % 2 == 0, c("business_name")).otherwise("wrong")
    publisher = F.when(c("entity_id") % 5 == 0, "elsewhere").otherwise(c("publisher"))
    number = F.when(c("entity_id") % 7 == 0, None).otherwise(F.concat(F.lit("B"), c("entity_id").cast("string")))
    lost = v("entities").agg((-F.max("entity_id") - 1).alias("entity_id")).select("entity_id", F.lit("nowhere").alias("publisher"), F.lit("x").alias("expected_name"), F.lit("y").alias("expected_business_id"))
    return rows.select("entity_id", publisher.alias("publisher"), name.alias("expected_name"), number.alias("expected_business_id")).unionByName(lost)


CANARIES = """(select entity_id, case when entity_id % 5 = 0 then 'elsewhere' else publisher end as publisher,
          concat_ws(',', case when entity_id % 5 = 0 then 'publisher' end, case when entity_id % 2 <> 0 and business_name is distinct from 'wrong' then 'name' end, case when entity_id % 7 = 0 then 'business_id' end) as mismatches
          from {entities} where entity_id % 3 = 0 and (entity_id % 5 = 0 or (entity_id % 2 <> 0 and business_name is distinct from 'wrong') or entity_id % 7 = 0) union all select -max(entity_id) - 1, 'nowhere', 'missing' from {entities})"""


@query(f"{ALL} select publisher, cast(sum(insert_count) as bigint) as new_records from vd where collection_date between {DAY} - 6 and {DAY} and not coalesce(quarantined, false) group by 1")
def q1_new_records(v):
    runs = judged_runs(v).withColumn("quarantined", F.coalesce("quarantined", F.lit(False)))
    return quality.new_records(runs, F.date_sub(day(v), 6), day(v))


@query("select classification, confidence, cast(count(*) as bigint) as n from {feed} where insert_date between date '1995-01-01' and date '1996-12-31' group by 1, 2")
def q2_classification_ratio(v):
    return quality.classification_ratio(v("feed"), F.lit("1995-01-01").cast("date"), F.lit("1996-12-31").cast("date"))


AGES = f"ages as (select p.publisher, max(r.extract_date) as extract_date, cast({DAY} - max(r.extract_date) as int) as age_days from {{register_publishers}} p left join {{runs}} r on p.publisher = r.publisher and r.status = 'ok' and r.collection_date <= {DAY} group by 1)"
CADENCE = """cad as (select publisher, quantile_cont(gap, 0.5) as cadence_days, cast(count(*) as bigint) as extracts from
             (select publisher, extract_date, cast(extract_date - lag(extract_date) over (partition by publisher order by extract_date) as int) as gap
              from (select distinct publisher, extract_date from {runs} where status = 'ok') x) y group by 1)"""


@query(f"with {AGES} select * from ages")
def q3_extract_ages(v):
    return quality.extract_ages(v("register_publishers"), v("runs"), day(v))


@query(f"select cast(sum(case when status <> 'ok' then 1 else 0 end) as bigint) as failed, cast(count(*) as bigint) as attempted from {{runs}} where collection_date = {DAY}")
def q4_parse_failure_rate(v):
    return quality.parse_failure_rate(v("runs"), day(v))


@query(f"with {CADENCE} select * from cad")
def q5_extract_cadence(v):
    return quality.extract_cadence(v("runs"))


@query(f"with {AGES}, {CADENCE} select publisher, age_days, coalesce(case when coalesce(extracts, 0) < 3 then age_days > 30 else age_days >= 1 and age_days > 0.5 * cadence_days end, false) as stale from ages left join cad using (publisher)")
def q6_staleness(v):
    p = Params(stale_least_days=1, stale_ratio=0.5)
    return quality.staleness(v("register_publishers"), v("runs"), day(v), p).select("publisher", "age_days", "stale")


DEVIATION = """dv as (select publisher, collection_date, item_count, case when item_count >= 10 and h >= 5 and m <> 0 then round(abs(item_count - m) / m, 6) end as deviation from
               (select *, quantile_cont(item_count, 0.5) over w as m, count(*) over w as h from {runs} where status = 'ok' window w as (partition by publisher order by collection_date rows between 28 preceding and 1 preceding)) x)"""


@query(f"with {DEVIATION} select *, coalesce(deviation > 0.1, false) as deviates from dv")
def q7_count_deviation(v):
    return quality.count_deviation(v("runs"), P).select("publisher", "collection_date", "item_count", "deviation", "deviates")


@query(f"select publisher, case when publisher = 'silent' then 'timeout' else 'no run' end as reason from {{register_publishers}} where publisher not in (select publisher from {{runs}} where collection_date = {DAY})")
def q8_missing_publishers(v):
    return quality.missing_publishers(v("register_publishers"), v("runs"), manifest(v), day(v))


@query(f"select publisher, collection_date, case when status <> 'ok' then 'failed' else 'skipped' end as alert from {{runs}} where collection_date = {DAY} and (status <> 'ok' or skipped_records * 1.0 / item_count > 0.01)")
def q9_parse_alerts(v):
    return quality.parse_alerts(v("runs"), day(v))


@query(f"select {DAY} as collection_date, not exists (select 1 from {{company_snapshots}} where collection_date = {DAY}) as alert")
def q10_feed_run_check(v):
    return quality.feed_run_check(company_runs(v), day(v)).select("collection_date", "alert")


@query(f"select * from {CANARIES} x")
def q11_canary_check(v):
    return quality.canary_check(identified(v), canaries(v))


@query(f"{ALL} select publisher, insert_count, quarantined, printf('%d inserts, overlap %.0f%%', insert_count, reissue_overlap * 100) as text from vd where collection_date = (select max(collection_date) from vd where triggered) and triggered")
def q12_flagged_runs(v):
    runs = judged_runs(v).na.fill(False, ["quarantined", "batch_publication"])
    last = runs.where("quarantined or batch_publication").agg(F.max("collection_date")).first()[0]
    return quality.flagged_runs(runs, v("register_publishers"), F.lit(last))


@query(f"""with {AGES}, {CADENCE}, {DEVIATION}, fine as (select publisher from {{runs}} where collection_date = {DAY} and status = 'ok'),
        fl as ({ALL} select publisher, insert_count, reissue_overlap, collection_date from vd where triggered)
        select 'stale' as kind, publisher as subject, cast(age_days as varchar) as detail from ages left join cad using (publisher) where publisher in (from fine) and coalesce(case when coalesce(extracts, 0) < 3 then age_days > 30 else age_days >= 10 and age_days > 3 * cadence_days end, false)
        union all select 'deviation', publisher, cast(item_count as varchar) from dv where publisher in (from fine) and collection_date = {DAY} and deviation > 0.1
        union all select 'missing', publisher, case when publisher = 'silent' then 'timeout' else 'no run' end from {{register_publishers}} where publisher not in (select publisher from {{runs}} where collection_date = {DAY})
        union all select 'parse', publisher, case when status <> 'ok' then 'failed' else 'skipped' end from {{runs}} where collection_date = {DAY} and (status <> 'ok' or skipped_records * 1.0 / item_count > 0.01)
        union all select 'company_feed', 'missing', 'missing' where not exists (select 1 from {{company_snapshots}} where collection_date = {DAY})
        union all select 'canary', cast(entity_id as varchar), mismatches from {CANARIES} cn
        union all select 'flagged', publisher, printf('%d inserts, overlap %.0f%%', insert_count, reissue_overlap * 100) from fl where collection_date = {DAY} and publisher in (select publisher from {{register_publishers}})""")
def q13_collect_alerts(v):
    runs = judged_runs(v).na.fill(False, ["quarantined", "batch_publication"])
    return quality.collect_alerts(v("register_publishers"), v("runs"), runs, company_runs(v), identified(v), canaries(v), manifest(v), day(v), P)


@query(f"with {events_sql()}, {DIFF}, w as (select * from dr where collection_date between {DAY} - 6 and {DAY}) select publisher, cast(sum(insert_count) as bigint) as inserts, cast(sum(update_count) as bigint) as updates, cast(sum(delete_count) as bigint) as deletes from w group by rollup (publisher)")
def q14_weekly_totals(v):
    return quality.weekly_totals(judged_runs(v), day(v))


@query(f"with {AGES} select * from ages order by age_days desc nulls first, publisher limit 3")
def q14_oldest_extracts(v):
    return quality.oldest_extracts(v("register_publishers"), v("runs"), day(v), 3)


@query(f"select p.publisher as stage, case when max(r.status) is null then 'never started' when bool_or(r.status = 'ok') then 'done' else 'unfinished' end as state from {{register_publishers}} p left join {{runs}} r on p.publisher = r.publisher and r.collection_date = {DAY} group by 1")
def q15_stage_completeness(v):
    ledger = v("runs").select(c("publisher").alias("stage"), c("collection_date").alias("run_date"), (c("status") == "ok").alias("finished"))
    return quality.stage_completeness(v("register_publishers").select(c("publisher").alias("stage")), ledger, day(v))


@query(f"with {events_sql()}, {DIFF} select publisher, max(insert_count) as largest, cast(sum(insert_count) as bigint) as total, cast(sum(case when insert_count = 0 then 1 else 0 end) as bigint) as empty_days, round(max(insert_count) * 1.0 / nullif(sum(insert_count), 0), 6) as largest_share, coalesce(round(max(insert_count) * 1.0 / nullif(sum(insert_count), 0), 6) >= 0.3, false) as bursts from dr where collection_date between {DAY} - 27 and {DAY} group by 1")
def q16_publication_cadence(v):
    return quality.publication_cadence(judged_runs(v), F.date_sub(day(v), 27), day(v), 0.3)
