"""Queries of change capture and the spike guard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import cdc, guard, runs
from ..params import Params
from ..sources.scratch import scratch, settled
from .registry import query

#: Guard thresholds at which the test data triggers.
GUARD = Params(spike_absolute=30, spike_ratio=1.2, spike_history=2, spike_floor=3, reissue_overlap=0.1)


def marked(v, name="snapshots"):
    return cdc.row_fingerprint(v(name), ["rating"])


def events(v, **more):
    return cdc.change_events(marked(v), v("runs"), **more)


LOG = """log as (select *, lag(rating) over (partition by publisher, entity_id order by collection_date) as before,
                   row_number() over (partition by publisher, entity_id order by collection_date) as nth from {snapshots})"""
OK = """ok as (select publisher, collection_date, row_number() over (partition by publisher order by collection_date) as run_no,
                  lag(collection_date) over (partition by publisher order by collection_date) as previous_date,
                  lead(collection_date) over (partition by publisher order by collection_date) as next_date from {runs} where status = 'ok')"""


def events_sql(permanent: bool = False, log: str = LOG) -> str:
    gone = "after is null" if permanent else "(after is null or after <> run_no + 1)"
    return f"""{log}, {OK},
        seen as (select s.publisher, s.entity_id, ok.run_no, ok.next_date, lead(ok.run_no) over (partition by s.publisher, s.entity_id order by s.collection_date) as after
                 from {{snapshots}} s join ok on s.publisher = ok.publisher and s.collection_date = ok.collection_date),
        ev as (select l.publisher, l.collection_date, l.entity_id, case when nth = 1 then 'INSERT' else 'UPDATE' end as event_type
               from log l join ok on l.publisher = ok.publisher and l.collection_date = ok.collection_date
               where (nth = 1 and run_no > 1) or (nth > 1 and rating is distinct from before)
               union all select publisher, next_date, entity_id, 'DELETE' from seen where {gone} and next_date is not null)"""


DIFF = """dr as (select ok.publisher, ok.collection_date, ok.previous_date as previous_collection_date,
                    cast(coalesce(sum(case when event_type = 'INSERT' then 1 else 0 end), 0) as bigint) as insert_count,
                    cast(coalesce(sum(case when event_type = 'UPDATE' then 1 else 0 end), 0) as bigint) as update_count,
                    cast(coalesce(sum(case when event_type = 'DELETE' then 1 else 0 end), 0) as bigint) as delete_count
             from ok left join ev on ok.publisher = ev.publisher and ok.collection_date = ev.collection_date group by 1, 2, 3)"""


@query("select publisher, entity_id, cast(count(distinct rating) as bigint) as versions from {snapshots} group by 1, 2")
def c1_row_fingerprint(v):
    return marked(v).groupBy("publisher", "entity_id").agg(F.countDistinct("fingerprint").alias("versions"))


@query("select company_number, cast(count(distinct company_status) as bigint) as versions from {company_snapshots} group by 1")
def c2_company_fingerprint(v):
    rows = v("company_snapshots").withColumn("sic_codes", F.array(F.lit("2"), F.lit("1")))
    return cdc.company_fingerprint(rows, ["company_name", "company_status"]).groupBy("company_number").agg(F.countDistinct("fingerprint").alias("versions"))


@query(f"with {LOG} select publisher, entity_id, collection_date, rating, case when nth = 1 then 'first_seen' else 'field_changed' end as change_type from log where nth = 1 or rating is distinct from before")
def c3_change_log(v):
    return cdc.change_log(marked(v)).select("publisher", "entity_id", "collection_date", "rating", "change_type")


@query(f"""with {LOG} select publisher, entity_id, arg_max(rating, collection_date) as rating, min(collection_date) as first_seen_date, max(collection_date) as last_seen_date,
           max(case when nth = 1 or rating is distinct from before then collection_date end) as last_changed_date from log group by 1, 2""")
def c4_current_state(v):
    return cdc.current_state(marked(v)).select("publisher", "entity_id", "rating", "first_seen_date", "last_seen_date", "last_changed_date")


@query("""with l as (select *, lag(company_status) over (partition by company_number order by collection_date) as before from {company_snapshots}),
          c as (select * from l where before is null or before <> company_status),
          s as (select company_number, min(collection_date) as first_seen_date, max(collection_date) as last_seen_date from {company_snapshots} group by 1)
          select company_number, first_seen_date, last_seen_date, max(c.collection_date) as last_changed_date, arg_max(source, c.collection_date) as source, arg_max(company_status, c.collection_date) as company_status
          from c join s using (company_number) group by 1, 2, 3""")
def c5_company_current(v):
    rows = cdc.row_fingerprint(v("company_snapshots"), ["company_status"])
    return cdc.company_current(rows).select("company_number", "first_seen_date", "last_seen_date", "last_changed_date", "source", "company_status")


@query(f"""with {LOG} select publisher, collection_date, cast(sum(case when nth = 1 then 1 else 0 end) as bigint) as first_seen, cast(sum(case when nth > 1 and rating is distinct from before then 1 else 0 end) as bigint) as changed,
           cast(sum(case when nth > 1 and rating is not distinct from before then 1 else 0 end) as bigint) as unchanged from log group by 1, 2""")
def c6_ingest_stats(v):
    return cdc.ingest_stats(marked(v))


@query("""select publisher, collection_date, max(case when status = 'ok' then collection_date end) over (partition by publisher order by collection_date rows between unbounded preceding and 1 preceding) as previous_date from {runs}""")
def c7_previous_run(v):
    return cdc.previous_run(v("runs"))


@query(f"with {events_sql()} select * from ev")
def c8_change_events(v):
    return events(v)


@query(f"with {events_sql(True)} select * from ev")
def c8_change_events_permanent(v):
    return events(v, permanent_only=True)


@query(f"with {events_sql()} select * from ev")
def c8_change_events_repeated(v):
    """Every row stands twice in its run, and once more with the name in capitals, which no fingerprint reads."""
    rows = marked(v)
    return cdc.change_events(rows.unionByName(rows).unionByName(rows.withColumn("business_name", F.upper("business_name"))), v("runs"))


@query(f"with {events_sql()}, {DIFF} select * from dr")
def c9_diff_runs(v):
    return cdc.diff_runs(events(v), v("runs"))


@query(f"with {events_sql()} select * from ev")
def c10_replace_run_events(v):
    store = events(v)
    last = store.join(v("runs").agg(F.max("collection_date").alias("collection_date")), "collection_date", "left_semi")
    return cdc.replace_run_events(store, last)


@query(f"with {events_sql(True)}, {DIFF} select * from dr")
def c11_replay(v):
    return cdc.replay(marked(v), v("runs"))


@query("select publisher, collection_date from {runs} where status <> 'ok'")
def c12_incremental_runs(v):
    return cdc.incremental_runs(v("runs"), v("raw_snapshots"))


#: The last two days of the runs, one publisher of which cannot be read on the first of them.
LATE = "collection_date > (select max(collection_date) - 2 from {runs})"


@query(f"""with rn as (select publisher, collection_date, case when status = 'ok' and not (publisher = 'view' and collection_date = (select max(collection_date) - 1 from {{runs}})) then 'ok' else 'failed' end as status from {{runs}}),
        {LOG}, {OK.replace("from {runs} where", "from rn where")}, seen as (select s.publisher, s.entity_id, ok.run_no, ok.next_date, lead(ok.run_no) over (partition by s.publisher, s.entity_id order by s.collection_date) as after
                 from {{snapshots}} s join ok on s.publisher = ok.publisher and s.collection_date = ok.collection_date),
        lg as (select l.*, run_no, row_number() over (partition by l.publisher, entity_id order by l.collection_date) as no, lag(rating) over (partition by l.publisher, entity_id order by l.collection_date) as last from log l join ok on l.publisher = ok.publisher and l.collection_date = ok.collection_date),
        ev as (select publisher, collection_date, entity_id, case when no = 1 then 'INSERT' else 'UPDATE' end as event_type from lg where (no = 1 and run_no > 1) or (no > 1 and rating is distinct from last)
               union all select publisher, next_date, entity_id, 'DELETE' from seen where (after is null or after <> run_no + 1) and next_date is not null)
        select publisher, collection_date, entity_id, event_type from ev where {LATE} union all select publisher, collection_date, null, status from rn where {LATE} and publisher in (select publisher from {{snapshots}})""")
def c12_incremental_run(v):
    """The archive but its last two days fills a store; these days are then run twice, of which the second does nothing."""
    rows, ledger = marked(v), v("runs")
    spark, last = rows.sparkSession, v("runs").agg(F.max("collection_date")).first()[0]
    if last is None:
        return events(v)
    late = F.col("collection_date") > F.date_sub(F.lit(last), 2)
    store = scratch(spark)
    runs.bootstrap(spark, store, rows.where(~late), ledger.where(~late))
    unread = F.raise_error(F.lit("this file is broken")).cast("string")
    # What lands lies apart from the archive, so that a day's work does not read it; at most two runs of a publisher are asked for.
    fresh = settled(rows.where(late))
    failed = {(r.publisher, r.collection_date) for r in ledger.where(late & (F.col("status") != "ok")).select("publisher", "collection_date").collect()}

    def snapshot_of(asked):
        day = asked[0][1]
        part = fresh.where((F.col("collection_date") == F.lit(day)) & F.col("publisher").isin([p for p, _ in asked]))
        lost = [p for p, d in asked if (p, d) in failed]
        if lost:
            raise ValueError(f"no snapshot of {lost}")
        broken = [p for p, d in asked if p == "view" and d == last - dt.timedelta(days=1)]
        return part.withColumn("fingerprint", F.when(F.col("publisher").isin(broken), unread).otherwise(F.col("fingerprint"))) if broken else part

    landed = ledger.where(late).select("publisher", "collection_date")
    made = runs.incremental_run(spark, store, landed, snapshot_of)
    again = runs.incremental_run(spark, store, landed.join(made.where("status = 'ok'"), ["publisher", "collection_date"], "left_semi"), snapshot_of)
    out = spark.read.schema("entity_id long, event_type string, publisher string, collection_date date").parquet(f"{store}/events")
    status = made.unionByName(again).select("publisher", "collection_date", F.lit(None).cast("long").alias("entity_id"), F.col("status").alias("event_type"))
    return out.select(status.columns).unionByName(status)


@query("""select publisher, arg_max(item_count, collection_date) as item_count, arg_max(status, collection_date) as status, min(collection_date) as first_seen_date, max(collection_date) as last_seen_date from {runs} group by 1""")
def s7_publishers_scd(v):
    return cdc.publishers_scd(v("runs").select("publisher", "collection_date", "item_count", "status"))


@query("select publisher, collection_date, case when status = 'ok' then status else 'retried' end as status from {runs}")
def s8_upsert_runs(v):
    runs = v("runs").select("publisher", "collection_date", "status").withColumn("parsed_at", F.col("collection_date").cast("timestamp"))
    again = runs.where("status <> 'ok'").withColumn("status", F.lit("retried"))
    return cdc.upsert_runs(runs, again).drop("parsed_at")


MEDIAN = """tm as (select *, quantile_cont(insert_count, 0.5) over (partition by publisher order by collection_date rows between 28 preceding and 1 preceding) as m,
                   count(insert_count) over (partition by publisher order by collection_date rows between 28 preceding and 1 preceding) as n from dr)"""
TRIGGER = """tr as (select *, insert_count > 30 or (n >= 2 and insert_count >= 3 and m <> 0 and insert_count > 1.2 * m) as triggered from tm)"""
OVERLAP = """named as (select ev.*, coalesce(regexp_replace(lower(business_name), '[^a-z0-9]', '', 'g'), '') as nk, coalesce(lower(district), '') as pk
                      from ev left join (select distinct publisher, entity_id, business_name, district from {snapshots}) e on ev.publisher = e.publisher and ev.entity_id = e.entity_id),
             ov as (select i.publisher, i.collection_date, avg(case when d.nk is not null then 1.0 else 0.0 end) as reissue_overlap
                    from (select * from named where event_type = 'INSERT') i left join (select distinct publisher, collection_date, nk, pk from named where event_type = 'DELETE') d
                      on i.publisher = d.publisher and i.collection_date = d.collection_date and i.nk = d.nk and i.pk = d.pk group by 1, 2)"""
VERDICT = """ve as (select tr.publisher, tr.collection_date, insert_count, coalesce(triggered, false) as triggered, case when triggered then round(coalesce(reissue_overlap, 0), 6) end as reissue_overlap
                   from tr left join ov on tr.publisher = ov.publisher and tr.collection_date = ov.collection_date),
             vd as (select *, triggered and reissue_overlap >= 0.1 as quarantined, triggered and reissue_overlap < 0.1 as batch_publication from ve)"""
ALL = f"with {events_sql()}, {DIFF}, {MEDIAN}, {TRIGGER}, {OVERLAP}, {VERDICT}"


def known(v):
    return v("snapshots").select("publisher", "entity_id", "business_name", F.col("district").alias("post_code")).distinct()


def verdict(v, found=None):
    """Verdicts of all runs; events are written once, as they are read twice."""
    found = settled(events(v)) if found is None else found
    rows = guard.spike_trigger(cdc.diff_runs(found, v("runs")), GUARD)
    return guard.run_verdict(rows, guard.reissue_overlap(found, known(v)), GUARD)


def judged_runs(v):
    """diff_runs with verdicts, as later stages take them."""
    return verdict(v).select("publisher", "collection_date", "insert_count", "update_count", "delete_count", "quarantined", "batch_publication", "reissue_overlap")


@query(f"with {events_sql()}, {DIFF}, {MEDIAN} select publisher, collection_date, insert_count, m as trailing_median, cast(n as bigint) as trailing_rows from tm")
def g1_trailing_median(v):
    return guard.trailing_median(cdc.diff_runs(events(v), v("runs")), "insert_count").select("publisher", "collection_date", "insert_count", "trailing_median", "trailing_rows")


@query(f"with {events_sql()}, {DIFF}, {MEDIAN}, {TRIGGER} select publisher, collection_date, insert_count, coalesce(triggered, false) as triggered from tr")
def g2_spike_trigger(v):
    return guard.spike_trigger(cdc.diff_runs(events(v), v("runs")), GUARD).select("publisher", "collection_date", "insert_count", "triggered")


@query(f"with {events_sql()}, {OVERLAP} select publisher, collection_date, round(reissue_overlap, 6) as reissue_overlap from ov")
def g3_reissue_overlap(v):
    return guard.reissue_overlap(events(v), known(v)).withColumn("reissue_overlap", F.round("reissue_overlap", 6))


@query(f"{ALL} select publisher, collection_date, triggered, reissue_overlap, quarantined, batch_publication from vd")
def g4_run_verdict(v):
    return verdict(v).select("publisher", "collection_date", "triggered", F.round("reissue_overlap", 6).alias("reissue_overlap"), F.coalesce("quarantined", F.lit(False)).alias("quarantined"), F.coalesce("batch_publication", F.lit(False)).alias("batch_publication"))


@query(f"{ALL} select ev.*, coalesce(quarantined and event_type = 'INSERT', false) as quarantined from ev left join vd on ev.publisher = vd.publisher and ev.collection_date = vd.collection_date")
def g5_flag_events(v):
    found = settled(events(v))
    return guard.flag_events(found, verdict(v, found))


@query(f"{ALL} select publisher, collection_date, quarantined and reissue_overlap >= 0.3 as quarantined, batch_publication or (quarantined and reissue_overlap < 0.3) as batch_publication from vd")
def g6_reevaluate_quarantines(v):
    stricter, found = Params(reissue_overlap=0.3), settled(events(v))
    return guard.reevaluate_quarantines(verdict(v, found), found, known(v), stricter).select("publisher", "collection_date", F.coalesce("quarantined", F.lit(False)).alias("quarantined"), F.coalesce("batch_publication", F.lit(False)).alias("batch_publication"))
