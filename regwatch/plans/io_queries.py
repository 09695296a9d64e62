"""Queries of readers, writers and streams (S1-S6, S9-S11, A1, R1-R7): the tables are landed as files of each form in
the shared scratch folder, and read back by the operator."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from ..operators import feed
from ..sources import readers, sinks
from ..sources.scratch import scratch, settled
from ..streaming import twins
from .change_queries import LOG, events_sql, marked
from .feed_queries import COLUMNS, shown
from .match_queries import LABELLED, labelled, merged
from .registry import query

c = F.col


def landed(df, form: str, **options) -> str:
    path = scratch(df.sparkSession)
    df.write.format(form).options(**options).save(path)
    return path


#: Records of a landed page or report, about.
PAGE = 1000


def page_of(df, key):
    """A page number by a hash of key; there are as many pages as the rows of df fill."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-df.count() // PAGE))))


def register_file(v) -> str:
    rows = v("feed").select(
        F.when(c("entity_id") % 50 != 0, c("entity_id").cast("string")).alias("FHRSID"), c("business_name").alias("BusinessName"), c("business_type").alias("BusinessType"), c("address_line_1").alias("AddressLine1"),
        c("post_code").alias("PostCode"), c("rating_value").alias("RatingValue"), c("first_seen_date").cast("string").alias("RatingDate"), F.struct((c("entity_id") % 20).cast("string").alias("Hygiene")).alias("Scores"),
    )
    return landed(rows, "xml", rowTag="EstablishmentDetail", rootTag="EstablishmentCollection")


@query("""select case when entity_id % 50 <> 0 then entity_id end as entity_id, trim(business_name) as business_name, address_line_1, post_code, rating_value, try_cast(rating_value as bigint) as rating_value_numeric, first_seen_date as rating_date, entity_id % 20 as hygiene_score from {feed}""")
def s1_read_register_xml(v):
    rows = readers.read_register_xml(v("feed").sparkSession, register_file(v))
    return rows.select("entity_id", "business_name", "address_line_1", "post_code", "rating_value", "rating_value_numeric", "rating_date", "hygiene_score")


@query("select extract_date, cast(item_count as bigint) as item_count, status as return_code from {runs}")
def s2_read_register_header(v):
    rows = v("runs").select(c("extract_date").cast("string").alias("ExtractDate"), c("item_count").cast("string").alias("ItemCount"), c("status").alias("ReturnCode"))
    return readers.read_register_header(rows.sparkSession, landed(rows, "xml", rowTag="Header", rootTag="Files")).drop("file")


@query("select cast(sum(case when entity_id % 50 = 0 then 1 else 0 end) as bigint) as no_key, cast(sum(case when entity_id % 50 <> 0 then 1 else 0 end) as bigint) as good from {feed}")
def s3_split_bad_records(v):
    good, skipped = readers.split_bad_records(readers.read_register_xml(v("feed").sparkSession, register_file(v)))
    return skipped.agg(F.sum("no_key").alias("no_key")).join(F.broadcast(good.agg(F.count("*").alias("good"))))


@query("select cast(publisher as bigint) as id, publisher, name, region_name from {publishers} where publisher <> '0' and cast(publisher as int) % 6 <> 5")
def s4_read_publisher_index(v):
    k = c("publisher").cast("int")
    rows = v("publishers").select(c("publisher").alias("LocalAuthorityId"), c("publisher").alias("LocalAuthorityIdCode"), c("name").alias("Name"), c("region_name").alias("RegionName"), F.when(k % 6 != 5, F.concat(F.lit("file"), c("publisher"))).alias("FileName"))
    return readers.read_publisher_index(rows.sparkSession, landed(rows, "xml", rowTag="WebLocalAuthorityAPI", rootTag="Index")).select("id", "publisher", "name", "region_name")


def company_pages(v):
    k = c("company_number").cast("long")
    item = F.struct(F.when(k % 13 != 0, c("company_number")).alias("company_number"), "company_name", c("date_of_creation").cast("string").alias("date_of_creation"), F.struct("address_line_1", c("postcode").alias("postal_code")).alias("registered_office_address"), F.array(F.lit("56101"), F.lit("10710")).alias("sic_codes"))
    return v("companies").groupBy(page_of(v("companies"), k).alias("page")).agg(F.count("*").alias("hits"), F.collect_list(item).alias("items")).drop("page")


@query("select company_number, company_name, address_line_1, postcode as postal_code, date_of_creation, '10710,56101' as codes from {companies} where cast(company_number as bigint) % 13 <> 0")
def s5_read_company_pages(v):
    pages = company_pages(v)
    good, _ = readers.read_company_pages(pages.sparkSession, landed(pages, "json", maxRecordsPerFile=1), "test")
    return good.select("company_number", "company_name", "address_line_1", "postal_code", "date_of_creation", F.array_join("sic_codes", ",").alias("codes"))


def lookup_pages(v):
    k = c("entity_id")
    item = F.struct(k.cast("string").alias("FHRSID"), F.coalesce("post_code", F.lit("")).alias("PostCode"))
    return v("feed").groupBy(page_of(v("feed"), k).alias("page")).agg(F.collect_list(item).alias("establishments")).select("establishments", F.struct(c("page").alias("pageNumber")).alias("meta"))


@query("select entity_id, post_code from {feed}")
def s6_read_lookup_pages(v):
    pages = lookup_pages(v)
    return readers.read_lookup_pages(pages.sparkSession, landed(pages, "json", maxRecordsPerFile=1))


@query(f"select {', '.join(f'nullif({x}, {chr(39) * 2}) as {x}' for x in COLUMNS)} from (select {', '.join(shown(x, x) for x in COLUMNS)} from {{feed}}) x")
def s9_write_feed(v):
    rows = feed.build_feed(v("feed"), F.lit("1998-01-31").cast("date"))
    path = scratch(rows.sparkSession)
    sinks.write_feed(rows, path)
    return rows.sparkSession.read.option("header", True).csv(path, schema=", ".join(f"{x} string" for x in feed.FEED))


FLAGS = {"ms": "coalesce(evidence_company_number, '') <> ''", "bp": "batch_publication", "id": "entity_id"}


@query(f"select {', '.join(f'{FLAGS[k]} as {k}' if k in FLAGS else shown(x, k) for k, x in feed.SHORT.items())} from {{feed}}")
def s10_write_json_feed(v):
    rows = feed.build_feed(v("feed"), F.lit("1998-01-31").cast("date"))
    path = scratch(rows.sparkSession)
    sinks.write_json_feed(rows, path)
    return rows.sparkSession.read.schema(", ".join(f"{k} {'long' if k == 'id' else 'boolean' if k in FLAGS else 'string'}" for k in feed.SHORT)).json(path)


LEDGER = """id long, n string, a string, pc string, au string, fs date, cl string, cf string, rs string, ri boolean, pm boolean, cn string,
    cand array<struct<n: string, no: string, s: double, st: string, hd: boolean, am: boolean, dc: date>>, gt struct<rmf: string, rcn: string, notes: string>"""


@query(f"""with {LABELLED}, tp as (select entity_id, insert_date, list({{'n': company_name, 'no': company_number, 's': name_similarity_score, 'st': case match_strategy when 'national' then 'n' when 'operator-prefix' then 'op' else 'd' end,
                'hd': coalesce(is_high_density_address, false), 'am': coalesce(address_matches_establishment, false), 'dc': date_of_creation}} order by rank) as cs from mg where rank <= 3 group by 1, 2)
        select lb.entity_id as id, e.business_name as n, e.address_line_1 as a, e.post_code as pc, coalesce(p.name, lb.publisher) as au, e.first_seen_date as fs, classification as cl, confidence as cf, reason as rs, recently_incorporated as ri, predecessor_name_match as pm,
               evidence_company_number as cn, coalesce(cast(to_json(cs) as varchar), '[]') as cand, case when lb.entity_id % 4 = 0 then 'y / 0000' || cast(lb.entity_id as varchar) || ' / ' end as gt
        from lb join {{entities}} e on e.entity_id = lb.entity_id left join {{register_publishers}} p on p.publisher = lb.publisher left join tp on tp.entity_id = lb.entity_id and tp.insert_date = lb.insert_date""")
def s10_write_json_ledger(v):
    candidates = settled(merged(v))
    entities = v("entities").withColumn("postcode_live", F.lit("unread"))
    hand = v("entities").where("entity_id % 4 = 0").select("entity_id", F.lit(" y").alias("real_match"), F.concat(F.lit("0000"), c("entity_id").cast("string"), F.lit(" ")).alias("real_company"), F.lit(None).cast("string").alias("notes"))
    rows = feed.short_ledger(labelled(v, candidates), entities, v("register_publishers"), candidates, hand)
    path = scratch(rows.sparkSession)
    sinks.write_json_ledger(rows, path)
    back = rows.sparkSession.read.schema(LEDGER).json(path)
    return back.withColumns({"cand": F.to_json("cand"), "gt": F.when(c("gt").isNotNull(), F.concat_ws(" / ", "gt.rmf", "gt.rcn", "gt.notes"))})


@query("select entity_id, coalesce(evidence_company_number, '') as true_company, evidence_company_number is null as blank from {feed}")
def s11_read_ground_truth(v):
    rows = v("feed").select(c("entity_id").cast("string").alias("entity_id"), F.coalesce("evidence_company_number", F.lit(" ")).alias("true_company"), F.lit("x").alias("note"))
    return readers.read_ground_truth(rows.sparkSession, landed(rows, "csv", header=True)).select("entity_id", "true_company", "blank")


def auth_reports(v):
    """Reports of a reporter and day; as many of each as the largest day of one fills."""
    seconds = lambda x: F.unix_timestamp(c(x).cast("timestamp"))
    record = F.struct(F.struct("source_ip", "count", F.struct("disposition", "dkim", "spf").alias("policy_evaluated")).alias("row"), F.struct("header_from").alias("identifiers"), F.struct(F.struct(F.lit("r").alias("domain"), c("spf").alias("result")).alias("spf")).alias("auth_results"))
    day = ["reporter", "begin_", "end_"]
    most = v("auth_records").groupBy(*day).count().agg(F.max("count")).first()[0] or 0
    # Equal records are dealt out too: the number of a row stands in the hash.
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, -(-most // PAGE)))).alias("part")
    rows = v("auth_records").select("*", part).groupBy(*day, "part").agg(F.collect_list(record).alias("record"))
    return rows.select(F.struct(c("reporter").alias("org_name"), F.struct(seconds("begin_").alias("begin"), seconds("end_").alias("end")).alias("date_range")).alias("report_metadata"), F.struct(F.lit("none").alias("p")).alias("policy_published"), "record")


def put(spark, path: str, content: bytes) -> None:
    """A small file in the shared folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(content))
    out.close()


def zipped(name: str, content: bytes) -> bytes:
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as archive:
        archive.writestr(name, content)
    return made.getvalue()


@query("""select source_ip, cast(sum(count) as bigint) as messages, min(begin_) as begin_, cast(count(*) as bigint) as records, string_agg(distinct coalesce(spf, '?'), ',' order by coalesce(spf, '?')) as spf, 0 as broken, min('r=' || coalesce(spf, '?')) as checked from {auth_records} group by 1
          union all select 'all of them', cast(sum(count) as bigint), min(begin_), 1, 'pass', 0, 'r=pass' from {auth_records}
          union all select 'unreadable', null, null, 0, null, 2, null""")
def a1_read_auth_reports(v):
    """The records as gzip reports, their sum as a report in a zip archive, and two files that cannot be read."""
    rows = auth_reports(v)
    spark = rows.sparkSession
    path = landed(rows, "xml", rowTag="feedback", rootTag="reports", compression="gzip", maxRecordsPerFile=10)
    n, first = v("auth_records").agg(F.sum("count"), F.unix_timestamp(F.min("begin_").cast("timestamp"))).first()
    whole = f"<feedback><report_metadata><org_name>sums</org_name><date_range><begin>{first}</begin></date_range></report_metadata><record><row><source_ip>all of them</source_ip><count>{n}</count><policy_evaluated><spf>pass</spf></policy_evaluated></row><auth_results><spf><domain>r</domain><result>pass</result></spf></auth_results></record></feedback>"
    put(spark, f"{path}/sum.zip", zipped("sum.xml", whole.encode()))
    put(spark, f"{path}/broken.xml", whole.encode()[:-9])
    put(spark, f"{path}/broken.gz", whole.encode())
    out = readers.read_auth_reports(spark, path)
    found = F.get("auth_spf", F.lit(0))
    sums = readers.auth_records(out).groupBy("source_ip").agg(
        F.sum("count").alias("messages"), F.min("begin").alias("begin_"), F.count("*").alias("records"), F.array_join(F.array_sort(F.collect_set(F.coalesce("spf", F.lit("?")))), ",").alias("spf"), F.lit(0).alias("broken"),
        F.min(F.concat(found["domain"], F.lit("="), F.coalesce(found["result"], F.lit("?")))).alias("checked"),
    )
    lost = readers.auth_failures(out).agg(F.lit("unreadable").alias("source_ip"), F.lit(0).cast("long").alias("records"), F.count("*").cast("int").alias("broken"))
    return sums.unionByName(lost, allowMissingColumns=True)


def by_day(v, df) -> tuple[str, object]:
    """df as one file of a date each, in their order, and its schema."""
    path = scratch(df.sparkSession)
    df.repartitionByRange(8, "collection_date").sortWithinPartitions("collection_date").write.parquet(path)
    return path, df.schema


def streamed(v, df):
    path, schema = by_day(v, df)
    return twins.files(df.sparkSession, path, schema), scratch(df.sparkSession)


def logged(v):
    """Marked snapshots as a stream, with a row that closes them."""
    rows = v("raw_snapshots").agg(F.max("collection_date")).first()[0]
    marks = marked(v).select("publisher", "entity_id", "collection_date", "fingerprint")
    return streamed(v, marks.unionByName(twins.closing(marks.schema, marks.sparkSession, rows)) if rows else marks)


@query(f"with {LOG} select publisher, entity_id, collection_date, case when nth = 1 then 'first_seen' else 'field_changed' end as change_type from log where nth = 1 or rating is distinct from before")
def r1_stream_change_log(v):
    stream, out = logged(v)
    twins.stream_change_log(stream, out, f"{out}/checkpoint")
    return v("runs").sparkSession.read.parquet(f"{out}/log").select("publisher", "entity_id", "collection_date", "change_type")


@query(f"with {events_sql()} select * from ev")
def r2_stream_change_events(v):
    stream, out = logged(v)
    twins.stream_change_events(stream, v("runs"), out, f"{out}/checkpoint")
    return twins.read_change_events(v("runs").sparkSession, v("runs"), out)


def inserts_stream(v):
    rows = v("inserts").select("publisher", "entity_id", "insert_date", c("insert_date").alias("collection_date"), c("insert_date").cast("timestamp").alias("ts"))
    return streamed(v, rows)


@query("select publisher, d as window_start, cast(count(*) as bigint) as n from (select publisher, insert_date - cast(k as int) as d from {inserts} cross join (select distinct n_nationkey as k from {nation} where n_nationkey < 7) x) y group by 1, 2")
def r3_windowed_inserts(v):
    stream, out = inserts_stream(v)
    twins.to_table(twins.windowed_inserts(stream, length="7 days"), f"{out}/checkpoint", f"{out}/table")
    return twins.latest(v("runs").sparkSession, f"{out}/table", ["w", "publisher"]).select("publisher", F.to_date("w.start").alias("window_start"), "n")


@query("select entity_id from {inserts} where entity_id % 180 <= 90")
def r4_late_evidence_recheck(v):
    stream, out = inserts_stream(v)
    found = F.date_add("insert_date", (c("entity_id") % 180).cast("int"))
    evidence = streamed(v, v("inserts").select("entity_id", found.alias("evidence_date"), found.alias("collection_date")))[0].drop("collection_date")
    twins.run(twins.late_evidence(stream, evidence), f"{out}/checkpoint", twins.idempotent_sink(f"{out}/table", ["entity_id", "insert_date"], "insert_date"), store=twins.ROCKS)
    return v("runs").sparkSession.read.parquet(f"{out}/table").select("entity_id")


@query("select publisher, max(extract_date) as extract_date from {runs} group by 1")
def r5_freshness_lag(v):
    stream, out = streamed(v, v("runs"))
    twins.to_table(twins.freshness_lag(stream), f"{out}/checkpoint", f"{out}/table")
    return twins.latest(v("runs").sparkSession, f"{out}/table", ["publisher"])


@query("select publisher, collection_date, item_count from {runs}")
def r6_idempotent_sink(v):
    stream, out = streamed(v, v("runs"))
    twins.run(stream, f"{out}/checkpoint", twins.idempotent_sink(f"{out}/table", ["publisher", "collection_date"]))


    return v("runs").sparkSession.read.parquet(f"{out}/table").select("publisher", "collection_date", "item_count")


@query("""with d as (select distinct publisher, collection_date from {snapshots}), g as (select *, case when collection_date - lag(collection_date) over (partition by publisher order by collection_date) <= 1 then 0 else 1 end as new from d),
          s as (select *, sum(new) over (partition by publisher order by collection_date) as spell from g) select publisher, min(collection_date) as first_day, cast(count(*) as bigint) as n from s group by publisher, spell""")
def r7_session_gaps(v):
    rows = v("snapshots").select("publisher", "collection_date").distinct()
    # A row of no publisher, long after all others, lets the watermark close the last spells.
    end = rows.agg(F.lit(None).cast("string").alias("publisher"), F.date_add(F.max("collection_date"), 30).alias("collection_date"))
    stream, out = streamed(v, rows.unionByName(end).withColumn("ts", c("collection_date").cast("timestamp")))
    twins.to_table(twins.session_gaps(stream), f"{out}/checkpoint", f"{out}/table", "append")
    return v("runs").sparkSession.read.parquet(f"{out}/table").select("publisher", F.to_date("w.start").alias("first_day"), "n")


