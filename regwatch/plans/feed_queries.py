"""Queries of feeds, reports, territories, delivery windows and mail reports (X, T, W, A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import feed, mailauth, territory, windows
from ..sources.scratch import settled
from .change_queries import ALL, events, judged_runs
from .match_queries import LABELLED, labelled, merged
from .registry import query
from .text_queries import tidy

c = F.col
ADDRESS = "concat_ws(', ', nullif(address_line_1, ''), nullif(address_line_2, ''), nullif(address_line_3, ''), nullif(address_line_4, ''))"
LIVE = "coalesce(nullif(postcode_live, ''), nullif(post_code, ''))"
CODE = f"case when length(replace(coalesce({LIVE}, ''), ' ', '')) = 0 then 'none' when length(replace({LIVE}, ' ', '')) < 5 then 'district_only' else 'full' end"
CHAIN = f"regexp_matches(regexp_replace(lower(business_name || {ADDRESS}), '[^a-z0-9]', '', 'g'), '{'|'.join(feed.CHAIN_STEMS)}') or regexp_matches(' ' || regexp_replace(lower(business_name), '[^a-z0-9]+', ' ', 'g') || ' ', ' ({'|'.join(feed.CHAIN_WORDS)}) ')"
INSTITUTION = rf"regexp_matches(lower(business_name), '\b({'|'.join(feed.INSTITUTIONS)})\b') or regexp_matches(lower({ADDRESS}), '\b({'|'.join(feed.INSTITUTIONS)})\b')"
SQ = r"regexp_replace(regexp_replace(replace(lower(coalesce(@, '')), '&', ' and '), '\b(and|the|ltd|limited|plc|llp|co|company|uk)\b', ' ', 'g'), '[^a-z0-9]', '', 'g')"
A, B = SQ.replace("@", "business_name"), SQ.replace("@", "previous_business_name")
REISSUE = f"classification = 'OPERATOR_CHANGE' and {A} <> '' and {B} <> '' and (strpos({A}, {B}) > 0 or strpos({B}, {A}) > 0)"
SURE = "(lower(reason) like '%registered address is an exact match for this establishment''s address%' and lower(reason) not like '%address isn''t corroborat%')"


def types(audience: str) -> str:
    return ", ".join(f"'{x}'" for x in feed.AUDIENCES[audience])


def removal(wanted: str, inside: str = "true") -> str:
    """The first reason of a record, as SQL."""
    kinds = "case " + " ".join(f"when {wanted} = '{a}' then business_type in ({types(a)})" for a in feed.AUDIENCES) + " end"
    return f"""case when not {inside} then 'outside territory' when classification not in ('NEW_VENUE', 'OPERATOR_CHANGE') then 'unclassified' when not coalesce({kinds}, false) then 'venue type'
               when not ({CODE} = 'full' and {ADDRESS} <> '') then 'incomplete address' when {CHAIN} then 'chain' when {INSTITUTION} then 'institution' when {REISSUE} then 're-issue' end"""


INSIDE = "authority_name in ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8')"
COUNCILS = ["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8"]


@query(f"""with {LABELLED}, jr as ({ALL} select publisher, collection_date, batch_publication from vd),
        ex as (select publisher, max(extract_date) as authority_extract_date from {{runs}} where status = 'ok' group by 1)
        select lb.* exclude (publisher), e.publisher, e.business_name, e.first_seen_date, e.last_seen_date, e.post_code, p.name as authority_name, ex.authority_extract_date, coalesce(jr.batch_publication, false) as batch_publication,
               c.company_name, c.company_status, c.date_of_creation as incorporation_date, c.sic_codes, b.business_name as previous_business_name, b.last_seen_date as previous_last_seen
        from lb join {{entities}} e on e.entity_id = lb.entity_id join {{register_publishers}} p on p.publisher = e.publisher left join ex on ex.publisher = e.publisher
        left join jr on jr.publisher = e.publisher and jr.collection_date = lb.insert_date left join {{companies}} c on c.company_number = lb.evidence_company_number left join {{entities}} b on b.entity_id = lb.evidence_predecessor_id
        where not lower(e.business_name) like '%closed%'""")
def x1_feed_records(v):
    inserts = v("inserts").select("entity_id", "insert_date", F.lit(False).alias("quarantined"))
    entities = v("entities").select("entity_id", "publisher", "business_name", "first_seen_date", "last_seen_date", "post_code")
    return feed.feed_records(settled(labelled(v)), inserts, entities, v("register_publishers"), judged_runs(v), v("runs"), v("companies")).na.fill(False, ["batch_publication"])


@query("select entity_id from {feed} where authority_name like '%NATION_1%' and lower(business_type) like '%pub%' and classification = 'NEW_VENUE' and regexp_extract(post_code, '^[A-Z]+') = 'D'")
def x2_filter_feed(v):
    return feed.filter_feed(v("feed"), area="d", publisher="nation_1", business_type="PUB", label="NEW_VENUE").select("entity_id")


@query("select entity_id, business_type = 'Farmers/growers' as noise from {feed}")
def x3_is_noise_type(v):
    return v("feed").select("entity_id", feed.is_noise_type(c("business_type")).alias("noise"))


def said(key: str, name: str = "''") -> str:
    """A phrase of the feed with a name in it, as SQL."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    head, _, tail = feed.SAID[key].partition("%s")
    return f"{quoted(head)} || {name} || {quoted(tail)}" if tail else quoted(head)


REASON = f"""case classification when 'NEW_VENUE' then case when coalesce(company_name, '') <> '' then {said("new with company", "company_name")} else {said("new")} end
          when 'OPERATOR_CHANGE' then case when coalesce(previous_business_name, '') <> '' and previous_business_name <> business_name then {said("change of name", "previous_business_name")}
               when coalesce(previous_business_name, '') <> '' then {said("change of the same name")} else {said("change")} end
          else case when coalesce(evidence_company_number, '') <> '' then {said("other with company", "coalesce(company_name, '')")} else {said("other")} end end"""


@query(f"select entity_id, {REASON} as out from {{feed}}")
def x4_customer_reason(v):
    return v("feed").select("entity_id", feed.customer_reason().alias("out"))


BULK = "coalesce(nullif(post_code, ''), nullif(postcode_live, ''))"


MAPPED = f"concat_ws(', ', nullif({ADDRESS}, ''), {BULK})"
#: Every column of the feed, as SQL.
COLUMNS = {
    "fhrsid": "entity_id", "business_name": "business_name", "address": ADDRESS, "postcode": BULK, "postcode_source": "case when coalesce(post_code, '') <> '' then 'bulk' when coalesce(postcode_live, '') <> '' then 'live_api' end",
    "address_completeness": f"case when {BULK} is null then 'no_address' when length(replace({BULK}, ' ', '')) < 5 then 'district_only' when {ADDRESS} <> '' then 'full' else 'postcode_only' end",
    "google_maps_url": f"case when {MAPPED} <> '' then '{t.MAP_LINK}' || replace(replace(url_encode({MAPPED}), '%2F', '/'), '%7E', '~') end", "authority_name": "authority_name", "authority_extract_date": "authority_extract_date",
    "business_type": "business_type", "rating_status": "case when rating_value in ('0', '1', '2', '3', '4', '5', 'Pass') then 'Rated' when rating_value = 'AwaitingInspection' then 'Awaiting Inspection' when rating_value = 'Awaiting Publication' then rating_value when rating_value = 'Exempt' then 'Exempt' else 'Unknown' end",
    "first_seen_date": "first_seen_date", "days_since_first_seen": "cast(date '1998-01-31' - first_seen_date as int)", "batch_publication": "case when batch_publication then 'Yes' else 'No' end", "classification": "classification", "confidence": "confidence",
    "reason": REASON, "reason_detail": "reason", "previous_business_name": "previous_business_name", "previous_fhrsid": "evidence_predecessor_id", "previous_last_seen": "previous_last_seen",
    "match_status": "case when coalesce(evidence_company_number, '') <> '' then 'Yes' else 'No' end", "company_name": "company_name", "company_number": "evidence_company_number", "company_status": "company_status",
    "incorporation_date": "incorporation_date", "sic_codes": "'56101, 56102'", "companies_house_url": f"'{t.COMPANY_LINK}' || nullif(evidence_company_number, '')", "fhrs_url": f"'{t.ENTITY_LINK}' || cast(entity_id as varchar)",
}


def shown(column: str, name: str) -> str:
    """A column of the feed as the text that stands there, by another name."""
    return f"coalesce(cast({COLUMNS[column]} as varchar), '') as {name}"


@query(f"select {', '.join(shown(x, x) for x in COLUMNS)} from {{feed}}")
def x5_build_feed(v):
    return feed.build_feed(v("feed"), F.lit("1998-01-31").cast("date"))


def address():
    return t.join_address(*(c(x) for x in feed.LINES))


@query(f"select entity_id, {CHAIN} as chain from {{feed}}")
def x6_is_chain(v):
    return v("feed").select("entity_id", feed.is_chain(c("business_name"), address()).alias("chain"))


@query(f"select entity_id, {INSTITUTION} as institution from {{feed}}")
def x7_is_institution(v):
    return v("feed").select("entity_id", feed.is_institution(c("business_name"), address()).alias("institution"))


@query(f"select entity_id, {SURE} as sure from {{feed}}")
def x8_company_is_corroborated(v):
    return v("feed").select("entity_id", feed.company_is_corroborated(c("reason")).alias("sure"))


@query(f"select entity_id, coalesce({REISSUE}, false) as reissue from {{feed}}")
def x9_is_reissue(v):
    return v("feed").select("entity_id", F.coalesce(feed.is_reissue(c("classification"), c("business_name"), c("previous_business_name")), F.lit(False)).alias("reissue"))


@query(f"select r as reason_removed, cast((select count(*) from (select {removal(chr(39) + 'broker' + chr(39), INSIDE)} as x from {{feed}}) y where x = r) as bigint) as removed from (values {', '.join(f'({chr(39)}{r}{chr(39)})' for r in feed.REASONS)}) z(r)")
def x10_filter_waterfall(v):
    return feed.filter_waterfall(v("feed"), "broker", COUNCILS)[1]


@query(f"select entity_id from {{feed}} where {removal(chr(39) + 'broker' + chr(39), INSIDE)} is null")
def x10_kept(v):
    return feed.filter_waterfall(v("feed"), "broker", COUNCILS)[0].select("entity_id")


@query(f"select entity_id, business_type in ({types('broker')}) as broker, business_type in ({types('roaster')}) as roaster from {{feed}}")
def x11_audience_types(v):
    rows = v("feed")
    pairs = feed.audience_types(rows.sparkSession)
    flag = lambda a: F.broadcast(pairs.where(c("audience") == a).select("business_type", F.lit(True).alias(a)))
    return rows.join(flag("broker"), "business_type", "left").join(flag("roaster"), "business_type", "left").select("entity_id", F.coalesce("broker", F.lit(False)).alias("broker"), F.coalesce("roaster", F.lit(False)).alias("roaster"))


CHANGE = "classification = 'OPERATOR_CHANGE'"
KNOWN = f"{SURE} and coalesce(evidence_company_number, '') <> ''"


@query(f"""select entity_id, {tidy("business_name")} as venue, case when {CHANGE} then 'Change of operator' else 'New opening' end as status,
           case business_type when 'Restaurant/Cafe/Canteen' then 'Cafe / restaurant' when 'Pub/bar/nightclub' then 'Pub / bar' when 'Takeaway/sandwich shop' then 'Takeaway' else coalesce(business_type, '') end as premises,
           {ADDRESS} as address, coalesce({LIVE}, '') as postcode, authority_name as council, first_seen_date as registered, case when {CHANGE} then {tidy("previous_business_name")} else '' end as previously,
           case when {KNOWN} then coalesce(company_name, '') else '' end as company, case when {KNOWN} then evidence_company_number else '' end as company_no, case when {KNOWN} then coalesce(cast(incorporation_date as varchar), '') else '' end as incorporated,
           concat_ws('; ', case when batch_publication then 'published in a batch' end, case when {CHANGE} and coalesce(previous_business_name, '') = '' then 'previous name unknown' end, case when confidence <> 'HIGH' then lower(confidence) || ' confidence' end) as notes,
           '{t.ENTITY_LINK}' || cast(entity_id as varchar) as link from {{feed}}""")
def x12_report_rows(v):
    return feed.report_rows(v("feed"))


@query(f"""with j as (select *, {removal(chr(39) + 'all' + chr(39))} as why from {{feed}})
        select cast(sum(case when why is null and classification <> 'OPERATOR_CHANGE' then 1 else 0 end) as bigint) as new, cast(sum(case when why is null and classification = 'OPERATOR_CHANGE' then 1 else 0 end) as bigint) as takeover,
               cast(sum(case when why is null and {SURE} and coalesce(evidence_company_number, '') <> '' then 1 else 0 end) as bigint) as with_company, cast(count(*) as bigint) as register_entries from j""")
def x13_report_summary(v):
    kept, removed = feed.filter_waterfall(v("feed"))
    return feed.report_summary(feed.report_rows(kept), removed)


@query("select entity_id, authority_name as council from {feed} order by council, entity_id")
def x14_report_sort(v):
    return feed.report_sort(feed.report_rows(v("feed"))).select("entity_id", "council")


@query("""select cast(count(*) as bigint) as total, cast(sum(case when classification = 'NEW_VENUE' then 1 else 0 end) as bigint) as new_venue, cast(sum(case when classification = 'OPERATOR_CHANGE' then 1 else 0 end) as bigint) as operator_change,
          cast(sum(case when classification = 'UNKNOWN' then 1 else 0 end) as bigint) as unknown, cast(count(evidence_company_number) as bigint) as matched, cast(sum(case when batch_publication then 1 else 0 end) as bigint) as batch from {feed}""")
def x16_feed_stats(v):
    return feed.feed_stats(v("feed"))


@query("select entity_id from {feed} where lower(business_name) like '%school%' or lower(coalesce(company_name, '')) like '%school%'")
def x16_feed_search(v):
    return feed.feed_search(v("feed"), "SCHOOL").select("entity_id")


def truth(v):
    return v("inserts").select("entity_id", F.when(c("entity_id") % 3 == 0, F.lpad((1 + c("entity_id") % 97).cast("string"), 8, "0")).otherwise("").alias("true_company"))


TRUTH = "case when lb.entity_id % 3 = 0 then lpad(cast(1 + lb.entity_id % 97 as varchar), 8, '0') else '' end"


@query(f"""with {LABELLED}, tp as (select entity_id, count(*) as n, list({{'rank': rank, 'company_number': company_number, 'name_similarity_score': name_similarity_score}} order by rank) as cs from mg where rank <= 3 group by 1)
        select lb.entity_id, classification, cast(n as int) as n, cast(to_json(cs) as varchar) as candidates, {TRUTH} as true_company from lb left join tp on tp.entity_id = lb.entity_id""")
def x17_audit_ledger(v):
    candidates = settled(merged(v))
    return feed.audit_ledger(labelled(v, candidates), candidates, truth(v)).select("entity_id", "classification", F.size("candidates").alias("n"), F.to_json("candidates").alias("candidates"), "true_company")


@query(f"with {LABELLED} select cast(count(*) as bigint) as labelled, cast(sum(case when evidence_company_number = {TRUTH} then 1 else 0 end) as bigint) as agree from lb where {TRUTH} <> ''")
def x18_ground_truth_score(v):
    candidates = settled(merged(v))
    return feed.ground_truth_score(feed.audit_ledger(labelled(v, candidates), candidates, truth(v)))


def gazetteer(v):
    """A gazetteer over the nations: regions under a synonym, some nations as cities, an abbreviation."""
    pubs = v("publishers")
    rows = pubs.select(F.concat(F.lit("greater "), F.lower("region_name")).alias("place_key"), F.lit("region_synonym").alias("kind"), c("region_name").alias("target")).distinct()
    rows = rows.unionByName(pubs.select(F.concat(F.lower("name"), F.lit(" city")).alias("place_key"), F.lit("city").alias("kind"), c("name").alias("target")))
    one = pubs.where("publisher = '0'")
    group = one.select(F.explode(F.array(F.lit("ASIA"), F.lit("MU"), F.lit("LEMURIA"))).alias("target")).select(F.lit("far lands").alias("place_key"), F.lit("region_group").alias("kind"), "target")
    rows = rows.unionByName(group)
    return rows.unionByName(one.select(F.lit("everywhere").alias("place_key"), F.lit("national").alias("kind"), F.lit("").alias("target"))).unionByName(one.select(F.lit("uk").alias("place_key"), F.lit("abbreviation").alias("kind"), F.lit("nation_5").alias("target")))


PLACE = """case o_orderkey % 14 when 0 then 'Nation_3, Nation_7' when 1 then 'Greater Asia' when 2 then 'UK' when 3 then 'Nation_8 City and Nation_9' when 4 then 'Atlantis' when 5 then 'Nation_3 and Atlantis' when 6 then 'Everywhere' when 7 then 'EUROPE / Nation_12'
        when 8 then ' the nation_2. ' when 9 then 'Far lands' when 10 then 'Nation_1, Far lands and the UK' when 11 then 'Nation_4,' when 12 then ' , ' else 'Asia,Nation_1 and Nation_1' end"""


def resolved(v):
    places = v("orders").selectExpr(f"{PLACE} as place")
    return territory.resolve_territories(places, gazetteer(v), v("publishers"))


@query(f"""with pl as (select distinct {PLACE} as place from {{orders}}), want as (
        select place, p.publisher from pl join {{publishers}} p on
          (place = 'Nation_3, Nation_7' and name in ('NATION_3', 'NATION_7')) or (place = 'Greater Asia' and region_name = 'ASIA') or (place = 'UK' and name = 'NATION_5') or (place = 'Nation_8 City and Nation_9' and name in ('NATION_8', 'NATION_9'))
          or place = 'Everywhere' or (place in (' the nation_2. ') and name = 'NATION_2') or (place = 'Nation_4,' and name = 'NATION_4') or (place = 'Asia,Nation_1 and Nation_1' and (region_name = 'ASIA' or name = 'NATION_1')))
        select pl.place, string_agg(publisher, ',' order by publisher) as publishers,
               case pl.place when 'Atlantis' then 'unknown: Atlantis' when 'Nation_3 and Atlantis' then 'unknown: Atlantis' when 'EUROPE / Nation_12' then 'unknown: EUROPE / Nation_12' when 'Far lands' then 'absent: LEMURIA, MU' when 'Nation_1, Far lands and the UK' then 'absent: LEMURIA, MU' when ' , ' then 'no territory given' end as reason
        from pl left join want on pl.place = want.place group by 1""")
def t1_resolve_territories(v):
    return resolved(v).select("place", F.array_join("publishers", ",").alias("publishers"), "reason")


@query("select region_name, string_agg(publisher, ',' order by publisher) as publishers from {publishers} group by 1")
def t2_regions(v):
    return territory.regions(v("publishers")).select("region_name", F.array_join("publishers", ",").alias("publishers"))


@query("select publisher from {publishers}")
def t3_resolve_many(v):
    return territory.resolve_many(resolved(v))


@query("select name from {publishers} where cast(publisher as int) % 4 = 0 order by name")
def t4_validate_gazetteer(v):
    return territory.validate_gazetteer(gazetteer(v).where("kind = 'city'"), v("publishers").where("cast(publisher as int) % 4 <> 0"))


COMPLETE = "cd as (select collection_date from {runs} where status = 'ok' group by 1 having count(distinct publisher) >= 0.9 * (select count(distinct publisher) from {runs}))"


def five(v):
    return v("register_publishers").where("publisher <> 'silent'")


@query(f"with {COMPLETE} select max(collection_date) as last_complete_date from cd")
def w1_last_complete_date(v):
    return windows.last_complete_date(v("runs"), five(v))


@query(f"""{ALL}, {COMPLETE}, dd as (select collection_date from vd group by 1 having count(distinct publisher) >= 4.5),
        bad as (select distinct ev.collection_date from ev left join vd on ev.publisher = vd.publisher and ev.collection_date = vd.collection_date where event_type = 'INSERT' and not coalesce(quarantined, false) and entity_id % 50 = 0)
        select max(collection_date) as last_reportable_date from (select collection_date from cd order by 1 desc limit 30) x where collection_date in (select collection_date from dd) and collection_date not in (select collection_date from bad)""")
def w2_last_reportable_date(v):
    from ..operators import guard
    from .change_queries import verdict

    flagged = guard.flag_events(events(v), verdict(v))
    done = flagged.where("event_type = 'INSERT' and entity_id % 50 <> 0").select("entity_id", c("collection_date").alias("insert_date"))
    return windows.last_reportable_date(v("runs"), five(v), judged_runs(v), flagged, done)


@query("select subscriber_id, arg_max(issue_id, until) as issue_id, max(until) as until from {issues} group by 1")
def w3_last_issue(v):
    return windows.last_issue(v("issues"))


def until(v):
    return v("orders").select(F.lit("1995-03-22").cast("date").alias("until")).limit(1)


NEXT = """nx as (select s.subscriber_id, coalesce(max(i.until), s.started_date) + 1 as since, date '1995-03-22' as until from {subscribers} s left join {issues} i on i.subscriber_id = s.subscriber_id where active group by s.subscriber_id, s.started_date)"""


@query(f"with {NEXT} select *, case when since > until then 'already_current' else 'owed' end as state from nx")
def w4_next_windows(v):
    return windows.next_windows(v("subscribers"), v("issues"), until(v))


@query("select subscriber_id, issue_id, since, expected_since from (select *, lag(until) over (partition by subscriber_id order by until) + 1 as expected_since from {issues}) x where since <> expected_since")
def w5_issue_gaps(v):
    return windows.issue_gaps(v("issues"))


@query("select issue_id from {issues} where sent_date is null")
def w6_unsent_issues(v):
    return windows.unsent_issues(v("issues")).select("issue_id")


@query("select s.subscriber_id, territory, audience, active, started_date, arg_max(issue_id, until) as issue_id, max(until) as until from {subscribers} s left join {issues} i on i.subscriber_id = s.subscriber_id where active group by all")
def w7_subscriber_status(v):
    return windows.subscriber_status(v("subscribers"), v("issues"))


@query(f"""with {NEXT} select nx.subscriber_id, {removal('s.audience')} as reason_removed, cast(count(*) as bigint) as n from nx join {{subscribers}} s on s.subscriber_id = nx.subscriber_id join {{territory_publishers}} t on t.territory = s.territory
           join {{feed}} f on f.publisher = t.publisher and f.first_seen_date between nx.since and nx.until where nx.since <= nx.until group by 1, 2""")
def w8_report_for_all(v):
    nx = windows.next_windows(v("subscribers"), v("issues"), until(v))
    return windows.report_for_all(v("subscribers"), nx, v("territory_publishers"), v("feed"))


DEMAND = """dm as (select territory, case f.entity_id % 2 when 0 then 'broker' else 'all' end as audience, cast(sum(case when first_seen_date >= date '1995-03-22' - 6 then 1 else 0 end) as bigint) as days_7, cast(count(*) as bigint) as days_28
           from {feed} f join {territory_publishers} t on t.publisher = f.publisher where first_seen_date between date '1995-03-22' - 27 and date '1995-03-22' group by 1, 2)"""


def demand(v):
    rows = v("feed").select("publisher", F.when(c("entity_id") % 2 == 0, "broker").otherwise("all").alias("audience"), "first_seen_date")
    return windows.demand_counts(rows, v("territory_publishers"), F.lit("1995-03-22").cast("date"))


@query(f"with {DEMAND} select * from dm")
def w9_demand_counts(v):
    return demand(v)


@query(f"""with {DEMAND} select s.subscriber_id as lead_id, s.territory, s.audience, case when s.subscriber_id % 7 = 0 then 'unresolved' when own.days_28 > 0 then 'send' when s.subscriber_id % 2 = 0 and wide.days_28 > 0 then 'widen' else 'hold' end as decision,
        coalesce(own.days_28, 0) as days_28, case when s.subscriber_id % 7 <> 0 and s.subscriber_id % 3 <> coalesce(own.days_28, 0) then printf('stored %d, now %d', s.subscriber_id % 3, coalesce(own.days_28, 0)) else '' end as note
        from {{subscribers}} s left join dm own on own.territory = s.territory and own.audience = s.audience left join dm wide on wide.territory = 'ASIA' and wide.audience = s.audience""")
def w10_send_gate(v):
    k = c("subscriber_id")
    batch = v("subscribers").select(k.alias("lead_id"), "territory", "audience", F.when(k % 2 == 0, "ASIA").alias("wider"), (k % 3).alias("stored_28"), (k % 7 != 0).alias("resolved"))
    return windows.send_gate(batch, demand(v))


VENUES = f"select entity_id, {tidy('business_name')} as venue, case when classification = 'OPERATOR_CHANGE' then 'Change of operator' else 'New opening' end as status, authority_name as council, case when classification = 'OPERATOR_CHANGE' then coalesce(previous_business_name, '') else '' end as previously from {{feed}}"


@query(f"""with r0 as ({VENUES}), r1 as (select *, substr(council, 1, 8) as territory, case when status = 'New opening' then 0 when previously = '' then 1 else 2 end as kind from r0),
        r2 as (select *, row_number() over (partition by territory, kind, council order by venue, entity_id) as turn from r1), r3 as (select *, row_number() over (partition by territory, kind order by turn, council, venue, entity_id) as place from r2),
        r4 as (select *, row_number() over (partition by territory, kind = 2 order by kind, place) as plain, max(case when kind = 2 then 1 else 0 end) over (partition by territory) as named from r3),
        r5 as (select *, row_number() over (partition by territory order by kind < 2 and plain > 5 - named, kind, place) as pick from r4)
        select territory, cast(pick as int) as pick, entity_id, status, council from r5 where pick <= 5""")
def w11_diverse_top_k(v):
    rows = feed.report_rows(v("feed")).withColumn("territory", F.substring("council", 1, 8))
    return windows.diverse_top_k(rows, 5, ["territory"]).select("territory", "pick", "entity_id", "status", "council")


@query(f"select authority_name as council, cast(sum(case when classification <> 'OPERATOR_CHANGE' then 1 else 0 end) as bigint) as new, cast(sum(case when classification = 'OPERATOR_CHANGE' then 1 else 0 end) as bigint) as takeover, cast(1 as bigint) as councils from {{feed}} where {removal(chr(39) + 'all' + chr(39))} is null group by 1")
def w12_split_counts(v):
    return windows.split_counts(feed.report_rows(feed.filter_waterfall(v("feed"))[0]), ["council"])


def records(v):
    """Records with what each sender's own checks found: one result of spf, two of dkim, of which one has no result."""
    pair = lambda domain, result: F.struct(domain.alias("domain"), result.alias("result"))
    own = {"auth_spf": F.array(pair(c("header_from"), c("spf"))), "auth_dkim": F.array(pair(c("header_from"), c("dkim")), pair(F.concat(F.lit("bulk."), "reporter"), F.lit(None).cast("string")))}
    return v("auth_records").withColumnsRenamed({"begin_": "begin", "end_": "end"}).withColumns(own)


def results(field: str) -> str:
    return f"{field}_counts as (select source_ip, string_agg(r || ':' || cast(n as varchar), ',' order by r) as {field}_results from (select source_ip, coalesce({field}, '?') as r, sum(count) as n from {{auth_records}} group by 1, 2) x group by 1)"


@query(f"""with {results("spf")}, {results("dkim")}, {results("disposition")},
          dk as (select source_ip, string_agg(d, ',' order by d) as dkim_domains from (select source_ip, header_from || '=' || dkim as d from {{auth_records}} union select source_ip, 'bulk.' || reporter || '=?' from {{auth_records}}) y group by 1),
          sp as (select source_ip, string_agg(d, ',' order by d) as spf_domains from (select distinct source_ip, header_from || '=' || coalesce(spf, '?') as d from {{auth_records}}) y group by 1),
          su as (select source_ip, cast(sum(count) as bigint) as messages, string_agg(distinct reporter, ',' order by reporter) as reporters, string_agg(distinct header_from, ',' order by header_from) as domains, min(begin_) as first_seen, max(begin_) as last_seen from {{auth_records}} group by 1)
          select * from su join spf_counts using (source_ip) join dkim_counts using (source_ip) join disposition_counts using (source_ip) join dk using (source_ip) join sp using (source_ip)""")
def a2_source_rollup(v):
    rows = mailauth.source_rollup(records(v))
    joined = [F.array_join(x, ",").alias(x) for x in ("reporters", "domains", "spf_domains", "dkim_domains")]
    counted = [F.array_join(F.transform(F.map_entries(x), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias(x) for x in ("spf_results", "dkim_results", "disposition_results")]
    return rows.select("source_ip", "messages", *joined, "first_seen", "last_seen", *counted)


@query("""with x as (select count, coalesce(spf = 'pass', false) as s, coalesce(dkim = 'pass', false) as d from {auth_records}) select cast(sum(count) as bigint) as messages, cast(sum(case when s or d then count else 0 end) as bigint) as passed, cast(sum(case when not (s or d) then count else 0 end) as bigint) as failed,
          cast(sum(case when d and not s then count else 0 end) as bigint) as dkim_only, cast(sum(case when s and not d then count else 0 end) as bigint) as spf_only from x""")
def a3_auth_tally(v):
    return mailauth.auth_tally(records(v))


@query("select distinct source_ip, case when source_ip like '10.1.%' then 'listed' when source_ip like '10.2.%' then 'listed' else 'unlisted' end as state from {auth_records}")
def a4_cidr_classify(v):
    nets = v("region").where("r_regionkey in (1, 2)").select(F.concat(F.lit("net"), c("r_regionkey").cast("string")).alias("label"), F.concat(F.lit("10."), c("r_regionkey").cast("string"), F.lit(".0.0")).alias("lo"), F.concat(F.lit("10."), c("r_regionkey").cast("string"), F.lit(".255.255")).alias("hi"))
    return mailauth.cidr_classify(records(v), nets).select("source_ip", "state")


@query("select 'domain=' || header_from || '; p=' || disposition || '; sp=-; pct=100; adkim=r; aspf=r' as policy, cast(count(*) as bigint) as reports from {auth_records} group by 1")
def a5_policy_counts(v):
    rows = records(v).select(c("header_from").alias("domain"), c("disposition").alias("p"), F.lit(None).cast("string").alias("sp"), F.lit(100).alias("pct"), F.lit("r").alias("adkim"), F.lit("r").alias("aspf"))
    return mailauth.policy_counts(rows)


@query("select reporter, cast(count(*) as bigint) as reports, min(begin_) as begin, max(end_) as end from {auth_records} group by 1".replace("as begin,", 'as "begin",').replace("as end ", 'as "end" '))
def a5_coverage(v):
    return mailauth.coverage(records(v))
