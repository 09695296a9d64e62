"""Views over the test tables in the shapes that the operators take.

Each view is one SQL text that Spark and DuckDB both run; ``{name}`` stands for a table or another view. Dialects differ
in the few words of SPARK.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations", "labels")
#: DuckDB's spelling to Spark's.
SPARK = (("arg_max(", "max_by("), ("as varchar", "as string"), ("unnest(", "explode("), ("string_split(", "split("))

VIEWS = {
    "raw_snapshots": """
        select a.publisher, a.entity_id, a.collection_date, a.rating, p.p_name as business_name,
               'D' || cast(a.entity_id % 4 as varchar) as district, cast(a.entity_id % 37 as varchar) || ' High Street' as address_line_1,
               'D' || cast(a.entity_id % 20 as varchar) || ' 1AA' as postcode
        from (select event_type as publisher,
                     user_id * 10 + case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as entity_id,
                     cast(ts as date) as collection_date, arg_max(cast(floor(value / 100) as bigint), {pair}) as rating
              from {events} group by 1, 2, 3) a
        join {part} p on p.p_partkey = a.entity_id % (select count(*) from {part})""",
    "runs": """
        select publisher, collection_date, collection_date - cast(day(collection_date) % 3 as int) as extract_date, count(*) as item_count,
               case when publisher = 'error' and day(collection_date) = 7 then 'parse_error' else 'ok' end as status, cast(count(*) % 3 as bigint) as skipped_records
        from {raw_snapshots} group by 1, 2, 3""",
    "snapshots": """
        select s.* from {raw_snapshots} s join {runs} r on s.publisher = r.publisher and s.collection_date = r.collection_date and r.status = 'ok'""",
    "companies": """
        select lpad(cast(p_partkey as varchar), 8, '0') as company_number,
               upper(p_name) || ' ' || replace(upper(p_brand), '#', ' ') || case when p_partkey % 2 = 1 then ' LIMITED' else ' LTD' end as company_name,
               cast(p_partkey % 37 as varchar) || ' High Street' as address_line_1, 'D' || cast(p_partkey % 20 as varchar) || ' 1AA' as postcode,
               date '2023-06-01' + cast(p_partkey % 400 as int) as date_of_creation, 'active' as company_status, '["56101","56102"]' as sic_codes
        from {part}""",
    "company_snapshots": """
        select c.company_number, c.company_name, case when (p_partkey + d) % 7 = 0 then 'dissolved' else 'active' end as company_status,
               'feed' || cast(d as varchar) as source, date '2024-01-01' + cast(d as int) as collection_date
        from {companies} c join {part} p on cast(c.company_number as bigint) = p.p_partkey cross join (select r_regionkey as d from {region} where r_regionkey < 3) x
        where p_partkey % 11 <> d""",
    "publishers": """
        select cast(n_nationkey as varchar) as publisher, n_name as name, r_name as region_name from {nation} join {region} on n_regionkey = r_regionkey""",
    "register_publishers": """
        select publisher, 'Council of ' || publisher as name, 'REGION' as region_name from (select distinct publisher from {raw_snapshots}) x
        union all select 'silent', 'Council of silence', 'REGION'""",
    "entities": """
        select s.publisher, s.entity_id, s.business_name, s.address_line_1, s.postcode, s.postcode as post_code, x.first_seen_date, x.last_seen_date
        from {snapshots} s join (select publisher, entity_id, min(collection_date) as first_seen_date, max(collection_date) as last_seen_date from {snapshots} group by 1, 2) x
          on s.publisher = x.publisher and s.entity_id = x.entity_id and s.collection_date = x.last_seen_date""",
    "inserts": """
        select e.entity_id, e.publisher, e.first_seen_date as insert_date, case when e.entity_id % 3 = 0 then upper(c.company_name) when e.entity_id % 3 = 1 then c.company_name || ' @ ' || e.business_name else e.business_name end as business_name,
               e.address_line_1, e.postcode, e.first_seen_date
        from {entities} e join {companies} c on cast(c.company_number as bigint) = 1 + e.entity_id % 97
        where e.first_seen_date > (select min(collection_date) from {runs})""",
    "spells": """
        select o_orderkey as entity_id, o_orderpriority as publisher, cast(o_orderdate as date) as insert_date, p.p_name as business_name, cast(o_custkey as varchar) || ' High Street' as address_line_1,
               'D' || cast(o_custkey % 10 as varchar) || ' 1AA' as postcode, cast(o_orderdate as date) as first_seen_date, cast(o_orderdate as date) + cast(30 + o_orderkey % 200 as int) as last_seen_date
        from {orders} join {part} p on p.p_partkey = 1 + o_orderkey % (select count(*) from {part})""",
    "feed": """
        select s.entity_id, n.n_name as authority_name, cast(n.n_nationkey as varchar) as publisher, s.insert_date, s.first_seen_date,
               case s.entity_id % 6 when 0 then 'GREGGS ' || upper(s.business_name) when 1 then 'St Ann''s School canteen' when 2 then upper(s.business_name) when 3 then 'D''' || upper(s.business_name) when 4 then 'The ' || s.business_name || ' & Co' else s.business_name end as business_name,
               case when s.entity_id % 11 = 0 then null else s.address_line_1 end as address_line_1, cast(null as varchar) as address_line_2, case when s.entity_id % 2 = 0 then 'Old Town' else '' end as address_line_3, n.n_name as address_line_4,
               case when s.entity_id % 7 = 0 then null else s.postcode end as post_code, case when s.entity_id % 5 = 0 then 'D1' else null end as postcode_live,
               case c.c_mktsegment when 'BUILDING' then 'Restaurant/Cafe/Canteen' when 'MACHINERY' then 'Takeaway/sandwich shop' when 'HOUSEHOLD' then 'Mobile caterer' when 'FURNITURE' then 'Farmers/growers' else 'Pub/bar/nightclub' end as business_type,
               case s.entity_id % 5 when 0 then '5' when 1 then 'AwaitingInspection' when 2 then 'Exempt' when 3 then null else 'Awaiting Publication' end as rating_value,
               case s.entity_id % 3 when 0 then 'NEW_VENUE' when 1 then 'OPERATOR_CHANGE' else 'UNKNOWN' end as classification,
               case s.entity_id % 4 when 0 then 'HIGH' when 1 then 'MEDIUM' else 'LOW' end as confidence,
               case s.entity_id % 4 when 0 then 'Registered address is an exact match for this establishment''s address' when 1 then 'address isn''t corroborating' else 'none' end as reason,
               case when s.entity_id % 3 = 1 and s.entity_id % 2 = 0 then s.business_name end as previous_business_name, case when s.entity_id % 3 = 1 then s.entity_id - 1 end as evidence_predecessor_id, s.last_seen_date as previous_last_seen,
               case when s.entity_id % 2 = 0 then lpad(cast(s.entity_id % 100 as varchar), 8, '0') end as evidence_company_number, case when s.entity_id % 2 = 0 then 'C' || cast(s.entity_id % 100 as varchar) || ' LTD' end as company_name,
               'active' as company_status, s.last_seen_date as incorporation_date, '["56101","56102"]' as sic_codes, s.last_seen_date as authority_extract_date, s.entity_id % 10 = 0 as batch_publication
        from {spells} s join {orders} o on o.o_orderkey = s.entity_id join {customer} c on c.c_custkey = o.o_custkey join {nation} n on n.n_nationkey = c.c_nationkey""",
    "subscribers": """
        select s_suppkey as subscriber_id, r_name as territory, case s_suppkey % 3 when 0 then 'roaster' when 1 then 'broker' else 'all' end as audience, s_suppkey % 9 <> 0 as active, date '1995-01-01' + cast(s_suppkey % 50 as int) as started_date
        from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "issues": """
        select s_suppkey * 10 + k as issue_id, s_suppkey as subscriber_id, date '1995-03-01' + cast(s_suppkey % 5 + 7 * k + case when (s_suppkey + k) % 6 = 0 then 1 else 0 end as int) as since,
               date '1995-03-01' + cast(s_suppkey % 5 + 7 * k + 6 as int) as until, case when (s_suppkey + k) % 4 <> 0 then date '1995-03-08' + cast(7 * k as int) end as sent_date
        from {supplier} cross join (select r_regionkey as k from {region} where r_regionkey < 3) x where s_suppkey % 10 > 1""",
    "territory_publishers": "select r_name as territory, cast(n_nationkey as varchar) as publisher from {nation} join {region} on n_regionkey = r_regionkey",
    "strings": """
        select 'case ' || cast(c_custkey as varchar) as k,
               case c_custkey % 12 when 0 then 'NG17 3GA' when 1 then 'sw1a 1aa' when 2 then 'M1 1AE' when 3 then 'OX7 ' when 4 then 'S43' when 5 then '' when 6 then null when 7 then '12345' when 8 then 'N1 9GU' when 9 then 'ABCDE' when 10 then 'RH20' else ' b33 8th ' end as postcode,
               case c_custkey % 13 when 0 then 'FOO LTD LTD' when 1 then 'The Cafe & Bar Limited' when 2 then 'LIMITED' when 3 then 'D''MUMBAI KITCHEN AND BAR' when 4 then 'foo cafeltd' when 5 then null when 6 then ''
                    when 7 then 'Sodexo Ltd @ St Mary''s' when 8 then ' @ nowhere' when 9 then 'BLIND COW' when 10 then 'Old Mill Bar/Bar' when 11 then 'Café Été, ' else 'A-B  (C) plc' end as name,
               case c_custkey % 7 when 0 then '12 High Street' when 1 then 'Old Town' when 2 then '' when 3 then null when 4 then 'Rowan House' when 5 then ' unit 4 ' else 'The Green, Ayton' end as line,
               case c_custkey % 8 when 0 then '5' when 1 then 'AwaitingInspection' when 2 then 'Awaiting Publication' when 3 then 'exempt' when 4 then null when 5 then 'Pass' when 6 then 'pass' else '' end as rating,
               case c_custkey % 6 when 0 then '2024-03-01' when 1 then '2024-3-1' when 2 then '2024-02-30' when 3 then null when 4 then 'x' else '2023-12-31' end as day_text,
               case c_custkey % 5 when 0 then '["56101","10710"]' when 1 then '[]' when 2 then null when 3 then 'bad' else '["1"]' end as codes, c_mktsegment as segment
        from {customer}
        union all select 'customer ' || cast(c_custkey as varchar), 'M' || cast(c_nationkey as varchar) || ' ' || cast(c_custkey % 10 as varchar) || 'AA', c_name || ' @ ' || c_mktsegment, cast(c_custkey as varchar) || ' ' || lower(c_mktsegment) || ' road', c_mktsegment, cast(c_acctbal as varchar), c_mktsegment, c_mktsegment from {customer}
        union all select 'part ' || cast(p_partkey as varchar), p_type, upper(p_name) || ' AND ' || replace(p_brand, '#', ' & ') || ' LTD', cast(p_size as varchar) || 'a ' || p_name, p_type, p_name, '["' || p_name || '","' || p_brand || '"]', p_brand from {part}
        union all select distinct 'word ' || w, w, w, w, w, w, w, w from (select unnest(string_split(replace(replace(text, chr(10), ' '), 'ß', 'ss'), ' ')) as w from {documents}) x""",
    "auth_records": """
        select '10.' || cast(user_id % 4 as varchar) || '.' || cast(user_id % 250 as varchar) || '.' || cast(user_id % 7 as varchar) as source_ip, cast(1 + floor(value) % 5 as bigint) as count,
               case when event_type = 'error' then 'reject' else 'none' end as disposition, case when event_type in ('click', 'view') then 'pass' else 'fail' end as dkim, case when event_type in ('click', 'signup') then 'pass' when event_type = 'error' then null else 'fail' end as spf,
               event_type || '.example' as header_from, 'reporter' || cast(user_id % 3 as varchar) as reporter, cast(ts as date) as begin_, cast(ts as date) + 1 as end_
        from {events}""",
}


def needed(name: str) -> list[str]:
    """The views behind a view, it last."""
    out: list[str] = []
    for other in re.findall(r"\{(\w+)\}", VIEWS[name]):
        if other in VIEWS:
            out += [x for x in needed(other) if x not in out]
    return [*out, name]


#: Views that many operators of one query read; they are kept, so that a plan holds them once.
KEPT = ("raw_snapshots", "runs", "snapshots", "entities", "inserts", "companies", "feed")
#: Tables and views with a row for each thing of the data. A join of a view sorts them: by the size of their compressed files
#: Spark would send them through the driver to every executor long after they have outgrown that.
GROWING = ("customer", "supplier", "part", "orders", "companies")
_views: dict[tuple, DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view of the data in sf_dir."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # What is behind a view is kept before it, also where the cache was cleared since.
    parts = {x: view(spark, sf_dir, x) for x in dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name])) if x != "pair"}
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), sf_dir, name)
    if key not in _views:
        _views[key] = _made(spark, name, parts)
    df = _views[key]
    return df.persist() if name in KEPT and not df.storageLevel.useMemory else df


def _made(spark: SparkSession, name: str, parts: dict[str, DataFrame]) -> DataFrame:
    """The parts are named as temporary views of their own, which stay: to drop one takes its rows out of the cache, and
    ``spark.sql`` drops those that it makes of its arguments."""
    sql = VIEWS[name]
    for a, b in SPARK:
        sql = sql.replace(a, b)
    names = {x: f"regwatch_{x}_{uuid.uuid4().hex}" for x in parts}
    for x, df in parts.items():
        (df.hint("merge") if x in GROWING and " join " in sql else df).createOrReplaceTempView(names[x])
    return spark.sql(sql.format(pair="struct(ts, event_id)", **names))


def with_views(body: str) -> str:
    """DuckDB SQL: body with every ``{view}`` in it as a common table expression before it."""
    names: list[str] = []
    for name in dict.fromkeys(re.findall(r"\{(\w+)\}", body)):
        if name in VIEWS:
            names += [x for x in needed(name) if x not in names]
    ctes = ", ".join(f"{n} as ({VIEWS[n]})" for n in names)
    text = re.sub(r"\{(\w+)\}", lambda m: "(ts, event_id)" if m[1] == "pair" else m[1], f"with {ctes} {body}" if not body.lstrip().lower().startswith("with ") else f"with {ctes}, {body.lstrip()[5:]}" if ctes else body)
    return text if ctes else re.sub(r"\{(\w+)\}", r"\1", body)
