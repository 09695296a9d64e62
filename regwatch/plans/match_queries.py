"""Queries of matching, classification and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import classify, enrich, resolve
from ..params import Params
from ..sources.scratch import settled
from .registry import query
from .text_queries import NORM

c = F.col


def date(text: str):
    return F.lit(text).cast("date")


norm = lambda name: NORM.replace("@", name)

IDF = f"""cn as (select company_number, company_name, address_line_1, postcode, split_part(postcode, ' ', 1) as district, date_of_creation, {norm('company_name')} as norm from {{companies}}),
        cw as (select distinct company_number as id, unnest(string_split(norm, ' ')) as word from cn where norm <> ''),
        idf as (select word, greatest(0, ln((select count(*) from cn where norm <> '') * 1.0 / (1 + count(*)))) as weight from cw group by 1)"""
EVENT_NAME = "business_name"


def scored(name: str, where: str) -> str:
    """CTEs: pairs of events (by an SQL expression of their name) and companies under a condition, with scores."""
    return f"""en as (select entity_id, insert_date, address_line_1, split_part(postcode, ' ', 1) as district, upper(address_line_1) || '|' || upper(postcode) as akey, {norm(name)} as norm from {{inserts}} where {name} is not null),
        ew as (select distinct norm, unnest(string_split(norm, ' ')) as word from en where norm <> ''),
        ewt as (select ew.norm, ew.word, coalesce(weight, (select max(weight) from idf)) as weight from ew left join idf using (word)),
        ea as (select norm, sum(weight) as total from ewt group by 1), ca as (select id, sum(weight) as total from cw join idf using (word) group by 1),
        dens as (select upper(address_line_1) || '|' || upper(postcode) as akey, count(*) as n from cn group by 1),
        pr as (select en.entity_id, en.insert_date, en.norm as enorm, en.akey as ekey, cn.* from en join cn on {where}),
        sh as (select enorm, company_number, sum(weight) as s from (select distinct enorm, company_number from pr) p join ewt on ewt.norm = p.enorm join cw on cw.id = p.company_number and cw.word = ewt.word group by 1, 2),
        sc as (select pr.*, dens.n as address_company_count, dens.n >= 5 as dense, pr.ekey = upper(pr.address_line_1) || '|' || upper(pr.postcode) as amatch,
                      case when pr.enorm = '' or pr.norm = '' then 0.0 when pr.enorm = pr.norm then 1.0 when coalesce(s, 0) > 0 then round(s / (ea.total + ca.total - s), 12) else 0.0 end as raw
               from pr left join sh on pr.enorm = sh.enorm and pr.company_number = sh.company_number left join ea on ea.norm = pr.enorm left join ca on ca.id = pr.company_number
               join dens on dens.akey = upper(pr.address_line_1) || '|' || upper(pr.postcode))"""


RANK = "row_number() over (partition by entity_id, insert_date order by (amatch and not dense) desc, case when amatch and not dense then -abs(cast(date_of_creation - insert_date as int)) else 0 end desc, round(raw, 4) desc, company_number)"
DISTRICT = f"{IDF}, {scored('business_name', 'en.district = cn.district')}, rk as (select *, {RANK} as rank from sc)"
PREFIX = "case when strpos(business_name, '@') > 0 then nullif(trim(split_part(business_name, '@', 1)), '') end"


def blocked(name: str) -> str:
    sql = scored(name, "en.norm <> '' and cn.norm <> '' and split_part(en.norm, ' ', 1) = split_part(cn.norm, ' ', 1)").replace("pr.ekey = upper(pr.address_line_1) || '|' || upper(pr.postcode) as amatch", "false as amatch")
    return f"{IDF}, {sql}, rk as (select *, {RANK} as rank from sc where raw >= 0.9)"


OUT = "select entity_id, insert_date, company_number, round(raw, 4) as score, cast(rank as int) as rank from rk where rank <= 5"


def idf(v):
    """The weights, kept: every name that is scored is joined with them."""
    return resolve.word_idf(v("companies")).persist()


def slim(df):
    return df.select("entity_id", "insert_date", "company_number", c("name_similarity_score").alias("score"), "rank")


def district(v):
    return resolve.district_candidates(v("inserts"), v("companies"), idf(v))


def merged(v):
    return resolve.all_candidates(v("inserts"), v("companies"), idf(v))


def matched(v, candidates):
    """Match runs with what K3 and K4 need of their events."""
    runs = resolve.match_runs(candidates, v("inserts"))
    return v("inserts").select("entity_id", "insert_date", "business_name", "first_seen_date").join(runs, ["entity_id", "insert_date"])


def labelled(v, candidates=None):
    """Classified events of the registers, with predecessors among the entities there."""
    events, entities, i = v("inserts"), v("entities"), idf(v)
    exact = settled(classify.predecessor_exact(events, entities))
    before = exact.unionByName(classify.predecessor_fallback(events, entities, i, exact))
    candidates = settled(merged(v)) if candidates is None else candidates
    m = settled(matched(v, candidates))
    return classify.classify(events, candidates, settled(before), classify.existing_operator(m), classify.operator_venue_count(m), i)


@query(f"with {IDF} select word, round(weight, 9) as weight from idf")
def m1_word_idf(v):
    return idf(v).select("word", F.round("weight", 9).alias("weight"))


@query(f"with {DISTRICT} select entity_id, insert_date, company_number, round(raw, 9) as score from sc where raw > 0")
def m2_name_similarity(v):
    return resolve.district_similarity(v("inserts"), v("companies"), idf(v)).select("entity_id", "insert_date", "company_number", "score")


@query("select company_number, cast(count(*) over (partition by upper(address_line_1), upper(postcode)) as bigint) as address_company_count, count(*) over (partition by upper(address_line_1), upper(postcode)) >= 5 as is_high_density_address from {companies}")
def m3_address_density(v):
    return resolve.address_density(v("companies")).select("company_number", "address_company_count", "is_high_density_address")


@query(f"with {DISTRICT} {OUT}")
def m4_district_candidates(v):
    return slim(district(v))


@query(f"with {blocked('business_name')} {OUT}")
def m5_national_candidates(v):
    return slim(resolve.national_candidates(v("inserts"), v("companies"), idf(v)))


@query(f"with {blocked(PREFIX)} {OUT}")
def m6_operator_candidates(v):
    return slim(resolve.operator_candidates(v("inserts"), v("companies"), idf(v)))


TRUST = "address_matches_establishment and not is_high_density_address"
BEST = f"({TRUST}) desc, case when {TRUST} then -abs(cast(date_of_creation - insert_date as int)) else 0 end desc, name_similarity_score desc"


def channel(ctes: str, strategy: str) -> str:
    return f"""(with {ctes} select entity_id, insert_date, company_number, company_name, round(raw, 4) as name_similarity_score, district as postcode_district, address_company_count,
               dense as is_high_density_address, '{strategy}' as match_strategy, date_of_creation, coalesce(amatch, false) as address_matches_establishment from rk where rank <= 5)"""


#: CTE mg: the candidates of all three channels.
MERGED = f"""mu as (select *, 0 as ord from {channel(DISTRICT, "district")} union all select *, 1 from {channel(blocked("business_name"), "national")} union all select *, 2 from {channel(blocked(PREFIX), "operator-prefix")}),
        mo as (select *, row_number() over (partition by entity_id, insert_date, company_number order by {BEST}, ord) as rn from mu),
        mr as (select * exclude (ord, rn), cast(row_number() over (partition by entity_id, insert_date order by {BEST}, company_number) as int) as rank from mo where rn = 1),
        mg as (select * from mr where rank <= 5)"""


@query(f"with {MERGED} select * from mg")
def m7_merge_candidates(v):
    return merged(v)


@query(f"with {DISTRICT} select entity_id, insert_date, company_number as best from rk where rank = 1")
def m8_candidate_priority(v):
    return district(v).where("rank = 1").select("entity_id", "insert_date", c("company_number").alias("best"))


@query(f"with {DISTRICT} select i.entity_id, i.insert_date, cast(coalesce(count(rank), 0) as bigint) as candidates_found, max(case when rank = 1 then company_number end) as best_company_number, max(case when rank = 1 then round(raw, 4) end) as best_score from {{inserts}} i left join (select * from rk where rank <= 5) rk on rk.entity_id = i.entity_id and rk.insert_date = i.insert_date group by 1, 2")
def m9_match_runs(v):
    return resolve.match_runs(district(v), v("inserts"))


PREFIXES = f"pf as (select {norm('p')} as prefix_norm, arg_min(p, (entity_id, p)) as prefix from (select entity_id, {PREFIX} as p from {{inserts}}) x where p is not null group by 1)"


@query(f"with {PREFIXES} select * from pf")
def m10_distinct_prefixes(v):
    return resolve.distinct_prefixes(v("inserts"))


def searched(v):
    """All companies as a search finds them: some dissolved, some dormant, by the size of their part."""
    part = v("part").select(F.lpad(c("p_partkey").cast("string"), 8, "0").alias("company_number"), "p_size")
    status, codes = F.when(c("p_size") % 4 == 0, "dissolved").otherwise("active"), F.array(F.when(c("p_size") % 5 == 0, "99999").otherwise("56101"), F.lit("56102"))
    return v("companies").drop("company_status", "sic_codes").join(part, "company_number").withColumns({"company_status": status, "sic_codes": codes})


@query(f"""with {PREFIXES}, hit as (with {blocked(PREFIX)} select distinct enorm from sc join {{part}} on p_partkey = cast(company_number as bigint) where raw >= 0.9 and p_size % 4 <> 0),
        ck as (select {norm('company_name')} as checked from {{companies}} join {{part}} on p_partkey = cast(company_number as bigint) where p_size % 4 = 0 and p_size * 2 < 30)
        select * from pf where strpos(prefix_norm, ' ') > 0 and prefix_norm not in (select enorm from hit) and prefix_norm not in (select checked from ck)""")
def m11_unsatisfied_prefixes(v):
    """Prefixes without a hit among the active companies, unless the name of a dissolved one was checked lately."""
    found = searched(v)
    hits = resolve.operator_candidates(v("inserts"), found.where("company_status = 'active'"), idf(v)).select("entity_id", "insert_date").distinct()
    hits = hits.join(v("inserts"), ["entity_id", "insert_date"]).select(t.company_name_norm(t.operator_prefix(c("business_name"))).alias("prefix_norm")).distinct()
    checks = found.where("company_status = 'dissolved'").select(t.company_name_norm(c("company_name")).alias("prefix_norm"), F.date_sub(date("2024-01-25"), c("p_size") * 2).alias("checked_date"))
    return resolve.unsatisfied_prefixes(resolve.distinct_prefixes(v("inserts")), hits, checks, date("2024-01-25"))


@query(f"""with {IDF}, {PREFIXES}, top as (select max(weight) as w from idf),
        se as (select cn.company_number, company_name as title, norm, p_size % 4 <> 0 as active, p_size % 5 = 0 as dormant from cn join {{part}} on p_partkey = cast(cn.company_number as bigint)),
        pw as (select distinct prefix, unnest(string_split(prefix_norm, ' ')) as word from pf where prefix_norm <> ''),
        pt as (select prefix, word, coalesce(weight, w) as weight from pw left join idf using (word) cross join top), pa as (select prefix, sum(weight) as total from pt group by 1),
        ca as (select id, sum(weight) as total from cw join idf using (word) group by 1),
        pr as (select pf.prefix, prefix_norm, se.* from pf join se on split_part(prefix_norm, ' ', 1) = split_part(norm, ' ', 1) where prefix_norm <> '' and active and not dormant),
        sh as (select pr.prefix, company_number, sum(weight) as s from pr join pt on pt.prefix = pr.prefix join cw on cw.id = pr.company_number and cw.word = pt.word group by 1, 2),
        sc as (select pr.prefix, pr.company_number, title, case when prefix_norm = norm then 1.0 when coalesce(s, 0) > 0 then round(s / (pa.total + ca.total - s), 12) else 0.0 end as score
               from pr join pa on pa.prefix = pr.prefix join ca on ca.id = pr.company_number left join sh on sh.prefix = pr.prefix and sh.company_number = pr.company_number),
        bs as (select *, row_number() over (partition by prefix order by score desc, company_number) as rn from sc where score >= 0.9)
        select prefix, company_number, title, round(score, 9) as score from bs where rn = 1""")
def m12_accept_search_results(v):
    first = lambda norm: F.substring_index(norm, " ", 1)
    pf = resolve.distinct_prefixes(v("inserts")).where("prefix_norm <> ''").select("prefix", first(c("prefix_norm")).alias("block"))
    found = searched(v).select(c("company_name").alias("title"), "company_number", "company_status", "sic_codes", first(t.company_name_norm(c("company_name"))).alias("block"))
    return resolve.accept_search_results(pf.join(found, "block").drop("block"), idf(v)).withColumn("score", F.round("score", 9))


@query("""select entity_id, insert_date from {inserts} where entity_id % 4 <> 0 or (entity_id % 8 = 0 and date '2024-01-25' - insert_date <= 90)""")
def m13_events_to_match(v):
    inserts = v("inserts")
    done = inserts.where("entity_id % 4 = 0")
    labels = done.select("entity_id", "insert_date", F.when(c("entity_id") % 8 == 0, "UNKNOWN").otherwise("NEW_VENUE").alias("classification"))
    return resolve.events_to_match(inserts, done, labels, date("2024-01-25")).select("entity_id", "insert_date")


K1_SQL = """k1 as (select e.entity_id, p.entity_id as predecessor_id, p.last_seen_date as predecessor_last_seen,
             row_number() over (partition by e.entity_id order by p.last_seen_date desc, p.entity_id) as rn
             from {spells} e join {spells} p on upper(trim(e.address_line_1)) = upper(trim(p.address_line_1)) and upper(trim(e.postcode)) = upper(trim(p.postcode)) and e.entity_id <> p.entity_id and p.last_seen_date < e.first_seen_date)"""


@query(f"with {K1_SQL} select entity_id, predecessor_id, predecessor_last_seen from k1 where rn = 1")
def k1_predecessor_exact(v):
    return classify.predecessor_exact(v("spells"), v("spells")).select("entity_id", "predecessor_id", "predecessor_last_seen")


@query(f"""with {IDF}, {K1_SQL}, nm as (select distinct business_name, {norm('business_name')} as norm from {{spells}}),
        nw as (select norm, word, coalesce(weight, (select max(weight) from idf)) as weight from (select distinct norm, unnest(string_split(norm, ' ')) as word from nm where norm <> '') x left join idf using (word)),
        na as (select norm, sum(weight) as total from nw group by 1),
        sh as (select x.norm as a, y.norm as b, sum(x.weight) as s from nw x join nw y on x.word = y.word group by 1, 2),
        sim as (select a, b, case when a = b then 1.0 else round(s / (ta.total + tb.total - s), 12) end as sim from sh join na ta on ta.norm = a join na tb on tb.norm = b where s > 0 or a = b),
        near as (select n.business_name as mine, m.business_name as other, sim from sim join nm n on n.norm = a join nm m on m.norm = b where sim >= 0.9),
        f as (select e.entity_id, p.entity_id as predecessor_id, row_number() over (partition by e.entity_id order by sim desc, p.last_seen_date desc, p.entity_id) as rn
              from {{spells}} e join near on mine = e.business_name join {{spells}} p on p.business_name = other and upper(trim(e.postcode)) = upper(trim(p.postcode)) and e.entity_id <> p.entity_id and p.last_seen_date < e.first_seen_date
              where e.entity_id not in (select entity_id from k1))
        select entity_id, predecessor_id from f where rn = 1""")
def k2_predecessor_fallback(v):
    """All spells, at the operator's own score."""
    exact = settled(classify.predecessor_exact(v("spells"), v("spells")))
    return classify.predecessor_fallback(v("spells"), v("spells"), idf(v), exact).select("entity_id", "predecessor_id")


FEED_MATCH = "fm as (select entity_id, insert_date, business_name, first_seen_date, evidence_company_number as best_company_number, case when entity_id % 3 = 0 then 0.5 else 0.8 end as best_score from {feed} where evidence_company_number is not null)"


def feed_matches(v):
    rows = v("feed").where("evidence_company_number is not null")
    return rows.select("entity_id", "insert_date", "business_name", "first_seen_date", c("evidence_company_number").alias("best_company_number"), F.when(c("entity_id") % 3 == 0, 0.5).otherwise(0.8).alias("best_score"))


@query(f"with {FEED_MATCH}, x as (select a.entity_id, b.entity_id as existing_operator_id, row_number() over (partition by a.entity_id order by b.first_seen_date, b.entity_id) as rn from fm a join fm b on a.best_company_number = b.best_company_number and b.best_score >= 0.6 and a.entity_id <> b.entity_id and b.first_seen_date < a.first_seen_date) select entity_id, existing_operator_id from x where rn = 1")
def k3_existing_operator(v):
    return classify.existing_operator(feed_matches(v)).select("entity_id", "existing_operator_id")


@query(f"with {FEED_MATCH} select best_company_number, cast(count(*) as bigint) as operator_venues from fm where best_score >= 0.6 group by 1")
def k4_operator_venue_count(v):
    return classify.operator_venue_count(feed_matches(v))


@query("""select k, case when day_text in ('2024-03-01', '2023-12-31') then date '2024-06-15' - cast(day_text as date) between 0 and 180 end as recent,
          coalesce(case when day_text in ('2024-03-01', '2023-12-31') then cast(day_text as date) - date '2024-01-15' between 1 and 90 end, false) as late from {strings}""".replace("case when day_text in ('2024-03-01', '2023-12-31') then", "case when day_text in ('2024-03-01', '2023-12-31') then"))
def k5_k6_incorporation(v):
    day = lambda x: F.lit(x).cast("date")
    made = t.iso_date(c("day_text"))
    return v("strings").select("k", classify.recently_incorporated(made, day("2024-06-15")).alias("recent"), classify.incorporated_late(made, day("2024-01-15")).alias("late"))


@query(f"with {DISTRICT} select entity_id, insert_date, company_number, (round(raw, 4) >= 0.6 or (amatch and not dense)) as corroborating from rk where rank <= 5")
def k7_is_corroborating(v):
    ok = classify.is_corroborating(c("name_similarity_score"), c("address_matches_establishment"), c("is_high_density_address"))
    return district(v).select("entity_id", "insert_date", "company_number", ok.alias("corroborating"))


@query(f"select k, case when {norm('name')} <> '' and {norm('line')} <> '' then {norm('name')} = {norm('line')} or (length({norm('name')}) >= 4 and length({norm('line')}) >= 4 and levenshtein({norm('name')}, {norm('line')}) <= 2) end as same from {{strings}}")
def k8_predecessor_name_match(v):
    a, b = (t.company_name_norm(c(x)) for x in ("name", "line"))
    return v("strings").select("k", classify.predecessor_name_match(a, b, F.lit(0.0)).alias("same"))


#: CTE lb: the classified events of the registers.
LABELLED = f"""{MERGED}, {IDF},
        mt as (select i.entity_id, i.insert_date, i.business_name, i.first_seen_date, b.company_number as best_company_number, b.name_similarity_score as best_score
               from {{inserts}} i left join (select * from mg where rank = 1) b on b.entity_id = i.entity_id and b.insert_date = i.insert_date),
        ve as (select best_company_number, cast(count(*) as bigint) as operator_venues from mt where best_score >= 0.6 group by 1),
        eo as (select a.entity_id, b.entity_id as existing_operator_id, b.business_name as existing_operator_name, row_number() over (partition by a.entity_id order by b.first_seen_date, b.entity_id, b.business_name) as rn
               from mt a join mt b on a.best_company_number = b.best_company_number and b.best_score >= 0.6 and a.entity_id <> b.entity_id and b.first_seen_date < a.first_seen_date),
        px as (select e.entity_id, p.entity_id as pid, p.business_name as pname, p.first_seen_date as pfirst, p.last_seen_date as plast, row_number() over (partition by e.entity_id order by p.last_seen_date desc, p.entity_id) as rn
               from {{inserts}} e join {{entities}} p on upper(trim(e.address_line_1)) = upper(trim(p.address_line_1)) and upper(trim(e.postcode)) = upper(trim(p.postcode)) and e.entity_id <> p.entity_id and p.last_seen_date < e.first_seen_date),
        nm as (select business_name, {norm("business_name")} as norm from (select business_name from {{inserts}} union select business_name from {{entities}}) x),
        nw as (select norm, word, coalesce(weight, (select max(weight) from idf)) as weight from (select distinct norm, unnest(string_split(norm, ' ')) as word from nm where norm <> '') x left join idf using (word)),
        na as (select norm, sum(weight) as total from nw group by 1),
        fp as (select e.entity_id, n.norm as a, p.entity_id as pid, m.norm as b, p.business_name as pname, p.first_seen_date as pfirst, p.last_seen_date as plast
               from {{inserts}} e join nm n on n.business_name = e.business_name join {{entities}} p on upper(trim(e.postcode)) = upper(trim(p.postcode)) and e.entity_id <> p.entity_id and p.last_seen_date < e.first_seen_date
               join nm m on m.business_name = p.business_name where e.entity_id not in (select entity_id from px)),
        pp as (select distinct a, b from fp union select n.norm, m.norm from {{inserts}} e join nm n on n.business_name = e.business_name join px on px.entity_id = e.entity_id and rn = 1 join nm m on m.business_name = px.pname),
        ps as (select a, b, sum(x.weight) as s from pp join nw x on x.norm = a join nw y on y.norm = b and y.word = x.word group by 1, 2),
        sim as (select pp.a, pp.b, case when pp.a = '' or pp.b = '' then 0.0 when pp.a = pp.b then 1.0 when coalesce(s, 0) > 0 then round(s / (ta.total + tb.total - s), 12) else 0.0 end as sim
                from pp left join ps on ps.a = pp.a and ps.b = pp.b left join na ta on ta.norm = pp.a left join na tb on tb.norm = pp.b),
        fb as (select fp.*, row_number() over (partition by entity_id order by sim desc, plast desc, pid) as rn from fp join sim on sim.a = fp.a and sim.b = fp.b where sim >= 0.9),
        bf as (select entity_id, pid, pname, pfirst, plast from px where rn = 1 union all select entity_id, pid, pname, pfirst, plast from fb where rn = 1),
        al as (select i.*, bf.pid, bf.pname, bf.pfirst, bf.plast, b.* exclude (entity_id, insert_date, rank), (select count(*) from mg where mg.entity_id = i.entity_id) as found, eo.existing_operator_id, eo.existing_operator_name, ve.operator_venues, n.norm as na, m.norm as nb, sim.sim
               from {{inserts}} i left join bf on bf.entity_id = i.entity_id left join (select * from mg where rank = 1) b on b.entity_id = i.entity_id left join (select * from eo where rn = 1) eo on eo.entity_id = i.entity_id
               left join ve on ve.best_company_number = b.company_number join nm n on n.business_name = i.business_name left join nm m on m.business_name = bf.pname left join sim on sim.a = n.norm and sim.b = m.norm),
        ju as (select *, pid is not null as old, coalesce(name_similarity_score >= 0.6 or (address_matches_establishment and not is_high_density_address), false) as supported,
                      coalesce(date_of_creation - first_seen_date between 1 and 90, false) as late, first_seen_date - date_of_creation between 0 and 180 as young, coalesce(operator_venues, 0) >= 5 as many,
                      case when na <> '' and coalesce(nb, '') <> '' then na = nb or sim >= 0.9 or (length(na) >= 4 and length(nb) >= 4 and levenshtein(na, nb) <= 2) end as same,
                      'company "' || company_name || '" (' || company_number || '), similarity ' || printf('%.4f', name_similarity_score) as company, coalesce(address_matches_establishment, false) as amatch,
                      coalesce(cast(date_of_creation as varchar), 'at an unknown date') as made from al),
        gr as (select *, late or coalesce(young, false) or existing_operator_id is not null as fresh, coalesce(same, false) and not supported as kept_name,
                      case when (is_high_density_address and (name_similarity_score < 0.85 or name_similarity_score < 0.95)) or many then 'LOW' when name_similarity_score < 0.85 or late then 'MEDIUM' else 'HIGH' end as grade from ju),
        lb as (select entity_id, insert_date, publisher, case when old then 'OPERATOR_CHANGE' when supported and fresh then 'NEW_VENUE' else 'UNKNOWN' end as classification,
                      case when old then case when kept_name then 'MEDIUM' else 'HIGH' end when supported and fresh then grade else 'LOW' end as confidence,
                      case when old then 'Another record, "' || pname || '" (' || cast(pid as varchar) || '), stood at this address from ' || cast(pfirst as varchar) || ' to ' || cast(plast as varchar) || '.'
                                || case when supported then ' Supported by ' || company || '.' || case when amatch then ' Registered address is an exact match for this establishment''s address.' else '' end else '' end
                                || case when kept_name then ' The name stayed nearly the same and no company supports a change; it may be the same business under a new id.' else '' end
                           when supported and not fresh then 'Matched ' || company || case when amatch then ' (qualified via exact registered-address match)' else '' end || ', created ' || made || '; neither recent nor known to run another venue.'
                           when supported then 'Matched ' || company || ', created ' || made || ', by ' || match_strategy || ' search.' || case when late then ' The company is younger than the record.' else '' end
                                || case when is_high_density_address then ' ' || cast(address_company_count as varchar) || ' companies share the registered address; address isn''t corroborating.' when amatch then ' Registered address is an exact match for this establishment''s address.' else '' end
                                || case when many then ' The company runs ' || cast(operator_venues as varchar) || ' venues.' when existing_operator_id is not null then ' The company already runs "' || existing_operator_name || '" (' || cast(existing_operator_id as varchar) || ').' else '' end
                           when coalesce(postcode, '') = '' then 'No postcode, so no company search.' when found = 0 then 'No company found by district or name.' else 'Closest was ' || company || '; too far.' end as reason,
                      case when supported then company_number end as evidence_company_number, pid as evidence_predecessor_id, case when not old and supported and fresh then existing_operator_id end as evidence_existing_operator_id,
                      case when supported then case when old then young when late then true else young end end as recently_incorporated, case when old then same end as predecessor_name_match from gr)"""


@query(f"with {LABELLED} select * from lb")
def k9_classify(v):
    return labelled(v)


@query("select entity_id from {feed} where classification = 'UNKNOWN' and insert_date >= date '1998-01-01' - 90")
def k10_recheck_unknown(v):
    return classify.recheck_unknown(v("feed"), F.lit("1998-01-01").cast("date")).select("entity_id")


@query("select entity_id, confidence, classification from {feed} where confidence = 'MEDIUM' and classification <> 'UNKNOWN'")
def k11_review_queue(v):
    return classify.review_queue(v("feed")).select("entity_id", "confidence", "classification")


@query("select classification, confidence, cast(count(*) as bigint) as n from {feed} group by 1, 2")
def k12_class_counts(v):
    return classify.class_counts(v("feed"))


TARGETS = "tg as (select entity_id, insert_date, evidence_company_number as company_number, first_seen_date from {feed} where classification = 'OPERATOR_CHANGE' and evidence_company_number is not null and entity_id % 7 <> 0)"


def targets(v):
    rows = v("feed")
    return classify.churn_targets(rows.drop("first_seen_date"), rows, rows.where("entity_id % 7 = 0"))


@query(f"with {TARGETS} select entity_id, company_number from tg")
def k13_churn_targets(v):
    return targets(v).select("entity_id", "company_number")


@query(f"""with {TARGETS}, ap as (select lpad(cast(s_suppkey % 100 as varchar), 8, '0') as company_number, date '1995-06-01' + cast(s_suppkey * 7 as int) as a, case when s_suppkey % 3 = 0 then date '1996-06-01' + cast(s_suppkey * 5 as int) end as r from {{supplier}})
        select tg.entity_id, cast(count(ap.company_number) as bigint) as appointments, coalesce(bool_or(abs(a - first_seen_date) <= 60), false) as started_near, coalesce(bool_or(abs(r - first_seen_date) <= 60), false) as ended_near from tg left join ap using (company_number) group by 1""")
def k14_churn_signal(v):
    s = c("s_suppkey")
    ap = v("supplier").select(
        F.lpad((s % 100).cast("string"), 8, "0").alias("company_number"), F.date_add(F.lit("1995-06-01").cast("date"), (s * 7).cast("int")).cast("string").alias("appointed_on"),
        F.when(s % 3 == 0, F.date_add(F.lit("1996-06-01").cast("date"), (s * 5).cast("int")).cast("string")).alias("resigned_on"),
    )
    return classify.churn_signal(targets(v), ap).select("entity_id", "appointments", "started_near", "ended_near")


def unfilled(v):
    """Entities as enrichment takes them: some without a postcode, some looked up before."""
    k = c("entity_id")
    return v("feed").select("entity_id", "publisher", "post_code", "postcode_live", F.when(k % 2 == 0, F.date_sub(F.lit("1998-01-01").cast("date"), (k % 60).cast("int"))).alias("postcode_checked_at"))


def looked_up(v):
    return v("feed").where("entity_id % 4 <> 3").select("entity_id", F.when(c("entity_id") % 4 == 0, F.concat(F.lit("D"), (c("entity_id") % 10).cast("string"))).alias("post_code"))


@query("select entity_id from {feed} where post_code is null and (entity_id % 2 <> 0 or entity_id % 60 >= 30)")
def e1_backfill_candidates(v):
    return enrich.backfill_candidates(unfilled(v), date("1998-01-01")).select("entity_id")


@query("""select entity_id, case when post_code is null and entity_id % 4 = 0 then 'D' || cast(entity_id % 10 as varchar) else postcode_live end as postcode_live,
          case when post_code is null and entity_id % 4 <> 3 then date '1998-01-01' when entity_id % 2 = 0 then date '1998-01-01' - cast(entity_id % 60 as int) end as postcode_checked_at from {feed}""")
def e2_apply_backfill(v):
    return enrich.apply_backfill(unfilled(v), looked_up(v), date("1998-01-01")).select("entity_id", "postcode_live", "postcode_checked_at")


@query("select entity_id, case when post_code is not null then 'bulk' when postcode_live is not null then 'live_api' end as source from {feed}")
def e3_postcode_source(v):
    return v("feed").select("entity_id", enrich.postcode_source(c("post_code"), c("postcode_live")).alias("source"))


@query("select publisher, cast(count(*) as bigint) as checked, cast(sum(case when entity_id % 4 = 0 then 1 else 0 end) as bigint) as resolved, 'ok' as status from {feed} where post_code is null and entity_id % 4 <> 3 group by 1")
def e4_backfill_runs(v):
    return enrich.backfill_runs(unfilled(v), looked_up(v))[0]
