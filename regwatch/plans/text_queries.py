"""Queries of the scalar functions (N1-N26), each over hand-made cases, all customers and parts, and all words of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators.resolve import spread
from .registry import query

c = F.col
PC = "replace(upper(trim(postcode)), ' ', '')"
DISTRICT = f"""case when length({PC}) between 5 and 7 then case when regexp_matches({PC}, '^[A-Z].*[0-9][A-Z][A-Z]$') then left({PC}, length({PC}) - 3) end
               when regexp_matches({PC}, '^[A-Z][A-Z]?[0-9][A-Z0-9]?$') then {PC} end"""
NORM = r"trim(regexp_replace(trim(regexp_replace(regexp_replace(replace(upper(coalesce(@, '')), '&', ' AND '), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), '( ?\b(LIMITED|LTD|LLP|PLC|CIC|LP|UNLIMITED))+$', ''))"
COMPLETE = "case when length(replace(coalesce(postcode, ''), ' ', '')) = 0 then 'none' when length(replace(coalesce(postcode, ''), ' ', '')) < 5 then 'district_only' else 'full' end"


def one(v, **made):
    return v("strings").select("k", *(x.alias(n) for n, x in made.items()))


def sql(expr: str) -> str:
    return f"select k, {expr} as out from {{strings}}"


@query(sql(DISTRICT))
def n1_postcode_district(v):
    return one(v, out=t.postcode_district(c("postcode")))


@query(sql(f"nullif(regexp_extract({DISTRICT}, '^[A-Z]+'), '')"))
def n2_postcode_area(v):
    return one(v, out=t.postcode_area(c("postcode")))


@query(sql(NORM.replace("@", "name")))
def n3_company_name_norm(v):
    return one(v, out=t.company_name_norm(c("name")))


@query(sql("regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]', '', 'g')"))
def n4_squash(v):
    return one(v, out=t.squash(c("name")))


@query(sql(r"regexp_replace(lower(coalesce(name, '')), '[^\p{{L}}\p{{N}}]', '', 'g')"))
def n5_overlap_key(v):
    return one(v, out=t.overlap_key(c("name")))


@query(sql(r"regexp_replace(regexp_replace(regexp_replace(replace(lower(coalesce(name, '')), '&', ' and '), '[à-ÿ]', 'Z', 'g'), '\b(and|the|ltd|limited|plc|llp|co|company|uk)\b', ' ', 'g'), '[^a-z0-9]', '', 'g')"))
def n6_squash_name(v):
    return one(v, out=t.squash_name(c("name")))


@query(sql("case when trim(line) <> '' and trim(postcode) <> '' then upper(trim(line)) || '|' || upper(trim(postcode)) end"))
def n7_address_key(v):
    return one(v, out=t.address_key(c("line"), c("postcode")))


@query(sql("upper(trim(coalesce(line, ''))) || '|' || upper(trim(coalesce(postcode, '')))"))
def n8_address_density_key(v):
    return one(v, out=t.address_density_key(c("line"), c("postcode")))


@query(sql("case when strpos(name, '@') > 0 then nullif(trim(split_part(name, '@', 1)), '') end"))
def n9_operator_prefix(v):
    return one(v, out=t.operator_prefix(c("name")))


@query(sql(f"strpos({NORM.replace('@', 'name')}, ' ') > 0"))
def n10_is_multi_word(v):
    return one(v, out=t.is_multi_word(c("name")))


@query(sql("concat_ws(', ', nullif(line, ''), nullif(postcode, ''))"))
def n11_join_address(v):
    return one(v, out=t.join_address(c("line"), c("postcode")))


@query(sql(COMPLETE))
def n12_postcode_completeness(v):
    return one(v, out=t.postcode_completeness(c("postcode")))


@query(sql(f"case {COMPLETE} when 'none' then 'no_address' when 'district_only' then 'district_only' else case when coalesce(line, '') <> '' then 'full' else 'postcode_only' end end"))
def n13_address_completeness(v):
    return one(v, out=t.address_completeness([c("line")], c("postcode")))


@query(sql("case when rating in ('0','1','2','3','4','5','Pass','Pass and Eat Safe','Improvement Required') then 'Rated' when lower(replace(rating, ' ', '')) = 'awaitinginspection' then 'Awaiting Inspection' when lower(replace(rating, ' ', '')) = 'awaitingpublication' then 'Awaiting Publication' when lower(replace(rating, ' ', '')) = 'exempt' then 'Exempt' else 'Unknown' end"))
def n14_rating_status(v):
    return one(v, out=t.rating_status(c("rating")))


@query(sql(r"cast(date_diff('day', case when regexp_matches(day_text, '^\d\d\d\d-\d\d-\d\d$') then try_cast(day_text as date) end, date '2024-06-01') as int)"))
def n15_days_since(v):
    return one(v, out=t.days_since(t.iso_date(c("day_text")), F.lit("2024-06-01").cast("date")))


@query("""select k, 'https://ratings.food.gov.uk/business/' || k as entity, case when coalesce(postcode, '') <> '' then 'https://find-and-update.company-information.service.gov.uk/company/' || postcode else '' end as company,
          case when concat_ws(', ', nullif(line, ''), nullif(postcode, '')) <> '' then 'https://www.google.com/maps/search/?api=1&query=' || replace(replace(url_encode(concat_ws(', ', nullif(line, ''), nullif(postcode, ''))), '%2F', '/'), '%7E', '~') else '' end as map from {strings}""")
def n16_links(v):
    return one(v, entity=t.entity_url(c("k")), company=t.company_url(c("postcode")), map=t.map_url(c("line"), c("postcode")))


@query(sql("case when starts_with(k, 'case ') then case codes when '[\"56101\",\"10710\"]' then '56101, 10710' when '[\"1\"]' then '1' else '' end when starts_with(k, 'part ') then replace(codes[3:-3], '\",\"', ', ') else '' end"))
def n17_format_codes(v):
    return one(v, out=t.format_codes(c("codes")))


STRIPPED = r"regexp_replace(coalesce(@, ''), '^\s+|\s+$', '', 'g')"


def stripped(x: str) -> str:
    return STRIPPED.replace("@", x)


def tidy(y: str) -> str:
    """Title case of names in capitals, letter by letter, small words lower except the first."""
    x = stripped(y)
    title = f"list_aggregate(list_transform(range(1, length({x}) + 1), lambda i: case when i = 1 or not regexp_matches(substr({x}, i - 1, 1), '\\p{{{{L}}}}') then upper(substr({x}, i, 1)) else lower(substr({x}, i, 1)) end), 'string_agg', '')"
    small = ", ".join(f"'{w}'" for w in t.SMALL_WORDS)
    words = f"list_aggregate(list_transform(string_split({title}, ' '), lambda w, k: case when k > 1 and lower(w) in ({small}) then lower(w) else w end), 'string_agg', ' ')"
    return f"case when length({x}) > 3 and {x} = upper({x}) and regexp_matches({x}, '\\p{{{{L}}}}') then {words} else {x} end"


@query(sql(tidy("name")))
def n18_tidy_name(v):
    return one(v, out=t.tidy_name(c("name")))


@query("select entity_id, case business_type when 'Restaurant/Cafe/Canteen' then 'Cafe / restaurant' when 'Pub/bar/nightclub' then 'Pub / bar' when 'Takeaway/sandwich shop' then 'Takeaway' else business_type end as out from {feed}")
def n19_premises_label(v):
    return v("feed").select("entity_id", t.premises_label(c("business_type")).alias("out"))


@query(sql(r"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(line, ''))), '^the ', ''), '[.,]', '', 'g'), '\s+', ' ', 'g'))"))
def n20_place_norm(v):
    return one(v, out=t.place_norm(c("line")))


@query(sql(f"trim(translate(lower(coalesce(name, '')), '{t.ACCENTED}', '{t._plain(t.ACCENTED)}'), ' ,.')"))
def n21_fold_accents(v):
    return one(v, out=t.fold_accents(c("name")))


CLEAN = f"""td as (select k, {tidy("name")} as x from {{strings}}), sl as (select k, x, list_filter(list_transform(string_split(x, '/'), lambda p: {stripped("p")}), lambda p: p <> '') as h from td),
        cl as (select k, case when len(h) = 2 and contains(lower(h[1]), lower(h[2])) then h[1] else x end as out from sl)"""
STREET = rf"(regexp_matches(lower(@), '^\s*[0-9]+[a-z]?\b') or regexp_matches(' ' || lower(@) || ' ', ' ({'|'.join(t.STREET_WORDS)})'))"
FOLD = f"trim(translate(lower(coalesce(@, '')), '{t.ACCENTED}', '{t._plain(t.ACCENTED)}'), ' ,.')"
fold, street = (lambda x: FOLD.replace("@", x)), (lambda x: STREET.replace("@", x))


@query(f"with {CLEAN} select k, out from cl")
def n22_clean_name(v):
    return one(v, out=t.clean_name(c("name")))


@query(sql(street("coalesce(line, '')")))
def n23_looks_like_street(v):
    return one(v, out=t.looks_like_street(c("line")))


#: Lines, council and postcode of n24: the council stands in the lines with and without brackets, and so do a county, the name and the postcode.
LINES = ["line", "case when length(line) % 2 = 0 then 'Old Mill' when length(line) % 5 = 0 then name end", "case length(coalesce(line, '')) % 4 when 0 then 'ayton,' when 1 then 'Kent' when 2 then 'Ayton (City of) ' || coalesce(postcode, '') end", "postcode"]


@query(f"""with {CLEAN}, ls as (select k, {stripped("postcode")} as code, [{", ".join(stripped(x) for x in LINES)}] as lines from {{strings}}),
        la as (select k, code, list_filter(list_transform(lines, lambda x: case when code <> '' and x <> '' then trim(regexp_replace(x, regexp_escape(code), '', 'gi'), ' ,') else x end), lambda x: x <> '') as l from ls),
        ln as (select k, code, cl.out as name, list_filter(l, lambda x: {fold("x")} <> {fold("cl.out")}) as l from la join cl using (k)),
        lc as (select k, code, name, list_bool_or(list_transform(l, lambda x: trim(lower(x), ' ,') in ('ayton (city of)', 'ayton'))) as seen,
                      list_transform(list_filter(l, lambda x: trim(lower(x), ' ,') not in ('ayton (city of)', 'ayton', {", ".join(f"'{x}'" for x in t.COUNTIES)})), lambda x: {tidy("x")}) as l from ln),
        lp as (select *, list_max(list_filter(range(1, len(l) + 1), lambda i: not {street("l[i]")})) as p from lc),
        lt as (select *, case when p > 1 or len(l) = 1 then p end as spot from lp),
        lu as (select *, case when spot is null then l else l[1:spot - 1] end as s from lt)
        select k, name, case when length(array_to_string(s, ', ')) > 42 then s[-1] else coalesce(array_to_string(s, ', '), '') end as street, case when spot is not null then l[spot] when seen then 'Ayton' else '' end as town, code as postcode from lu""")
def n24_address_parts(v):
    parts = t.address_parts(c("name"), [F.expr(x) for x in LINES], F.lit("Ayton (City of)"), c("postcode"))
    # Few bytes, much work for each row: a file of the tables can be one task.
    return spread(v("strings"), "k").select("k", parts.alias("p")).select("k", "p.*")


@query("select k, coalesce(nullif(postcode, ''), nullif(rating, '')) as bulk_first, coalesce(nullif(rating, ''), nullif(postcode, '')) as live_first from {strings}")
def n25_effective_postcode(v):
    return one(v, bulk_first=t.effective_postcode(c("postcode"), c("rating")), live_first=t.effective_postcode(c("postcode"), c("rating"), "live"))


@query("select k, levenshtein(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]', '', 'g'), regexp_replace(lower(coalesce(line, '')), '[^a-z0-9]', '', 'g')) <= 9 as close from {strings}")
def n26_edit_distance(v):
    return one(v, close=t.edit_distance_within(t.squash(c("name")), t.squash(c("line")), 9))
