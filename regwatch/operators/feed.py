"""Feed, audience filter and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .resolve import EVENT

# Types, stems and words that results must agree on.
NOISE_TYPES = ("School/college/university", "Hospitals/Childcare/Caring Premises", "Manufacturers/packers", "Distributors/Transporters", "Farmers/growers", "Importers/Exporters")
CORE = ("Restaurant/Cafe/Canteen", "Pub/bar/nightclub", "Hotel/bed & breakfast/guest house", "Other catering premises")
WIDE = (*CORE, "Takeaway/sandwich shop", "Retailers - other", "Retailers - supermarkets/hypermarkets", "Mobile caterer")
AUDIENCES = {"roaster": CORE, "broker": (*CORE, "Takeaway/sandwich shop"), "waste": WIDE, "all": WIDE}
CHAIN_STEMS = (
    "greggs", "wagamama", "pizzaexpress", "mcdonald", "costacoffee", "starbucks", "papajohn", "burgerking", "nandos", "pretamanger", "caffenero", "cafenero", "fiveguys",
    "sainsbury", "morrison", "waitrose", "marksandspencer", "greeneking", "marstons", "wetherspoon", "premierinn", "travelodge", "holidayinn", "marriott", "tobycarvery",
    "harvester", "beefeater", "brewersfayre", "bellaitalia", "askitalian", "frankieandbennys", "chiquito", "pizzahut", "compassgroup", "aramark", "sodexo", "chartwells",
    "caterlink", "allianceinpartnership", "costcutter", "mccoll",
)
CHAIN_WORDS = ("tesco", "asda", "aldi", "lidl", "spar", "londis", "nisa", "budgens", "one stop", "subway", "kfc", "itsu", "wasabi", "zizzi", "elior", "hilton", "costa", "dominos")
INSTITUTIONS = ("school", "college", "academy", "primary", "secondary", "nursery", "university", "hospital", "prison", "hmp", "barracks", "care home", "nursing home")
CORROBORATED = ("registered address is an exact match for this establishment's address", "qualified via exact registered-address match")
NOT_CORROBORATED = "address isn't corroborat"
SOLD = ("NEW_VENUE", "OPERATOR_CHANGE")
REASONS = ("outside territory", "unclassified", "venue type", "incomplete address", "chain", "institution", "re-issue")
LINES = tuple(f"address_line_{k}" for k in range(1, 5))
# The feed's column names, in their order.
FEED = (
    "fhrsid", "business_name", "address", "postcode", "postcode_source", "address_completeness", "google_maps_url", "authority_name",
    "authority_extract_date", "business_type", "rating_status", "first_seen_date", "days_since_first_seen", "batch_publication", "classification",
    "confidence", "reason", "reason_detail", "previous_business_name", "previous_fhrsid", "previous_last_seen", "match_status", "company_name",
    "company_number", "company_status", "incorporation_date", "sic_codes", "companies_house_url", "fhrs_url",
)

# What a customer is told about a record; results must agree on it.
SAID = {
    "new": "New registration.",
    "new with company": 'New registration, matched to Companies House company "%s".',
    "change": "Operator change.",
    "change of name": 'Operator change -- this address previously traded as "%s".',
    "change of the same name": "Possible operator change -- kept the same trading name as the previous record; not company-confirmed.",
    "other": "No confirmed company match.",
    "other with company": 'Matched to Companies House company "%s", but not confirmed as a new registration.',
}


def feed_records(classifications: DataFrame, events: DataFrame, entities: DataFrame, publishers: DataFrame, diff_runs: DataFrame, runs: DataFrame, companies: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Classified INSERTs with all that is known of them; quarantined ones, closed or nameless entities go.

    events carry entity_id, insert_date and quarantined; the publisher's latest good extract date comes by a group-by.
    """
    c = F.col
    extract = runs.where("status = 'ok'").groupBy("publisher").agg(F.max("extract_date").alias("authority_extract_date"))
    rows = classifications.drop("publisher").join(entities, "entity_id").join(publishers.select("publisher", c("name").alias("authority_name")), "publisher")
    rows = rows.join(events.where("not quarantined").select(*EVENT), list(EVENT)).where(~F.coalesce(c("business_name").ilike("%closed%"), F.lit(True)))
    if since is not None:
        rows = rows.where(c("first_seen_date") >= since)
    if until is not None:
        rows = rows.where(c("first_seen_date") <= until)
    rows = rows.join(extract, "publisher", "left").join(diff_runs.select("publisher", c("collection_date").alias("insert_date"), "batch_publication"), ["publisher", "insert_date"], "left")
    company = companies.select(c("company_number").alias("evidence_company_number"), "company_name", "company_status", c("date_of_creation").alias("incorporation_date"), "sic_codes")
    before = entities.select(c("entity_id").alias("evidence_predecessor_id"), c("business_name").alias("previous_business_name"), c("last_seen_date").alias("previous_last_seen"))
    return rows.join(company, "evidence_company_number", "left").join(before, "evidence_predecessor_id", "left")


def filter_feed(records: DataFrame, area: str | None = None, publisher: str | None = None, business_type: str | None = None, label: str | None = None) -> DataFrame:
    c = F.col
    rows = records
    if area:
        rows = rows.where(t.postcode_area(c("post_code")) == area.upper())
    if publisher:
        rows = rows.where((c("publisher") == publisher) | F.contains(F.lower("authority_name"), F.lit(publisher.lower())))
    if business_type:
        rows = rows.where(F.contains(F.lower("business_type"), F.lit(business_type.lower())))
    return rows.where(c("classification") == label) if label else rows


def is_noise_type(c: Column) -> Column:
    return F.coalesce(c.isin(*NOISE_TYPES), F.lit(False))


def customer_reason() -> Column:
    """What SAID has for a record's label and evidence."""
    c = F.col
    new, change = c("classification") == "NEW_VENUE", c("classification") == "OPERATOR_CHANGE"
    known = lambda name: t.text(c(name)) != ""
    said = lambda key, name=None: F.lit(SAID[key]) if name is None else F.format_string(SAID[key], t.text(c(name)))
    return (
        F.when(new & known("company_name"), said("new with company", "company_name"))
        .when(new, said("new"))
        .when(change & known("previous_business_name") & c("previous_business_name").eqNullSafe(c("business_name")), said("change of the same name"))
        .when(change & known("previous_business_name"), said("change of name", "previous_business_name"))
        .when(change, said("change"))
        .when(known("evidence_company_number"), said("other with company", "company_name"))
        .otherwise(said("other"))
    )


def build_feed(records: DataFrame, as_of: Column) -> DataFrame:
    """The columns of the feed, all text; absent values are empty."""
    c = F.col
    postcode = t.effective_postcode(c("post_code"), c("postcode_live"))
    address = t.join_address(*(c(x) for x in LINES))
    yes = lambda cond: F.when(cond, "Yes").otherwise("No")
    made = {
        "fhrsid": c("entity_id"), "business_name": c("business_name"), "address": address, "postcode": postcode,
        "postcode_source": F.when(t.text(c("post_code")) != "", "bulk").when(t.text(c("postcode_live")) != "", "live_api"),
        "address_completeness": t.address_completeness([c(x) for x in LINES], postcode), "google_maps_url": t.map_url(address, postcode), "authority_name": c("authority_name"),
        "authority_extract_date": c("authority_extract_date"), "business_type": c("business_type"), "rating_status": t.rating_status(c("rating_value")), "first_seen_date": c("first_seen_date"),
        "days_since_first_seen": t.days_since(c("first_seen_date"), as_of), "batch_publication": yes(F.coalesce(c("batch_publication"), F.lit(False))), "classification": c("classification"),
        "confidence": c("confidence"), "reason": customer_reason(), "reason_detail": c("reason"), "previous_business_name": c("previous_business_name"), "previous_fhrsid": c("evidence_predecessor_id"),
        "previous_last_seen": c("previous_last_seen"), "match_status": yes(t.text(c("evidence_company_number")) != ""), "company_name": c("company_name"), "company_number": c("evidence_company_number"),
        "company_status": c("company_status"), "incorporation_date": c("incorporation_date"), "sic_codes": t.format_codes(c("sic_codes")), "companies_house_url": t.company_url(c("evidence_company_number")),
        "fhrs_url": t.entity_url(c("entity_id")),
    }
    return records.select(*(t.text(made[k].cast("string")).alias(k) for k in FEED))


def is_chain(name: Column, address: Column) -> Column:
    both = F.concat(t.squash(name), t.squash(address))
    spaced = F.regexp_replace(F.lower(t.text(name)), "[^a-z0-9]+", " ")
    return both.rlike("|".join(CHAIN_STEMS)) | F.concat(F.lit(" "), spaced, F.lit(" ")).rlike(f" ({'|'.join(CHAIN_WORDS)}) ")


def is_institution(name: Column, address: Column) -> Column:
    pattern = rf"(?i)\b({'|'.join(INSTITUTIONS)})\b"
    return t.text(name).rlike(pattern) | t.text(address).rlike(pattern)


def company_is_corroborated(reason: Column) -> Column:
    low = F.lower(t.text(reason))
    return t.any_of(low, CORROBORATED) & ~F.contains(low, F.lit(NOT_CORROBORATED))


def is_reissue(label: Column, name: Column, previous: Column) -> Column:
    a, b = t.squash_name(name), t.squash_name(previous)
    return (label == "OPERATOR_CHANGE") & (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def audience_types(spark) -> DataFrame:
    return spark.createDataFrame([(a, x) for a, types in AUDIENCES.items() for x in types], "audience string, business_type string")


def removal_reason(audience: Column | str, inside: Column) -> Column:
    """Why a record is left out, the first reason in their order; null for one that stays."""
    c = F.col
    wanted = audience if isinstance(audience, Column) else F.lit(audience)
    types = F.when(F.lit(False), False)
    for name, values in AUDIENCES.items():
        types = types.when(wanted == name, c("business_type").isin(*values))
    address = t.join_address(*(c(x) for x in LINES))
    full = t.address_completeness([c(x) for x in LINES], t.effective_postcode(c("post_code"), c("postcode_live"), "live")) == "full"
    tests = (inside, c("classification").isin(*SOLD), types, full, ~is_chain(c("business_name"), address), ~is_institution(c("business_name"), address), ~is_reissue(c("classification"), c("business_name"), c("previous_business_name")))
    out = None
    for reason, passed in zip(REASONS, tests, strict=True):
        failed = ~F.coalesce(passed, F.lit(False))
        out = F.when(failed, reason) if out is None else out.when(failed, reason)
    return out


def filter_waterfall(records: DataFrame, audience: str = "all", publishers: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Records that stay, and the number removed for each of the seven reasons, zeros too."""
    if audience not in AUDIENCES:
        raise ValueError(f"no audience is called {audience!r}; there are {', '.join(AUDIENCES)}")
    inside = F.lit(True) if publishers is None else F.col("authority_name").isin(*publishers)
    judged = records.withColumn("reason_removed", removal_reason(audience, inside))
    every = records.sparkSession.createDataFrame([(r,) for r in REASONS], "reason_removed string")
    counts = every.join(judged.groupBy("reason_removed").agg(F.count("*").alias("removed")), "reason_removed", "left").na.fill(0, ["removed"])
    return judged.where("reason_removed is null").drop("reason_removed"), counts


def report_rows(records: DataFrame) -> DataFrame:
    """Display columns of a report; the company only where its address corroborates it."""
    c = F.col
    sure = company_is_corroborated(c("reason")) & (t.text(c("evidence_company_number")) != "")
    when = lambda cond, x: F.when(cond, x).otherwise("")
    change = c("classification") == "OPERATOR_CHANGE"
    postcode = t.effective_postcode(c("post_code"), c("postcode_live"), "live")
    notes = F.concat_ws("; ", F.when(F.coalesce(c("batch_publication"), F.lit(False)), "published in a batch"), F.when(change & (t.text(c("previous_business_name")) == ""), "previous name unknown"), F.when(c("confidence") != "HIGH", F.concat(F.lower("confidence"), F.lit(" confidence"))))
    return records.select(
        c("entity_id"), t.tidy_name(c("business_name")).alias("venue"), F.when(change, "Change of operator").otherwise("New opening").alias("status"), t.premises_label(c("business_type")).alias("premises"),
        t.join_address(*(c(x) for x in LINES)).alias("address"), t.text(postcode).alias("postcode"), c("authority_name").alias("council"), c("first_seen_date").alias("registered"),
        when(change, t.tidy_name(t.text(c("previous_business_name")))).alias("previously"), when(sure, t.text(c("company_name"))).alias("company"), when(sure, c("evidence_company_number")).alias("company_no"),
        when(sure, t.text(c("incorporation_date").cast("string"))).alias("incorporated"), notes.alias("notes"), t.entity_url(c("entity_id")).alias("link"),
    )


def report_summary(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Totals; the register's entries are those kept and those removed within the territory."""
    a = rows.agg(F.count_if(F.col("status") == "New opening").alias("new"), F.count_if(F.col("status") != "New opening").alias("takeover"), F.count_if(F.col("company") != "").alias("with_company"), F.count("*").alias("kept"))
    b = removed.where("reason_removed <> 'outside territory'").agg(F.sum("removed").alias("__removed"))
    return a.join(F.broadcast(b)).select("new", "takeover", "with_company", (F.col("kept") + F.col("__removed")).alias("register_entries"))


def report_sort(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.coalesce("council", F.lit("")), F.coalesce("venue", F.lit("")), "entity_id")


def feed_stats(records: DataFrame) -> DataFrame:
    label = lambda x: F.count_if(F.col("classification") == x).alias(x.lower())
    return records.agg(F.count("*").alias("total"), *(label(x) for x in ("NEW_VENUE", "OPERATOR_CHANGE", "UNKNOWN")), F.count_if(t.text(F.col("evidence_company_number")) != "").alias("matched"), F.count_if(F.coalesce(F.col("batch_publication"), F.lit(False))).alias("batch"))


def feed_search(records: DataFrame, query: str, sort: str = "business_name") -> DataFrame:
    """Records that hold the query in id, name, postcode, council or company; sorted, null as empty."""
    cols = [F.lower(t.text(F.col(x).cast("string"))) for x in ("entity_id", "business_name", "post_code", "authority_name", "company_name")]
    return records.where(F.contains(F.concat_ws("\n", *cols), F.lit(query.lower()))).orderBy(t.text(F.col(sort).cast("string")), "entity_id")


def audit_ledger(classifications: DataFrame, candidates: DataFrame, truth: DataFrame, top: int = 3) -> DataFrame:
    """Each event with its best candidates as an array in rank order, and its label by hand."""
    best = candidates.where(F.col("rank") <= top).groupBy(*EVENT).agg(F.array_sort(F.collect_list(F.struct("rank", "company_number", "name_similarity_score"))).alias("candidates"))
    # As many rows as there are events: sorted, not sent through the driver.
    return classifications.join(best.hint("merge"), list(EVENT), "left").join(truth, "entity_id", "left")


#: Short keys of a JSON feed and the feed's columns behind them, in their order.
SHORT = {
    "id": "fhrsid", "au": "authority_name", "n": "business_name", "a": "address", "pc": "postcode", "ac": "address_completeness", "bt": "business_type", "rst": "rating_status", "fs": "first_seen_date",
    "cl": "classification", "cf": "confidence", "rs": "reason", "pbn": "previous_business_name", "pls": "previous_last_seen", "ms": "match_status", "bp": "batch_publication", "cnm": "company_name",
    "cn": "company_number", "cst": "company_status", "ic": "incorporation_date", "sic": "sic_codes", "url": "fhrs_url", "gmu": "google_maps_url", "chu": "companies_house_url",
}
STRATEGIES = {"district": "d", "national": "n", "operator-prefix": "op"}


def short_feed(rows: DataFrame) -> DataFrame:
    """Rows of the feed under short keys: the id as a number, the two flags as booleans; an absent batch flag is false."""

    def value(key: str, column: str) -> Column:
        if column not in rows.columns:
            return F.lit(False) if key == "bp" else F.lit(None).cast("string")
        c = F.col(column)
        return F.coalesce(c == "Yes", F.lit(False)) if key in ("ms", "bp") else c.cast("long") if key == "id" else c

    return rows.select(*(value(k, c).alias(k) for k, c in SHORT.items()))


def short_ledger(labels: DataFrame, entities: DataFrame, publishers: DataFrame, candidates: DataFrame, truth: DataFrame, top: int = 3) -> DataFrame:
    """Labelled events under short keys, each with its best candidates as an array in the order of rank (empty if there is
    none) and its label by hand (rmf, rcn, notes; null without one). Unknown stays null in ri and pm; the candidates' flags are
    true or false; a strategy without a code is the district's.

    labels: entity_id, publisher, insert_date and what ``classify`` gives; truth: entity_id, real_match, real_company, notes.
    """
    c = F.col
    code = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in STRATEGIES.items() for x in kv]), c("match_strategy")), F.lit("d"))
    no = F.lit(False)
    one = F.struct(
        "rank", c("company_name").alias("n"), c("company_number").alias("no"), c("name_similarity_score").alias("s"), code.alias("st"), F.coalesce("is_high_density_address", no).alias("hd"),
        F.coalesce("address_matches_establishment", no).alias("am"), c("date_of_creation").alias("dc"),
    )
    best = candidates.where(c("rank") <= top).groupBy(*EVENT).agg(F.array_sort(F.collect_list(one)).alias("__best")).withColumn("__best", F.transform("__best", lambda x: x.dropFields("rank")))
    hand = truth.select("entity_id", F.struct(*(F.trim(t.text(c(x))).alias(k) for k, x in (("rmf", "real_match"), ("rcn", "real_company"), ("notes", "notes")))).alias("gt"))
    known = entities.select("entity_id", "business_name", "address_line_1", t.effective_postcode(c("post_code"), c("postcode_live")).alias("pc"), "first_seen_date")
    rows = labels.select("entity_id", "publisher", "insert_date", "classification", "confidence", "reason", "recently_incorporated", "predecessor_name_match", "evidence_company_number").join(known, "entity_id")
    rows = rows.join(publishers.select("publisher", "name"), "publisher", "left").join(best, list(EVENT), "left").join(hand, "entity_id", "left")
    none = F.array().cast(best.schema["__best"].dataType)
    return rows.select(
        c("entity_id").alias("id"), c("business_name").alias("n"), c("address_line_1").alias("a"), "pc", F.coalesce("name", "publisher").alias("au"), c("first_seen_date").alias("fs"), c("classification").alias("cl"), c("confidence").alias("cf"),
        c("reason").alias("rs"), c("recently_incorporated").alias("ri"), c("predecessor_name_match").alias("pm"), c("evidence_company_number").alias("cn"), F.coalesce("__best", none).alias("cand"), "gt",
    )


def ground_truth_score(ledger: DataFrame) -> DataFrame:
    """How often the evidence names the company that was labelled by hand."""
    known = ledger.where("coalesce(true_company, '') <> ''")
    return known.agg(F.count("*").alias("labelled"), F.count_if(F.col("evidence_company_number") == F.col("true_company")).alias("agree"))

