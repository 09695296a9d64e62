"""Labels for new entities from evidence.

events: entity_id, publisher, insert_date, business_name, address_line_1, postcode, first_seen_date; entities: entity_id,
business_name, address_line_1, postcode, first_seen_date, last_seen_date. Range conditions ride on equal keys, so every
join hashes or sorts. Booleans have three values: null is unknown, never false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import address_key, company_name_norm, edit_distance_within, text
from ..params import DEFAULT, Params
from .resolve import EVENT, bagged, name_bags, name_keys, name_similarity

# Fixed phrases: later stages read whether the address corroborates a company from them.
ADDRESS_MATCH = "registered address is an exact match for this establishment's address"
VIA_ADDRESS = "qualified via exact registered-address match"
NOT_BY_ADDRESS = "address isn't corroborating"


def _prior(entities: DataFrame) -> DataFrame:
    return entities.select(
        F.col("entity_id").alias("predecessor_id"), F.col("business_name").alias("predecessor_name"), F.col("address_line_1").alias("p_line"), F.col("postcode").alias("p_code"),
        F.col("first_seen_date").alias("predecessor_first_seen"), F.col("last_seen_date").alias("predecessor_last_seen"),
    )


PREDECESSOR = ["predecessor_id", "predecessor_name", "predecessor_first_seen", "predecessor_last_seen"]


def _last_other(departures: DataFrame, arrivals: DataFrame, place: list[str]) -> DataFrame:
    """For each arrival (place, on, event) the entity that last left its place before, other than its own, as ``found``.

    An as-of merge: departures and arrivals of a place stand in one order of time, in which an arrival comes before
    the departures of its day, and of those the one of the smallest id last. Two running values go along: the last
    departure, and the last one of another entity than that; an arrival takes the first of them that is not its own.
    """
    merged = departures.withColumn("kind", F.lit(1)).unionByName(arrivals.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy(*place).orderBy("on", "kind", "tie")
    before, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    rows = merged.withColumn("last", F.last("gone", ignorenulls=True).over(before))
    rows = rows.withColumn("turn", F.when(F.col("last.predecessor_id") != F.col("gone.predecessor_id"), F.col("last")))
    rows = rows.withColumn("other", F.last("turn", ignorenulls=True).over(so_far)).where("event is not null")
    return rows.withColumn("found", F.when(F.col("last.predecessor_id") != F.col("event.entity_id"), F.col("last")).otherwise(F.col("other"))).where("found is not null")


def _departures(entities: DataFrame) -> DataFrame:
    """Entities as ``gone``, with the day they were last seen and the place of their id among those of a day."""
    rows = _prior(entities).where("predecessor_last_seen is not null and predecessor_id is not null")
    who = F.struct(F.col("predecessor_id"), F.col("predecessor_name"), F.col("predecessor_first_seen"), F.col("predecessor_last_seen"))
    return rows.withColumns({"on": F.col("predecessor_last_seen"), "tie": -F.col("predecessor_id").cast("decimal(20,0)"), "gone": who})


def _latest() -> Column:
    """Order of predecessors: who left last, of these the least id."""
    return F.struct(F.col("found.predecessor_last_seen").alias("on"), (-F.col("found.predecessor_id").cast("decimal(20,0)")).alias("tie"))


def predecessor_exact(events: DataFrame, entities: DataFrame) -> DataFrame:
    """The entity that last left the event's address before it appeared, if any."""
    at = address_key(F.col("address_line_1"), F.col("postcode"))
    gone = _departures(entities).select(address_key(F.col("p_line"), F.col("p_code")).alias("at"), "on", "tie", "gone").where("at is not null")
    arrivals = events.select(at.alias("at"), F.col("first_seen_date").alias("on"), F.struct(*EVENT).alias("event")).where("on is not null and at is not null")
    return _last_other(gone, arrivals, ["at"]).groupBy("event").agg(F.max_by("found", _latest()).alias("found")).select("event.*", "found.*")


def predecessor_fallback(events: DataFrame, entities: DataFrame, idf: DataFrame, exact: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """For events without an exact predecessor: one of the same postcode whose name scores enough.

    Names are compared, each once in a postcode, and only where they share a key, as all that score enough do. The last
    entity of each such name that left before the event then comes from an as-of merge, not from pairs of rows.
    """
    code = lambda c: F.when(F.trim(c) != "", F.upper(F.trim(c)))
    rows = events.join(exact.select(*EVENT), list(EVENT), "left_anti").where("first_seen_date is not null and entity_id is not null")
    rows = rows.select(F.struct(*EVENT).alias("event"), F.col("first_seen_date").alias("on"), code(F.col("postcode")).alias("at"), company_name_norm(F.col("business_name")).alias("norm_a")).where("at is not null and norm_a <> ''")
    gone = _departures(entities).select("on", "tie", "gone", code(F.col("p_code")).alias("at"), company_name_norm(F.col("predecessor_name")).alias("norm")).where("at is not null and norm <> ''")
    left = name_keys(bagged(rows.select("at", "norm_a").distinct(), "norm_a", "bag_a", idf), "norm_a", "bag_a", "wa", p.fallback_score)
    right = name_keys(bagged(gone.select("at", "norm").distinct(), "norm", "bag", idf), "norm", "bag", "wb", p.fallback_score)
    score = name_similarity(F.col("norm_a"), F.col("bag_a"), F.col("norm"), F.col("bag"))
    near = left.join(right, ["at", "key"]).select("at", "norm_a", "norm", score.alias("score")).where(F.col("score") >= p.fallback_score).distinct()
    found = _last_other(gone, rows.join(near, ["at", "norm_a"]).drop("norm_a"), ["at", "norm"])
    best = F.struct("score", _latest())
    return found.groupBy("event").agg(F.max_by("found", best).alias("found")).select("event.*", "found.*").select(*EVENT, *PREDECESSOR)


def existing_operator(matched: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The earliest other entity, seen strictly before, whose best match is the same company.
    matched: entity_id, insert_date, business_name, first_seen_date, best_company_number, best_score."""
    own = F.struct(F.col("first_seen_date").alias("existing_operator_first_seen"), F.col("entity_id").alias("existing_operator_id"), F.col("business_name").alias("existing_operator_name"))
    known = matched.where((F.col("best_score") >= p.score_medium) & F.col("first_seen_date").isNotNull() & F.col("entity_id").isNotNull()).select("best_company_number", own.alias("o"))
    # An entity's answer is the earliest row of its company, or, where that is its own, the earliest of the other entities.
    once = known.groupBy("best_company_number", F.col("o.existing_operator_id").alias("id")).agg(F.min("o").alias("o"))
    two = once.withColumn("rn", F.row_number().over(Window.partitionBy("best_company_number").orderBy("o"))).where("rn <= 2")
    heads = two.groupBy("best_company_number").agg(*(F.min(F.when(F.col("rn") == k, F.col("o"))).alias(name) for k, name in ((1, "first"), (2, "second"))))
    rows = matched.join(heads, "best_company_number")
    rows = rows.withColumn("o", F.when(F.col("first.existing_operator_id") != F.col("entity_id"), F.col("first")).otherwise(F.col("second")))
    return rows.where("o.existing_operator_first_seen < first_seen_date").groupBy(*EVENT).agg(F.min("o").alias("o")).select(*EVENT, "o.*")


def operator_venue_count(matched: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Match rows behind each company."""
    return matched.where(F.col("best_score") >= p.score_medium).groupBy("best_company_number").agg(F.count("*").alias("operator_venues"))


def recently_incorporated(created: Column, first_seen: Column, p: Params = DEFAULT) -> Column:
    return F.datediff(first_seen, created).between(0, p.incorporation_days)


def incorporated_late(created: Column, first_seen: Column, p: Params = DEFAULT) -> Column:
    return F.coalesce(F.datediff(created, first_seen).between(1, p.incorporation_late_days), F.lit(False))


def is_corroborating(score: Column, address_match: Column, dense: Column, p: Params = DEFAULT) -> Column:
    return (score >= p.score_medium) | (address_match & ~dense)


def predecessor_name_match(norm_a: Column, norm_b: Column, score: Column, p: Params = DEFAULT) -> Column:
    """Whether two names are the same but for spelling; null if either is empty."""
    long = (F.length(norm_a) >= p.name_least) & (F.length(norm_b) >= p.name_least)
    same = (norm_a == norm_b) | (score >= p.fallback_score) | (long & edit_distance_within(norm_a, norm_b, p.name_edits))
    return F.when((text(norm_a) != "") & (text(norm_b) != ""), same)


def classify(events: DataFrame, candidates: DataFrame, predecessors: DataFrame, operators: DataFrame, venues: DataFrame, idf: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """classification, confidence, reason and evidence of every event; one projection after left joins."""
    best = candidates.where("rank = 1").drop("rank")
    found = candidates.groupBy(*EVENT).agg(F.count("*").alias("candidates_found"))
    key = list(EVENT)
    rows = events.join(predecessors, key, "left").join(best, key, "left").join(found, key, "left").join(operators, key, "left")
    rows = rows.join(venues, rows["company_number"] == venues["best_company_number"], "left").drop("best_company_number")
    # Bags come from the names of the tables that went in, so that the joined rows are not made once more for them.
    norms = company_name_norm(F.col("business_name")), company_name_norm(F.col("predecessor_name"))
    bags = name_bags(events.select(norms[0].alias("norm")).unionByName(predecessors.select(norms[1].alias("norm"))), idf)
    rows = rows.withColumns({"__na": norms[0], "__nb": norms[1]})
    for n, b in (("__na", "__ba"), ("__nb", "__bb")):
        rows = rows.join(bags.withColumnsRenamed({"norm": n, "bag": b}), n, "left")
    c = F.col
    score, created = c("name_similarity_score"), c("date_of_creation")
    rows = (
        rows.withColumn("__supported", F.coalesce(is_corroborating(score, c("address_matches_establishment"), c("is_high_density_address"), p), F.lit(False)))
        .withColumn("__late", incorporated_late(created, c("first_seen_date"), p))
        .withColumn("__young", recently_incorporated(created, c("first_seen_date"), p))
        .withColumn("__same", predecessor_name_match(c("__na"), c("__nb"), name_similarity(c("__na"), c("__ba"), c("__nb"), c("__bb")), p))
        .withColumn("__many", F.coalesce(c("operator_venues"), F.lit(0)) >= p.many_venues)
    )
    recent = F.when(c("__late"), True).otherwise(c("__young"))
    old, supported, new = c("predecessor_id").isNotNull(), c("__supported"), F.coalesce(recent, F.lit(False)) | c("existing_operator_id").isNotNull()
    kept_name = c("__same") & ~supported
    high = score >= p.score_high
    dense = F.when(high, c("is_high_density_address") & (score < p.score_rescue)).otherwise(c("is_high_density_address"))
    grade = F.when(dense | c("__many"), "LOW").when(~high | c("__late"), "MEDIUM").otherwise("HIGH")
    label = F.when(old, "OPERATOR_CHANGE").when(supported & new, "NEW_VENUE").otherwise("UNKNOWN")
    confidence = F.when(old, F.when(F.coalesce(kept_name, F.lit(False)), "MEDIUM").otherwise("HIGH")).when(supported & new, grade).otherwise("LOW")
    some = lambda cond, what: F.when(cond, what).otherwise(F.lit(""))
    matches = F.coalesce(c("address_matches_establishment"), F.lit(False))
    company = F.format_string('company "%s" (%s), similarity %.4f', c("company_name"), c("company_number"), score)
    reason = (
        F.when(
            old,
            F.concat(
                F.format_string('Another record, "%s" (%s), stood at this address from %s to %s.', c("predecessor_name"), c("predecessor_id").cast("string"), c("predecessor_first_seen").cast("string"), c("predecessor_last_seen").cast("string")),
                some(supported, F.concat(F.lit(" Supported by "), company, F.lit("."), some(matches, F.lit(f" {ADDRESS_MATCH.capitalize()}.")))),
                some(F.coalesce(kept_name, F.lit(False)), F.lit(" The name stayed nearly the same and no company supports a change; it may be the same business under a new id.")),
            ),
        )
        .when(
            supported & ~new,
            F.concat(F.lit("Matched "), company, some(matches, F.lit(f" ({VIA_ADDRESS})")), F.lit(", created "), F.coalesce(created.cast("string"), F.lit("at an unknown date")), F.lit("; neither recent nor known to run another venue.")),
        )
        .when(
            supported,
            F.concat(
                F.lit("Matched "), company, F.lit(", created "), F.coalesce(created.cast("string"), F.lit("at an unknown date")), F.lit(", by "), c("match_strategy"), F.lit(" search."),
                some(c("__late"), F.lit(" The company is younger than the record.")),
                F.when(c("is_high_density_address"), F.format_string(f" %d companies share the registered address; {NOT_BY_ADDRESS}.", c("address_company_count"))).otherwise(some(matches, F.lit(f" {ADDRESS_MATCH.capitalize()}."))),
                F.when(c("__many"), F.format_string(" The company runs %d venues.", c("operator_venues"))).otherwise(some(c("existing_operator_id").isNotNull(), F.format_string(' The company already runs "%s" (%s).', c("existing_operator_name"), c("existing_operator_id").cast("string")))),
            ),
        )
        .when(text(c("postcode")) == "", "No postcode, so no company search.")
        .when(c("candidates_found").isNull(), "No company found by district or name.")
        .otherwise(F.concat(F.lit("Closest was "), company, F.lit("; too far.")))
    )
    return rows.select(
        *EVENT,
        "publisher",
        label.alias("classification"),
        confidence.alias("confidence"),
        reason.alias("reason"),
        F.when(supported, c("company_number")).alias("evidence_company_number"),
        c("predecessor_id").alias("evidence_predecessor_id"),
        F.when(~old & supported & new, c("existing_operator_id")).alias("evidence_existing_operator_id"),
        F.when(supported, F.when(old, c("__young")).otherwise(recent)).alias("recently_incorporated"),
        F.when(old, c("__same")).alias("predecessor_name_match"),
    )


def recheck_unknown(classifications: DataFrame, as_of: Column, p: Params = DEFAULT) -> DataFrame:
    return classifications.where((F.col("classification") == "UNKNOWN") & (F.col("insert_date") >= F.date_sub(as_of, p.recheck_days)))


def upgraded(old: DataFrame, new: DataFrame) -> DataFrame:
    """Events whose label changed, with both labels."""
    was = old.select(*EVENT, F.col("classification").alias("was"))
    return was.join(new.select(*EVENT, "classification"), list(EVENT)).where("was <> classification")


def review_queue(classifications: DataFrame) -> DataFrame:
    return classifications.where("confidence = 'MEDIUM' and classification in ('NEW_VENUE', 'OPERATOR_CHANGE')")


def class_counts(classifications: DataFrame) -> DataFrame:
    return classifications.groupBy("classification", "confidence").agg(F.count("*").alias("n"))


def churn_targets(classifications: DataFrame, entities: DataFrame, checks: DataFrame) -> DataFrame:
    """Operator changes with a company behind them that no check has covered."""
    rows = classifications.where("classification = 'OPERATOR_CHANGE' and evidence_company_number is not null").join(entities.select("entity_id", "first_seen_date"), "entity_id")
    return rows.join(checks.select(*EVENT), list(EVENT), "left_anti").select(*EVENT, F.col("evidence_company_number").alias("company_number"), "first_seen_date")


def churn_signal(targets: DataFrame, appointments: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per target the appointments of its company and whether one began or ended close by. Dates only, no person."""
    dates = appointments.select("company_number", F.col("appointed_on").try_cast("date").alias("a"), F.col("resigned_on").try_cast("date").alias("r"))
    near = lambda d: F.coalesce(F.max(F.abs(F.datediff(d, "first_seen_date")) <= p.churn_days), F.lit(False))
    return targets.join(dates.withColumn("__one", F.lit(1)), "company_number", "left").groupBy(*EVENT, "company_number").agg(F.count("__one").alias("appointments"), near("a").alias("started_near"), near("r").alias("ended_near"))


