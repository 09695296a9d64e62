"""Names that very many rows bear are compared once: what grew with the pairs of rows would not end here."""

import pytest
from pyspark.sql import functions as F

from regwatch.operators import classify, resolve

N = 20_000


@pytest.fixture(scope="module")
def companies(spark):
    return spark.range(N).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"), F.concat(F.lit("BLUE DOOR "), F.col("id") % 2).alias("company_name"), F.lit("").alias("address_line_1"), F.lit("D1 1AA").alias("postcode"), F.lit(None).cast("date").alias("date_of_creation"))


@pytest.fixture(scope="module")
def events(companies):
    return companies.selectExpr("cast(company_number as long) as entity_id", "date'2024-01-01' as insert_date", "concat(company_name, ' @ ', company_name) as business_name", "address_line_1", "postcode")


@pytest.fixture(scope="module")
def idf(companies):
    return resolve.word_idf(companies)


def firsts(rows):
    """Events, companies of the first number of ranks, and rows of each list."""
    even = F.col("company_number").cast("long") == 2 * (F.col("rank") - 1) + F.col("entity_id") % 2
    return rows.groupBy().agg(F.count("*"), F.countDistinct("entity_id"), F.count_if(even & (F.col("name_similarity_score") == 1))).first()[:]


def test_district_candidates_of_one_name(events, companies, idf):
    named = events.withColumn("business_name", F.substring_index("business_name", " @ ", 1))
    assert firsts(resolve.district_candidates(named, companies, idf)) == (5 * N, N, 5 * N)


def test_national_candidates_of_one_name(events, companies, idf):
    named = events.withColumn("business_name", F.substring_index("business_name", " @ ", 1))
    assert firsts(resolve.national_candidates(named, companies, idf)) == (5 * N, N, 5 * N)


def test_operator_candidates_of_one_name(events, companies, idf):
    assert firsts(resolve.operator_candidates(events, companies, idf)) == (5 * N, N, 5 * N)


def test_a_fallback_among_spells_of_one_name(spark, idf):
    day = lambda n: F.date_add(F.lit("2000-01-01").cast("date"), n)
    ids = spark.range(N).select(F.col("id").alias("entity_id"), F.lit("Blue Door 1").alias("business_name"), F.col("id").cast("string").alias("address_line_1"), F.lit("D1 1AA").alias("postcode"))
    table = ids.withColumn("first_seen_date", day((F.col("entity_id") * 2).cast("int"))).withColumn("last_seen_date", day((F.col("entity_id") * 2 + 1).cast("int"))).withColumn("insert_date", F.col("first_seen_date"))
    exact = classify.predecessor_exact(table, table)
    got = classify.predecessor_fallback(table, table, idf, exact)
    assert got.agg(F.count("*"), F.sum(F.col("entity_id") - F.col("predecessor_id"))).first()[:] == (N - 1, N - 1)


def test_every_pair_of_similar_names_once(spark, events, companies, idf):
    named, some = events.where("entity_id < 300").withColumn("business_name", F.substring_index("business_name", " @ ", 1)), companies.where("company_number < '00000400'")
    left, right = resolve._prepared_events(named, F.col("business_name"), idf), resolve.prepared_companies(some, idf)
    score = F.round(resolve.name_similarity(F.col("event_norm"), F.col("event_bag"), F.col("company_norm"), F.col("company_bag")), 9).alias("score")
    pick = ["entity_id", "company_number", "score"]
    want = left.join(right, F.col("event_district") == F.col("district")).select("entity_id", "company_number", score).where("score > 0")
    got = resolve.district_similarity(named, some, idf)
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(map(tuple, want.select(*pick).collect()))


def test_search_results_of_one_title(spark, idf):
    rows = spark.range(2 * N).select(F.lit("Blue Door 1").alias("prefix"), F.lit("BLUE DOOR 1 LTD").alias("title"), F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"), F.lit("active").alias("company_status"), F.when(F.col("id") < 3, F.array(F.lit("99999"))).otherwise(F.array(F.lit("1"))).alias("sic_codes"))
    assert [tuple(r)[:3] for r in resolve.accept_search_results(rows, idf).collect()] == [("Blue Door 1", "00000003", "BLUE DOOR 1 LTD")]


def test_all_candidates_name_companies_once(spark, events, companies, idf, monkeypatch):
    some, few, calls = events.where("entity_id < 300"), companies.where("company_number < '00000400'"), []
    want = resolve.merge_candidates(*(f(some, few, idf) for f in (resolve.district_candidates, resolve.national_candidates, resolve.operator_candidates)))
    made = resolve.named_companies
    monkeypatch.setattr(resolve, "named_companies", lambda *a: calls.append(1) or made(*a))
    got = resolve.all_candidates(some, few, idf)
    assert len(calls) == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_a_full_list_has_the_trusted_first_and_then_the_best(spark, companies, idf):
    """Four trusted companies, two of them among the first five by score and number: one place is left, for the first other."""
    day = F.lit("2024-01-01").cast("date")
    at = F.when(F.col("company_number").isin("00000000", "00000004", "00000012", "00000013"), "1 High Street").otherwise("")
    few = companies.where("company_number < '00000020'").withColumn("address_line_1", at)
    event = spark.range(1).select(F.col("id").alias("entity_id"), day.alias("insert_date"), F.lit("Blue Door 0").alias("business_name"), F.lit("1 High Street").alias("address_line_1"), F.lit("D1 1AA").alias("postcode"))
    got = resolve.district_candidates(event, few, idf).orderBy("rank").collect()
    assert [(r["company_number"], r["address_matches_establishment"]) for r in got] == [("00000000", True), ("00000004", True), ("00000012", True), ("00000013", True), ("00000002", False)]


def test_numbers_at_addresses_are_not_broadcast(companies):
    rows = companies.withColumn("address_line_1", F.concat(F.col("company_number"), F.lit(" High Street")))
    text = resolve.address_density(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
