"""Pairs of rows are written out of blocks of rows, behind the last join and shuffle."""

import pytest
from pyspark.sql import functions as F

from regwatch.operators import resolve

PICK = ["entity_id", "insert_date", "company_number", "score"]


@pytest.fixture(scope="module")
def companies(spark):
    """Three districts, the first with most; names of one to four words, some empty, some equal to events' names."""
    name = F.concat_ws(" ", F.when(F.col("id") % 3 > 0, F.concat(F.lit("BLUE"), F.col("id") % 5)), F.when(F.col("id") % 4 > 0, F.concat(F.lit("DOOR"), F.col("id") % 3)), F.when(F.col("id") % 11 > 0, F.lit("ALL")))
    return spark.range(900).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"), name.alias("company_name"), F.concat(F.lit("D"), F.greatest(F.col("id") % 5 - 2, F.lit(0)), F.lit(" 1AA")).alias("postcode"), F.lit("").alias("address_line_1"), F.lit(None).cast("date").alias("date_of_creation"))


@pytest.fixture(scope="module")
def events(companies):
    """An event twice, events without a number or a day, and names of words that no company has."""
    name = F.when(F.col("company_number") % 7 == 0, F.concat("company_name", F.lit(" UNSEEN"))).otherwise(F.col("company_name"))
    number = F.when(F.col("company_number") != "00000005", F.col("company_number").cast("long"))
    day = F.when(F.col("company_number") != "00000008", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("company_number") % 9).cast("int")))
    rows = companies.where("company_number < '00000300'").select(number.alias("entity_id"), day.alias("insert_date"), name.alias("business_name"), "address_line_1", "postcode")
    return rows.unionByName(rows.where("entity_id = 4"))


@pytest.fixture(scope="module")
def idf(companies):
    return resolve.word_idf(companies)


@pytest.fixture(scope="module")
def want(events, companies, idf):
    left, right = resolve._prepared_events(events, F.col("business_name"), idf), resolve.prepared_companies(companies, idf)
    score = F.round(resolve.name_similarity(F.col("event_norm"), F.col("event_bag"), F.col("company_norm"), F.col("company_bag")), 9).alias("score")
    return rows(left.join(right, F.col("event_district") == F.col("district")).select(*PICK[:3], score).where("score > 0"))


def rows(df):
    return sorted(map(str, df.select(*PICK).collect()))


@pytest.mark.parametrize("cell", (50_000, 40, 1))
def test_every_pair_once_however_districts_are_cut(events, companies, idf, want, cell):
    assert len(want) > 20_000
    assert rows(resolve.district_similarity(events, companies, idf, cell=cell)) == want


def test_blocks_hold_all_rows_and_few_each(spark):
    table = spark.range(5000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("x"), F.col("id").alias("y"))
    held = resolve.blocks(table, ("k",), 16)
    assert held.agg(F.max(F.size("x")), F.count("*") < 5000 / 16 * 1.5).first()[:] == (16, True)
    back = held.select("k", F.posexplode("x").alias("at", "x"), "y").select("k", "x", F.get("y", F.col("at")).alias("y"))
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_joins_see_blocks_where_they_saw_rows(events, companies, idf):
    """900 companies of one district and name: a join that gives a row for each pair of rows does not scale to the result."""
    few, many = events.limit(300).withColumns({"business_name": F.lit("Blue1 Door1"), "postcode": F.lit("D0 1AA")}), companies.withColumns({"company_name": F.lit("BLUE1 DOOR1"), "postcode": F.lit("D0 1AA")})
    got = resolve.district_similarity(few, many, idf)
    assert len(got.collect()) == 300 * 900
    joined, nodes = [], [got._jdf.queryExecution().executedPlan().executedPlan()]
    while nodes:
        node = nodes.pop()
        if "Join" in node.nodeName():
            joined.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(k) for k in range(node.children().size())] + ([node.plan()] if "QueryStage" in node.nodeName() else [])
    assert joined and max(joined) < 1000
