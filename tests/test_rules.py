"""Rules that the tables do not reach, on rows made by hand."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from regwatch.functions import text as t
from regwatch.operators import cdc, classify, feed, guard, mailauth, resolve, windows
from regwatch.params import Params
from regwatch.sources import readers
from regwatch.streaming import twins

D = dt.date


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("value", "want"), [("D'MUMBAI STATION KITCHEN AND BAR", "D'Mumbai Station Kitchen and Bar"), ("THE BAR", "The Bar"), ("KFC", "KFC"), ("munchbox", "munchbox")])
def test_tidy_name(spark, value, want):
    assert one(spark, value, t.tidy_name) == want


def test_clean_name_and_accents(spark):
    assert one(spark, "Rochester Health Club The Fuel Bar/The Fuel Bar", t.clean_name) == "Rochester Health Club The Fuel Bar"
    assert one(spark, " Café Été,", t.fold_accents) == "cafe ete"


@pytest.mark.parametrize(("value", "want"), [("NG17 3GA", "NG17"), ("OX7 ", "OX7"), ("ABCDE", None), ("12345", None), ("SW1A1AA", "SW1A"), ("", None), (None, None)])
def test_postcode_district(spark, value, want):
    assert one(spark, value, t.postcode_district) == want


def snapshots(spark, rows):
    return spark.createDataFrame([(p, e, D(2024, 1, d), f) for p, e, d, f in rows], "publisher string, entity_id long, collection_date date, fingerprint string")


def runs(spark, rows):
    return spark.createDataFrame([(p, D(2024, 1, d), s) for p, d, s in rows], "publisher string, collection_date date, status string")


def found(events):
    return sorted((r.collection_date.day, r.entity_id, r.event_type) for r in events.collect())


def test_deletes_skip_failed_runs_and_come_once(spark):
    rows = snapshots(spark, [("a", 1, 1, "x"), ("a", 2, 1, "x"), ("a", 1, 4, "x"), ("a", 1, 5, "y"), ("a", 2, 6, "x")])
    ledger = runs(spark, [("a", 1, "ok"), ("a", 2, "parse_error"), ("a", 4, "ok"), ("a", 5, "ok"), ("a", 6, "ok")])
    # 2 leaves on day 4 and comes back on day 6 unchanged: no INSERT; 1 changes on day 5 and leaves on day 6
    assert found(cdc.change_events(rows, ledger)) == [(4, 2, "DELETE"), (5, 1, "UPDATE"), (6, 1, "DELETE")]
    assert found(cdc.change_events(rows, ledger, permanent_only=True)) == [(5, 1, "UPDATE"), (6, 1, "DELETE")]
    counts = {r.collection_date.day: (r.insert_count, r.update_count, r.delete_count) for r in cdc.diff_runs(cdc.change_events(rows, ledger), ledger).collect()}
    assert counts == {1: (0, 0, 0), 4: (0, 0, 1), 5: (0, 1, 0), 6: (0, 0, 1)}


def test_an_empty_run_is_a_run(spark):
    rows = snapshots(spark, [("a", 1, 1, "x"), ("a", 1, 3, "x")])
    assert found(cdc.change_events(rows, runs(spark, [("a", 1, "ok"), ("a", 2, "ok"), ("a", 3, "ok")]))) == [(2, 1, "DELETE")]


def test_overlap_at_the_limit_quarantines_and_absent_keys_match(spark):
    events = spark.createDataFrame([("a", D(2024, 1, 2), 1, "INSERT"), ("a", D(2024, 1, 2), 2, "INSERT"), ("a", D(2024, 1, 2), 3, "DELETE")], "publisher string, collection_date date, entity_id long, event_type string")
    known = spark.createDataFrame([("a", 1, None, None), ("a", 2, "x", None), ("a", 3, "", "")], "publisher string, entity_id long, business_name string, post_code string")
    share = guard.reissue_overlap(events, known)
    assert share.first().reissue_overlap == 0.5
    hit = spark.createDataFrame([("a", D(2024, 1, 2), True, "200 inserts")], "publisher string, collection_date date, triggered boolean, trigger_reason string")
    assert guard.run_verdict(hit, share).first().quarantined is True


def test_zero_median_never_triggers(spark):
    rows = spark.createDataFrame([("a", D(2024, 1, d), 0 if d < 9 else 100) for d in range(1, 10)], "publisher string, collection_date date, insert_count long")
    assert not any(r.triggered for r in guard.spike_trigger(rows).collect())
    assert guard.spike_trigger(rows, Params(spike_absolute=50)).where("triggered").count() == 1


def test_stream_equals_batch(spark, tmp_path):
    rows = snapshots(spark, [("a", e, d, str((e * d) // 5)) for e in range(30) for d in range(1, 9) if (e + d) % 7])
    for d in range(1, 9):
        rows.where(F.dayofmonth("collection_date") == d).coalesce(1).write.parquet(str(tmp_path / "in" / f"day{d}"))
    twins.closing(rows.schema, spark, D(2024, 1, 8)).coalesce(1).write.parquet(str(tmp_path / "in" / "day9"))  # lets the watermark pass all others
    stream = twins.files(spark, str(tmp_path / "in" / "*"), rows.schema, 1)
    twins.stream_change_log(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    pick = ["entity_id", "collection_date", "change_type"]
    got = spark.read.parquet(str(tmp_path / "out" / "log"))
    assert got.select("batch").distinct().count() > 3
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(map(tuple, cdc.change_log(rows).select(*pick).collect()))


CANDIDATE = "entity_id long, insert_date date, company_number string, company_name string, name_similarity_score double, postcode_district string, address_company_count long, is_high_density_address boolean, match_strategy string, date_of_creation date, address_matches_establishment boolean, rank int"


def label(spark, predecessor=None, candidate=None, operator=None, venues=None, name="Blue Door"):
    day = D(2024, 6, 1)
    events = spark.createDataFrame([(1, "p", day, name, "1 Road", "N1 9GU", day)], "entity_id long, publisher string, insert_date date, business_name string, address_line_1 string, postcode string, first_seen_date date")
    before = spark.createDataFrame([(1, day, 7, predecessor, D(2023, 1, 1), D(2024, 1, 1))] if predecessor else [], "entity_id long, insert_date date, predecessor_id long, predecessor_name string, predecessor_first_seen date, predecessor_last_seen date")
    found = spark.createDataFrame([(1, day, "0001", "BLUE DOOR LTD", *candidate, 1)] if candidate else [], CANDIDATE)
    others = spark.createDataFrame([(1, day, D(2020, 1, 1), 9, "Blue Door Two")] if operator else [], "entity_id long, insert_date date, existing_operator_first_seen date, existing_operator_id long, existing_operator_name string")
    counts = spark.createDataFrame([("0001", venues)] if venues else [], "best_company_number string, operator_venues long")
    idf = spark.createDataFrame([("BLUE", 1.0), ("DOOR", 1.0)], "word string, weight double")
    r = classify.classify(events, found, before, others, counts, idf).first()
    return r.classification, r.confidence, r.recently_incorporated, r.predecessor_name_match


def candidate(score, created=D(2024, 3, 1), dense=False, match=False):
    return score, "N1", 1, dense, "district", created, match


def test_classification_table(spark):
    assert label(spark) == ("UNKNOWN", "LOW", None, None)
    assert label(spark, "Other Name") == ("OPERATOR_CHANGE", "HIGH", None, False)
    assert label(spark, "Blue Dor") == ("OPERATOR_CHANGE", "MEDIUM", None, True)
    assert label(spark, "Blue Door", candidate(0.6)) == ("OPERATOR_CHANGE", "HIGH", True, True)
    assert label(spark, candidate=candidate(0.85)) == ("NEW_VENUE", "HIGH", True, None)
    assert label(spark, candidate=candidate(0.84)) == ("NEW_VENUE", "MEDIUM", True, None)
    assert label(spark, candidate=candidate(0.9, dense=True)) == ("NEW_VENUE", "LOW", True, None)
    assert label(spark, candidate=candidate(0.95, dense=True)) == ("NEW_VENUE", "HIGH", True, None)
    assert label(spark, candidate=candidate(0.9, D(2024, 8, 30))) == ("NEW_VENUE", "MEDIUM", True, None)
    assert label(spark, candidate=candidate(0.9, D(2024, 8, 31))) == ("UNKNOWN", "LOW", False, None)
    assert label(spark, candidate=candidate(0.9, D(2020, 1, 1))) == ("UNKNOWN", "LOW", False, None)
    assert label(spark, candidate=candidate(0.9, None)) == ("UNKNOWN", "LOW", None, None)
    assert label(spark, candidate=candidate(0.9, D(2020, 1, 1)), operator=True) == ("NEW_VENUE", "HIGH", False, None)
    assert label(spark, candidate=candidate(1.0), venues=5) == ("NEW_VENUE", "LOW", True, None)
    assert label(spark, candidate=candidate(0.1, match=True)) == ("NEW_VENUE", "MEDIUM", True, None)
    assert label(spark, candidate=candidate(0.59, match=True, dense=True)) == ("UNKNOWN", "LOW", None, None)


def test_merged_candidates_keep_the_best_of_each_company(spark):
    day = D(2024, 6, 1)
    row = lambda number, score, strategy, match=False, dense=False, created=None: (1, day, number, "X", score, "N1", 1, dense, strategy, created, match, 1)
    make = lambda *rows: spark.createDataFrame(list(rows), CANDIDATE)
    got = resolve.merge_candidates(make(row("A", 0.2, "district", True, created=D(2024, 5, 1)), row("B", 0.95, "district")), make(row("B", 0.95, "national"), row("C", 1.0, "national")), make(row("A", 0.99, "operator-prefix")))
    assert [(r.rank, r.company_number, r.match_strategy) for r in got.orderBy("rank").collect()] == [(1, "A", "district"), (2, "C", "national"), (3, "B", "district")]


def test_chains_reissues_and_unknown_audience(spark):
    cases = [("Danisa Cafe", "", False), ("Nisa Local", "", True), ("Canteen, WM MORRISON PRODUCE", "", True), ("Canteen", "Wm Morrison Produce Ltd", True), ("Sparrow Inn", "", False)]
    rows = spark.createDataFrame(cases, "name string, address string, want boolean")
    assert all(r.got == r.want for r in rows.select("want", feed.is_chain(F.col("name"), F.col("address")).alias("got")).collect())
    with pytest.raises(ValueError, match="no audience"):
        feed.filter_waterfall(rows, "nobody")


def test_addresses_of_both_kinds(spark):
    ips = spark.createDataFrame([("10.0.0.5",), ("10.0.1.0",), ("2001:db8::1",), ("2001:db9::",), ("300.1.1.1",), ("x",)], "source_ip string")
    nets = spark.createDataFrame([("a", "10.0.0.0", "10.0.0.255"), ("b", "2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff")], "label string, lo string, hi string")
    assert {r.source_ip: r.state for r in mailauth.cidr_classify(ips, nets).collect()} == {"10.0.0.5": "listed", "10.0.1.0": "unlisted", "2001:db8::1": "listed", "2001:db9::": "unlisted", "300.1.1.1": "unparseable", "x": "unparseable"}


def test_picks_keep_a_place_for_named_takeovers(spark):
    rows = [(i, "New opening", "", f"c{i % 2}", f"v{i}") for i in range(6)] + [(9, "Change of operator", "Old", "c9", "v9")]
    table = spark.createDataFrame([("t", *r) for r in rows], "territory string, entity_id long, status string, previously string, council string, venue string")
    got = windows.diverse_top_k(table, 4, ["territory"]).orderBy("pick").collect()
    assert [r.entity_id for r in got] == [0, 1, 2, 9]
    assert windows.diverse_top_k(table, 10, ["territory"]).count() == 7


def test_picks_of_a_large_group_are_few_rows_before_the_shuffle(spark):
    """Each task holds a few rows of each council and class; before, one task sorted a whole group."""
    kinds = F.when(F.col("id") % 3 == 0, "New opening").otherwise("Change of operator").alias("status"), F.when(F.col("id") % 3 == 2, "Old").otherwise("").alias("previously")
    names = F.concat(F.lit("c"), (F.col("id") * 7 % 3).cast("string")).alias("council"), F.concat(F.lit("v"), (F.col("id") * 31 % 977).cast("string")).alias("venue")
    table = spark.range(0, 30_000, 1, 4).select(F.lit("t").alias("territory"), F.col("id").alias("entity_id"), *kinds, *names)
    rows, got = table.collect(), windows.diverse_top_k(table, 7, ["territory"])
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    turns, classes = {}, {0: [], 1: [], 2: []}
    for r in sorted(rows, key=lambda r: (r.venue, r.entity_id)):
        kind = 0 if r.status == "New opening" else 2 if r.previously else 1
        turns[kind, r.council] = turns.get((kind, r.council), 0) + 1
        classes[kind].append((turns[kind, r.council], r.council, r.venue, r.entity_id))
    plain, named = sorted(classes[0]) + sorted(classes[1]), sorted(classes[2])
    want = [x[3] for x in plain[:6] + named[:1]]
    assert [r.entity_id for r in got.orderBy("pick").collect()] == want
    # A class that runs out gives its places to the next.
    few = table.where("status <> 'New opening' or entity_id < 9").where("status = 'New opening' or previously = 'Old' or entity_id < 3")
    pick = [r.entity_id for r in windows.diverse_top_k(few, 7, ["territory"]).orderBy("pick").collect()]
    assert len(pick) == 7 and set(pick[:4]) == {0, 3, 6, 1}


def test_broken_files_are_parse_errors(spark, tmp_path):
    record = "<EstablishmentDetail><FHRSID>{}</FHRSID><BusinessName>x</BusinessName></EstablishmentDetail>"
    whole = "<E>" + "".join(record.format(k) for k in (1, 2, 2, "")) + "</E>"
    (tmp_path / "a.xml").write_text(whole)
    (tmp_path / "b.xml").write_text("<E>" + record.format(3) + "<EstablishmentDetail><FHRSID>4</FHRSID><BusinessName>x</EstablishmentDetail></E>")
    good, skipped = readers.split_bad_records(readers.read_register_xml(spark, str(tmp_path)))
    assert sorted(r.entity_id for r in good.collect()) == [1, 2]
    assert {r.file[-5:]: (r.no_key, r.repeated, r.broken > 0, r.status) for r in skipped.collect()} == {"a.xml": (1, 1, False, "skipped"), "b.xml": (0, 0, True, "parse_error")}


def test_streams_in_many_batches_equal_the_whole(spark, tmp_path):
    days = [f"2024-01-{d:02d}" for d in (1, 2, 3, 4, 5)]
    rows = [("p", k, d, f"f{(k * (i // 2)) % 3}") for i, d in enumerate(days) for k in range(12) if (k + i) % 5 and not (k > 8 and i < 2)]
    df = spark.createDataFrame(rows, "publisher string, entity_id long, day string, fingerprint string").selectExpr("publisher", "entity_id", "cast(day as date) as collection_date", "fingerprint")
    runs = df.select("publisher", "collection_date").distinct().withColumn("status", F.lit("ok"))
    for i, d in enumerate(days):
        df.where(F.col("collection_date") == d).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    twins.closing(df.schema, spark, D(2024, 1, 5)).coalesce(1).write.parquet(str(tmp_path / "in" / "last"))
    stream = twins.files(spark, str(tmp_path / "in" / "*"), df.schema, 1)
    twins.stream_change_events(stream, runs, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = twins.read_change_events(spark, runs, str(tmp_path / "out"))
    want = cdc.change_events(df, runs).select(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 10


def test_companies_without_an_address_are_counted_together(spark):
    rows = spark.createDataFrame([("1", None, " "), ("2", "", None), ("3", "1 Road", "N1"), ("4", "1 road ", "n1"), ("5", "1 Road", None)], "company_number string, address_line_1 string, postcode string")
    got = {r.company_number: r.address_company_count for r in resolve.address_density(rows).collect()}
    assert got == {"1": 2, "2": 2, "3": 2, "4": 2, "5": 1}


def test_repeated_rows_of_a_run_are_no_departure(spark):
    days = [("a", 1, d, "x") for d in (1, 2, 3)]
    ledger = runs(spark, [("a", d, "ok") for d in (1, 2, 3)])
    assert found(cdc.change_events(snapshots(spark, [*days, days[1], days[0], days[0]]), ledger)) == []
    differing = snapshots(spark, [*days, ("a", 1, 2, "w")])
    # both rows of day 2 count, in the order of their fingerprints: x, w, x, x
    assert found(cdc.change_events(differing, ledger)) == [(2, 1, "UPDATE"), (2, 1, "UPDATE")]
    assert cdc.current_state(differing).first().fingerprint == "x"
    assert [tuple(r)[2:] for r in cdc.ingest_stats(snapshots(spark, [*days, days[1]])).orderBy("collection_date").collect()] == [(1, 0, 0), (0, 0, 2), (0, 0, 1)]


def test_a_replayed_state_breaks_ties_alike(spark):
    rows = snapshots(spark, [("a", 1, 1, "x"), ("a", 1, 1, "z"), ("a", 1, 1, "y")])
    for n in (1, 3):
        r = cdc.current_state(rows.repartition(n)).first()
        assert (r.fingerprint, r.last_changed_date) == ("z", D(2024, 1, 1))


def spells(spark, rows):
    return spark.createDataFrame([(i, f"n{i}", a, "P1 1AA", D(2024, 1, 1) + dt.timedelta(x), D(2024, 1, 1) + dt.timedelta(y)) for i, a, x, y in rows], "entity_id long, business_name string, address_line_1 string, postcode string, first_seen_date date, last_seen_date date")


def test_predecessor_is_an_as_of_merge(spark):
    import random

    rng = random.Random(4)
    rows = []
    for i in range(400):
        x = rng.randrange(60)
        rows.append((rng.randrange(150), rng.choice(["a", "b", " A ", "", None]), x, x + rng.randrange(12)))
    table = spells(spark, rows)
    arrivals = table.withColumn("insert_date", F.col("first_seen_date"))
    got = {(r.entity_id, r.insert_date): (r.predecessor_id, r.predecessor_last_seen) for r in classify.predecessor_exact(arrivals, table).collect()}
    want = {}
    at = lambda a: (a or "").strip().upper()
    for i, a, x, _ in rows:
        for j, b, _, y in rows:
            if at(a) and at(a) == at(b) and i != j and y < x:
                k = (i, D(2024, 1, 1) + dt.timedelta(x))
                want[k] = max(want.get(k, (-1, 0)), (y, -j))
    assert got == {k: (-j, D(2024, 1, 1) + dt.timedelta(y)) for k, (y, j) in want.items()}


def test_a_hundred_thousand_entities_of_one_address(spark):
    ids = spark.range(100_000).select(F.col("id").alias("entity_id"), F.lit("n").alias("business_name"), F.lit("1 High St").alias("address_line_1"), F.lit("P1 1AA").alias("postcode"))
    day = lambda n: F.date_add(F.lit("2000-01-01").cast("date"), n)
    table = ids.withColumn("first_seen_date", day((F.col("entity_id") * 2).cast("int"))).withColumn("last_seen_date", day((F.col("entity_id") * 2 + 1).cast("int")))
    rows = classify.predecessor_exact(table.withColumn("insert_date", F.col("first_seen_date")), table)
    assert rows.agg(F.count("*"), F.sum(F.col("entity_id") - F.col("predecessor_id"))).first()[:] == (99_999, 99_999)


def all_pairs(events, companies, idf, p):
    """District candidates from every pair of a district."""
    left, right = resolve._prepared_events(events, F.col("business_name"), idf), resolve.prepared_companies(companies, idf, p)
    return resolve._ranked(resolve._scored(left.join(right, left["event_district"] == right["district"])), p.top_candidates)


@pytest.mark.parametrize(("words", "first_words"), [(12, 2), (40, 1), (6, 3)])
def test_district_candidates_equal_all_pairs(spark, words, first_words):
    import random

    rng = random.Random(words)
    lexicon = [f"W{min(rng.randrange(words), rng.randrange(words))}" for _ in range(4 * words)]
    name = lambda: " ".join(rng.choices(lexicon, k=rng.choice([0, 1, 2, 3, 5])))
    line = lambda: rng.choice([f"{rng.randrange(30)} High St", "", None])
    code = lambda: rng.choice([f"D{rng.randrange(3)} 1AA", "D9 1AA", None, "?"])
    day = lambda: rng.choice([None, D(2024, 1, 1) + dt.timedelta(rng.randrange(300))])
    companies = spark.createDataFrame([(f"{i:05}", name(), line(), code(), day()) for i in range(300)], "company_number string, company_name string, address_line_1 string, postcode string, date_of_creation date")
    events = spark.createDataFrame([(i, D(2024, 5, 1), name(), line(), code()) for i in range(150)], "entity_id long, insert_date date, business_name string, address_line_1 string, postcode string")
    idf = resolve.word_idf(companies)
    got = resolve.district_candidates(events, companies, idf, first_words=first_words)
    rows = lambda df: sorted((tuple(map(str, r)) for r in df.select(*resolve.CANDIDATE, "rank").collect()))
    assert rows(got) == rows(all_pairs(events, companies, idf, Params()))


def test_district_candidates_do_not_pair_all_of_a_district(spark):
    rows = spark.range(3000)
    companies = rows.select(F.lpad(F.col("id").cast("string"), 8, "0").alias("company_number"), F.concat(F.lit("N"), "id").alias("company_name"), F.lit("").alias("address_line_1"), F.lit("D1 1AA").alias("postcode"), F.lit(None).cast("date").alias("date_of_creation"))
    events = companies.selectExpr("cast(company_number as long) as entity_id", "date'2024-01-01' as insert_date", "company_name as business_name", "address_line_1", "postcode")
    got = resolve.district_candidates(events, companies, resolve.word_idf(companies))
    assert got.groupBy().agg(F.count("*"), F.count_if((F.col("name_similarity_score") == 1) & (F.col("rank") == 1) & (F.col("company_number").cast("long") == F.col("entity_id")))).first()[:] == (15_000, 3000)
    graph = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in graph and "BroadcastNestedLoopJoin" not in graph


def model_parts(record, counties=t.COUNTIES):
    """address_parts line by line, in plain Python."""
    import re
    import unicodedata

    def tidy(x):
        x = (x or "").strip()
        if not x.isupper() or len(x) <= 3:
            return x
        first, *rest = x.title().split(" ")
        return " ".join([first, *(w.lower() if w.lower() in t.SMALL_WORDS else w for w in rest)])

    def plain(x):
        return "".join(c for c in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(c)).strip(" ,.")

    def is_street(x):
        return bool(re.match(r"\s*\d+[a-z]?\b", x.lower())) or any(f" {w}" in f" {x.lower()} " for w in t.STREET_WORDS)

    name, lines, council, code = record
    name, code, council = tidy(name), (code or "").strip(), council or ""
    halves = [h.strip() for h in name.split("/") if h.strip()]
    name = halves[0] if len(halves) == 2 and halves[1].lower() in halves[0].lower() else name
    shown = re.sub(r"\s*\(.*?\)\s*", "", council).strip()
    kept, met = [], None
    for line in lines:
        line = (line or "").strip()
        line = re.sub(re.escape(code), "", line, flags=re.IGNORECASE).strip(" ,") if code and line else line
        low = line.lower().strip(" ,")
        if not line or plain(line) == plain(name):
            continue
        if low in (council.lower(), shown.lower()):
            met = shown or tidy(line)
        elif low not in counties:
            kept.append(tidy(line))
    town = next((k for k in range(len(kept) - 1, -1, -1) if not is_street(kept[k])), None)
    town = None if town == 0 and len(kept) > 1 else town
    street = kept[:town] if town is not None else kept
    joined = ", ".join(street)
    return name, street[-1] if len(joined) > 42 else joined, kept[town] if town is not None else met or "", code


def test_address_parts_match_a_model(spark):
    import random

    rng = random.Random(11)
    lines = ["12 High Street", "12th Man", "THE OLD MILL", "Rowan House", "Kent", "KENT", "Fife", "fife,", "Ayton", "AYTON ON SEA", "ng17 3ga", "Ayton NG17 3GA", "NG17 3GA", "Hyde Park", "Parkside", "Unit 4, The Long Industrial Estate Of Somewhere", "City of Edinburgh", "Edinburgh", "St Mary's Café", "St Mary's Cafe", "", None, " ,", "7a Mews", "D'MUMBAI (X+Y)", "England"]
    names = ["St Mary's Café", "A B/B", "A B/B/C", "A/B", "Fuel Bar /", " BLIND COW ", None, "12th Man", "THE OLD MILL/OLD MILL"]
    councils = ["Fife", "Edinburgh (City of)", "Ayton", "Kent", None, "(none)"]
    rows = [(i, rng.choice(names), *(rng.choice(lines) for _ in range(4)), rng.choice(councils), rng.choice(["NG17 3GA", " ng17 3ga ", "", None, "D.1+"])) for i in range(5000)]
    table = spark.createDataFrame(rows, "k long, name string, l1 string, l2 string, l3 string, l4 string, council string, code string")
    parts = t.address_parts(F.col("name"), [F.col(f"l{i}") for i in (1, 2, 3, 4)], F.col("council"), F.col("code"))
    got = {r.k: tuple(r.p) for r in table.select("k", parts.alias("p")).collect()}
    for k, name, *four, council, code in rows:
        assert got[k] == model_parts((name, four, council, code)), (name, four, council, code)


def test_address_parts_read_each_input_once(spark):
    """What stood for a value was written out wherever the value was read: more than a hundred times for the name."""
    inputs = ["name", "l1", "l2", "l3", "l4", "council", "code"]
    table = spark.createDataFrame([("a",) * 7], ", ".join(f"{x} string" for x in inputs))
    tidied = table.select(t.address_parts(F.col("name"), [F.col(x) for x in inputs[1:5]], F.col("council"), F.col("code")).alias("p"))
    text = tidied._jdf.queryExecution().analyzed().expressions().head().toString()
    assert [x for x in inputs if text.count(f"{x}#") != 1] == ["council"] and text.count("council#") == 2


@pytest.mark.parametrize(("value", "want"), [("12th Man", False), ("12 High", True), ("12a Mews", True), ("7B", True), ("Hyde Park", True), ("Parkside", False), ("Rowan House", True), ("Throw", False), ("", False)])
def test_looks_like_street(spark, value, want):
    assert one(spark, value, t.looks_like_street) is want


@pytest.mark.parametrize(("value", "want"), [("A B/B/C", "A B/B/C"), ("A B/B", "A B"), ("A B/ /B", "A B"), ("A/B", "A/B"), (" OLD MILL/MILL ", "Old Mill"), ("x/", "x/")])
def test_clean_name_takes_two_parts_alone(spark, value, want):
    assert one(spark, value, t.clean_name) == want


def test_territories_are_strict(spark):
    from regwatch.operators import territory

    publishers = spark.createDataFrame([("1", "Bournemouth, Christchurch and Poole", "SOUTH"), ("2", "Leeds", "NORTH"), ("3", "Leeds", "SOUTH")], "publisher string, name string, region_name string")
    rows = [("the north", "region_group", "NORTH"), ("uplands", "region_group", "NORTH"), ("uplands", "region_group", "WEST"), ("gb", "abbreviation", "leeds"), ("all", "national", ""), ("dorset", "county", "Bournemouth, Christchurch and Poole"), ("dorset", "county", "Gone")]
    gazetteer = spark.createDataFrame(rows, "place_key string, kind string, target string")
    places = ["Bournemouth, Christchurch and Poole", "Uplands", "Leeds and Uplands", "GB", "ALL", "Dorset, Leeds", "South / North", "Leeds And South", "", None, ",", "Leeds,"]
    got = {r.place: (r.publishers, r.reason) for r in territory.resolve_territories(spark.createDataFrame([(p,) for p in places], "place string"), gazetteer, publishers).collect()}
    # "And" in capitals is no separator, nor is a slash; a comma at the end leaves a single part, which the whole already is
    assert got == {
        "Bournemouth, Christchurch and Poole": (["1"], None), "Uplands": (None, "absent: WEST"), "Leeds and Uplands": (None, "absent: WEST"), "GB": (["2", "3"], None), "ALL": (["1", "2", "3"], None), "Dorset, Leeds": (["1", "2", "3"], None),
        "South / North": (None, "unknown: South / North"), "Leeds And South": (None, "unknown: Leeds And South"), "": (None, "no territory given"), None: (None, "no territory given"), ",": (None, "no territory given"), "Leeds,": (["2", "3"], None),
    }
    with pytest.raises(Exception, match="territory Uplands: absent: WEST"):
        territory.resolve_territories(spark.createDataFrame([("Uplands",)], "place string"), gazetteer, publishers, strict=True).collect()


def test_a_canary_that_moved_is_not_missing(spark):
    from regwatch.operators import quality

    there = spark.createDataFrame([(1, "a", "x", "B1"), (2, "b", "y", None), (3, "a", "z", "B3"), (3, "b", "z", "B3")], "entity_id long, publisher string, business_name string, business_id string")
    wanted = spark.createDataFrame([(1, "b", "x", "B2"), (2, "b", "y", None), (3, "b", "z", "B3"), (4, "b", "q", "B4")], "entity_id long, publisher string, expected_name string, expected_business_id string")
    assert sorted(tuple(r) for r in quality.canary_check(there, wanted).collect()) == [(1, "b", "publisher,business_id"), (4, "b", "missing")]


def test_windows_count_records_of_both_ends(spark):
    days = spark.createDataFrame([("p", "all", "", D(2024, 1, d)) for d in (2, 2, 5, 9)] + [("p", "all", "", None)], "publisher string, audience string, reason_removed string, first_seen_date date")
    keys = ["publisher", "audience", "reason_removed"]
    counts = windows.cumulative_counts(days, keys, "first_seen_date")
    asked = spark.createDataFrame([("p", "all", "", D(2024, 1, d)) for d in (1, 2, 4, 5, 30)] + [("q", "all", "", D(2024, 1, 3))], "publisher string, audience string, reason_removed string, first_seen_date date")
    got = {(r.publisher, r.first_seen_date.day): r.n for r in windows.counts_until(counts, asked, keys, "first_seen_date").collect()}
    assert got == {("p", 1): 0, ("p", 2): 2, ("p", 4): 2, ("p", 5): 3, ("p", 30): 4, ("q", 3): 0}


def test_mail_reports_plain_gzip_zip_and_broken(spark, tmp_path):
    import gzip
    import io
    import zipfile

    def report(org, *records):
        return f"<feedback><report_metadata><org_name>{org}</org_name><date_range><begin>1704067200</begin><end>1704153600</end></date_range></report_metadata><policy_published><domain>d.example</domain><p>none</p></policy_published>{''.join(records)}</feedback>".encode()

    one = "<record><row><source_ip>1.2.3.4</source_ip><count>3</count><policy_evaluated><disposition>none</disposition><spf>pass</spf></policy_evaluated></row><identifiers><header_from>a.example</header_from></identifiers><auth_results><spf><domain>s1</domain><result>pass</result></spf><dkim><domain>k1</domain><result>fail</result></dkim><dkim><domain>k2</domain></dkim><dkim><result>pass</result></dkim></auth_results></record>"
    (tmp_path / "a.xml").write_bytes(report("plain", one, "<record/>"))
    (tmp_path / "b.xml.gz").write_bytes(gzip.compress(report("packed", one)))
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("x.xml", report("archived", one))
    (tmp_path / "c.zip").write_bytes(made.getvalue())
    for name, content in (("d.xml", b"<feedback>"), ("e.zip", b"PK no archive"), ("f.gz", b"plain"), ("g.xml", report("bad", one.replace("<count>3", "<count>three"))), ("h.xml", b"")):
        (tmp_path / name).write_bytes(content)
    got = readers.read_auth_reports(spark, str(tmp_path))
    assert sorted(r.file for r in readers.auth_failures(got).collect()) == ["d.xml", "e.zip", "f.gz", "g.xml", "h.xml"]
    rows = readers.auth_records(got)
    assert sorted((r.reporter, r.source_ip, r["count"]) for r in rows.collect()) == [("archived", "1.2.3.4", 3), ("packed", "1.2.3.4", 3), ("plain", "1.2.3.4", 3), ("plain", "?", 0)]
    sums = {r.source_ip: r for r in mailauth.source_rollup(rows).collect()}
    r = sums["1.2.3.4"]
    assert (r.messages, r.reporters, r.domains, r.spf_domains, r.dkim_domains) == (9, ["archived", "packed", "plain"], ["a.example"], ["s1=pass"], ["k1=fail", "k2=?"])
    assert (r.spf_results, r.dkim_results, r.disposition_results, r.last_seen) == ({"pass": 9}, {"?": 9}, {"none": 9}, D(2024, 1, 1))
    assert (sums["?"].messages, sums["?"].domains, sums["?"].spf_results) == (0, [], {"?": 0})


def test_a_sink_opens_the_ledger_of_its_own_days_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    sink = twins.idempotent_sink(path, ["publisher", "collection_date"])
    rows = lambda *days: spark.createDataFrame([(p, D(2024, 1, 1) + dt.timedelta(d), n) for d in days for p in ("a", "b c/d") for n in (1, 2)], "publisher string, collection_date date, n long")
    opened = []
    for number in range(12):
        sink(rows(number, number - 1), number)  # the day before comes again
        known = twins.finished_runs(spark, path, "collection_date", [D(2024, 1, 1) + dt.timedelta(number)], "publisher string, collection_date date")
        opened.append(len(known.inputFiles()))
    assert set(opened) == {1}
    sink(rows(11, 10), 11)  # a batch that is repeated
    got = spark.read.parquet(path)
    assert got.count() == 13 * 4 and got.distinct().count() == 13 * 4


def test_deletes_of_a_stream_read_two_runs_for_each_of_their_own(spark, tmp_path, monkeypatch):
    ledger = runs(spark, [("a b", d, "ok") for d in range(1, 11)])
    opened, read = [], twins._read
    monkeypatch.setattr(twins, "_read", lambda *x: opened.append(len(twins._folders(*x[:3]))) or read(*x))
    rows = snapshots(spark, [("a b", e, d, "x") for d in range(1, 11) for e in range(5) if (e + d) % 5])
    landed = str(tmp_path / "in")
    rows.repartitionByRange(10, "collection_date").sortWithinPartitions("collection_date").write.parquet(landed)
    twins.closing(rows.schema, spark, D(2024, 1, 10)).write.mode("append").parquet(landed)
    twins.stream_change_events(twins.files(spark, landed, rows.schema, 1), ledger, str(tmp_path / "out"), str(tmp_path / "check"))
    assert len(opened) > 10 and max(opened) <= 4
    assert found(twins.read_change_events(spark, ledger, str(tmp_path / "out"))) == found(cdc.change_events(rows, ledger))


def test_a_stream_puts_late_rows_in_order(spark, tmp_path):
    import random

    rng = random.Random(7)
    rows = snapshots(spark, [("p", e, d, rng.choice("xyz")) for e in range(6) for d in range(1, 20) if rng.random() < 0.8])
    files, landed = sorted(rows.collect(), key=lambda r: r.collection_date.day + rng.random() * 6), str(tmp_path / "in")
    for k in range(0, len(files), 20):  # each file holds rows of several days, and days are spread over files
        spark.createDataFrame(files[k : k + 20], rows.schema).coalesce(1).write.mode("append").parquet(landed)
        time.sleep(1.1)  # files are read in the order of their times
    twins.closing(rows.schema, spark, D(2024, 1, 19)).coalesce(1).write.mode("append").parquet(landed)
    stored = spark.createDataFrame([("p", 0, "x"), ("p", 1, "y")], "publisher string, entity_id long, fingerprint string")
    twins.stream_change_log(twins.files(spark, landed, rows.schema, 1), str(tmp_path / "out"), str(tmp_path / "check"), late="8 days", stored=stored)
    key = lambda r: (r.entity_id, r.collection_date.day, r.fingerprint, r.change_type)
    got = sorted(map(key, spark.read.parquet(str(tmp_path / "out/log")).collect()))
    earlier = stored.select("publisher", "entity_id", F.lit(D(2023, 12, 1)).alias("collection_date"), "fingerprint")
    want = cdc.change_log(rows.unionByName(earlier)).where("collection_date >= date'2024-01-01'")
    assert got == sorted(map(key, want.collect()))


def test_one_broken_publisher_leaves_the_others_done(spark, tmp_path):
    from regwatch.operators import runs as driver

    days = [D(2024, 1, d) for d in (1, 2, 3)]
    rows = snapshots(spark, [(p, e, d, "x" if (e + d) % 4 else "y") for p in "abcde" for d in (1, 2, 3) for e in range(8) if (e * d) % 5 or d == 1])
    rows = rows.unionByName(rows.where("publisher = 'a'"))
    asked, broken = [], {("c", days[1])}

    def snapshot_of(runs_):
        asked.append(runs_)
        if broken & set(runs_):
            raise ValueError("unreadable")
        return rows.where((F.col("collection_date") == runs_[0][1]) & F.col("publisher").isin([p for p, _ in runs_]))

    store, landed = str(tmp_path / "store"), spark.createDataFrame([(p, d) for p in "abcde" for d in days], "publisher string, collection_date date")
    status = lambda made: {(r.publisher, r.collection_date.day): r.status for r in made.collect()}
    first = status(driver.incremental_run(spark, store, landed, snapshot_of))
    assert {k for k, v in first.items() if v != "ok"} == {("c", 2)} and len(first) == 15
    assert len(asked) < 12  # halves, not one job for each publisher
    ledger = landed.withColumn("status", F.when((F.col("publisher") == "c") & (F.col("collection_date") == days[1]), "failed").otherwise("ok"))
    kept = lambda: spark.read.schema("entity_id long, event_type string, publisher string, collection_date date").parquet(f"{store}/events")
    key = lambda df: sorted((r.publisher, r.collection_date, r.entity_id, r.event_type) for r in df.collect())
    assert key(kept()) == key(cdc.change_events(rows.join(ledger.where("status = 'ok'"), ["publisher", "collection_date"], "left_semi"), ledger))
    asked.clear()
    broken.clear()
    assert status(driver.incremental_run(spark, store, landed, snapshot_of)) == {("c", 2): "ok"} and asked == [[("c", days[1])]]
    assert driver.incremental_run(spark, store, landed, snapshot_of).count() == 0 and len(asked) == 1
    before = key(kept())
    again = driver.incremental_run(spark, store, landed.where("publisher = 'a'"), snapshot_of, force=True)
    assert status(again) == {("a", d): "ok" for d in (1, 2, 3)} and key(kept()) == before


def test_daily_runs_ask_for_their_ledger_once(spark):
    """Each attempt read the ledger once for each of its runs, and the whole archive for its day: 182 jobs, now 136."""
    from __spark_entry__ import queries

    spark.sparkContext.setJobGroup("c12 jobs", "")
    assert queries()["c12_incremental_run"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("c12 jobs")) < 160
