"""Matching queries over whole tables, against brute force."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from regwatch.functions import text as t
from regwatch.operators import resolve
from regwatch.plans import match_queries as m
from regwatch.plans.fixtures import view

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def v(spark):
    return lambda name: view(spark, FOLDER, name)


@pytest.fixture(scope="module")
def weights(v):
    return {r.word: r.weight for r in resolve.word_idf(v("companies")).collect()}


def similarity(a, b, weights):
    if not a or not b or a == b:
        return float(bool(a) and a == b)
    x, y, top = set(a.split()), set(b.split()), max(weights.values())
    total = lambda words: sum(weights.get(w, top) for w in words)
    return total(x & y) / total(x | y) if x & y and total(x | y) else 0.0


def prefixes(v):
    return resolve.distinct_prefixes(v("inserts")).collect()


def companies(v):
    return m.searched(v).withColumn("norm", t.company_name_norm(F.col("company_name"))).collect()


def test_m12_takes_results_of_all_companies(v, weights):
    want, rows = {}, companies(v)
    for p in prefixes(v):
        block = [(similarity(p.prefix_norm, r.norm, weights), r) for r in rows if r.company_status == "active" and "99999" not in r.sic_codes and r.norm.split(" ")[0] == p.prefix_norm.split(" ")[0]]
        best = min(((-s, r.company_number) for s, r in block if s >= 0.9), default=None)
        if best:
            want[p.prefix] = best[1]
    assert {r.prefix: r.company_number for r in m.m12_accept_search_results(v).collect()} == want
    assert max(map(int, want.values())) > 20 and len(want) < len(prefixes(v)) and {r.company_status for r in rows} == {"active", "dissolved"}


def test_m11_uses_national_hits_and_recent_checks(v, weights):
    want, dropped, rows = set(), 0, companies(v)
    for p in prefixes(v):
        if " " not in p.prefix.strip():
            continue
        hit = any(similarity(p.prefix_norm, r.norm, weights) >= 0.9 for r in rows if r.company_status == "active" and r.norm.split(" ")[0] == p.prefix_norm.split(" ")[0])
        lately = any(r.norm == p.prefix_norm and r.p_size * 2 < 30 for r in rows if r.company_status == "dissolved")
        dropped += lately and not hit
        if not hit and not lately:
            want.add(p.prefix_norm)
    assert dropped
    assert {r.prefix_norm for r in m.m11_unsatisfied_prefixes(v).collect()} == want


def test_k2_finds_similar_names_of_all_spells(spark, v, weights):
    near = [w for w, _ in sorted(weights.items(), key=lambda x: (-x[1], x[0]))][:12]
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(k)
    names = [" ".join(near), " ".join(near[:11]), " ".join(near[:9]), near[3], " ".join(reversed(near)), "", None]
    rows = [(k, day(k), names[k % 7], f"{k % 17} Road", f"d{k % 3} 1aa", day(k * 5 % 90), day(k * 5 % 90 + 3)) for k in range(90)]
    rows += [(201, day(0), names[0], "1 Way", "z1", day(0), day(3)), (202, day(9), names[1], "2 Way", "z1", day(9), day(12)), (203, day(20), names[2], "3 Way", "z1", day(20), day(22))]
    spells = spark.createDataFrame(rows, "entity_id long, insert_date date, business_name string, address_line_1 string, postcode string, first_seen_date date, last_seen_date date")
    norm = {r.entity_id: r.norm for r in spells.select("entity_id", t.company_name_norm(F.col("business_name")).alias("norm")).collect()}
    want, scores = {}, collections.Counter()
    for a in rows:
        before = [b for b in rows if b[4] == a[4] and b[0] != a[0] and b[6] < a[5]]
        if any(b[3] == a[3] for b in before):
            continue
        scored = [(round(similarity(norm[a[0]], norm[b[0]], weights), 12), b[6].toordinal(), -b[0]) for b in before]
        best = max((s for s in scored if s[0] >= 0.9), default=None)
        if best:
            want[a[0]] = -best[2]
            scores[best[0] < 1] += 1
    got = m.k2_predecessor_fallback(lambda name: spells if name == "spells" else v(name)).collect()
    assert {r.entity_id: r.predecessor_id for r in got} == want
    assert scores[True] and scores[False] and any(k % 5 for k in want)
