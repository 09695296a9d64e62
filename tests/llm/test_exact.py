import hashlib
import random
import re

from regwatch.llm import exact

SCHEMA = "doc_id long, text string, digest int, kept string"


def test_index_inserts_deletes_and_grows():
    index, live, rng = exact.CuckooIndex(2), {}, random.Random(1)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for _ in range(12000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            assert index.insert(key) == (key not in live)
            live[key] = live.get(key, 0) + 1
        else:
            assert index.delete(key) == (key in live)
            live[key] = live.get(key, 0) - 1
            if live[key] <= 0:
                del live[key]
    assert {k: n for k, n, _ in index.items()} == live and index.resizes > 3
    assert all((k in index) == (k in live) for k in keys)


def test_equal_fingerprints_are_verified():
    a, b = bytes(32), bytes(31) + b"\x01"
    index = exact.CuckooIndex()
    assert index.insert(a) and b not in index and index.insert(b) and index.delete(a) and b in index and a not in index


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, (d, t) in enumerate(rows)}
    out = []
    for i, (d, t) in enumerate(rows):
        group = [j for j in norm if norm[j] == norm[i]]
        best = min(group, key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0]))
        kept = rows[best][0] == d and len(rows[best][1] or "") == len(t or "")
        out.append((d, rows[best][0], len(group), kept, hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_match_brute_force(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " "), (7, "A b"), (8, "x" * 50000), (9, "x" * 50000 + " "), (10, "é "), (11, "é"), (12, "ab"), (12, "ab"), (None, "lone")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in exact.find_duplicates(docs).collect()), key=str)
    assert got == brute(rows)
    kept = exact.drop_duplicates(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["10", "11", "3", "6", "7", "9", "None"]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6), (2, "a", 7, 8), (1, "a", 5, 6), (None, "b", 1, 1)], "doc_id int, text string, __digest int, __own int")
    assert sorted(map(str, exact.drop_duplicates(docs).collect())) == sorted(map(str, docs.where("doc_id is null or doc_id = 1").distinct().collect()))


def test_whole_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a", 5)], "doc_id long, text string, n int")
    plan = exact.drop_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(__digest") == 2  # the texts, and the digests that stay


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a", 0, ""), (1, "a", 0, "")], SCHEMA)
    assert exact.drop_duplicates(docs).count() == 1
    assert exact.find_duplicates(docs.limit(0)).count() == 0


def test_index_changes(spark):
    docs = lambda *texts: spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA)
    index = exact.apply_changes(None, docs("a", "a ", "b"))
    index = exact.apply_changes(index, docs("c"), docs("a", "b", "never"))
    live = {r.digest: r.live for r in index.collect()}
    assert live == {hashlib.sha256(t.encode()).hexdigest(): 1 for t in "ac"}
