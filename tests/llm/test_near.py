import random
from collections import Counter

import numpy as np
import pytest

from regwatch.llm import graph, near
from regwatch.llm.common import words_in


def shingles(text):
    w = (text or "").lower().encode().split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    return (a & b).total() / max(1, (a | b).total())


def brute(rows):
    ids = sorted({d for d, _ in rows})
    own = [(d, shingles(t)) for d, t in rows]
    top = {d: d for d in ids}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, x) in enumerate(own):
        for b, y in own[:i]:
            if (not x and not y) or (x and y and 5 * (x & y).total() >= 4 * (x | y).total()):
                p, q = root(a), root(b)
                top[max(p, q)] = min(p, q)
    return {d: root(d) for d in ids}


def test_agreement_follows_similarity():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    a = rng.choices(words, k=400)
    b = a[:300] + rng.choices(words, k=100)
    want = jaccard(shingles(" ".join(a)), shingles(" ".join(b)))
    x, y = (near.signature(near.strips(words_in([" ".join(t).encode()])[0]), 3000) for t in (a, b))
    assert abs((x == y).mean() - want) < 0.04
    heavy, light = "p q r s t " * 8, "p q r s t " * 4
    want = jaccard(shingles(heavy), shingles(light))
    x, y = (near.signature(near.strips(words_in([t.encode()])[0]), 3000) for t in (heavy, light))
    assert abs((x == y).mean() - want) < 0.04


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)]
    top = {n: n for e in edges for n in e}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        p, q = root(a), root(b)
        top[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in {x for a, b in edges if a != b for x in (a, b)}}


def test_classes_match_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 80)))) for i in range(60)]
    base = rng.choices(words, k=150)
    for i in range(100, 300):  # a family whose members are often not linked with each other
        t = list(base)
        for _ in range(rng.randrange(7)):
            t[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(t)))
    for i in range(300, 320):  # copies of copies
        t = rows[-1][1].split()
        t[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(t)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a b c"), (504, "A  b c"), (505, "one two " * 20000), (506, "one two " * 19000), (507, rows[0][1]), (507, rows[0][1])]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows] + [(None, "a b c", 1, 2), (None, "sole", 1, 2)], "doc_id long, text string, node int, content int")
    want = brute(rows)
    assert len(set(want.values())) < len(want) - 100
    got = near.classes(docs).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert sorted((r.class_id == 503, r.kept) for r in got if r.doc_id is None) == [(False, True), (True, False)]
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} - {None} == set(want.values())
    assert near.classes(docs.limit(0)).count() == 0


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7, 8), (2, "A b c d e  f", 7, 8), (None, None, 7, 8)], "doc_id int, text string, __id int, own int")
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, None}


def test_components_of_nothing_and_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert graph.components(edges.limit(0)).count() == 0
    assert {r.component for r in graph.components(edges).collect()} == {0}
    with pytest.raises(RuntimeError):
        graph.components(edges, rounds=1)


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for family in range(3):  # families whose members meet in buckets without all being linked
        base = rng.choices(words, k=120)
        for i in range(40):
            t = list(base)
            for _ in range(rng.randrange(8)):
                t[rng.randrange(120)] = rng.choice(words)
            rows.append((family * 100 + i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near.classes(docs).collect()} == brute(rows)


def test_search_in_blocks_finds_all_components():
    import pyarrow as pa

    sets = [np.sort(np.random.default_rng(k).integers(0, 1 << 60, 50).astype(np.uint64)) for k in range(3)]
    sets += [np.sort(np.concatenate([s[:48], [np.uint64(7 + k), np.uint64(9 + k)]]).astype(np.uint64)) for k, s in enumerate(sets)]
    table = pa.table({"node": list(range(6)), "component": list(range(6)), "block": [0, 0, 0, 1, 1, 1], "strips": [s.tobytes() for s in sets]})
    got = near._searched(table).to_pylist()
    assert sorted((x["a"], x["b"]) for x in got) == [(0, 3), (1, 4), (2, 5)]
