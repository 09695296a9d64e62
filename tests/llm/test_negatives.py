import math
import random

import numpy as np
import pytest

from regwatch.llm import negatives


def brute(rows, every=50):
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        kept.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, la, va in kept:
        if a % every:
            continue
        scored = sorted((-dot(va, v), i, lab) for i, lab, v in kept)
        for s, i, _ in [x for x in scored if x[2] == la and x[1] != a][:5]:
            hits = [x for x in scored if x[2] != la and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(hits)]
    return sorted(out)


def rows_of(rng, n, width, spread=1.0):
    return [(i, [float(np.float32(rng.gauss(0.3, 0.4) * spread)) for _ in range(width)], rng.randrange(4)) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int, v int, copies int, score int"


@pytest.mark.parametrize(("n", "width", "spread"), [(700, 16, 1.0), (230, 150, 40.0), (160, 3, 2000.0)])
def test_negatives_match_brute_force(spark, monkeypatch, n, width, spread):
    monkeypatch.setattr(negatives, "BLOCK", 97)
    rng = random.Random(n)
    rows = rows_of(rng, n, width, spread)
    rows += [(None, [1.0] * width, 1), (n, None, 1), (n + 1, [1.0] * width, None), (n + 2, [float("nan")] * width, 1), (n + 3, [float("inf")] * width, 1), (n + 4, [None] + [1.0] * (width - 1), 1)]
    rows += [(n + 5, [], 1), (n + 6, [1.0], 2), rows[50], rows[50], rows[51], rows[3], (-50, rows[9][1], rows[9][2])]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in negatives.hard_negatives(docs).collect())
    assert got and got == brute(rows)


def test_rounds_give_the_same(spark, monkeypatch):
    rows = rows_of(random.Random(2), 400, 8)
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 8 * 8 * 3)
    assert sorted(tuple(r) for r in negatives.hard_negatives(docs).collect()) == brute(rows)


def test_residues_are_exact():
    rng = np.random.default_rng(1)
    for most, width in ((3, 1), (1 << 14, 64), (1 << 24, 200)):
        a, b = (rng.integers(-most, most + 1, (40, width)) for _ in range(2))
        codes = negatives.Residues(width * most * most + 1, width) if width * most * most < negatives.MOST else negatives.Residues(negatives.MOST - 1, width)
        exact = a @ b.T
        if np.abs(exact).max() < negatives.MOST:
            assert (codes.products(codes.of(a), codes.of(b)) == exact).all()
    with pytest.raises(ValueError):
        negatives.Residues(1 << 50, 4)


def test_empty_tables_and_missing_partners(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty).collect() == []
    alone = spark.createDataFrame([(50, [1.0, 2.0], 1, 1, 2, 3), (51, [1.0, 1.0], 2, 1, 2, 3)], SCHEMA)
    assert negatives.hard_negatives(alone).collect() == []
    assert negatives.hard_negatives(alone).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
