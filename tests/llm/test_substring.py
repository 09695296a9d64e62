import hashlib
import random

import numpy as np
import pytest

from regwatch.llm import substring
from regwatch.llm.common import hashes, words_in


def brute(rows, width):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - width + 1):
            if d is not None:
                key = tuple(w[k : k + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - width + 1):
            if d is not None and first[tuple(w[k : k + width])] < d:
                gone |= set(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    small, large = [f"w{i}" for i in range(4)], [f"w{i}" for i in range(4000)]
    passages = [rng.choices(large, k=n) for n in (49, 50, 51, 60, 90, 200)] + [["a"] * 130, ["a", "b"] * 60, rng.choices(small, k=100)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2)
            words += rng.choices(large, k=rng.randrange(20)) + p[cut * (rng.random() < 0.4) :]
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    rows += [(500, None), (501, ""), (502, "q " * 30000), (503, rows[5][1]), (504, rows[5][1].replace(" ", "\n")), (505, rows[6][1] + " end"), (505, rows[7][1]), (None, rows[7][1]), (1, rows[0][1])]
    return rows


def test_equal_windows_have_equal_anchors():
    rng = random.Random(0)
    for seed in range(6):
        rng = random.Random(seed)
        words = [b"%d" % rng.randrange(rng.choice([2, 30, 5000])) for _ in range(400)]
        inner = words[100:150]
        seen = set()
        for _ in range(20):
            text = [b"%d" % rng.randrange(9000) for _ in range(rng.randrange(70))] + inner + [b"%d" % rng.randrange(9000) for _ in range(rng.randrange(70))]
            at = next(k for k in range(len(text)) if text[k : k + 50] == inner)
            other = [b"x"] * 7
            h = hashes(other + text, len(text) + 7)
            starts, keys, places = substring.windows(h, np.array([0, 7, 7 + len(text)]))
            seen.add(int(keys[starts.tolist().index(7 + at)]))
        assert len(seen) == 1


def test_words_hash_alike_wherever_they_stand():
    rng = random.Random(5)
    words = [bytes(rng.choices(b"ab\xc3\xa9\0", k=rng.randrange(1, 90))) for _ in range(300)]
    texts = [b"".join(rng.choice([b" ", b"\n\n", b"\t "]) + w for w in rng.choices(words, k=rng.randrange(9))) + b" " * rng.randrange(2) for _ in range(200)]
    h, bounds = words_in(texts)
    seen = {}
    for t, lo, hi in zip(texts, bounds, bounds[1:], strict=False):
        assert hi - lo == len(t.split())
        for w, x in zip(t.split(), h[lo:hi].tolist(), strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    assert [x.tolist() for x in words_in([])] == [[], [0]] and words_in([b"", b" "])[1].tolist() == [0, 0, 0]


def test_rounds_shrink_periodic_texts():
    h = hashes([b"a", b"b"] * 2000, 4000)
    sizes = [len(sym) for sym, _, _ in substring.levels(h, np.array([0, 4000]))]
    assert sizes[0] == 4000 and sizes[-1] <= 4
    assert [len(x[0]) for x in substring.levels(hashes([b"q"] * 900, 900), np.array([0, 900]))][1] == 1


def test_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, 5, 6), (2, f"x {text} y", 7, 8), (None, None, 9, 9)], "doc_id int, text string, __id int, __idplaces int")
    got = substring.remove(docs)
    assert got.columns == docs.columns and {tuple(r) for r in got.collect()} == {(1, text, 5, 6), (2, "x y", 7, 8), (None, None, 9, 9)}


@pytest.mark.parametrize("hot", [20_000, 3])
def test_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_STRETCHES", hot)
    rows = corpus(1)
    docs = spark.createDataFrame([(*r, 3, "z") for r in rows], "doc_id long, text string, n_words int, sha string")
    want = brute(rows, substring.WINDOW)
    assert sum(0 < x[2] < x[1] for x in want) > 30
    got = substring.report(docs).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(x[:4]) for x in want)
    removed = substring.remove(docs)
    assert removed.columns == docs.columns
    assert sorted((str(r.doc_id), " ".join((r.text or "").split())) for r in removed.collect()) == sorted((str(x[0]), x[4]) for x in want)
    assert substring.report(docs.limit(0)).count() == 0
