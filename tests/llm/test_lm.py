import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from regwatch.llm import lm


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def brute(rows):
    """The model by dictionaries; EM over single events."""
    folds = [zlib.crc32(str("" if d is None else d).encode()) % 5 for d, _ in rows]

    def counts(wanted):
        words, pairs = Counter(), Counter()
        for (_, t), f in zip(rows, folds, strict=True):
            if f in wanted:
                seq = tokens(t)
                words.update(seq)
                pairs.update(zip([b" ", *seq], seq, strict=False))
        return words, pairs, sum(words.values()), len(words)

    def parts(model, a, b):
        words, pairs, n, v = model
        return [pairs[a, b] / max(1, words[a]), words[b] / max(1, n), 1 / (v + 1)]

    bucket = lambda model, a: min(lm.BUCKETS - 1, int(math.log2(model[0][a] + 1)))
    first, full = counts({2, 3, 4}), counts({0, 2, 3, 4})
    events = [(bucket(first, a), parts(first, a, b)) for (_, t), f in zip(rows, folds, strict=True) if f == 0 for a, b in zip([b" ", *tokens(t)], tokens(t), strict=False)]
    weights = np.full((lm.BUCKETS, 3), 1 / 3)
    for _ in range(lm.EM_ROUNDS):
        old = weights.copy()
        for k in {b for b, _ in events}:
            share = weights[k] * np.array([x for b, x in events if b == k])
            weights[k] = (share / share.sum(1, keepdims=True)).mean(0)
        if abs(weights - old).max() <= lm.SETTLED:
            break
    weights = np.maximum(weights, lm.FLOOR)
    weights /= weights.sum(1, keepdims=True)
    out = []
    words, _, n, v = full
    for (d, t), f in zip(rows, folds, strict=True):
        seq = tokens(t)
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in seq)
        own = sum(math.log10(float(weights[bucket(full, a)] @ parts(full, a, b))) for a, b in zip([b" ", *seq], seq, strict=False))
        out.append((d, f == 1, len(seq), sum(words[w] > 0 for w in seq), n, base, own))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"W{i}" for i in range(80)]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(80)], k=rng.randrange(60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "w1 \0 É w2\x1c"), (903, "w3 " * 20000), (None, "w1 w2"), (904, "w1"), (904, "w1")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fold int, g int")
    got = sorted((tuple(r) for r in lm.score(docs).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
    assert lm.score(docs.limit(0)).count() == 0
    alone = lm.score(docs.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].score < 0


def test_counts_pack_and_unpack():
    for counts in ([], [0], [254, 255, 256, 1 << 40, 3], list(range(600))):
        assert lm._unpack_counts(lm._pack_counts(np.array(counts, np.int64))).tolist() == counts


def test_chunks_and_ranges_change_nothing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=30))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {r.doc_id: r for r in lm.score(docs).collect()}
    got = {r.doc_id: r for r in lm.score(docs.repartition(3), 300).collect()}
    assert got.keys() == want.keys()
    for d, r in got.items():
        assert r[:5] == want[d][:5] and r.base_score == pytest.approx(want[d].base_score) and r.score == pytest.approx(want[d].score, rel=1e-6)


def test_keys_pack_and_unpack():
    for keys in ([5], [1, 2, 3], [0, 1 << 63, (1 << 64) - 1], list(range(7, 10**6, 999))):
        assert lm._unpack_keys(lm._pack_keys(np.array(keys, np.uint64))).tolist() == keys
