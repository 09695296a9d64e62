import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from regwatch.llm import fingerprint as fp

BINS, REST = fp.BINS, (1 << 56) - 1


def signed(x, bits=64):
    return x - (1 << bits) if x >> (bits - 1) else x


def murmur(*ints):
    """Spark's hash of ints: 32-bit Murmur3 with seed 42, each value with the hash before it as seed."""
    h, m = 42, 0xFFFFFFFF
    for k in ints:
        k = (k & m) * 0xCC9E2D51 & m
        k = ((k << 15 | k >> 17) & m) * 0x1B873593 & m
        h ^= k
        h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
        h ^= 4
        h = (h ^ h >> 16) * 0x85EBCA6B & m
        h = (h ^ h >> 13) * 0xC2B2AE35 & m
        h ^= h >> 16
    return signed(h, 32)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    groups = [words[i : i + 5] for i in range(len(words) - 4)] or ([words] if words else [])

    def chained(group):
        h = 42
        for w in group:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        return h

    return {chained(g) for g in groups}


def brute(text):
    held = [None] * BINS
    for h in shingles(text):
        b = (h >> 56) ^ 128  # signed order: the sign bit first
        held[b] = min(held[b] if held[b] is not None else REST, h & REST)
    if all(v is None for v in held):
        return ""
    asked = lambda i: next((held[murmur(i, t) & 255] for t in range(fp.ASKED) if held[murmur(i, t) & 255] is not None), None)
    out = []
    for i, v in enumerate(held):
        v = v if v is not None else asked(i)
        if v is None:
            seeds = [(signed(xxhash.xxh64_intdigest(signed(b ^ 128, 8).to_bytes(8, "little", signed=True), seed=xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed=42))), x) for b, x in enumerate(held) if x is not None]
            v = min(seeds)[1]
        out.append(f"{v & 15:x}")
    return "".join(out)


def alike(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    return max(0.0, (sum(x == y for x, y in zip(a, b, strict=True)) / BINS - 1 / 16) / (15 / 16))


def corpus(rng, n):
    words = ["wa", "to", "né", "x", "lo-ng", "日本", "q.", "😀"]
    return [(i * 3, rng.choice([" ", "\n", "\t\x0b"]).join(rng.choices(words, k=rng.choice([0, 1, 2, 4, 5, 6, 9, 30, 200, 700])))) for i in range(n)]


def test_edits_match_brute_force(spark):
    rows = corpus(random.Random(5), 120) + [(5000, None), (5001, ""), (5001, "a b"), (5001, ""), (None, "b c d e f g"), (-4, " \n"), (9000, "long " * 30000 + "end")]
    docs = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], "doc_id long, text string, next_text int, edited string, __at int").repartition(3)
    got = sorted((tuple(r) for r in fp.edits(docs).collect()), key=lambda r: (r[0] is not None, r[0], r[2]))
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0], r[1].encode()))
    want = []
    for k, (d, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b = brute(t), brute(edited)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, brute(after))))
    want.sort(key=lambda r: (r[0] is not None, r[0], r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


def test_likeness_is_close_to_the_share_of_shingles(spark):
    rng, pairs = random.Random(6), []
    for k in range(120):
        a = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([40, 150, 600]))]
        cut = int(len(a) * rng.random())
        pairs.append((k, " ".join(a), " ".join(a[:cut] + [f"v{rng.randrange(10**6)}" for _ in a[cut:]])))
    both = fp.with_fingerprint(fp.with_fingerprint(spark.createDataFrame(pairs, "k long, text string, other string"), "text", "a"), "other", "b")
    got = {r.k: r.like for r in both.select("k", fp.likeness(F.col("a"), F.col("b")).alias("like")).collect()}
    true = {k: len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for k, a, b in pairs}
    errors = np.array([got[k] - true[k] for k in true])
    assert abs(errors.mean()) < 0.01 and np.abs(errors).max() < 0.15 and np.sqrt((errors**2).mean()) < 0.045


def test_empty_and_single(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert fp.edits(docs.limit(0)).count() == 0 and fp.with_fingerprint(docs.limit(0)).count() == 0
    r = fp.edits(docs).first()
    assert (r.edited_sha256, r.near_next) == (hashlib.sha256(b"a b c d a b c d"[:8] + b"a b c d").hexdigest(), 1.0)


def bodies(plan):
    """What stands inside the lambdas of a plan."""
    for m in re.finditer(r"lambdafunction\(", plan):
        depth, k = 1, m.end()
        while depth and k < len(plan):
            depth += {"(": 1, ")": -1}.get(plan[k], 0)
            k += 1
        yield plan[m.end() : k]


def test_plan_has_no_python_and_computes_no_step_in_a_lambda(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = fp.edits(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.count("split(") <= 3  # documents, guests and edited texts
    for inside in bodies(plan):
        assert not re.search("split|sort_array|zip_with|concat", inside)
