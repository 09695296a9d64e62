import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from regwatch.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, seq string, node string"


def brute(rows, group=20, heads=4):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32], (r, t)))
    turns = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in convs.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        made[c] = turns.get(c - int(np.fmod(c, group)), [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) if children[p] else 1
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = own + sum(saved[x] for x in children[p])
    key = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], key(p)) for p, m in members.items())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)


def some_rows(rng, n, texts):
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in range(n) for t in range(rng.choice([1, 2, 3, 4, 7, 12]))]
    rows += [(c, t, "system", "same") for c in range(n, n + 60) for t in range(5)]
    return rows


def order(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("limits", [(1 << 16, 1 << 14), (13, 5), (1, 1)])
def test_tree_matches_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr(trie, "SHARD_TURNS", limits[0])
    monkeypatch.setattr(trie, "SHARD_ROWS", limits[1])
    rng = random.Random(1)
    rows = some_rows(rng, 150, ["a", "b b", "", None, "  c\td e ", "日本 😀"])
    rows += [(None, 1, "user", "lost"), (7, None, "user", "first"), (7, 2, "user", "tie"), (7, 2, "user", "tie"), (7, 2, "x", "other"), (-5, 0, "user", "minus"), (-5, 1, "user", "minus two"), (0, 3, "user", "base"), (0, 4, "user", "base")]
    rows += [(2000, t, "user", f"long {t}") for t in range(700)] + [(2001, t, "user", f"long {t}") for t in range(650)]
    got = trie.prefix_tree(table(spark, rows))
    assert [c for c in got.columns] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(brute(rows), key=order)


def test_empty_table_and_turnless(spark):
    assert trie.prefix_tree(table(spark, []).limit(0)).count() == 0
    one = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(one, 0, "user", "a"), (one, 1, "user", "b")]
    got = [tuple(r) for r in trie.prefix_tree(table(spark, rows)).collect()]
    assert got == brute(rows) and got[0][:7] == (one, 0, None, 1, 0, 1, 0)


def test_double_array_knows_its_sequences_and_no_others(spark):
    rng = np.random.default_rng(3)
    seqs = sorted({tuple(rng.integers(1, 9, rng.integers(0, 7))) for _ in range(900)})
    codes = np.array([c for s in seqs for c in s], np.int64)
    lengths = np.array([len(s) for s in seqs])
    packed = trie.packed(codes, np.cumsum(lengths) - lengths, lengths)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    states = {(): 0}
    for p in sorted(prefixes, key=len):
        for c in range(1, 9):
            t = int(packed.step(np.array([states[p]]), np.array([c]))[0])
            assert (t >= 0) == (p + (c,) in prefixes)
            if t >= 0:
                states[p + (c,)] = t
    assert len(set(states.values())) == len(states) and (packed.check >= 0).sum() == len(states)


def test_packed_tries_find_prefixes(spark):
    rows = some_rows(random.Random(2), 40, ["a", "b", "c"])
    seqs = trie.sequences(table(spark, rows))
    shards = trie.tries(seqs).collect()
    for r in seqs.collect():
        assert max(trie.find(s.turns, s.base, s.check, r.seq + "f" * 32) for s in shards) == len(r.seq) // 32
    assert trie.find(shards[0].turns, shards[0].base, shards[0].check, "") == 0
