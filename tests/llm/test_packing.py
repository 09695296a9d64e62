import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regwatch.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def lay_out(counts, capacity):
    """Every piece of a plan by itself: (sequence, offset, length)."""
    plan = packing.Plan(counts, capacity)
    out = [(first + q // each, offset + q % each * size, size) for size, _, bins, each, first, offset in plan.runs for q in range(bins * each)]
    return plan, out


def optimum(sizes, capacity):
    """Fewest bins by trying everything."""
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] + sizes[i] <= capacity:
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_gapless_and_close_to_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 20])
    sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randrange(1, 10))), reverse=True)
    counts = {s: sizes.count(s) for s in sizes}
    plan, out = lay_out(counts, capacity)
    assert sorted(x[2] for x in out) == sorted(sizes)
    bins = {}
    for seq, at, size in sorted(out):
        assert at == bins.get(seq, 0)
        bins[seq] = at + size
    assert max(bins.values()) <= capacity and len(bins) == plan.bins
    assert plan.bins <= optimum(sizes, capacity) + 1
    # what the reduction fixes is part of an optimal packing
    fixed = [x[2] for x in out if x[0] < plan.fixed]
    rest = list(sizes)
    for s in fixed:
        rest.remove(s)
    assert plan.fixed + optimum(sorted(rest, reverse=True), capacity) == optimum(sizes, capacity)


def test_words_encode_as_the_whole_text():
    tok = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    bits = ["the", "The,", "don't", "I'LL", "ünß", "²x", "a1b22", "%%%", " ", "\n", "\t", "\xa0", "\x1c", "日本", "é", "Σς", "İ", "<|endoftext|>", "_'s", "😀", "\x85", "ª", "µm", " ", "﻿"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(3000)] + [""]
    got = packing.PartTokens(PATH).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_forgetting_parts_changes_no_ids(monkeypatch):
    texts = [f"w{i % 50}x the {i}, {'q' * (i % 9)}" for i in range(400)]
    want = packing.PartTokens(PATH).encode(texts)
    monkeypatch.setattr(packing, "REMEMBERED", 20_000)
    tokens = packing.PartTokens(PATH)
    assert [tokens.encode([t])[0] for t in texts] == want
    assert len(tokens.young) + len(tokens.old) < 150


def test_rows_without_ids_spread_over_buckets(spark):
    rows = [(None, 0, 7, 5)] * 3000 + [(1, 0, 7, 3)] * 3
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, __place int, length long").checkpoint()
    got = packing.pack(pieces, 16).collect()
    assert len(got) == 3003 and got[0]["__place"] == 7
    assert len({(r.sequence_id, r.offset) for r in got}) == 3003


def test_documents_are_packed(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "Γ"]) for _ in range(rng.choice([0, 3, 40, 300])))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "word " * 900), (None, "x y"), (503, "dup"), (503, "dup")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, length int, offset string")
    got = packing.pack_documents(docs, PATH, 256).collect()
    tok, want = Tokenizer.from_file(PATH), []
    for doc_id, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(doc_id, k, at, len(ids[at : at + 256]), zlib.crc32(np.array(ids[at : at + 256], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 256))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 256 and len(ends) <= -(-sum(x[3] for x in want) // 256) + 5
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
    built = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(docs, PATH, 256).collect()}
    assert built == ends
