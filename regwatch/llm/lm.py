"""Language-model scores by deleted interpolation of bigrams.

The model mixes the maximum-likelihood estimates of bigrams and unigrams and a uniform share. The mixture weights
depend on how often the context occurs (buckets by powers of two) and are learned by expectation-maximisation on the
counts of held-out training documents, against estimates from the other training documents; the final estimates use
all training documents. Each round of EM is a sum over all held-out counts, which Spark adds up; the driver sees three
numbers of each bucket.

Counts never pass through one place. Documents are packed into chunks; a chunk sends its distinct tokens and bigrams,
as sorted hashes cut into ranges, each range sums over all chunks, and what the totals exceed the chunk's own counts by
comes back to it. A message holds a key at least, so there are never more of them than distinct tokens and bigrams.

Tokens: words without white space, A-Z lower-cased, then one end token, which also is the context of the first word.
Fold 1 of the crc32 of doc_id modulo 5 is held out from all learning; fold 0 gives the counts that the weights are
learned on.

Defined results: null text counts as empty and is the end token alone; a null doc_id counts as the empty text in the
fold; repeated rows are scored each by itself and counted each; very long texts are scored whole, in one chunk; an empty
table gives an empty result; further columns, whatever their names, are ignored; without training documents the score
is that of the uniform share. There are no ties to settle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, fold, hashes, mixed, text_of

FOLDS, HELD_OUT, TUNING = 5, 1, 0
CHUNK_CHARS = 12_000_000
#: EM ends when no weight changes by more than SETTLED any more, or after so many rounds.
BUCKETS, EM_ROUNDS, SETTLED, FLOOR = 32, 40, 1e-3, 1e-4
END = xxhash.xxh3_64_intdigest(b" ")  # no word holds a space
LEAST_RANGES = 64
WORD, PAIR = 0, 1


def _pack_counts(x: np.ndarray) -> bytes:
    """A byte for each count under 255; the others stand in full before them."""
    large = x[x >= 255].astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(len(large).to_bytes(8, "little") + large.tobytes() + np.minimum(x, 255).astype(np.uint8).tobytes())


def _unpack_counts(blob) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(bytes(blob))
    n = int.from_bytes(raw[:8], "little")
    out = np.frombuffer(raw, np.uint8, offset=8 + 8 * n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, np.int64, n, 8)
    return out


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps of six bytes where all fit, or of eight."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    head, gaps = gaps[:1].tobytes(), gaps[1:]
    small = not len(gaps) or gaps.max() < (1 << 48)
    return bytes([6 if small else 8]) + head + gaps.view(np.uint8).reshape(-1, 8)[:, : 6 if small else 8].tobytes()


def _unpack_keys(x) -> np.ndarray:
    x = np.frombuffer(x, np.uint8)
    width = int(x[0])
    gaps = np.zeros(((len(x) - 9) // width, 8), np.uint8)
    gaps[:, :width] = x[9:].reshape(-1, width)
    return np.cumsum(np.concatenate([x[1:9].view(np.uint64), gaps.view(np.uint64).ravel()]))


class Tokens:
    """Token hashes of the texts of a chunk, end to end, and their bigrams."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        self.bounds = np.concatenate([[0], np.cumsum([len(w) + 1 for w in split])]).astype(np.int64)
        n = int(self.bounds[-1])
        self.words = np.full(n, END, np.uint64)
        inside = np.ones(n, bool)
        inside[self.bounds[1:] - 1] = False
        self.words[inside] = hashes((w for words in split for w in words), n - len(split))
        self.before = np.concatenate([[np.uint64(END)], self.words[:-1]]).astype(np.uint64)
        self.pairs = mixed(mixed(self.before, 1) ^ self.words, 2)


def _chunked(chars: int):
    def chunked(batches):
        press = zstandard.ZstdCompressor(level=3)
        for ids, folds, texts in chunks(batches, ["doc_id", "fold", "text"], chars):
            coded = [b" ".join(t.encode("utf-8", "replace").lower().split()) for t in texts]
            for tuning in (True, False):
                own = [k for k, f in enumerate(folds) if (f == TUNING) == tuning]
                if own:
                    blob = press.compress(b"\n".join(coded[k] for k in own))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([[ids[k] for k in own]], pa.list_(pa.int64())), pa.array([[int(folds[k]) for k in own]], pa.list_(pa.int32())), pa.array([tuning]), pa.array([blob], pa.binary())],
                        ["ids", "folds", "tuning", "blob"],
                    )

    return chunked


def _opened(row) -> tuple[list, np.ndarray, Tokens]:
    texts = zstandard.ZstdDecompressor().decompress(bytes(row["blob"])).split(b"\n")
    return row["ids"], np.array(row["folds"]), Tokens(texts)


def _local(tokens: Tokens, folds: np.ndarray):
    """For words and for pairs: distinct keys, a place of each, the key of each token, and counts in training folds."""
    learned = np.repeat(folds, np.diff(tokens.bounds)) != HELD_OUT
    for kind, x in ((WORD, tokens.words), (PAIR, tokens.pairs)):
        keys, first, own = np.unique(x, return_index=True, return_inverse=True)
        yield kind, keys, first, own, np.bincount(own[learned], minlength=len(keys))


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    bits = ranges.bit_length() - 1
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange(ranges + 1, dtype=np.uint64))


def _sent(ranges: int):
    def sent(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, folds, tokens = _opened(row)
                for kind, keys, _, _, counts in _local(tokens, folds):
                    cuts = _cuts(keys, ranges)
                    own = np.flatnonzero(np.diff(cuts)).tolist()
                    parts = [slice(cuts[r], cuts[r + 1]) for r in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own, pa.int32()), pa.array([row["g"]] * len(own), pa.int64()), pa.array([kind] * len(own), pa.int32()), pa.array([row["tuning"]] * len(own)),
                            pa.array([_pack_keys(keys[p]) for p in parts], pa.binary()), pa.array([_pack_counts(counts[p]) for p in parts], pa.binary()),
                        ],
                        ["r", "g", "kind", "tuning", "keys", "n"],
                    )

    return sent


RETURNED = "g long, r int, kind int, others binary, estimated binary, n_a long, n_h long, v_a long, v_t long"


def _summed(table: pa.Table) -> pa.Table:
    """For each chunk, in the order of its keys, what the totals of this range exceed its own counts by, and for tuning
    chunks the totals of the estimation folds; and, with g null, the tokens and distinct tokens of the range."""
    out: list[dict] = []
    rows = table.to_pylist()
    for kind in (WORD, PAIR):
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        keys, counts = [_unpack_keys(r["keys"]) for r in own], [_unpack_counts(r["n"]) for r in own]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        places = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        estimated, tuning = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        for r, at, n in zip(own, places, counts, strict=True):
            (tuning if r["tuning"] else estimated)[at] += n  # a chunk names a key once
        for r, at, n in zip(own, places, counts, strict=True):
            out.append({"g": r["g"], "r": r["r"], "kind": kind, "others": _pack_counts(estimated[at] + tuning[at] - n), "estimated": _pack_counts(estimated[at]) if r["tuning"] else None})
        if kind == WORD:
            out.append({"g": None, "r": own[0]["r"], "kind": kind, "n_a": int(estimated.sum()), "n_h": int(tuning.sum()), "v_a": int((estimated > 0).sum()), "v_t": int((estimated + tuning > 0).sum())})
    names = [x.split()[0] for x in RETURNED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    return pa.table([pa.array([r.get(n) for r in out], k) for n, k in zip(names, kinds, strict=True)], names)


def _joined(back: list[dict], kind: int, column: str) -> np.ndarray:
    return np.concatenate([_unpack_counts(r[column]) for r in sorted((r for r in back if r["kind"] == kind), key=lambda r: r["r"])])


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.floor(np.log2(context + 1.0))).astype(np.int64)


def _estimates(pair: np.ndarray, context: np.ndarray, word: np.ndarray, n: int, v: int) -> np.ndarray:
    """Of the pair, the word and the uniform share: (events, 3)."""
    return np.stack([pair / np.maximum(1, context), word / max(1, n), np.full(len(pair), 1.0 / (v + 1))], 1)


EVENTS = "pair binary, context binary, word binary, n binary"


def _events(left: pa.Table, right: pa.Table) -> pa.Table:
    """The distinct pairs of a tuning chunk: counts of the pair, of its context and of the word in the estimation folds,
    and how often the chunk has the pair."""
    columns: list[list[bytes]] = [[], [], [], []]
    for row in left.to_pylist():
        _, folds, tokens = _opened(row)
        back = right.to_pylist()
        (_, keys, _, own, _), (_, _, first, _, n) = _local(tokens, folds)
        word = _joined(back, WORD, "estimated")
        before = np.concatenate([[np.searchsorted(keys, np.uint64(END))], own[:-1]])
        for column, x in zip(columns, (_joined(back, PAIR, "estimated"), word[before[first]], word[own[first]], n), strict=True):
            column.append(_pack_counts(x))
    return pa.table([pa.array(c, pa.binary()) for c in columns], [x.split()[0] for x in EVENTS.split(", ")])


def _expected(weights: np.ndarray, n: int, v: int):
    def expected(batches):
        total = np.zeros((BUCKETS, 4))
        for batch in batches:
            for row in batch.to_pylist():
                pair, context, word, times = (_unpack_counts(row[c]) for c in ("pair", "context", "word", "n"))
                b = _bucket(context)
                share = weights[b] * _estimates(pair, context, word, n, v)
                share *= (times / share.sum(1))[:, None]
                total += np.stack([np.bincount(b, x, BUCKETS) for x in (*share.T, times)], 1)
        used = np.flatnonzero(total[:, 3])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(x) for x in total[used].T)], ["b", "pair", "word", "uniform", "n"])

    return expected


def learn_weights(events: DataFrame, n: int, v: int) -> np.ndarray:
    """Weights of the pair, the word and the uniform share by bucket of the context's count, by EM over all events."""
    out = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(EM_ROUNDS):
        sums = events.mapInArrow(_expected(out, n, v), "b int, pair double, word double, uniform double, n double").groupBy("b").agg(*(F.sum(c).alias(c) for c in ("pair", "word", "uniform", "n"))).collect()
        new = out.copy()
        for r in sums:
            new[r.b] = np.array([r.pair, r.word, r.uniform]) / r.n
        moved, out = np.abs(new - out).max(), new
        if moved <= SETTLED:
            break
    out = np.maximum(out, FLOOR)
    return out / out.sum(1, keepdims=True)


def _scores(shared):
    def scores(left: pa.Table, right: pa.Table) -> pa.Table:
        weights, n, v = shared.value
        ids, folds, tokens = _opened(left.to_pylist()[0])
        back = right.to_pylist()
        (_, keys, _, own, words), (_, _, _, own_pair, pairs) = _local(tokens, folds)
        words, pairs = words + _joined(back, WORD, "others"), pairs + _joined(back, PAIR, "others")
        before = np.concatenate([[np.searchsorted(keys, np.uint64(END))], own[:-1]])
        context, word = words[before], words[own]
        mixture = (weights[_bucket(context)] * _estimates(pairs[own_pair], context, word, n, v)).sum(1)
        add = lambda z: np.add.reduceat(z, tokens.bounds[:-1])
        size = np.diff(tokens.bounds)
        return pa.table(
            [
                pa.array(ids, pa.int64()), pa.array(folds == HELD_OUT), pa.array(size), pa.array(add((word > 0).astype(np.int64))), pa.array(np.full(len(size), n)),
                pa.array(add(np.log10((word + 0.5) / (n + 0.5 * (v + 1))))), pa.array(add(np.log10(mixture))),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return scores


def score(docs: DataFrame, chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; about ``chars``
    characters make a chunk."""
    packed = text_of(docs, fold(F.col("doc_id"), FOLDS).cast("int").alias("fold")).mapInArrow(_chunked(chars), "ids array<long>, folds array<int>, tuning boolean, blob binary")
    packed = cut(packed.withColumn("g", F.monotonically_increasing_id()))
    ranges, groups = LEAST_RANGES, packed.count()
    while ranges < groups:
        ranges *= 2
    back = cut(packed.mapInArrow(_sent(ranges), "r int, g long, kind int, tuning boolean, keys binary, n binary").groupBy("r").applyInArrow(_summed, RETURNED))
    n_a, n_h, v_a, v_t = (x or 0 for x in back.where("g is null").agg(F.sum("n_a"), F.sum("n_h"), F.sum("v_a"), F.sum("v_t")).first())
    tuning = back.where("estimated is not null").select("g", "r", "kind", "estimated")
    events = cut(packed.where("tuning").groupBy("g").cogroup(tuning.groupBy("g")).applyInArrow(_events, EVENTS))
    shared = docs.sparkSession.sparkContext.broadcast((learn_weights(events, n_a, v_a), n_a + n_h, v_t))
    counts = back.where("g is not null").select("g", "r", "kind", "others")
    return packed.groupBy("g").cogroup(counts.groupBy("g")).applyInArrow(_scores(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
