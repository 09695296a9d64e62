"""Long repeated passages across documents, by recompression.

A text is a string of word symbols. Each round first names the runs of equal symbols, then splits the symbols into left
and right ones by a hash and names every pair of a left symbol before a right one. Names are hashes of what they stand
for, so they are the same in all documents without being exchanged, and all rounds of a text run in the task that holds
it. Each symbol knows the stretch of words that alone decides it; wherever that stretch occurs, in any text, the symbol
does too. So every window of WINDOW words has an anchor that depends on its words only: of the symbols decided within
it, on the highest level that has one, the one of least hash. Windows that are equal have equal anchors.

Spark then joins: anchors that occur in several documents reveal candidates. Runs of windows under one anchor are
verified by the hash of their whole stretch; where stretches of an anchor differ, one document of each stretch is
compared with the others window by window. Texts are read again for this rather than shuffled: Bloom filters of a
bounded size tell a task which of its anchors matter, and what they let pass beyond that is only more to compare.

Defined results: words are runs without white space, unchanged; null and empty texts have none; a word goes when a
window that covers it also starts in a document of smaller doc_id, judged on the input; rows of null doc_id neither
lose words nor make others lose any; rows that share a doc_id do not affect each other; a text shorter than a window
keeps all; very long texts are treated whole, like all others; an empty table gives an empty result; further columns,
whatever their names, are ignored by ``report`` and kept by ``remove``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom, chunks, cut, free, in_bloom, mixed, powers, text_of, words_in, words_of

WINDOW, ROUNDS = 50, 4
#: Bits of a Bloom filter for each anchor.
ANCHOR_BITS = 16
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Characters and rows of the texts that a task takes up at once, plain and compressed.
CHUNK, PRESSED, ROWS = 400_000, 1_000_000, 64
#: Stretches of an anchor beyond which its windows are joined one by one, and windows of a bucket of other anchors.
HOT_STRETCHES, BUCKET_WINDOWS = 20_000, 1_000_000


def stretch_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words from each start to before each end."""
    n = 1 << max(10, int(len(h) + 1).bit_length())
    up, down = powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h, 21) * up[: len(h)])])
    return mixed((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64), 22)


def levels(h: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level the symbols and the stretch [lo, hi) that decides each. Texts lie end to end: text d has the words
    bounds[d] to bounds[d + 1]; what hangs on a text's end is decided by no stretch inside it."""
    n = len(h)
    d = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    sym, lo, hi = h, np.arange(n), np.arange(n) + 1
    out = [(sym, lo, hi)]

    def neighbours(d, lo, hi):
        """lo of the symbol before and hi of the one after, or beyond the text."""
        before, after = bounds[d] - 1, bounds[d + 1] + 1
        same = d[1:] == d[:-1]
        before[1:] = np.where(same, lo[:-1], before[1:])
        after[:-1] = np.where(same, hi[1:], after[:-1])
        return before, after

    for k in range(ROUNDS if n else 0):
        # runs: a symbol is decided by its neighbours too, as they end its run
        first = np.ones(len(sym), bool)
        first[1:] = (sym[1:] != sym[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(first)
        last = np.concatenate([at[1:], [len(sym)]]) - 1
        before, after = neighbours(d, lo, hi)
        size = (last - at + 1).astype(np.uint64)
        sym = np.where(size > 1, mixed(sym[at] ^ mixed(size, 31 + k), 51 + k), sym[at])
        lo, hi, d = before[at], after[last], d[at]
        out.append((sym, lo, hi))
        # pairs
        left = mixed(sym, 100 + k) & np.uint64(1) > 0
        pair = np.zeros(len(sym), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (d[1:] == d[:-1])
        second = np.zeros(len(sym), bool)
        second[1:] = pair[:-1]
        before, after = neighbours(d, lo, hi)
        nxt = np.concatenate([sym[1:], sym[:1]])
        new = np.where(pair, mixed(sym * BASE ^ mixed(nxt, 200 + k), 300 + k), sym)
        lo = np.where(left | second, lo, before)
        hi = np.where(left, after, hi)  # of a pair: hi of its right symbol, which is the neighbour's
        keep = ~second
        sym, lo, hi, d = new[keep], lo[keep], hi[keep], d[keep]
        out.append((sym, lo, hi))
    return out


def windows(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window, its anchor's key, and a number of the anchor's occurrence."""
    count = np.maximum(0, np.diff(bounds) - WINDOW + 1)
    starts = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
    keys, places = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    stack = levels(h, bounds)
    for level in range(len(stack) - 1, -1, -1):
        if not len(open_):
            break
        sym, lo, hi = stack[level]
        w = starts[open_]
        i, j = np.searchsorted(lo, w, "left"), np.searchsorted(hi, w + WINDOW, "right") - 1
        ok = i <= j
        i, j, done = i[ok], j[ok], open_[ok]
        rank = mixed(sym, 400 + level)
        best = i.copy()
        for step in range(1, int((j - i).max(initial=0)) + 1):
            at = np.minimum(i + step, j)
            best = np.where(rank[at] < rank[best], at, best)
        keys[done] = rank[best]
        places[done] = best * len(stack) + level
        open_ = open_[~ok]
    return starts, keys, places


def runs(h: np.ndarray, bounds: np.ndarray):
    """Runs of successive windows under one anchor: first index into the windows and one past the last, with the windows."""
    starts, keys, places = windows(h, bounds)
    new = np.ones(len(starts), bool)
    new[1:] = (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    return starts, keys, first, np.concatenate([first[1:], [len(starts)]])


def _pressed(batches):
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            texts = [press.compress(b" ".join(words_of(t))) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])


def pressed(texts: DataFrame) -> DataFrame:
    """doc_id and the words of the text, compressed for a shuffle."""
    return texts.mapInArrow(_pressed, "doc_id long, text binary")


def _texts(batches):
    """doc_id and text (as bytes) of chunks, with the hashes of the words and the bounds of the texts."""
    for ids, texts in chunks(batches, ["doc_id", "text"], CHUNK, ROWS):
        coded = [t.encode("utf-8", "replace") for t in texts]
        yield ids, coded, *words_in(coded)


def _short(sha: str) -> int:
    return int.from_bytes(bytes.fromhex(sha[:16]), "big", signed=True)


def _sha(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


def _scanned(batches):
    for ids, texts, h, bounds in _texts(batches):
        starts, keys, first, _ = runs(h, bounds)
        owner = np.searchsorted(bounds, starts[first], "right") - 1
        own = np.split(keys[first], np.searchsorted(owner, np.arange(1, len(texts))))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(map(_sha, texts), pa.string()),
                pa.array([np.unique(k).view(np.int64) for k in own], pa.list_(pa.int64())),
            ],
            ["doc_id", "n_words", "sha", "keys"],
        )


def _marks(texts: list[bytes], owner: np.ndarray) -> np.ndarray:
    """For each owner a short mark of the text, as rows may share a doc_id."""
    marks = {k: _short(_sha(texts[k])) for k in np.unique(owner).tolist()}
    return np.array([marks[k] for k in owner.tolist()], np.int64)


def _met(shared):
    """Runs of windows whose anchors may occur elsewhere, with the hash of their stretch."""

    def met(batches):
        for ids, texts, h, bounds in _texts(batches):
            starts, keys, first, last = runs(h, bounds)
            keep = in_bloom(shared.value, keys[first])
            first, last = first[keep], last[keep]
            owner = np.searchsorted(bounds, starts[first], "right") - 1
            spans = stretch_hashes(h, starts[first], starts[last - 1] + WINDOW)
            columns = [np.array(ids, np.int64)[owner], _marks(texts, owner), keys[first].view(np.int64), spans.view(np.int64), (starts[first] - bounds[owner]).astype(np.int32), (last - first).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["doc_id", "mark", "key", "span", "start", "n"])

    return met


def _first_of(key: np.ndarray, span: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    return mixed(mixed(key, 41) ^ mixed(span, 42) ^ mixed(doc_id, 43), 44)


def _named(batches):
    """The one hash of (key, span, lo) by which a task knows the runs that it is to compare."""
    for batch in batches:
        key, span, lo = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "span", "lo"))
        yield pa.RecordBatch.from_arrays([pa.array(_first_of(key, span, lo).view(np.int64))], ["key"])


def _single(shared, hot: bool):
    """The windows of the runs that stand for all equal stretches of an anchor with several: a row for each run of an
    anchor with few stretches, or for each window of the hot ones."""

    def single(batches):
        firsts, hot_keys = shared.value
        for ids, texts, h, bounds in _texts(batches):
            starts, keys, first, last = runs(h, bounds)
            owner = np.searchsorted(bounds, starts[first], "right") - 1
            spans = stretch_hashes(h, starts[first], starts[last - 1] + WINDOW)
            keep = in_bloom(firsts, _first_of(keys[first], spans, np.array(ids, np.int64)[owner].view(np.uint64)))
            if hot_keys is not None:
                is_hot = np.zeros(len(first), bool)
                is_hot[in_bloom(hot_keys, keys[first])] = True
                keep = keep[is_hot[keep] == hot]
            first, last, owner = first[keep], last[keep], owner[keep]
            each = stretch_hashes(h, starts, starts + WINDOW).view(np.int64)
            marks = _marks(texts, owner)
            if hot:
                sizes = last - first
                at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                owner, marks, found = np.repeat(owner, sizes), np.repeat(marks, sizes), each[at]
            else:
                at, found = first, pa.array([each[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())
            columns = [np.array(ids, np.int64)[owner], marks, keys[at].view(np.int64), found, (starts[at] - bounds[owner]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["doc_id", "mark", "key", "windows", "start"])

    return single


def _compared(table: pa.Table) -> pa.Table:
    """Of the runs of a bucket of anchors the stretches of windows that a smaller document has too."""
    ids, marks, start = (table.column(c).to_numpy() for c in ("doc_id", "mark", "start"))
    each = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("windows")]
    sizes = np.array([len(x) for x in each])
    row = np.repeat(np.arange(len(each)), sizes)
    _, code = np.unique(np.concatenate(each), return_inverse=True)
    least = np.full(int(code.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids[row])
    hit = np.flatnonzero(least[code] < ids[row])
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(hit)))
    at = hit[first]
    turn = at - (np.cumsum(sizes) - sizes)[row[at]]
    return pa.table([pa.array(ids[row[at]]), pa.array(marks[row[at]]), pa.array((start[row[at]] + turn).astype(np.int32)), pa.array(n.astype(np.int32))], ["doc_id", "mark", "start", "n"])


STRETCHES = "doc_id long, mark long, start int, n int"


def _anchors(scan: DataFrame, least: DataFrame) -> np.ndarray:
    """A Bloom filter of the anchors that several texts have."""
    own = scan.join(least, "sha").where("doc_id = least").select(F.explode("keys").alias("key"))
    return bloom(cut(own.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")), ANCHOR_BITS)


def _whole(texts: DataFrame, anchors: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray | None, int]:
    """Stretches that a smaller document has whole; and what the windows of the others are found by: the filters of the
    runs to compare and of hot anchors, and the number of windows."""
    shared = texts.sparkSession.sparkContext.broadcast(anchors)
    found = cut(texts.mapInArrow(_met(shared), "doc_id long, mark long, key long, span long, start int, n int"))
    spans = cut(found.groupBy("key", "span").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("n").alias("n")))
    counts = spans.groupBy("key").agg(F.count("*").alias("spans")).where("spans > 1")
    firsts = cut(spans.join(counts, "key").select("key", "span", "lo", "n", "spans"))
    hot = firsts.where(F.col("spans") > HOT_STRETCHES).select("key").distinct()
    windows_ = firsts.agg(F.sum("n")).first()[0] or 0
    whole = cut(found.join(spans.where("lo < hi").select("key", "span", "lo"), ["key", "span"]).where("doc_id > lo").select("doc_id", "mark", "start", "n"))
    return whole, bloom(firsts.mapInArrow(_named, "key long"), ANCHOR_BITS), bloom(hot, ANCHOR_BITS) if not hot.isEmpty() else None, windows_


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scan (doc_id, n_words, sha, least: the smallest doc_id of equal words) and the stretches of windows that also
    start in a smaller document (doc_id, mark, start, n), copies of a whole text aside."""
    texts = text_of(docs)
    named = texts.where("doc_id is not null")
    scan = cut(texts.mapInArrow(_scanned, "doc_id long, n_words long, sha string, keys array<long>"))
    least = cut(scan.groupBy("sha").agg(F.min("doc_id").alias("least")))
    whole, firsts, hot, n = _whole(named, _anchors(scan, least))
    shared = docs.sparkSession.sparkContext.broadcast((firsts, hot))
    found = "doc_id long, mark long, key long, windows {}, start int"
    dealt = named.mapInArrow(_single(shared, False), found.format("binary")).withColumn("bucket", F.pmod("key", F.lit(n // BUCKET_WINDOWS + 1)))
    out = whole.unionByName(dealt.groupBy("bucket").applyInArrow(_compared, STRETCHES))
    if hot is not None:  # too many stretches for one bucket: their windows are joined one by one
        each = cut(named.mapInArrow(_single(shared, True), found.format("long")))
        best = each.groupBy("key", "windows").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key", "windows", "lo")
        out = out.unionByName(each.join(best, ["key", "windows"]).where("doc_id > lo").select("doc_id", "mark", "start", F.lit(1).alias("n")))
    return scan.select("doc_id", "n_words", "sha").join(least, "sha", "left"), out


def _covered(n: int, places: list) -> np.ndarray:
    """Which of n words the stretches (start, windows) cover."""
    edge = np.zeros(n + 1, np.int64)
    for start, count in places:
        edge[start] += 1
        edge[start + count + WINDOW - 1] -= 1
    return np.cumsum(edge)[:n] > 0


def _places(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("mark", "start", "n")).alias("places"))


def _own(places, words: list[bytes]) -> list:
    mark = _short(_sha(b" ".join(words)))
    return [(p["start"], p["n"]) for p in places if p["mark"] == mark]


def _cleaned(batches):
    opened = zstandard.ZstdDecompressor().decompress
    for ids, places, texts in chunks(batches, ["doc_id", "places", "text"], PRESSED):
        out: list[list] = [[], [], [], []]
        for doc_id, found, text in zip(ids, places, texts, strict=True):
            words = opened(text).split()
            gone = _covered(len(words), _own(found, words))
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
            for column, value in zip(out, (doc_id, hashlib.sha256(b" ".join(words)).hexdigest(), int(gone.sum()), hashlib.sha256(kept).hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)], ["own_id", "own_sha", "removed", "kept"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    scan, found = repeats(docs)
    places = cut(_places(found))
    touched = pressed(text_of(docs)).join(places, "doc_id").select("doc_id", "places", "text")
    cleaned = touched.mapInArrow(_cleaned, "own_id long, own_sha string, removed long, kept string").distinct()
    both = scan.join(cleaned, (F.col("doc_id") == F.col("own_id")) & (F.col("sha") == F.col("own_sha")), "left")
    copy = (F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW)
    return both.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def remove(docs: DataFrame) -> DataFrame:
    """docs with the repeated words gone from text; texts that lose words are joined anew by single spaces."""
    scan, found = repeats(docs)
    copies = scan.where((F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW)).select("doc_id", F.conv(F.substring("sha", 1, 16), 16, -10).cast("long").alias("mark"), F.lit(0).alias("start"), (F.col("n_words") - WINDOW + 1).cast("int").alias("n")).distinct()
    columns, schema, own = docs.columns, docs.schema, free("__id", docs)
    places = _places(found.unionByName(copies)).select(F.col("doc_id").alias(own), F.col("places").alias(f"{own}places"))
    joined = docs.join(places, docs["doc_id"].cast("long") == places[own], "left").drop(own)
    at = columns.index("text")

    def emptied(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(at).to_pylist()
                for k, found in enumerate(part.column(len(columns)).to_pylist()):
                    if found:
                        words = words_of(texts[k] or "")
                        own = _own(found, words)
                        if own:
                            gone = _covered(len(words), own).tolist()
                            texts[k] = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode("utf-8")
                rest = [part.column(k) if k != at else pa.array(texts, pa.string()) for k in range(len(columns))]
                yield pa.RecordBatch.from_arrays(rest, columns)

    return joined.mapInArrow(emptied, schema)
