"""Near duplicates: DartMinHash signatures, banded joining, exact verification.

A document is the weighted set of its five-word shingles, the weight being how often one occurs. A shingle of weight w
owns the strips 0 to w - 1 of its weight axis; darts fall on each strip at the times of a Poisson process that hashes
drive, so equal strips get equal darts in every document. Each dart also hashes to a coordinate, and the earliest dart
of each of K coordinates is the signature: two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. A document looks at no more of the time axis than fills all coordinates, about K ln K darts.

Documents of equal words are one class from the start. Classes that share a band meet in its bucket. First all of a
bucket are compared with its leader, the one that meets most others (of equals the least doc_id); then the buckets of a
leader, if several components are left in them, are searched exhaustively for links between components, in blocks.
Every link is verified on the shingles.

Defined results: words are lower-cased runs without white space; a text of fewer than five words has one shingle, all
of it; null, empty and blank texts are one class; rows that share a doc_id are one node; a row of null doc_id belongs to
the class of equal words only, and to none (its class id is a hash) if that has no other id; very long texts are signed
whole; of a class the least doc_id stays; an empty table gives an empty result; further columns, whatever their names,
are ignored by ``classes`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, free, mixed, text_of, words_in
from .graph import components

SHINGLE, BANDS, ROWS = 5, 24, 4
K = BANDS * ROWS
#: Characters of the texts that a task takes up at once.
CHUNK = 400_000
#: Two documents are linked when NUMBER * shared >= OVER * united shingles: a similarity of 0.8.
OVER, NUMBER = 4, 5
#: Classes and bytes of strips of one block of a group that is searched exhaustively, and shingles compared at once.
BLOCK, BLOCK_BYTES, COLUMNS = 512, 64_000_000, 4096


def strips(h: np.ndarray) -> np.ndarray:
    """Sorted hashes of the strips of a text's shingles, (shingle, occurrence) pairs, from the hashes of its words."""
    if not len(h):
        return np.zeros(0, np.uint64)
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    s = np.full(n, width, np.uint64)
    for k in range(width):
        s = mixed(s ^ h[k : k + n], k)
    s.sort()
    fresh = np.ones(n, bool)
    fresh[1:] = s[1:] != s[:-1]
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    out = mixed(s + (np.arange(n) - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 77)
    out.sort()
    return out


def signature(own: np.ndarray, k: int = K) -> np.ndarray:
    """The earliest dart of each coordinate."""
    until = (k * math.log(k) + 2 * k) / len(own)
    while True:
        alive, time, turn = own, np.zeros(len(own)), 0
        times, coordinates, darts = [], [], []
        while len(alive):
            width = max(1, int(until) + 1) if turn == 0 else 2
            h = mixed(alive[:, None] ^ mixed(np.arange(turn, turn + width, dtype=np.uint64), 3)[None, :], 4)
            at = time[:, None] + np.cumsum(-np.log(((h >> np.uint64(11)) + 0.5) / float(1 << 53)), 1)
            inside = at < until
            found = h[inside]
            times.append(at[inside])
            darts.append(found)
            coordinates.append(mixed(found, 5) % np.uint64(k))
            more = inside[:, -1]
            alive, time, turn = alive[more], at[more, -1], turn + width
        times, darts, coordinates = np.concatenate(times), np.concatenate(darts), np.concatenate(coordinates).astype(np.int64)
        order = np.argsort(-times, kind="stable")
        out, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[coordinates[order]] = darts[order]
        filled[coordinates] = True
        if filled.all():
            return out
        until *= 2


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    rows = sig.reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = mixed(out ^ rows[:, k], 9)
    return out


def _signed(batches):
    for ids, texts in chunks(batches, ["doc_id", "text"], CHUNK, 64):
        content, bands = [], []
        coded = [t.lower().encode("utf-8", "replace") for t in texts]
        h, bounds = words_in(coded)
        for text, lo, hi in zip(coded, bounds, bounds[1:], strict=False):
            content.append(hashlib.blake2b(b" ".join(text.split()), digest_size=16).hexdigest())
            own = strips(h[lo:hi])
            bands.append(band_keys(signature(own)).view(np.int64) if len(own) else None)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(content, pa.string()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "content", "bands"])


def _stripped(batches):
    for ids, texts in chunks(batches, ["doc_id", "text"], CHUNK, 64):
        h, bounds = words_in([t.lower().encode("utf-8", "replace") for t in texts])
        own = [strips(h[lo:hi]).tobytes() for lo, hi in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own, pa.binary())], ["node", "strips"])


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if NUMBER * min(len(a), len(b)) < OVER * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return NUMBER * shared >= OVER * (len(a) + len(b) - shared)


def _verified(batches):
    for batch in batches:
        left, right = batch.column("sa"), batch.column("sb")
        keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(left, right, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _searched(table: pa.Table) -> pa.Table:
    """Links that join components, among the classes of two blocks; a link is given only while its ends are apart."""
    nodes, parts, blocks = (table.column(c).to_numpy() for c in ("node", "component", "block"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("strips")]
    sizes = np.array([len(s) for s in sets])
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    common = counts[codes] > 1
    place = np.cumsum(counts > 1) - 1
    rows, columns = rows[common], place[codes[common]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(counts[counts > 1].size), COLUMNS):
        lo, hi = np.searchsorted(columns, [start, start + COLUMNS])
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[rows[lo:hi], columns[lo:hi] - start] = 1
        shared += dense @ dense.T
    close = NUMBER * shared >= OVER * (sizes[:, None] + sizes[None, :] - shared)
    close &= (parts[:, None] != parts[None, :]) & ((blocks[:, None] != blocks[None, :]) | (blocks.min() == blocks.max()))
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while x in top:
            x = top[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(close)), strict=True):
        x, y = root(int(parts[i])), root(int(parts[j]))
        if x != y:
            top[max(x, y)] = min(x, y)
            out.append((int(nodes[i]), int(nodes[j])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _meetings(contents: DataFrame) -> DataFrame:
    """node, key, size of all buckets that hold several nodes."""
    bands = contents.where("node is not null").select("node", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return cut(bands.join(sizes, "key").distinct())


def _labels(docs: DataFrame, members: DataFrame) -> DataFrame:
    """node and component of all nodes that have a link."""
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    leaders = members.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("least"))).alias("top"))
    stars = cut(members.join(leaders.select("key", (-F.col("top.least")).alias("a")), "key").where("a != node").select("a", F.col("node").alias("b")).distinct())
    nodes = members.select("node").distinct()
    texts = text_of(docs).join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    own = cut(texts.mapInArrow(_stripped, "node long, strips binary").distinct())
    right = own.select(F.col("node").alias("b"), F.col("strips").alias("sb"))
    left = own.select(F.col("node").alias("a"), F.col("strips").alias("sa"))
    links = cut(stars.join(right, "b").join(left, "a").mapInArrow(_verified, "a long, b long").distinct())
    first = components(links)

    # All buckets of one leader are searched as one group, so bands that meet the same classes again cost nothing. Links
    # between components have an end outside the group's largest one: those classes are compared with all others.
    met = stars.select(F.col("a").alias("key"), F.col("b").alias("node")).unionByName(stars.select(F.col("a").alias("key"), F.col("a").alias("node")).distinct())
    size = own.select("node", F.octet_length("strips").cast("long").alias("bytes"))
    placed = met.join(first, "node", "left").join(size, "node").select("node", "key", F.coalesce("component", "node").alias("component"), "bytes")
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    sums = parts.groupBy("key").agg(F.max(F.struct("n", "component", "bytes")).alias("top"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = lambda n, bytes_: F.ceil(F.greatest(n / BLOCK, bytes_ / BLOCK_BYTES)).cast("int")
    wanted = sums.where("parts > 1 and n > 2").select(
        "key",
        F.col("top.component").alias("main"),
        blocks(F.col("top.n"), F.col("top.bytes")).alias("inside"),
        blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("outside"),
    )
    dealt = placed.join(wanted, "key").withColumn("in", F.col("component") == F.col("main"))
    dealt = dealt.withColumn("block", F.when(F.col("in"), -1 - F.pmod(F.xxhash64("node"), F.col("inside"))).otherwise(F.pmod(F.xxhash64("node"), F.col("outside"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("outside") - 1)
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("in"), others).otherwise(F.concat(others, F.transform(F.sequence(F.lit(1), F.col("inside")), lambda x: -x)))))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "block")
    found = dealt.join(own, "node").groupBy("key", "i", "j").applyInArrow(_searched, "a long, b long")
    found = cut(found.distinct())
    if found.isEmpty():
        return first
    return components(links.unionByName(found))


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of the class), kept (whether it is that document)."""
    signed = cut(text_of(docs).mapInArrow(_signed, "doc_id long, content string, bands array<long>"))
    contents = cut(signed.groupBy("content").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")))
    labels = _labels(docs, _meetings(contents))
    known = contents.select("content", "node").join(labels.select("node", "component"), "node", "left")
    own = known.select("content", F.coalesce("component", "node", F.xxhash64("content")).alias("class_id"), F.col("node").isNull().alias("lone"))
    return signed.select("doc_id", "content").join(own, "content").select("doc_id", "class_id", (F.col("lone") | (F.col("doc_id").isNotNull() & (F.col("doc_id") == F.col("class_id")))).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: of each class the document of the least doc_id, and rows of null doc_id."""
    own = free("__id", docs)
    gone = classes(docs).where("not kept and doc_id is not null").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[own]), "left_anti")
