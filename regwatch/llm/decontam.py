"""Benchmark passages in training text, found by spaced seeds and verified with substitutions allowed.

Fixed masks pick some of the words at each position and ignore the others, so a seed survives a changed word at an
ignored place. Test and training seeds are joined on their hash. A Bloom filter of the test seeds, whose size has a
fixed bound, keeps almost all training seeds out of that join and loses none. Each hit names an item and a diagonal;
along it the words are compared, and an item counts as contained when some stretch of WINDOW words (or the whole item,
if shorter) agrees in at least AGREE of its words. The masks of a length hit every stretch with as many changes as that
allows: two in 10 to 13 words, one in 5 to 9.

Defined results: words are lower-cased runs without white space; null and empty texts contain nothing; an item of
fewer than LEAST_WORDS words (none) is not looked for, one of fewer than SHORT words must occur whole and unchanged; an
item is known by its id and text together, so one of null id is looked for, texts that share an id are items each, and rows
that repeat both are one; rows that share a doc_id get what any of them contains; of equal stretches the first one counts, of equal items the last in
order; very long texts are searched whole; empty tables give no hits; further columns, whatever their names, are ignored
by ``overlaps`` and ``report`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom, chunks, cut, free, in_bloom, mixed, text_of, words_in

#: Words that count (1) and words that are ignored (0).
MASKS = ("11101011", "11001111")
#: The masks of items of so many words or more, up to the next entry; all hold an ignored place.
BY_LENGTH = {5: ("1011", "1101"), 6: ("10111", "11101"), 8: ("101111", "111011"), 10: ("110111", "11001011", "10100111"), 12: (*MASKS, "1111011"), 13: MASKS}
WINDOW, AGREE, SHORT, LEAST_WORDS = 13, 0.8, 5, 1
#: Characters of the texts that a task takes up at once.
CHUNK = 400_000
#: Bits of the Bloom filter for each seed.
SEED_BITS = 512
STEP = np.uint64(0x9E3779B97F4A7C15)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each position of the word hashes h at which the mask fits."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask) * 1009 + mask.count("1"), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            out = (out ^ h[k : k + n]) * STEP
            out ^= out >> np.uint64(29)
    return mixed(out)


def word_hashes(text: str) -> np.ndarray:
    return words_in([text.lower().encode("utf-8", "replace")])[0]


def masks_of(n: int) -> tuple[str, ...]:
    """The masks for an item of n words: one of its whole length if it must be unchanged."""
    return ("1" * n,) if n < SHORT else BY_LENGTH[max(k for k in BY_LENGTH if k <= n)]


def masks_for(lengths: list[int]) -> list[str]:
    """The masks for items of these numbers of words, each once."""
    return list(dict.fromkeys(m for n in sorted(set(lengths)) for m in masks_of(n)))


def _items(batches):
    for keys, ids, texts in chunks(batches, ["item_key", "item_id", "text"]):
        rows = [(k, i, word_hashes(t)) for k, i, t in zip(keys, ids, texts, strict=True)]
        rows = [x for x in rows if len(x[2]) >= LEAST_WORDS]
        columns = [pa.array([k for k, _, _ in rows], pa.string()), pa.array([i for _, i, _ in rows], pa.string()), pa.array([len(h) for _, _, h in rows], pa.int32()), pa.array([h.view(np.int64) for _, _, h in rows], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["item_key", "item_id", "n", "item"])


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_key (a digest of id and text), item_id (as text), n and the word hashes of the items that are looked for."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.left(F.sha2(F.to_json(F.array("item_id", "text")), 256), F.lit(32)).alias("item_key")
    return rows.select(key, "item_id", "text").mapInArrow(_items, "item_key string, item_id string, n int, item array<long>").dropDuplicates(["item_key"])


def _item_seeds(items: DataFrame) -> DataFrame:
    def made(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for item_id, item in zip(batch.column("item_key").to_pylist(), batch.column("item"), strict=True):
                h = item.values.to_numpy(zero_copy_only=False).view(np.uint64)
                for mask in masks_of(len(h)):
                    s = seeds(h, mask).view(np.int64)
                    out[0] += s.tolist()
                    out[1] += [item_id] * len(s)
                    out[2] += range(len(s))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32())], ["seed", "item_key", "place"])

    return items.mapInArrow(made, "seed long, item_key string, place int")


def _agreeing(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """Words that agree along the diagonal, and the best stretch's agreeing words and first word in the document."""
    n = len(item)
    flags = np.zeros(n, np.int64)
    lo, hi = max(0, -diagonal), min(n, len(doc) - diagonal)
    if hi > lo:
        flags[lo:hi] = doc[lo + diagonal : hi + diagonal] == item[lo:hi]
    width = n if n < SHORT else min(n, WINDOW)
    sums = np.concatenate([[0], np.cumsum(flags)])
    stretch = sums[width:] - sums[:-width]
    at = int(stretch.argmax())
    return int(flags.sum()), int(stretch[at]), at + diagonal


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each item found in a document: doc_id, item_id, item_words, agreeing, best (agreeing words of the best
    stretch) and start (first word of that stretch in the document)."""
    items = cut(benchmark_items(benchmark))
    # As many rows as BY_LENGTH has lengths, at most.
    masks = masks_for([r.n for r in items.select(F.least("n", F.lit(max(BY_LENGTH))).alias("n")).distinct().collect()])
    item_seeds = cut(_item_seeds(items))
    shared = docs.sparkSession.sparkContext.broadcast(bloom(item_seeds.select(F.col("seed").alias("key")), SEED_BITS))

    def hits(batches):
        filter_ = shared.value
        for ids, texts in chunks(batches, ["doc_id", "text"], CHUNK, 64):
            h, bounds = words_in([t.lower().encode("utf-8", "replace") for t in texts])
            ends = bounds[1:]
            rows: dict[int, tuple[list, list]] = {}
            for mask in masks:
                s = seeds(h, mask)
                at = in_bloom(filter_, s)
                own = np.searchsorted(ends, at, "right")
                inside = at + len(mask) <= ends[own]
                at, own = at[inside], own[inside]
                if "0" not in mask:  # such items are unchanged: a document's first place of each says all
                    first = np.sort(np.unique(np.stack([own, s[at].view(np.int64)]), axis=1, return_index=True)[1])
                    at, own = at[first], own[first]
                for k, seed, place in zip(own.tolist(), s[at].view(np.int64).tolist(), at.tolist(), strict=True):
                    found = rows.setdefault(k, ([], []))
                    found[0].append(seed)
                    found[1].append(place - int(bounds[k]))
            own = list(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[k] for k in own], pa.int64()),
                    pa.array([rows[k][0] for k in own], pa.list_(pa.int64())),
                    pa.array([rows[k][1] for k in own], pa.list_(pa.int32())),
                    pa.array([h[bounds[k] : ends[k]].view(np.int64) for k in own], pa.list_(pa.int64())),
                ],
                ["doc_id", "seeds", "places", "words"],
            )

    met = text_of(docs).mapInArrow(hits, "doc_id long, seeds array<long>, places array<int>, words array<long>")
    met = cut(met.withColumn("row", F.monotonically_increasing_id()))
    single = met.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("row", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at"))
    near = single.join(item_seeds, "seed").select("row", "item_key", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    pairs = near.join(items, "item_key").join(met.select("row", "doc_id", "words"), "row")

    def verified(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            columns = [batch.column(c) for c in ("doc_id", "item_key", "item_id", "diagonal", "item", "words")]
            for doc_id, item_key, item_id, diagonal, item, words in zip(*columns, strict=True):
                item, words = (x.values.to_numpy(zero_copy_only=False) for x in (item, words))
                agreeing, best, start = _agreeing(words, item, diagonal.as_py())
                width = len(item) if len(item) < SHORT else min(len(item), WINDOW)
                if best >= (width if len(item) < SHORT else math.ceil(AGREE * width)):
                    for column, value in zip(out, (doc_id.as_py(), item_key.as_py(), item_id.as_py(), len(item), agreeing, best, start), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "item_key", "item_id", "item_words", "agreeing", "best", "start"])

    found = pairs.select("doc_id", "item_key", "item_id", "diagonal", "item", "words").mapInArrow(verified, "doc_id long, item_key string, item_id string, item_words int, agreeing int, best int, start int")
    top = F.max(F.struct("agreeing", "best", (-F.col("start")).alias("start"), "item_words")).alias("top")
    return found.groupBy("doc_id", "item_key", "item_id").agg(top).select("doc_id", "item_id", "top.item_words", "top.agreeing", "top.best", (-F.col("top.start")).alias("start"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, worst_item, worst_agreeing, worst_words."""
    found = overlaps(docs, benchmark).groupBy("doc_id").agg(F.count("*").alias("n_items"), F.max(F.struct("agreeing", "item_words", "item_id")).alias("worst"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    both = ids.join(found.withColumnRenamed("doc_id", "found_id"), F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    return both.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.col("worst.item_id").alias("worst_item"), F.col("worst.agreeing").cast("long").alias("worst_agreeing"), F.col("worst.item_words").cast("long").alias("worst_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that contain no benchmark item."""
    own = free("__id", docs)
    bad = cut(overlaps(docs, benchmark).select(F.col("doc_id").alias(own)).distinct())
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad[own]), "left_anti")
