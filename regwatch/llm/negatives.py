"""Hard negatives by exact inner products in a residue number system.

Components become integers. A block of anchors and a block of rows are multiplied modulo several small primes, one
float32 matrix product for each prime: residues lie around zero and at most 64 products are added before the next
reduction, so every sum stays below 2**24 and float32 is exact. Chinese remaindering gives the signed scores back; the
primes are as many as the largest possible score needs (Cauchy-Schwarz over the longest vector).

Anchors are the stated queries: they meet all rows, in rounds of at most ANCHOR_BYTES of vectors, which is what a round
broadcasts. A round reads the rows twice: for the positives of each anchor, and then for the negatives in the window that
each positive opens. Every task keeps the best few of each anchor or window while it reads, so what is shuffled does not
grow with the rows of a task, and no pair is ever written out.

Defined results: rows with a null label, vector, component or id, or with a component that is not finite, take no part;
shorter vectors end in zeros; an empty vector scores 0; rows that repeat an id are rows each, but a row is no positive of
an anchor of its own id; ties go to the smaller id; anchors without a positive, and positives without a negative, give no
row; an empty table gives an empty result; further columns are ignored. Vectors so long that a score could pass 2**50
are refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Products that are added up before a reduction, and the primes whose residues let so many of them stay exact.
INNER = 64
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
#: Bytes of integer vectors that a round broadcasts, anchors and rows in a block of a task.
ANCHOR_BYTES, ANCHOR_ROWS, BLOCK = 8 << 20, 256, 4096
MOST = 1 << 50
_FOUND = "round int, anchor int, slot int, score long, vec_id long"


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, taken as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def quantised(embeddings: DataFrame, scale: int = 256, mask: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label and integer vector of the rows that take part. Where vec_id is divisible by mask, the label is moved
    on by one, modulo labels (mask 0: nowhere)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % mask == 0, (label + 1) % labels).otherwise(label) if mask else label
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), integers(F.col("embedding"), scale).alias("v"))


class Residues:
    """Integer rows as matrices modulo each prime, around zero, and their exact products with other rows."""

    def __init__(self, most: int, width: int) -> None:
        if most >= MOST:
            raise ValueError(f"a score may reach {most}, beyond the {MOST} that are supported: scale the vectors down")
        self.primes, self.width, product = [], width, 1
        for p in PRIMES:
            if product > 2 * most + 1 and self.primes:
                break
            self.primes.append(p)
            product *= p
        self.product = product

    def of(self, rows: np.ndarray) -> list[np.ndarray]:
        out = []
        for p in self.primes:
            r = rows % p
            out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
        return out

    def products(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Signed inner products of all rows of a with all of b, by Garner's form of Chinese remaindering."""
        score = np.zeros((len(a[0]), len(b[0])), np.int64)
        step = 1
        for p, x, y in zip(self.primes, a, b, strict=True):
            total = np.zeros(score.shape, np.int64)
            for k in range(0, self.width, INNER):
                total += np.rint(x[:, k : k + INNER] @ y[:, k : k + INNER].T).astype(np.int64)
            digit = (total - score) % p * pow(step, -1, p) % p if step > 1 else total % p
            score += digit * step
            step *= p
        score[score > self.product // 2] -= self.product
        return score


def _dense(vectors: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    at = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - at[row]] = flat
    return out


def _blocks(batches: Iterator, width: int) -> Iterator[tuple]:
    """Ids, labels and vectors of at most BLOCK rows, in the order of ids within a block."""
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            part = batch.slice(k, BLOCK)
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            vectors = part.column(2)
            yield ids, labels, _dense(vectors, width)


class Best:
    """The best of each slot so far: higher scores first, of equal ones the smaller id."""

    def __init__(self, slots: int, most: int) -> None:
        self.most, self.floor = most, np.full(slots, -MOST, np.int64)
        self.slot = self.score = self.ids = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(slot, prepend=-1))
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(starts, append=len(slot)))
        keep = rank < self.most
        self.slot, self.score, self.ids = slot[keep], score[keep], ids[keep]
        last = rank == self.most - 1
        self.floor[slot[last]] = score[last]


def _search(rows: DataFrame, anchors: dict, number: int, codes: Residues, windows: np.ndarray | None, most: int) -> DataFrame:
    """The best rows of each anchor of a round in every task. windows: for each anchor and slot the least and the highest
    score of a row of another label; without it a row must have the anchor's label and another id."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, windows))

    def search(batches: Iterator) -> Iterator[pa.RecordBatch]:
        (own, opened), width = shared.value, codes.width
        n, slots = len(own["ids"]), 1 if opened is None else opened.shape[1]
        best, prepared = Best(n * slots, most), [codes.of(own["vectors"][k : k + ANCHOR_ROWS]) for k in range(0, n, ANCHOR_ROWS)]
        for ids, labels, vectors in _blocks(batches, width):
            there = codes.of(vectors)
            for b, here in enumerate(prepared):
                at = slice(b * ANCHOR_ROWS, min(n, (b + 1) * ANCHOR_ROWS))
                scores = codes.products(here, there)
                same = own["labels"][at, None] == labels
                if opened is None:
                    open_ = same & (own["ids"][at, None] != ids)
                    low = best.floor[at]
                    a, r = np.nonzero(open_ & (scores >= low[:, None]))
                    best.add(a + at.start, scores[a, r], ids[r])
                    continue
                for s in range(slots):
                    low = np.maximum(opened[at, s, 0], best.floor[np.arange(at.start, at.stop) * slots + s])
                    a, r = np.nonzero(~same & (scores >= low[:, None]) & (scores <= opened[at, s, 1][:, None]))
                    best.add((a + at.start) * slots + s, scores[a, r], ids[r])
        if len(best.slot):
            columns = [np.full(len(best.slot), number, np.int32), (best.slot // slots).astype(np.int32), (best.slot % slots).astype(np.int32), best.score, best.ids]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["round", "anchor", "slot", "score", "vec_id"])

    found = rows.select("vec_id", "label", "v").mapInArrow(search, _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def hard_negatives(embeddings: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256, mask: int = 7, labels: int = 10) -> DataFrame:
    """For each anchor (id divisible by every) and each of its first positives (rows of its label) the first rows of other
    labels that score between window per cent of the positive's score: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score."""
    spark, (low, high) = embeddings.sparkSession, window
    rows = cut(quantised(embeddings, scale, mask, labels))
    norm = F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest, width = rows.agg(F.max(norm), F.max(F.size("v"))).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    codes = Residues(math.ceil((longest or 0.0) * (1 + 1e-9)) + 1, max(1, width or 0))
    # Anchors that repeat in all they hold are searched for once; the copies come back in the end.
    anchors = cut(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "label", "v").agg(F.count("*").alias("copies")))
    total, each = anchors.count(), max(1, ANCHOR_BYTES // (8 * codes.width))
    rounds, parts = math.ceil(total / each), []
    for k in range(rounds):
        block = anchors.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(rounds)) == k).toArrow().sort_by([("vec_id", "ascending")])
        if not block.num_rows:
            continue
        block = block.combine_chunks()
        own = {"ids": block.column("vec_id").to_numpy(), "labels": block.column("label").to_numpy(), "vectors": _dense(block.column("v").chunk(0), codes.width), "copies": block.column("copies").to_numpy()}
        near = _search(rows, own, k, codes, None, positives).toArrow()
        opened, names = np.full((block.num_rows, positives, 2), (1, 0), np.int64), np.zeros((block.num_rows, positives, 2), np.int64)
        a, r = near.column("anchor").to_numpy(), near.column("rank").to_numpy() - 1
        score = near.column("score").to_numpy()
        opened[a, r] = np.stack([-(-low * score // 100), high * score // 100], 1)
        names[a, r] = np.stack([near.column("vec_id").to_numpy(), score], 1)
        found = _search(rows, own, k, codes, opened, negatives)
        anchor, slot = np.nonzero(opened[:, :, 0] <= opened[:, :, 1])
        if not len(anchor):
            continue
        keys = pa.table({"anchor": pa.array(anchor, pa.int32()), "slot": pa.array(slot, pa.int32()), "anchor_id": own["ids"][anchor], "copies": own["copies"][anchor], "positive_id": names[anchor, slot, 0], "positive_score": names[anchor, slot, 1]})
        known = found.join(spark.createDataFrame(keys), ["anchor", "slot"])
        each_copy = known.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        part = each_copy.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        parts.append(cut(part) if rounds > 1 else part)
    out = spark.createDataFrame([], schema)
    for part in parts:
        out = out.unionByName(part) if parts.index(part) else part
    return out.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")))
