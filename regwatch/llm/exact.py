"""Exact duplicates by a sharded cuckoo-filter index.

A shard of the digest space holds a cuckoo filter (16-bit fingerprints, four to a bucket) and, slot by slot, the stored
SHA-256 digest of the normalised text. A fingerprint hit is only a hint: it counts once the stored digest in that very
bucket is equal. When an insertion runs out of kicks, the shard doubles its buckets and refills them from the stored
digests, so no key is lost.

Defined results: null text counts as empty, so nulls and blank texts form one group; a null doc_id sorts last; of texts
of one group and length the smallest doc_id stays; rows that repeat doc_id and text are the same document and get the
same flags (``drop_duplicates`` keeps one of them); very long texts are digested whole; an empty table gives an empty
result; further columns of the input, whatever their names, are ignored by ``find_duplicates`` and kept by
``drop_duplicates``.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free, text_of

#: Characters that do not count: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
SLOTS, KICKS, FINGERPRINT = 4, 200, 0xFFFF
#: Digests that a shard is meant for, and the fewest shards.
SHARD_KEYS, LEAST_SHARDS = 1 << 15, 256
#: Digests that a map task gathers before it passes its sums on.
COMBINE_KEYS = 100_000


class CuckooIndex:
    """A cuckoo filter over live digests. Beside each slot stand the digest itself, how many copies are live, and a value
    that came with the first of them; nothing else is stored."""

    def __init__(self, buckets: int = 64):
        self.resizes = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.buckets = buckets
        self.marks = [0] * (buckets * SLOTS)
        self.rows: list[tuple[bytes, int, object] | None] = [None] * (buckets * SLOTS)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "little") % FINGERPRINT + 1
        one = int.from_bytes(key[:8], "little") & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def _slot(self, key: bytes) -> int:
        """Slot that holds this very key, or -1: fingerprints propose, the stored digest decides."""
        mark, one, two = self._places(key)
        for bucket in (one, two):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.rows[slot][0] == key:
                    return slot
        return -1

    def __contains__(self, key: bytes) -> bool:
        return self._slot(key) >= 0

    def items(self) -> list[tuple[bytes, int, object]]:
        """Digest, live copies and value of every live digest."""
        return [row for row in self.rows if row]

    def _place(self, row: tuple[bytes, int, object]) -> tuple[bytes, int, object] | None:
        """None, or the row that is left without a slot."""
        mark, one, two = self._places(row[0])
        for bucket in (one, two):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.rows[slot] = mark, row
                    return None
        bucket = two
        for turn in range(KICKS):
            slot = bucket * SLOTS + (mark + turn) % SLOTS
            mark, self.marks[slot] = self.marks[slot], mark
            row, self.rows[slot] = self.rows[slot], row
            bucket = self._other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[free]:
                    self.marks[free], self.rows[free] = mark, row
                    return None
        return row

    def insert(self, key: bytes, times: int = 1, value: object = None) -> bool:
        """True if the key was not live before."""
        slot = self._slot(key)
        if slot >= 0:
            own = self.rows[slot]
            self.rows[slot] = (key, own[1] + times, own[2])
            return False
        if homeless := self._place((key, times, value)):
            self._grow(homeless)
        return True

    def _grow(self, homeless: tuple[bytes, int, object]) -> None:
        stored, buckets = [*self.items(), homeless], self.buckets
        while True:
            buckets *= 2
            self.resizes += 1
            self._empty(buckets)
            if not any(map(self._place, stored)):
                return

    def delete(self, key: bytes, times: int = 1) -> bool:
        """True if the key was live; its fingerprint leaves the filter with its last copy."""
        slot = self._slot(key)
        if slot < 0:
            return False
        _, live, value = self.rows[slot]
        if live > times:
            self.rows[slot] = (key, live - times, value)
        else:
            self.marks[slot], self.rows[slot] = 0, None
        return True


def normalised(text: Column) -> Column:
    """The text without its blanks; null is empty."""
    return reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (hex SHA-256 of the normalised text) and n_points (code points of the original text)."""
    return text_of(docs).select("doc_id", F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("digest"), F.length("text").cast("long").alias("n_points"))


def shards_for(rows: int) -> int:
    """A power of two, so that a shard's share of the digests stays near SHARD_KEYS."""
    n = LEAST_SHARDS
    while n * SHARD_KEYS < rows:
        n *= 2
    return n


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def _combined(batches):
    """One row for a digest and task: rows of it, and its best row (most code points, then smallest doc_id)."""
    live: dict[str, list] = {}

    def rows():
        cols = list(zip(*live.values(), strict=True)) if live else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(live), pa.string()), *(pa.array(c, pa.int64()) for c in cols[:3])], ["digest", "n", "n_points", "doc_id"])

    for batch in batches:
        for digest, doc_id, points in zip(*(batch.column(c).to_pylist() for c in ("digest", "doc_id", "n_points")), strict=True):
            rank = (-points, doc_id is None, doc_id)
            if (old := live.get(digest)) is None:
                live[digest] = [1, points, doc_id, rank]
            else:
                old[0] += 1
                if rank < old[3]:
                    old[1:] = [points, doc_id, rank]
        if len(live) > COMBINE_KEYS:
            yield rows()
            live.clear()
    yield rows()


def _grouped(table: pa.Table) -> pa.Table:
    """The groups of one shard: the first insertion of a digest is its keeper, verified hits are its copies."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("digest", "n", "n_points", "doc_id")), strict=True), key=lambda r: (-r[2], r[3] is None, r[3]))
    index = CuckooIndex()
    for digest, n, points, doc_id in rows:
        index.insert(bytes.fromhex(digest), n, (doc_id, points))
    own = index.items()
    return pa.table({"digest": pa.array([k.hex() for k, _, _ in own], pa.string()), "keep_id": pa.array([v[0] for _, _, v in own], pa.int64()), "keep_points": pa.array([v[1] for _, _, v in own], pa.int64()), "group_size": pa.array([n for _, n, _ in own], pa.int64())})


def groups(keyed: DataFrame, rows: int) -> DataFrame:
    """digest, keep_id, keep_points, group_size of the rows that ``digests`` gives; sums go ahead of the shuffle."""
    parts = keyed.mapInArrow(_combined, "digest string, n long, n_points long, doc_id long")
    return parts.withColumn("shard", _shard(F.col("digest"), shards_for(rows))).groupBy("shard").applyInArrow(_grouped, "digest string, keep_id long, keep_points long, group_size long")


def find_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The group's largest original text stays, then the smallest doc_id. Only groups of two or more are joined back, and
    that join is an outer one from the documents, whose hot keys adaptive execution splits.
    """
    keyed = cut(digests(docs))
    found = groups(keyed, keyed.count()).where("group_size > 1")
    one = keyed.join(found, "digest", "left")
    lone = F.col("group_size").isNull()
    return one.select(
        "doc_id",
        F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (lone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one for each group, with all their columns. Whole texts are shuffled once: rows that
    repeat doc_id and text are combined before it, and the join with the rows that stay uses the same partitions."""
    digest, own = free("__digest", docs), free("__own", docs)
    name = lambda doc_id: F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).alias(own)
    kept = find_duplicates(docs).where("kept").select(F.col("text_sha256").alias(digest), name(F.col("doc_id"))).distinct()
    keyed = docs.select("*", F.sha2(normalised(F.col("text")).cast("binary"), 256).alias(digest), name(F.col("doc_id")))
    return keyed.dropDuplicates([digest, own]).join(kept, [digest, own], "left_semi").select(*docs.columns)


INDEX = "shard int, digest string, live long, buckets int, resizes int"


def _rows(index: CuckooIndex, shard: int) -> pa.Table:
    own = index.items()
    return pa.table({"shard": pa.array([shard] * len(own), pa.int32()), "digest": pa.array([k.hex() for k, _, _ in own], pa.string()), "live": pa.array([n for _, n, _ in own], pa.int64()), "buckets": pa.array([index.buckets] * len(own), pa.int32()), "resizes": pa.array([index.resizes] * len(own), pa.int32())})


def apply_changes(index: DataFrame | None, inserts: DataFrame, deletes: DataFrame | None = None, shards: int = LEAST_SHARDS) -> DataFrame:
    """The stored index after insertions and deletions of documents: a row for each live digest, by shard.

    A deletion of a digest that is not live changes nothing. The same number of shards is to be used throughout.
    """

    def summed(docs: DataFrame, sign: int) -> DataFrame:
        parts = digests(docs).mapInArrow(_combined, "digest string, n long, n_points long, doc_id long")
        return parts.select(_shard(F.col("digest"), shards).alias("shard"), "digest", (F.col("n") * sign).alias("n"))

    steps = summed(inserts, 1)
    if deletes is not None:
        steps = steps.unionByName(summed(deletes, -1))
    if index is not None:
        steps = steps.unionByName(index.select("shard", "digest", F.col("live").alias("n")))

    def rebuilt(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = CuckooIndex()
        rows = sorted(zip(table.column("digest").to_pylist(), table.column("n").to_pylist(), strict=True), key=lambda r: -r[1])
        for digest, n in rows:
            (out.insert if n > 0 else out.delete)(bytes.fromhex(digest), abs(n))
        return _rows(out, key[0].as_py())

    return steps.groupBy("shard").applyInArrow(rebuilt, INDEX)
