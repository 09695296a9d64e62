"""Packing of documents into training sequences: dominance reduction, then best fit.

Documents become token pieces in one map. The packing problem depends on nothing but how many pieces there are of each
length, at most ``capacity`` counts, so the driver solves it on those counts: pairs and single pieces that provably
dominate every alternative are fixed for good (Martello and Toth's reduction), the rest goes by best fit, longest
first. The solution is a list of runs of equal pieces, joined back to the pieces by length and rank.

Defined results: null text is empty and gives the end token alone; a null doc_id stays null; repeated rows are packed
each by itself; very long texts are cut at every ``capacity`` tokens; among pieces of one length any may take a place,
and the same ones do when a task is repeated; an empty table gives an empty result; further columns of the input,
whatever their names, are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, cut, free, give_back, text_of

CAPACITY, END = 4096, 1
#: Bytes of the parts of words that a worker remembers, in two generations, and what an entry takes besides its text.
REMEMBERED, ENTRY = 100_000_000, 150
#: Rows that share one bucket of a length while ranks are dealt out, and the fewest buckets.
RANK_ROWS, LEAST_BUCKETS = 20_000, 64

#: How the vocabulary's pre-tokenizer splits lower-case Latin-1 text; any other word is left to the library whole.
_LATIN = re.compile(r"[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
_SPECIAL = "<|"
#: A blank, so that no part begins with it.
FOREIGN = " "
_BLANK = re.compile(r"[ \t-\r]")


class PartTokens:
    """Token ids (little-endian 32-bit) of the parts of words (letter runs, digits, marks), which this vocabulary encodes
    one by one. Parts that have not been met for a generation are forgotten."""

    _open: tuple[str, PartTokens] | None = None

    @classmethod
    def of(cls, path: str) -> PartTokens:
        """The one that this worker keeps from task to task."""
        if cls._open is None or cls._open[0] != path:
            cls._open = (path, cls(path))
        return cls._open[1]

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # Parts are split and lower-case already: only the vocabulary is left to apply.
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, parts: list[str]) -> None:
        """Afterwards all parts are in the young generation; their ids are taken from the old one where it has them."""
        known = [p for p in parts if p in self.old]
        self.young.update(zip(known, map(self.old.__getitem__, known), strict=True))
        fresh = list(set(parts).difference(known)) if known else parts
        split = [p for p in fresh if p[0] != FOREIGN]
        self.young.update(zip(split, [_little(c.ids) for c in self.plain.encode_batch_fast(split, add_special_tokens=False)], strict=True))
        self.young.update((p, _little(self.whole.encode(p[1:], add_special_tokens=False).ids)) for p in fresh if p[0] == FOREIGN)
        self.size += ENTRY * len(parts) + 3 * sum(map(len, parts))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_parts(t) for t in texts]
        flat = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
        distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.size > REMEMBERED // 2:
            self.old, self.young, self.size = self.young, {}, 0
        if new := [p for p in distinct if p not in self.young]:
            self._learn(new)
        codes = pa.array([self.young[p] for p in distinct], pa.large_binary()).take(flat.indices)
        _, offsets, data = codes.buffers()
        ends = np.frombuffer(offsets or b"\0" * 8, np.int64)[np.cumsum([0, *map(len, split)])].tolist()
        view = memoryview(data or b"")
        return [bytes(view[lo:hi]) for lo, hi in pairwise(ends)]


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _parts(text: str) -> list[str]:
    """Strings whose ids, end to end, are the text's: the pre-tokenizer's parts, and, behind a FOREIGN mark, whole words
    that only the library can split."""
    if _SPECIAL not in text:
        try:
            text.encode("latin-1")
            return _LATIN.findall(text.lower())
        except UnicodeEncodeError:
            pass
    out: list[str] = []
    for word in _BLANK.split(text):
        if word:
            latin = max(word) <= "ÿ" and _SPECIAL not in word
            out += _LATIN.findall(word.lower()) if latin else [FOREIGN + word]
    return out


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32, and ids if asked for."""

    def pieces(batches):
        tokens = PartTokens.of(path)
        end = np.array([END], "<u4").tobytes()
        for ids, texts in chunks(batches, ["doc_id", "text"], 2_000_000):
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, whole in zip(ids, tokens.encode(texts), strict=True):
                whole += end
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    for column, value in zip(rows, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        column.append(value)
            columns = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            if not with_ids:
                columns, names = columns[:-1], names[:-1]
            yield pa.RecordBatch.from_arrays(columns, names)
        tokens.old = {}
        give_back()

    return text_of(docs).mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Plan:
    """Runs (length, first rank, bins, pieces to a bin, first sequence, offset) for counts of pieces by length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left, self.used = capacity, dict(counts), dict.fromkeys(counts, 0)
        self.sizes = sorted(n for n, k in counts.items() if k)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.bins = self.fixed = 0
        self._reduce()
        self.fixed = self.bins
        self._best_fit()

    def _put(self, size: int, bins: int, each: int, first: int, offset: int) -> None:
        self.runs.append((size, self.used[size], bins, each, first, offset))
        self.used[size] += bins * each
        self.left[size] -= bins * each
        if not self.left[size]:
            del self.sizes[bisect_left(self.sizes, size)]

    def _fix(self, bins: int, *sizes: int) -> None:
        offset = 0
        for size in sizes:
            self._put(size, bins, 1, self.bins, offset)
            offset += size
        self.bins += bins

    def _dominant(self, size: int) -> int:
        """The partner that with ``size`` dominates all sets that hold it; 0: none is needed; -1: no set is known to."""
        room = self.capacity - size
        others = [s for s in self.sizes[:2] if s != size or self.left[s] > 1]
        if not others or others[0] > room:
            return 0
        if room in self.left and self.left[room] > (room == size):
            return room
        small = others[0]
        spare = self.left[small] - (small == size)
        two = 2 * small if spare > 1 else small + (next((s for s in self.sizes if s > small and (s != size or self.left[s] > 1)), self.capacity))
        if two <= room:
            return -1
        at = bisect_left(self.sizes, room + 1) - 1
        while at >= 0 and self.sizes[at] == size and self.left[size] < 2:
            at -= 1
        return self.sizes[at]

    def _reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for size in reversed(self.sizes.copy()):
                while self.left[size] and (partner := self._dominant(size)) >= 0:
                    changed = True
                    if not partner:
                        self._fix(self.left[size], size)
                    elif partner == size:
                        self._fix(self.left[size] // 2, size, size)
                    else:
                        self._fix(min(self.left[size], self.left[partner]), size, partner)

    def _best_fit(self) -> None:
        rooms: list[int] = []
        free: dict[int, list[tuple[int, int]]] = {}

        def give(room: int, first: int, bins: int) -> None:
            if room and bins:
                if room not in free:
                    insort(rooms, room)
                free.setdefault(room, []).append((first, bins))

        for size in reversed(self.sizes.copy()):
            while k := self.left[size]:
                if (at := bisect_left(rooms, size)) < len(rooms):
                    room = rooms[at]
                    first, bins = free[room].pop()
                    if not free[room]:
                        del free[room], rooms[at]
                else:
                    room, first = self.capacity, self.bins
                    bins = -(-k // (room // size))
                    self.bins += bins
                each = min(room // size, k)
                full = min(bins, k // each)
                self._put(size, full, each, first, self.capacity - room)
                give(room - each * size, first, full)
                give(room, first + full, bins - full)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, length and more) with sequence_id and offset, gapless from 0 in every sequence.

    Rows are told apart by their place, so pieces must be a written or checkpointed table: rows of equal ids, or of none,
    are dealt out like all others, and a repeated task deals them the same way.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = np.array(sorted(Plan(counts, capacity).runs) or np.zeros((0, 6)), np.int64).reshape(-1, 6)
    buckets = max(LEAST_BUCKETS, sum(counts.values()) // RANK_ROWS)
    place, bucket, rank = (free(f"__{c}", pieces) for c in ("place", "bucket", "rank"))
    dealt = pieces.withColumn(place, F.monotonically_increasing_id()).withColumn(bucket, F.pmod(F.xxhash64(place), F.lit(buckets)).cast("int"))
    sums = dealt.groupBy("length", bucket).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(rank))
    within = Window.partitionBy("length", bucket).orderBy(place)
    ranked = dealt.join(sums, ["length", bucket]).select(*(dealt[c] for c in pieces.columns), (F.col(rank) + F.row_number().over(within) - 1).alias(rank))
    shared = pieces.sparkSession.sparkContext.broadcast(runs)  # a bounded number of runs for each length

    names = pieces.columns

    def placed(batches):
        runs = shared.value
        key = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", rank))
            size, first, _, each, sequence, offset = runs[np.searchsorted(key, (length << 44) + own, "right") - 1].T
            turn = own - first
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence + turn // each), pa.array(offset + turn % each * size)], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return ranked.mapInArrow(placed, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed pieces of docs: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut(tokenize(docs, path, capacity)), capacity)


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and the ids of each sequence (at most ``capacity``), as little-endian 32-bit integers."""
    packed = pack(cut(tokenize(docs, path, capacity, with_ids=True)), capacity)
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
