"""The prefix tree of conversations, from double-array tries over shards of the sorted sequences.

A conversation is a sequence of turns, and a turn is known by 128 bits of the SHA-256 of its role and text. Spark sorts
all sequences by range, so prefixes lie side by side and a shard of them shares its upper nodes with neighbours at most
along its first and its last sequence. A task packs each shard into a double array (BASE and CHECK over the shard's dense
turn ids) and walks its sequences through it to sum up every node. Nodes that may stand in a neighbour too carry the hash
of their prefix and are merged by it; all others are complete as they are.

What is summed over a subtree is a sum over its members. A sequence brings in the nodes deeper than the prefix that it
shares with the one before it in the order of all sequences, so each distinct node is counted once, however many shards
hold it, and no round over levels is needed. Shards know what they share with their neighbours: the least and last
sequences of partitions meet in one task, a row for each partition.

The hash of the conversations that end in a node is taken over ids in ascending order. Runs that a shard cuts are sent on
as text and hashed as a stream, so that no task holds a list of them.

Defined results: null role or text is empty; rows with a null conv_id belong to no conversation and take no part; rows of
one conv_id and turn follow the digests of what they hold, and repeated rows are turns each; null turns come first; an
empty table gives no node; further columns are ignored. Numbers of conversations are truncated towards zero, so
c - c % 20 of -5 is 0. One conversation is one row of 36 bytes for each turn, so it must fit into memory; many
conversations of one beginning need not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Hexadecimal digits of a turn's digest.
DIGITS = 32
#: Turns and sequences of a shard, at most (a longer sequence is a shard with what was gathered before it).
SHARD_TURNS, SHARD_ROWS = 1 << 16, 1 << 14
#: Free slots tried for the children of a node before they go behind all that is used.
TRIES = 64
_NODE = "node string, parent string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, piece string, piece_at long"
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest and number of words of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), F.lit(DIGITS))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), words.alias("words"))


def _gathered(rows: DataFrame, *keys: str) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    whole = rows.groupBy(*keys).agg(turns.alias("turns"))
    return whole.select(*keys, F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("seq"), F.transform("turns", lambda t: t["words"]).alias("words"))


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, seq (the digests end to end) and words (of each turn) of every conversation as it stands."""
    return _gathered(turn_rows(conversations), "conv_id")


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """As ``sequences``, with the first crc32(conv_id) % heads turns of each conversation c taken from c - c % group."""
    first = F.col("conv_id") - F.col("conv_id") % group
    own = _gathered(turn_rows(conversations).withColumn("first", first).repartition("first"), "first", "conv_id")
    head = own.where(F.col("conv_id") == F.col("first")).select("first", F.left("seq", F.lit(DIGITS * (heads - 1))).alias("head"), F.slice("words", 1, heads - 1).alias("head_words"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.join(head, "first", "left").withColumn("h", h)
    seq = F.concat(F.left(F.coalesce("head", F.lit("")), F.col("h") * DIGITS), F.substring("seq", F.col("h") * DIGITS + 1, F.length("seq")))
    words = F.concat(F.slice(F.coalesce("head_words", F.array().cast("array<int>")), F.lit(1), F.col("h")), F.slice("words", F.col("h") + 1, F.size("words")))
    return both.select("conv_id", seq.alias("seq"), words.alias("words"))


def common(a: str, b: str) -> int:
    """Turns that two sequences of digests begin with alike."""
    low, high = 0, min(len(a), len(b)) // DIGITS
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * DIGITS : mid * DIGITS] == b[low * DIGITS : mid * DIGITS]:
            low = mid
        else:
            high = mid - 1
    return low


class DoubleArray:
    """A trie in two arrays. State 0 is the root; the child of state s by code c is t = base[s] + c if check[t] is s."""

    FREE = -1

    def __init__(self) -> None:
        self.base, self.check = np.zeros(1024, np.int32), np.full(1024, self.FREE, np.int32)
        self.check[0] = 0
        self.after = [1, *range(1, 1024)]
        self.last = 0

    def _room(self, n: int) -> None:
        size = len(self.base)
        if n >= size:
            more = max(size, n + 1 - size)
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, self.FREE, np.int32)])
            self.after.extend(range(size, size + more))

    def _free(self, i: int) -> int:
        """The first free slot from i on; ``after`` leads from a used slot to a later one, and a free one to itself."""
        self._room(i)
        after = self.after
        while after[i] != i:
            if after[i] >= len(after):
                self._room(after[i])
            after[i] = after[after[i]]
            i = after[i]
        return i

    def place(self, parent: int, codes: np.ndarray) -> None:
        """Give a state its children: the first base at which all their slots are free."""
        first, width = int(codes[0]), int(codes[-1])
        slot = self._free(first + 1)
        for tries in range(TRIES + 1):
            if tries == TRIES:
                slot = max(self.last, first) + 1
            self._room(slot - first + width)
            if len(codes) == 1 or (self.check[slot - first + codes] == self.FREE).all():
                break
            slot = self._free(slot + 1)
        base = slot - first
        self.base[parent], self.check[base + codes] = base, parent
        for t in (base + codes).tolist():
            self.after[t] = t + 1
        self.last = max(self.last, base + width)
        self._room(self.last + 1)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of states by codes, -1 where there is none."""
        t = self.base[states] + codes
        t[t >= len(self.check)] = 0
        return np.where((self.check[t] == states) & (t > 0), t, -1)


def packed(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> DoubleArray:
    """The trie of the sequences codes[start : start + length], built level by level; codes begin with 1."""
    trie, states, live = DoubleArray(), np.zeros(len(starts), np.int64), np.arange(len(starts))
    top = int(codes.max()) + 1 if len(codes) else 1
    for depth in range(int(lengths.max()) if len(lengths) else 0):
        live = live[lengths[live] > depth]
        code = codes[starts[live] + depth]
        pairs = np.unique(states[live] * top + code)
        parents, children = pairs // top, pairs % top
        bounds = np.flatnonzero(np.diff(parents, prepend=-1))
        for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(pairs)], strict=True):
            trie.place(int(parents[a]), children[a:b])
        states[live] = trie.step(states[live], code)
    return trie


def _coded(seqs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct turns of a shard, the dense ids (from 1) of all its turns, and where each sequence starts and how long it is."""
    lengths = np.fromiter((len(s) // DIGITS for s in seqs), np.int64, len(seqs))
    turns, codes = np.unique(np.frombuffer("".join(seqs).encode(), f"S{DIGITS}"), return_inverse=True)
    return turns, codes.astype(np.int64) + 1, np.cumsum(lengths) - lengths, lengths


def shard_nodes(ids: np.ndarray, seqs: list[str], words: np.ndarray, before: int, after: int) -> dict[str, list]:
    """The nodes of one shard. before and after: turns that its first and last sequence share with their neighbours
    outside, -1 where there is none."""
    _, codes, starts, lengths = _coded(seqs)
    n = len(seqs)
    shared = np.empty(n + 1, np.int64)
    shared[0], shared[n] = before, after
    for i in range(1, n):
        m = min(lengths[i - 1], lengths[i])
        alike = codes[starts[i - 1] : starts[i - 1] + m] == codes[starts[i] : starts[i] + m]
        shared[i] = m if alike.all() else alike.argmin()
    fresh = np.flatnonzero(np.r_[True, (shared[1:n] < lengths[1:]) | (shared[1:n] < lengths[:-1])])
    trie = packed(codes, starts[fresh], lengths[fresh])
    # An entry for each sequence and depth, the root's first: its state and what it adds to the sums of its node.
    size = lengths + 1
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(n), size)
    depth = np.arange(len(owner)) - first[owner]
    weight = np.zeros(len(owner), np.int64)
    weight[depth > 0] = words
    state = np.zeros(len(owner), np.int64)
    live = np.arange(n)
    for d in range(1, int(lengths.max()) + 1):
        live = live[lengths[live] >= d]
        state[first[live] + d] = trie.step(state[first[live] + d - 1], codes[starts[live] + d - 1])
    total = np.r_[0, np.cumsum(weight)]
    new = np.r_[0, np.cumsum(np.where(depth > shared[owner], weight, 0))]
    here, end = np.arange(len(owner)), (first + size)[owner]
    adds = {
        "n_convs": np.ones(len(owner), np.int64),
        "n_children": ((shared[owner] <= depth) & (depth < lengths[owner])).astype(np.int64),
        "n_leaves": (shared[1:] < lengths)[owner].astype(np.int64),
        "saved_tokens": (total[end] - total[here]) - (new[end] - new[here]),
    }
    order = np.argsort(state, kind="stable")
    cuts = np.flatnonzero(np.diff(state[order], prepend=-1))
    states = state[order][cuts]
    place = np.full(len(trie.check), -1, np.int64)
    place[states] = np.arange(len(states))
    out: dict[str, list] = {k: np.add.reduceat(v[order], cuts).tolist() for k, v in adds.items()}
    least = np.minimum.reduceat(ids[owner][order], cuts)
    sample = order[cuts]
    above = place[trie.check[states]]
    outside = np.zeros(len(states), bool)
    for i, most in ((0, before), (n - 1, after)):
        if most >= 0:
            outside[place[state[first[i] : first[i] + min(most, lengths[i]) + 1]]] = True
    name: dict[int, str] = {}

    def named(k: int) -> str:
        if k not in name:
            name[k] = hashlib.sha256(seqs[owner[sample[k]]][: DIGITS * int(depth[sample[k]])].encode()).hexdigest()
        return name[k]

    root = int(place[0])
    out["node"] = [named(k) if outside[k] else None for k in range(len(states))]
    out["parent"] = [named(p) if k != root and outside[p] else None for k, p in enumerate(above.tolist())]
    out["parent_conv_id"] = [int(least[p]) if k != root and not outside[p] else None for k, p in enumerate(above.tolist())]
    out["depth"], out["conv_id"] = depth[sample].tolist(), least.tolist()
    out["ends"], out["piece"], out["piece_at"] = ([None] * len(states) for _ in range(3))
    for a, b in zip(fresh.tolist(), [*fresh[1:].tolist(), n], strict=True):
        k, text = int(place[state[first[a] + lengths[a]]]), ",".join(map(str, ids[a:b].tolist()))
        if a == 0 and before == lengths[0] or b == n and after == lengths[n - 1]:
            out["piece"][k], out["piece_at"][k] = text, int(ids[a])
        else:
            out["ends"][k] = hashlib.sha256(text.encode()).hexdigest()
    return out


def _sorted(seqs: DataFrame) -> DataFrame:
    """Sequences in one order over all partitions, with the number of the partition; copies of one sequence may be split."""
    dealt = seqs.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return cut(dealt.withColumn("part", F.spark_partition_id()))


def _ends(batches: Iterator) -> Iterator[pa.RecordBatch]:
    part = first = last = None
    for batch in batches:
        if batch.num_rows:
            seq = batch.column("seq")
            first = seq[0].as_py() if part is None else first
            last, part = seq[-1].as_py(), batch.column("part")[0].as_py()
    if part is not None:
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "first": [first], "last": [last]})


def _met(batches: Iterator) -> Iterator[pa.RecordBatch]:
    part = last = None
    for batch in batches:
        for r in batch.to_pylist():
            if part is not None:
                yield pa.RecordBatch.from_pydict({"left": pa.array([part], pa.int32()), "right": pa.array([r["part"]], pa.int32()), "shared": pa.array([common(last, r["first"])], pa.int32())})
            part, last = r["part"], r["last"]


def _shards(batches: Iterator, before: dict, after: dict) -> Iterator[tuple]:
    """Shards of the sorted sequences of a partition, with what they share with the sequences around them."""
    ids, seqs, words, turns, number, shared, last = [], [], [], 0, None, -1, None
    for batch in batches:
        number = batch.column("part")[0].as_py() if batch.num_rows and number is None else number
        for conv_id, seq, counts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "words")), strict=True):
            if not seqs and last is None:
                shared = before.get(number, -1)
            if seqs and (turns >= SHARD_TURNS or len(seqs) >= SHARD_ROWS):
                follows = common(seqs[-1], seq)
                yield number, np.array(ids, np.int64), seqs, np.array(words, np.int64), shared, follows
                ids, seqs, words, turns, shared = [], [], [], 0, follows
            ids.append(conv_id)
            seqs.append(seq)
            words.extend(counts)
            turns, last = turns + len(counts), seq
    if seqs:
        yield number, np.array(ids, np.int64), seqs, np.array(words, np.int64), shared, after.get(number, -1)


def _hashed(batches: Iterator) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, joined by commas as they come."""
    node = digest = None
    for batch in batches:
        for key, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    yield pa.RecordBatch.from_pydict({"node": [node], "hashed": [digest.hexdigest()]})
                node, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if node is not None:
        yield pa.RecordBatch.from_pydict({"node": [node], "hashed": [digest.hexdigest()]})


def nodes(seqs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (as ``sequences`` gives them): conv_id (the least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    dealt = _sorted(seqs)
    edges = dealt.select("part", "seq").mapInArrow(_ends, "part int, first string, last string")
    met = edges.repartition(1).sortWithinPartitions("part").mapInArrow(_met, "left int, right int, shared int").collect()
    before, after = {r.right: r.shared for r in met}, {r.left: r.shared for r in met}

    def build(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for _, ids, seqs, words, left, right in _shards(batches, before, after):
            made = shard_nodes(ids, seqs, words, left, right)
            columns = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _NODE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(made[c], t) for c, t in columns], [c for c, _ in columns])

    found = cut(dealt.mapInArrow(build, _NODE))
    split = found.where("node is not null")
    merged = split.groupBy("node").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in _SUMS), F.max("ends").alias("ends"))
    pieces = split.where("piece is not null").select("node", "piece_at", "piece").repartition("node").sortWithinPartitions("node", "piece_at")
    merged = cut(merged.join(pieces.mapInArrow(_hashed, "node string, hashed string"), "node", "left").withColumn("ends", F.coalesce("hashed", "ends")).drop("hashed"))
    columns = ["conv_id", "depth", "parent", *_SUMS, "ends"]
    below = found.where("node is null").select(*columns, "parent_conv_id").unionByName(merged.select(*columns, F.lit(None).cast("long").alias("parent_conv_id")))
    known = below.where("parent is null").drop("parent")
    tops = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("of"))
    joined = below.where("parent is not null").join(tops, "parent", "left").withColumn("parent_conv_id", F.col("of")).drop("of", "parent")
    none = hashlib.sha256(b"").hexdigest()
    return known.unionByName(joined).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(none)).alias("ends_sha256"))


def tries(seqs: DataFrame) -> DataFrame:
    """The packed tries themselves, one row per shard: part, turns (the digest of dense id k + 1 stands at k), base, check.
    ``find`` walks a sequence through one."""

    def build(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for part, _, seqs, _, _, _ in _shards(batches, {}, {}):
            turns, codes, starts, lengths = _coded(seqs)
            trie = packed(codes, starts, lengths)
            n = trie.last + 1
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "turns": [[t.decode() for t in turns]], "base": pa.array([trie.base[:n].tolist()], pa.list_(pa.int32())), "check": pa.array([trie.check[:n].tolist()], pa.list_(pa.int32()))})

    return _sorted(seqs).mapInArrow(build, "part int, turns array<string>, base array<int>, check array<int>")


def find(turns: list[str], base: list[int], check: list[int], seq: str) -> int:
    """How many turns of a sequence a packed trie knows as a prefix."""
    codes, state = {t: k + 1 for k, t in enumerate(turns)}, 0
    for depth in range(len(seq) // DIGITS):
        t = base[state] + codes.get(seq[depth * DIGITS : (depth + 1) * DIGITS], len(base))
        if not 0 < t < len(check) or check[t] != state:
            return depth
        state = t
    return len(seq) // DIGITS


def prefix_tree(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """The nodes of all rebuilt conversations."""
    return nodes(rebuilt(conversations, group, heads))
