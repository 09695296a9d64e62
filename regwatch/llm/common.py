"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task holds before it hands a batch on; texts are whole, so a batch is also cut by its characters.
BATCH_CHARS = 8_000_000
MASK = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; a local master may do without one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="regwatch-checkpoint-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder, so that later reads neither repeat its work nor depend on an executor.

    The shuffle files behind it are not needed any more; Spark removes them once the driver has collected its garbage,
    which otherwise may be long after the disks are full.
    """
    spark = df.sparkSession
    shared_dir(spark)
    out = df.checkpoint(eager=True)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return out


def free(name: str, *frames: DataFrame) -> str:
    """The name, or a longer one that is no column of the frames (in any spelling)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name in taken:
        name += "_"
    return name


def free_prefix(prefix: str, *frames: DataFrame) -> str:
    """The prefix, or a longer one with which no column of the frames begins (in any spelling)."""
    while any(c.lower().startswith(prefix) for f in frames for c in f.columns):
        prefix += "_"
    return prefix


def text_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) of docs, without its other columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id written as text, modulo n."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def words_of(text: str) -> list[bytes]:
    """The maximal runs without ASCII white space, in UTF-8 (bytes.split() knows just those six characters)."""
    return text.encode("utf-8", "replace").split()


def hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser of 64-bit integers (the public splitmix64 constants)."""
    z = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & MASK)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
_LETTERS = mixed(np.arange(256, dtype=np.uint64), 61)
_BASE = 0x9E3779B97F4A7C15
#: Words of more bytes are hashed by the library one by one: sums of powers are weak on very long ones.
LONG_WORD = 64


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def words_in(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (as ``words_of`` splits) of the texts, end to end, and the bounds of the texts in it."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(_BLANK[data], prepend=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(1 << max(10, (len(data) + 1).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[: len(data)], out=sums[1:])
    h = mixed((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64), 62)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        h[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return h, np.searchsorted(starts, bounds)


def give_back() -> None:
    """Hand memory that is free already back to the system. Workers live on after a task, beside the next task's JVM; without
    this they keep the most that any of their tasks took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: its own rules hold


def chunks(batches: Iterable, columns: list[str], chars: int = BATCH_CHARS, rows: int = 256):
    """Lists of the columns of Arrow batches; the last column is text and a chunk holds about so many characters, or so
    many rows if they hold more."""
    out: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        got = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for start in range(0, batch.num_rows, rows):
            part = [c.slice(start, rows).to_pylist() for c in got]
            for whole, more in zip(out, part, strict=True):
                whole += more
            size += sum(map(len, part[-1]))
            if size >= chars:
                yield out
                out, size = [[] for _ in columns], 0
    if out[0]:
        yield out
    out, batch, got, part = [], None, None, None
    give_back()


#: Probes of the Bloom filter: the lowest bits of a 64-bit hash after each of these shifts.
PROBES = (0, 18, 37)


def bloom(keys: DataFrame, bits_each: int, least: int = 1 << 20, most: int = 1 << 27) -> np.ndarray:
    """A Bloom filter, as 64-bit words, of the column ``key`` (long hashes). Spark merges its words; the driver gets
    most / 64 of them at most (16 MB), however many keys there are: with more keys it lets more others pass."""
    bits = min(most, max(least, 1 << math.ceil(math.log2(max(1, keys.count() * bits_each)))))
    at = F.explode(F.array(*(F.shiftrightunsigned("key", k).bitwiseAND(bits - 1) for k in PROBES))).alias("at")
    words = keys.select(at).select(F.shiftright("at", 6).alias("w"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("b"))
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return out


def in_bloom(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indices of the keys (unsigned) that the filter may hold."""
    found = np.arange(len(keys))
    top = np.uint64(len(filter_) * 64 - 1)
    for k in PROBES:
        at = (keys[found] >> np.uint64(k)) & top
        found = found[(filter_[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0]
    return found
