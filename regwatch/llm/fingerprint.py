"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

Every shingle of five words is hashed once. Its top bits name a bin and the rest is its value; a bin keeps its least
value. An empty bin takes the value of the first bin that is not empty in its own fixed order (optimal densification: the
orders are affine, and differ from bin to bin), so two texts that share a share J of their shingles agree in a bin with
probability J. Of each bin the four lowest bits are stored, a hexadecimal digit each; ``likeness`` takes off the
agreement that chance alone gives.

The next document is found without a global window: documents are dealt into buckets of adjacent ids, each bucket gets
the first document of the next one as a guest, and windows run within buckets.

Defined results: null texts are empty; a text of fewer than five words has one shingle of all of them; a text without a
word has the empty fingerprint, which is like itself (1) and like no other (0); equal texts have equal fingerprints; null
ids come first in the order of documents; rows of one id are ordered by their texts (as bytes) and each is a document;
the only document of a table is its own next one; very long texts are read whole; an empty table gives an empty result;
further columns, whatever their names, are kept by ``with_fingerprint`` and left out by ``edits``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_prefix, text_of

#: Words in a shingle, bins (a power of two, 16 at least) and stored bits of a bin.
SHINGLE, BINS, BITS = 5, 256, 4
#: Bins that an empty bin asks one after the other before it looks at all that hold a value.
ASKED = 32
#: Buckets of adjacent documents for each shuffle partition, so that hashing buckets to partitions is even.
SPREAD = 4
_LEAST = -(1 << 63)


def _bin_bits(bins: int) -> int:
    if bins < 16 or bins & (bins - 1):
        raise ValueError("bins must be a power of two, 16 at least")
    return bins.bit_length() - 1


def _with_ends(hashes: Column, bins: int) -> Column:
    """The hashes in order. A last possible value is put into every bin, so none is missing."""
    shift = 64 - _bin_bits(bins)
    ends = F.transform(F.sequence(F.lit(-(bins // 2)), F.lit(bins // 2 - 1)), lambda b: F.bitwise_not(F.shiftleft(F.bitwise_not(b.cast("long")), shift)))
    return F.sort_array(F.concat(hashes, ends))


def _firsts(ordered: Column, bins: int) -> Column:
    """Of ordered hashes the first of every bin."""
    shift = 64 - _bin_bits(bins)
    before = F.concat(F.array(F.lit(None).cast("long")), ordered)
    firsts = F.zip_with(ordered, before, lambda x, p: F.when(x.isNotNull() & (p.isNull() | (F.shiftright(x, shift) != F.shiftright(p, shift))), x))
    return F.filter(firsts, lambda x: x.isNotNull())


def _value(x: Column, bins: int) -> Column:
    """A hash without its bin; null if it is the last possible value, which stands for an empty bin."""
    rest = F.lit((1 << (64 - _bin_bits(bins))) - 1)
    return F.nullif(x.bitwiseAND(rest), rest)


def _filled(held: Column, some: Column, bins: int) -> Column:
    """Values of bins (held) with the empty ones filled: bin i asks bin hash(i, t) for t = 0, 1, ... and takes the first
    value it meets. After ASKED empty ones it takes, of all bins that hold a value (some), the one of least hash with it."""
    shift, last = 64 - _bin_bits(bins), F.lit(bins - 1)

    def donor(i: Column) -> Column:
        asked = (F.get(held, F.hash(i, F.lit(t)).bitwiseAND(last)) for t in range(ASKED))
        every = F.transform(some, lambda x: F.struct(F.xxhash64(i, F.shiftright(x, shift)).alias("by"), _value(x, bins).alias("value")))
        return F.coalesce(*asked, F.array_min(every)["value"])

    return F.when(F.size(some) > 0, F.transform(held, lambda x, i: F.when(x.isNotNull(), x).otherwise(donor(i))))


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", bins: int = BINS) -> DataFrame:
    """docs with a further column, the fingerprint of a text column. A column of that name is replaced.

    Every step is a column of its own that the next step reads more than once or outside of lambdas, so that no step is
    computed again for each element of the next.
    """
    own = free_prefix("__", docs)
    w, h, s, first, held, some, full = (f"{own}{x}" for x in ("words", "hashes", "ordered", "firsts", "held", "some", "full"))
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", -1), "")
    n = F.size(w)
    shingle = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*(F.get(F.col(w), i + k) for k in range(SHINGLE))))
    whole = F.array(F.xxhash64(*(F.get(F.col(w), F.lit(k)) for k in range(SHINGLE))))
    hashes = F.when(n >= SHINGLE, shingle).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))
    digits = F.array_join(F.transform(F.col(full), lambda x: F.hex(x.bitwiseAND(F.lit((1 << BITS) - 1)))), "")
    out = docs.withColumn(w, words).withColumn(h, hashes).withColumn(s, _with_ends(F.col(h), bins)).withColumn(first, _firsts(F.col(s), bins))
    out = out.withColumns({held: F.transform(first, lambda x: _value(x, bins)), some: F.filter(first, lambda x: _value(x, bins).isNotNull())})
    out = out.withColumn(full, _filled(F.col(held), F.col(some), bins))
    return out.withColumn(name, F.coalesce(F.lower(digits), F.lit(""))).drop(w, h, s, first, held, some, full)


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Estimated share of shingles that two fingerprints have in common, 0 to 1: agreeing bins, less those by chance."""

    def differing(k: int) -> Column:
        part = lambda x: F.conv(F.substring(x, 16 * k + 1, 16), 16, -10).cast("long")
        x = part(a).bitwiseXOR(part(b))
        any_bit = reduce(lambda y, n: y.bitwiseOR(F.shiftrightunsigned(x, n)), range(1, BITS), x)
        return F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))

    agree = F.lit(1.0) - reduce(lambda x, y: x + y, (differing(k) for k in range(bins // 16))) / F.lit(float(bins))
    chance = 2.0**-BITS
    apart = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(apart)


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id", ties: str = "text", made: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """made(docs) with ``next_<column>`` for each of the columns: that column of the next document by ascending key (nulls
    first), after the last one that of the first. made adds columns row by row; it runs before rows are dealt out and, of
    the guests, on those alone. Only the bounds of buckets and the first key of each, a few for every shuffle partition,
    pass through the driver."""
    spark = docs.sparkSession
    own = free_prefix("__", docs)
    at, bucket, guest = f"{own}at", f"{own}bucket", f"{own}guest"
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn(at, F.coalesce(F.col(key).cast("long"), F.lit(_LEAST)))
    bounds = keyed.agg(F.percentile_approx(at, [k / buckets for k in range(1, buckets)], 10 * buckets)).first()[0] or []
    bounds = sorted(set(bounds))
    keyed = keyed.withColumn(bucket, _place(F.col(at), bounds, 0, len(bounds)))
    firsts = sorted(tuple(r) for r in keyed.groupBy(bucket).agg(F.min(at)).collect())
    if not firsts:
        return made(docs).select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    before = {b: firsts[k - 1][0] for k, (b, _) in enumerate(firsts)}
    wanted = spark.createDataFrame([(first, before[b]) for b, first in firsts], f"{at} long, {own}to int")
    first_row = Window.partitionBy(at).orderBy(F.col(ties).asc_nulls_first())
    guests = keyed.drop(bucket).join(F.broadcast(wanted), at).withColumn(f"{own}n", F.row_number().over(first_row)).where(F.col(f"{own}n") == 1)
    guests = guests.withColumnRenamed(f"{own}to", bucket).withColumn(guest, F.lit(1))
    both = made(keyed.withColumn(guest, F.lit(0)).unionByName(guests.drop(f"{own}n")))
    order = Window.partitionBy(bucket).orderBy(guest, at, F.col(ties).asc_nulls_first())
    out = both.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return out.where(F.col(guest) == 0).drop(at, bucket, guest)


def _place(x: Column, bounds: list[int], low: int, high: int) -> Column:
    """How many of the sorted bounds are not above x, by halving (the expression is as deep as the bounds' logarithm)."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(x < F.lit(bounds[mid]), _place(x, bounds, low, mid)).otherwise(_place(x, bounds, mid + 1, high))


def edits(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, the fingerprint, and for the text whose second half is replaced by the start
    of the next document its SHA-256 and fingerprint, with the likeness to it (near_edited) and to the next document
    (near_next)."""
    made = with_next(text_of(docs), ["text", "fingerprint"], made=with_fingerprint)
    n = F.length("text")
    half = F.shiftright(n, 1)
    made = made.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    made = with_fingerprint(made.drop("text", "next_text"), "edited", "edited_fingerprint")
    own, edited, following = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return made.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), own, edited, likeness(own, edited).alias("near_edited"), likeness(own, following).alias("near_next"))
