"""Personal data by pattern, checksum and context, in DataFrame functions alone (a map without a shuffle).

A regular expression proposes spans of a kind, a validator confirms them (part range, digit count, Luhn, mod-97), and
context words close by raise the score. Email, ip, card and phone are the base kinds; iban is added. The patterns are
written so that a long run of characters is tried once, from its start: they match what the plain ones match.

Defined results: null and empty texts have no span and the hash of the empty string; a null doc_id stays null; repeated
rows are judged each by itself; spans of one start stand in the order of their kinds; very long texts are searched whole;
an empty table gives an empty result; further columns of the input, whatever their names, are ignored by ``find_spans``
and kept by ``with_spans`` and ``redact``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_prefix, text_of

#: Kinds in the order that breaks ties of start.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"{_LOCAL}(?:(?<!{_LOCAL}{{2}})|(?<=\G{_LOCAL})){_LOCAL}*+@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
}
#: What a text must hold for the pattern to have a chance.
NEEDS = {"email": "@", "phone": "+"}
#: Score of a confirmed span, and words close by that add to it.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8}
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|server|host|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|telefon|llame",
    "iban": "iban|bank|account|konto|compte|cuenta",
}
BONUS, REACH = 0.2, 40
# A part of zeros alone has nothing left after them; the pattern of the span sees to it that every part has a digit.
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})?"


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _number(c: Column, i: Column) -> Column:
    return F.substring(c, i, F.lit(1)).cast("int")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        twice = _number(back, i) * F.when(i % 2 == 0, 2).otherwise(1)
        return twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number in capitals and digits has the remainder 1, its first four characters moved to the end."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(a: Column, i: Column) -> Column:
        at = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(at >= 65, (a * 100 + at - 55) % 97).otherwise((a * 10 + at - 48) % 97).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda s: F.when(F.length(_digits(s)).between(12, 19), luhn(_digits(s))).otherwise(False),
    "phone": lambda s: F.length(_digits(s)).between(9, 15),
    "iban": mod97,
}
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"
#: Elements that one running sum takes in at a time, and characters of the pieces that a text is cut into.
RUN, PIECE = 256, 256


def _running(df: DataFrame, arrays: dict[str, tuple[str, str, Callable[[Column, Column], Column]]]) -> DataFrame:
    """df with further columns, by name (array column, type of its elements, op): its elements as structs (before, item),
    where before is op over the field ``x`` of all elements before, from 0. Runs of RUN elements are summed by themselves
    and moved on by the sums of the runs before them, so no array grows by more than a run, or than the number of runs."""
    own = free_prefix("__run_", df)
    runs = lambda c: F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / RUN).cast("int")), lambda k: F.slice(c, k * RUN + 1, RUN))
    none = lambda kind: F.array().cast(f"array<struct<before:int,item:{kind}>>")

    def summed(kind: str, op: Callable) -> Callable[[Column], Column]:
        step = lambda s, x: F.struct(op(s["at"], x["x"]).alias("at"), F.concat(s["out"], F.array(F.struct(s["at"].alias("before"), x.alias("item")))).alias("out"))
        return lambda run: F.aggregate(run, F.struct(F.lit(0).alias("at"), none(kind).alias("out")), step)

    def moved(sums: str, op: Callable) -> Column:
        step = lambda s, r: F.struct(op(s["at"], r["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        offsets = F.aggregate(F.col(sums), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step, lambda s: s["out"])
        return F.flatten(F.zip_with(F.col(sums), offsets, lambda r, off: F.transform(r["out"], lambda e: F.struct(op(off, e["before"]).alias("before"), e["item"].alias("item")))))

    df = df.withColumns({f"{own}runs_{n}": F.when(F.size(c) > 0, runs(F.col(c))) for n, (c, _, _) in arrays.items()})
    df = df.withColumns({f"{own}sums_{n}": F.transform(f"{own}runs_{n}", summed(kind, op)) for n, (_, kind, op) in arrays.items()})
    df = df.withColumns({n: F.coalesce(moved(f"{own}sums_{n}", op), none(kind)) for n, (_, kind, op) in arrays.items()})
    return df.drop(*(c for c in df.columns if c.startswith(own)))


def _part(pieces: Column, start: Column, length: Column) -> Column:
    """length characters from start on (from 0), out of the pieces that hold them."""
    first = F.floor(start / PIECE).cast("int")
    count = F.floor((start + length) / PIECE).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(pieces, first + 1, count), ""), start - first * PIECE + 1, length)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _confirmed(kind: str, placed: str, pieces: Column) -> Column:
    """The spans of a kind that hold, scored by the words around them."""

    def span(e: Column) -> Column:
        start = e["before"] + e["item"]["gap"]
        end = e["before"] + e["item"]["x"]
        near = F.lower(_part(pieces, F.greatest(F.lit(0), start - REACH), end - start + 2 * REACH))
        score = F.lit(SCORES[kind]) + F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})"), BONUS).otherwise(0.0)
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), F.round(score, 2).alias("score"))

    return F.transform(F.filter(F.col(placed), lambda e: VALID[kind](e["item"]["span"])), span).cast(_SPAN)


def with_spans(docs: DataFrame, name: str = "pii_spans") -> DataFrame:
    """docs with a further column: all spans as structs (start, rank, kind, end, score), in order. A column of that name
    is replaced. Time is in proportion to the text and its spans: each step is a column of its own that the next one
    reads more than once or outside of lambdas, so that Spark does not move it into the work on a single span."""
    own, spans = free_prefix("__", docs), F.array().cast(_SPAN)
    out, none = docs.withColumn(f"{own}text", F.coalesce(F.col("text"), F.lit(""))), F.array().cast("array<string>")
    text, pieces = F.col(f"{own}text"), F.col(f"{own}pieces")
    for kind in KINDS:
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        out = out.withColumn(own + kind, F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found)
    held = {k: F.size(own + k) > 0 for k in KINDS}
    gaps = {f"{own}gaps_{k}": F.when(held[k], F.split(text, PATTERNS[k], -1)).otherwise(none) for k in KINDS}
    out = out.withColumns(gaps | {f"{own}pieces": F.when(reduce(lambda a, b: a | b, held.values()), _pieces(text)).otherwise(none)})
    part = lambda s, g: F.struct(s.alias("span"), F.length(g).alias("gap"), (F.length(g) + F.length(s)).alias("x"))
    out = out.withColumns({f"{own}parts_{k}": F.zip_with(own + k, F.slice(F.col(f"{own}gaps_{k}"), F.lit(1), F.size(own + k)), part) for k in KINDS})
    out = _running(out, {f"{own}at_{k}": (f"{own}parts_{k}", "struct<span:string,gap:int,x:int>", lambda a, x: a + x) for k in KINDS})
    out = out.withColumns({f"{own}done_{k}": F.when(held[k], _confirmed(k, f"{own}at_{k}", pieces)).otherwise(spans) for k in KINDS})
    every = F.array_sort(F.concat(*(F.col(f"{own}done_{k}") for k in KINDS)))
    return out.withColumn(name, every).drop(*(c for c in out.columns if c.startswith(own)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts of the base kinds and of iban, base_sha256, spans, scores."""
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return with_spans(text_of(docs)).select(
        "doc_id",
        *(count(k) for k in KINDS),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets; a span that begins inside an earlier one goes with
    it. What lies between two spans is read from the pieces that hold it, so the work grows with the text."""
    own = free_prefix("__", docs)
    spans, parts, at, pieces, last = (f"{own}{x}" for x in ("spans", "parts", "at", "pieces", "last"))
    out = with_spans(docs, spans).withColumn(pieces, F.when(F.size(spans) > 0, _pieces(F.col("text"))))
    kind = "struct<start:int,kind:string,x:int>"
    out = out.withColumn(parts, F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("x"))))
    out = _running(out, {at: (parts, kind, lambda a, x: F.greatest(a, x))}).withColumn(last, F.array_max(F.transform(spans, lambda s: s["end"])))

    def piece(e: Column) -> Column:
        start = e["item"]["start"]
        clear = F.when(start > e["before"], _part(F.col(pieces), e["before"], start - e["before"])).otherwise("")
        return F.when(start >= e["before"], F.concat(clear, F.lit("["), e["item"]["kind"], F.lit("]"))).otherwise("")

    rest = F.substring("text", F.col(last) + 1, F.length("text"))
    done = F.when(F.size(pieces) > 0, F.concat(F.array_join(F.transform(at, piece), ""), rest)).otherwise(F.col("text"))
    return out.withColumn("text", done).drop(spans, parts, at, pieces, last)
