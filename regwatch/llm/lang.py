"""Language identification by a bidirectional gated recurrent network over bytes.

The network runs over a text's bytes in both directions, across words, and gives every position a distribution over the
languages; a document's probability of a language is the mean over all positions. Long texts are read in stretches:
each position is labelled once, by states that have run over at least CONTEXT bytes before and behind it, or over all
there are. The network is small, trained by backpropagation through time on a bounded sample of labelled documents.

Defined results: a text that is null or has no letter is ``und`` with score 0; a null doc_id stays null and counts as
the empty text in the fold; repeated rows are judged each by itself; of equal probabilities the language that sorts
first wins; very long texts are read whole, a stretch at a time; an empty table gives an empty result; without any
labelled row every text is ``und``; further columns of the input, whatever their names, are ignored by ``identify`` and
kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold

#: Rows of each language that may be learned from, and the most languages: more are an error, none is left out.
SAMPLE_ROWS, MOST_LANGS = 300, 200
#: Stretches that a sampled document gives, spread over its whole text, and their bytes.
CROPS, CROP = 4, 96
HIDDEN, EPOCHS, BATCH, RATE = 12, 4, 64, 0.02
#: Bytes of a text that one column of a batch labels, bytes of context to either side, and columns of a batch.
STRETCH, CONTEXT, COLUMNS = 1024, 128, 512
#: Characters of the texts that a task takes up at once.
TEXTS = 2_000_000
#: Probabilities that are held at once.
CELLS = 1 << 20
#: A document whose best language has a lower score is in none of the learned languages.
LEAST_SCORE = 0.3
UNKNOWN = "und"
SPACE = 32
#: A byte that UTF-8 never uses fills up columns.
FILL = b"\xff"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class ByteGru:
    """Two gated recurrent layers, one for each direction, and a softmax at every position."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        make = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.p = {f"{k}{d}": v for d in "fb" for k, v in (("x", make(256, 3 * hidden)), ("h", make(hidden, 3 * hidden)), ("b", np.zeros(3 * hidden, np.float32)))}
        self.p |= {"o": make(2 * hidden, len(langs)), "c": np.zeros(len(langs), np.float32)}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str):
        """States of one direction at each step (steps, words, hidden), and what the way back needs."""
        n = self.hidden
        wx, wh, b = self.p[f"x{d}"], self.p[f"h{d}"], self.p[f"b{d}"]
        h = np.zeros((x.shape[1], n), np.float32)
        states, kept = [], []
        for t in range(len(x)):
            a = wx[x[t]] + b
            g = h @ wh
            zr = _sigmoid(a[:, : 2 * n] + g[:, : 2 * n])
            z, r = zr[:, :n], zr[:, n:]
            s = np.tanh(a[:, 2 * n :] + r * g[:, 2 * n :])
            m = mask[t][:, None]
            new = np.where(m, (1 - z) * h + z * s, h)
            kept.append((h, z, r, s, g[:, 2 * n :]))
            h = new
            states.append(h)
        return np.stack(states), kept

    def forward(self, x: np.ndarray, mask: np.ndarray):
        """Probabilities of each language at each position: (steps, words, languages)."""
        f, kf = self._run(x, mask, "f")
        b, kb = self._run(x[::-1], mask[::-1], "b")
        both = np.concatenate([f, b[::-1]], 2)
        logits = both @ self.p["o"] + self.p["c"]
        e = np.exp(logits - logits.max(2, keepdims=True))
        return e / e.sum(2, keepdims=True), (both, kf, kb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Of the mean cross-entropy over all positions, by backpropagation through time."""
        prob, (both, kf, kb) = self.forward(x, mask)
        total = max(1, int(mask.sum()))
        loss = -float(np.log(np.take_along_axis(prob, np.broadcast_to(y[None, :, None], (*x.shape, 1)), 2) + 1e-9)[..., 0][mask].sum()) / total
        d = prob.copy()
        d[:, np.arange(x.shape[1]), y] -= 1
        d *= mask[:, :, None] / total
        out = {"o": np.einsum("twh,twl->hl", both, d), "c": d.sum((0, 1))}
        dh = d @ self.p["o"].T
        n = self.hidden
        for way, (xs, ms, ks, up) in {"f": (x, mask, kf, dh[:, :, :n]), "b": (x[::-1], mask[::-1], kb, dh[::-1, :, n:])}.items():
            wh = self.p[f"h{way}"]
            gh, each = np.zeros_like(wh), np.zeros((*xs.shape, 3 * n), wh.dtype)
            back = np.zeros((x.shape[1], n), np.float32)
            for t in range(len(xs) - 1, -1, -1):
                h, z, r, s, g = ks[t]
                m = ms[t][:, None].astype(np.float32)
                whole = back + up[t]
                on = whole * m
                ds = on * z * (1 - s * s)
                dz = on * (s - h) * z * (1 - z)
                dr = ds * g * r * (1 - r)
                da = np.concatenate([dz, dr, ds], 1)
                dg = np.concatenate([dz, dr, ds * r], 1)
                each[t] = da
                gh += h.T @ dg
                back = whole * (1 - m) + on * (1 - z) + dg @ wh.T
            flat, spots = each.reshape(-1, 3 * n), xs.ravel()
            gx = np.stack([np.bincount(spots, column, 256) for column in flat.T], 1).astype(wh.dtype)
            out |= {f"x{way}": gx, f"h{way}": gh, f"b{way}": flat.sum(0)}
        return out, loss

    def fit(self, stretches: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> ByteGru:
        """Adam over batches of stretches of like length."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        lengths = np.array([len(w) for w in stretches])
        step, rate = 0, RATE
        for _ in range(epochs):
            order = rng.permutation(len(stretches))
            order = order[np.argsort(lengths[order], kind="stable")]
            cuts = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
            for k in rng.permutation(len(cuts)):
                x, mask = padded([stretches[i] for i in cuts[k]])
                grads, _ = self.gradients(x, mask, labels[cuts[k]])
                step += 1
                for name, g in grads.items():
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.99 * square[name] + 0.01 * g * g
                    self.p[name] -= rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6)
            rate /= 2
        return self

    def _states(self, x: np.ndarray, steps: Iterable[int], d: str) -> np.ndarray:
        """States of one direction after each of the steps, by step: (rows of x, hidden, columns). A state stands still
        on FILL. Gates and tanh are computed by exp, which numpy does many at a time: sigmoid(v) = 1 / (1 + exp(-v)) and
        tanh(v) = 1 - 2 / (1 + exp(2 v)), with these factors put into the weights; an exp that overflows gives the limit."""
        n = self.hidden
        factor = np.repeat(np.array([-1.0, -1.0, 2.0], np.float32), n)
        wx = np.ascontiguousarray(((self.p[f"x{d}"] + self.p[f"b{d}"]) * factor).T)
        wx[:n, FILL[0]] = 60.0
        wh = np.ascontiguousarray((self.p[f"h{d}"] * factor).T)
        out = np.empty((len(x), n, x.shape[1]), np.float32)
        h = np.zeros((n, x.shape[1]), np.float32)
        a, g = np.empty((3 * n, x.shape[1]), np.float32), np.empty((3 * n, x.shape[1]), np.float32)
        gates, s = a[: 2 * n], a[2 * n :]
        z, r = gates[:n], gates[n:]
        with np.errstate(over="ignore"):
            for t in steps:
                np.take(wx, x[t], 1, out=a, mode="clip")
                np.matmul(wh, h, out=g)
                gates += g[: 2 * n]
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                r *= g[2 * n :]
                s += r
                np.exp(s, out=s)
                s += 1
                np.divide(-2, s, out=s)
                s += 1
                s -= h
                s *= z
                h = np.add(h, s, out=out[t])
        return out

    def sums(self, texts: list[bytes]) -> np.ndarray:
        """For each text the sum of its positions' probabilities, and their number as the last column."""
        out = np.zeros((len(self.langs) + 1, len(texts)), np.float64)
        parts = sorted((min(STRETCH, len(text) - lo), k, lo) for k, text in enumerate(texts) for lo in range(0, len(text), STRETCH))
        for i in range(0, len(parts), COLUMNS):
            own = parts[i : i + COLUMNS]
            most = own[-1][0]
            # Context that no column of the batch has is not run over.
            ahead = max(min(lo, CONTEXT) for _, _, lo in own)
            behind = max(min(len(texts[k]) - lo - n, CONTEXT) for n, k, lo in own)
            rows = ahead + most + behind
            filled = []
            for n, k, lo in own:
                left = min(lo, CONTEXT)
                filled.append((FILL * (ahead + most - n - left) + texts[k][lo - left : lo + n + CONTEXT]).ljust(rows, FILL))
            x = np.frombuffer(b"".join(filled), np.uint8).reshape(len(own), rows).T.astype(np.intp)
            forth = self._states(x, range(ahead + most), "f")
            back = self._states(x, range(rows - 1, ahead - 1, -1), "b")
            lengths = np.array([n for n, _, _ in own])
            pooled = np.zeros((len(self.langs), len(own)))
            wide = max(1, CELLS // (len(self.langs) * len(own)))
            for lo in range(ahead, ahead + most, wide):
                at = slice(lo, min(lo + wide, ahead + most))
                e = np.matmul(self.p["o"][: self.hidden].T, forth[at]) + np.matmul(self.p["o"][self.hidden :].T, back[at])
                e += self.p["c"][:, None]
                e -= e.max(1, keepdims=True)
                np.exp(e, out=e)
                e /= e.sum(1, keepdims=True)
                e *= (np.arange(at.start, at.stop)[:, None] >= ahead + most - lengths)[:, None, :]
                pooled += e.sum(0)
            np.add.at(out.T, [k for _, k, _ in own], np.concatenate([pooled, lengths[None, :]]).T)
        return out.T


def padded(stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as (steps, stretches), and which of them are not filling."""
    steps = max(map(len, stretches))
    x = np.frombuffer(b"".join([w.ljust(steps, b" ") for w in stretches]), np.uint8).reshape(len(stretches), steps)
    inside = np.arange(steps)[None, :] < np.array([len(w) for w in stretches])[:, None]
    return np.ascontiguousarray(x.T), np.ascontiguousarray(inside.T)


def framed(text: str) -> bytes:
    """The bytes of a text between a space at either end."""
    return b" " + text.encode("utf-8", "replace") + b" "


def crops(text: str) -> list[bytes]:
    """Stretches of a text for learning: at most CROPS, evenly spread over all of it."""
    whole = framed(text)
    n = min(CROPS, -(-len(whole) // CROP))
    return [whole[at : at + CROP] for at in ((len(whole) - CROP) * k // max(1, n - 1) if n > 1 else 0 for k in range(n))]


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> ByteGru | None:
    """A network learned from text and lang of the learning folds, of about ``rows`` documents of each language.

    The documents are those whose hash is under a threshold set by the counts, so they spread over the whole table.
    More than MOST_LANGS languages are an error: none is left out.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), 4) != 2)).select("doc_id", "text", "lang")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages to learn")
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    langs = sorted(counts)

    def sampled(batches):
        for lang, texts in chunks(batches, ["lang", "text"]):
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array([crops(t) for t in texts], pa.list_(pa.binary()))], ["lang", "crops"])

    sample = known.where(F.element_at(share, F.col("lang")) > draw).select("lang", "text").mapInArrow(sampled, "lang string, crops array<binary>")
    # A bound for the driver: the threshold lets half as many pass. Only copies of one text can pass it, and then the first in order stay.
    found = sample.orderBy("lang", F.xxhash64("crops"), "crops").limit(2 * rows * len(langs)).collect()
    pairs = sorted((bytes(c), langs.index(r.lang)) for r in found for c in r.crops)
    return ByteGru(langs).fit([c for c, _ in pairs], np.array([k for _, k in pairs], np.int64)) if pairs else None


def judged(model: ByteGru | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    langs, best = [UNKNOWN] * len(texts), [0.0] * len(texts)
    spoken = [k for k, t in enumerate(texts) if model is not None and any(map(str.isalpha, t))]
    if spoken:
        sums = model.sums([framed(texts[k]) for k in spoken])
        prob = sums[:, :-1] / sums[:, -1:]
        for k, at, p in zip(spoken, prob.argmax(1).tolist(), prob.max(1).tolist(), strict=True):
            langs[k], best[k] = model.langs[at], min(1.0, p)
    return langs, best


def identify(docs: DataFrame, model: ByteGru | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from docs unless a model is given."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def predicted(batches):
        for ids, held, texts in chunks(batches, ["doc_id", "held_out", "text"], TEXTS):
            langs, best = judged(shared.value, texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(langs, pa.string()), pa.array(best, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), 4) == 2).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: ByteGru | None = None, langs: Iterable[str] | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs that ``identify`` finds to be in one of ``langs`` (all learned ones unless given) with a score of
    at least ``least``. Whole texts pass through once."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))
    wanted = None if langs is None else frozenset(langs)
    at = docs.columns.index("text")

    def kept(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found, best = judged(shared.value, [t or "" for t in part.column(at).to_pylist()])
                keep = [x != UNKNOWN and (wanted is None or x in wanted) and p >= least for x, p in zip(found, best, strict=True)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
