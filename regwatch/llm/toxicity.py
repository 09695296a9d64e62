"""Toxicity by a learned lexicon, misspellings included, weighed by context.

Terms and stems that mark toxic documents are learned from a bounded sample of labelled rows and kept in a trie. Words
are run through the intersection of that trie with the Levenshtein automata of its terms, made deterministic as states
are met: one edit for terms of five letters or more, two for terms of nine or more, none below; stems match as
prefixes. All letter runs of a word are tried and the best one counts; signs that mask letters, as in "id10t", stand
for the letters they look like. Every hit gets a score from a window of words around it: quotation marks and reporting verbs lower it,
second persons raise it. A logistic regression over the sums gives the document's score.

Defined results: null and empty texts get the score of a text without hits; a null doc_id stays null; labels of null
count as absent; repeated rows are judged each by itself; very long texts are scored whole; of several grades of a word
the best counts, of equal ones either; an empty table gives an empty result; without labels of both kinds the score is 0
or the rate of the labels; further columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, fold, text_of

#: Labelled rows of either kind that may be learned from (about: a hash under a threshold picks them).
TOXIC_ROWS, CLEAN_ROWS = 3000, 6000
#: Lengths of stems, least documents behind a term, and least ratio of its rates.
STEMS, LEAST_DOCS, LEAST_RATIO = range(4, 8), 5, 20.0
#: A prefix is a stem unless one word makes up this share of it.
ONE_WORD = 0.8
#: Words to either side of a hit that make its context, and words that a worker remembers.
WINDOW, WORDS = 6, 800_000
PREDICT_AT = 0.3
# Quotation marks, and words of the four languages that report speech or address a person.
QUOTES = set("\"“”„«»‹›‘’'`")
REPORTS = set("said says say wrote writes called calls quote quoted word term sagte nannte schrieb wort dit appelle mot dijo llama palabra".split())
PERSONS = set("you your youre u du dich dein ihr tu te toi vous ton usted eres tus".split())
#: Signs that mask letters, and the letters they look like; an asterisk stands for any.
LOOKS = {"@": "a", "$": "s", "!": "il", "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "*": None}
_SIGN = re.compile(r"[@$0-9*!]")
#: Runs of letters alone, with single signs within, and with any signs within or before.
_RUNS = tuple(map(re.compile, (r"[^\W\d_]+", r"[^\W\d_]+(?:[@$0-9*!][^\W\d_]+)*", r"[@$0-9*!]*[^\W\d_]+(?:[@$0-9*!]+[^\W\d_]+)*")))


def terms_of(word: str) -> list[str]:
    """The lower-case letter runs of a word, without and with the signs in and before them."""
    kinds = _RUNS if _SIGN.search(word) else _RUNS[:1]
    return list(dict.fromkeys(run.lower() for kind in kinds for run in kind.findall(word)))


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """A trie of words and stems, and the lazily built deterministic automaton of all strings close to them."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_edits, self.stem_edits = [-1], [-1]
        for terms, budget in ((words, self.word_edits), (stems, self.stem_edits)):
            for term in terms:
                budget[self._node(term)] = max(0, edits_for(term) - (budget is self.stem_edits))
        self.room = [max(w, s) for w, s in zip(self.word_edits, self.stem_edits, strict=True)]
        for node in range(len(self.children) - 1, -1, -1):
            self.room[node] = max([self.room[node], *(self.room[c] for c in self.children[node].values())])
        self._reset()

    def _node(self, term: str) -> int:
        node = 0
        for c in term:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.word_edits.append(-1)
                self.stem_edits.append(-1)
            node = self.children[node][c]
        return node

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.states: list[dict[int, int]] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[int, int]] = []
        self._state({0: 0})

    def _state(self, places: dict[int, int]) -> int:
        """The state of (node, fewest edits) pairs, after lexicon letters are skipped too; -1: no term is left."""
        queue = list(places.items())
        while queue:
            node, edits = queue.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.room[child] and edits + 1 < places.get(child, 99):
                    places[child] = edits + 1
                    queue.append((child, edits + 1))
        if not places:
            return -1
        key = frozenset(places.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(places)
            self.steps.append({})
            grade = lambda budget: max((2 - (e > 0) for n, e in places.items() if e <= budget[n]), default=0)
            self.found.append((grade(self.word_edits), grade(self.stem_edits)))
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        places: dict[int, int] = {}
        for node, edits in self.states[state].items():
            for letter, child in self.children[node].items():
                cost = edits + (letter != c)
                if cost <= self.room[child] and cost < places.get(child, 99):
                    places[child] = cost
            if edits + 1 <= self.room[node] and edits + 1 < places.get(node, 99):
                places[node] = edits + 1
        self.steps[state][c] = out = self._state(places)
        return out

    def match(self, term: str) -> int:
        """2: a term, or a stem begins it; 1: within its edits of one; 0: neither."""
        if len(self.states) > 200_000:
            self._reset()
        state, best = 0, 0
        for c in term:
            step = self.steps[state].get(c)
            state = self._step(state, c) if step is None else step
            if state < 0:
                return best
            stem = self.found[state][1]
            if stem == 2:
                return 2
            best = max(best, stem)
        return max(best, self.found[state][0])

    def masked(self, term: str) -> int:
        """1: a term, or a stem begins it, if signs are read as what they look like, at most one for each letter; 0: neither."""
        nodes, letters = {0}, 0
        for k, c in enumerate(term):
            letters += c not in LOOKS
            looks = LOOKS.get(c, c)
            nodes = {child for n in nodes for letter, child in self.children[n].items() if looks is None or letter == c or letter in looks}
            if not nodes:
                return 0
            if letters >= max(2, (k + 1) / 2) and any(self.stem_edits[n] >= 0 for n in nodes):
                return 1
        return int(letters >= max(2, len(term) / 2) and any(self.word_edits[n] >= 0 for n in nodes))

    def grade(self, word: str) -> int:
        """The best grade of the letter runs of a word."""
        best = 0
        for term in terms_of(word):
            best = max(best, self.match(term) or (self.masked(term) if _SIGN.search(term) else 0))
        return best


def context_score(words: list[str], at: int) -> float:
    """1 for a plain hit; less in quotation marks or reported speech, more beside a second person."""
    before, after = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
    own = words[at]
    opened = sum(c in QUOTES and c not in "'’" for w in before for c in w) % 2 == 1
    quoted = own[:1] in QUOTES or own[-1:] in QUOTES or own.rstrip(".,;:!?")[-1:] in QUOTES or (opened and any(c in QUOTES for w in after for c in w))
    near = {t for w in before + after for t in terms_of(w)}
    return max(0.1, 1.0 - 0.6 * quoted - 0.3 * bool(near & REPORTS) + 0.2 * bool(near & PERSONS))


class Scorer:
    """Features of texts; remembers which words hit."""

    _open: tuple[tuple, Scorer] | None = None

    def __init__(self, words: list[str], stems: list[str]):
        self.lexicon, self.grades = Lexicon(words, stems), {}

    @classmethod
    def of(cls, words: list[str], stems: list[str]) -> Scorer:
        key = (tuple(words), tuple(stems))
        if cls._open is None or cls._open[0] != key:
            cls._open = (key, cls(words, stems))
        return cls._open[1]

    def features(self, text: str) -> list[float]:
        """Intercept, sums of exact and of misspelt hits by context, their share of the words, and whether any is exact."""
        words = text.encode("utf-8", "replace").split()
        grades, met = self.grades, set(words)
        if len(grades) > WORDS:
            grades.clear()
        for word in [w for w in met if w not in grades]:
            grades[word] = self.lexicon.grade(word.decode("utf-8", "replace"))
        bad = {w for w in met if grades[w]}
        sums = [0.0, 0.0, 0.0]
        if bad:
            decoded = [w.decode("utf-8", "replace") for w in words]
            for i, word in enumerate(words):
                if word in bad:
                    sums[grades[word]] += context_score(decoded, i)
        return [1.0, math.log1p(sums[2]), math.log1p(sums[1]), min(1.0, 20 * (sums[1] + sums[2]) / max(1, len(words))), float(sums[2] > 0)]


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """text and toxic of about so many labelled rows of the learning folds; the drawn ids are few enough to broadcast."""
    known = labels.where("toxic is not null and doc_id is not null").where(fold(F.col("doc_id"), 4) != 2).select(F.col("doc_id").cast("long").alias("__id"), (F.col("toxic") > 0).alias("__toxic"))
    counts = {r["__toxic"]: r.n for r in known.groupBy("__toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    share = lambda toxic, rows: min(1.0, rows / max(1, counts.get(toxic, 0)))
    drawn = known.where(draw < F.when(F.col("__toxic"), share(True, toxic_rows)).otherwise(share(False, clean_rows))).orderBy(draw, "__id", "__toxic").limit(2 * (toxic_rows + clean_rows))
    return text_of(docs).join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("text", F.col("__toxic").cast("int").alias("toxic"))


def _counted(batches):
    """Documents of either kind behind each word and stem, summed over a task."""
    counts: list[Counter] = [Counter(), Counter()]
    for toxic, texts in chunks(batches, ["toxic", "text"]):
        for kind, text in zip(toxic, texts, strict=True):
            terms = {t for w in set(text.encode("utf-8", "replace").split()) for t in terms_of(w.decode("utf-8", "replace"))}
            counts[kind].update(t + "$" for t in terms)
            counts[kind].update({t[:n] for t in terms for n in STEMS if len(t) > n})
    for kind in (0, 1):
        items = list(counts[kind].items())
        for k in range(0, len(items), 50_000):
            terms, n = zip(*items[k : k + 50_000], strict=True)
            zero = [0] * len(n)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(n if kind else zero, pa.int64()), pa.array(zero if kind else n, pa.int64())], ["term", "toxic", "clean"])


def learn_terms(drawn: DataFrame) -> tuple[list[str], list[str]]:
    """Whole words and stems whose rate among toxic documents is far above that among clean ones."""
    totals = {r.toxic: r.n for r in drawn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    sums = drawn.mapInArrow(_counted, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    rows = sums.where((F.col("toxic") >= max(LEAST_DOCS, toxic // 400)) & (ratio >= LEAST_RATIO)).collect()  # each stands in LEAST_DOCS of TOXIC_ROWS documents
    rows.sort(key=lambda r: (-r.toxic, r.term))
    words = {r.term[:-1]: r.toxic for r in rows if r.term.endswith("$")}
    stems: list[str] = []
    for r in sorted((r for r in rows if not r.term.endswith("$")), key=lambda r: len(r.term)):
        top = max((n for w, n in words.items() if w.startswith(r.term)), default=0)
        if top < ONE_WORD * r.toxic and not r.term.startswith(tuple(stems)):
            stems.append(r.term)
    return sorted(w for w in words if not w.startswith(tuple(stems))), sorted(stems)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w -= np.linalg.solve(h, g)
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str], list[float]]:
    """Words, stems and regression weights."""
    drawn = cut(sample(docs, labels))
    words, stems = learn_terms(drawn)
    shared = drawn.sparkSession.sparkContext.broadcast((words, stems))

    def measured(batches):
        scorer = Scorer.of(*shared.value)
        for toxic, texts in chunks(batches, ["toxic", "text"]):
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array([scorer.features(t) for t in texts], pa.list_(pa.float64()))], ["toxic", "x"])

    rows = drawn.mapInArrow(measured, "toxic int, x array<double>").collect()  # as many as the sample
    y = np.array([r.toxic for r in rows], float)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return words, stems, [math.log(max(rate, 1e-9) / max(1 - rate, 1e-9)), 0.0, 0.0, 0.0, 0.0]
    known = labels.where("toxic is not null").where(fold(F.col("doc_id"), 4) != 2).agg(F.avg((F.col("toxic") > 0).cast("int"))).first()[0]
    weight = np.where(y == 1, known / y.mean(), (1 - known) / (1 - y.mean()))
    return words, stems, fit(np.array([r.x for r in rows]), y, weight).tolist()


def score(docs: DataFrame, labels: DataFrame | None = None, model: tuple | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; learned from labels unless a model is given."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))

    def scored(batches):
        words, stems, weights = shared.value
        scorer = Scorer.of(words, stems)
        for ids, held, texts in chunks(batches, ["doc_id", "held_out", "text"]):
            logits = [sum(map(float.__mul__, weights, scorer.features(t))) for t in texts]
            p = [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in logits]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(p, pa.float64()), pa.array([int(x >= PREDICT_AT) for x in p], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = text_of(docs, (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
