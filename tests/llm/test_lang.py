import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from regwatch.llm import lang

WORDS = {"en": "the of and thing that with".split(), "de": "der die und über nicht schön".split(), "fr": "le des être où garçon que".split()}


def test_gradients_match_differences():
    model = lang.ByteGru(["a", "b"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = lang.padded([b"ab", b"cba", b"a"])
    y = np.array([0, 1, 1])
    grads, _ = model.gradients(x, mask, y)
    rng = np.random.default_rng(0)
    for name, value in model.p.items():
        spots = [np.unravel_index(i, value.shape) for i in rng.integers(0, value.size, 4)]
        spots += [(ord("a"), 1), (SPACE, 2)] if name[0] == "x" else []
        for spot in spots:
            old = value[spot]
            value[spot] = old + 1e-2
            up = model.gradients(x, mask, y)[1]
            value[spot] = old - 1e-2
            down = model.gradients(x, mask, y)[1]
            value[spot] = old
            assert abs((up - down) / 2e-2 - grads[name][spot]) < 2e-3


SPACE = lang.SPACE


def states(model, text, d):
    """The recurrence of one direction, a byte at a time."""
    n, h, out = model.hidden, np.zeros(model.hidden), []
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for byte in text if d == "f" else text[::-1]:
        a, g = model.p[f"x{d}"][byte] + model.p[f"b{d}"], h @ model.p[f"h{d}"]
        z, r = sigmoid(a[:n] + g[:n]), sigmoid(a[n : 2 * n] + g[n : 2 * n])
        h = (1 - z) * h + z * np.tanh(a[2 * n :] + r * g[2 * n :])
        out.append(h)
    return np.array(out if d == "f" else out[::-1])


def test_every_position_is_labelled_from_its_context(monkeypatch):
    monkeypatch.setattr(lang, "STRETCH", 20)
    monkeypatch.setattr(lang, "CONTEXT", 6)
    monkeypatch.setattr(lang, "COLUMNS", 7)
    model, rng = lang.ByteGru(["a", "b", "c"]), random.Random(3)
    texts = [bytes(rng.choices(range(1, 250), k=n)) for n in (1, 2, 19, 20, 21, 45, 140)]
    got = model.sums(texts)
    for text, row in zip(texts, got, strict=True):
        want = np.zeros(3)
        for lo in range(0, len(text), 20):
            hi, left = min(lo + 20, len(text)), min(lo, 6)
            forth = states(model, text[lo - left : hi], "f")[left:]
            back = states(model, text[lo : hi + 6], "b")[: hi - lo]
            logits = np.concatenate([forth, back], 1) @ model.p["o"] + model.p["c"]
            e = np.exp(logits)
            want += (e / e.sum(1, keepdims=True)).sum(0)
        assert row[-1] == len(text) and np.allclose(row[:-1], want, atol=1e-3)


def test_context_that_no_text_has_is_not_run_over(monkeypatch):
    """Before, texts of one stretch were run over with CONTEXT bytes of filling on either side."""
    steps, states_of = [], lang.ByteGru._states
    monkeypatch.setattr(lang.ByteGru, "_states", lambda self, x, way, d: steps.append(len(way)) or states_of(self, x, way, d))
    lang.ByteGru(["a", "b"]).sums([b"x" * 50, b"y" * 20])
    assert steps == [50, 50]
    steps.clear()
    lang.ByteGru(["a", "b"]).sums([b"x" * (lang.STRETCH + 50)])
    assert steps == [lang.CONTEXT + lang.STRETCH, lang.STRETCH + 50]


def test_the_order_of_words_matters():
    model = lang.ByteGru(["a", "b"])
    one, two = model.sums([lang.framed("foo bar"), lang.framed("bar foo")])
    assert abs(one[0] - two[0]) > 1e-4


def test_crops_spread_over_the_whole_text():
    text = "".join(chr(97 + k % 26) for k in range(5000))
    got = lang.crops(text)
    whole = lang.framed(text)
    assert len(got) == lang.CROPS and whole.startswith(got[0]) and whole.endswith(got[-1])
    assert lang.crops("ab") == [b" ab "] and lang.crops("") == [b"  "]


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(WORDS[k], k=rng.randrange(3, 30))), k) for i, k in enumerate(rng.choices(list(WORDS), k=400))]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 %% 34", "en"), (903, "the thing " * 20000, None), (None, "der die und", None), (904, "le des", "fr"), (904, "le des", "fr")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, score int")
    got = lang.identify(docs).collect()
    assert len(got) == len(rows)
    right = total = 0
    for (doc_id, text, want), r in zip(rows, sorted(got, key=lambda r: [x[0] for x in rows].index(r.doc_id)), strict=True):
        assert r.held_out == (zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r.score <= 1
        if r.held_out and want and r.lang_pred != "und":
            right, total = right + (r.lang_pred == want), total + 1
    assert total > 50 and right / total > 0.97
    model = lang.train(docs)
    judged = {r.doc_id: r for r in lang.identify(docs, model).collect()}
    kept = lang.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in judged.items() if r.lang_pred != "und" and r.score >= lang.LEAST_SCORE}
    foreign = {r.doc_id for r in lang.keep_known(docs, model, ["en", "de"]).collect()}
    assert foreign == {d for d, r in judged.items() if r.lang_pred in ("en", "de") and r.score >= lang.LEAST_SCORE} and 904 not in foreign
    assert not {900, 901, 902} & foreign and lang.keep_known(docs, model, least=1.01).count() == 0
    assert lang.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in lang.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang is null")).collect()} == {"und"}


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(lang, "MOST_LANGS", 2)
    docs = spark.createDataFrame([(i, "some text", f"l{i % 3}") for i in range(60)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        lang.train(docs)


def whole_recurrence(model, text):
    """Mean probability of each language, byte by byte over the whole text, from the weights alone."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    n, data = model.hidden, np.frombuffer(b" " + text.encode() + b" ", np.uint8)

    def states(seq, d):
        h, out = np.zeros(n), []
        for byte in seq:
            a, g = p[f"x{d}"][byte] + p[f"b{d}"], h @ p[f"h{d}"]
            z, r = (1 / (1 + np.exp(-(a[k * n : k * n + n] + g[k * n : k * n + n]))) for k in (0, 1))
            h = (1 - z) * h + z * np.tanh(a[2 * n :] + r * g[2 * n :])
            out.append(h)
        return np.array(out)

    logits = np.concatenate([states(data, "f"), states(data[::-1], "b")[::-1]], 1) @ p["o"] + p["c"]
    e = np.exp(logits - logits.max(1, keepdims=True))
    return (e / e.sum(1, keepdims=True)).mean(0)


def test_identify_matches_the_recurrence_over_whole_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang.train(docs)
    rows = docs.where("text is not null").orderBy(F.xxhash64("doc_id")).limit(150).select("doc_id", "text").collect()
    rows += [(10_001, "a"), (10_002, ""), (10_003, " ".join(r.text for r in rows[:40]))]
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang.identify(spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string"), model).collect()}
    apart = []  # by the context of 128 bytes from which a stretch of 1024 starts
    for doc_id, text in rows:
        if any(map(str.isalpha, text)):
            prob = whole_recurrence(model, text)
            apart.append(abs(got[doc_id][1] - prob.max()))
            second = np.sort(prob)[-2]
            assert got[doc_id][0] == model.langs[int(prob.argmax())] or prob.max() - second < 0.02, text[:100]
    assert np.mean(apart) < 0.0005 and np.max(apart) < 0.02
