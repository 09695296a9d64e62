import random

import pyarrow as pa

from regwatch.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(6)
    words, stems = ["abca", "abcab", "bcabca", "abcabcabc", "cab"], ["bbcc", "caccab"]
    lexicon = toxicity.Lexicon(words, stems)
    for _ in range(6000):
        term = "".join(rng.choices("abcd", k=rng.randrange(11)))
        want = 0
        for w in words:
            d = distance(term, w)
            want = max(want, 2 if d == 0 else 1 if d <= toxicity.edits_for(w) else 0)
        for s in stems:
            d = min(distance(term[:k], s) for k in range(len(term) + 1))
            want = max(want, 2 if term.startswith(s) else 1 if d <= max(0, toxicity.edits_for(s) - 1) else 0)
        assert lexicon.match(term) == want, term


def test_every_run_of_a_word_is_graded():
    scorer = toxicity.Scorer(["idiot", "shit"], ["vequ"])
    hits = lambda text: scorer.features(text)[1:3]
    none, exact, misspelt = hits("well then"), hits("idiot"), hits("idiott")
    assert none == [0.0, 0.0] and exact[0] > 0 and misspelt[1] > 0
    for text in ("well...idiot", "<b>idiot</b>", "you/idiot", "so,idiot,so", "a--shit", "l'idiot", "**idiot**", "you!idiot", "one.two/vequa-three", "x" * 50 + "/idiot"):
        assert hits(text) == exact, text
    for text in ("id10t", "i**ot", "$hit", "*hit", "sh!t", "$h1t", "v3qua", "(1d1ot)"):
        assert hits(text) == misspelt, text
    for text in ("****bold", "10th", "2024", "***", "i5", "x1000", "*house*", "shirt", "h1t", "*****x", "*t"):
        assert hits(text) == none, text
    at = "they wrote \"well...idiot\" home".split()
    assert toxicity.context_score(at, 2) == toxicity.context_score("they wrote \"idiot\" home".split(), 2)


def test_terms_are_learned_from_every_run():
    rows = pa.RecordBatch.from_pydict({"toxic": [1, 0], "text": ["you/idiot $hit", "well"]})
    counts = {r["term"]: (r["toxic"], r["clean"]) for batch in toxicity._counted([rows]) for r in batch.to_pylist()}
    assert counts["idiot$"] == counts["you$"] == counts["$hit$"] == (1, 0) and counts["well$"] == (0, 1)


def test_context_separates_quotation_from_abuse():
    plain = toxicity.context_score("well the idiot came home".split(), 2)
    quoted = toxicity.context_score('they wrote "the idiot came" home'.split(), 3)
    abuse = toxicity.context_score("you are an idiot really".split(), 3)
    assert quoted < plain < abuse


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(8)
    words = ["thing", "house", "water", "idiom", "green", "stone"]
    rows, labels = [], []
    for i in range(1200):
        bad = i % 6 == 0
        text = rng.choices(words, k=30)
        if bad:
            text[rng.randrange(30)] = rng.choice(["idiot", "moron", "vequ" + rng.choice(["a", "b", "c", "d", "e"]), "idiott" if i % 12 else "idiot"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad) if i % 50 else None))
    rows += [(5000, None), (5001, ""), (5002, "thing " * 20000), (None, "idiot"), (5003, "moron"), (5003, "moron")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, score int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, marks).collect()}
    held = [r for i, r in got.items() if r.held_out and i is not None and i < 1200]
    assert len(held) > 200 and all(r.predicted == int(r.doc_id % 6 == 0) and 0 <= r.score <= 1 for r in held)
    assert got[5000].score == got[5001].score < 0.3 and got[5002].predicted == 0 and got[None].predicted == 1 and got[5003].predicted == 1
    assert toxicity.score(docs, marks).count() == len(rows)
    assert toxicity.score(docs.limit(0), marks).count() == 0
    assert {r.score for r in toxicity.score(docs, marks.limit(0)).collect()} == {toxicity.score(docs.limit(1), marks.limit(0)).first().score}


def plain_grade(word, words, stems):
    """The grade of a word by tables of edit distances over the whole lexicon, without automaton, trie or memory."""
    best = 0
    for term in toxicity.terms_of(word):
        own = 0
        for w in words:
            d = distance(term, w)
            own = max(own, 2 if d == 0 else 1 if d <= toxicity.edits_for(w) else 0)
        for s in stems:
            near = min(distance(term[:k], s) for k in range(len(term) + 1))
            own = max(own, 2 if term.startswith(s) else 1 if near <= max(0, toxicity.edits_for(s) - 1) else 0)
        if not own and any(c in "@$0123456789*!" for c in term):
            alike = lambda c, x: c == "*" or c == x or x in (toxicity.LOOKS.get(c) or c)
            plain = lambda t: sum(c not in toxicity.LOOKS for c in t)
            whole = any(len(w) == len(term) and all(map(alike, term, w)) and plain(term) >= max(2, len(w) / 2) for w in words)
            begun = any(len(s) <= len(term) and all(map(alike, term, s)) and plain(term[: len(s)]) >= max(2, len(s) / 2) for s in stems)
            own = int(whole or begun)
        best = max(best, own)
    return best


def test_scores_match_a_plain_scorer(spark):
    import math

    rng = random.Random(9)
    words, stems, weights = ["idiot", "dummkopf", "shit", "imbécile"], ["vequa", "stupid"], [-3.0, 2.5, 1.5, 0.7, 1.1]
    vocabulary = ["idiot", "idoit", "idiots", "dumkopf", "shit", "$hit", "sh1t", "imbecile", "imbéciles", "vequax", "veqa-x", "stupidly", "stu*id", "1d10t", "the", "a", "you", "said", '"the', 'end"', "«oui", "non»", "dinner.", "house,", "well...idiot", "x" * 40, "日本", "10th", "e-mail", "tu"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 12, 60]))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs, model=(words, stems, weights)).collect()}
    for k, text in enumerate(texts):
        split = text.split()
        sums = [0.0, 0.0, 0.0]
        for i, w in enumerate(split):
            if grade := plain_grade(w, words, stems):
                sums[grade] += toxicity.context_score(split, i)
        x = [1.0, math.log1p(sums[2]), math.log1p(sums[1]), min(1.0, 20 * (sums[1] + sums[2]) / max(1, len(split))), float(sums[2] > 0)]
        want = 1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, x, strict=True))))
        assert abs(got[k][0] - want) < 1e-9 and got[k][1] == int(want >= 0.3), text
