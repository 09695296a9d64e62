import random
import re

import corpus_pipeline


def test_stages_match_brute_force(spark, tmp_path):
    rng = random.Random(20)
    en, fr = ["the", "of", "and", "thing", "with", "that"], ["le", "des", "où", "garçon", "que", "être"]
    word = lambda lang: rng.choice(lang) + rng.choice(["", "x", "y", "zu"]) + rng.choice(lang)
    rows = [(i, " ".join(word(lang) for _ in range(rng.randrange(20, 200))), name) for i, (lang, name) in enumerate(rng.choices([(en, "en"), (fr, "fr")], k=120))]
    test = " ".join(word(en) for _ in range(30))
    rows += [(200 + i, t.replace(" ", "  ", 2), lang) for i, (_, t, lang) in enumerate(rows[:20])]  # copies but for white space; longer
    rows += [(300 + i, t.rsplit(" ", 1)[0], lang) for i, (_, t, lang) in enumerate(rows[20:40])]  # near copies
    rows += [(400 + i, f"{t} {test} {t[::-1]}", lang) for i, (_, t, lang) in enumerate(rows[40:50])]  # leaks
    rows += [(500, None, "en"), (501, "", "en"), (502, "12 34", "en")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, test)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns, name
    want = {d for d, t, _ in rows if d < 120 and d not in range(20)} | set(range(200, 220))
    sets = {d: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for d, t, _ in rows if t}
    want |= {300 + i for i in range(20) if len(sets[300 + i] & sets[20 + i]) * 5 < 4 * len(sets[300 + i] | sets[20 + i])}
    assert {r.doc_id for r in left.collect()} == want
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == want and {r.piece for r in out} == {0}
    assert all(re.fullmatch(r"\d+", str(r.sequence_id)) for r in out)


def test_stages_take_odd_rows(spark, tmp_path):
    text = "the thing of that and with " * 40
    rows = [(1, text, "en", 1, 2, 3), (1, text, "en", 1, 2, 3), (2, text + "x", "en", 1, 2, 3), (None, "le des que où être garçon", "fr", 1, 2, 3), (3, None, "fr", 1, 2, 3), (4, "le que " * 30000, "fr", None, None, None), (5, "", None, 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __id int, __digest int, __own int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "of no document at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns, name
    kept = [r.doc_id for r in left.collect()]
    assert sorted(map(str, kept)) == ["1", "4", "None"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, 4, None}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
