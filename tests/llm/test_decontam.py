import itertools
import math
import random

from regwatch.llm import decontam


def test_masks_hit_any_stretch_with_two_changes():
    for pair in itertools.combinations(range(13), 2):
        assert any(all(at + k not in pair for k, c in enumerate(m) if c == "1") for m in decontam.MASKS for at in range(13 - len(m) + 1))


def test_masks_hit_all_allowed_changes_of_each_length():
    for n in range(1, 31):
        width = min(n, decontam.WINDOW)
        changes = 0 if n < decontam.SHORT else width - math.ceil(decontam.AGREE * width)
        assert changes == (0 if n < 5 else 1 if n < 10 else 2)
        for changed in itertools.combinations(range(width), changes):
            assert any(all(at + k not in changed for k, c in enumerate(m) if c == "1") for m in decontam.masks_of(n) for at in range(width - len(m) + 1)), (n, changed)


def test_short_items_are_found_at_all_change_positions(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 14)}
    docs, want = [], set()
    for n, item in items.items():
        allowed = 0 if n < 5 else 1 if n < 10 else 2
        for count in range(allowed + 2):
            for changed in itertools.combinations(range(n), count):
                docs.append((len(docs), " ".join(["a", "b", *("x" if k in changed else w for k, w in enumerate(item)), "c", "d"])))
                if count <= allowed:
                    want.add((docs[-1][0], str(n)))
    docs.append((len(docs), "i1w0 a " * 500 + "i3w0 i3w1"))
    want.add((docs[-1][0], "1"))
    tests = spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id long, text string")
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), tests).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert {r.start for r in got} == {0, 2}


def brute(docs, items):
    out = set()
    for (d, text), (i, test) in itertools.product(docs, items):
        a, b = (text or "").lower().split(), (test or "").lower().split()
        if len(b) < decontam.LEAST_WORDS:
            continue
        for diagonal in range(-len(b), len(a)):
            flags = [0 <= k + diagonal < len(a) and a[k + diagonal] == w for k, w in enumerate(b)]
            width = len(b) if len(b) < decontam.SHORT else min(len(b), decontam.WINDOW)
            need = width if len(b) < decontam.SHORT else math.ceil(decontam.AGREE * width)
            if any(sum(flags[k : k + width]) >= need for k in range(len(b) - width + 1)):
                out.add((d, str(i)))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([3, 5, 7, 11, 12, 13, 20, 40, 40])] + [(90, None), (91, "")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(30)]
    for i in range(30, 150):
        passage = rng.choice(items[:9])[1].split()
        cut = passage[: rng.randrange(len(passage) // 2, len(passage) + 1)]
        cut = [w.upper() if rng.random() < 0.2 else "x" if rng.random() < rng.choice([0, 0.1, 0.25]) else w for w in cut]
        docs.append((i, " ".join(rng.choices(vocabulary, k=9) + cut + rng.choices(vocabulary, k=9))))
    docs += [(500, None), (501, ""), (502, items[7][1] + " y" * 3000), (None, items[6][1]), (503, items[8][1]), (503, items[8][1])]
    table = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, item_id string, n int")
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 40
    assert {(r.doc_id, r.item_id) for r in decontam.overlaps(table, tests).collect()} == want
    bad = {d for d, _ in want}
    got = decontam.report(table, tests).collect()
    assert len(got) == len(docs) and {r.doc_id for r in got if r.contaminated} == bad
    kept = decontam.drop_contaminated(table, tests)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in bad)
    assert decontam.report(table.limit(0), tests).count() == 0
    assert decontam.drop_contaminated(table, tests.limit(0)).count() == len(docs)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "x one two three four five six seven eight nine ten eleven twelve thirteen y", 7), (2, "clean", 8), (None, None, 9)], "doc_id int, text string, __id int")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {(2, "clean", 8), (None, None, 9)}


def test_items_without_an_id_and_with_a_shared_one(spark):
    first, second, third = (" ".join(f"{c}{k}" for k in range(20)) for c in "abc")
    benchmark = spark.createDataFrame([(None, first), ("x", second), ("x", third), ("x", third)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"so {first} on"), (2, f"{second} and {third}"), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.worst_item) for r in decontam.report(docs, benchmark).collect()}
    assert got == {1: (True, 1, None), 2: (True, 2, "x"), 3: (False, 0, None)}
    assert [r.doc_id for r in decontam.drop_contaminated(docs, benchmark).collect()] == [3]
