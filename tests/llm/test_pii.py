import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from regwatch.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def ok(kind, span):
    digits = re.sub("[^0-9]", "", span)
    return {"email": True, "ip": all(int(p) <= 255 for p in span.split(".")) if kind == "ip" else 0, "card": 12 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], text or "") if ok(kind, m[0])]
    return [sum(x[1] == k for x in found) for k in range(4)], hashlib.sha256(",".join(x[2] for x in sorted(found)).encode()).hexdigest()


def test_base_spans_match_brute_force(spark):
    rng = random.Random(3)
    bits = ["a@b.com", "_x@d.e", "1.2.3.4", ".5", "256.1.1.1", "4539 1488 0343 6467", "-4539148803436467", "+1 (555) 123-4567", "é", " ", "😀", "@", "+", "0012", "a.b", "%", "-", "12", ".", "x", "DE89370400440532013000", "\n"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(1, 14)))) for i in range(1500)]
    rows += [(9000, None), (9001, ""), (9002, "a" * 3000), (9003, "1.1" * 900), (9004, "a.b" * 300 + "@" + "c." * 5000 + "d"), (None, "q@w.de"), (9005, "a@b.com_x@d.e"), (9005, "a@b.com_x@d.e")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, kind int, spans string")
    got = pii.find_spans(docs).collect()
    assert len(got) == len(rows)
    for (doc_id, text), r in zip(rows, got, strict=True):
        counts, sha = brute(text)
        assert (r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == (doc_id, counts, sha), text[:200]
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_addresses_with_zero_parts_match_brute_force(spark):
    texts = ["10.0.0.1", "0.0.0.0", "000.1.1.1", "255.255.255.0", "at 192.168.0.1, and 100.20.00.0255", "0.0.0.256", "00.0.0.1000", "1.0.0", "8.8.8.8", "260.0.0.0", "0.199.200.249", "0300.0.0.1"]
    rng = random.Random(4)
    texts += [".".join(rng.choice(["0", "00", "1", "9", "010", "99", "100", "199", "249", "255", "256", "0256", "300"]) for _ in range(4)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for text, r in zip(texts, pii.find_spans(docs).collect(), strict=True):
        counts, sha = brute(text)
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == (counts, sha), text
    assert [r.text for r in pii.redact(docs.where("doc_id < 2")).collect()] == ["[ip]", "[ip]"]


def test_checksums_and_context(spark):
    one = spark.createDataFrame([("DE89370400440532013000", "4539148803436467"), ("DE89370400440532013001", "4539148803436468")], "a string, b string")
    assert [tuple(r) for r in one.select(pii.mod97(F.col("a")), pii.luhn(F.col("b"))).collect()] == [(True, True), (False, False)]
    docs = spark.createDataFrame([(1, "my bank: DE89370400440532013000"), (2, "say: DE89370400440532013000"), (3, "DE89370400440532013001")], "doc_id long, text string")
    assert [(r.n_iban, r.scores) for r in pii.find_spans(docs).collect()] == [(1, "1.00"), (1, "0.80"), (0, "")]
    assert [r.text for r in pii.redact(docs).collect()] == ["my bank: [iban]", "say: [iban]", "DE89370400440532013001"]


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "to a@b.com", 2, 3, 4, 5)], "doc_id long, text string, __text int, __email int, spans int, pii_spans int")
    got = pii.redact(docs)
    assert got.columns == docs.columns and tuple(got.first()) == (1, "to [email]", 2, 3, 4, 5)
    assert [c for c in pii.with_spans(docs).columns if c != "pii_spans"] == [c for c in docs.columns if c != "pii_spans"]


def bodies(plan):
    """What stands inside the lambdas of a plan."""
    for m in re.finditer(r"lambdafunction\(", plan):
        depth, k = 1, m.end()
        while depth and k < len(plan):
            depth += {"(": 1, ")": -1}.get(plan[k], 0)
            k += 1
        yield plan[m.end() : k]


def test_plan_has_no_python_no_shuffle_and_no_split_in_a_lambda(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for made in (pii.find_spans(docs), pii.redact(docs)):
        query = made._jdf.queryExecution()
        assert not re.search("Python|Pandas|Arrow|Exchange", query.toString())
        inside = list(bodies(query.optimizedPlan().toString()))
        assert inside and not any(re.search(r"split\(|regexp_extract_all\(|flatten\(", x) for x in inside)


def test_dense_spans_take_time_in_proportion(spark):
    text = "mail ab@cd.com now " * 50_000
    docs = spark.createDataFrame([(1, text), (2, "+1 (555) 123-4567, é 1.2.3.4 " * 700)], "doc_id long, text string")
    began = time.time()
    a, b = pii.find_spans(docs).collect()
    assert (a.n_email, b.n_phone, b.n_ip) == (50_000, 700, 700) and time.time() - began < 60
    for r, whole in ((a, text), (b, docs.where("doc_id = 2").first().text)):
        counts, sha = brute(whole)
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == (counts, sha)
    began = time.time()
    assert pii.redact(docs).first().text == "mail [email] now " * 50_000 and time.time() - began < 60


def test_scores_and_redaction_match_brute_force(spark):
    rng = random.Random(8)
    bits = ["mail ", "a@b.com", " 1.2.3.4 ", "Server", "+1 (555) 123-4567", "tel", "é", " ", "😀 ", "x" * 37, "4539148803436467 ", "DE89370400440532013000 ", "bank"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, redacted = pii.find_spans(docs).collect(), pii.redact(docs).collect()
    for text, r, q in zip(texts, found, redacted, strict=True):
        at, out = 0, ""
        for span, score in zip(filter(None, r.spans.split(",")), r.scores.split(","), strict=bool(r.spans)):
            kind, start, end = span.split(":")[0], *map(int, span.split(":")[1:])
            low = max(0, start - pii.REACH)
            near = text[low : low + end - start + 2 * pii.REACH].lower()
            assert float(score) == round(pii.SCORES[kind] + (pii.BONUS if re.search(rf"\b(?:{pii.CONTEXT[kind]})", near) else 0), 2)
            out += f"{text[at:start]}[{kind}]" if start >= at else ""
            at = max(at, end)
        assert q.text == out + text[at:]
