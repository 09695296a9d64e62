import hashlib
import re

from regwatch.llm import warc

PAGES = [
    (1, "http://a/1", '<!DOCTYPE html><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script><!-- x --><p>One &lt;two&gt;<br>three</p> <b>fo</b>ur'),
    (2, "http://a/2", None),
    (3, None, ""),
    (4, "http://a/4", "plain\r\n\r\nWARC/1.1\r\nx é " + "long " * 50000),
    (4, "http://a/4", "plain\r\n\r\nWARC/1.1\r\nx é " + "long " * 50000),
]


def pages(spark):
    return spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, block string")


def sha(x):
    return "sha256:" + hashlib.sha256(x.encode()).hexdigest()


def test_derivatives_are_linked(spark):
    sources = warc.responses(pages(spark)).collect()
    assert len(sources) == len(PAGES)
    made = warc.derive(warc.responses(pages(spark))).collect()
    assert len(made) == 2 * len(PAGES)
    by_source = {(r.refers_to, r.warc_type): r for r in made}
    for (_, url, html), s in zip(PAGES, sources, strict=True):
        assert re.fullmatch(r"urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}", s.record_id)
        assert s.payload_digest == sha(html or "") and s.block_digest == sha(s.block) and s.block.endswith("\r\n\r\n" + (html or ""))
        for kind in ("metadata", "conversion"):
            r = by_source[s.record_id, kind]
            assert (r.target_uri, r.warc_date, r.block_digest) == (url, s.warc_date, sha(r.block))
            assert r.headers == {"X-Source-Payload-Digest": s.payload_digest, "X-Source-Block-Digest": s.block_digest}
    first = sources[0].record_id
    assert by_source[first, "conversion"].block == "A & B\nOne <two>\nthree\nfour"
    assert by_source[first, "metadata"].block.startswith("http-status: 200\r\nhttp-header-content-type: text/html; charset=utf-8\r\n")
    assert "title: A &amp; B\r\n" in by_source[first, "metadata"].block


def test_files_round_trip(spark, tmp_path):
    records = warc.responses(pages(spark))
    records = records.unionByName(warc.derive(records))
    want = sorted(map(str, records.collect()))
    for compression in ("gzip", "none"):
        warc.write_records(records, str(tmp_path / compression), compression, 3)
        assert sorted(map(str, warc.read_records(spark, str(tmp_path / compression)).collect())) == want
    assert warc.derive(records.limit(0)).count() == 0
