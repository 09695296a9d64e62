"""Mail reports of many records."""

import gzip
import tracemalloc

from regwatch.sources import readers

RECORD = "<record><row><source_ip>10.0.0.%d</source_ip><count>2</count></row></record>"


def test_a_report_of_many_records_is_not_held_whole(spark, tmp_path):
    n = 40_000
    head = "<report_metadata><org_name>late</org_name><date_range><begin>86400</begin></date_range></report_metadata>"
    # What holds for all records of the first report stands behind them.
    xml = "<reports><feedback>" + "".join(RECORD % (k % 9) for k in range(n)) + head + "</feedback><other/><feedback>" + RECORD % 77 + "</feedback></reports>"
    raw = gzip.compress(xml.encode())
    tracemalloc.start()
    try:
        rows, last = 0, None
        for last in readers._records("a.xml.gz", raw):
            rows += last["reporter"] == "late"
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (rows, last["reporter"], last["source_ip"]) == (n, "?", "10.0.0.77")
    assert peak < 8_000_000
    (tmp_path / "a.xml.gz").write_bytes(raw)
    (tmp_path / "cut.xml").write_bytes(xml.encode()[:-9])
    got = readers.read_auth_reports(spark, str(tmp_path))
    assert readers.auth_records(got).groupBy("file").count().collect() == [("a.xml.gz", n + 1)]
    assert [r.file for r in readers.auth_failures(got).collect()] == ["cut.xml"]
