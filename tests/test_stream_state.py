"""Where the state of joined streams lies."""

import glob

from pyspark.sql import functions as F

from regwatch.plans import io_queries
from regwatch.plans.fixtures import view
from regwatch.streaming import twins


def test_rows_that_wait_for_evidence_lie_in_rocksdb(spark, monkeypatch):
    paths, before, run = [], spark.conf.get(twins.PROVIDER), twins.run
    monkeypatch.setattr(twins, "run", lambda stream, checkpoint, *a, **k: (paths.append(checkpoint), run(stream, checkpoint, *a, **k)))
    got = io_queries.r4_late_evidence_recheck(lambda name: view(spark, "/root/testdata/sf0.001", name))
    assert got.count() == view(spark, "/root/testdata/sf0.001", "inserts").where(F.expr("entity_id % 180 <= 90")).count() > 0
    files = [f for p in paths for f in glob.glob(f"{p.removeprefix('file:')}/state/**/*", recursive=True)]
    assert any(f.endswith((".zip", ".changelog")) for f in files) and not any(f.endswith(".delta") for f in files)
    assert spark.conf.get(twins.PROVIDER) == before
