"""Daily processing of pending runs against a store on shared storage.

The store holds, in folders of their own: ``ledger`` (what became of each run, newest write wins), ``state`` (versions of the
last fingerprint and day of every entity, by publisher), ``log`` and ``events`` (by publisher and date). A day's runs are
compared with the stored state alone, so the work of a day does not grow with the archive. The ledger is written last: what a
lost driver leaves behind without its ledger row is written again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cdc import DATE, KEY, incremental_runs, write_run_events

LEDGER = f"publisher string, {DATE} date, status string, reason string, rows long, version long, written timestamp"
Run = tuple[str, dt.date]


def _folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """The newest entry of every run that was ever tried."""
    if not _folder(spark, f"{store}/ledger"):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(f"{store}/ledger")
    newest = Window.partitionBy("publisher", DATE).orderBy(F.desc("version"), F.desc("written"))
    return rows.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def _pruned(spark: SparkSession, base: str, schema: str, parts: list[str]) -> DataFrame:
    found = [p for p in (f"{base}/{x}" for x in parts) if _folder(spark, p)]
    return spark.read.schema(schema).option("basePath", base).parquet(*found) if found else spark.createDataFrame([], schema)


def stored_state(spark: SparkSession, store: str, versions: dict[str, int], kind: str = "long") -> DataFrame:
    """publisher, entity_id, fingerprint and last_seen of the publishers, each as of a version of the state."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = [f"version={v}/publisher={escape(p)}" for p, v in versions.items()]
    return _pruned(spark, f"{store}/state", f"entity_id {kind}, fingerprint string, last_seen date, version long, publisher string", parts).drop("version")


def _before(ledger: DataFrame, day: dt.date, publishers: list[str]) -> dict[str, tuple[dt.date, int]]:
    """The last successful run of each publisher before a day, and the version of the state that it left."""
    rows = ledger.where((F.col("status") == "ok") & (F.col(DATE) < F.lit(day)) & F.col("publisher").isin(publishers))
    return {r.publisher: (r.x[DATE], r.x["version"]) for r in rows.groupBy("publisher").agg(F.max(F.struct(DATE, "version")).alias("x")).collect()}


def compare(snapshot: DataFrame, state: DataFrame, previous: DataFrame, day: dt.date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A day's rows against the stored state: change log, events, and the state after it.

    snapshot: publisher, entity_id, fingerprint; previous: publisher and the day of its last successful run (none: the first
    run, which emits nothing). An entity that was seen in that run and is not here is deleted; one that comes back is an
    UPDATE if it changed. Of rows that repeat an entity the least and the greatest fingerprint count, as the first and the
    last of the day.
    """
    one = snapshot.groupBy(*KEY).agg(F.min("fingerprint").alias("first"), F.max("fingerprint").alias("last"))
    both = one.join(state, list(KEY), "full").join(F.broadcast(previous), "publisher", "left")
    here, known = F.col("last").isNotNull(), F.col("fingerprint").isNotNull()
    changed = here & known & ((F.col("first") != F.col("fingerprint")) | (F.col("last") != F.col("first")))
    kind = F.when(here & ~known, "first_seen").when(changed, "field_changed")
    run = F.lit(day).alias(DATE)
    log = both.select(*KEY, kind.alias("change_type"), F.col("last").alias("fingerprint"), run).where("change_type is not null")
    event = F.when(F.col("previous").isNotNull() & here & ~known, "INSERT").when(changed, "UPDATE").when(~here & (F.col("last_seen") == F.col("previous")), "DELETE")
    events = both.select("entity_id", event.alias("event_type"), "publisher", run).where("event_type is not null")
    after = both.select(*KEY, F.coalesce("last", "fingerprint").alias("fingerprint"), F.when(here, F.lit(day)).otherwise(F.col("last_seen")).alias("last_seen"))
    return log, events, after


def incremental_run(spark: SparkSession, store: str, landed: DataFrame, snapshot_of: Callable[[list[Run]], DataFrame], force: bool = False, kind: str = "long") -> DataFrame:
    """Process the landed runs that are not done yet (all if forced), day by day, and return their ledger rows.

    landed: publisher and collection_date; snapshot_of gives the rows (publisher, entity_id, fingerprint) of some runs of
    one day, and may fail. All runs of a day go through one job. If it fails the runs are halved until those that fail stand
    alone; they become rows ``failed`` of the ledger with the reason, and the others are done. A run that failed is tried
    again the next time. A forced run is compared with the state before its day; later days are not done again by it.
    """
    ledger = read_ledger(spark, store)
    pending: dict[dt.date, list[str]] = {}
    for r in incremental_runs(ledger, landed, force).collect():
        pending.setdefault(r[DATE], []).append(r.publisher)
    version = 1 + (ledger.agg(F.max("version")).first()[0] or 0)
    done: list[tuple] = []

    def attempt(day: dt.date, publishers: list[str], version: int) -> int:
        """Ledger rows of these runs; the next free version."""
        try:
            before = _before(read_ledger(spark, store), day, publishers)
            snapshot = snapshot_of([(p, day) for p in publishers]).select(*KEY, "fingerprint").persist()
            try:
                counts = {r.publisher: r["count"] for r in snapshot.groupBy("publisher").count().collect()}
                state = stored_state(spark, store, {p: v for p, (_, v) in before.items()}, kind)
                previous = spark.createDataFrame([(p, d) for p, (d, _) in before.items()], "publisher string, previous date")
                log, events, after = compare(snapshot, state, previous, day)
                write_run_events(log, f"{store}/log")
                write_run_events(events, f"{store}/events")
                after.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "publisher").parquet(f"{store}/state")
            finally:
                snapshot.unpersist()
            rows = [(p, day, "ok", None, counts.get(p, 0), version) for p in publishers]
        except Exception as e:
            if len(publishers) > 1:
                half = len(publishers) // 2
                return attempt(day, publishers[half:], attempt(day, publishers[:half], version))
            rows = [(publishers[0], day, "failed", f"{type(e).__name__}: {e}".splitlines()[0][:500], None, version)]
        now = dt.datetime.now(dt.timezone.utc)
        spark.createDataFrame([(*r, now) for r in rows], LEDGER).coalesce(1).write.mode("append").parquet(f"{store}/ledger")
        done.extend(rows)
        return version + 1

    for day in sorted(pending):
        version = attempt(day, sorted(pending[day]), version)
    return spark.createDataFrame([r[:5] for r in done], f"publisher string, {DATE} date, status string, reason string, rows long")


def bootstrap(spark: SparkSession, store: str, snapshots: DataFrame, runs: DataFrame) -> None:
    """Fill a new store from an archive in one job: the state as of the last successful run of each publisher."""
    after = snapshots.groupBy(*KEY).agg(F.max_by("fingerprint", F.struct(DATE, "fingerprint")).alias("fingerprint"), F.max(DATE).alias("last_seen"))
    after.withColumn("version", F.lit(1).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "publisher").parquet(f"{store}/state")
    rows = runs.where("status = 'ok'").select("publisher", DATE, "status", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("long").alias("rows"), F.lit(1).cast("long").alias("version"), F.current_timestamp().alias("written"))
    rows.write.mode("append").parquet(f"{store}/ledger")
