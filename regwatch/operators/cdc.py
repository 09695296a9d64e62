"""Change capture from full snapshots.

A snapshot row has a key (by default publisher and entity_id) and a collection_date; a run is one publisher's snapshot
of one date and stands in the ledger even if it has no rows. Rows are ordered by date within a key by window functions,
so one plan replays any number of days, and nothing but the key is shuffled. A key that repeats in one run counts once
where it repeats with the same fingerprint; rows that differ follow each other in the order of their fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY, DATE = ("publisher", "entity_id"), "collection_date"


def fingerprint(cols: list[str]) -> Column:
    """SHA-256 of the columns as a JSON array, in which null differs from empty."""
    return F.sha2(F.to_json(F.array(*(F.col(c).cast("string") for c in cols))), 256)


def row_fingerprint(df: DataFrame, cols: list[str], name: str = "fingerprint") -> DataFrame:
    return df.withColumn(name, fingerprint(cols))


def company_fingerprint(df: DataFrame, cols: list[str], codes: str = "sic_codes", name: str = "fingerprint") -> DataFrame:
    """As row_fingerprint, with the sorted codes; key and source are to be left out of cols."""
    return df.withColumn(name, F.sha2(F.to_json(F.array(*(F.col(c).cast("string") for c in cols), F.to_json(F.array_sort(codes)))), 256))


def _in_order(key: tuple, fp: str, date: str) -> WindowSpec:
    return Window.partitionBy(*key).orderBy(date, fp)


def _kind(fp: str, w: WindowSpec) -> Column:
    """first_seen, field_changed or null of a row, by the row before it of its key."""
    return F.when(F.row_number().over(w) == 1, "first_seen").when(~F.col(fp).eqNullSafe(F.lag(fp).over(w)), "field_changed")


def change_log(snapshots: DataFrame, key: tuple = KEY, fp: str = "fingerprint", date: str = DATE) -> DataFrame:
    """Rows that are new (first_seen) or whose fingerprint differs from the one before (field_changed)."""
    return snapshots.withColumn("change_type", _kind(fp, _in_order(key, fp, date))).where("change_type is not null")


def current_state(snapshots: DataFrame, key: tuple = KEY, fp: str = "fingerprint", date: str = DATE) -> DataFrame:
    """The latest row of each key, with first_seen_date, last_seen_date and last_changed_date. Of rows of one date the one
    of the greatest fingerprint counts, and of those the one of the greatest hash."""
    changed = F.when(_kind(fp, _in_order(key, fp, date)).isNotNull(), F.col(date))
    rest = [c for c in snapshots.columns if c not in (*key, date)]
    one = snapshots.withColumn("__changed", changed).groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.struct(date, fp, F.xxhash64(*rest))).alias("__last"), F.min(date).alias("first_seen_date"), F.max(date).alias("last_seen_date"), F.max("__changed").alias("last_changed_date")
    )
    return one.select(*key, "__last.*", "first_seen_date", "last_seen_date", "last_changed_date")


def company_current(snapshots: DataFrame, key: tuple = ("company_number",), fp: str = "fingerprint", date: str = DATE) -> DataFrame:
    """As current_state, but values (source among them) stay those of the last real change."""
    log = change_log(snapshots, key, fp, date)
    rest = [c for c in log.columns if c not in (*key, date, "change_type")]
    last = log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(date, fp, F.xxhash64(*rest))).alias("__last"), F.max(date).alias("last_changed_date"))
    seen = snapshots.groupBy(*key).agg(F.min(date).alias("first_seen_date"), F.max(date).alias("last_seen_date"))
    return last.join(seen, list(key)).select(*key, "__last.*", "first_seen_date", "last_seen_date", "last_changed_date")


def ingest_stats(snapshots: DataFrame, key: tuple = KEY, fp: str = "fingerprint", date: str = DATE) -> DataFrame:
    """Rows of each run that are new, changed and unchanged."""
    kind = F.coalesce(_kind(fp, _in_order(key, fp, date)), F.lit("unchanged"))
    count = lambda k, name: F.count_if(F.col("__kind") == k).alias(name)
    return snapshots.withColumn("__kind", kind).groupBy("publisher", date).agg(count("first_seen", "first_seen"), count("field_changed", "changed"), count("unchanged", "unchanged"))


def ok_runs(runs: DataFrame) -> DataFrame:
    """Runs that succeeded, numbered within their publisher, with the dates before and after."""
    w = Window.partitionBy("publisher").orderBy(DATE)
    rows = runs.where("status = 'ok'").select("publisher", DATE).distinct()
    return rows.select("publisher", DATE, F.row_number().over(w).alias("run_no"), F.lag(DATE).over(w).alias("previous_date"), F.lead(DATE).over(w).alias("next_date"))


def previous_run(runs: DataFrame) -> DataFrame:
    """For each run the latest earlier date that succeeded; failed days are skipped."""
    w = Window.partitionBy("publisher").orderBy(DATE).rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("publisher", DATE, F.max(F.when(F.col("status") == "ok", F.col(DATE))).over(w).alias("previous_date"))


def change_events(snapshots: DataFrame, runs: DataFrame, fp: str = "fingerprint", permanent_only: bool = False) -> DataFrame:
    """INSERT, UPDATE and DELETE of each run (publisher, collection_date, entity_id, event_type).

    A publisher's first run emits nothing. DELETE compares with the run before; it belongs to the first successful run
    that misses the entity. ``permanent_only`` leaves out absences that ended, as a replay of the archive does. The row
    before and the row after come from one window, so the snapshots are shuffled once.
    """
    rows = snapshots.select(*KEY, DATE, fp).join(ok_runs(runs).select("publisher", DATE, "run_no", "next_date"), ["publisher", DATE])
    w = _in_order(KEY, fp, DATE)
    rows = rows.select(*KEY, DATE, "run_no", "next_date", _kind(fp, w).alias("kind"), F.lead("run_no").over(w).alias("after"))
    now = F.when(F.col("kind") == "field_changed", "UPDATE").when((F.col("kind") == "first_seen") & (F.col("run_no") > 1), "INSERT")
    # A repeated row is followed by one of the same run: only the last of them can be the entity's last.
    gone = F.col("after").isNull() if permanent_only else F.col("after").isNull() | (F.col("after") > F.col("run_no") + 1)
    then = F.when(gone & F.col("next_date").isNotNull(), "DELETE")
    both = F.array(F.struct(F.col(DATE).alias("date"), now.alias("kind")), F.struct(F.col("next_date").alias("date"), then.alias("kind")))
    out = rows.select(*KEY, F.explode(F.filter(both, lambda e: e["kind"].isNotNull())).alias("e"))
    return out.select("publisher", F.col("e.date").alias(DATE), "entity_id", F.col("e.kind").alias("event_type"))


def diff_runs(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Counts of each successful run's events, with the date it was compared with; runs without events have zeros."""
    count = lambda kind: F.count_if(F.col("event_type") == kind).alias(f"{kind.lower()}_count")
    sums = events.groupBy("publisher", DATE).agg(*(count(k) for k in ("INSERT", "UPDATE", "DELETE")))
    rows = ok_runs(runs).select("publisher", DATE, F.col("previous_date").alias("previous_collection_date")).join(sums, ["publisher", DATE], "left")
    return rows.na.fill(0, ["insert_count", "update_count", "delete_count"])


def replace_run_events(store: DataFrame, new: DataFrame) -> DataFrame:
    """The stored events with those of the runs in ``new`` replaced."""
    return store.join(new.select("publisher", DATE).distinct(), ["publisher", DATE], "left_anti").unionByName(new)


def write_run_events(new: DataFrame, path: str) -> None:
    """Overwrite just the partitions (publisher, date) that ``new`` has; a rerun leaves one copy."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("publisher", DATE).parquet(path)


def replay(snapshots: DataFrame, runs: DataFrame, fp: str = "fingerprint") -> DataFrame:
    """The run counts that a rebuild from the whole archive gives."""
    return diff_runs(change_events(snapshots, runs, fp, permanent_only=True), runs)


def incremental_runs(ledger: DataFrame, landed: DataFrame, force: bool = False) -> DataFrame:
    """Landed runs still to do: those without a successful ledger row, or all if forced."""
    rows = landed.select("publisher", DATE).distinct()
    return rows if force else rows.join(ledger.where("status = 'ok'"), ["publisher", DATE], "left_anti")


def publishers_scd(seen: DataFrame, key: str = "publisher", date: str = DATE) -> DataFrame:
    """Publisher dimension: latest attributes, first and last date seen."""
    rest = [c for c in seen.columns if c not in (key, date)]
    rows = seen.groupBy(key).agg(F.max_by(F.struct(*rest), date).alias("__last"), F.min(date).alias("first_seen_date"), F.max(date).alias("last_seen_date"))
    return rows.select(key, "__last.*", "first_seen_date", "last_seen_date")


def upsert_runs(ledger: DataFrame, new: DataFrame, written: str = "parsed_at") -> DataFrame:
    """One row for each (publisher, date), the newest write; ``new`` wins a tie."""
    both = ledger.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    w = Window.partitionBy("publisher", DATE).orderBy(F.desc(written), F.desc("__new"))
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__new")
