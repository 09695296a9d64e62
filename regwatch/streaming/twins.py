"""Streaming twins (R1-R7): the same results as the batch operators, from files as they arrive. What a watermark has to close
comes out once rows of later dates have moved it; ``closing`` makes such rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from ..operators import cdc
from ..params import DEFAULT, Params


def _there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run(stream: DataFrame, checkpoint: str, batch, mode: str = "append", store: str | None = None) -> None:
    """Process all that is there in micro-batches, then stop. ``store`` is the provider of its state, if not the session's."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, store or before)
    try:
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)


def to_table(stream: DataFrame, checkpoint: str, path: str, mode: str = "update") -> None:
    """A streaming aggregate as a table of what each batch changed (update) or closed (append); ``latest`` reads it."""
    run(stream, checkpoint, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}"), mode)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Of a table that ``to_table`` has written the newest row of each key."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last")).select(*keys, "__last.*")


class _InOrder(StatefulProcessor):
    """Holds the rows of a key (date, fingerprint and the row as text) until the watermark has passed their dates, and then
    tells in the order of dates and fingerprints which of them are new or changed. What stays is the last fingerprint."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "fingerprint string")
        self.held = handle.getListState("held", "day date, fingerprint string, kept string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update((_plain(initialState["fingerprint"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            held = [(d, _plain(f), k) for d, f, k in zip(frame["day"], frame["fingerprint"], frame["kept"], strict=True) if not pd.isna(d)]
            if held:
                self.held.appendList(held)
                # One timer for all of them: at the first that goes off, all that the watermark has passed is due.
                self.handle.registerTimer(min(_millis(d) for d, _, _ in held))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        rows = list(self.held.get()) if self.held.exists() else []
        due = sorted((r for r in rows if _millis(r[0]) <= at), key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
        if not due:
            return iter(())
        known, out = self.last.exists(), []
        last = self.last.get()[0] if known else None
        for _, fingerprint, kept in due:
            if not known or fingerprint != last:
                out.append((kept, "field_changed" if known else "first_seen"))
            known, last = True, fingerprint
        self.last.update((last,))
        if rest := [tuple(r) for r in rows if _millis(r[0]) > at]:
            self.held.put(rest)
            self.handle.registerTimer(min(_millis(r[0]) for r in rest))
        else:
            self.held.clear()
        return iter([pd.DataFrame(out, columns=["kept", "change_type"])] if out else ())


def _plain(x):
    return None if pd.isna(x) else x


def _millis(day) -> int:
    """Midnight, UTC, of a date in milliseconds."""
    return (pd.Timestamp(day) - pd.Timestamp(0)) // pd.Timedelta(milliseconds=1)


def stream_change_log(stream: DataFrame, path: str, checkpoint: str, key: tuple = cdc.KEY, fp: str = "fingerprint", date: str = cdc.DATE, late: str = "3 days", stored: DataFrame | None = None) -> None:
    """Append to path/log the rows that are new or changed, in whatever order rows arrive within the delay.

    A row waits in state until the watermark (the latest date less the delay) has passed its date; then it is compared with
    the last fingerprint of its key. Rows still waiting come out once later dates arrive; rows later than the delay are
    dropped by Spark, and rows without a date never come out. ``stored`` (key and fingerprint, a row for each key) is where
    a log of an earlier time ended. A repeated batch writes the same.
    """
    # Keys and rows go through Python as text: a null among numbers would turn all of them into floating point there.
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    name, kept = F.to_json(F.struct(*key), exact).alias("key"), F.to_json(F.struct(*stream.columns), exact).alias("kept")
    mark = F.col(fp).cast("string").alias("fingerprint")
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # the store that typed state and timers need
    try:
        timed = stream.select(name, F.col(date).alias("day"), mark, kept, F.col(date).cast("timestamp").alias("at")).withWatermark("at", late).groupBy("key")
        start = stored.select(name, mark).groupBy("key") if stored is not None else None
        log = timed.transformWithStateInPandas(_InOrder(), "kept string, change_type string", "Append", "eventTime", start)
        log = log.select(F.from_json("kept", stream.schema, exact).alias("r"), "change_type").select("r.*", "change_type")
        run(log, checkpoint, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/log/batch={n}"))
    finally:
        spark.conf.set(PROVIDER, before)


def _folders(spark: SparkSession, base: str, parts: list[dict]) -> list[str]:
    """The folders of partitions below base that are there. Each is asked for by its name, so nothing is listed and the work
    is as large as what is asked."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name = lambda x: "__HIVE_DEFAULT_PARTITION__" if x is None else escape(str(x))
    paths = ["/".join([base, *(f"{k}={name(x)}" for k, x in part.items())]) for part in parts]
    return [p for p in dict.fromkeys(paths) if _there(spark, p)]


def _read(spark: SparkSession, base: str, parts: list[dict], schema: str) -> DataFrame:
    """Rows of some partitions below base, and of no other."""
    found = _folders(spark, base, parts)
    reader = spark.read.schema(schema)
    return reader.option("basePath", base).parquet(*found) if found else spark.createDataFrame([], schema)


def _run_list(df: DataFrame) -> list[tuple]:
    """Runs as (publisher, date), of one micro-batch."""
    return [tuple(r) for r in df.select("publisher", cdc.DATE).distinct().collect()]


def stream_change_events(stream: DataFrame, runs: DataFrame, path: str, checkpoint: str, fp: str = "fingerprint") -> None:
    """Write what ``read_change_events`` needs: the change log, from state, and the entities that a run no longer has.

    Keys of landed runs lie in folders of publisher, date and batch. A batch compares its runs, and those that follow them,
    with the run before, as the ledger of successful runs orders them. It opens the folders of these runs by name, so what
    it reads does not depend on how many batches or runs there were. Runs that are there already are written again alike.
    """
    numbered = cdc.ok_runs(runs)

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        keys = df.select(*cdc.KEY, cdc.DATE).distinct().persist()
        base = f"{path}/landed"
        schema = f"entity_id {df.schema['entity_id'].dataType.simpleString()}, publisher string, {cdc.DATE} date, batch long"
        keys.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("publisher", cdc.DATE, "batch").parquet(base)
        here = keys.select("publisher", cdc.DATE).distinct()
        after = here.withColumnRenamed(cdc.DATE, "previous_date")
        asked = numbered.join(here, ["publisher", cdc.DATE], "left_semi").unionByName(numbered.join(after, ["publisher", "previous_date"], "left_semi")).distinct()
        asked = asked.where("previous_date is not null").select("publisher", cdc.DATE, "previous_date")
        pairs = [tuple(r) for r in asked.collect()]
        run = lambda publisher, day: {"publisher": publisher, cdc.DATE: day}
        pairs = [x for x in pairs if _folders(spark, base, [run(x[0], x[1])])]
        landed = _read(spark, base, [run(p, d) for p, *days in pairs for d in days], schema)
        now = spark.createDataFrame(pairs, f"publisher string, {cdc.DATE} date, previous_date date")
        before = landed.select("publisher", "entity_id", F.col(cdc.DATE).alias("previous_date")).distinct().join(F.broadcast(now), ["publisher", "previous_date"])
        gone = before.join(landed.select(*cdc.KEY, cdc.DATE), [*cdc.KEY, cdc.DATE], "left_anti")
        cdc.write_run_events(gone.select("entity_id", F.lit("DELETE").alias("event_type"), "publisher", cdc.DATE), f"{path}/deletes")
        keys.unpersist()

    run(stream, f"{checkpoint}/landed", batch)
    stream_change_log(stream, path, f"{checkpoint}/log", fp=fp)


def read_change_events(spark: SparkSession, runs: DataFrame, path: str) -> DataFrame:
    """The events of the runs that ``stream_change_events`` has met (publisher, date, entity_id, event_type)."""
    log = spark.read.parquet(f"{path}/log").join(cdc.ok_runs(runs).select("publisher", cdc.DATE, "run_no"), ["publisher", cdc.DATE])
    kind = F.when(F.col("change_type") == "first_seen", "INSERT").otherwise("UPDATE").alias("event_type")
    changes = log.where("change_type = 'field_changed' or run_no > 1").select("publisher", cdc.DATE, "entity_id", kind)
    deletes = spark.read.schema(f"entity_id {log.schema['entity_id'].dataType.simpleString()}, event_type string, publisher string, {cdc.DATE} date").parquet(f"{path}/deletes")
    return changes.unionByName(deletes)


def windowed_inserts(stream: DataFrame, ts: str = "ts", length: str = "28 days", slide: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows of sliding windows, by publisher."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, length, slide).alias("w"), "publisher").agg(F.count("*").alias("n"))


def late_evidence(events: DataFrame, evidence: DataFrame, p: Params = DEFAULT, late: str = "2 days") -> DataFrame:
    """Events (insert_date) with evidence (evidence_date) that comes within the recheck window after them. Either may be
    a stream: the window bounds what is kept of both, so evidence that comes batches later still meets its event."""
    left = events.withColumn("__at", F.col("insert_date").cast("timestamp")).withWatermark("__at", late)
    right = evidence.withColumnRenamed("entity_id", "__id").withColumn("__seen", F.col("evidence_date").cast("timestamp")).withWatermark("__seen", late)
    near = (F.col("entity_id") == F.col("__id")) & (F.col("__seen") >= F.col("__at")) & (F.col("__seen") <= F.col("__at") + F.expr(f"interval {p.recheck_days} days"))
    return left.join(right, near).drop("__at", "__id", "__seen")


def freshness_lag(stream: DataFrame) -> DataFrame:
    """The latest extract date of each publisher."""
    return stream.groupBy("publisher").agg(F.max("extract_date").alias("extract_date"))


def finished_runs(spark: SparkSession, path: str, by: str, days: list, schema: str) -> DataFrame:
    """Runs of some days that a table holds, with the batch that wrote them, out of the folders of these days alone."""
    return _read(spark, f"{path}-runs", [{by: day} for day in days], f"{schema}, batch long")


def idempotent_sink(path: str, keys: list[str], by: str | None = None):
    """A foreachBatch function that writes only runs that the table does not have yet.

    Beside the table lies a ledger of its runs, in folders of their day (``by``, one of the keys) and batch. A batch reads
    the folders of its own days, writes its rows and then its part of the ledger; a batch that is repeated after a loss
    passes over its own entries and writes both again. Without ``by`` the day is the collection date, or the last key.
    """
    by = by or (cdc.DATE if cdc.DATE in keys else keys[-1])
    if by not in keys:
        raise ValueError(f"{by} is none of the keys {keys}")

    def batch(df: DataFrame, number: int) -> None:
        spark, df = df.sparkSession, df.persist()
        kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
        days = [r[0] for r in df.select(by).distinct().collect()]
        have = finished_runs(spark, path, by, days, kinds).where(F.col("batch") != number).select(*keys).distinct()
        new = df.join(have, keys, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={number}")
        runs = new.select(*keys).distinct().withColumn("batch", F.lit(number).cast("long"))
        runs.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, "batch").parquet(f"{path}-runs")
        df.unpersist()

    return batch


def session_gaps(stream: DataFrame, ts: str = "ts", gap: str = "36 hours", late: str = "2 days") -> DataFrame:
    """Spells of activity of each publisher without a pause as long as the gap, each once the watermark has closed it."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), "publisher").agg(F.count("*").alias("n"))


def closing(stream_schema: StructType, spark: SparkSession, last, days: int = 30, date: str = cdc.DATE) -> DataFrame:
    """A row of nothing but a date some time after the last one: landed after all others, it lets the watermark pass them.
    It stays in state itself and never comes out."""
    value = {f.name: None for f in stream_schema.fields} | {date: last + dt.timedelta(days=days)}
    return spark.createDataFrame([tuple(value[f.name] for f in stream_schema.fields)], StructType([StructField(f.name, f.dataType, True) for f in stream_schema.fields]))


def files(spark: SparkSession, path: str, schema, most: int | None = None) -> DataFrame:
    """A stream of the parquet files that match a path."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", most) if most else reader).parquet(path)


