"""Structured Streaming jobs.

Each job is a function that *defines and starts* a streaming query and
returns the ``StreamingQuery``; sinks are Parquet folders with their own
checkpoint location, so a restarted job resumes exactly where it stopped.
Event times load as ``timestamp_ntz``; they are cast to ``timestamp`` (UTC
session) before a watermark, which requires the zoned type.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cartwheel.functions.exprs import ntz_from_utc, utc_instant, utc_micros

WATERMARK_DELAY = "10 minutes"


STAGED_ROWS = 5_000_000


def stage_files(df: DataFrame, path: str, partition_by: str | None = None, files: int | None = None) -> str:
    """Land a batch DataFrame as Parquet files a stream can pick up; partitioned, as a file a value up to ``STAGED_ROWS`` rows,
    so a stream that takes some files at a time does not get more and smaller batches from more input tasks."""
    df = df.repartition(files) if files else df.repartition(partition_by) if partition_by else df
    w = df.write.mode("overwrite").option("maxRecordsPerFile", STAGED_ROWS)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def with_event_time(df: DataFrame, col: str = "action_time", out: str = "event_time") -> DataFrame:
    """Zoned event time for watermarks: the wall time read as UTC, whatever the session zone."""
    return df.withColumn(out, utc_instant(col))


def _start(df: DataFrame, sink: str | None, checkpoint: str, mode: str = "append", available_now: bool = True,
           partition_by: str | None = None) -> StreamingQuery:
    """``sink`` None: no output is kept (the job's state is read instead)."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.format("parquet").option("path", sink) if sink else w.format("noop")
    if partition_by:
        w = w.partitionBy(partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# ---------------------------------------------------------------- W5 / K8
def append_log(actions: DataFrame, sink: str, checkpoint: str, **kw) -> StreamingQuery:
    """Append every incoming action to the full history, partitioned by date."""
    out = actions.withColumn("dt", F.to_date("action_time"))
    return _start(out, sink, checkpoint, "append", partition_by="dt", **kw)


# ---------------------------------------------------------------- W1
def window_counts(actions: DataFrame, sink: str, checkpoint: str, size: str = "2 hours",
                  delay: str = WATERMARK_DELAY, **kw) -> StreamingQuery:
    """Actions per tumbling event-time window; a window is emitted once the
    watermark (max event time − delay) passes its end (append mode)."""
    ev = with_event_time(actions).withWatermark("event_time", delay)
    agg = (ev.groupBy(F.window("event_time", size).alias("w"))
           .agg(F.count(F.lit(1)).alias("n")))
    out = agg.select(ntz_from_utc("w.start").alias("window_start"), ntz_from_utc("w.end").alias("window_end"), "n")
    return _start(out, sink, checkpoint, "append", **kw)


# ---------------------------------------------------------------- W4
LATEST_STATE = "version long, ts array<long>, eid array<long>, sku array<long>"
LATEST_OUT = "user_id long, version long, rnk long, sku_id long"


def _newest(held: list[np.ndarray], pdf: pd.DataFrame, n: int) -> list[np.ndarray]:
    """The newest ``n`` of the held (ts, eid, sku) and the rows; of equal ones those held come first."""
    ts, eid, sku = [np.concatenate([h, pdf[c].astype("int64").to_numpy()]) for h, c in zip(held, ("ts_us", "event_id", "sku_id"), strict=True)]
    order = np.lexsort((~eid, ~ts))[:n]
    return [ts[order], eid[order], sku[order]]


def _latest_rows(user: int, version: int, sku: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"user_id": np.full(len(sku), user, np.int64), "version": np.full(len(sku), version, np.int64),
                         "rnk": np.arange(1, len(sku) + 1, dtype=np.int64), "sku_id": sku}, copy=False)


def _latest_updater(n: int) -> Callable:
    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        version, cur = 0, [np.zeros(0, np.int64)] * 3
        if state.exists:
            version, *cur = state.get
            cur = [np.array(c, np.int64) for c in cur]
        for pdf in batches:  # keep only the newest n after every chunk: bounded memory per user
            cur = _newest(cur, pdf, n)
        version += 1
        state.update((version, *[c.tolist() for c in cur]))
        yield _latest_rows(int(key[0]), version, cur[2])
    return update


def latest_items_state(actions: DataFrame, sink: str | None, checkpoint: str, n: int = 10, **kw) -> StreamingQuery:
    """Per-user newest-n items kept in keyed state.

    With a ``sink`` each update appends the user's whole list with a new version (readers keep the max version);
    without one nothing is appended, and readers take the lists from the state (``latest_from_state``)."""
    rows = (actions.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull())
            .select("user_id", "sku_id", "event_id",
                    utc_micros("action_time").alias("ts_us")))
    out = rows.groupBy("user_id").applyInPandasWithState(
        _latest_updater(n), LATEST_OUT, LATEST_STATE, "append", GroupStateTimeout.NoTimeout)
    return _start(out, sink, checkpoint, "append", **kw)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestItemsProcessor(StatefulProcessor):
    """Keyed ``ListState`` holding a user's newest ``n`` (time, event id, sku)
    entries; every update emits the user's whole list with a new version."""

    def __init__(self, n: int = 10):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getListState("items", "ts long, eid long, sku long")
        self.version = handle.getValueState("version", "v long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        told = self.version.get()    # None: no list yet
        items = list(self.items.get()) if told is not None else []
        cur = [np.array([r[k] for r in items], np.int64) for k in range(3)]
        for pdf in rows:  # keep only the newest n after every chunk
            cur = _newest(cur, pdf, self.n)
        self.items.put(list(zip(*[c.tolist() for c in cur], strict=True)))
        version = (told[0] if told is not None else 0) + 1
        self.version.update((version,))
        yield _latest_rows(int(key[0]), version, cur[2])

    def close(self) -> None:
        pass


def latest_items_list_state(actions: DataFrame, sink: str | None, checkpoint: str, n: int = 10,
                            **kw) -> StreamingQuery:
    """Same contract as ``latest_items_state`` on the ``transformWithStateInPandas``
    API (list state in the RocksDB state store, which this API requires)."""
    spark, key = actions.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    rows = (actions.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull())
            .select("user_id", "sku_id", "event_id", utc_micros("action_time").alias("ts_us")))
    out = rows.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=LatestItemsProcessor(n), outputStructType=LATEST_OUT,
        outputMode="Append", timeMode="None")
    spark.conf.set(key, ROCKSDB_PROVIDER)  # a query keeps the provider it starts with
    try:
        return _start(out, sink, checkpoint, "append", **kw)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def latest_from_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, rnk, sku_id): the lists of ``latest_items_state`` as of its last committed batch, read from its state.

    The state holds one entry a user, so nothing grows with the number of updates.  The job may be running or stopped."""
    state = spark.read.format("statestore").load(checkpoint)
    return (state.select(F.col("key.user_id").alias("user_id"), F.posexplode("value.groupState.sku").alias("rnk", "sku_id"))
            .select("user_id", (F.col("rnk") + 1).cast("bigint").alias("rnk"), "sku_id"))


def latest_from_list_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The same from the list state of ``latest_items_list_state``; a user has at most n entries."""
    state = spark.read.format("statestore").option("stateVarName", "items").load(checkpoint)
    rows = state.select(F.col("key.user_id").alias("user_id"), "list_element.*")
    newest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("eid"))
    return rows.select("user_id", F.row_number().over(newest).cast("bigint").alias("rnk"), F.col("sku").alias("sku_id"))


def current_latest(versions: DataFrame) -> DataFrame:
    """Newest version of every user's list: (user_id, rnk, sku_id)."""
    top = versions.groupBy("user_id").agg(F.max("version").alias("version"))
    return versions.join(top, ["user_id", "version"]).select("user_id", "rnk", "sku_id")


def compact_latest(spark, versions_path: str, out_path: str) -> DataFrame:
    """Fold the appended versions into one row set per user (keeps the newest
    version with its number), written to ``out_path``.  Run it periodically
    (e.g. with each offline refresh) and point readers at the compacted table
    plus newer versions, so the version log never grows without bound."""
    v = spark.read.parquet(versions_path)
    top = v.groupBy("user_id").agg(F.max("version").alias("version"))
    cur = v.join(top, ["user_id", "version"]).select("user_id", "version", "rnk", "sku_id")
    cur.repartition("user_id").write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


# ---------------------------------------------------------------- W3 / W7
def request_candidates(requests: DataFrame, per_batch: Callable[[DataFrame], tuple[DataFrame, Callable[[], None]]], sink: str,
                       checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Valid requests -> ``per_batch(users)`` (a batch plan over keyed lookups in the
    newest snapshot, so an offline refresh is seen, and what frees its kept rows) -> sink.

    The plan runs once per user of the micro-batch; every request gets its own
    answer rows (columns of the request that the answer lacks come along)."""
    def run(batch: DataFrame, epoch: int) -> None:
        # one folder per epoch, overwritten on replay: a retried batch never duplicates
        held = batch.persist()
        answers, release = per_batch(held.select("user_id").distinct())
        asked = held.select("user_id", *[c for c in held.columns if c not in answers.columns])
        asked.join(answers, "user_id").write.mode("overwrite").parquet(f"{sink.rstrip('/')}/epoch={epoch}")
        release()
        held.unpersist()

    w = requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="2 seconds")
    return w.start()


# ---------------------------------------------------------------- W1 / W2 / K8
_EPOCH = dt.datetime(1970, 1, 1)


def period_floor(t: dt.datetime, period: dt.timedelta) -> dt.datetime:
    """Start of the tumbling event-time period containing ``t`` (epoch aligned)."""
    secs = (t - _EPOCH) // period
    return _EPOCH + secs * period


def refresh_on_event_time(actions: DataFrame, history_path: str, state_path: str, checkpoint: str,
                          on_anchors: Callable[[DataFrame, list[dt.datetime], int], None],
                          period: dt.timedelta = dt.timedelta(hours=2),
                          delay: dt.timedelta = dt.timedelta(minutes=10),
                          available_now: bool = True) -> StreamingQuery:
    """Append every micro-batch to the history and run ``on_anchors(history,
    anchors, epoch)`` with *every* period boundary that the event-time
    watermark (newest event − delay) has crossed, in order (README: a refresh
    every two hours of event time, over the history up to it).  The first
    boundary is the first after the earliest event of the first micro-batch.

    Per epoch the history folder and a one-row state record (newest event time
    seen, last anchor) are written in overwrite mode, and only the records of
    this and the previous epoch are read.  A replayed epoch neither duplicates
    rows nor fires again what it has recorded; a crash between the refresh and
    its record fires that refresh again (at least once).
    """
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        own = f"{history_path.rstrip('/')}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(own)

        def record(e: int):
            try:
                return spark.read.parquet(f"{state_path.rstrip('/')}/epoch_part={e}").first()
            except AnalysisException:  # no such record
                return None

        if record(epoch) is not None:
            return  # replayed: done before
        oldest, newest = spark.read.parquet(own).agg(F.min("action_time"), F.max("action_time")).first()
        past = record(epoch - 1)
        seen, last = (past["seen"], past["anchor"]) if past is not None else (None, None)
        known = [x for x in (seen, newest) if x is not None]
        seen = max(known) if known else None
        if last is None and oldest is not None:
            last = period_floor(oldest, period)
        if seen is not None:
            boundary = period_floor(seen - delay, period)
            anchors = [last + k * period for k in range(1, (boundary - last) // period + 1)]
            if anchors:
                on_anchors(spark.read.parquet(history_path), anchors, epoch)
                last = boundary
        spark.createDataFrame([(epoch, seen, last)], "epoch long, seen timestamp_ntz, anchor timestamp_ntz") \
            .write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/epoch_part={epoch}")

    w = actions.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
