"""Incremental refresh: two-hour panes of partial counts, merged and retired as anchors pass.

A micro-batch adds to every list only counts: (list_kind, list_key, sku_id, n) by pane, the period that ends at or after an
action's time.  One write of a micro-batch to one pane is a unit, a folder ``epoch=E/pane=P``.  The totals at an anchor are the
sum of the units whose pane lies in (anchor - window, anchor].  A refresh reads the units that entered since the last
one, late arrivals included, and those that left the window, adds the former to the last totals and takes the latter
away; no other unit, and no action, is read again.  Totals are a versioned table, so a repeated refresh starts from the
same one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.functions.exprs import utc_micros
from cartwheel.operators.topn import top_n_per_group
from cartwheel.streaming.jobs import period_floor

PANE = dt.timedelta(hours=2)
KEYS = ["list_kind", "list_key", "sku_id"]
_EPOCH = dt.datetime(1970, 1, 1)


def _micros(t: dt.datetime) -> int:
    return (t - _EPOCH) // dt.timedelta(microseconds=1)


def months_before(t: dt.datetime, months: int) -> dt.datetime:
    """The wall time ``months`` earlier, the last day of a shorter month."""
    year, month = divmod(t.year * 12 + t.month - 1 - months, 12)
    last = (dt.datetime(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return t.replace(year=year, month=month + 1, day=min(t.day, last))


def pane_counts(enriched: DataFrame, kinds: Sequence[str], pane: dt.timedelta = PANE) -> DataFrame:
    """(pane, list_kind, list_key, sku_id, n): actions by the end of their pane, in microseconds of UTC wall time."""
    size = pane // dt.timedelta(microseconds=1)
    groups = F.explode(F.array(*[F.struct(F.lit(k).alias("list_kind"), F.col(k).cast("bigint").alias("list_key")) for k in kinds])).alias("g")
    long = enriched.where("sku_id is not null and action_time is not null").select((F.ceil(utc_micros("action_time") / F.lit(size)) * F.lit(size)).cast("bigint").alias("pane"), "sku_id", groups)
    return long.select("pane", "g.*", "sku_id").where("list_key is not null").groupBy("pane", *KEYS).agg(F.count("*").alias("n"))


@dataclass
class Panes:
    """Folders of the units and of the totals below ``root``."""
    root: str
    kinds: Sequence[str]
    months: int = 2
    reads: list[tuple[int, int, int]] = field(default_factory=list)   # a refresh: units added, units retired, units there are

    def _units(self) -> str:
        return f"{self.root.rstrip('/')}/units"

    def _index(self) -> str:
        return f"{self.root.rstrip('/')}/index"

    def add(self, enriched: DataFrame, epoch: int) -> None:
        """Store a micro-batch's counts; a replayed one overwrites its own."""
        spark = enriched.sparkSession
        path = f"{self._units()}/epoch={epoch}"
        pane_counts(enriched, self.kinds).repartition("pane").write.mode("overwrite").partitionBy("pane").parquet(path)
        try:
            index = spark.read.parquet(path).select(F.col("pane").cast("bigint").alias("pane")).distinct()
        except AnalysisException:   # no action to count
            index = spark.createDataFrame([], "pane bigint")
        index.write.mode("overwrite").parquet(f"{self._index()}/epoch={epoch}")

    def _units_in(self, spark: SparkSession, low: int, high: int, epoch: int) -> set[tuple[int, int]]:
        """(epoch, pane) of the units in (low, high], up to ``epoch``: one row a unit of the window."""
        try:
            index = spark.read.parquet(self._index())
        except AnalysisException:   # nothing stored, or no unit yet
            return set()
        return {(r["epoch"], r["pane"]) for r in index.where((F.col("pane") > low) & (F.col("pane") <= high) & (F.col("epoch") <= epoch)).collect()}

    def _read(self, spark: SparkSession, units: set[tuple[int, int]], sign: int) -> DataFrame | None:
        if not units:
            return None
        return spark.read.parquet(*[f"{self._units()}/epoch={e}/pane={p}" for e, p in sorted(units)]).select(*KEYS, (F.col("n") * sign).alias("n"))

    def refresh(self, spark: SparkSession, anchor: dt.datetime, epoch: int, last: tuple[dt.datetime, int] | None) -> DataFrame:
        """Totals (list_kind, list_key, sku_id, n) of (anchor - months, anchor] over the epochs so far; ``last``: (anchor,
        epoch) of the refresh before, whose totals are brought forward."""
        def window(at: dt.datetime, upto: int) -> set[tuple[int, int]]:
            return self._units_in(spark, _micros(months_before(at, self.months)), _micros(at), upto)

        now, before = window(anchor, epoch), window(*last) if last else set()
        parts = [self._read(spark, now - before, 1), self._read(spark, before - now, -1)]
        self.reads.append((len(now - before), len(before - now), len(now | before)))
        if last:
            parts.append(spark.read.parquet(self._totals(*last)))
        parts = [p for p in parts if p is not None]
        total = parts[0] if parts else spark.createDataFrame([], "list_kind string, list_key bigint, sku_id bigint, n bigint")
        for p in parts[1:]:
            total = total.unionByName(p)
        path = self._totals(anchor, epoch)
        total.groupBy(*KEYS).agg(F.sum("n").alias("n")).where("n > 0").write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def _totals(self, anchor: dt.datetime, epoch: int) -> str:
        return f"{self.root.rstrip('/')}/totals/anchor={_micros(anchor)}_{epoch}"


def lists_of(totals: DataFrame, n: int = 10) -> DataFrame:
    """Content lists of totals: (list_kind, list_key, rnk, sku_id, cnt)."""
    counts = totals.withColumnRenamed("n", "cnt")
    return top_n_per_group(counts, ["list_kind", "list_key"], [F.desc("cnt"), F.asc("sku_id")], n).select("list_kind", "list_key", "rnk", "sku_id", "cnt")


def refresh_by_panes(actions: DataFrame, enrich: Callable[[DataFrame], DataFrame], panes: Panes, checkpoint: str,
                     on_totals: Callable[[DataFrame, dt.datetime, int], None], every: dt.timedelta = PANE,
                     delay: dt.timedelta = dt.timedelta(minutes=10), available_now: bool = True) -> StreamingQuery:
    """Event-time refreshes by panes: ``on_totals(totals, anchor, epoch)`` at every boundary of ``every`` (a multiple of a pane)
    that the watermark (newest event - delay) crosses.

    One record per epoch keeps the newest event time and the last anchor, so a restarted job goes on from it; an epoch
    that is replayed after its record is done already.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession

        def record(e: int):
            try:
                return spark.read.parquet(f"{panes.root.rstrip('/')}/records/epoch_part={e}").first()
            except AnalysisException:  # no such record
                return None

        if record(epoch) is not None:
            return
        held = batch.persist()
        panes.add(enrich(held), epoch)
        oldest, newest = held.agg(F.min("action_time"), F.max("action_time")).first()
        held.unpersist()
        past = record(epoch - 1)
        seen, anchor, at = (past["seen"], past["anchor"], past["at"]) if past is not None else (None, None, None)
        seen = max([x for x in (seen, newest) if x is not None], default=None)
        if anchor is None and oldest is not None:
            anchor = period_floor(oldest, every)
        if seen is not None:
            boundary = period_floor(seen - delay, every)
            while anchor + every <= boundary:
                last = (anchor, at) if at is not None else None
                anchor, at = anchor + every, epoch
                on_totals(panes.refresh(spark, anchor, epoch, last), anchor, epoch)
        spark.createDataFrame([(epoch, seen, anchor, at)], "epoch long, seen timestamp_ntz, anchor timestamp_ntz, at long") \
            .write.mode("overwrite").parquet(f"{panes.root.rstrip('/')}/records/epoch_part={epoch}")

    w = actions.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
