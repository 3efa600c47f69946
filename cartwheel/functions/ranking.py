"""Exact global positions and prefix sums without a single-partition step.

``Window.orderBy(...)`` with no partition (or a partition with a handful of
keys, such as a feature field) runs in one task.  Instead:

1. range-partition on the sort keys and sort inside each partition;
2. freeze that layout with a reliable checkpoint (in ``spark.checkpoint.dir``),
   so a lost executor recomputes the same partitions;
3. ``monotonically_increasing_id`` then encodes (partition, row-in-partition);
4. per-partition counts/sums form a table of at most partitions + groups rows,
   whose running totals give every partition its offset.

Each step is a distributed job; only the small offset table is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def frozen_sorted(df: DataFrame, keys: Sequence, num_partitions: int | None = None, settle: bool = False) -> DataFrame:
    """Range-partitioned, locally sorted copy of ``df``, checkpointed.

    Range bounds are sampled, which runs the lineage of ``df`` twice; ``settle`` checkpoints it first, which pays
    where the rows to sort are few against the work behind them (distinct values, counts per score).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if settle:
        df = df.checkpoint()
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return ordered.checkpoint(eager=True)


def _tag(frozen: DataFrame) -> DataFrame:
    mid = F.monotonically_increasing_id()
    return (frozen.withColumn("_mid", mid)
            .withColumn("_pid", F.shiftright("_mid", 33))
            .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33))))


def sorted_index(df: DataFrame, order: Sequence, within: Sequence[str] = (), index_col: str = "idx",
                 num_partitions: int | None = None, with_counts: bool = False, settle: bool = False):
    """0-based position of each row in ``order`` (restarting per ``within`` group).

    ``order`` must be a total order (append a unique key) for a stable result.
    ``within`` should have few distinct values (e.g. feature fields): the
    offset table has one row per (partition, group) pair it spans.
    With ``with_counts`` also returns the rows per ``within`` group, read off
    that small offset table.
    """
    keys = [*within, *order]
    tagged = _tag(frozen_sorted(df, keys, num_partitions, settle))
    stats = tagged.groupBy("_pid", *within).agg(F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_n"))
    counts = stats.groupBy(*within).agg(F.sum("_n").alias("n"))
    w = Window.partitionBy(*within).orderBy("_pid") if within else Window.orderBy("_pid")
    stats = stats.withColumn("_off", F.sum("_n").over(w) - F.col("_n"))
    out = tagged.join(F.broadcast(stats.drop("_n")), ["_pid", *within])
    out = out.withColumn(index_col, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("bigint"))
    out = out.drop("_mid", "_pid", "_loc", "_first", "_off")
    return (out, counts) if with_counts else out


def prefix_sums(df: DataFrame, order: Sequence, sums: Sequence[str], suffix: str = "_before",
                num_partitions: int | None = None, settle: bool = False) -> DataFrame:
    """For each row, the sum of ``sums`` columns over all rows strictly before it.

    Within a partition the running sum is a window partitioned by the
    partition id (one original partition per window group, bounded); across
    partitions the offsets come from the small per-partition totals table.
    """
    tagged = _tag(frozen_sorted(df, list(order), num_partitions, settle))
    totals = tagged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in sums])
    wl = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.select("*", *[F.coalesce(F.sum(c).over(wl), F.lit(0)).alias(f"_l_{c}") for c in sums])
    out = local.join(F.broadcast(offs), "_pid")
    for c in sums:
        out = out.withColumn(f"{c}{suffix}", F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    drop = ["_mid", "_pid", "_loc"] + [f"_o_{c}" for c in sums] + [f"_l_{c}" for c in sums]
    return out.drop(*drop)
