"""As-of join by sorting: every fact gets the newest dimension row of its key that is not younger.

Facts and dimension rows are sorted together, range-partitioned by (key, time), so no range condition is joined and a key
with a large share of the rows spans several partitions.  Inside a partition a running ``last`` carries the dimension
row on; what a key carries into a partition comes from a table of two rows a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.ranking import _tag, frozen_sorted


def asof_join(facts: DataFrame, dimension: DataFrame, key: str, fact_time: str, dim_time: str, columns: Sequence[str],
              num_partitions: int | None = None) -> DataFrame:
    """``facts`` with ``columns`` of the dimension row of the same key with the largest ``dim_time`` <= ``fact_time``.

    Facts before a key's first dimension row, and those with a NULL key or time, get NULLs; of dimension rows of one key and
    time the largest by ``columns`` counts.
    """
    fact = F.struct(*[F.col(c) for c in facts.columns])
    row = F.struct(*[F.col(c) for c in columns])
    one = dimension.where(F.col(key).isNotNull() & F.col(dim_time).isNotNull()).groupBy(key, dim_time).agg(F.max(row).alias("_dim"))
    able = F.col(key).isNotNull() & F.col(fact_time).isNotNull()
    both = (one.select(F.col(key).alias("_key"), F.col(dim_time).alias("_time"), F.lit(0).alias("_kind"), "_dim")
            .unionByName(facts.where(able).select(F.col(key).alias("_key"), F.col(fact_time).alias("_time"), F.lit(1).alias("_kind"), fact.alias("_fact")), allowMissingColumns=True))
    tagged = _tag(frozen_sorted(both, ["_key", "_time", "_kind"], num_partitions)).drop("_mid")
    inside = Window.partitionBy("_pid", "_key").orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
    carried = tagged.withColumn("_here", F.last("_dim", ignorenulls=True).over(inside))
    # what crosses partitions: the last dimension row of every partition's last key, and its first key
    newest = F.max_by("_dim", F.when(F.col("_kind") == 0, F.col("_loc")))
    ends = tagged.groupBy("_pid", "_key").agg(F.min("_loc").alias("_first"), F.max("_loc").alias("_last"), newest.alias("_dim"))
    edge = ends.groupBy("_pid").agg(F.min_by("_key", "_first").alias("_head"), F.max_by(F.struct("_key", "_dim"), "_last").alias("_tail"))
    marks = edge.select("_pid", F.explode(F.array(
        F.struct(F.col("_head").alias("_key"), F.lit(0).alias("_end"), F.lit(None).cast(ends.schema["_dim"].dataType).alias("_dim")),
        F.struct(F.col("_tail._key").alias("_key"), F.lit(1).alias("_end"), F.col("_tail._dim").alias("_dim")))).alias("m")).select("_pid", "m.*")
    over = Window.partitionBy("_key").orderBy("_pid", "_end").rowsBetween(Window.unboundedPreceding, -1)
    brought = marks.withColumn("_before", F.last("_dim", ignorenulls=True).over(over)).where("_end = 0").select("_pid", "_key", "_before")
    out = carried.where("_kind = 1").join(F.broadcast(brought), ["_pid", "_key"], "left")  # a row a partition
    found = out.select("_fact.*", F.coalesce("_here", "_before").alias("_dim")).select(*facts.columns, *[F.col(f"_dim.{c}").alias(c) for c in columns])
    return found.unionByName(facts.where(~able), allowMissingColumns=True)
