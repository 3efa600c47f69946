"""Connected components of a table of links: smallest label over neighbours plus pointer jumping.

Every round joins labels to links, takes the smallest label a node sees (partial aggregation, so a hub costs one row
per task), then lets every label point to its own label's label, which halves long chains.  Labels are written
as a table each round; rounds grow with the logarithm of the longest chain.  Tables are written in as few
files as their counted rows need, and read again with their true size, so small ones are joined without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import shared_path

ROWS_A_TASK = 200_000


def tasks_for(rows: int, a_task: int = ROWS_A_TASK) -> int:
    return 1 + rows // a_task


def settled(df: DataFrame, tasks: int) -> DataFrame:
    """``df`` written by ``tasks`` tasks below the shared folder and read again: cut lineage, known size."""
    spark = df.sparkSession
    path = shared_path(spark, "settled")
    df.coalesce(tasks).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b); component is the smallest node reachable.

    ``start`` (node, component) gives labels known already (its nodes are part of the result).
    """
    n = 2 * links.count()
    both = settled(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), tasks_for(n))
    nodes = both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    if start is not None:
        n += start.count()
        nodes = nodes.unionByName(start.select("node", "component")).groupBy("node").agg(F.min("component").alias("component"))
    k = tasks_for(n)
    labels = settled(nodes, k)
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        # nodes with one label move together; then every label follows its lowest neighbour's
        told = labels.join(seen, "node", "left").select("component", F.least("component", F.coalesce("near", "component")).alias("low"))
        low = settled(told.groupBy("component").agg(F.min("low").alias("low")), k)
        hop = (low.join(low.select(F.col("component").alias("low"), F.col("low").alias("lower")), "low", "left")
               .select("component", F.least("low", F.coalesce("lower", "low")).alias("next")))
        new = labels.join(hop, "component", "left").select("node", F.coalesce("next", "component").alias("component"), (F.coalesce("next", "component") < F.col("component")).alias("moved"))
        new = settled(new, k)
        labels = new.select("node", "component")
        if not new.where("moved").limit(1).count():
            return labels
