"""Exact ranking metrics as DataFrame aggregates (M6).

AUC with ties = Σ_s pos_s · (neg_below_s + neg_s / 2) / (P · N) (NULL when a
group lacks positives or negatives) over the
distinct scores s of each group; neg_below is an exact distributed prefix sum
(``functions.ranking.prefix_sums``), never a single-task window over all
scores.  Log-loss is a plain aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.ranking import prefix_sums


def auc_exact(scored: DataFrame, label: str = "label", score: str = "score",
              group: Sequence[str] = ()) -> DataFrame:
    group = list(group)
    per = (scored.groupBy(*group, score)
           .agg(F.sum(F.col(label).cast("bigint")).alias("pos"),
                F.sum((1 - F.col(label)).cast("bigint")).alias("neg")))
    pre = prefix_sums(per, [*group, score], ["neg"], settle=True)
    if group:
        # prefix sums run over all groups in order; rebase at each group's start.
        # ``group`` is a report split (e.g. train/test): one row per group, broadcast
        start = pre.groupBy(*group).agg(F.min("neg_before").alias("_start"))
        pre = pre.join(F.broadcast(start), group).withColumn("neg_before", F.col("neg_before") - F.col("_start"))
    contrib = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    return (pre.groupBy(*group)
            .agg(F.try_divide(F.sum(contrib), F.sum("pos") * F.sum("neg")).alias("auc"),
                 F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")))


def logloss(scored: DataFrame, label: str = "label", prob: str = "score", group: Sequence[str] = (),
            eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    ll = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return scored.groupBy(*group).agg(F.avg(ll).alias("logloss"), F.count(F.lit(1)).alias("rows"))
