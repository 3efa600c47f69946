"""Cross-validated trees, the fixed grids and the weight export (M5, M7, M9).

The factorization machines and linear models (M1-M4) are trained by AdaGrad in
``cartwheel.operators.ffm``, the trees in ``cartwheel.operators.gbdt``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import gbdt
from cartwheel.operators.metrics import auc_exact, logloss
from cartwheel.session import shared_path

# Grids of the model comparison (fixed values of the reference's scripts)
LR_LAMBDAS = [0.0002, 0.002, 0.02, 0.2]
FM_LAMBDAS = [0.0002, 0.002, 0.2]
FM_FACTORS = [16, 64]
FFM_LAMBDAS = [0.0002, 0.002, 0.02]
FFM_FACTORS = [4, 6, 8]


def grid_report(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """(model, lambda, k, auc, logloss) — the printed grid of the reference, as a table."""
    return spark.createDataFrame(pd.DataFrame(rows, columns=["model", "lambda", "k", "auc", "logloss"]))


def gbt_cv(table: DataFrame, feature_cols: Sequence[str], folds: int = 5, seed: int = 7, leaves: int = gbdt.LEAVES,
           categorical: Sequence[str] = (), fold_keys: Sequence[str] = ()) -> DataFrame:
    """One-round leaf-wise GBDT, k-fold cross validation reporting mean AUC and log-loss;
    the label is *not* a feature.

    ``categorical`` columns are split as sets of their values, however many there are.  Folds come from
    ``fold_keys`` by md5 (all columns without them): stable under recomputation, and equal rows share a fold.
    """
    spark = table.sparkSession
    feats = [c for c in feature_cols if c != "label"]
    path = shared_path(spark, "gbt_scores")
    gbdt.cross_validated(table, feats, categorical, folds, seed, list(fold_keys) or feats, leaves).write.parquet(path)
    scored = spark.read.parquet(path)
    auc = auc_exact(scored, group=["fold"]).agg(F.avg("auc")).first()[0]
    loss = logloss(scored, group=["fold"]).agg(F.avg("logloss")).first()[0]
    return grid_report(spark, [{"model": "gbt", "lambda": 0.0, "k": folds, "auc": auc, "logloss": loss}])


def weights_text(kv: DataFrame) -> DataFrame:
    """Text model export, one ``key: v1 v2 ...`` line per weight key."""
    return kv.select(F.concat(F.col("key"), F.lit(": "),
                              F.array_join(F.transform("values", lambda x: x.cast("string")), " ")).alias("line"))


def weights_as_kv(table: DataFrame, bias: float) -> DataFrame:
    spark = table.sparkSession
    b = spark.range(1).select(F.lit("bias").alias("key"), F.array(F.lit(bias)).alias("values"))
    w = table.select(F.concat(F.lit("w_"), F.col("feature_id").cast("string")).alias("key"),
                     F.array("w").alias("values"))
    v = table.select(F.concat(F.lit("v_"), F.col("feature_id").cast("string")).alias("key"),
                     F.col("v").alias("values"))
    return b.unionByName(w).unionByName(v)


def write_model(table: DataFrame, path: str) -> None:
    """Store a model, rows (feature_id, w, v) with the bias as feature -1, as text lines ``key: v1 v2 ...``."""
    values = table.select("feature_id", "w", "v")
    kv = (values.where("feature_id >= 0").select(F.explode(F.array(
        F.struct(F.concat(F.lit("w_"), F.col("feature_id")).alias("key"), F.array("w").alias("values")),
        F.struct(F.concat(F.lit("v_"), F.col("feature_id")).alias("key"), F.col("v").alias("values")))).alias("x")).select("x.*"))
    bias = values.where("feature_id = -1").select(F.lit("bias").alias("key"), F.array("w").alias("values"))
    weights_text(kv.unionByName(bias)).write.text(path)


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """(key, values) of a stored model; a number reads back as the double that was written."""
    parts = F.split("value", ": ?", 2)
    text = F.element_at(parts, 2)
    values = F.when(text == "", F.array().cast("array<double>")).otherwise(F.split(text, " ").cast("array<double>"))
    return spark.read.text(path).select(F.element_at(parts, 1).alias("key"), values.alias("values"))


def read_model(spark: SparkSession, path: str) -> tuple[DataFrame, float]:
    """(rows feature_id, w, v; bias) of a stored model."""
    kv = read_kv(spark, path)
    kind, number = F.substring("key", 1, 1), F.substring("key", 3, 20).cast("bigint")
    table = (kv.where("key <> 'bias'").groupBy(number.alias("feature_id"))
             .agg(F.max(F.when(kind == "w", F.get("values", F.lit(0)))).alias("w"), F.max(F.when(kind == "v", F.col("values"))).alias("v")))
    return table, kv.where("key = 'bias'").first()["values"][0]
