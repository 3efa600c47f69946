"""Factorization machines and linear models trained by AdaGrad as Spark jobs (M1-M4).

One-hot rows with one active feature i_a per field a (value 1); ``kind``:

* ``ffm``:    φ(x) = w0 + Σ_a w_{i_a} + Σ_{a<b} <V_{i_a, b}, V_{i_b, a}>, V_{i, f} ∈ R^k
* ``fm``:     φ(x) = w0 + Σ_a w_{i_a} + Σ_{a<b} <V_{i_a}, V_{i_b}>,       V_i ∈ R^k
* ``linear``: φ(x) = w0 + Σ_a w_{i_a}

Parameters live in a long table (feature_id, pos, value, acc) — pos -1 is
the linear weight, pos 0.. the factors (ffm: f·k+t for field f) — partitioned
by feature id; the bias is feature_id -1.  One epoch = one synchronous
full-batch AdaGrad step:

1. rows (one record per training row, its F feature ids) ⋈ parameters
   (reassembled per feature) -> per row: F ids, F weights, F×F×k factors;
2. ``mapInPandas`` computes logistic-loss gradients for a whole Arrow
   batch in NumPy and combines them per feature inside the batch;
3. ``groupBy(feature_id, pos).sum`` adds the partial gradients;
4. a join with the parameter table applies AdaGrad; the new table is
   written to the shared folder (cuts lineage; survives lost executors).

No parameter vector is ever collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import h64
from cartwheel.session import shared_path

GRAD_SCHEMA = "feature_id long, pos int, g double"
SCORE_SCHEMA = "row_id long, label double, score double"


def width(kind: str, n_fields: int, k: int) -> int:
    """Factors per feature."""
    return {"ffm": n_fields * k, "fm": k, "linear": 0}[kind]


def init_params(feature_ids: DataFrame, n_fields: int, k: int, seed: int = 3, kind: str = "ffm") -> DataFrame:
    """w = 0; factors uniform in [0, 1/sqrt(k)) from md5; bias row feature_id -1."""
    ids = feature_ids.select(F.col("feature_id").cast("bigint")).distinct()
    ids = ids.unionByName(ids.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("feature_id")))
    pos = F.explode(F.sequence(F.lit(-1), F.lit(width(kind, n_fields, k) - 1))).alias("pos")
    p = ids.select("feature_id", pos).where((F.col("feature_id") >= 0) | (F.col("pos") == -1))
    init = F.when(F.col("pos") == -1, F.lit(0.0)).otherwise(
        F.pmod(h64(F.lit(seed), "feature_id", "pos"), F.lit(1_000_000)) / 1_000_000.0 / float(np.sqrt(max(k, 1))))
    return p.select("feature_id", F.col("pos").cast("int"), init.alias("value"), F.lit(0.0).alias("acc"))


BROADCAST_PARAM_BYTES = 64 << 20


def _broadcastable(params: DataFrame, n_fields: int, k: int, kind: str = "ffm") -> bool:
    """Counted size check of all look-ups together: F × features × (1 + factors) doubles under BROADCAST_PARAM_BYTES."""
    n_feat = params.where(F.col("pos") == -1).count()
    return n_fields * n_feat * (1 + width(kind, n_fields, k)) * 8 <= BROADCAST_PARAM_BYTES


def _row_view(rows: DataFrame, params: DataFrame, n_fields: int, k: int, broadcast: bool = False, kind: str = "ffm") -> DataFrame:
    """One record per row: label, ids[F], w[F], v[F·factors] (+ bias).

    With ``broadcast`` (size checked by the caller) every field looks its
    parameters up by a broadcast join and the rows stay where they are; otherwise the lookup is a shuffle join on feature id, whose
    hot ids (e.g. a common age) AQE's skew handling splits.
    """
    wide = (params.where(F.col("feature_id") >= 0)
            .groupBy("feature_id")
            .agg(F.max(F.when(F.col("pos") == -1, F.col("value"))).alias("w"),
                 F.array_sort(F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", "value")))).alias("vs")))
    wide = wide.select("feature_id", "w", F.transform("vs", lambda s: s["value"]).alias("v"))
    zero_v = F.array_repeat(F.lit(0.0), width(kind, n_fields, k)) if width(kind, n_fields, k) else F.array().cast("array<double>")
    bias = params.where(F.col("feature_id") == -1).select(F.max("value")).scalar()
    if broadcast:
        j = rows.select("row_id", "label", "ids")
        for f in range(n_fields):
            side = wide.select(F.col("feature_id").alias(f"_id{f}"), F.col("w").alias(f"_w{f}"), F.col("v").alias(f"_v{f}"))
            j = j.join(F.broadcast(side), F.col("ids")[f] == F.col(f"_id{f}"), "left")
        return j.select("row_id", F.col("label").cast("double").alias("label"), "ids",
                        F.array(*[F.coalesce(f"_w{f}", F.lit(0.0)) for f in range(n_fields)]).alias("w"),
                        F.concat(*[F.coalesce(f"_v{f}", zero_v) for f in range(n_fields)]).alias("v"),
                        F.coalesce(bias, F.lit(0.0)).alias("w0"))
    long = rows.select("row_id", "label", F.posexplode("ids").alias("field", "feature_id"))
    j = long.join(wide, "feature_id", "left")
    j = j.select("row_id", "label", "field", "feature_id", F.coalesce("w", F.lit(0.0)).alias("w"),
                 F.coalesce("v", zero_v).alias("v"))
    per_row = (j.groupBy("row_id", "label")
               .agg(F.array_sort(F.collect_list(F.struct("field", "feature_id", "w", "v"))).alias("items")))
    return per_row.select("row_id", F.col("label").cast("double").alias("label"),
                          F.transform("items", lambda s: s["feature_id"]).alias("ids"),
                          F.transform("items", lambda s: s["w"]).alias("w"),
                          F.flatten(F.transform("items", lambda s: s["v"])).alias("v"),
                          F.coalesce(bias, F.lit(0.0)).alias("w0"))


def _phi(pdf: pd.DataFrame, n_fields: int, k: int, kind: str = "ffm"):
    n = len(pdf)
    w = np.stack(pdf["w"].to_numpy()).reshape(n, n_fields)
    if kind != "ffm":
        factors = width(kind, n_fields, k)
        v = np.stack(pdf["v"].to_numpy()).reshape(n, n_fields, factors) if factors else np.zeros((n, n_fields, 0))
        total = v.sum(axis=1)
        return pdf["w0"].to_numpy() + w.sum(axis=1) + 0.5 * ((total * total).sum(axis=1) - (v * v).sum(axis=(1, 2))), w, v
    v = np.stack(pdf["v"].to_numpy()).reshape(n, n_fields, n_fields, k)
    inter = np.einsum("nabk,nbak->nab", v, v)
    iu = np.triu_indices(n_fields, 1)
    phi = pdf["w0"].to_numpy() + w.sum(axis=1) + inter[:, iu[0], iu[1]].sum(axis=1)
    return phi, w, v


def _gradients(n_fields: int, k: int, reg: float, n_total: float, kind: str = "ffm"):
    factors = width(kind, n_fields, k)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            phi, w, v = _phi(pdf, n_fields, k, kind)
            y = np.where(pdf["label"].to_numpy() > 0, 1.0, -1.0)
            kappa = -y / (1.0 + np.exp(np.clip(y * phi, -35, 35)))           # dLoss/dphi
            ids = np.stack(pdf["ids"].to_numpy()).astype("int64")           # (n, F)
            gw = kappa[:, None] + reg * w                                     # (n, F)
            if kind == "ffm":
                gv = kappa[:, None, None, None] * np.transpose(v, (0, 2, 1, 3)) + reg * v   # (n, F, F, k)
                eye = np.eye(n_fields, dtype=bool)
                gv[:, eye, :] = 0.0                                           # no self-field pairs
            else:
                gv = kappa[:, None, None] * (v.sum(axis=1, keepdims=True) - v) + reg * v    # (n, F, factors)
            uniq, inv = np.unique(ids.ravel(), return_inverse=True)
            acc_w = np.zeros(len(uniq))
            np.add.at(acc_w, inv, gw.ravel())
            acc_v = np.zeros((len(uniq), factors))
            np.add.at(acc_v, inv, gv.reshape(-1, factors) if factors else np.zeros((len(inv), 0)))
            fid = np.repeat(uniq, 1 + factors)
            pos = np.tile(np.arange(-1, factors), len(uniq))
            g = np.concatenate([acc_w[:, None], acc_v], axis=1).ravel() / n_total
            yield pd.DataFrame({"feature_id": np.append(fid, -1), "pos": np.append(pos, -1).astype("int32"),
                                "g": np.append(g, kappa.sum() / n_total)})
    return run


def _scores(n_fields: int, k: int, kind: str = "ffm"):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            phi, _, _ = _phi(pdf, n_fields, k, kind)
            yield pd.DataFrame({"row_id": pdf["row_id"], "label": pdf["label"], "score": 1 / (1 + np.exp(-phi))})
    return run


def training_rows(encoded: DataFrame, feature_cols: Sequence[str], label: str = "label") -> DataFrame:
    """(row_id, label, ids[F]) written once to the shared folder (stable row ids)."""
    rows = encoded.select(F.col(label).alias("label"),
                          F.array(*[F.col(c).cast("bigint") for c in feature_cols]).alias("ids"))
    path = shared_path(encoded.sparkSession, "ffm_rows")
    rows.withColumn("row_id", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    return encoded.sparkSession.read.parquet(path)


def fit(rows: DataFrame, n_fields: int, k: int = 4, reg: float = 0.002, lr: float = 0.2,
        epochs: int = 5, seed: int = 3, kind: str = "ffm") -> DataFrame:
    """Train; returns the final long parameter table (feature_id, pos, value, acc)."""
    spark = rows.sparkSession
    n_total = float(rows.count())
    feats = rows.select(F.explode("ids").alias("feature_id"))
    params = init_params(feats, n_fields, k, seed, kind)
    small = _broadcastable(params, n_fields, k, kind)
    for epoch in range(epochs):
        view = _row_view(rows, params, n_fields, k, broadcast=small, kind=kind)
        grads = (view.mapInPandas(_gradients(n_fields, k, reg, n_total, kind), GRAD_SCHEMA)
                 .groupBy("feature_id", "pos").agg(F.sum("g").alias("g")))
        upd = params.join(grads, ["feature_id", "pos"], "left").fillna(0.0, subset=["g"])
        acc = F.col("acc") + F.col("g") * F.col("g")
        upd = upd.select("feature_id", "pos",
                         (F.col("value") - F.lit(lr) * F.col("g") / F.sqrt(acc + F.lit(1e-8))).alias("value"),
                         acc.alias("acc"))
        path = shared_path(spark, "ffm_params", f"epoch{epoch}")
        upd.repartition("feature_id").write.mode("overwrite").parquet(path)
        params = spark.read.parquet(path)
    return params


def predict(rows: DataFrame, params: DataFrame, n_fields: int, k: int, kind: str = "ffm") -> DataFrame:
    view = _row_view(rows, params, n_fields, k, broadcast=_broadcastable(params, n_fields, k, kind), kind=kind)
    return view.mapInPandas(_scores(n_fields, k, kind), SCORE_SCHEMA)


def weight_table(params: DataFrame) -> DataFrame:
    """Scoring table (feature_id, w, v) of the trained features; the bias has feature_id -1."""
    return (params.groupBy("feature_id")
            .agg(F.max(F.when(F.col("pos") == -1, F.col("value"))).alias("w"),
                 F.array_sort(F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", "value")))).alias("vs"))
            .select("feature_id", "w", F.transform("vs", lambda s: s["value"]).alias("v")))


def grid(train_rows: DataFrame, test_rows: DataFrame, n_fields: int, lambdas=(0.0002, 0.002, 0.02),
         factors=(4, 6, 8), lr: float = 0.2, epochs: int = 5, kind: str = "ffm") -> list[dict]:
    """A comparison grid (λ × k): test AUC and log-loss per point."""
    from cartwheel.operators.metrics import auc_exact, logloss
    out = []
    for lam in lambdas:
        for k in factors:
            params = fit(train_rows, n_fields, k=k, reg=lam, lr=lr, epochs=epochs, kind=kind)
            scored = predict(test_rows, params, n_fields, k, kind)
            out.append({"model": {"linear": "lr"}.get(kind, kind), "lambda": lam, "k": k,
                        "auc": auc_exact(scored).first()["auc"], "logloss": logloss(scored).first()["logloss"]})
    return out
