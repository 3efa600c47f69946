"""Binary cosine similarity between entities that share users.

sim(a, b) = |U(a) ∩ U(b)| / sqrt(|U(a)| · |U(b)|), a ≠ b, only pairs with a
common user (the sparse form of the reference's dense brand × brand matrix).

The co-occurrence counts are a sparse matrix product MᵀM of the (user ×
entity) incidence matrix, computed block-wise instead of by a self-join that
would emit every entity pair of every user:

* entities hash into K blocks; users hash into S salts;
* each (user, entity) row is sent to the block pairs (b_i <= b_j) that user
  touches — at most K copies per row, however many entities the user has;
* one ``applyInPandas`` task per (b_i, b_j, salt) multiplies the dense 0/1
  sub-matrices chunk by chunk in NumPy and emits partial counts;
* Spark sums the partials over salts (map-side partial aggregation) and
  divides by the degrees.

K and S are derived from counted sizes so that a block holds about
``block_size`` entities and a group about ``rows_per_group`` rows; a user or
entity holding a third of the log is thereby split across many tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir

PARTIAL_SCHEMA = "e1 long, e2 long, co long"


def _block_cooccurrence(pdf: pd.DataFrame) -> pd.DataFrame:
    """Partial co-occurrence counts for one (block_i, block_j, salt) group.

    Rows: user, entity, side (0 = left block, 1 = right block, 2 = both).
    """
    left = pdf[pdf["side"] != 1]
    right = pdf[pdf["side"] != 0]
    if left.empty or right.empty:
        return pd.DataFrame({"e1": [], "e2": [], "co": []}).astype("int64")
    lu, le = left["user"].to_numpy(), left["entity"].to_numpy()
    ru, re_ = right["user"].to_numpy(), right["entity"].to_numpy()
    users, uinv = np.unique(np.concatenate([lu, ru]), return_inverse=True)
    lui, rui = uinv[: len(lu)], uinv[len(lu):]
    lents, lidx = np.unique(le, return_inverse=True)
    rents, ridx = np.unique(re_, return_inverse=True)
    nl, nr = len(lents), len(rents)
    acc = np.zeros((nl, nr), dtype=np.float64)
    chunk = max(1, (1 << 22) // max(nl, nr, 1))
    lorder, rorder = np.argsort(lui, kind="stable"), np.argsort(rui, kind="stable")
    lui_s, lidx_s = lui[lorder], lidx[lorder]
    rui_s, ridx_s = rui[rorder], ridx[rorder]
    for start in range(0, len(users), chunk):
        stop = min(start + chunk, len(users))
        la, lb = np.searchsorted(lui_s, [start, stop])
        ra, rb = np.searchsorted(rui_s, [start, stop])
        if la == lb or ra == rb:
            continue
        a = np.zeros((stop - start, nl), dtype=np.float64)
        b = np.zeros((stop - start, nr), dtype=np.float64)
        a[lui_s[la:lb] - start, lidx_s[la:lb]] = 1.0
        b[rui_s[ra:rb] - start, ridx_s[ra:rb]] = 1.0
        acc += a.T @ b
    i, j = np.nonzero(acc)
    e1, e2, co = lents[i].astype("int64"), rents[j].astype("int64"), np.rint(acc[i, j]).astype("int64")
    if not (pdf["side"] == 2).any():
        # off-diagonal block pair: also emit the transposed direction
        e1, e2, co = np.concatenate([e1, e2]), np.concatenate([e2, e1]), np.concatenate([co, co])
    keep = e1 != e2
    return pd.DataFrame({"e1": e1[keep], "e2": e2[keep], "co": co[keep]})


def _salts(incidence: DataFrame, blocks: int, rows_per_group: int) -> int:
    """Salts that keep a block pair's group at about ``rows_per_group`` rows: it holds the rows of two blocks."""
    largest = incidence.groupBy(_block(blocks)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return math.ceil(2 * largest / rows_per_group)


def _block(blocks: int):
    return F.pmod(F.xxhash64(F.col("entity").cast("bigint")), F.lit(blocks)).cast("int").alias("blk")


def cooccurrence(incidence: DataFrame, block_size: int = 1024, rows_per_group: int = 500_000,
                 blocks: int | None = None, salts: int | None = None) -> DataFrame:
    """Directed co-occurrence counts (e1, e2, co) for e1 ≠ e2 sharing a user.

    ``incidence`` holds distinct (user, entity) rows (both bigint).
    """
    if blocks is None or salts is None:
        blocks = blocks or max(1, math.ceil(incidence.select("entity").distinct().count() / block_size))
        pairs = blocks * (blocks + 1) // 2
        # groups enough for every slot, and no more than the rows need beyond that
        slots = incidence.sparkSession.sparkContext.defaultParallelism
        salts = salts or max(_salts(incidence, blocks, rows_per_group), math.ceil(slots / pairs), 2)
    inc = incidence.select(
        F.col("user").cast("bigint").alias("user"), F.col("entity").cast("bigint").alias("entity"),
        _block(blocks),
        F.pmod(F.xxhash64(F.col("user"), F.lit(7)), F.lit(salts)).cast("int").alias("salt"))
    touched = inc.groupBy("user").agg(F.collect_set("blk").alias("blks"))  # at most K ids per user
    routed = (inc.join(touched, "user")
              .select("user", "entity", "blk", "salt", F.explode("blks").alias("other")))
    routed = routed.select(
        "user", "entity", "salt",
        F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"),
        F.when(F.col("blk") == F.col("other"), 2).when(F.col("blk") < F.col("other"), 0).otherwise(1)
        .cast("int").alias("side"))
    partial = (routed.groupBy("bi", "bj", "salt")
               .applyInPandas(lambda pdf: _block_cooccurrence(pdf), PARTIAL_SCHEMA))
    return partial.groupBy("e1", "e2").agg(F.sum("co").alias("co"))


def cosine_similarity(incidence: DataFrame, **kw) -> DataFrame:
    """(e1, e2, co, sim) for every ordered pair of distinct co-occurring entities.

    The distinct incidence is checkpointed once (it feeds the sizes, the
    routing and the degrees), so the log behind it is scanned a single time.
    """
    inc = incidence.select("user", "entity").distinct()
    ensure_checkpoint_dir(inc.sparkSession)
    inc = inc.checkpoint(eager=True)
    co = cooccurrence(inc, **kw)
    deg = inc.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    d1 = deg.select(F.col("entity").alias("e1"), F.col("n").alias("n1"))
    d2 = deg.select(F.col("entity").alias("e2"), F.col("n").alias("n2"))
    return (co.join(d1, "e1").join(d2, "e2")
            .select("e1", "e2", "co", (F.col("co") / F.sqrt(F.col("n1") * F.col("n2"))).alias("sim")))


def brand_similarity(enriched_active: DataFrame, **kw) -> DataFrame:
    """Brand × brand cosine over the users (already filtered to active ones)."""
    inc = (enriched_active.where(F.col("brand").isNotNull() & F.col("user_id").isNotNull())
           .select(F.col("user_id").alias("user"), F.col("brand").cast("bigint").alias("entity")))
    s = cosine_similarity(inc, **kw)
    return s.select(F.col("e1").alias("brand1"), F.col("e2").alias("brand2"), "co", "sim")


def item_similarity(action_active: DataFrame, **kw) -> DataFrame:
    inc = (action_active.where(F.col("sku_id").isNotNull() & F.col("user_id").isNotNull())
           .select(F.col("user_id").alias("user"), F.col("sku_id").alias("entity")))
    s = cosine_similarity(inc, **kw)
    return s.select(F.col("e1").alias("sku1"), F.col("e2").alias("sku2"), "co", "sim")
