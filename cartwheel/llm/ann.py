"""Approximate nearest neighbours by inner product: a permutation index with pivot inverted files.

Pivots come from a bounded sample (``sample_size`` rows by hash of the id) and are chosen farthest-first.  Every
vector is represented by the order of all pivots by nearness to it.  Inner products are made a distance by the
usual extra component ``sqrt(M^2 - |x|^2)`` (M: the largest norm; 0 for queries), so long vectors rank as they
should.  A vector is posted in the inverted files of its ``posted`` nearest pivots; a query reads those of its
``probed`` nearest pivots.  Within a list, candidates are ranked by Spearman's footrule between permutations;
the best ``keep_share`` (``keep_least`` at least) are reranked by the exact inner product in double precision.

Lists are dealt in pieces: rows of a list in chunks of about ``chunk_rows``, its queries in chunks of
``chunk_queries``, every pair of chunks in one task, so no list, however popular its pivot or vector, has to
fit in one task.  A candidate in several of a query's lists is examined in the first of them alone.

Defined results: vectors that are null, zero, hold a null or a non-finite component, or differ in length from most take no part
(as query or candidate); ties go to the smaller id; equal vectors are separate candidates; rows that repeat an
id count once per different score; fewer candidates than ``k`` give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 128
POSTED = 8
PROBED = 16
KEEP_SHARE = 0.5
KEEP_LEAST = 1000
SAMPLE = 4096
CHUNK_ROWS = 4096
CHUNK_QUERIES = 1024


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec as array<double>) of the vectors that take part."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    sound = (rows.where(v.isNotNull() & F.col("id").isNotNull() & (F.size(v) > 0))
             .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)))
    dims = sound.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return sound.where(F.size("vec") == (dims[0]["d"] if dims else 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of ``n`` rows of the (augmented) sample."""
    chosen = [0]
    away = np.full(len(sample), np.inf)
    while len(chosen) < min(n, len(sample)):
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        away[chosen] = -1
        chosen.append(int(away.argmax()))
    return sample[chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _augment(x: np.ndarray, norm2: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0.0))[:, None]])


def _ranks(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Position of every pivot in the order of nearness to each row (uint8 below 256 pivots)."""
    distance = (pivots * pivots).sum(axis=1)[None, :] - 2.0 * (x @ pivots.T)
    order = np.argsort(distance, axis=1, kind="stable")
    ranks = np.empty(order.shape, np.uint8 if len(pivots) <= 256 else np.uint16)
    np.put_along_axis(ranks, order, np.arange(len(pivots), dtype=ranks.dtype)[None, :].repeat(len(x), 0), 1)
    return ranks


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           pivots: int = PIVOTS, posted: int = POSTED, probed: int = PROBED, keep_share: float = KEEP_SHARE,
           keep_least: int = KEEP_LEAST, sample_size: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors`` found for each row of ``queries``."""
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = usable(vectors, id_col, vec_col)
    asked = usable(queries, id_col, vec_col)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    if not stats["n"]:
        return spark.createDataFrame([], schema)
    n, norm2 = stats["n"], stats["m"]
    share = min(1.0, 1.5 * sample_size / n)
    picked = (rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
              .orderBy(F.xxhash64("id"), "id").limit(sample_size).collect())
    sample = _augment(np.array([r["vec"] for r in picked]), norm2)
    chosen = choose_pivots(sample, max(1, min(pivots, n // 50)))
    shared = spark.sparkContext.broadcast(chosen)
    narrow = vectors.schema[vec_col].dataType.simpleString() == "array<float>"

    def represent(as_query: bool, width: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pv = shared.value
            for batch in batches:
                for lo in range(0, batch.num_rows, 2048):
                    part = batch.slice(lo, 2048)
                    if not part.num_rows:
                        continue
                    x = _matrix(part.column("vec"))
                    aug = np.hstack([x, np.zeros((len(x), 1))]) if as_query else _augment(x, norm2)
                    ranks = _ranks(aug, pv)
                    near = np.argsort(ranks, axis=1)[:, :width].astype(np.int32)
                    lists = pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), pa.array(near.ravel()))
                    raw = x.astype(np.float32 if narrow else np.float64)
                    yield pa.record_batch([part.column("id"), pa.array([r.tobytes() for r in ranks], pa.binary()),
                                           pa.array([r.tobytes() for r in raw], pa.binary()), lists], ["id", "ranks", "vec", "pivots"])
        return run

    kind = "id bigint, ranks binary, vec binary, pivots array<int>"
    held = rows.mapInArrow(represent(False, min(posted, len(chosen))), kind).select("id", "ranks", "vec", F.explode("pivots").alias("pivot"))
    put = asked.mapInArrow(represent(True, min(probed, len(chosen))), kind).select("id", "ranks", "vec", F.explode("pivots").alias("pivot"))
    # sizes of the lists: one row per pivot
    sizes = (held.groupBy("pivot").agg(F.count(F.lit(1)).alias("rows"))
             .join(put.groupBy("pivot").agg(F.count(F.lit(1)).alias("asked")), "pivot")
             .select("pivot", F.ceil(F.col("rows") / CHUNK_ROWS).cast("int").alias("nr"), F.ceil(F.col("asked") / CHUNK_QUERIES).cast("int").alias("nq"))
             .checkpoint())
    sizes = F.broadcast(sizes)  # at most ``pivots`` rows
    held = held.join(sizes, "pivot").select("pivot", F.pmod(F.xxhash64("id"), F.col("nr")).cast("int").alias("rc"),
                                            F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qc"), F.lit(False).alias("is_query"), "id", "ranks", "vec")
    put = put.join(sizes, "pivot").select("pivot", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("rc"),
                                          F.pmod(F.xxhash64("id"), F.col("nq")).cast("int").alias("qc"), F.lit(True).alias("is_query"), "id", "ranks", "vec")
    n_pivots, limit = len(chosen), min(posted, len(chosen))
    vec_type, rank_type = (np.float32 if narrow else np.float64), (np.uint8 if len(chosen) <= 256 else np.uint16)

    def examine(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        pivot = int(key[0])
        flag = group["is_query"].to_numpy()
        cand, ask = group[~flag], group[flag]
        out = []
        if len(cand) and len(ask):
            order = np.argsort(cand["id"].to_numpy(), kind="stable")
            ids = cand["id"].to_numpy()[order]
            ranks = np.frombuffer(b"".join(cand["ranks"]), rank_type).reshape(len(cand), n_pivots)[order]
            vec = np.frombuffer(b"".join(cand["vec"]), vec_type).reshape(len(cand), -1)[order].astype(np.float64)
            near = ranks < limit
            for q_id, q_raw, q_vec in zip(ask["id"], ask["ranks"], ask["vec"], strict=True):
                q = np.frombuffer(q_raw, rank_type)
                before = np.flatnonzero(q < q[pivot])  # lists this query reads earlier
                mine = ids != q_id
                if len(before):
                    mine &= ~near[:, before].any(axis=1)
                at = np.flatnonzero(mine)
                if not len(at):
                    continue
                keep = max(keep_least, int(np.ceil(keep_share * len(at))))
                if keep < len(at):
                    own = ranks[at]
                    foot = (np.maximum(own, q) - np.minimum(own, q)).sum(axis=1, dtype=np.int32)
                    at = at[np.argsort(foot, kind="stable")[:keep]]  # ties: the smaller id
                score = vec[at] @ np.frombuffer(q_vec, vec_type).astype(np.float64)
                best = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"query_id": q_id, "vec_id": ids[at][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    found = held.unionByName(put).groupBy("pivot", "rc", "qc").applyInPandas(examine, "query_id bigint, vec_id bigint, score double")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
