"""Reproducible negative sampling, shuffling and exact positional splits.

Negative sampling (per user: draw m distinct items from the item list,
m = cnt + randint(-ceil(cnt/10), floor(cnt/10) + 2), clamp to [0, n], then
drop the items the user touched) without cartesian products or per-user
collections:

* items get an index 0..n-1 in md5-shuffled order (exact distributed rank);
* user u walks the affine permutation i -> (a_u·i + b_u) mod n for
  i = 0..m_u-1, which visits m_u *distinct* indices.  a_u is a prime above
  2^40 (hence coprime with any realistic n) reduced mod n; a_u, b_u and the
  randint draw come from md5 of (seed, tag, user), so Spark and the SQL
  oracle compute the same sample;
* the draws are generated in chunks spread over tasks, so a user holding a
  third of the log does not generate its sample in one task.

Positional split (first K rows of a shuffle go to train): exact via
histograms of the shuffle hash's bits, two levels of 16 bits; only the one
boundary bucket left at the end is ranked, and it holds ~N / 2^32 rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import h64
from cartwheel.functions.ranking import sorted_index
from cartwheel.session import ensure_checkpoint_dir

N_STEP_PRIMES = 256
DRAW_CHUNK = 100_000
SPLIT_BUCKET_BITS = 16


def _is_prime(n: int) -> bool:
    if n < 2:
        return False
    small = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
    for q in small:
        if n % q == 0:
            return n == q
    d, s = n - 1, 0
    while d % 2 == 0:
        d //= 2
        s += 1
    for a in small:  # deterministic for n < 3.3e24
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


@functools.lru_cache(maxsize=1)
def step_primes() -> tuple[int, ...]:
    """The first N_STEP_PRIMES primes above 2^40 (permutation steps)."""
    out, c = [], (1 << 40) + 1
    while len(out) < N_STEP_PRIMES:
        if _is_prime(c):
            out.append(c)
        c += 2
    return tuple(out)


def _tagged_hash(seed, tag: str, *cols) -> Column:
    return h64(F.lit(str(seed)), F.lit(tag), *cols)


def item_index(items: DataFrame, seed: int = 42) -> DataFrame:
    """(sku_id, idx): distinct items numbered 0..n-1 in md5-shuffled order."""
    d = items.where(F.col("sku_id").isNotNull()).select("sku_id").distinct()
    d = d.withColumn("_h", _tagged_hash(seed, "item", "sku_id"))
    return sorted_index(d, ["_h", "sku_id"], index_col="idx", settle=True).select("sku_id", "idx")


def sample_sizes(action: DataFrame, n_items: Column, seed: int = 42) -> DataFrame:
    """(user_id, cnt, m, a, b) per user; m clamped to [0, n]."""
    cnt = action.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    lo = F.floor(-F.col("cnt") / 10)
    hi = F.floor(F.col("cnt") / 10) + 2
    draw = lo + F.pmod(_tagged_hash(seed, "m", "user_id"), hi - lo + 1)
    m = F.least(F.greatest(F.col("cnt") + draw, F.lit(0)), n_items)
    primes = F.array(*[F.lit(p) for p in step_primes()])
    has_items = n_items > 0  # an empty item list draws nothing (and must not divide by zero)
    a = F.when(has_items, F.pmod(F.element_at(primes, (F.pmod(_tagged_hash(seed, "a", "user_id"),
                                                              F.lit(N_STEP_PRIMES)) + 1).cast("int")), n_items))
    b = F.when(has_items, F.pmod(_tagged_hash(seed, "b", "user_id"), n_items))
    return cnt.select("user_id", "cnt", m.cast("bigint").alias("m"), a.alias("a"), b.alias("b"))


def chunked_positions(params: DataFrame, count_col: str = "m", chunk: int = DRAW_CHUNK,
                      partitions: int | None = None) -> DataFrame:
    """Explode 0..count-1 per row, in chunks redistributed across tasks."""
    spark = params.sparkSession
    parts = partitions or max(8, spark.sparkContext.defaultParallelism * 2)
    chunks = (params.where(F.col(count_col) > 0)
              .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                         F.floor((F.col(count_col) - 1) / chunk).cast("bigint")))))
    chunks = chunks.repartition(parts, "user_id", "_chunk")
    lo = F.col("_chunk") * chunk
    hi = F.least(lo + chunk, F.col(count_col)) - 1
    return chunks.withColumn("i", F.explode(F.sequence(lo, hi))).drop("_chunk")


def negative_samples(action: DataFrame, seed: int = 42, chunk: int = DRAW_CHUNK) -> DataFrame:
    """Negatives (user_id, sku_id, label=0): the sample minus the user's items."""
    idx = item_index(action.select("sku_id"), seed)
    n_items = idx.agg(F.count(F.lit(1))).scalar()
    params = sample_sizes(action, n_items, seed)
    pos = chunked_positions(params, chunk=chunk)
    pos = pos.select("user_id", F.pmod(F.col("a") * F.col("i") + F.col("b"), n_items).alias("idx"))
    drawn = pos.join(idx, "idx").select("user_id", "sku_id")
    touched = action.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull()).select("user_id", "sku_id")
    return (drawn.join(touched.distinct(), ["user_id", "sku_id"], "left_anti")
            .withColumn("label", F.lit(0).cast("tinyint")))


def shuffle_key(df: DataFrame, cols, seed: int = 42, name: str = "_shuffle") -> DataFrame:
    """Attach the md5 shuffle key (the order of a reproducible full shuffle)."""
    return df.withColumn(name, _tagged_hash(seed, "shuffle", *cols))


def split_first_k(df: DataFrame, k: int | None, key_cols, seed: int = 42, bucket_bits: int = SPLIT_BUCKET_BITS,
                  levels: int = 2, head: str = "train", rest: str = "test", part_col: str = "part", share: float = 0.5) -> DataFrame:
    """Label the first ``k`` rows in shuffle order ``head`` and the others ``rest``; without ``k`` that is
    ``share`` of the counted rows, rounded down.

    Exact and bounded: at each level the still-undecided rows are counted per
    bucket of the next ``bucket_bits`` hash bits (at most 2^bucket_bits
    counts); the one bucket holding the k-th row (one row comes back to the
    driver) is all that is carried to the next level.  After ``levels``
    levels (2 × 16 bits: about N / 2^32 rows left) that bucket is ranked by
    (hash, keys).  Rows must be unique on ``key_cols`` for a total order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # every level scans the input again: freeze it once instead of recomputing its lineage
    keyed = shuffle_key(df, key_cols, seed).checkpoint(eager=True)
    if k is None:
        k = int(keyed.count() * share)
    rules: list[tuple[Column, str]] = []
    inside = F.lit(True)          # rows in the boundary bucket of every level so far
    before = 0                    # rows in shuffle order ahead of that bucket
    last_bits = 0
    for level in range(levels):
        shift = 60 - bucket_bits * (level + 1)
        bkt = F.shiftright("_shuffle", shift).bitwiseAND(F.lit((1 << bucket_bits) - 1))
        counts = keyed.where(inside).groupBy(bkt.alias("_bkt")).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)  # ≤ 2^bits rows
        cum = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)) + F.lit(before))
        hit = cum.where((F.col("_before") < k) & (F.col("_before") + F.col("_n") >= k)) \
            .select("_bkt", "_before").first()
        if hit is None:
            # every pooled row fits (k beyond them) or none does (k already reached)
            rules.append((inside, head if before < k else rest))
            inside = F.lit(False)
            break
        rules.append((inside & (bkt < hit["_bkt"]), head))
        rules.append((inside & (bkt > hit["_bkt"]), rest))
        inside = inside & (bkt == hit["_bkt"])
        before = int(hit["_before"])
        last_bits = bucket_bits * (level + 1)
    label = None
    for cond, name in rules:
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    decided = keyed.withColumn(part_col, label)
    settled = decided.where(F.col(part_col).isNotNull())
    last = decided.where(F.col(part_col).isNull())
    rw = Window.partitionBy(F.shiftright("_shuffle", 60 - max(last_bits, 1))).orderBy("_shuffle", *key_cols)
    last = (last.withColumn("_r", F.row_number().over(rw))
            .withColumn(part_col, F.when(F.col("_r") + before <= k, head).otherwise(rest)).drop("_r"))
    return settled.unionByName(last).drop("_shuffle")


def split_fraction(df: DataFrame, fraction: float, key_cols, seed: int = 42, head: str = "train",
                   rest: str = "test", part_col: str = "part") -> DataFrame:
    """Approximate positional split: rows whose shuffle hash falls in the first
    ``fraction`` of the hash range go to ``head``.  One projection, no
    aggregation — the scalable default when an exact count is not required."""
    cut = int(fraction * (1 << 60))
    keyed = shuffle_key(df, key_cols, seed)
    return keyed.withColumn(part_col, F.when(F.col("_shuffle") < F.lit(cut), head).otherwise(rest)).drop("_shuffle")


def train_test_with_negatives(train_pos: DataFrame, test_pos: DataFrame, negatives: DataFrame,
                              n_train_negatives: int | None = 30_000_000, seed: int = 42, share: float = 0.5) -> DataFrame:
    """(user_id, sku_id, label, part): positives keep duplicates (label 1),
    the first ``n_train_negatives`` shuffled negatives (without a number: that ``share`` of them) join train, the rest test."""
    neg = split_first_k(negatives.select("user_id", "sku_id", "label"), n_train_negatives,
                        ["user_id", "sku_id"], seed, share=share)
    tp = train_pos.select("user_id", "sku_id", F.lit(1).cast("tinyint").alias("label"), F.lit("train").alias("part"))
    sp = test_pos.select("user_id", "sku_id", F.lit(1).cast("tinyint").alias("label"), F.lit("test").alias("part"))
    return tp.unionByName(sp).unionByName(neg.select("user_id", "sku_id", "label", "part"))
