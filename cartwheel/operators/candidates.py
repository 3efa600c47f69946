"""Per-user candidate generation from the recall tables.

Everything is set-based over all users at once: the online path of the
reference (one user per request) is the same plan restricted by a semi join
with the incoming requests (see ``cartwheel.streaming.candidates``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import fixed, h64, unfixed
from cartwheel.operators.topn import top_n_per_group


_LIST = 256           # neighbours in a list; longer ones are cut
_PAIRS = 1 << 21      # (user, candidate) pairs added up at once


def _pair_sums(user: np.ndarray, item: np.ndarray, score: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of scores, and whether seen, by (user, item), in order."""
    least, span = int(item.min()), int(item.max()) - int(item.min()) + 1
    if span * (int(user.max()) + 1) < 1 << 62:
        order = np.argsort(user.astype(np.int64) * span + (item - least))
    else:
        order = np.lexsort((item, user))
    user, item = user[order], item[order]
    first = np.flatnonzero(np.concatenate(([True], (user[1:] != user[:-1]) | (item[1:] != item[:-1]))))
    return user[first], item[first], np.add.reduceat(score[order], first), np.logical_or.reduceat(seen[order], first)


def _best_unseen(n: int):
    """Rows (user_id, sku_id, cands, scores), a user's one after the other -> (user_id, rnk, cand, score)."""
    def best(names: list, user: np.ndarray, item: np.ndarray, score: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        user, item, score = user[~seen], item[~seen], score[~seen]
        ends, kept, rank = np.searchsorted(user, np.arange(len(names) + 1)), [], []
        for lo, hi in zip(ends, ends[1:], strict=False):
            at = np.arange(lo, hi)
            if hi - lo > n:
                at = at[score[lo:hi] >= np.partition(score[lo:hi], hi - lo - n)[hi - lo - n]]      # and all that tie with the last
            kept.append(at[np.lexsort((item[at], -score[at]))][:n])
            rank.append(np.arange(1, len(kept[-1]) + 1))
        if kept:
            at = np.concatenate(kept)
            yield pa.record_batch([pa.array(names, pa.int64()).take(pa.array(user[at])), pa.array(np.concatenate(rank), pa.int64()), pa.array(item[at]), pa.array(score[at])], ["user_id", "rnk", "cand", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts, size = [], [], 0           # of users so far; (user, item, score, seen) arrays, users by number

        def added(parts: list) -> tuple[np.ndarray, ...]:
            return _pair_sums(*[np.concatenate(x) for x in zip(*parts, strict=True)])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists, nobody = batch.column("cands"), batch.column("user_id").is_null().to_numpy(zero_copy_only=False)
            who = batch.column("user_id").fill_null(0).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (who[1:] != who[:-1]) | (nobody[1:] != nobody[:-1]))))
            told = [None if nobody[k] else int(who[k]) for k in starts]
            new = np.concatenate(([not names or names[-1] != told[0]], np.ones(len(starts) - 1, bool)))
            code = np.repeat(np.cumsum(new) - 1, np.diff(np.append(starts, len(who)))) + len(names)
            names += [x for x, fresh in zip(told, new, strict=True) if fresh]
            many = lists.value_lengths().fill_null(0).to_numpy()
            cands, scores = lists.flatten().to_numpy(), batch.column("scores").flatten().to_numpy()
            parts += [(code, batch.column("sku_id").to_numpy(), np.zeros(len(who), np.int64), ~nobody),       # rows without a user have seen nothing
                      (np.repeat(code, many), cands, scores, np.zeros(len(cands), bool))]
            size += len(cands) + len(who)
            if size >= _PAIRS:                   # the last user may go on
                user, *rest = added(parts)
                cut = int(np.searchsorted(user, len(names) - 1))
                yield from best(names[:-1], user[:cut], *[x[:cut] for x in rest])
                names, parts = names[-1:], [(user[cut:] * 0, *[x[cut:] for x in rest])]
                size = len(user) - cut if 2 * (len(user) - cut) < _PAIRS else 0      # a user of very many items: as many again before the next sum
        if names:
            yield from best(names, *added(parts))

    return run


def user_topn_cf(history: DataFrame, item_sim: DataFrame, n: int = 20) -> DataFrame:
    """Item-item CF: score(u, j) = Σ_{i ∈ H(u)} sim(i, j), j ∉ H(u); top-n per user.

    An item's neighbours travel to its users as packed lists (of ``_LIST`` at most), once; a task adds them up for some users at
    a time and keeps n of each.  Sums are in fixed point, so equal sums tie whatever the order of their terms.
    """
    h = history.select(F.col("user_id").cast("bigint").alias("user_id"), F.col("sku_id").cast("bigint").alias("sku_id")).distinct()
    sim = item_sim.where("sku1 is not null and sku2 is not null").select(F.col("sku1").cast("bigint").alias("sku_id"), F.col("sku2").cast("bigint").alias("sku2"), fixed(F.col("sim")).alias("score"))
    lists = sim.groupBy("sku_id").agg(F.array_sort(F.collect_list(F.struct("score", "sku2"))).alias("all"))
    lists = lists.select("sku_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("all"), F.lit(_LIST)), lambda k: F.slice("all", k, _LIST))).alias("all"))
    met = (h.where("sku_id is not null").join(lists, "sku_id", "left").select("user_id", "sku_id", F.col("all.sku2").alias("cands"), F.col("all.score").alias("scores"))
           .repartition("user_id").sortWithinPartitions("user_id"))
    top = met.mapInArrow(_best_unseen(n), "user_id bigint, rnk bigint, cand bigint, score bigint")
    return top.select("user_id", "rnk", F.col("cand").alias("sku_id"), unfixed(F.col("score")).alias("score"))


def seed_brands(seeds: DataFrame, product: DataFrame, decay: float | None = None) -> DataFrame:
    """Brands of each user's seed items; with ``decay`` each seed item weighs
    decay^(rnk-1) (rnk = recency rank), otherwise each distinct brand weighs 1."""
    sb = seeds.select("user_id", "sku_id", "rnk").join(product.select("sku_id", "brand"), "sku_id")
    sb = sb.where(F.col("brand").isNotNull())
    if decay is None:
        return sb.select("user_id", "brand").distinct().withColumn("w", F.lit(1.0))
    return (sb.groupBy("user_id", "brand")
            .agg(unfixed(F.sum(fixed(F.pow(F.lit(float(decay)), F.col("rnk") - 1)))).alias("w")))


def cf_brands(seeds: DataFrame, product: DataFrame, brand_sim: DataFrame, k: int = 10,
              decay: float | None = None) -> DataFrame:
    """Top-k brands per user by Σ w · sim(seed brand, brand), positive sums only."""
    sb = seed_brands(seeds, product, decay)
    s = (sb.join(brand_sim.select(F.col("brand1").alias("brand"), "brand2", "sim"), "brand")
         .groupBy("user_id", "brand2")
         .agg(F.sum(fixed(F.col("w") * F.col("sim"))).alias("score"))
         .where(F.col("score") > 0))
    top = top_n_per_group(s, "user_id", [F.col("score").desc(), F.col("brand2").asc()], k)
    return top.select("user_id", "rnk", F.col("brand2").alias("brand"), unfixed(F.col("score")).alias("score"))


def online_cf(seeds: DataFrame, product: DataFrame, brand_sim: DataFrame, brand_lists: DataFrame,
              k: int = 10, per_brand: int = 10, seed: int = 7, sample: bool = True) -> DataFrame:
    """Brand-CF candidates: top-k brands -> their most popular items -> k items.

    ``sample``: the k picks from the pooled items are md5-ordered per user (a
    reproducible sample without replacement, as the reference samples);
    otherwise they are ranked by brand score, then by the item's rank in its
    brand list.  A pool smaller than k is taken whole.
    """
    return pick_from_brands(cf_brands(seeds, product, brand_sim, k), brand_lists, k, per_brand, seed, sample)


def pick_from_brands(top: DataFrame, brand_lists: DataFrame, k: int = 10, per_brand: int = 10, seed: int = 7, sample: bool = True) -> DataFrame:
    """``k`` items per user from the lists of the user's ``top`` brands (user_id, brand, score)."""
    lists = (brand_lists.where(F.col("rnk") <= per_brand)
             .select(F.col("list_key").alias("brand"), "sku_id", F.col("rnk").alias("item_rnk")))
    pool = (top.select("user_id", "brand", "score").join(lists, "brand")
            .groupBy("user_id", "sku_id").agg(F.max("score").alias("score"), F.min("item_rnk").alias("item_rnk")))
    if sample:
        order = [h64(F.lit(seed), "user_id", "sku_id").asc(), F.col("sku_id").asc()]
    else:
        order = [F.col("score").desc(), F.col("item_rnk").asc(), F.col("sku_id").asc()]
    picked = top_n_per_group(pool, "user_id", order, k)
    return picked.select("user_id", "rnk", "sku_id")


def candidates_union(users: DataFrame, user_attrs: DataFrame, content: DataFrame, hot: DataFrame,
                     cf: DataFrame, n: int = 10) -> DataFrame:
    """Union of city, age, hottest-day and CF candidates per user, deduplicated.

    ``content`` = content_lists table (list_kind, list_key, rnk, sku_id);
    ``hot`` = one hottest list (rnk, sku_id), bounded by n, enters as a
    scalar-subquery array; provenance = sorted distinct channel names.
    """
    u = users.select("user_id").distinct().join(user_attrs.select("user_id", "city", "age"), "user_id", "left")
    lists = content.where(F.col("rnk") <= n)
    by_city = (u.select("user_id", F.col("city").cast("bigint").alias("list_key"))
               .join(lists.where(F.col("list_kind") == "city").select("list_key", "sku_id"), "list_key")
               .select("user_id", "sku_id", F.lit("city").alias("channel")))
    by_age = (u.select("user_id", F.col("age").cast("bigint").alias("list_key"))
              .join(lists.where(F.col("list_kind") == "age").select("list_key", "sku_id"), "list_key")
              .select("user_id", "sku_id", F.lit("age").alias("channel")))
    hot_arr = hot.where(F.col("rnk") <= n).agg(F.collect_list("sku_id")).scalar()
    by_hot = u.select("user_id", F.explode(hot_arr).alias("sku_id"), F.lit("hot").alias("channel"))
    by_cf = cf.select("user_id", "sku_id", F.lit("cf").alias("channel"))
    allc = by_city.unionByName(by_age).unionByName(by_hot).unionByName(by_cf)
    return (allc.groupBy("user_id", "sku_id")
            .agg(F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("channels")))


def candidate_payload(encoded: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """One message per user: "<user>:" then one tab-separated row per candidate.

    The rows of a user are bounded by the candidate lists (4 channels × n).
    """
    row = F.concat_ws("\t", *[F.col(c).cast("string") for c in feature_cols], F.col("item_id").cast("string"))
    per = encoded.select("user_id", "item_id", row.alias("row"))
    agg = per.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "row"))).alias("rows"))
    return agg.select("user_id", F.concat(F.col("user_id").cast("string"), F.lit(":\n"),
                                          F.array_join(F.transform("rows", lambda r: r["row"]), "\n"),
                                          F.lit("\n")).alias("payload"))


# ---------------------------------------------------------------- FM scoring
def hashed_fm_weights(feature_ids: DataFrame, factors: int = 4, seed: int = 11) -> DataFrame:
    """Deterministic FM weights per feature id (for scoring checks):
    w = (h % 2001 - 1000) / 10000, v_f likewise.  Output (feature_id, w, v)."""
    def small(*parts):
        return (F.pmod(h64(*parts), F.lit(2001)) - 1000) / 10000.0
    fid = feature_ids.select(F.col("feature_id").cast("bigint").alias("feature_id")).distinct()
    return fid.select("feature_id", small(F.lit(seed), F.lit("w"), "feature_id").alias("w"),
                      F.array(*[small(F.lit(seed), F.lit("v"), "feature_id", F.lit(f)) for f in range(factors)])
                      .alias("v"))


def fm_scores(encoded: DataFrame, feature_cols: Sequence[str], weights: DataFrame, bias: float = 0.0) -> DataFrame:
    """score = w0 + Σ w_i + ½ Σ_f [(Σ_i v_if)² − Σ_i v_if²] for one-hot rows.

    Rows are unpivoted to (user, item, field, feature), joined once with the
    weight table (feature ids missing from it weigh 0) and gathered per
    (user, item) in field order; the factors stay arrays, and all sums run in
    field order, so a score does not depend on the physical plan.
    """
    one = F.array(*[F.struct(F.lit(k).alias("field"), F.col(c).cast("bigint").alias("feature_id")) for k, c in enumerate(feature_cols)])
    long = encoded.select("user_id", "item_id", F.explode(one).alias("x")).select("user_id", "item_id", "x.field", "x.feature_id")
    own = (long.join(weights.select("feature_id", "w", "v"), "feature_id", "left").where("w is not null")
           .groupBy("user_id", "item_id").agg(F.array_sort(F.collect_list(F.struct("field", "w", "v"))).alias("own")))
    rows = encoded.select("user_id", "item_id").distinct().join(own, ["user_id", "item_id"], "left")
    zero = F.lit(0.0)

    def add(s, x):
        return F.zip_with(s, x["v"], lambda a, b: F.coalesce(a, zero) + F.coalesce(b, zero))

    def add_squares(s, x):
        return F.zip_with(s, x["v"], lambda a, b: F.coalesce(a, zero) + F.coalesce(b * b, zero))

    nothing = F.array().cast("array<double>")
    lin = F.aggregate("own", zero, lambda s, x: s + x["w"])
    pair = F.aggregate(F.zip_with(F.aggregate("own", nothing, add), F.aggregate("own", nothing, add_squares), lambda a, b: a * a - b), zero, lambda s, x: s + x)
    return rows.select("user_id", "item_id", (F.lit(float(bias)) + F.coalesce(lin, zero) + 0.5 * F.coalesce(pair, zero)).alias("score"))


def rank_by_score(scores: DataFrame, n: int = 3) -> DataFrame:
    """Final ranking: top-n items per user by score (ties: smaller item id)."""
    top = top_n_per_group(scores, "user_id", [F.col("score").desc(), F.col("item_id").asc()], n)
    return top.select("user_id", "rnk", "item_id", "score")
