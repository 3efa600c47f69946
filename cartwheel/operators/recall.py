"""Recall (candidate generation) operators: content lists, hottest lists,
active users, behaviour scores, latest items, cold start.

Every operator takes DataFrames and returns a lazy DataFrame; none collects.
Anchors (newest action time) and bounded lists (a top-N) enter other plans as
scalar subqueries, never as driver-side values or cartesian products.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions import bloom
from cartwheel.functions.exprs import BEHAVIOUR_WEIGHTS, code_lookup
from cartwheel.operators.topn import global_top_n, item_counts, top_items_per_group, top_n_per_group

CONTENT_KINDS = ("city", "age", "cate", "brand")


PRODUCT_ATTRS = ("brand", "shop_id", "cate")
USER_ATTRS = ("age", "city")


def recall_input(action: DataFrame, product: DataFrame | None, user: DataFrame | None,
                 needed: Sequence[str] | None = None) -> DataFrame:
    """Action log with product attributes and user age/city (left joins).

    ``needed`` limits the joins to the dimensions whose columns are used, so
    a city list never shuffles the product table.
    """
    a = action.select("user_id", "sku_id", "type", "action_time", "event_id")
    want = set(needed) if needed is not None else set(PRODUCT_ATTRS) | set(USER_ATTRS)
    pcols = [c for c in PRODUCT_ATTRS if c in want]
    ucols = [c for c in USER_ATTRS if c in want]
    if product is not None and pcols:
        a = a.join(product.select("sku_id", *pcols), "sku_id", "left")
    if user is not None and ucols:
        a = a.join(user.select("user_id", *ucols), "user_id", "left")
    return a


def content_list(enriched: DataFrame, kind: str, n: int = 10) -> DataFrame:
    """Top-n items per value of ``kind`` (city / age / cate / brand).

    Output: (list_key, rnk, sku_id, cnt); the group value is the key, for every
    kind (the reference wrote cate lists under an age key; not reproduced).
    """
    top = top_items_per_group(enriched, kind, n)
    return top.select(F.col(kind).cast("bigint").alias("list_key"), "rnk", "sku_id", "cnt")


def content_lists(enriched: DataFrame, kinds: Sequence[str] = CONTENT_KINDS, n: int = 10) -> DataFrame:
    """All content lists in one table: (list_kind, list_key, rnk, sku_id, cnt).

    One unpivot + one aggregation instead of one job per kind.
    """
    long = enriched.select(
        "sku_id",
        F.explode(F.array(*[F.struct(F.lit(k).alias("list_kind"), F.col(k).cast("bigint").alias("list_key"))
                            for k in kinds])).alias("g"))
    long = long.select("g.list_kind", "g.list_key", "sku_id")
    return top_items_per_group(long, ["list_kind", "list_key"], n).select(
        "list_kind", "list_key", "rnk", "sku_id", "cnt")


def toplists(content: DataFrame, hottest_table: DataFrame) -> DataFrame:
    """Every published list in one table: (list_kind, list_key, rnk, sku_id, score).

    Content lists keep their kind; hottest lists become kind 'hottest' keyed by
    the window length in days.  Written whole per refresh, so a key never keeps
    stale members from an earlier refresh.
    """
    c = content.select("list_kind", "list_key", "rnk", "sku_id", F.col("cnt").alias("score"))
    h = hottest_table.select(F.lit("hottest").alias("list_kind"), F.col("days").cast("bigint").alias("list_key"),
                             "rnk", "sku_id", F.col("cnt").alias("score"))
    return c.unionByName(h)


def newest_action_time(action: DataFrame):
    """Scalar-subquery column holding max(action_time) of the log."""
    return action.select(F.max("action_time")).scalar()


def hottest(action: DataFrame, days: int, n: int = 10) -> DataFrame:
    """Top-n items of the last ``days`` days before the newest action (strict >)."""
    anchor = newest_action_time(action)
    recent = action.where(F.col("action_time") > anchor - F.expr(f"INTERVAL {int(days)} DAYS"))
    counts = item_counts(recent, None, "sku_id")
    return global_top_n(counts, [F.col("cnt").desc(), F.col("sku_id").asc()], n).select("rnk", "sku_id", "cnt")


def hottest_lists(action: DataFrame, days: Sequence[int] = (1, 7, 30), n: int = 10) -> DataFrame:
    """All hottest lists from one scan: (days, rnk, sku_id, cnt)."""
    anchor = newest_action_time(action)
    widest = max(days)
    recent = action.where(F.col("action_time") > anchor - F.expr(f"INTERVAL {int(widest)} DAYS"))
    aggs = [F.count_if(F.col("action_time") > anchor - F.expr(f"INTERVAL {int(d)} DAYS")).alias(f"c{d}")
            for d in days]
    counts = recent.where(F.col("sku_id").isNotNull()).groupBy("sku_id").agg(*aggs)
    long = counts.select("sku_id", F.explode(F.array(*[
        F.struct(F.lit(int(d)).alias("days"), F.col(f"c{d}").alias("cnt")) for d in days])).alias("w"))
    long = long.select("w.days", "sku_id", "w.cnt").where(F.col("cnt") > 0)
    return top_n_per_group(long, "days", [F.col("cnt").desc(), F.col("sku_id").asc()], n).select(
        "days", "rnk", "sku_id", "cnt")


def action_counts(action: DataFrame) -> DataFrame:
    """Actions per user (non-null sku), the reference's ``item_cnts``."""
    return (action.where(F.col("user_id").isNotNull())
            .groupBy("user_id").agg(F.count("sku_id").alias("item_cnts")))


def active_users(action: DataFrame, min_actions: int = 5) -> DataFrame:
    """Users with at least ``min_actions`` actions (the code uses >=)."""
    return action_counts(action).where(F.col("item_cnts") >= min_actions)


def active_actions(action: DataFrame, min_actions: int = 5) -> DataFrame:
    """Restrict a log to active users (semi join: no column of the filter survives)."""
    return action.join(active_users(action, min_actions).select("user_id"), "user_id", "left_semi")


def behaviour_score(type_col: str = "type"):
    return code_lookup(type_col, BEHAVIOUR_WEIGHTS)


def user_brand_score(enriched: DataFrame, min_actions: int = 5) -> DataFrame:
    """Sum of behaviour weights per (active user, brand); all-missing sums are 0.

    One pass: sums and action counts per (user, brand), without a brand too, then a user's actions as a window over those
    few rows.  No task sorts or joins the log itself."""
    sums = (enriched.where(F.col("user_id").isNotNull())
            .withColumn("score", behaviour_score())
            .groupBy("user_id", "brand")
            .agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("score"), F.count("sku_id").alias("_n")))
    actions = F.sum("_n").over(Window.partitionBy("user_id"))
    return (sums.withColumn("_actions", actions)
            .where((F.col("_actions") >= min_actions) & F.col("brand").isNotNull())
            .select("user_id", "brand", "score"))


def distinct_sets(action: DataFrame) -> DataFrame:
    """The known-user and known-item sets as one long table (set_name, id)."""
    u = action.where(F.col("user_id").isNotNull()).select(F.lit("user").alias("set_name"),
                                                           F.col("user_id").alias("id")).distinct()
    i = action.where(F.col("sku_id").isNotNull()).select(F.lit("item").alias("set_name"),
                                                          F.col("sku_id").alias("id")).distinct()
    return u.unionByName(i)


def user_item_sets(action: DataFrame) -> DataFrame:
    """Per-user item sets in long form: distinct (user_id, sku_id).

    The long form never gathers a whole user into one row, so a user holding a
    large share of the log costs no more than any other key.
    """
    return (action.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull())
            .select("user_id", "sku_id").distinct())


def latest_items(action: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` items per user (ties on time broken by event id)."""
    a = action.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull())
    top = top_n_per_group(a, "user_id", [F.col("action_time").desc(), F.col("event_id").desc()], n)
    return top.select("user_id", "rnk", "sku_id")


def latest_known_items(action: DataFrame, known_items: DataFrame, n: int = 10) -> DataFrame:
    """Latest items restricted to the known item set (hash semi join)."""
    return latest_items(action, n).join(known_items.select("sku_id").distinct(), "sku_id", "left_semi")


def cold_start_users(user: DataFrame, action: DataFrame) -> DataFrame:
    """Users in the user table with no action in the log (anti join).

    The log side is reduced to distinct user ids first (map-side partial
    aggregation), so the shuffle carries users, not actions.
    """
    seen = action.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return user.select("user_id").join(seen, "user_id", "left_anti")


def unseen_users(user: DataFrame, sketch: DataFrame, seen: DataFrame) -> DataFrame:
    """Users outside ``seen`` (user_id) by its Bloom filter: most new users are told in the scan, the rest by an exact join.

    ``sketch`` is the filter of ``functions.bloom.build`` over ``seen``; only users it cannot rule out are joined."""
    told = user.select("user_id", bloom.might_contain(F.col("user_id"), bloom.as_column(sketch)).alias("maybe"))
    maybe = told.where("maybe").select("user_id").join(seen.select("user_id"), "user_id", "left_anti")
    return told.where("not maybe or maybe is null").select("user_id").unionByName(maybe)


def cold_start_recommendations(user: DataFrame, action: DataFrame, days: int = 7, n: int = 3) -> DataFrame:
    """Each new user gets the top-n hottest items of the last ``days`` days.

    The bounded list enters as a scalar-subquery array (n elements), so the
    plan is a projection + explode over the new users, not a cartesian join.
    """
    return with_list(cold_start_users(user, action), hottest(action, days, n))


def with_list(users: DataFrame, hot: DataFrame) -> DataFrame:
    """Every user with every entry of one bounded list (rnk, sku_id, cnt)."""
    hot_arr = hot.agg(F.array_sort(F.collect_list(F.struct("rnk", "sku_id", "cnt")))).scalar()
    return (users.select("user_id", F.explode(hot_arr).alias("h"))
            .select("user_id", "h.rnk", "h.sku_id", "h.cnt"))
