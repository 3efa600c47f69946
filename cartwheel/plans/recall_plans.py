"""Registered recall queries (phase 0-1) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import bloom
from cartwheel.functions.exprs import round6
from cartwheel.operators import recall as R
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle_ctes import with_ctes
from cartwheel.session import shared_path
from cartwheel.sources import fixtures as fx

TRAIN_END = "2024-01-17"  # first test-slice boundary of the clicks log (FIXTURES.md §2)


def _enriched_clicks(spark, sf, needed=None):
    return R.recall_input(fx.clicks(spark, sf), fx.products(spark, sf), fx.users(spark, sf), needed)


# ---------------------------------------------------------------- hottest
def _hottest_sql(days: int) -> str:
    return with_ctes(["clicks"], f"""
SELECT rnk, sku_id, cnt FROM (
  SELECT CAST(row_number() OVER (ORDER BY cnt DESC, sku_id) AS BIGINT) AS rnk, sku_id, cnt
  FROM counts) t
WHERE rnk <= 10""", local=[
        ("anchor", "SELECT max(action_time) AS a FROM clicks"),
        ("counts", f"""SELECT sku_id, count(sku_id) AS cnt FROM clicks, anchor
  WHERE sku_id IS NOT NULL AND action_time > a - INTERVAL {days} DAY GROUP BY sku_id"""),
    ])


def _hottest_query(days: int):
    def q(spark, sf):
        return R.hottest(fx.clicks(spark, sf), days, 10)
    q.__name__ = f"hottest_{days}d"
    return q


for _d in (1, 7, 30):
    register(f"hottest_{_d}d", _hottest_sql(_d))(_hottest_query(_d))


# ---------------------------------------------------------------- content lists
def _content_sql(kind: str) -> str:
    return with_ctes(["enriched_clicks"], f"""
SELECT list_key, rnk, sku_id, cnt FROM (
  SELECT CAST({kind} AS BIGINT) AS list_key, sku_id, cnt,
         CAST(row_number() OVER (PARTITION BY {kind} ORDER BY cnt DESC, sku_id) AS BIGINT) AS rnk
  FROM (SELECT {kind}, sku_id, count(sku_id) AS cnt FROM enriched_clicks
        WHERE {kind} IS NOT NULL AND sku_id IS NOT NULL GROUP BY {kind}, sku_id) c) t
WHERE rnk <= 10""")


def _content_query(kind: str):
    def q(spark, sf):
        return R.content_list(_enriched_clicks(spark, sf, [kind]), kind, 10)
    q.__name__ = f"content_topn_{kind}"
    return q


for _k in R.CONTENT_KINDS:
    register(f"content_topn_{_k}", _content_sql(_k))(_content_query(_k))


# ---------------------------------------------------------------- sets, latest, cold start
@register("distinct_sets", with_ctes(["clicks"], """
SELECT DISTINCT 'user' AS set_name, user_id AS id FROM clicks WHERE user_id IS NOT NULL
UNION ALL
SELECT DISTINCT 'item' AS set_name, sku_id AS id FROM clicks WHERE sku_id IS NOT NULL"""))
def distinct_sets(spark, sf):
    return R.distinct_sets(fx.clicks(spark, sf))


@register("user_item_sets", with_ctes(["clicks"], """
SELECT DISTINCT user_id, sku_id FROM clicks WHERE user_id IS NOT NULL AND sku_id IS NOT NULL"""))
def user_item_sets(spark, sf):
    return R.user_item_sets(fx.clicks(spark, sf))


_LATEST_SQL_BODY = """
SELECT user_id, rnk, sku_id FROM (
  SELECT user_id, sku_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY action_time DESC, event_id DESC) AS BIGINT) AS rnk
  FROM clicks WHERE user_id IS NOT NULL AND sku_id IS NOT NULL) t
WHERE rnk <= 10"""


@register("latest_items", with_ctes(["clicks"], _LATEST_SQL_BODY))
def latest_items(spark, sf):
    return R.latest_items(fx.clicks(spark, sf), 10)


@register("latest_known_items", with_ctes(["clicks"], f"""
SELECT l.user_id, l.rnk, l.sku_id FROM latest l
WHERE l.sku_id IN (SELECT sku_id FROM clicks WHERE action_time < TIMESTAMP '{TRAIN_END}')""",
                                          local=[("latest", _LATEST_SQL_BODY)]))
def latest_known_items(spark, sf):
    c = fx.clicks(spark, sf)
    known = c.where(F.col("action_time") < F.lit(TRAIN_END).cast("timestamp_ntz")).select("sku_id")
    return R.latest_known_items(c, known, 10)


_COLD_SQL = with_ctes(["clicks", "users"], """
SELECT n.user_id, h.rnk, h.sku_id, h.cnt
FROM (SELECT user_id FROM users WHERE user_id NOT IN (SELECT user_id FROM clicks WHERE user_id IS NOT NULL)) n,
     hot h""", local=[
    ("anchor", "SELECT max(action_time) AS a FROM clicks"),
    ("counts", """SELECT sku_id, count(sku_id) AS cnt FROM clicks, anchor
  WHERE sku_id IS NOT NULL AND action_time > a - INTERVAL 7 DAY GROUP BY sku_id"""),
    ("hot", """SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY cnt DESC, sku_id) AS BIGINT) AS rnk,
  sku_id, cnt FROM counts) WHERE rnk <= 3"""),
])


@register("cold_start_users", _COLD_SQL)
def cold_start_users(spark, sf):
    return R.cold_start_recommendations(fx.users(spark, sf), fx.clicks(spark, sf), 7, 3)


@register("cold_start_users_filtered", _COLD_SQL)
def cold_start_users_filtered(spark, sf):
    """Cold start with the known-user set as a stored Bloom filter: the scan of users settles most of them."""
    clicks = fx.clicks(spark, sf)
    base = shared_path(spark, "known_users")
    clicks.where("user_id is not null").select("user_id").distinct().write.parquet(f"{base}/ids")
    seen = spark.read.parquet(f"{base}/ids")
    bloom.build(seen, "user_id", bloom.bits_for(seen.count())).write.parquet(f"{base}/bloom")
    new = R.unseen_users(fx.users(spark, sf), spark.read.parquet(f"{base}/bloom"), seen)
    return R.with_list(new, R.hottest(clicks, 7, 3))


# ---------------------------------------------------------------- CF inputs
@register("active_users", with_ctes(["purchases"], """
SELECT user_id, item_cnts FROM (
  SELECT user_id, count(sku_id) AS item_cnts FROM purchases WHERE user_id IS NOT NULL GROUP BY user_id) t
WHERE item_cnts >= 5"""))
def active_users(spark, sf):
    return R.active_users(fx.purchases(spark, sf), 5)


@register("user_brand_score", with_ctes(["enriched_purchases"], """
SELECT user_id, brand,
       round(CAST(coalesce(sum(CASE type WHEN 1 THEN 0.1 WHEN 2 THEN 0.5 WHEN 3 THEN 0.2
                                         WHEN 4 THEN 0.3 WHEN 5 THEN 0.4 END), 0) AS DOUBLE), 6) AS score
FROM enriched_purchases
WHERE brand IS NOT NULL
  AND user_id IN (SELECT user_id FROM purchases GROUP BY user_id HAVING count(sku_id) >= 5)
GROUP BY user_id, brand"""))
def user_brand_score(spark, sf):
    enriched = R.recall_input(fx.purchases(spark, sf), fx.products(spark, sf), None, ["brand"])
    s = R.user_brand_score(enriched, 5)
    return s.select("user_id", "brand", round6("score").alias("score"))


# ---------------------------------------------------------------- all published lists
_TOPLISTS_SQL = with_ctes(["enriched_clicks"], """
SELECT list_kind, list_key, rnk, sku_id, score FROM (
  SELECT list_kind, list_key, sku_id, cnt AS score,
         CAST(row_number() OVER (PARTITION BY list_kind, list_key ORDER BY cnt DESC, sku_id) AS BIGINT) AS rnk
  FROM (""" + "\n        UNION ALL\n".join(
    f"""SELECT '{k}' AS list_kind, CAST({k} AS BIGINT) AS list_key, sku_id, count(sku_id) AS cnt
        FROM enriched_clicks WHERE {k} IS NOT NULL AND sku_id IS NOT NULL GROUP BY {k}, sku_id"""
    for k in R.CONTENT_KINDS) + """) c) t WHERE rnk <= 10
UNION ALL
SELECT 'hottest', days, rnk, sku_id, cnt FROM (
  SELECT days, sku_id, cnt, CAST(row_number() OVER (PARTITION BY days ORDER BY cnt DESC, sku_id) AS BIGINT) AS rnk
  FROM (""" + "\n        UNION ALL\n".join(
    f"""SELECT CAST({d} AS BIGINT) AS days, sku_id, count(sku_id) AS cnt FROM enriched_clicks,
               (SELECT max(action_time) AS a FROM enriched_clicks) m
        WHERE sku_id IS NOT NULL AND action_time > a - INTERVAL {d} DAY GROUP BY sku_id"""
    for d in (1, 7, 30)) + """) h) t WHERE rnk <= 10""")


@register("toplists", _TOPLISTS_SQL)
def toplists(spark, sf):
    clicks = fx.clicks(spark, sf)
    enriched = R.recall_input(clicks, fx.products(spark, sf), fx.users(spark, sf))
    return R.toplists(R.content_lists(enriched, R.CONTENT_KINDS, 10), R.hottest_lists(clicks, (1, 7, 30), 10))
