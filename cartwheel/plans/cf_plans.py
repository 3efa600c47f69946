"""Registered CF and candidate queries (phases 4-5) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions.exprs import round6
from cartwheel.operators import candidates as C
from cartwheel.operators import encode as E
from cartwheel.operators import models as M
from cartwheel.operators import recall as R
from cartwheel.operators import similarity as S
from cartwheel.operators import topk_graph as T
from cartwheel.plans.catalog import register
from cartwheel.plans.encode_plans import _dict_ctes, train_dictionary
from cartwheel.plans.oracle_ctes import define, fixed_sql, h64_sql, unfixed_sql, with_ctes
from cartwheel.schemas import FEATURE_COLUMNS
from cartwheel.session import shared_path
from cartwheel.sources import fixtures as fx

# ---------------------------------------------------------------- oracle building blocks
define("active_purchases", ["purchases"], """
  SELECT * FROM purchases WHERE user_id IN
    (SELECT user_id FROM purchases WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(sku_id) >= 5)""")
define("active_clicks", ["clicks"], """
  SELECT * FROM clicks WHERE user_id IN
    (SELECT user_id FROM clicks WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(sku_id) >= 5)""")


def _cosine_sql(inc_sql: str, a: str, b: str) -> list[tuple[str, str]]:
    return [
        (f"{a}_inc", inc_sql),
        (f"{a}_deg", f"SELECT e, count(*) AS n FROM {a}_inc GROUP BY e"),
        (f"{a}_co", f"""SELECT x.e AS e1, y.e AS e2, count(*) AS co FROM {a}_inc x JOIN {a}_inc y
  ON x.u = y.u AND x.e <> y.e GROUP BY x.e, y.e"""),
        (f"{a}_sim", f"""SELECT c.e1 AS {b}1, c.e2 AS {b}2, c.co, c.co / sqrt(d1.n * d2.n) AS sim
  FROM {a}_co c JOIN {a}_deg d1 ON d1.e = c.e1 JOIN {a}_deg d2 ON d2.e = c.e2"""),
    ]


_BRAND_P = _cosine_sql("""SELECT DISTINCT a.user_id AS u, CAST(p.brand AS BIGINT) AS e
  FROM active_purchases a JOIN products p ON a.sku_id = p.sku_id WHERE p.brand IS NOT NULL""", "bp", "brand")
_BRAND_C = _cosine_sql("""SELECT DISTINCT a.user_id AS u, CAST(p.brand AS BIGINT) AS e
  FROM active_clicks a JOIN products p ON a.sku_id = p.sku_id WHERE p.brand IS NOT NULL""", "bc", "brand")
_ITEM_C = _cosine_sql("""SELECT DISTINCT user_id AS u, sku_id AS e FROM active_clicks
  WHERE sku_id IS NOT NULL""", "ic", "sku")

_LATEST = ("latest", """SELECT user_id, sku_id, rnk FROM (
  SELECT user_id, sku_id, row_number() OVER (PARTITION BY user_id ORDER BY action_time DESC, event_id DESC) AS rnk
  FROM clicks WHERE user_id IS NOT NULL AND sku_id IS NOT NULL) t WHERE rnk <= 10""")
_BRAND_LISTS = ("brand_lists", """SELECT list_key, sku_id, rnk FROM (
  SELECT CAST(brand AS BIGINT) AS list_key, sku_id, cnt,
         row_number() OVER (PARTITION BY brand ORDER BY cnt DESC, sku_id) AS rnk
  FROM (SELECT brand, sku_id, count(sku_id) AS cnt FROM enriched_clicks
        WHERE brand IS NOT NULL AND sku_id IS NOT NULL GROUP BY brand, sku_id) c) t WHERE rnk <= 10""")


def _cf_brand_sql(decay: float | None) -> list[tuple[str, str]]:
    w = "1.0" if decay is None else f"pow({decay}, l.rnk - 1)"
    seeds = ("SELECT DISTINCT l.user_id, CAST(p.brand AS BIGINT) AS brand, 1.0 AS w" if decay is None else
             f"SELECT l.user_id, CAST(p.brand AS BIGINT) AS brand, {unfixed_sql(f'sum({fixed_sql(w)})')} AS w")
    tail = "" if decay is None else " GROUP BY l.user_id, p.brand"
    name = "cfb" if decay is None else "cfd"
    return [
        (f"{name}_seed", f"""{seeds}
  FROM latest l JOIN products p ON l.sku_id = p.sku_id WHERE p.brand IS NOT NULL{tail}"""),
        (f"{name}_score", f"""SELECT s.user_id, b.brand2, sum({fixed_sql("s.w * b.sim")}) AS score
  FROM {name}_seed s JOIN bc_sim b ON b.brand1 = s.brand GROUP BY s.user_id, b.brand2"""),
        (f"{name}_top", f"""SELECT user_id, brand2 AS brand, score, rnk FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, brand2) AS rnk
  FROM {name}_score WHERE score > 0) t WHERE rnk <= 10"""),
    ]


_ONLINE_CF = _BRAND_C + [_LATEST, _BRAND_LISTS] + _cf_brand_sql(None) + [
    ("cf_pool", """SELECT DISTINCT t.user_id, l.sku_id FROM cfb_top t JOIN brand_lists l ON l.list_key = t.brand"""),
    ("cf_pick", f"""SELECT user_id, sku_id, rnk FROM (
  SELECT user_id, sku_id,
         row_number() OVER (PARTITION BY user_id ORDER BY {h64_sql("7", "user_id", "sku_id")}, sku_id) AS rnk
  FROM cf_pool) t WHERE rnk <= 10"""),
]

_CANDIDATES = _ONLINE_CF + [
    ("content", """SELECT list_kind, list_key, sku_id FROM (
  SELECT list_kind, list_key, sku_id,
         row_number() OVER (PARTITION BY list_kind, list_key ORDER BY cnt DESC, sku_id) AS rnk
  FROM (SELECT 'city' AS list_kind, CAST(city AS BIGINT) AS list_key, sku_id, count(sku_id) AS cnt
        FROM enriched_clicks WHERE city IS NOT NULL AND sku_id IS NOT NULL GROUP BY city, sku_id
        UNION ALL
        SELECT 'age', CAST(age AS BIGINT), sku_id, count(sku_id)
        FROM enriched_clicks WHERE age IS NOT NULL AND sku_id IS NOT NULL GROUP BY age, sku_id) c) t
  WHERE rnk <= 10"""),
    ("hot", """SELECT sku_id FROM (
  SELECT sku_id, row_number() OVER (ORDER BY cnt DESC, sku_id) AS rnk FROM (
    SELECT sku_id, count(sku_id) AS cnt FROM clicks, (SELECT max(action_time) AS a FROM clicks) m
    WHERE sku_id IS NOT NULL AND action_time > a - INTERVAL 1 DAY GROUP BY sku_id) c) t WHERE rnk <= 10"""),
    ("cu", """SELECT DISTINCT c.user_id, u.city, u.age FROM clicks c LEFT JOIN users u ON c.user_id = u.user_id
  WHERE c.user_id IS NOT NULL"""),
    ("cand_all", """
  SELECT cu.user_id, ct.sku_id, 'city' AS channel FROM cu JOIN content ct ON ct.list_kind = 'city' AND ct.list_key = cu.city
  UNION ALL
  SELECT cu.user_id, ct.sku_id, 'age' FROM cu JOIN content ct ON ct.list_kind = 'age' AND ct.list_key = cu.age
  UNION ALL
  SELECT cu.user_id, h.sku_id, 'hot' FROM cu, hot h
  UNION ALL
  SELECT user_id, sku_id, 'cf' FROM cf_pick"""),
    ("cands", """SELECT user_id, sku_id, array_to_string(list_sort(list_distinct(list(channel))), ',') AS channels
  FROM cand_all GROUP BY user_id, sku_id"""),
]

_ENCODED = _dict_ctes(FEATURE_COLUMNS) + _CANDIDATES + [
    ("cwide", """SELECT c.user_id, c.sku_id,
  coalesce(u.age, 0) AS age, coalesce(u.sex, 0) AS sex, coalesce(u.city, 0) AS city, coalesce(u.county, 0) AS county,
  coalesce(p.brand, 0) AS brand, coalesce(p.shop_id, 0) AS shop_id, coalesce(p.cate, 0) AS cate
  FROM (SELECT DISTINCT user_id, sku_id FROM cands) c
  LEFT JOIN products p ON c.sku_id = p.sku_id LEFT JOIN users u ON c.user_id = u.user_id"""),
    ("encoded", "SELECT cw.user_id, cw.sku_id AS item_id, " + ", ".join(
        f"CAST(coalesce(d{i}.feature_id, (SELECT sum(size) FROM dfields) + {i}) AS BIGINT) AS f_{c}"
        for i, c in enumerate(FEATURE_COLUMNS)) + "\n  FROM cwide cw\n  " + "\n  ".join(
        f"LEFT JOIN dict d{i} ON d{i}.field_id = {i} AND d{i}.value = CAST(cw.{c} AS BIGINT)"
        for i, c in enumerate(FEATURE_COLUMNS))),
]


# ---------------------------------------------------------------- Spark building blocks
BLOCK = 12  # entities a block: the tables have 25 brands and 100 clicked items, which so take several blocks


def _brand_sim_clicks(spark, sf):
    enriched = R.recall_input(fx.clicks(spark, sf), fx.products(spark, sf), None, ["brand"])
    return S.brand_similarity(R.active_actions(enriched, 5), block_size=BLOCK)


def _online_cf(spark, sf, k=10):
    clicks = fx.clicks(spark, sf)
    product = fx.products(spark, sf)
    enriched = R.recall_input(clicks, product, None, ["brand"])
    seeds = R.latest_items(clicks, 10)
    brand_lists = R.content_list(enriched, "brand", 10)
    return C.online_cf(seeds, product, _brand_sim_clicks(spark, sf), brand_lists, k=k)


def _candidates(spark, sf):
    clicks = fx.clicks(spark, sf)
    users = fx.users(spark, sf)
    enriched = R.recall_input(clicks, None, users, ["city", "age"])
    content = R.content_lists(enriched, ("city", "age"), 10)
    hot = R.hottest(clicks, 1, 10)
    return C.candidates_union(clicks, users, content, hot, _online_cf(spark, sf), 10)


def _encoded(spark, sf):
    d = train_dictionary(spark, sf)
    return E.encode_candidates(_candidates(spark, sf), fx.products(spark, sf), fx.users(spark, sf), d, unseen="keep"), d


# ---------------------------------------------------------------- registered queries
@register("brand_similarity", with_ctes(["active_purchases", "products"], """
SELECT brand1, brand2, co, round(sim, 6) AS sim FROM bp_sim""", local=_BRAND_P))
def brand_similarity(spark, sf):
    enriched = R.recall_input(fx.purchases(spark, sf), fx.products(spark, sf), None, ["brand"])
    s = S.brand_similarity(R.active_actions(enriched, 5), block_size=BLOCK)
    return s.select("brand1", "brand2", "co", round6("sim").alias("sim"))


@register("item_similarity", with_ctes(["active_clicks"], """
SELECT sku1, sku2, co, round(sim, 6) AS sim FROM ic_sim""", local=_ITEM_C))
def item_similarity(spark, sf):
    s = S.item_similarity(R.active_actions(fx.clicks(spark, sf), 5), block_size=BLOCK)
    return s.select("sku1", "sku2", "co", round6("sim").alias("sim"))


@register("user_topn_cf", with_ctes(["active_clicks"], """
SELECT user_id, CAST(rnk AS BIGINT) AS rnk, cand AS sku_id, round(score / 17592186044416.0, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, cand) AS rnk FROM fresh) t
WHERE rnk <= 20""", local=_ITEM_C + [
    ("hist", "SELECT DISTINCT user_id, sku_id FROM clicks WHERE user_id IS NOT NULL AND sku_id IS NOT NULL"),
    ("scored", f"""SELECT h.user_id, s.sku2 AS cand, sum({fixed_sql("s.sim")}) AS score
  FROM hist h JOIN ic_sim s ON h.sku_id = s.sku1 GROUP BY h.user_id, s.sku2"""),
    ("fresh", """SELECT * FROM scored x WHERE NOT EXISTS
  (SELECT 1 FROM hist h WHERE h.user_id = x.user_id AND h.sku_id = x.cand)"""),
]))
def user_topn_cf(spark, sf):
    clicks = fx.clicks(spark, sf)
    sim = S.item_similarity(R.active_actions(clicks, 5), block_size=BLOCK)
    top = C.user_topn_cf(clicks, sim, 20)
    return top.select("user_id", "rnk", "sku_id", round6("score").alias("score"))


GRAPH_K = 50
_ITEM_P = _cosine_sql("""SELECT DISTINCT user_id AS u, sku_id AS e FROM active_purchases
  WHERE sku_id IS NOT NULL""", "ip", "sku") + [("ip_graph", f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY sku1 ORDER BY sim DESC, sku2) AS rnk FROM ip_sim) t WHERE rnk <= {GRAPH_K}""")]


def _purchase_graph(spark, sf):
    """The item graph of the purchase log: every item's 50 most similar items."""
    bought = R.active_actions(fx.purchases(spark, sf), 5)
    return T.topk_cosine(bought.select(F.col("user_id").alias("user"), F.col("sku_id").alias("entity")), k=GRAPH_K)


@register("item_similarity_topk", with_ctes(["active_purchases"], """
SELECT sku1, sku2, CAST(rnk AS BIGINT) AS rnk, co, round(sim, 6) AS sim FROM ip_graph""", local=_ITEM_P))
def item_similarity_topk(spark, sf):
    g = _purchase_graph(spark, sf)
    return g.select(F.col("e1").alias("sku1"), F.col("e2").alias("sku2"), "rnk", "co", round6("sim").alias("sim"))


@register("user_topn_cf_graph", with_ctes(["active_purchases"], """
SELECT user_id, CAST(rnk AS BIGINT) AS rnk, cand AS sku_id, round(score / 17592186044416.0, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, cand) AS rnk FROM fresh) t
WHERE rnk <= 20""", local=_ITEM_P + [
    ("hist", "SELECT DISTINCT user_id, sku_id FROM purchases WHERE user_id IS NOT NULL AND sku_id IS NOT NULL"),
    ("scored", f"""SELECT h.user_id, s.sku2 AS cand, sum({fixed_sql("s.sim")}) AS score
  FROM hist h JOIN ip_graph s ON h.sku_id = s.sku1 GROUP BY h.user_id, s.sku2"""),
    ("fresh", """SELECT * FROM scored x WHERE NOT EXISTS
  (SELECT 1 FROM hist h WHERE h.user_id = x.user_id AND h.sku_id = x.cand)"""),
]))
def user_topn_cf_graph(spark, sf):
    """Item CF over the purchase log on the top-k graph: a history row meets at most 50 neighbours."""
    graph = _purchase_graph(spark, sf).select(F.col("e1").alias("sku1"), F.col("e2").alias("sku2"), "sim")
    top = C.user_topn_cf(fx.purchases(spark, sf).where("user_id is not null and sku_id is not null"), graph, 20)
    return top.select("user_id", "rnk", "sku_id", round6("score").alias("score"))


@register("online_cf", with_ctes(["enriched_clicks", "active_clicks"], """
SELECT user_id, CAST(rnk AS BIGINT) AS rnk, sku_id FROM cf_pick""", local=_ONLINE_CF))
def online_cf(spark, sf):
    return _online_cf(spark, sf)


@register("online_cf_decay", with_ctes(["enriched_clicks", "active_clicks"], """
SELECT user_id, CAST(rnk AS BIGINT) AS rnk, brand, round(score / 17592186044416.0, 6) AS score FROM cfd_top""",
                                       local=_BRAND_C + [_LATEST] + _cf_brand_sql(0.9)))
def online_cf_decay(spark, sf):
    clicks = fx.clicks(spark, sf)
    top = C.cf_brands(R.latest_items(clicks, 10), fx.products(spark, sf), _brand_sim_clicks(spark, sf),
                      k=10, decay=0.9)
    return top.select("user_id", "rnk", "brand", round6("score").alias("score"))


@register("candidates_union", with_ctes(["enriched_clicks", "active_clicks"], """
SELECT user_id, sku_id, channels FROM cands""", local=_CANDIDATES))
def candidates_union(spark, sf):
    return _candidates(spark, sf)


@register("encode_candidates", with_ctes(["enriched_clicks", "active_clicks", "wide_train"], """
SELECT * FROM encoded""", local=_ENCODED))
def encode_candidates(spark, sf):
    enc, _ = _encoded(spark, sf)
    return enc


@register("candidate_payload", with_ctes(["enriched_clicks", "active_clicks", "wide_train"], """
SELECT user_id, CAST(user_id AS VARCHAR) || ':' || chr(10) ||
       string_agg(""" + " || chr(9) || ".join(f"CAST({c} AS VARCHAR)" for c in [f"f_{x}" for x in FEATURE_COLUMNS] + ["item_id"]) +
    """, chr(10) ORDER BY item_id) || chr(10) AS payload
FROM encoded GROUP BY user_id""", local=_ENCODED))
def candidate_payload(spark, sf):
    enc, _ = _encoded(spark, sf)
    return C.candidate_payload(enc, [f"f_{c}" for c in FEATURE_COLUMNS])


def _fm_weights_sql(factors: int = 4, seed: int = 11) -> tuple[str, str]:
    def small(*parts):
        return f"(({h64_sql(*parts)} % 2001) - 1000) / 10000.0"
    vs = ", ".join(small(str(seed), "'v'", "feature_id", str(f)) for f in range(factors))
    return ("fmw", f"""SELECT feature_id, {small(str(seed), "'w'", "feature_id")} AS w, [{vs}] AS v
  FROM (SELECT DISTINCT feature_id FROM dict) t""")


ORACLE_FM_TOPN_BODY = """
SELECT user_id, CAST(rnk AS BIGINT) AS rnk, item_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rnk FROM scores) t
WHERE rnk <= 3"""
def _in_order(terms: list[str], first: str = "0.0::DOUBLE") -> str:
    """first + t1 + t2 ..., left to right."""
    out = first
    for t in terms:
        out = f"({out} + {t})"
    return out


_N = len(FEATURE_COLUMNS)
_FACTORS = 4
_S = [_in_order([f"coalesce(x{i}.v[{f + 1}], 0.0)" for i in range(_N)]) for f in range(_FACTORS)]
_S2 = [_in_order([f"coalesce(x{i}.v[{f + 1}] * x{i}.v[{f + 1}], 0.0)" for i in range(_N)]) for f in range(_FACTORS)]
ORACLE_FM_TOPN_CTES = _ENCODED + [_fm_weights_sql(), (
    "scores", "SELECT e.user_id, e.item_id, (0.0 + " + _in_order([f"coalesce(x{i}.w, 0.0)" for i in range(_N)]) + " + 0.5 * "
    + _in_order([f"(({_S[f]}) * ({_S[f]}) - ({_S2[f]}))" for f in range(_FACTORS)]) + ") AS score FROM encoded e "
    + " ".join(f"LEFT JOIN fmw x{i} ON x{i}.feature_id = e.f_{c}" for i, c in enumerate(FEATURE_COLUMNS)))]


@register("fm_score_topn", with_ctes(["enriched_clicks", "active_clicks", "wide_train"], ORACLE_FM_TOPN_BODY,
                                     local=ORACLE_FM_TOPN_CTES))
def fm_score_topn(spark, sf):
    enc, d = _encoded(spark, sf)
    weights = C.hashed_fm_weights(d.values, factors=4, seed=11)
    top = C.rank_by_score(C.fm_scores(enc, [f"f_{c}" for c in FEATURE_COLUMNS], weights), 3)
    return top.select("user_id", "rnk", "item_id", round6("score").alias("score"))


@register("fm_model_export", with_ctes(["wide_train"], """
SELECT 'w_' || feature_id AS key, 0 AS pos, round(w, 9) AS value FROM fmw
UNION ALL SELECT 'v_' || feature_id, CAST(p AS INTEGER), round(v[p + 1], 9) FROM fmw, range(4) r(p)
UNION ALL SELECT 'bias', 0, 0.125""", local=_dict_ctes(FEATURE_COLUMNS) + [_fm_weights_sql()]))
def fm_model_export(spark, sf):
    """A model of known weights stored as text and loaded again, by value (K5, M7)."""
    d = train_dictionary(spark, sf)
    weights = C.hashed_fm_weights(d.values, factors=4, seed=11)
    bias = spark.range(1).select(F.lit(-1).cast("bigint").alias("feature_id"), F.lit(0.125).alias("w"), F.array().cast("array<double>").alias("v"))
    path = shared_path(spark, "fm_export")
    M.write_model(weights.unionByName(bias), path)
    return M.read_kv(spark, path).select("key", F.posexplode("values").alias("pos", "value")).withColumn("value", F.round("value", 9))
