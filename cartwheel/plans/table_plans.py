"""Registered training-table, cast, split and I/O queries (phase 2)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import ts_text
from cartwheel.operators import transform as X
from cartwheel.operators.asof import asof_join
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle_ctes import define, with_ctes
from cartwheel.schemas import ACTION
from cartwheel.session import shared_path
from cartwheel.sources import files as io
from cartwheel.sources import fixtures as fx
from cartwheel.sources import kvlog as KV

SPLIT_BOUNDARIES = ["2024-01-17", "2024-01-19", "2024-01-22", "2024-01-25", "2024-01-28", "2024-01-31"]

define("pairs_clicks", ["clicks"], """
  SELECT user_id, sku_id, count(type) AS cnt,
         CAST(CASE WHEN count(type) > 1 THEN 1 ELSE 0 END AS TINYINT) AS label
  FROM clicks WHERE user_id IS NOT NULL AND sku_id IS NOT NULL GROUP BY user_id, sku_id""")

define("wide_clicks", ["pairs_clicks", "products", "users"], """
  SELECT p.label,
         coalesce(u.age, 0) AS age, coalesce(u.sex, 0) AS sex, coalesce(u.city, 0) AS city,
         coalesce(u.county, 0) AS county, coalesce(pr.brand, 0) AS brand,
         coalesce(pr.shop_id, 0) AS shop_id, coalesce(pr.cate, 0) AS cate,
         p.user_id, p.sku_id
  FROM pairs_clicks p LEFT JOIN products pr ON p.sku_id = pr.sku_id
                      LEFT JOIN users u ON p.user_id = u.user_id""")

define("enriched_wide_clicks", ["pairs_clicks", "products", "users", "shops"], """
  SELECT p.label,
         coalesce(u.age, 0) AS age, coalesce(u.city, 0) AS city,
         coalesce(pr.brand, 0) AS brand, coalesce(pr.shop_id, 0) AS shop_id,
         coalesce(pr.cate, 0) AS cate, coalesce(s.fans_num, 0) AS fans_num,
         coalesce(s.shop_score, 0.0) AS shop_score, p.user_id, p.sku_id
  FROM pairs_clicks p LEFT JOIN products pr ON p.sku_id = pr.sku_id
                      LEFT JOIN users u ON p.user_id = u.user_id
                      LEFT JOIN shops s ON pr.shop_id = s.shop_id""")


def _wide_clicks(spark, sf):
    pairs = X.pair_labels(fx.clicks(spark, sf))
    wide = X.fill_zero(X.join_dimensions(pairs, fx.products(spark, sf), fx.users(spark, sf)))
    return wide.select("label", "age", "sex", "city", "county", "brand", "shop_id", "cate", "user_id", "sku_id")


def _enriched_wide_clicks(spark, sf):
    pairs = X.pair_labels(fx.clicks(spark, sf))
    return X.enriched_actions(pairs, fx.products(spark, sf), fx.users(spark, sf), fx.shops(spark, sf))


@register("pair_labels", with_ctes(["pairs_clicks"], "SELECT user_id, sku_id, cnt, label FROM pairs_clicks"))
def pair_labels(spark, sf):
    return X.pair_labels(fx.clicks(spark, sf)).select("user_id", "sku_id", "cnt", "label")


@register("train_table", with_ctes(["wide_clicks"], """
SELECT CAST(label AS TINYINT) AS label, CAST(age AS TINYINT) AS age, CAST(sex AS TINYINT) AS sex,
       CAST(city AS SMALLINT) AS city, CAST(county AS INTEGER) AS county, CAST(brand AS BIGINT) AS brand,
       CAST(shop_id AS BIGINT) AS shop_id, CAST(cate AS SMALLINT) AS cate,
       CAST(user_id AS BIGINT) AS user_id, CAST(sku_id AS BIGINT) AS sku_id
FROM wide_clicks"""))
def train_table(spark, sf):
    return X.train_table(fx.clicks(spark, sf), fx.products(spark, sf), fx.users(spark, sf))


@register("enriched_actions", with_ctes(["enriched_wide_clicks"], """
SELECT label, age, city, brand, shop_id, cate, fans_num, round(shop_score, 6) AS shop_score, user_id, sku_id
FROM enriched_wide_clicks"""))
def enriched_actions(spark, sf):
    df = _enriched_wide_clicks(spark, sf)
    return df.withColumn("shop_score", F.round("shop_score", 6))


# Casts that may not fit: a failing column keeps its type and values.
CAST_SPEC = {"age": "tinyint", "city": "tinyint", "county": "tinyint", "brand": "smallint",
             "user_id": "smallint", "sku_id": "int", "cate": "tinyint"}


@register("cast_columns", with_ctes(["wide_clicks"], """
SELECT label, CAST(age AS TINYINT) AS age, sex, CAST(city AS TINYINT) AS city,
       county,  -- exceeds tinyint: kept as it was
       CAST(brand AS SMALLINT) AS brand, shop_id, CAST(cate AS TINYINT) AS cate,
       CAST(user_id AS SMALLINT) AS user_id, CAST(sku_id AS INTEGER) AS sku_id
FROM wide_clicks"""))
def cast_columns(spark, sf):
    return X.cast_columns(_wide_clicks(spark, sf), CAST_SPEC)


def _narrow_report_select() -> str:
    cols = [("label", "tinyint"), ("age", "tinyint"), ("city", "smallint"), ("brand", "int"),
            ("shop_id", "bigint"), ("cate", "smallint"), ("fans_num", "int"), ("shop_score", "double"),
            ("user_id", "bigint"), ("sku_id", "bigint")]
    nbytes = "CASE {t} WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 WHEN 'bigint' THEN 8 " \
             "WHEN 'float' THEN 4 ELSE 8 END"
    parts = []
    for c, kind in cols:
        if kind == "double":
            to = (f"CASE WHEN min({c}) > -3.4028234663852886e38 AND max({c}) < 3.4028234663852886e38 "
                  f"THEN 'float' ELSE 'double' END")
        else:
            to = (f"CASE WHEN min({c}) > -128 AND max({c}) < 127 THEN 'tinyint' "
                  f"WHEN min({c}) > -32768 AND max({c}) < 32767 THEN 'smallint' "
                  f"WHEN min({c}) > -2147483648 AND max({c}) < 2147483647 THEN 'int' ELSE 'bigint' END")
        parts.append(f"SELECT '{c}' AS column_name, '{kind}' AS from_type, {to} AS to_type FROM enriched_wide_clicks")
    body = "\nUNION ALL\n".join(parts)
    return f"""
SELECT column_name, from_type, to_type,
       CAST({nbytes.format(t='from_type')} AS BIGINT) AS bytes_before,
       CAST({nbytes.format(t='to_type')} AS BIGINT) AS bytes_after
FROM ({body}) r"""


def _narrow_sql() -> str:
    return with_ctes(["enriched_wide_clicks"], _narrow_report_select())


@register("narrow_types", _narrow_sql())
def narrow_types(spark, sf):
    return X.narrowing_report(_enriched_wide_clicks(spark, sf))


@register("narrowed_table", with_ctes(["enriched_wide_clicks"], """
SELECT label, age, city, brand, shop_id, cate, fans_num, CAST(CAST(shop_score AS FLOAT) AS DOUBLE) AS shop_score, user_id, sku_id
FROM enriched_wide_clicks"""))
def narrowed_table(spark, sf):
    """The table itself in its narrow types (the score as 32 bits, shown as a double)."""
    t = X.narrow_types(_enriched_wide_clicks(spark, sf))
    return t.withColumn("shop_score", F.col("shop_score").cast("double"))


@register("narrow_types_summary", with_ctes(["enriched_wide_clicks"], """
SELECT n.rows, CAST(10 AS BIGINT) AS columns, CAST(n.rows * b.before AS BIGINT) AS bytes_before,
       CAST(n.rows * b.after AS BIGINT) AS bytes_after,
       round(100.0 * (b.before - b.after) / b.before, 6) AS reduction_pct
FROM (SELECT count(*) AS rows FROM enriched_wide_clicks) n,
     (SELECT sum(bytes_before) AS before, sum(bytes_after) AS after FROM report) b""",
                                            local=[("report", _narrow_report_select())]))
def narrow_types_summary(spark, sf):
    return X.narrowing_summary(_enriched_wide_clicks(spark, sf))


def _split_sql() -> str:
    b = SPLIT_BOUNDARIES
    names = ["train", "test1", "test2", "test3", "test4", "test5"]
    whens = " ".join(f"WHEN action_time < TIMESTAMP '{x}' THEN '{n}'" for n, x in zip(names, b))
    return with_ctes(["clicks"], f"""
SELECT * FROM (SELECT event_id, user_id, sku_id, CASE {whens} END AS split FROM clicks) t
WHERE split IS NOT NULL""")


@register("temporal_split", _split_sql())
def temporal_split(spark, sf):
    return X.temporal_split(fx.clicks(spark, sf), SPLIT_BOUNDARIES).select("event_id", "user_id", "sku_id", "split")


@register("rolling_history", with_ctes(["purchases"], """
SELECT event_id, user_id, sku_id FROM purchases, (SELECT max(action_time) AS a FROM purchases) m
WHERE action_time > a - INTERVAL 2 MONTH AND action_time <= a"""))
def rolling_history(spark, sf):
    return X.rolling_history(fx.purchases(spark, sf), 2).select("event_id", "user_id", "sku_id")


@register("sorted_log", with_ctes(["clicks"], """
SELECT row_number() OVER (ORDER BY action_time, user_id, sku_id, event_id) - 1 AS position,
       event_id, user_id, sku_id, type, strftime(action_time, '%Y-%m-%d %H:%M:%S.%f') AS action_time FROM clicks"""))
def sorted_log(spark, sf):
    """The sorted log, written and read again, with the place at which each row stands in the files."""
    path = shared_path(spark, "sorted_log")
    X.sorted_log(fx.clicks(spark, sf)).write.parquet(path)
    s = io.file_positions(spark.read.parquet(path))
    return s.select("position", "event_id", "user_id", "sku_id", "type", ts_text("action_time").alias("action_time"))


@register("log_range_scan", with_ctes(["clicks"], """
SELECT split_part(rowkey, ',', 1) AS ts, CAST(split_part(rowkey, ',', 2) AS INTEGER) AS user_id,
       CAST(it AS INTEGER) AS item_id, CAST(ty AS TINYINT) AS type
FROM kv WHERE rowkey >= '2024-01-10' AND rowkey < '2024-01-20'""", local=[("kv", """
SELECT strftime(action_time, '%Y-%m-%d %H:%M:%S') || ',' || CAST(user_id AS VARCHAR) AS rowkey,
       CAST(sku_id AS VARCHAR) AS it, CAST(type AS VARCHAR) AS ty FROM clicks""")]))
def log_range_scan(spark, sf):
    """Row-key log stored partitioned by date; the key range prunes partitions."""
    path = shared_path(spark, "kv_log")
    io.write_kv_log(fx.kv_log(fx.clicks(spark, sf)), path)
    return io.log_range_scan(spark.read.parquet(path), "2024-01-10", "2024-01-20", reverse=True,
                             with_time=True, date_col="dt")


SCAN_LIMIT = 1500


@register("kv_scan_limit", with_ctes(["clicks"], f"""
SELECT CAST(row_number() OVER (ORDER BY rowkey DESC, it, ty) AS BIGINT) AS place, split_part(rowkey, ',', 1) AS ts,
       CAST(split_part(rowkey, ',', 2) AS INTEGER) AS user_id, CAST(it AS INTEGER) AS item_id, CAST(ty AS TINYINT) AS type
FROM (SELECT * FROM kv WHERE rowkey >= '2024-01-05' AND rowkey < '2024-01-20 12' ORDER BY rowkey DESC, it, ty LIMIT {SCAN_LIMIT}) x""", local=[("kv", """
SELECT strftime(action_time, '%Y-%m-%d %H:%M:%S') || ',' || CAST(user_id AS VARCHAR) AS rowkey,
       CAST(sku_id AS VARCHAR) AS it, CAST(type AS VARCHAR) AS ty FROM clicks
WHERE user_id IS NOT NULL AND sku_id IS NOT NULL AND type IS NOT NULL""")]))
def kv_scan_limit(spark, sf):
    """The newest rows of a key range through the ``kvlog`` source; ``limit`` is the feature (as of the scan it stands for)."""
    path = shared_path(spark, "kv_store")
    KV.write_store(fx.kv_log(fx.clicks(spark, sf)).dropna(), path)
    rows = KV.log_scan(spark, path, "2024-01-05", "2024-01-20 12", reverse=True, limit=SCAN_LIMIT)
    # the scan's order, shown as a column: the index of a row of one sorted result
    held = rows.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)  # at most the limit's rows
    return held.select("place", "ts", "user_id", "item_id", "type")


_COMMENTS_SQL = [("comments", """SELECT sku_id, t, CAST(sum(n) OVER w AS BIGINT) AS comments, CAST(sum(good) OVER w AS BIGINT) AS good_comments FROM (
  SELECT sku_id, action_time AS t, count(*) AS n, count(*) FILTER (type >= 4) AS good FROM purchases WHERE event_id % 3 = 0 GROUP BY sku_id, action_time) x
  WINDOW w AS (PARTITION BY sku_id ORDER BY t)""")]


@register("asof_dimension", with_ctes(["purchases"], """
SELECT p.user_id, p.sku_id, p.event_id, strftime(p.action_time, '%Y-%m-%d %H:%M:%S') AS action_time, c.comments, c.good_comments
FROM purchases p ASOF LEFT JOIN comments c ON p.sku_id = c.sku_id AND p.action_time >= c.t""", local=_COMMENTS_SQL))
def asof_dimension(spark, sf):
    """Purchases with the comment counts of their product as they stood at the time.

    Comment table of the fixture: every third purchase line comments on its product that day."""
    bought = fx.purchases(spark, sf)
    told = bought.where("event_id % 3 = 0").groupBy("sku_id", "action_time").agg(F.count("*").alias("n"), F.count_if(F.col("type") >= 4).alias("good"))
    so_far = Window.partitionBy("sku_id").orderBy("action_time")
    comments = told.select("sku_id", F.col("action_time").alias("t"), F.sum("n").over(so_far).alias("comments"), F.sum("good").over(so_far).alias("good_comments"))
    out = asof_join(bought, comments, "sku_id", "action_time", "t", ["comments", "good_comments"])
    return out.select("user_id", "sku_id", "event_id", F.date_format("action_time", "yyyy-MM-dd HH:mm:ss").alias("action_time"), "comments", "good_comments")


_CLICKS_TEXT_SQL = with_ctes(["clicks"], """
SELECT user_id, sku_id, type, strftime(action_time, '%Y-%m-%d %H:%M:%S.%f') AS action_time, event_id FROM clicks""")


@register("scan_csv_roundtrip", _CLICKS_TEXT_SQL)
def scan_csv_roundtrip(spark, sf):
    path = shared_path(spark, "csv_roundtrip")
    io.write_csv(fx.clicks(spark, sf), path)
    back = io.read_csv(spark, path, ACTION)
    return back.select("user_id", "sku_id", "type", ts_text("action_time").alias("action_time"), "event_id")


@register("scan_snapshot", with_ctes(["clicks"], """
SELECT user_id, sku_id, type, strftime(action_time, '%Y-%m-%d %H:%M:%S.%f') AS action_time, event_id,
       CAST(CAST(action_time AS DATE) AS VARCHAR) AS dt FROM clicks"""))
def scan_snapshot(spark, sf):
    path = shared_path(spark, "snapshot")
    io.write_snapshot(io.with_date_partition(fx.clicks(spark, sf)), path, partition_by=["dt"])
    back = io.read_snapshot(spark, path)
    return back.select("user_id", "sku_id", "type", ts_text("action_time").alias("action_time"), "event_id",
                       F.col("dt").cast("string").alias("dt"))
