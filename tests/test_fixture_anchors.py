"""The fixture mapping reproduces the anchor numbers documented for sf0.01."""

from pyspark.sql import functions as F

from paths import SF01

from cartwheel.operators import recall as R
from cartwheel.operators import transform as X
from cartwheel.sources import fixtures as fx


def test_click_log_shape_and_labels(spark):
    c = fx.clicks(spark, SF01)
    r = c.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("u"),
              F.countDistinct("sku_id").alias("i")).first()
    assert (r.n, r.u, r.i) == (10_000, 150, 100)
    pairs = X.pair_labels(c)
    assert pairs.count() == 7310
    assert pairs.where("label = 1").count() == 2135


def test_hottest_day_top3(spark):
    top = R.hottest(fx.clicks(spark, SF01), 1, 3).orderBy("rnk").collect()
    assert [(r.sku_id, r.cnt) for r in top] == [(89, 9), (12, 8), (47, 8)]


def test_split_sizes(spark):
    s = X.temporal_split(fx.clicks(spark, SF01),
                         ["2024-01-17", "2024-01-19", "2024-01-22", "2024-01-25", "2024-01-28", "2024-01-31"])
    got = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert got == {"train": 5320, "test1": 685, "test2": 991, "test3": 998, "test4": 1012, "test5": 994}


def test_product_gaps_and_cold_start(spark):
    c = fx.clicks(spark, SF01)
    missing = c.join(fx.products(spark, SF01), "sku_id", "left_anti").count()
    assert missing == 0      # every part is in the product table
    assert R.cold_start_users(fx.users(spark, SF01), c).count() == 1350


def test_purchase_log_shape(spark):
    p = fx.purchases(spark, SF01)
    r = p.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("u"),
              F.countDistinct("sku_id").alias("i")).first()
    assert (r.n, r.u, r.i) == (60_000, 1_500, 2_000)
    assert R.active_users(p, 5).count() == 1_498
