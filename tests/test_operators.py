"""Operator rules on hand-written micro tables (null/ordering rules N1-N10,
reference quirks) and property checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import recall as R
from cartwheel.operators import topn as T
from cartwheel.operators import transform as X

ACT = "user_id long, sku_id long, type tinyint, action_time timestamp_ntz, event_id long"


def _t(s):
    return dt.datetime.fromisoformat(s)


def test_top_n_ties_break_on_smaller_item_and_null_groups_drop(spark):
    rows = [(1, 10, 1, _t("2024-01-01 00:00:00"), 1), (2, 11, 1, _t("2024-01-01 00:00:01"), 2),
            (3, 10, 1, _t("2024-01-01 00:00:02"), 3), (4, 11, 1, _t("2024-01-01 00:00:03"), 4),
            (5, 12, 1, _t("2024-01-01 00:00:04"), 5), (6, None, 1, _t("2024-01-01 00:00:05"), 6)]
    a = spark.createDataFrame(rows, ACT).withColumn("g", F.when(F.col("user_id") < 5, F.lit(1)))
    top = T.top_items_per_group(a, "g", 2).orderBy("rnk").collect()
    assert [(r.g, r.sku_id, r.cnt, r.rnk) for r in top] == [(1, 10, 2, 1), (1, 11, 2, 2)]


def test_hottest_window_is_strictly_after_anchor_minus_days(spark):
    rows = [(1, 1, 1, _t("2024-01-10 00:00:00"), 1),   # exactly anchor - 1 day: excluded
            (1, 2, 1, _t("2024-01-10 00:00:01"), 2),
            (1, 3, 1, _t("2024-01-11 00:00:00"), 3)]
    a = spark.createDataFrame(rows, ACT)
    assert sorted(r.sku_id for r in R.hottest(a, 1, 10).collect()) == [2, 3]


def test_active_users_threshold_is_inclusive(spark):
    rows = [(u, s, 1, _t("2024-01-01 00:00:00"), u * 10 + s) for u, n in ((1, 5), (2, 4)) for s in range(n)]
    a = spark.createDataFrame(rows, ACT)
    assert [r.user_id for r in R.active_users(a, 5).collect()] == [1]


def test_behaviour_weights_and_unknown_code(spark):
    df = spark.createDataFrame([(1,), (2,), (5,), (9,)], "type tinyint")
    got = [r.w for r in df.select(R.behaviour_score().alias("w")).collect()]
    assert got == [0.1, 0.5, 0.4, None]


def test_pair_labels_repeat_means_positive(spark):
    rows = [(1, 1, 1, _t("2024-01-01 00:00:00"), 1), (1, 1, 2, _t("2024-01-01 00:00:01"), 2),
            (1, 2, 1, _t("2024-01-01 00:00:02"), 3)]
    got = {(r.sku_id, r.cnt, r.label) for r in X.pair_labels(spark.createDataFrame(rows, ACT)).collect()}
    assert got == {(1, 2, 1), (2, 1, 0)}


def test_cast_columns_keeps_column_that_does_not_fit(spark):
    df = spark.createDataFrame([(1, 300, None), (2, 5, 7)], "a long, b long, c long")
    out = X.cast_columns(df, {"a": "tinyint", "b": "tinyint", "c": "tinyint"})
    types = dict(out.dtypes)
    assert types == {"a": "tinyint", "b": "bigint", "c": "tinyint"}
    assert sorted(r.b for r in out.collect()) == [5, 300]


def test_narrowing_uses_open_ranges_and_never_floats_ids(spark):
    df = spark.createDataFrame([(0, 127, 1.5, 10), (1, -5, 2.5, 20)], "a long, b long, x double, user_id long")
    plan = {c: to for c, _, to, _, _ in X.narrowing_plan(df, ["user_id"])}
    assert plan == {"a": "tinyint", "b": "smallint", "x": "float", "user_id": "tinyint"}


def test_fill_zero_touches_numbers_only(spark):
    df = spark.createDataFrame([(None, None, None)], "a long, b double, s string")
    r = X.fill_zero(df).first()
    assert (r.a, r.b, r.s) == (0, 0.0, None)


def test_temporal_split_half_open(spark):
    rows = [(1, 1, 1, _t("2024-01-16 23:59:59"), 1), (1, 1, 1, _t("2024-01-17 00:00:00"), 2),
            (1, 1, 1, _t("2024-01-19 00:00:00"), 3), (1, 1, 1, _t("2024-02-01 00:00:00"), 4)]
    out = X.temporal_split(spark.createDataFrame(rows, ACT), ["2024-01-17", "2024-01-19", "2024-01-22"])
    assert {r.event_id: r.split for r in out.collect()} == {1: "train", 2: "test1", 3: "test2"}


def test_latest_items_ties_by_event_id(spark):
    rows = [(1, s, 1, _t("2024-01-01 00:00:00"), s) for s in range(12)]
    got = [r.sku_id for r in R.latest_items(spark.createDataFrame(rows, ACT), 10).orderBy("rnk").collect()]
    assert got == list(range(11, 1, -1))


def test_cold_start_gets_hottest_week(spark):
    rows = [(1, 7, 1, _t("2024-01-10 00:00:00"), 1), (1, 7, 1, _t("2024-01-10 00:00:01"), 2),
            (1, 8, 1, _t("2024-01-10 00:00:02"), 3)]
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    got = R.cold_start_recommendations(users, spark.createDataFrame(rows, ACT), 7, 3).collect()
    assert {(r.user_id, r.rnk, r.sku_id) for r in got} == {(2, 1, 7), (2, 2, 8), (3, 1, 7), (3, 2, 8)}


@pytest.mark.parametrize("line,ok", [("12 34", True), ("  12 34 ", True), ("abc 1", False), ("1  2", False),
                                     ("1 2 3", False), ("", False)])
def test_request_validation(spark, line, ok):
    from cartwheel.streaming.requests import parse_requests
    r = parse_requests(spark.createDataFrame([(line,)], "value string")).first()
    assert r.valid is ok
    if ok:
        assert (r.user_id, r.sku_id) == tuple(int(x) for x in line.split())


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_event_time_helpers_ignore_session_zone(spark, tz):
    from cartwheel.functions.exprs import ntz_from_utc, utc_instant, utc_micros
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame([(_t("2024-01-05 13:07:09.123456"),)], "t timestamp_ntz")
        r = df.select(utc_micros("t").alias("us"), ntz_from_utc(utc_instant("t")).alias("back")).first()
        assert r.us == int((_t("2024-01-05 13:07:09.123456") - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
        assert r.back == _t("2024-01-05 13:07:09.123456")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_left_joins_keep_actions_of_unknown_products(spark):
    pairs = spark.createDataFrame([(1, 10, 1), (1, 99, 0)], "user_id long, sku_id long, label int")
    product = spark.createDataFrame([(10, 3, 4, 5)], "sku_id long, brand int, shop_id long, cate short")
    user = spark.createDataFrame([(1, 2, 1, 7, 70)], "user_id long, age byte, sex byte, city short, county int")
    got = {r.sku_id: (r.brand, r.age) for r in X.fill_zero(X.join_dimensions(pairs, product, user)).collect()}
    assert got == {10: (3, 2), 99: (0, 2)}


def test_lines_of_text_and_missing_features(spark):
    from cartwheel.operators import encode as E
    df = spark.createDataFrame([(1, "b", 7, 2.0000001), (0, None, 7, 5e-9), (1, "a", None, None), (0, "é", 9, -1.5)], "label int, t string, n int, x double")
    d = E.build_dictionary(df, ["t", "n", "x"], ["x"])
    lines = sorted(r.line for r in E.ffm_lines(df, d).collect())
    assert [ln.split()[:-1] if "2:" in ln else ln.split() for ln in lines] == [["0", "0:2:1", "1:4:1"], ["0", "1:3:1"], ["1", "0:0:1"], ["1", "0:1:1", "1:3:1"]]
    values = sorted(float(ln.split("2:5:")[1]) for ln in lines if "2:5:" in ln)
    assert values == [-1.5, 5e-9, 2.0000001]
    new = spark.createDataFrame([(1, "zz", 7, 1.0)], "label int, t string, n int, x double")
    assert E.ffm_lines(new, d).first().line.startswith("1 0:6:1 1:3:1")           # reserved id of the field


def test_small_scores_are_not_rounded_away(spark):
    from cartwheel.operators import candidates as C
    seeds = spark.createDataFrame([(1, 100, 10)], "user_id long, sku_id long, rnk long")
    product = spark.createDataFrame([(100, 1)], "sku_id long, brand int")
    sim = spark.createDataFrame([(1, 2, 1, 1e-9), (1, 3, 1, 1.0000001e-9)], "brand1 long, brand2 long, co long, sim double")
    got = C.cf_brands(seeds, product, sim, k=5, decay=0.9).orderBy("rnk").collect()
    assert [r.brand for r in got] in ([3, 2], [2, 3]) and all(r.score > 0 for r in got)


def test_brand_scores_read_the_log_once(spark, tmp_path):
    """Users of five actions or more count, those without a brand too; the log is neither joined with itself nor sorted."""
    rows = [(1, 10, 1, 7), (1, 11, 2, 7), (1, 12, 9, 8), (1, 13, 1, None), (1, 14, 3, 7), (2, 10, 1, 7), (2, None, 2, 7), (None, 10, 1, 7),
            *[(3, k, None, 9) for k in range(5)], *[(4, None, 1, 9)] * 6, (4, 1, 1, 9), *[(5, 1, 2, None)] * 5]
    spark.createDataFrame(rows, "user_id long, sku_id long, type int, brand int").write.parquet(f"{tmp_path}/log")
    scores = R.user_brand_score(spark.read.parquet(f"{tmp_path}/log"))
    assert {(r["user_id"], r["brand"]): round(r["score"], 6) for r in scores.collect()} == {(1, 7): 0.8, (1, 8): 0.0, (3, 9): 0.0}
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan


@pytest.mark.parametrize(("pairs", "cut"), [(1 << 21, 256), (50, 3), (400, 7)])
def test_item_cf_adds_up_packed_lists(spark, monkeypatch, pairs, cut):
    """Users that span sums, neighbours in several lists, ties, a row without user and items without neighbours; no shuffled row a (user, neighbour)."""
    from cartwheel.operators import candidates as C
    monkeypatch.setattr(C, "_PAIRS", pairs)
    monkeypatch.setattr(C, "_LIST", cut)
    rnd = __import__("random").Random(6)
    history = [(rnd.choice([None, *range(12)]), rnd.choice([None, *range(30)])) for _ in range(300)]
    sim = {(a, b): rnd.choice([0.5, 0.25, 0.1]) for a in range(25) for b in range(40) if a != b and rnd.random() < 0.5}
    met = C.user_topn_cf(spark.createDataFrame(history, "user_id long, sku_id long"), spark.createDataFrame([(a, b, s) for (a, b), s in sim.items()], "sku1 long, sku2 long, sim double"), 5)
    got = {(r["user_id"], r["rnk"]): (r["sku_id"], r["score"]) for r in met.collect()}
    want = {}
    for u in {x for x, _ in history}:
        mine, score = {i for x, i in history if x == u and i is not None}, {}
        for (a, b), s in sim.items():
            if a in mine and (u is None or b not in mine):
                score[b] = score.get(b, 0) + int(s * 2 ** 44)
        for r, (b, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:5], 1):
            want[u, r] = (b, s / 2 ** 44)
    assert got == want
    assert met._jdf.queryExecution().executedPlan().toString().count("Window") == 0
