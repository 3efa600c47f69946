"""Sources/sinks, list tables, CF candidates and scoring on micro tables."""

import datetime as dt
import os

import numpy as np

from cartwheel.operators import candidates as C
from cartwheel.operators import recall as R
from cartwheel.session import local_fs_path, shared_path
from cartwheel.sources import files as io

ACT = "user_id long, sku_id long, type tinyint, action_time timestamp_ntz, event_id long"


def _t(s):
    return dt.datetime.fromisoformat(s)


def test_log_range_scan_half_open_reverse_and_limit(spark):
    kv = spark.createDataFrame([("2024-01-01 00:00:00,1", "5", "1"), ("2024-01-02 00:00:00,2", "6", "2"),
                                ("2024-01-03 00:00:00,3", "7", "3"), ("2024-01-04 00:00:00,4", "8", "4")],
                               "rowkey string, it string, ty string")
    rows = io.log_range_scan(kv, "2024-01-02", "2024-01-04", reverse=True).collect()
    assert [(r.user_id, r.item_id, r.type) for r in rows] == [(3, 7, 3), (2, 6, 2)]
    fwd = io.log_range_scan(kv, None, None, reverse=False, limit=2).collect()
    assert [r.user_id for r in fwd] == [1, 2]
    assert dict(io.log_range_scan(kv).dtypes) == {"user_id": "int", "item_id": "int", "type": "tinyint"}


def test_libffm_sink_appends_txt(spark):
    df = spark.createDataFrame([("1 0:1:1",)], "line string")
    p = io.write_lines(df, shared_path(spark, "ffm_test"))
    assert p.endswith(".txt")
    assert [r.value for r in spark.read.text(p).collect()] == ["1 0:1:1"]
    assert os.path.isdir(local_fs_path(p))


def test_csv_corrupt_lines_are_kept_aside(spark):
    p = shared_path(spark, "csv_corrupt")
    os.makedirs(local_fs_path(p), exist_ok=True)
    with open(os.path.join(local_fs_path(p), "a.csv"), "w") as f:
        f.write("user_id,sku_id,type,action_time,event_id\n1,2,3,2024-01-01 00:00:00,9\nx,y,z,w,v\n")
    from cartwheel.schemas import ACTION
    rows = io.read_csv(spark, p, ACTION).collect()
    good = [r for r in rows if r._corrupt_record is None]
    assert len(rows) == 2 and len(good) == 1 and good[0].user_id == 1


def test_hottest_lists_agree_with_single_lists(spark):
    rows = [(u, (u * 7 + d) % 13, 1, _t("2024-01-01 00:00:00") + dt.timedelta(hours=d * 11), u * 100 + d)
            for u in range(20) for d in range(70)]
    a = spark.createDataFrame(rows, ACT)
    both = R.hottest_lists(a, (1, 7, 30), 5).collect()
    for days in (1, 7, 30):
        one = {(r.rnk, r.sku_id, r.cnt) for r in R.hottest(a, days, 5).collect()}
        assert {(r.rnk, r.sku_id, r.cnt) for r in both if r.days == days} == one


def test_content_lists_agree_with_single_list(spark):
    rows = [(u % 5, u % 3, s, s % 4) for u in range(40) for s in range(u % 9)]
    e = spark.createDataFrame(rows, "city int, age int, sku_id long, brand int")
    allk = R.content_lists(e, ("city", "age", "brand"), 3).collect()
    for k in ("city", "age", "brand"):
        one = {(r.list_key, r.rnk, r.sku_id, r.cnt) for r in R.content_list(e, k, 3).collect()}
        assert {(r.list_key, r.rnk, r.sku_id, r.cnt) for r in allk if r.list_kind == k} == one


def test_online_cf_takes_small_pool_whole_and_reads_lists_descending(spark):
    seeds = spark.createDataFrame([(1, 100, 1)], "user_id long, sku_id long, rnk long")
    product = spark.createDataFrame([(100, 1), (200, 2), (201, 2)], "sku_id long, brand int")
    sim = spark.createDataFrame([(1, 2, 1, 0.5)], "brand1 long, brand2 long, co long, sim double")
    lists = spark.createDataFrame([(2, 1, 201, 9), (2, 2, 200, 3)], "list_key long, rnk long, sku_id long, cnt long")
    got = C.online_cf(seeds, product, sim, lists, k=10, per_brand=1).collect()
    assert [(r.user_id, r.sku_id) for r in got] == [(1, 201)]      # most popular item of the brand
    got = C.online_cf(seeds, product, sim, lists, k=10, per_brand=10).collect()
    assert sorted(r.sku_id for r in got) == [200, 201]              # pool < k: all of it


def test_decayed_brand_scores(spark):
    seeds = spark.createDataFrame([(1, 100, 1), (1, 101, 2)], "user_id long, sku_id long, rnk long")
    product = spark.createDataFrame([(100, 1), (101, 3)], "sku_id long, brand int")
    sim = spark.createDataFrame([(1, 2, 1, 0.5), (3, 2, 1, 0.25)], "brand1 long, brand2 long, co long, sim double")
    r = C.cf_brands(seeds, product, sim, k=5, decay=0.5).first()
    assert (r.brand, r.score) == (2, 0.5 * 1.0 + 0.25 * 0.5)


def test_fm_scores_match_numpy(spark):
    rng = np.random.default_rng(0)
    w = rng.normal(size=6)
    v = rng.normal(size=(6, 3))
    weights = spark.createDataFrame([(i, float(w[i]), [float(x) for x in v[i]]) for i in range(6)],
                                    "feature_id long, w double, v array<double>")
    enc = spark.createDataFrame([(1, 10, 0, 2, 5), (1, 11, 1, 3, 4)], "user_id long, item_id long, a long, b long, c long")
    got = {r.item_id: r.score for r in C.fm_scores(enc, ["a", "b", "c"], weights, bias=0.3).collect()}
    for item, ids in ((10, [0, 2, 5]), (11, [1, 3, 4])):
        s = v[ids].sum(axis=0)
        want = 0.3 + w[ids].sum() + 0.5 * float((s * s).sum() - (v[ids] ** 2).sum())
        assert abs(got[item] - want) < 1e-9


def test_candidate_payload_format(spark):
    enc = spark.createDataFrame([(7, 2, 11, 12), (7, 1, 13, 14)], "user_id long, item_id long, f_a long, f_b long")
    p = C.candidate_payload(enc, ["f_a", "f_b"]).first().payload
    assert p == "7:\n13\t14\t1\n11\t12\t2\n"


def test_online_cf_ranked_mode_orders_by_brand_score(spark):
    seeds = spark.createDataFrame([(1, 100, 1)], "user_id long, sku_id long, rnk long")
    product = spark.createDataFrame([(100, 1)], "sku_id long, brand int")
    sim = spark.createDataFrame([(1, 2, 1, 0.9), (1, 3, 1, 0.4)], "brand1 long, brand2 long, co long, sim double")
    lists = spark.createDataFrame([(2, 1, 20, 5), (2, 2, 21, 4), (3, 1, 30, 9)],
                                  "list_key long, rnk long, sku_id long, cnt long")
    got = C.online_cf(seeds, product, sim, lists, k=2, sample=False).orderBy("rnk").collect()
    assert [r.sku_id for r in got] == [20, 21]


def test_split_fraction_is_close_and_deterministic(spark):
    from cartwheel.operators import sampling as SM
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = SM.split_fraction(df, 0.3, ["k"], seed=1)
    share = a.where("part = 'train'").count() / 20000
    assert abs(share - 0.3) < 0.02
    assert a.where("part = 'train'").collect() == SM.split_fraction(df, 0.3, ["k"], seed=1).where(
        "part = 'train'").collect()


def test_libsvm_and_weight_text_sinks(spark):
    from pyspark.ml.linalg import Vectors

    from cartwheel.operators import models as M
    df = spark.createDataFrame([(1.0, Vectors.sparse(5, [0, 3], [1.0, 1.0]))], ["label", "features"])
    p = shared_path(spark, "libsvm")
    io.write_libsvm(df, p)
    assert [r.value for r in spark.read.text(p).collect()] == ["1.0 1:1.0 4:1.0"]
    kv = spark.createDataFrame([("bias", [0.5]), ("v_3", [0.25, -1.0])], "key string, values array<double>")
    assert sorted(r.line for r in M.weights_text(kv).collect()) == ["bias: 0.5", "v_3: 0.25 -1.0"]


def test_range_scan_prunes_date_partitions(spark):
    from paths import SF001

    from cartwheel.sources import fixtures as fx
    kv = fx.kv_log(fx.clicks(spark, SF001))
    p = shared_path(spark, "kv_store")
    io.write_kv_log(kv, p)
    stored = spark.read.parquet(p)
    scan = io.log_range_scan(stored, "2024-01-10", "2024-01-12", date_col="dt", with_time=True)
    plan = scan._sc._jvm.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(dt" in plan
    want = io.log_range_scan(kv, "2024-01-10", "2024-01-12", with_time=True)
    assert sorted(map(tuple, scan.collect())) == sorted(map(tuple, want.collect()))
