"""Growing dictionaries, panes, as-of joins, Bloom filters, the KV source and streaming state, each against a plain version."""
import bisect
import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paths import SF001

from cartwheel.functions import bloom
from cartwheel.operators import encode as E
from cartwheel.operators import recall as R
from cartwheel.operators.asof import asof_join
from cartwheel.session import shared_path
from cartwheel.sources import fixtures as fx
from cartwheel.sources import kvlog as KV
from cartwheel.streaming import jobs as J
from cartwheel.streaming import panes as PN


# ---------------------------------------------------------------- dictionary
def test_dictionary_grows_without_recoding(spark):
    one = spark.createDataFrame([(3, "b", 1.5), (1, "a", 2.5), (None, None, 0.0)], "n int, t string, x double")
    two = spark.createDataFrame([(2, "a", 0.5), (1, "c", 0.5), (9, None, 0.5)], "n int, t string, x double")
    d0 = E.build_dictionary(one, ["n", "x", "t"], numeric=["x"])
    d1 = E.extend_dictionary(d0, two, 1)
    d2 = E.extend_dictionary(d1, two, 2)

    def ids(d):
        return {(r["column"], r["value"] if r["value"] is not None else r["text_value"]): r["feature_id"] for r in d.values.collect()}

    assert ids(d0) == {("n", 1): 0, ("n", 3): 1, ("t", "a"): 3, ("t", "b"): 4}         # 2 is the numeric field
    assert ids(d1) == {**ids(d0), ("n", 2): 5, ("n", 9): 6, ("t", "c"): 7}
    assert ids(d2) == ids(d1) and (d0.total, d1.total, d2.total) == (5, 8, 8)
    enc = E.encode_columns(two, d1).orderBy("n").select("f_n", "f_t").collect()
    assert [tuple(r) for r in enc] == [(0, 7), (5, 3), (6, None)]
    lines = [r["line"] for r in E.ffm_lines(two.withColumn("label", F.lit(1)), d1).collect()]
    assert any(line.startswith("1 0:5:1 1:2:0.5 2:3:1") for line in lines)


def test_one_hot_vectors(spark):
    df = spark.createDataFrame([(1, 3, "b", 1.5), (0, 1, "a", 0.0)], "label int, n int, t string, x double")
    d = E.build_dictionary(df, ["n", "x", "t"], numeric=["x"])
    unseen = spark.createDataFrame([(1, 7, "a", 2.0)], "label int, n int, t string, x double")
    got = [(r["label"], dict(zip(map(int, r["features"].toArray().nonzero()[0]), r["features"].toArray()[r["features"].toArray().nonzero()]))) for r in
           E.one_hot(E.encode_columns(df.unionAll(unseen), d), d).collect()]
    assert got == [(1.0, {1: 1.0, 2: 1.5, 4: 1.0}), (0.0, {0: 1.0, 3: 1.0}), (1.0, {2: 2.0, 3: 1.0})]


# ---------------------------------------------------------------- as-of join
@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_asof_against_bisection(spark, partitions):
    rnd = random.Random(partitions)
    dim = [(rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([None, *range(60)]), k) for k in range(150)]
    facts = [(rnd.choice([1, 1, 1, 2, 3, 4, None]), rnd.choice([None, *range(-5, 65)]), k) for k in range(400)]   # key 1 spans partitions
    got = asof_join(spark.createDataFrame(facts, "k int, t int, f int"), spark.createDataFrame(dim, "k int, at int, v int"), "k", "t", "at", ["v"], num_partitions=partitions)
    newest = defaultdict(dict)
    for k, at, v in dim:
        if k is not None and at is not None:
            newest[k][at] = max(v, newest[k].get(at, -1))
    want = []
    for k, t, f in facts:
        times = sorted(newest[k]) if k is not None and t is not None else []
        place = bisect.bisect_right(times, t) if times else 0
        want.append((k, t, f, newest[k][times[place - 1]] if place else None))
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_asof_empty_sides(spark):
    facts = spark.createDataFrame([(1, 5)], "k int, t int")
    dim = spark.createDataFrame([(1, 4, 9)], "k int, at int, v int")
    assert [tuple(r) for r in asof_join(facts, dim.limit(0), "k", "t", "at", ["v"]).collect()] == [(1, 5, None)]
    assert asof_join(facts.limit(0), dim, "k", "t", "at", ["v"]).count() == 0


# ---------------------------------------------------------------- Bloom filters
def test_bloom_filter_never_denies_and_seldom_lies(spark):
    ids = spark.range(0, 40_000, 2)
    bits = bloom.bits_for(20_000)
    sketch = spark.createDataFrame(bloom.build(ids, "id", bits).collect(), "bits long, words array<long>")
    told = spark.range(0, 80_000).select("id", bloom.might_contain(F.col("id"), bloom.as_column(sketch)).alias("maybe"))
    inside = (F.col("id") % 2 == 0) & (F.col("id") < 40_000)
    r = told.agg(F.count_if(inside & ~F.col("maybe")).alias("denied"), F.count_if(~inside & F.col("maybe")).alias("lies"), F.count_if(~inside).alias("out")).first()
    assert r["denied"] == 0 and 0 < r["lies"] / r["out"] < 0.02


@pytest.mark.parametrize("bits", [64, 4096])
def test_unseen_users_are_exact_at_any_filter_size(spark, bits):
    users = spark.createDataFrame([(k,) for k in range(500)] + [(None,)], "user_id long")
    seen = spark.createDataFrame([(k,) for k in range(0, 500, 3)], "user_id long")
    got = R.unseen_users(users, bloom.build(seen, "user_id", bits), seen)
    assert sorted((r[0] for r in got.collect()), key=lambda v: (v is None, v)) == [k for k in range(500) if k % 3] + [None]


def test_bloom_of_nothing(spark):
    empty = bloom.build(spark.range(0), "id", 64)
    assert [r["maybe"] for r in spark.range(3).select(bloom.might_contain(F.col("id"), bloom.as_column(empty)).alias("maybe")).collect()] == [False] * 3


# ---------------------------------------------------------------- KV source
@pytest.fixture(scope="module")
def store(spark):
    rnd = random.Random(4)
    rows = [(f"2024-01-{rnd.randrange(1, 13):02d} {rnd.randrange(24):02d}:00:0{rnd.randrange(3)},{rnd.randrange(3)}", str(rnd.randrange(50)), str(rnd.randrange(1, 6))) for _ in range(6000)]
    path = shared_path(spark, "t_kv")
    KV.write_store(spark.createDataFrame(rows, "rowkey string, it string, ty string").repartition(3), path)
    return path, rows


@pytest.mark.parametrize(("start", "stop", "reverse", "limit"), [
    (None, None, True, None), ("2024-01-03", "2024-01-05 07", True, 25), ("2024-01-03", "2024-01-05 07", False, 700),
    ("2024-01-12", None, True, 1), (None, "2024-01-02", False, 9999), ("2025", None, True, 5), ("2024-01-05 03", "2024-01-05 03", True, 5)])
def test_kv_scan(spark, store, start, stop, reverse, limit):
    path, rows = store
    held = [r for r in rows if (start is None or r[0] >= start) and (stop is None or r[0] < stop)]
    held.sort(key=lambda r: (r[1], r[2]))
    held.sort(key=lambda r: r[0], reverse=reverse)
    want = [(k.split(",")[0], int(k.split(",")[1]), int(it), int(ty)) for k, it, ty in held[:limit]]
    assert [tuple(r) for r in KV.log_scan(spark, path, start, stop, reverse, limit, page=100).collect()] == want


def test_kv_limit_stops_reading(store):
    path, rows = store
    reader = KV._Reader({"path": path, "limit": "10", "reverse": "true", "page": "7"})
    for part in reader.partitions():
        got = [b.num_rows for b in reader.read(part)]
        date = part.files[0].split("dt=")[1][:10]
        keys = sorted((r[0] for r in rows if r[0].startswith(date)), reverse=True)
        assert 10 <= sum(got) <= 16 + max(Counter(keys).values()) < len(keys) and max(got) <= 7


# ---------------------------------------------------------------- panes
def test_months_before():
    assert PN.months_before(dt.datetime(2024, 3, 31, 2), 1) == dt.datetime(2024, 2, 29, 2)
    assert PN.months_before(dt.datetime(2024, 1, 15), 2) == dt.datetime(2023, 11, 15)
    assert PN.months_before(dt.datetime(2024, 12, 31), 12) == dt.datetime(2023, 12, 31)


def test_panes_equal_whole_recount_and_read_only_what_changed(spark):
    """Micro-batches out of order, with late rows; a window of one month, so panes also leave it."""
    rnd = random.Random(8)
    base = dt.datetime(2024, 1, 1)
    log = [(rnd.randrange(5), rnd.randrange(8), base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 70))) for _ in range(3000)]
    log.sort(key=lambda r: r[2])
    log[100], log[2500] = log[2500], log[100]
    panes = PN.Panes(shared_path(spark, "t_panes"), ["city"], months=1)
    shape = "city int, sku_id long, action_time timestamp_ntz"
    last, seen, before = None, [], None
    for epoch, lo in enumerate(range(0, 3000, 500)):
        seen += log[lo:lo + 500]
        panes.add(spark.createDataFrame(log[lo:lo + 500], shape), epoch)
        anchor = base + dt.timedelta(days=11 * (epoch + 1))
        got = {(r["list_key"], r["sku_id"]): r["n"] for r in panes.refresh(spark, anchor, epoch, last).collect()}
        low = PN.months_before(anchor, 1)
        assert got == Counter((c, s) for c, s, t in seen if low < t <= anchor)
        last = (anchor, epoch)
        added, retired, all_units = panes.reads[-1]
        if epoch >= 4:
            assert retired > 0 and added + retired < all_units
        before = got
    panes.refresh(spark, last[0], 5, last)          # nothing new: no unit is read
    assert panes.reads[-1][:2] == (0, 0) and before


def test_refresh_by_panes_lists_equal_content_lists(spark):
    clicks, product, user = fx.clicks(spark, SF001), fx.products(spark, SF001), fx.users(spark, SF001)
    src, out = shared_path(spark, "t_panes_in"), []
    J.stage_files(clicks.withColumn("dt", F.to_date("action_time")), src, partition_by="dt")
    panes = PN.Panes(shared_path(spark, "t_panes_root"), ["city", "brand"])

    def keep(totals, anchor, epoch):
        out.append((anchor, {tuple(r) for r in PN.lists_of(totals, 3).collect()}))

    q = PN.refresh_by_panes(J.file_stream(spark, src, clicks.schema.add("dt", "date"), max_files_per_trigger=50), lambda b: R.recall_input(b, product, user), panes,
                            shared_path(spark, "t_panes_ck"), keep, every=dt.timedelta(days=12))
    q.awaitTermination()
    assert len(out) >= 2
    for anchor, lists in out:
        until = R.recall_input(clicks.where(F.col("action_time") <= F.lit(anchor)), product, user)
        assert lists == {tuple(r) for r in R.content_lists(until, ["city", "brand"], 3).collect()}


# ---------------------------------------------------------------- streaming state
def test_lists_are_read_from_state_after_a_restart(spark):
    clicks = fx.clicks(spark, SF001)
    want = {tuple(r) for r in R.latest_items(clicks, 10).collect()}
    for job, read in ((J.latest_items_state, J.latest_from_state), (J.latest_items_list_state, J.latest_from_list_state)):
        src, ck = shared_path(spark, "t_state_in"), shared_path(spark, "t_state_ck")
        for half in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
            clicks.where(half).write.mode("append").parquet(src)
            job(J.file_stream(spark, src, clicks.schema), None, ck, n=10).awaitTermination()
        assert {tuple(r) for r in read(spark, ck).collect()} == want
