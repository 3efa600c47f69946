"""Event-time refresh trigger: history append + refresh at 2-hour boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from paths import SF001

from cartwheel.operators import recall as R
from cartwheel.plans.offline import history_until
from cartwheel.session import shared_path
from cartwheel.sources import fixtures as fx
from cartwheel.streaming import jobs as J


def test_refresh_fires_on_event_time_boundaries(spark):
    clicks = fx.clicks(spark, SF001)
    src = shared_path(spark, "t_refresh_in")
    J.stage_files(clicks.withColumn("dt", F.to_date("action_time")), src, partition_by="dt")
    schema = clicks.schema.add("dt", "date")
    hist, state, ck, out = (shared_path(spark, x) for x in ("t_hist", "t_state", "t_ck", "t_lists"))
    fired = []

    def on_anchors(history, anchors, epoch):
        fired.extend(anchors)
        anchor = anchors[-1]
        R.hottest_lists(history_until(history.drop("dt"), anchor), (1, 7), 5) \
            .write.mode("overwrite").parquet(f"{out}/last")

    q = J.refresh_on_event_time(J.file_stream(spark, src, schema, max_files_per_trigger=10), hist, state, ck,
                                on_anchors)
    q.awaitTermination()
    newest = clicks.agg(F.max("action_time")).first()[0]
    want_anchor = J.period_floor(newest - dt.timedelta(minutes=10), dt.timedelta(hours=2))
    assert len(fired) >= 2 and fired[-1] == want_anchor
    assert all(b - a == dt.timedelta(hours=2) for a, b in zip(fired, fired[1:]))  # every boundary, once, in order
    assert spark.read.parquet(hist).count() == clicks.count()          # every action appended once
    got = {tuple(r) for r in spark.read.parquet(f"{out}/last").collect()}
    want = {tuple(r) for r in R.hottest_lists(history_until(clicks, want_anchor), (1, 7), 5).collect()}
    assert got == want


def test_latest_state_stream_matches_batch_and_compacts(spark):
    clicks = fx.clicks(spark, SF001)
    src = shared_path(spark, "t_latest_in")
    J.stage_files(clicks.withColumn("dt", F.to_date("action_time")), src, partition_by="dt")
    sink, ck, compacted = shared_path(spark, "t_latest_out"), shared_path(spark, "t_latest_ck"), \
        shared_path(spark, "t_latest_cur")
    q = J.latest_items_state(J.file_stream(spark, src, clicks.schema.add("dt", "date"), max_files_per_trigger=7),
                             sink, ck, n=10)
    q.awaitTermination()
    want = {tuple(r) for r in R.latest_items(clicks, 10).collect()}
    assert {tuple(r) for r in J.current_latest(spark.read.parquet(sink)).collect()} == want
    cur = J.compact_latest(spark, sink, compacted)
    assert {(r.user_id, r.rnk, r.sku_id) for r in cur.collect()} == want
    assert cur.groupBy("user_id").agg(F.countDistinct("version").alias("v")).where("v > 1").count() == 0


def test_offline_refresh_writes_every_snapshot(spark):
    from cartwheel.plans.offline import refresh
    clicks = fx.clicks(spark, SF001)
    train = clicks.where(F.col("action_time") < F.lit("2024-01-17").cast("timestamp_ntz"))
    snap = refresh(clicks, train, fx.products(spark, SF001), fx.users(spark, SF001),
                   shared_path(spark, "t_snap"), with_lines=True, with_item_cf=True)
    for name in ("enriched", "sets", "dict_values", "dict_fields", "content", "hottest", "toplists",
                 "brand_sim", "item_sim", "user_cf", "latest"):
        assert snap.read(spark, name).count() > 0, name
    assert spark.read.text(snap.path("train_ffm") + ".txt").count() == fx.clicks(spark, SF001).where(
        F.col("action_time") < F.lit("2024-01-17").cast("timestamp_ntz")).select("user_id", "sku_id").distinct().count()
    got = {tuple(r) for r in snap.read(spark, "hottest").where("days = 7").select("rnk", "sku_id", "cnt").collect()}
    assert got == {tuple(r) for r in R.hottest(clicks, 7, 10).collect()}


def test_rerank_sends_unknown_users_to_cold_start(spark):
    from cartwheel.operators import candidates as C
    from cartwheel.plans.offline import refresh
    from cartwheel.streaming import online as O
    clicks = fx.clicks(spark, SF001)
    product, user = fx.products(spark, SF001), fx.users(spark, SF001)
    snap = refresh(clicks, clicks, product, user, shared_path(spark, "t_snap_cold"))
    weights = C.hashed_fm_weights(snap.read(spark, "dict_values"))
    known_user = clicks.select("user_id").first()[0]
    users = spark.createDataFrame([(known_user,), (10 ** 9,)], "user_id long")
    ranked, release = O.rerank_for(users, snap, weights)
    out = ranked.collect()
    release()
    new = sorted((r.rnk, r.item_id) for r in out if r.user_id == 10 ** 9)
    assert new == [(r.rnk, r.sku_id) for r in R.hottest(clicks, 7, 3).orderBy("rnk").collect()]
    assert all(r.score is not None for r in out if r.user_id == known_user)


def test_candidates_can_use_live_latest_state(spark):
    from cartwheel.plans.offline import refresh
    from cartwheel.streaming import online as O
    clicks = fx.clicks(spark, SF001)
    product, user = fx.products(spark, SF001), fx.users(spark, SF001)
    snap = refresh(clicks, clicks, product, user, shared_path(spark, "t_snap_live"))
    users = clicks.select("user_id").distinct()
    a = {tuple(r) for r in O.candidates_for(users, snap).collect()}
    b = {tuple(r) for r in O.candidates_for(users, snap, latest=R.latest_items(clicks, 10)).collect()}
    assert a == b and a


def test_list_state_variant_matches_batch(spark):
    clicks = fx.clicks(spark, SF001)
    src = shared_path(spark, "t_tws_in")
    J.stage_files(clicks.withColumn("dt", F.to_date("action_time")), src, partition_by="dt")
    sink, ck = shared_path(spark, "t_tws_out"), shared_path(spark, "t_tws_ck")
    q = J.latest_items_list_state(J.file_stream(spark, src, clicks.schema.add("dt", "date"),
                                                max_files_per_trigger=10), sink, ck, n=10)
    q.awaitTermination()
    want = {tuple(r) for r in R.latest_items(clicks, 10).collect()}
    assert {tuple(r) for r in J.current_latest(spark.read.parquet(sink)).collect()} == want


def test_refresh_while_a_reader_is_open(spark):
    from cartwheel.plans.offline import refresh
    clicks = fx.clicks(spark, SF001)
    product, user, root = fx.products(spark, SF001), fx.users(spark, SF001), shared_path(spark, "t_snap_versions")
    first = refresh(clicks, clicks, product, user, root, anchor="2024-01-10 00:00:00")
    open_reader = first.current(spark).read(spark, "latest")
    before = open_reader.count()
    second = refresh(clicks, clicks, product, user, root)
    assert open_reader.count() == before                       # its files are still there
    assert first.current(spark).version == second.version      # and the next look-up sees the new version
    assert first.current(spark).read(spark, "latest").count() == second.read(spark, "latest").count()


def test_staged_files_follow_the_days_not_the_input_tasks(spark, tmp_path):
    """A stream that takes some files at a time gets as many batches from many input tasks as from one."""
    rows = spark.range(0, 600, numPartitions=12).select("id", (F.col("id") % 3).alias("dt"))
    J.stage_files(rows, str(tmp_path / "in"), partition_by="dt")
    assert len(list((tmp_path / "in").rglob("*.parquet"))) == 3 and spark.read.parquet(str(tmp_path / "in")).count() == 600


def test_newest_keeps_held_rows_first_among_equal_ones():
    import numpy as np
    import pandas as pd

    held = [np.array([5, 3]), np.array([1, 1]), np.array([10, 11])]
    got = J._newest(held, pd.DataFrame({"ts_us": [5, 9, 3], "event_id": [1, 0, 2], "sku_id": [20, 21, 22]}), 4)
    assert [x.tolist() for x in got] == [[9, 5, 5, 3], [0, 1, 1, 2], [21, 10, 20, 22]]
