"""Keyed snapshot tables: what a lookup reads, and how versions retire."""
import os

import pytest
from pyspark.sql import functions as F

from paths import SF001

from cartwheel.operators import candidates as C
from cartwheel.operators import encode as E
from cartwheel.operators import recall as R
from cartwheel.plans.offline import Snapshots, refresh
from cartwheel.session import local_fs_path, shared_path
from cartwheel.sources import fixtures as fx
from cartwheel.sources import keyed
from cartwheel.streaming import online as O


@pytest.fixture(scope="module")
def snap(spark):
    clicks = fx.clicks(spark, SF001)
    train = clicks.where(F.col("action_time") < F.lit("2024-01-17").cast("timestamp_ntz"))
    return refresh(clicks, train, fx.products(spark, SF001), fx.users(spark, SF001), shared_path(spark, "t_keyed"), buckets=24)


def files_read(df):
    return {f for f in df.inputFiles()}


def test_lookup_equals_semi_join(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("a").alias("g"))
    path = shared_path(spark, "t_lookup")
    keyed.write_keyed(rows, path, ["g", "k"], 32)
    table = spark.read.parquet(path)
    wanted = spark.createDataFrame([("a", 7), ("a", 4999), ("a", 7), ("b", 8), (None, 9), ("a", None)], "g string, k int")  # other type of key
    got = keyed.lookup(table, ["g", "k"], wanted.select("g", F.col("k").cast("long").alias("k")), 32)
    assert sorted((r.k, r.v) for r in got.collect()) == [(7, 14), (4999, 9998)]
    assert keyed.lookup(table, ["g", "k"], wanted.limit(0), 32).count() == 0
    assert keyed.buckets_for(10) == 16 and keyed.buckets_for(10 ** 12) == keyed.MOST_BUCKETS


def test_one_user_reads_one_bucket(spark, snap):
    """Files that the lookups of a single user's request open, against the files there are."""
    one = fx.clicks(spark, SF001).where("sku_id is not null").select("user_id").limit(1)
    for name in ("users", "latest"):
        table = snap._table(spark, name)
        hit = keyed.pruned(table, ["user_id"], one, snap.buckets)
        bucket = one.select(keyed.bucket_of(["user_id"], snap.buckets)).first()[0]
        opened = {r[0] for r in hit.select(F.input_file_name()).distinct().collect()}
        assert len(opened) == 1 and all(f"/kb={bucket}/" in f for f in opened) and len(files_read(table)) > 12
    batch = O.Batch(one, snap)
    seen = batch.find("latest", batch.users)
    items = keyed.pruned(snap._table(spark, "items"), ["sku_id"], seen, snap.buckets)
    read = files_read(items) & {r[0] for r in items.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(read) <= min(10, seen.count()) < len(files_read(snap._table(spark, "items")))
    batch.release()


def test_candidates_and_ids_equal_the_batch_plan(spark, snap):
    """The online path by lookups gives what the batch operators give over whole tables."""
    clicks, product, user = fx.clicks(spark, SF001), fx.products(spark, SF001), fx.users(spark, SF001)
    users = spark.createDataFrame([(r[0],) for r in clicks.select("user_id").distinct().limit(6).collect()] + [(10 ** 9,)], "user_id long")
    batch = O.Batch(users, snap)
    cands = batch.candidates(batch.users)
    got = {tuple(r) for r in batch.encoded(cands).collect()}
    content, hot = snap.read(spark, "content"), snap.read(spark, "hottest").where("days = 1")
    seeds = R.latest_items(clicks, 10).join(users, "user_id", "left_semi")
    cf = C.online_cf(seeds, product, snap.read(spark, "brand_sim"), content.where("list_kind = 'brand'"))
    whole = C.candidates_union(users, user, content, hot, cf, 10)
    assert {tuple(r) for r in cands.collect()} == {tuple(r) for r in whole.collect()}
    want = E.encode_candidates(whole, product, user, snap.dictionary(spark), unseen="keep")
    assert got == {tuple(r) for r in want.collect()} and any(r[0] == 10 ** 9 for r in got)
    batch.release()


def test_old_versions_retire(spark):
    clicks = fx.clicks(spark, SF001).limit(300)
    product, user, root = fx.products(spark, SF001), fx.users(spark, SF001), shared_path(spark, "t_retire")
    names = [refresh(clicks, clicks, product, user, root, keep=2).version for _ in range(3)]
    left = sorted(n for n in os.listdir(local_fs_path(root)) if n.startswith("version_"))
    assert left == sorted(names[1:])
    reader = Snapshots(root, names[1])
    assert reader.current(spark).version == names[2] and reader.read(spark, "latest").count() > 0
    assert spark.read.parquet(f"{root}/pointers").count() == 2
