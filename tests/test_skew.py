"""A user holding a third of all rows: key operators stay exact (brute force
checks) and the per-user top-n is limited before its shuffle."""

import datetime as dt
import random

import pytest

from cartwheel.operators import recall as R
from cartwheel.operators import sampling as SM
from cartwheel.operators import similarity as S
from cartwheel.operators import transform as X

ACT = "user_id long, sku_id long, type tinyint, action_time timestamp_ntz, event_id long"


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    rows, eid = [], 0
    t0 = dt.datetime(2024, 1, 1)
    for u in range(1, 41):                       # 40 ordinary users, ~25 actions each
        for _ in range(25):
            eid += 1
            rows.append((u, rnd.randrange(80), rnd.randrange(1, 6), t0 + dt.timedelta(minutes=eid), eid))
    for _ in range(len(rows) // 2):              # user 0: a third of all rows
        eid += 1
        rows.append((0, rnd.randrange(80), rnd.randrange(1, 6), t0 + dt.timedelta(minutes=eid), eid))
    return rows, spark.createDataFrame(rows, ACT)


def test_hot_user_share(skewed):
    rows, _ = skewed
    assert abs(sum(1 for r in rows if r[0] == 0) / len(rows) - 1 / 3) < 0.01


def test_latest_items_with_hot_user(spark, skewed):
    rows, df = skewed
    got = {(r.user_id, r.rnk, r.sku_id) for r in R.latest_items(df, 10).collect()}
    want = set()
    for u in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == u), key=lambda r: (r[3], r[4]), reverse=True)[:10]
        want |= {(u, i + 1, r[1]) for i, r in enumerate(mine)}
    assert got == want
    plan = R.latest_items(df, 10)._sc._jvm.PythonSQLUtils.explainString(
        R.latest_items(df, 10)._jdf.queryExecution(), "formatted")
    assert "WindowGroupLimit" in plan          # partial limit runs before the exchange


def test_pair_labels_with_hot_user(spark, skewed):
    rows, df = skewed
    cnt = {}
    for u, s, *_ in rows:
        cnt[(u, s)] = cnt.get((u, s), 0) + 1
    got = {(r.user_id, r.sku_id): (r.cnt, r.label) for r in X.pair_labels(df).collect()}
    assert got == {k: (c, 1 if c > 1 else 0) for k, c in cnt.items()}


def test_similarity_with_hot_user_many_blocks(spark, skewed):
    rows, df = skewed
    inc = df.selectExpr("user_id AS user", "sku_id AS entity").distinct()
    got = {(r.e1, r.e2): r.co for r in S.cosine_similarity(inc, blocks=4, salts=3).collect()}
    users = {}
    for u, s, *_ in rows:
        users.setdefault(s, set()).add(u)
    want = {(a, b): len(users[a] & users[b]) for a in users for b in users
            if a != b and users[a] & users[b]}
    assert got == want


def test_negative_draws_split_in_chunks_are_identical(spark, skewed):
    _, df = skewed
    big = {tuple(r) for r in SM.negative_samples(df, seed=3).collect()}
    small = {tuple(r) for r in SM.negative_samples(df, seed=3, chunk=7).collect()}
    assert big == small and len(big) > 0


def test_negative_samples_without_items_is_empty(spark):
    df = spark.createDataFrame([(1, None, 1, dt.datetime(2024, 1, 1), 1)], ACT)
    assert SM.negative_samples(df).count() == 0


def test_groups_of_block_pairs_stay_small(spark):
    """Salts count what a group really holds: the rows of two blocks, also when one block has most rows."""
    rows = spark.range(3000).selectExpr("id as user", "IF(id % 10 < 8, 3L, id % 25) as entity")
    salts = S._salts(rows, 3, 500)
    held = rows.groupBy(S._block(3)).count().agg({"count": "max"}).first()[0]
    assert 2 * held / salts <= 500 < 2 * held / (salts - 1)
