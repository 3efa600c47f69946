"""Distributed building blocks checked against brute force on small inputs:
exact ranking / prefix sums, block co-occurrence, dictionary, sampling,
exact split and AUC."""

import itertools
import math
import random

import pandas as pd
import pytest

from cartwheel.functions.ranking import prefix_sums, sorted_index
from cartwheel.operators import encode as E
from cartwheel.operators import metrics as MT
from cartwheel.operators import sampling as SM
from cartwheel.operators import similarity as S


def test_sorted_index_matches_pandas_rank(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([0, 1, 2]), rnd.randrange(10_000)) for _ in range(3000)]
    rows = list({r for r in rows})
    df = spark.createDataFrame(rows, "g int, v long")
    got = {(r.g, r.v): r.idx for r in sorted_index(df, ["v"], within=["g"], num_partitions=7).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    pdf["idx"] = pdf.groupby("g")["v"].rank(method="first").astype(int) - 1
    assert got == {(g, v): i for g, v, i in pdf.itertuples(index=False)}


def test_prefix_sums_match_cumsum(spark):
    rows = [(i, (i * 7) % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, x long")
    got = {r.k: r.x_before for r in prefix_sums(df, ["k"], ["x"], num_partitions=6).collect()}
    run, want = 0, {}
    for k, x in rows:
        want[k] = run
        run += x
    assert got == want


def _brute_cosine(pairs):
    users = {}
    for u, e in pairs:
        users.setdefault(e, set()).add(u)
    out = {}
    for a, b in itertools.permutations(users, 2):
        co = len(users[a] & users[b])
        if co:
            out[(a, b)] = (co, co / math.sqrt(len(users[a]) * len(users[b])))
    return out


@pytest.mark.parametrize("blocks,salts", [(1, 1), (3, 2), (5, 4)])
def test_block_cooccurrence_equals_brute_force(spark, blocks, salts):
    rnd = random.Random(blocks * 10 + salts)
    pairs = {(rnd.randrange(40), rnd.randrange(25)) for _ in range(400)}
    pairs |= {(999, e) for e in range(25)}  # one user touching every entity (hot key)
    inc = spark.createDataFrame(sorted(pairs), "user long, entity long")
    got = {(r.e1, r.e2): (r.co, r.sim) for r in S.cosine_similarity(inc, blocks=blocks, salts=salts).collect()}
    want = _brute_cosine(pairs)
    assert got.keys() == want.keys()
    for k, (co, sim) in want.items():
        assert got[k][0] == co and abs(got[k][1] - sim) < 1e-12
        assert 0 < sim <= 1 + 1e-12
        assert got[(k[1], k[0])][0] == co  # symmetric


def test_dictionary_is_contiguous_bijection_and_unseen_policies(spark):
    df = spark.createDataFrame([(1, 10), (1, 30), (2, 20), (5, 10)], "a long, b long")
    d = E.build_dictionary(df, ["a", "b"])
    vals = sorted((r.field_id, r.value, r.code, r.feature_id) for r in d.values.collect())
    assert vals == [(0, 1, 0, 0), (0, 2, 1, 1), (0, 5, 2, 2), (1, 10, 0, 3), (1, 20, 1, 4), (1, 30, 2, 5)]
    assert d.total == 6
    new = spark.createDataFrame([(1, 99), (7, 10)], "a long, b long")
    keep = sorted((r.f_a, r.f_b) for r in E.encode_columns(new, d, "keep").collect())
    assert keep == [(0, 6 + 1), (6 + 0, 3)]
    assert E.encode_columns(new, d, "skip").count() == 0
    with pytest.raises(Exception):
        E.encode_columns(new, d, "error").collect()


def test_negative_samples_properties(spark):
    import datetime as dt
    rnd = random.Random(3)
    rows = []
    for u in range(30):
        for j in range(rnd.randrange(1, 40)):
            rows.append((u, rnd.randrange(60), 1, dt.datetime(2024, 1, 1), u * 1000 + j))
    a = spark.createDataFrame(rows, "user_id long, sku_id long, type tinyint, action_time timestamp_ntz, event_id long")
    neg = SM.negative_samples(a, seed=5)
    got = [(r.user_id, r.sku_id) for r in neg.collect()]
    assert len(got) == len(set(got))                       # sampled without replacement
    touched = {(u, s) for u, s, *_ in rows}
    assert not (set(got) & touched)                        # no negative is a positive
    items = {s for _, s, *_ in rows}
    assert {s for _, s in got} <= items
    n = len(items)
    cnt = pd.DataFrame(rows).groupby(0).size().to_dict()
    per = pd.Series([u for u, _ in got]).value_counts().to_dict()
    for u, c in cnt.items():                               # m within the reference's randint range
        m_max = min(c + c // 10 + 2, n)
        assert per.get(u, 0) <= m_max


def test_split_first_k_matches_row_number(spark):
    rows = [(u, s) for u in range(50) for s in range(u % 7, 40, 3)]
    df = spark.createDataFrame(rows, "user_id long, sku_id long")
    keyed = SM.shuffle_key(df, ["user_id", "sku_id"], seed=9).toPandas()
    keyed = keyed.sort_values(["_shuffle", "user_id", "sku_id"]).reset_index(drop=True)
    for k in (0, 1, 17, 200, len(rows), len(rows) + 5):
        want = set(map(tuple, keyed.iloc[:k][["user_id", "sku_id"]].to_numpy().tolist()))
        got = {(r.user_id, r.sku_id) for r in SM.split_first_k(df, k, ["user_id", "sku_id"], seed=9,
                                                               bucket_bits=4).where("part = 'train'").collect()}
        assert got == want


def test_auc_exact_matches_pairwise_definition(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice([0, 1]), rnd.randrange(8)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score long")
    got = MT.auc_exact(df).first().auc
    pos = [s for y, s in rows if y == 1]
    negs = [s for y, s in rows if y == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in negs) / (len(pos) * len(negs))
    assert abs(got - want) < 1e-12


def test_step_primes_are_prime_and_above_2_40():
    ps = SM.step_primes()
    assert len(ps) == SM.N_STEP_PRIMES and min(ps) > 2 ** 40
    assert all(all(p % q for q in range(2, 2000)) for p in ps[:5])
