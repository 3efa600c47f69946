"""Leaf-wise trees against a plain version, and what their splits may use."""
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import gbdt as G
from cartwheel.operators import models as M


def plain_tree(rows, n_features, numeric, leaves, min_rows=G.MIN_ROWS, most=G.MOST_CATEGORIES):
    """Best-first growth over (label, bins): ([(node, feature, gain, left rows)], {leaf: rows})."""
    share = sum(y > 0 for y, _ in rows) / len(rows)
    data = [(math.floor((share - (y > 0)) * G.SCALE), math.floor(share * (1 - share) * G.SCALE), b) for y, b in rows]

    def part(g, h, l2):
        g, h = g / G.SCALE, h / G.SCALE
        return g * g / (h + l2)

    def best(members):
        tg, th, found = sum(r[0] for r in members), sum(r[1] for r in members), []
        for f in range(n_features):
            hist = defaultdict(lambda: [0, 0, 0])
            for g, h, b in members:
                for k, v in enumerate((g, h, 1)):
                    hist[b[f]][k] += v
            if f in numeric:
                ways = [(0, sorted(hist), 0.0)]
            else:
                able = [b for b in hist if hist[b][2] >= G.CAT_SMOOTH]
                ratio = {b: (hist[b][0] / G.SCALE) / (hist[b][1] / G.SCALE + G.CAT_SMOOTH) for b in able}
                ways = [(1, sorted(able, key=lambda b: (ratio[b], b))[:most], G.CAT_L2), (2, sorted(able, key=lambda b: (-ratio[b], b))[:most], G.CAT_L2)]
            for way, order, l2 in ways:
                lg = lh = ln = 0
                for pos, b in enumerate(order):
                    lg, lh, ln = lg + hist[b][0], lh + hist[b][1], ln + hist[b][2]
                    if ln >= min_rows and len(members) - ln >= min_rows:
                        gain = part(lg, lh, l2) + part(tg - lg, th - lh, l2) - part(tg, th, 0.0)
                        if gain > 0:
                            found.append((-gain, f, way, pos, set(order[:pos + 1])))
        return min(found, key=lambda x: x[:4]) if found else None

    nodes, order = {"": data}, []
    while len(nodes) < leaves:
        options = sorted((b[0], n, b) for n, m in nodes.items() for b in [best(m)] if b)
        if not options:
            break
        _, node, (loss, f, _, _, left) = options[0]
        members = nodes.pop(node)
        nodes[node + "L"], nodes[node + "R"] = [r for r in members if r[2][f] in left], [r for r in members if r[2][f] not in left]
        order.append((node, f, round(-loss, 9), len(nodes[node + "L"])))
    return order, {n: len(m) for n, m in nodes.items()}


def sample(n, seed):
    rnd = random.Random(seed)
    good = {f"c{k}" for k in range(0, 60, 7)}
    rows = []
    for _ in range(n):
        c, d, x = f"c{rnd.randrange(60)}", rnd.randrange(4), rnd.randrange(30) / 2
        p = 0.8 if c in good else 0.5 if x > 9 and d == 2 else 0.1
        rows.append((int(rnd.random() < p), c, d, x))
    return rows


@pytest.mark.parametrize(("leaves", "most"), [(2, 32), (9, 32), (40, 5)])
def test_growth_equals_plain_version(spark, leaves, most):
    rows = sample(1500, leaves)
    df = spark.createDataFrame(rows, "label int, c string, d int, x double").repartition(3)
    bins = G.fit_bins(df, ["c", "d", "x"], ["c", "d"])
    data = G.Data.write(df.withColumn("fold", F.lit(-1)), bins)
    tree = G.grow(data, spark, leaves, most=most)[0]
    told = [(r["label"], [r["b0"], r["b1"], r["b2"]]) for r in data.read(spark).collect()]
    order, ends = plain_tree(told, 3, {2}, leaves, most=most)
    assert [(n, tree.best[n].feature, round(tree.best[n].gain, 9), tree.best[n].left[2]) for n in tree.order] == order
    assert {n: s[2] for n, s in tree.leaves().items()} == ends


def test_rows_reach_their_leaves(spark):
    """Scores of the training rows add up by leaf: as many rows a score as the leaves of that value hold."""
    df = spark.createDataFrame(sample(800, 1), "label int, c string, d int, x double").repartition(3)
    bins = G.fit_bins(df, ["c", "d", "x"], ["c", "d"])
    data = G.Data.write(df.withColumn("fold", F.lit(-1)), bins)
    tree = G.grow(data, spark, 12)[0]
    seen = G.Data.write(df.withColumn("fold", F.lit(0)), bins)        # the same rows as the tree's test rows
    seen.shares = data.shares
    got = {round(r["score"], 9): r["n"] for r in G.score(seen, spark, {0: tree}).groupBy("score").agg(F.count("*").alias("n")).collect()}
    want = defaultdict(int)
    for s in tree.leaves().values():
        want[round(1 / (1 + math.exp(-(data.base(0) + G.RATE * G.value_of(s)))), 9)] += s[2]
    assert got == dict(want)


def test_bins(spark):
    df = spark.createDataFrame([(float(k % 300) if k % 50 else None, float(k % 3), k) for k in range(3000)], "many double, few double, id long")
    bins = G.fit_bins(df, ["many", "few", "id"], ["id"])
    assert bins.edges["few"] == [0.0, 1.0] and len(bins.edges["many"]) <= G.MAX_BINS - 1
    seen = df.select("many", "few", *bins.columns()).select("many", "few", F.array(bins.text(0), bins.text(1)).alias("b")).collect()
    assert all(r["b"][0] == "00000" for r in seen if r["many"] is None) and {r["b"][1] for r in seen} == {"00001", "00002", "00003"}
    by_value = sorted((r["many"], r["b"][0]) for r in seen if r["many"] is not None)
    assert [b for _, b in by_value] == sorted(b for _, b in by_value)        # bins follow the values


def test_many_categories_stay_apart(spark):
    """Over a thousand ids with equal frequency, half of them good: sets of ids tell them apart."""
    rnd = random.Random(5)
    rows = [(int(k % 2 == 0), f"id{k}", rnd.random()) for k in range(1100) for _ in range(26)]
    df = spark.createDataFrame(rows, "label int, id string, x double").repartition(4)
    r = M.gbt_cv(df, ["id", "x"], folds=2, categorical=["id"], fold_keys=["id", "x"], leaves=40).first()
    assert r.auc > 0.85


def test_folds_do_not_see_their_rows(spark):
    rnd = random.Random(6)
    df = spark.createDataFrame([(rnd.randrange(2), str(k)) for k in range(800)], "label int, c string")   # every value once
    scored = G.cross_validated(df, ["c"], ["c"], 4, 7, ["c"])
    assert scored.count() == 800 and scored.select("fold").distinct().count() == 4
    assert scored.groupBy("fold").agg(F.countDistinct("score").alias("n")).where("n > 1").count() == 0    # nothing to learn


def test_constant_label_and_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (1, "a", 2.0)] * 40, "label int, c string, x double")
    bins = G.fit_bins(df, ["c", "x"], ["c"])
    data = G.Data.write(df.withColumn("fold", F.lit(-1)), bins)
    assert list(G.grow(data, spark, 5)[0].leaves()) == [""]
    assert G.grow(G.Data.write(df.limit(0).withColumn("fold", F.lit(-1)), bins), spark, 5) == {}


def test_rounds_read_smaller_children_only(spark, monkeypatch):
    """No round reads more than half of the rows of a split node, and no stored histogram differs from the rows it stands for."""
    df = spark.createDataFrame(sample(1500, 4), "label int, c string, d int, x double").repartition(3)
    bins = G.fit_bins(df, ["c", "d", "x"], ["c", "d"])
    data = G.Data.write(df.withColumn("fold", F.lit(-1)), bins)
    read, plain = [], G._histograms

    def seen(data, spark, trees, wanted):
        read.extend((trees[t].sums(n[:-1])[2], trees[t].sums(n)[2]) for t, nodes in wanted.items() for n in nodes)
        return plain(data, spark, trees, wanted)

    monkeypatch.setattr(G, "_histograms", seen)
    tree = G.grow(data, spark, 12)[0]
    assert read and all(2 * n <= parent for parent, n in read)
    stored = G._Stored(spark, [2])
    stored.add(G._root_histograms(data, spark, [0]), {0: [""]})
    small = [tree.smaller(n) for n in tree.order]
    stored.add(plain(data, spark, {0: tree}, {0: small}), {0: small})
    ends = list(tree.leaves())
    key = ["node", "feature", "bin", "g", "h", "n"]
    got = {tuple(r) for r in stored.of({0: tree}, {0: ends}).select(*key).collect()}
    want = {tuple(r) for r in G._kept(plain(data, spark, {0: tree}, {0: ends}), [2]).select(*key).collect()}
    assert got == want
