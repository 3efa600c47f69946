"""The convolutional classifier against a plain version, numeric gradients and held-out labels."""
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import toxicity as T
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def raw_of(*texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(b) for b in data])))


def plain_pool(net, rows):
    """Maxima by one loop a window; ``rows``: the (words, 3) table rows of one text."""
    x = [sum(net.table[r] for r in word) for word in rows.tolist()]
    out = []
    for w in net.filters:
        for f in range(T.FILTERS):
            best = -math.inf
            for t in range(len(x)):
                best = max(best, sum(float(x[t + k] @ w[k][:, f]) for k in range(len(w)) if t + k < len(x)))
            out.append(best)
    return out


def random_net(bits=8, seed=3):
    net = T.new_net(bits, seed)
    net.table = np.random.default_rng(seed).normal(0, 1, net.table.shape).astype(np.float32)
    return net


def test_words_share_rows():
    rows, first = T.buckets(*raw_of("Idiot idiot!", "**IDIOTIC** idiom", ""), bits=16)
    assert first.tolist() == [0, 2, 4, 4]
    assert (rows[0] == rows[1]).all() and rows[2, 1] == rows[0, 1] and rows[2, 0] != rows[0, 0]
    assert rows[3, 1] == rows[0, 1] and rows[3, 2] != rows[2, 2]


def test_pooling_against_plain_version():
    net = random_net()
    texts = ["", "one", "two words", "a few more words in here", " ".join(f"w{k * k % 37}" for k in range(200))]
    rows, first = T.buckets(*raw_of(*texts), bits=8)
    got = net.pool(rows, first)
    assert np.isneginf(got[0]).all()
    for k in range(1, len(texts)):
        assert np.allclose(got[k], plain_pool(net, rows[first[k]:first[k + 1]]), atol=1e-4)


@pytest.mark.parametrize("most", [10, 17, 64, 1000])
def test_pieces_change_nothing(most):
    net = random_net()
    rnd = np.random.default_rng(most)
    for _ in range(20):
        text = " ".join("x" * rnd.integers(1, 5) + str(rnd.integers(50)) for _ in range(rnd.integers(1, 120)))
        raw, off = raw_of(text)
        parts = T.cuts(raw, most)
        if any(last for *_, last in parts[:-1]):
            continue  # cut without a repeat: fewer words than that in a piece
        whole = net.pool(*T.buckets(raw, off, 8))[0]
        best = np.full((1, len(net.bias)), -np.inf, np.float32)
        T._pool_into(net, raw, [(0, a, b, last) for a, b, last in parts], best, 8)
        assert np.allclose(best[0], whole, atol=1e-5)


def test_piece_borders():
    assert T.cuts(raw_of("abc")[0], 10) == [(0, 3, True)]
    assert T.cuts(raw_of("x" * 25)[0], 10) == [(0, 10, True), (10, 20, True), (20, 25, True)]
    text = "aa bb cc dd ee ff gg"
    parts = T.cuts(raw_of(text)[0], 10)
    words = [text[a:b].split() for a, b, _ in parts]
    assert all(w[-2:] == v[:2] for w, v in zip(words, words[1:], strict=False)) and words[-1][-1] == "gg"


def test_gradients_by_differences():
    """One batch, one step: every parameter moves against its numeric gradient."""
    rnd = np.random.default_rng(0)
    docs = [rnd.integers(0, 16, (rnd.integers(3, 9), 3)).astype(np.int32) for _ in range(8)]
    labels = np.array([0, 1] * 4, float)
    start, done = T.new_net(4), T.fit_net(docs, labels, bits=4, epochs=1, decay=0.0)

    def loss(net):
        pooled = np.array([plain_pool(net, d) for d in docs])
        p = T._sigmoid(net.logit(pooled))
        return -float(np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)))

    eps = 1e-3
    for name, at in [("out", k) for k in range(0, 24, 5)] + [("bias", k) for k in range(0, 24, 5)]:
        up, down = T.new_net(4), T.new_net(4)
        getattr(up, name)[at] += eps
        getattr(down, name)[at] -= eps
        g = (loss(up) - loss(down)) / (2 * eps)
        moved = getattr(done, name)[at] - getattr(start, name)[at]
        assert abs(moved + 0.1 * g / math.sqrt(1e-4 + g * g)) < 5e-3, (name, at, g, moved)
    for j, w in enumerate(start.filters):
        for k in range(len(w)):
            up, down = T.new_net(4), T.new_net(4)
            up.filters[j][k][2, 1] += eps
            down.filters[j][k][2, 1] -= eps
            g = (loss(up) - loss(down)) / (2 * eps)
            moved = done.filters[j][k][2, 1] - w[k][2, 1]
            assert abs(moved + 0.1 * g / math.sqrt(1e-4 + g * g)) < 1e-2, (j, k, g, moved)


def test_platt_and_threshold():
    rnd = np.random.default_rng(2)
    z = rnd.normal(0, 2, 20_000)
    y = (rnd.random(20_000) < T._sigmoid(1.7 * z - 0.6)).astype(float)
    a, b = T.platt(z, y, np.ones(20_000))
    assert abs(a - 1.7) < 0.1 and abs(b + 0.6) < 0.1
    s, y = np.array([0.9, 0.8, 0.7, 0.7, 0.2, 0.1]), np.array([1, 1, 0, 1, 0, 0])
    best = max((2 * ((s >= t) & (y > 0)).sum() / ((s >= t).sum() + 3), -t) for t in (0.95, 0.85, 0.75, 0.5, 0.15, 0.0))
    got = T.best_threshold(s, y, np.ones(6))
    assert 2 * ((s >= got) & (y > 0)).sum() / ((s >= got).sum() + 3) == best[0]


def test_model_round_trip():
    net = random_net()
    net.thresholds, net.common, net.scale = {"en": 0.25, "fr": 0.5}, 0.4, 1.5
    back = T.Net.load(net.dump())
    rows, first = T.buckets(*raw_of("some words to score"), bits=8)
    assert back.score(back.pool(rows, first)) == net.score(net.pool(rows, first))
    assert (back.thresholds, back.common) == (net.thresholds, net.common)


def test_held_out_labels(spark):
    got = {r["doc_id"]: r for r in QUERIES["op12_toxicity_cnn"](spark, "/root/testdata/sf0.1").collect()}
    assert len(got) == 10_000
    held = [r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(got[r["doc_id"]]["held_out"] for r in held) and sum(r["held_out"] for r in got.values()) < 3000
    toxic = [got[r["doc_id"]] for r in held if r["toxic"] == 1]
    clean = [got[r["doc_id"]] for r in held if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in toxic]) > 0.8 and np.mean([r["predicted"] for r in clean]) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \n ", "xx"), (4, "you idiot", "en"), (4, "you idiot", "en"), (None, "you idiot " * 300_000, "en"), (5, "x" * 3_000_000, "de")]
    docs = spark.createDataFrame([(*r, 0.5, 0.1, 7) for r in rows], "doc_id long, text string, lang string, score double, threshold double, id int")
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 0), (None, 1), (5, 0), (9, None), (2, 0)], "doc_id long, toxic int")
    net = T.fit(docs, labels, bits=12)
    got = T.score(docs, net, keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    none = {r["score"] for r in got if r["text"] is not None and not r["text"].strip() or r["text"] is None}
    assert len(none) == 1
    assert len({round(r["score"], 6) for r in got if r["doc_id"] == 4}) == 1
    for label in (labels.limit(0), labels.where("toxic = 1")):
        net = T.fit(docs, label, bits=12)
        share = 1.0 if label.count() else 0.0
        assert all(abs(r["score"] - share) < 1e-6 for r in T.score(docs, net, keep=["doc_id"]).collect())
    net = T.fit(docs.limit(0), labels, bits=12)
    assert T.score(docs.limit(0), net, keep=["doc_id"]).count() == 0


def test_every_label_trains(spark, monkeypatch):
    """All labelled texts lie in the blocks or on the side, the long one too; several blocks learn what one does."""
    rnd = np.random.default_rng(4)
    plain = ["red", "blue", "tree", "house", "water", "stone", "cloud", "river"]
    rows = [(k, " ".join([*rnd.choice(plain, 6), "idiot" if k % 4 == 0 else "friend"]), "en") for k in range(600)]
    rows.append((600, "idiot " + "water " * 60_000, "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(601)], "doc_id long, toxic int")
    seen, plain_blocks, plain_logits = [], T._blocks, T._logits
    monkeypatch.setattr(T, "_blocks", lambda learn, n: seen.append((n, learn.count())) or plain_blocks(learn, n))
    monkeypatch.setattr(T, "_logits", lambda hold, net: seen.append(hold.count()) or plain_logits(hold, net))
    net = T.fit(docs, labels, bits=12, block_rows=100)
    assert seen[0][0] > 3 and seen[0][1] + seen[1] == 601
    got = {r["doc_id"]: r["score"] for r in T.score(docs, net, keep=["doc_id"]).collect()}
    assert min(v for k, v in got.items() if k % 4 == 0) > max(v for k, v in got.items() if k % 4)


def test_calibration_by_aggregates(spark):
    rnd = np.random.default_rng(9)
    z = np.round(rnd.normal(0, 2, 500), 1)
    y = (rnd.random(500) < T._sigmoid(1.5 * z - 1)).astype(int)
    lang = rnd.choice(["en", "fr"], 500)
    told = spark.createDataFrame([(str(a), int(b), float(c)) for a, b, c in zip(lang, y, z, strict=True)], "lang string, toxic int, z double")
    w = np.where(y > 0, 0.7, 1.2)
    assert np.allclose(T.platt_of(told, 1.2, 0.7), T.platt(z, y, w))
    s = T._sigmoid(z)
    got = T.thresholds_of(told.select("lang", "toxic", T._sure(F.col("z")).alias("score")), 1.2, 0.7)
    want = {None: T.best_threshold(s, y, w)} | {v: T.best_threshold(s[lang == v], y[lang == v], w[lang == v]) for v in ("en", "fr")}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
