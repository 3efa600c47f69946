"""Mixture, nearest neighbours, tool calls, archives and the classifier; SQL oracles."""

import json
import math

import duckdb
import numpy as np
import pytest
from brute import label_posteriors, quality_votes, words

from cartwheel.llm import ann, mixing, quality, tool_calls, warc
from cartwheel.llm.queries import MIX_POWERS, ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "embeddings", "labels"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.execute(ORACLE[name])
    cols = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(repr, want.fetchall()))


# ---------------------------------------------------------------- mixture

def test_mixture_meets_margins(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs, {"source": 0.3, "lang": 0.5, "topic": 1.0}, iterations=30).collect()
    tokens = sum(r["mix_tokens"] for r in rows)
    for d, power in (("source", 0.3), ("lang", 0.5), ("mix_topic", 1.0)):
        have, got = {}, {}
        for r in rows:
            have[r[d]] = have.get(r[d], 0) + r["mix_tokens"]
            got[r[d]] = got.get(r[d], 0) + r["mix_tokens"] * r["mix_weight"]
        goal = {k: v ** power for k, v in have.items() if v}
        total = sum(goal.values())
        assert all(abs(got[k] / tokens - v / total) < 2e-3 for k, v in goal.items())
    drawn = sum(r["mix_tokens"] * r["mix_copies"] for r in rows)
    assert abs(drawn / tokens - 1) < 0.1


def test_mixture_odd_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "word " * 50_000, "en", "a"), (3, "word " * 50_000, "en", "a"), (None, "x y", None, "b"), (4, "HELLO THERE", "de", "b")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, weight string")
    got = mixing.mix(docs, MIX_POWERS).collect()
    assert len(got) == 6 and {r["weight"] for r in got} == {"x"}
    assert all(r["mix_copies"] == 1 for r in got if r["mix_tokens"] == 0)
    assert len({r["mix_copies"] for r in got if r["doc_id"] == 3}) == 1
    assert mixing.mix(docs.limit(0), MIX_POWERS).count() == 0
    assert mixing.mix(docs.where("text is null"), MIX_POWERS).count() == 1


# ---------------------------------------------------------------- neighbours

def nearest(ids, x, q, k):
    score = x @ x[q]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_neighbours_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = QUERIES["op4_permutation_index"](spark, sf).toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want = nearest(ids, x, q, 20)
        own = got[got["query_id"] == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and own["score"].is_monotonic_decreasing
        hits += len({i for i, _ in want} & set(own["vec_id"]))
        total += 20
    assert hits / total >= 0.9


def test_neighbours_recall_with_cut(spark, monkeypatch):
    """Lists of several chunks, each cut to ``KEEP_SHARE`` by footrule."""
    monkeypatch.setattr(ann, "CHUNK_ROWS", 128)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = ann.search(df, df.where("vec_id % 20 = 0"), k=20, keep_least=20).toPandas()
    asked = np.flatnonzero(ids % 20 == 0)
    hits = sum(len({i for i, _ in nearest(ids, x, q, 20)} & set(got[got["query_id"] == ids[q]]["vec_id"])) for q in asked)
    assert hits / (20 * len(asked)) >= 0.9


def test_neighbours_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK_ROWS", 64)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 4)
    rnd = np.random.default_rng(0)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(300)] + [(i, [3.0] * 8) for i in range(300, 500)]
    bad = [(600, None), (620, [0.0] * 8), (640, [1.0, None] + [0.0] * 6), (660, [float("nan")] * 8), (680, [float("inf")] * 8), (700, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(*r, "z") for r in rows + bad], "vec_id long, embedding array<double>, rank string")
    got = ann.search(df, df.where("vec_id % 20 = 0"), keep_share=1.0, probed=1000, posted=1000, pivots=16).toPandas()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert set(got["query_id"]) == set(range(0, 500, 20))
    for q in range(0, 500, 20):
        own = got[got["query_id"] == q].sort_values("rank")
        want = nearest(ids, x, q, 20)
        assert np.allclose(own["score"], [s for _, s in want])
        if q >= 300:
            assert own["vec_id"].tolist() == [i for i, _ in want]
    few = df.where("vec_id < 3")
    assert ann.search(few, few, k=20).count() == 6
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


# ---------------------------------------------------------------- tool calls

SCHEMAS = "('get', 'id', 'integer', true, 1D, 9D), ('get', 'tags', 'array', false, cast(null as double), 2D), ('get', 'name', 'string', false, cast(null as double), cast(null as double))"


def test_tool_calls(spark):
    calls = [("a", "get", '{"tags":["x"], "id": 3}', None), ("b", "get", '{"id": "3"}', "a"), ("c", "get", '{"id": 10, "zz": null}', "b"), ("d", "put", "{}", "gone"),
             ("e", "get", "not json", "c"), ("x", "get", '{"id":1}', "y"), ("y", "get", '{"id":1}', "x"), ("z", "get", '{"id":1}', "y"),
             (None, "get", '{"id":2}', None), (None, "get", '{"id":2}', None), ("a", "get", '{"tags":["x"], "id": 3}', None), ("f", "get", "[1]", None), ("g", None, None, None)]
    results = [("a", "r2"), ("a", "r1"), ("b", None), ("nobody", "r"), (None, "r")]
    schemas = spark.sql(f"SELECT * FROM VALUES {SCHEMAS} AS t(name, arg, type, required, least, most)")
    got = tool_calls.link(spark.createDataFrame(calls, "call_id string, name string, arguments string, parent_id string"),
                          spark.createDataFrame(results, "call_id string, content string"), schemas).collect()
    by = {r["call_id"]: r for r in got if r["call_id"]}
    assert len(got) == len(by) + 2
    assert [by[k]["depth"] for k in "abcdefxyz"] == [0, 1, 2, 0, 3, 0, None, None, None]
    assert by["a"]["valid"] and by["a"]["n_results"] == 2
    assert by["a"]["json"] == '{"arguments":{"id":3,"tags":["x"]},"depth":0,"errors":[],"id":"a","name":"get","parent":null,"result":"r1","valid":true}'
    assert [by[k]["errors"] for k in "bcdefgz"] == ["id: type", "id: range,zz: unexpected", "unknown tool", "arguments", "arguments", "arguments", "cycle"]
    assert all(json.loads(r["json"])["id"] == r["call_id"] for r in got)
    empty = spark.createDataFrame([], "call_id string, name string, arguments string, parent_id string")
    assert tool_calls.link(empty, spark.createDataFrame([], "call_id string, content string"), schemas).count() == 0


def test_long_chain_is_ordered(spark):
    calls = spark.range(300).selectExpr("cast(id as string) call_id", "cast(null as string) name", "cast(null as string) arguments", "cast(id - 1 as string) parent_id")
    assert {r["call_id"]: r["depth"] for r in tool_calls.depths(calls).collect()} == {str(i): i for i in range(300)}


# ---------------------------------------------------------------- archives

def test_archives(spark, tmp_path):
    rows = [(1, "http://a/ü b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>x</p>"), (5, "u", "y" * 300_000), (5, "u", "y" * 300_000), (6, "u", "y" * 300_000),
            (None, "u", "only null"), (7, "é\r\nX: y", "é")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")
    warc.write_archives(warc.mark_revisits(pages), str(tmp_path / "w"))
    got = [r.asDict() for r in warc.read_archives(spark, str(tmp_path / "w"), with_payload=True).collect()]
    assert len(got) == len(rows) and all(r["error"] is None for r in got)
    key = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
    assert key == sorted([(1, "response", None, 8), (2, "revisit", 1, 8), (3, "response", None, 0), (4, "revisit", 3, 0), (0, "revisit", 1, 8), (5, "response", None, 300_000),
                          (5, "response", None, 300_000), (6, "revisit", 5, 300_000), (0, "response", None, 9), (7, "response", None, 2)])
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == {b"<p>x</p>", b"", b"y" * 300_000, b"only null", "é".encode()}
    large = warc.mark_revisits(pages, min_bytes=9)
    assert {r["page_id"] for r in large.where("refers_to is not null").collect()} == {6}
    assert warc.mark_revisits(pages.limit(0)).count() == 0
    warc.write_archives(warc.mark_revisits(pages.limit(0)), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_dictionary_frame_leads(spark, tmp_path):
    warc.write_archives(warc.mark_revisits(spark.read.parquet(f"{SF}/pages.parquet").coalesce(1)), str(tmp_path / "w"))
    files = [p for p in (tmp_path / "w").iterdir() if p.name.startswith("part-")]
    assert files
    for p in files:
        data = memoryview(p.read_bytes())
        kinds = [m for m, _, _ in warc.frames(data)]
        assert kinds[0] == warc.DICT_MAGIC and kinds.count(warc.DICT_MAGIC) == 1 and kinds.count(warc.FRAME_MAGIC) == 250


def test_faulty_records():
    good = warc.build_record(1, "u", b"body", None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(good)["error"] is None
    assert warc.parse_record(good.replace(b"WARC/1.1", b"WORC/1.1"))["error"] == "version line"
    assert warc.parse_record(good[:-1])["error"] == "block length"
    assert warc.parse_record(good.replace(b"body", b"bodY"))["error"] == "block digest"
    assert warc.parse_record(good.replace(b"WARC-Date", b"WARC-Data"))["error"] == "no WARC-Date"
    import zstandard
    frame = zstandard.ZstdCompressor().compress(good)
    assert [r["error"] for r in warc.read_archive(memoryview(frame + frame[:-3]))][-1].startswith("archive")
    assert [r["page_id"] for r in warc.read_archive(memoryview(frame + b"P*M\x18\x03\0\0\0abc" + frame))] == [1, 1]


# ---------------------------------------------------------------- classifier

def test_label_model_finds_accuracies():
    rnd = np.random.default_rng(3)
    truth = rnd.random(40_000) < 0.3
    right = np.array([0.9, 0.8, 0.7, 0.95])
    votes = np.where(rnd.random((40_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int) + 1
    votes[rnd.random(votes.shape) < 0.3] = quality.ABSTAIN
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float), np.zeros((len(patterns), 2)))
    assert abs(model.prior - 0.3) < 0.03
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9
    told = model.rates[:, 1, quality.POSITIVE] / (1 - model.rates[:, 1, quality.ABSTAIN])
    assert np.abs(told - right).max() < 0.05


def test_classifier(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_quality_classifier"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == 1000
    good = [r for r in labels if r["quality"] == 1 and r["toxic"] == 0]
    assert np.mean([(got[r["doc_id"]]["quality_score"] >= 0.5) == (r["quality"] == 1) for r in labels]) > 0.97
    assert np.mean([got[r["doc_id"]]["keep"] for r in good]) > 0.95
    assert np.mean([got[r["doc_id"]]["toxic"] for r in labels if r["toxic"] == 1]) > 0.6


def test_classifier_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.2), (3, " \n ", 0.3), (4, "fine words here and there", 0.4), (4, "fine words here and there", 0.4), (None, "x" * 100_000, 0.5)],
                                 "doc_id long, text string, toxic_score double")
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 6 and all(r["quality_score"] == 0 and r["toxic_score"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert quality.classify(docs, labels.limit(0)).count() == 6
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_classifier_labels_against_brute_force(spark):
    """Posterior quality of every document of the whole query against labellers and EM in plain Python."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    told = [(d, quality_votes(t)) for d, t in docs if words(t)]
    want = dict(zip([d for d, _ in told], label_posteriors([v for _, v in told], [(v, labels[d]) for d, v in told if labels.get(d) is not None]), strict=True))
    got = {r["doc_id"]: r["quality_label"] for r in QUERIES["op8_quality_classifier"](spark, SF).collect()}
    assert len(got) == len(docs) and all(got[d] == 0 for d, _ in docs if d not in want)
    assert max(abs(got[d] - p) for d, p in want.items()) < 1e-6


def test_scorer_against_plain_steps():
    """The hashed linear scorer against dictionaries and loops, one mini-batch after the other."""
    rnd = np.random.default_rng(4)
    samples = []
    for _ in range(90):
        bucket = np.unique(rnd.integers(0, 16, 5))
        samples.append((bucket.astype(np.int32), rnd.random(len(bucket)).astype(np.float32), rnd.random(8).astype(np.float32), float(rnd.random())))
    got = quality.fit_scorer(samples, 4, epochs=3)
    stats = np.array([s[2] for s in samples], float)
    centre, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    dense = [[*((s[2] - centre) / scale), 1.0] for s in samples]
    high = sum(s[3] > 0.5 for s in samples) / len(samples)
    weight = [0.5 / (high if s[3] > 0.5 else 1 - high) for s in samples]
    w, gw, d, gd = [0.0] * 16, [1e-8] * 16, [0.0] * 9, [1e-8] * 9
    order_of = np.random.default_rng(7)
    for _ in range(3):
        order = order_of.permutation(len(samples))
        for lo in range(0, len(order), 64):
            batch, g, gg = order[lo:lo + 64], {}, [0.0] * 9
            for i in batch:
                z = sum(w[b] * float(v) for b, v in zip(samples[i][0], samples[i][1], strict=True)) + sum(x * y for x, y in zip(dense[i], d, strict=True))
                err = (1 / (1 + math.exp(-z)) - samples[i][3]) * weight[i] / len(batch)
                for b, v in zip(samples[i][0].tolist(), samples[i][1], strict=True):
                    g[b] = g.get(b, 0.0) + err * float(v)
                gg = [x + err * y for x, y in zip(gg, dense[i], strict=True)]
            for b, x in g.items():
                x += 1e-6 * w[b]
                gw[b] += x * x
                w[b] -= 0.3 * x / math.sqrt(gw[b])
            for k, x in enumerate(gg):
                gd[k] += x * x
                d[k] -= 0.3 * x / math.sqrt(gd[k])
    assert np.allclose(got.weights, w, atol=1e-6) and np.allclose(got.dense, d[:-1], atol=1e-6) and abs(got.bias - d[-1]) < 1e-6


def test_mixture_keeps_columns_of_any_name(spark):
    rows = [(k, "some plain words here", "en", f"s{k % 3}", 0.5, "a", "b", 7) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _w double, _source string, _topic string, mix_own int")
    got = mixing.mix(docs, {"source": 0.7, "lang": 0.8, "topic": 0.9}).collect()
    assert len(got) == 30 and all((r["_w"], r["_source"], r["_topic"], r["mix_own"]) == (0.5, "a", "b", 7) and r["mix_weight"] > 0 for r in got)
