"""Suffix dedup, n-gram join, language model, decontamination and language ID against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import components, contaminated, language_labels, language_model, repeats

from cartwheel.llm import bitmap, decontam, langid, ngram_join, ngram_lm, suffix_dedup
from cartwheel.llm.blocks import Words, flat, pack, shingles, unpack

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i * i % 977}x{i}" for i in range(20_000))


def texts(spark, sf=SF):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, multi-byte text."""
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdeé ü".replace(" ", "")) for _ in range(rnd.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))

    base, passage = prose(120), prose(30)
    rows = [(10, None), (11, ""), (12, " \n\t "), (13, "one two"), (14, "One  TWO"), (15, LONG), (16, LONG + " tail"), (17, base), (18, base), (19, base + " more words"),
            (20, "x " + base), (21, prose(50) + " " + passage + " " + prose(50)), (22, passage + " " + prose(20)), (23, prose(20) + " " + passage),
            (24, "ab" * 400), (25, "cab" * 200), (26, "é" * 300), (27, "a" + "é" * 150), (28, "a b c")]
    for k in range(60):  # near copies with one or two edits each
        w = base.split()
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = f"edit{k}"
        rows.append((100 + k, " ".join(w)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1.5, "k") for d, t in rows], "doc_id long, text string, score double, kept string").repartition(3)


# ---------------------------------------------------------------- helpers

def test_words_and_pack():
    import pyarrow as pa

    raw, off = flat(pa.array(["Ab  c", None, "", "\x0bd e\n", "x"]))
    w = Words(raw, off)
    assert w.count.tolist() == [2, 0, 0, 1, 1] and w.doc.tolist() == [0, 0, 3, 4]
    sets, edge = shingles(w)
    assert np.diff(edge).tolist() == [1, 0, 0, 1, 1] and len(set(sets.tolist())) == 3
    a = [np.arange(5, dtype=np.uint16), np.zeros(0), np.array([1.5])]
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(a, unpack(pack(a)), strict=True))


def test_bitmap(spark):
    ids = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    rows = spark.createDataFrame([(ids[k::7].tobytes(),) for k in range(7)], "payload binary").repartition(4)
    got = bitmap.union(rows, 20, salt=3)
    assert bitmap.has(got, ids, 20).all()
    assert bitmap.has(got, np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64), 20).mean() < 0.02


# ---------------------------------------------------------------- suffix dedup

def cut_rows(spark, rows, **more):
    got = suffix_dedup.cut(frame(spark, rows), keep=["doc_id", "score"], **more).collect()
    assert {r["score"] for r in got} <= {1.5}
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got}


@pytest.mark.parametrize("more", [{}, {"cap": 2}, {"hot": 2}, {"cap": 2, "hot": 2, "length": 40}])
def test_suffix_dedup(spark, more):
    rows = odd_rows() + texts(spark)[:60]
    rows = list({d: (d, t) for d, t in rows}.values())
    assert cut_rows(spark, rows, **more) == repeats(rows, more.get("length", 100))


def test_suffix_sort_is_lexicographic():
    rnd = np.random.default_rng(5)
    data = rnd.integers(97, 99, 400).astype(np.uint8)
    s = suffix_dedup.Suffixes(data, 20)
    start, group = np.arange(380), np.zeros(380, np.int64)
    order = s.sort(start, group)
    assert order.tolist() == sorted(range(380), key=lambda i: (data[i:i + 20].tobytes(), i))
    x, y = rnd.integers(0, 380, 200), rnd.integers(0, 380, 200)
    want = [next((k for k in range(20) if data[a + k] != data[b + k]), 20) for a, b in zip(x, y, strict=True)]
    assert s.extension(x, y).tolist() == want


def test_suffix_dedup_repeated_rows_and_empty(spark):
    t = "z" * 10 + " ".join(str(i) for i in range(80))
    got = suffix_dedup.cut(spark.createDataFrame([(1, t), (1, t), (2, t), (None, "q"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, len(t))]
    assert suffix_dedup.cut(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_characters(spark):
    rows = [(1, "é" * 120), (2, "x" + "é" * 120)]
    for r in suffix_dedup.cut(frame(spark, rows), whole_chars=True).collect():
        bytes(r["kept"]).decode()


# ---------------------------------------------------------------- n-gram join

@pytest.mark.parametrize("cap", [2, 256])
def test_ngram_join(spark, cap):
    rows = list({d: (d, t) for d, t in odd_rows() + texts(spark)}.values())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(frame(spark, rows), cap=cap).collect()}
    assert got == components(rows)


def test_ngram_join_null_ids_repeated_rows_empty(spark):
    t = " ".join(f"word{i}" for i in range(30))
    rows = [(None, t), (5, t), (5, t), (None, "alone here"), (7, None)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got if r["component_id"]) == [(0, 26, 5), (5, 26, 5), (5, 26, 5), (7, 0, 7)]
    assert len(got) == 5
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ngram_join_copy_of_a_marker(spark):
    """A passage common in one task only, whose first class has a copy in another task."""
    def run(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    passage, rarer = run("s", 60), run("t", 26)
    first = [(1, run("f", 90) + " " + passage), (2, rarer + " " + run("x", 4) + " " + passage), (7, rarer + " " + run("k", 90))]
    first += [(3 + k, run(f"g{k}q", 90) + " " + passage) for k in range(3)]
    second = [(11, first[0][1]), (12, rarer + " " + run("y", 4) + " " + passage), (17, rarer + " " + run("l", 90))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize([first, second], 2).flatMap(lambda rows: rows), "doc_id long, text string")  # two tasks
    copied = ngram_join.copied_sets(ngram_join.document_sets(docs))
    sent = [ngram_join._decode(bytes(r["payload"])) for r in ngram_join.shared_shingles(docs, 2000, copied, cap=5).where("kind <> 2").collect()]
    found = {}
    for shingle, _, _, df in sent:
        for x, d in zip(shingle.tolist(), df.tolist(), strict=True):
            found.setdefault(x, set()).add(d)
    assert found and all(len(d) == 1 for d in found.values())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs, cap=5).collect()}
    assert got == components(first + second) and got[12][1] == 2


def test_ngram_join_many_flushes(spark, monkeypatch):
    """Many small flushes and many buckets: copies and single sets travel by different names and meet all the same."""
    monkeypatch.setattr(ngram_join, "FLUSH", 300)
    monkeypatch.setattr(ngram_join, "BUCKET", 40)
    rows = [(d, t) for d, t in texts(spark)][:120]
    rows += [(9000 + k, rows[k][1]) for k in range(0, 40, 3)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(frame(spark, rows)).collect()}
    assert got == components(rows)


def test_references_find_their_names():
    rnd = np.random.default_rng(9)
    fp = rnd.integers(1 << 62, 1 << 63, 30, dtype=np.uint64) | ngram_join._PRINT
    size, several = rnd.integers(1, 99, 30), rnd.random(30) < 0.4
    number = ngram_join.flush_number(12, 3)
    shingle, who = np.sort(rnd.integers(0, 1 << 56, 500, dtype=np.uint64)), rnd.integers(0, 30, 500)
    got_shingle, ref, sizes, df = ngram_join._decode_sent(ngram_join._encode_sent(shingle, who, number, several, fp, size, np.ones(500, np.uint16)))
    assert (got_shingle == shingle).all() and (df == 1).all() and ((ref >= ngram_join._PRINT) == several[who]).all()
    rows = list(ngram_join._to_classes(got_shingle, ref, sizes, df, 4))
    other = pack([np.array([number + 1]), fp[:5], size[:5].astype(np.uint32)])
    own = pack([np.array([number]), np.where(several, np.uint64(0), fp), size.astype(np.uint32)])
    seen = []
    for _, blob in rows:
        s, r, n, _ = ngram_join._decode(blob)
        f, n = ngram_join.named(r, n, [other, own])
        seen += zip(s.tolist(), f.tolist(), n.tolist(), strict=True)
    assert sorted(seen) == sorted(zip(shingle.tolist(), fp[who].tolist(), size[who].tolist(), strict=True))


def test_filters_are_bounds():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        x = np.unique(rnd.integers(0, 400, rnd.integers(1, 200)).astype(np.uint64))
        y = np.unique(rnd.integers(0, 400, rnd.integers(1, 200)).astype(np.uint64))
        shared = len(np.intersect1d(x, y))
        assert ngram_join.parity_difference(ngram_join.parity_bits(x), ngram_join.parity_bits(y)) <= len(x) + len(y) - 2 * shared
        assert ngram_join.suffix_bound(x, y) >= shared


# ---------------------------------------------------------------- language model

def test_elias_fano():
    rnd = np.random.default_rng(4)
    for n, top in ((1, 5), (10, 3), (1000, 10**9), (5000, 2**50), (300, 40)):
        v = np.sort(rnd.integers(0, top, n)).astype(np.uint64)
        ef = ngram_lm.EliasFano.encode(v)
        assert (ef.get(np.arange(n)) == v).all()
        assert ef.low.nbytes + ef.high.nbytes <= n * (np.log2(max(2, top / n)) + 3) / 8 + 32


def test_trie_lookup(tmp_path):
    rnd = np.random.default_rng(6)
    pairs = np.unique(rnd.integers(0, 50 * 70, 900))
    w, u = pairs // 70, pairs % 70
    trie = ngram_lm.Trie(str(tmp_path), np.linspace(-5, -1, 50), np.searchsorted(w, np.arange(51)), u, pairs * 0.001, 70)
    ask = np.arange(50 * 70)
    found, value = trie.lookup(ask // 70, ask % 70)
    assert (np.flatnonzero(found) == pairs).all() and np.allclose(value[found], pairs * 0.001)


@pytest.mark.parametrize("hot", [200_000, 30])
def test_language_model(spark, hot):
    from pyspark.sql import functions as F

    rows = list({d: (d, t) for d, t in odd_rows() + texts(spark)}.values()) + [(None, "one two three")]
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    got = {r["doc_id"]: r for r in ngram_lm.score(frame(spark, rows), held, hot_least=hot).collect()}
    want = language_model(rows, ngram_lm.MU)
    assert set(got) == set(want)
    for d, (h, n, known, total, base, score) in want.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total), d
        assert abs(r["base_score"] - base) < 1e-6 * n and abs(r["score"] - score) < 0.01 * n


def test_language_model_repeated_rows_empty_split(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ngram_lm, "BUCKET", 500)  # many buckets: split words and pairs meet in several
    rows = [(k, "the cat sat on the mat the cat " * 5) for k in range(1, 200)]
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    got = {r["doc_id"]: r for r in ngram_lm.score(frame(spark, rows), held, hot_least=200).collect()}
    for d, (*_, base, score) in language_model(rows, ngram_lm.MU).items():
        assert abs(got[d]["base_score"] - base) < 1e-6 and abs(got[d]["score"] - score) < 0.05
    twice = ngram_lm.score(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string"), F.lit(False)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["train_tokens"]) for r in twice) == [(1, 3, 7), (1, 3, 7), (2, 1, 7)]
    assert ngram_lm.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(False)).count() == 0


def test_language_model_null_ids_keep_their_rows(spark):
    from pyspark.sql import functions as F

    rows = [(None, " ".join(f"n{i}x{j}" for j in range(i % 13))  + f" own{i}") for i in range(1500)] + [(7, f"text {i} " * (i % 5 + 1)) for i in range(1500)]
    got = ngram_lm.score(frame(spark, rows), F.lit(False)).collect()
    for d in (None, 7):
        want = sorted(len(t.split()) + 1 for i, t in rows if i == d)
        assert sorted(r["n_tokens"] for r in got if r["doc_id"] == d) == want


def test_sums_meet_by_flush_and_place():
    """Three flushes over two parts, their sums spread over several tasks' rows."""
    import pandas as pd

    rnd, sizes = np.random.default_rng(5), {ngram_lm.flush_number(t, k): n for t, k, n in ((0, 0, 40), (0, 1, 3), (7, 0, 500))}
    want = {(f, i): np.zeros(4, np.int64) for f, n in sizes.items() for i in range(n)}
    frames = [pd.DataFrame({"part": [int(ngram_lm.part_of(np.array([f]), 2)[0])], "kind": [ngram_lm.DIRECTORY],
                            "payload": [pack([np.array([f]), np.arange(n) + f % 1000 * 1000, np.arange(n) % 2 == 0])]}) for f, n in sizes.items()]
    for _ in range(6):
        docs = sorted(k for k in want if rnd.random() < 0.5)
        numbers = rnd.integers(-10**9, 10**9, (4, len(docs)))
        for j, d in enumerate(docs):
            want[d] += numbers[:, j]
        frames.append(ngram_lm.pack_sums(np.array([d[0] for d in docs]), np.array([d[1] for d in docs]), list(numbers), 2))
    rows = pd.concat(frames)
    got = pd.concat([ngram_lm.add_sums((k,), part) for k, part in rows.groupby("part")])
    assert len(got) == len(want)
    told = {(r.doc_id, r.held): (r.n, r.known, round(r.base * ngram_lm.FIXED), round(r.score * ngram_lm.FIXED)) for r in got.itertuples()}
    assert told == {(i + f % 1000 * 1000, i % 2 == 0): tuple(v) for (f, i), v in want.items()}


# ---------------------------------------------------------------- decontamination

def test_decontamination(spark):
    rnd = random.Random(8)
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, "three short words"), (901, None), (902, ""), (903, items[0][1])]
    rows = texts(spark)
    for k, (_, t) in enumerate(items[:30]):
        w = t.split() if t else []
        if len(w) > 12:
            near = list(w)
            near[len(w) // 2 if k % 2 else 0] = "changed"
            rows += [(5000 + k, " ".join(rnd.choice(w) for _ in range(40)) + " " + " ".join(near) + " end of it"), (6000 + k, t.upper().replace(" ", "  "))]
    rows += [(7000, None), (7001, ""), (7002, "here three short words stand"), (7003, "a b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.find(frame(spark, rows), bench).collect()}
    want = contaminated(rows, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    sliced = {(r["doc_id"], r["item_id"]) for r in decontam.find(frame(spark, rows), bench, slice_items=7).collect()}
    assert sliced == set(want)
    left = {r["doc_id"] for r in decontam.clean(frame(spark, rows), bench, slice_items=11).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in want}
    assert decontam.find(frame(spark, rows), bench.limit(0)).count() == 0


def test_multi_index_is_complete():
    import pyarrow as pa

    texts_ = [" ".join(f"w{(i * 7 + j * j) % 91}" for j in range(20)) for i in range(40)]
    index = decontam.Index(list(range(40)), texts_, 11)
    items, own, _ = index.groups[5][20]
    rnd = np.random.default_rng(1)
    fp = own[rnd.integers(0, len(own), 500)] ^ np.bitwise_or.reduce(np.uint64(1) << rnd.integers(0, 64, (8, 500)).astype(np.uint64), axis=0)
    w, i, d = index.near(5, 20, fp)
    distance = np.bitwise_count(fp[:, None] ^ own[None, :])
    assert {(int(a), int(b)) for a, b in zip(w, i, strict=True)} == {(int(a), int(items[b])) for a, b in zip(*np.nonzero(distance <= 11), strict=True)}
    assert pa is not None and (d <= 11).all()


# ---------------------------------------------------------------- language ID

def test_viterbi_is_optimal():
    rnd = np.random.default_rng(9)
    counts = np.array([3, 0, 7, 1, 5])
    scores = rnd.normal(size=(counts.sum(), 3)).astype(np.float32)
    path = langid.viterbi(scores, counts, 1.0)
    at = 0
    for n in counts:
        own, got = scores[at:at + n].astype(float), path[at:at + n]
        at += n

        def value(p, own=own):
            return sum(own[i, x] for i, x in enumerate(p)) - sum(a != b for a, b in zip(p, p[1:], strict=False))

        if n:
            from itertools import product
            assert value(list(got)) >= max(value(p) for p in product(range(3), repeat=int(n))) - 1e-5


def test_viterbi_many_languages():
    scores = np.full((6, 300), -5.0, np.float32)
    want = [130, 130, 299, 299, 5, 200]
    scores[np.arange(6), want] = 0.0
    assert langid.viterbi(scores, np.array([4, 2]), 1.0).tolist() == want


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from cartwheel.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()}
    truth = {r[0]: r[1] for r in docs.select("doc_id", "lang").collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[d]["lang_pred"] == truth[d] for d in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_id_against_brute_force(spark):
    """The whole query, and odd texts, against a version that goes byte by byte."""
    from cartwheel.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = language_labels([(t, lang) for d, t, lang in rows if zlib.crc32(str(d).encode()) % 5], [(d, t) for d, t, _ in rows], langid._SCRIPT_BIT)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op10_language_id"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == want.keys()
    assert all(got[d][0] == want[d][0] and abs(got[d][1] - want[d][1]) < 1e-6 for d in want)
    train = [("the house and the garden are here " * 5, "en"), ("это дом и сад для людей " * 5, "ru"), ("der hund und das haus " * 5, "de"), (None, "de"), ("x", None)]
    odd = [(1, None), (2, ""), (3, "12 !"), (4, "the дом the сад das haus"), (5, "日本"), (6, "a"), (7, "the house der hund " * 50)]
    model = langid.train(spark.createDataFrame(train, "text string, lang string"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    want = language_labels(train, odd, langid._SCRIPT_BIT)
    assert all(got[d][0] == want[d][0] and abs(got[d][1] - want[d][1]) < 1e-6 for d in want) and len(got) == 7


def test_language_id_clashing_names(spark):
    model = langid.train(spark.createDataFrame([("the house", "en"), ("das haus", "de")], "text string, lang string"))
    docs = spark.createDataFrame([(1, "the house", "x", 2.0, "y")], "doc_id long, body string, _letter string, _text double, _text_ string")
    r = langid.identify(docs, model, text_col="body", keep=["doc_id", "_letter", "_text", "_text_"]).first()
    assert (r["lang_pred"], r["_letter"], r["_text"], r["_text_"]) == ("en", "x", 2.0, "y")


def test_language_id_spans_scripts_and_odd_rows(spark):
    train = spark.createDataFrame([("the house and the garden are with the people " * 20, "en"), ("der hund und das haus sind nicht die katze " * 20, "de"),
                                   ("это дом и сад для людей и собаки " * 20, "ru"), ("abc", None), (None, "en")], "text string, lang string")
    model = langid.train(train)
    assert model.langs == ["de", "en", "ru"]
    mixed = "the people and the house are with the garden " * 3 + "der hund und die katze sind nicht das haus " * 3
    rows = [(1, mixed), (2, "дом для собаки"), (3, None), (4, ""), (5, "123 $$ !"), (6, "العربية"), (7, "the house " * 30_000), (None, "und der hund nicht")]
    docs = spark.createDataFrame([(d, t, "old", 7.0) for d, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = {r["doc_id"]: r for r in langid.identify(docs, model, spans=True).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "de"] and got[1]["n_spans"] == 2
    assert got[1]["spans"][0]["n_words"] == 27
    assert got[2]["lang_pred"] == "ru" and got[7]["lang_pred"] == "en" and got[None]["lang_pred"] == "de"
    assert all(got[d]["lang_pred"] == "und" and got[d]["score"] == 0 for d in (3, 4, 5))
    assert got[6]["lang_pred"] in model.langs and 0 <= got[6]["score"] <= 1
    none = langid.train(train.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
