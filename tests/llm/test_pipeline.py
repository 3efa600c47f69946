"""Every stage of the corpus pipeline against brute force on its own input."""

import corpus_pipeline as P
import pytest
from brute import components, contaminated, repeats

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, f in P.STAGES:
        f(spark, docs, SF).write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return out


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_language_keeps_clean_documents(inputs):
    before, after = inputs["language_id"]
    kept = {r["doc_id"]: r for r in after}
    assert all(kept[r["doc_id"]] == r for r in before if r["doc_id"] in kept)
    assert len(after) > 0.97 * len(before)


def test_one_of_each_group(inputs):
    before, after = inputs["ngram_jaccard"]
    want = {d for d, (_, c) in components(pairs(before)).items() if c == d}
    assert {r["doc_id"] for r in after} == want and len(after) == len(want)


def test_group_of_an_id_with_two_texts(spark):
    def run(tag, n=40):
        return " ".join(f"{tag}{i}" for i in range(n))

    rows = [(2, run("a")), (5, run("a")), (5, run("b")), (3, run("c")), (6, run("c") + " more"), (6, run("d")), (6, run("d")), (None, run("a")), (8, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], KINDS)
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in P.near_duplicates(spark, docs, SF).collect())
    assert got == [(0, run("a")), (2, run("a")), (3, run("c")), (5, run("b")), (6, run("d")), (8, "")]


def test_repeated_passages(inputs):
    before, after = inputs["suffix_dedup"]
    want, got = repeats(pairs(before)), {r["doc_id"]: r for r in after}
    for r in before:
        size, removed, _, _ = want[r["doc_id"]]
        if removed == 0:
            assert got[r["doc_id"]] == r
        elif removed < size:
            left = got[r["doc_id"]]
            assert size - removed <= len(left["text"].encode()) <= size - removed + 6 * want[r["doc_id"]][2]
            assert left["n_chars"] == len(left["text"])
        else:
            assert r["doc_id"] not in got


def test_leaks_go(spark, inputs):
    before, after = inputs["decontaminate"]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _ in contaminated(pairs(before), items)}
    assert hit and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - hit


def test_mixture_draws(inputs):
    before, after = inputs["mix_weights"]
    ids = {r["doc_id"]: r for r in before}
    assert all({k: v for k, v in r.items() if k != "copies"} == ids[r["doc_id"]] and r["copies"] >= 1 for r in after)
    assert len(after) > 0.8 * len(before)


def test_run_is_the_stages(spark, inputs):
    got = sorted((r["doc_id"], r["copies"]) for r in P.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["copies"]) for r in inputs["mix_weights"][1])


def test_odd_rows_and_columns(spark):
    t = "the people of this place and the house with a garden " * 4
    rows = [(1, t, "en", "s"), (1, t, "en", "s"), (2, t + "more", "en", "s"), (None, "another text entirely of other words", None, None), (3, None, "en", "s"), (4, "", None, "s"), (5, "12 34", "en", "s")]
    docs = spark.createDataFrame([(*r, 1, 0.5, "x", 7) for r in rows], KINDS + ", score double, lang_pred string, mark long")
    for _, f in P.STAGES:
        docs = f(spark, docs, SF)
        assert docs.columns[:8] == ["doc_id", "text", "lang", "source", "n_chars", "score", "lang_pred", "mark"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = docs.collect()
    assert {r["doc_id"] for r in got} <= {1, None} and all(r["score"] == 0.5 and r["mark"] == 7 for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], KINDS)
    for _, f in P.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
