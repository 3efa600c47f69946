"""Registered queries of the corpus operators: thin callers with production parameters, SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import ann, conversation, decontam, langid, mixing, ngram_join, ngram_lm, quality, suffix_dedup, tool_calls, toxicity, warc, whitening
from cartwheel.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int):
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, html, octet_length(payload) AS n, sha1(html) AS hex,
      min(page_id) OVER (PARTITION BY html) AS first_id FROM p),
b AS (SELECT *, list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, 1 + (5 * i // 20) * 5, 5))::BIGINT)
               >> (15 - (5 * i) % 20)) & 31)::BIGINT, 1)) AS letters FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(letters, '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to, NULL::VARCHAR AS error
FROM b
"""


@register("op6_warc_zstd", OP6_SQL)
def op6_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a record of dictionary-compressed archives, read the archives back."""
    path = shared_path(spark, "warc")
    warc.write_archives(warc.mark_revisits(table(spark, sf_dir, "pages"), min_bytes=0), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@register("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 5) == 0
    model = langid.train(docs.where(~held))
    found = langid.identify(docs.withColumn("held_out", held), model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "n_spans")


MIX_POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
OP3_SQL = f"""WITH {mixing.mix_sql(MIX_POWERS)}
SELECT doc_id, source, lang, mix_topic AS topic, mix_tokens AS n_tokens, round(mix_weight, 6) AS weight, mix_copies AS copies FROM mixed"""


@register("op3_mix_weights", OP3_SQL)
def op3_mix_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its raked weight and how often the mixture draws it."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), MIX_POWERS)
    return mixed.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
                        F.round("mix_weight", 6).alias("weight"), F.col("mix_copies").alias("copies"))


@register("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair in which the document holds the item or a near copy of it."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_permutation_index")
def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@register("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document; ``keep`` asks for good quality and no toxicity."""
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    toxic = (F.col("toxic_score") >= 0.5) | (F.col("toxic_label") >= 0.5)
    return scored.select("*", toxic.alias("toxic"), ((F.col("quality_score") >= 0.5) & ~toxic).alias("keep"))


@register("op2_ngram_jaccard")
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 75 % similarity of their 5-word shingle sets."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


@register("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document once all repeated 100-byte strings are cut."""
    kept = suffix_dedup.cut(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100, keep=["doc_id"])
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op7_ngram_lm")
def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a bigram model of nine tenths of them."""
    return ngram_lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


WORD = mixing.WORD
TOOLS = [("ask", "query", "string", True, 1.0, 2000.0), ("ask", "words", "integer", True, 1.0, 60.0),
         ("configure", "query", "string", True, 1.0, 400.0), ("configure", "words", "integer", False, 1.0, 40.0)]
OP5_SQL = rf"""
WITH RECURSIVE turns AS (SELECT *, 'call_' || conv_id || '_' || turn AS call_id, 'call_' || conv_id || '_' || (turn - 1) AS before FROM conversations),
rows AS (SELECT call_id, min(struct_pack(a := CASE role WHEN 'system' THEN 'configure' ELSE 'ask' END, t := text, p := 'call_' || conv_id || '_' || (turn - 2))) AS b
  FROM turns WHERE role IN ('system', 'user') AND call_id IS NOT NULL GROUP BY call_id),
calls AS (SELECT call_id, b.a AS name, b.t AS text, b.p AS parent_id, len(regexp_extract_all(b.t, '{WORD}')) AS words FROM rows),
results AS (SELECT before AS call_id, min(text) AS result, count(*) AS n_results FROM turns WHERE role = 'assistant' AND before IS NOT NULL GROUP BY before),
depth AS (SELECT call_id, 0::BIGINT AS depth FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.call_id = c.parent_id)
  UNION ALL SELECT c.call_id, d.depth + 1 FROM calls c JOIN depth d ON c.parent_id = d.call_id),
told AS (SELECT c.*, d.depth, r.result, coalesce(r.n_results, 0)::BIGINT AS n_results, list_filter([
    CASE WHEN c.text IS NULL THEN 'query: missing' WHEN length(c.text) < 1 OR length(c.text) > (CASE name WHEN 'ask' THEN 2000 ELSE 400 END) THEN 'query: range' END,
    CASE WHEN words < 1 OR words > (CASE name WHEN 'ask' THEN 60 ELSE 40 END) THEN 'words: range' END], lambda e: e IS NOT NULL) AS errors
  FROM calls c JOIN depth d USING (call_id) LEFT JOIN results r USING (call_id))
SELECT call_id, name, parent_id, depth, n_results, len(errors) = 0 AS valid, array_to_string(errors, ',') AS errors,
  '{{"arguments":{{"query":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"words":' || words || '}},"depth":' || depth || ',"errors":' || to_json(errors)::VARCHAR ||
  ',"id":"' || call_id || '","name":"' || name || '","parent":"' || parent_id || '","result":' || coalesce(to_json(result)::VARCHAR, 'null') || ',"valid":' ||
  CASE WHEN len(errors) = 0 THEN 'true' ELSE 'false' END || '}}' AS json
FROM told
"""


@register("op5_tool_calls", OP5_SQL)
def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tool calls: a system or user turn calls, the next turn answers, the turn two before is the parent."""
    turns = table(spark, sf_dir, "conversations")

    def name(shift: int):
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - shift).cast("string"))

    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    calls = turns.where(F.col("role").isin("system", "user")).select(
        name(0).alias("call_id"), F.when(F.col("role") == "system", "configure").otherwise("ask").alias("name"),
        F.to_json(F.struct(words.alias("words"), F.col("text").alias("query")), {"ignoreNullFields": "false"}).alias("arguments"), name(2).alias("parent_id"))
    results = turns.where(F.col("role") == "assistant").select(name(1).alias("call_id"), F.col("text").alias("content"))
    rules = ", ".join(f"('{n}', '{a}', '{t}', {str(r).lower()}, {lo}D, {hi}D)" for n, a, t, r, lo, hi in TOOLS)
    schemas = spark.sql(f"SELECT * FROM VALUES {rules} AS t(name, arg, type, required, least, most)")
    return tool_calls.link(calls, results, schemas)


@register("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 32 principal components, scaled to unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), most=32)


@register("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the cheapest edits that repair it."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation.summarise(conversation.damage(turns), ids=turns)


@register("op12_toxicity_cnn")
def op12_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled ones outside the held-out quarter."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold("doc_id", 4) == 2
    net = toxicity.fit(docs.where(~held), labels.where(~held))
    scored = toxicity.score(docs.withColumn("held_out", held), net, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
