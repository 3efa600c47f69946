"""The corpus pipeline: language ID, near duplicates, repeated passages, benchmark leaks, mixture.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which
``run`` writes as Parquet below the session's shared folder and reads again as the next one's documents.  All but
the last return the columns of their input.

Defined results for odd rows: a stage keeps columns it does not know, whatever their names; rows without a text or a
letter leave at the first stage; rows that repeat id and text are one document from the second stage on (that whose
other columns are least as JSON text); rows without an id cannot be told apart by the second stage and stay; an empty
table passes through.

No SQL expresses the whole: ORACLE_SQL is None, and tests/llm compares every stage with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm import decontam, langid, mixing, ngram_join, suffix_dedup
from cartwheel.llm.queries import MIX_POWERS, fold, table
from cartwheel.session import ensure_checkpoint_dir, shared_path, ship_package, small_batches

LEAST_SHARE = 0.5  # of a document's letters in its language
ORACLE_SQL = None

KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    small_batches(spark)


def _hide(docs: DataFrame) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with unknown columns renamed out of the way, and the function that gives their names back."""
    names = {c: c if c in KNOWN else f"extra_{k}" for k, c in enumerate(docs.columns)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])

    def back(df: DataFrame, *more) -> DataFrame:
        return df.select(*[F.col(n).alias(c) for c, n in names.items()], *more)

    return hidden, back


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language that covers at least half of its letters."""
    _ready(spark)
    rows, back = _hide(docs)
    model = langid.train(rows.where(fold("doc_id", 5) != 0))
    return back(langid.identify(rows, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id."""
    _ready(spark)
    rows, back = _hide(docs)
    # an id may have several texts, in different groups: a document is its id and text
    told = rows.withColumn("mark", F.xxhash64("text")).withColumn("node", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "mark")))
    ids = told.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    group = ngram_join.join(told, id_col="node").where("doc_id is not null").groupBy(F.col("doc_id").alias("node")).agg(F.min("component_id").alias("component_id"))
    group = group.join(ids, "node").checkpoint()
    least = group.groupBy("component_id").agg(F.min("doc_id").alias("doc_id"))
    stays = group.join(least, ["component_id", "doc_id"], "left_semi").select("node", F.lit(True).alias("stays"))
    first = Window.partitionBy("doc_id", "mark").orderBy(F.to_json(F.struct(F.lit(0), *[c for c in rows.columns if c != "text"])))  # a defined one of rows that differ elsewhere
    kept = told.join(stays, "node", "left").where("node is null or stays").withColumn("row_no", F.row_number().over(first)).where("row_no = 1")
    return back(kept)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that an earlier place has; documents of which nothing is left go."""
    _ready(spark)
    rows, back = _hide(docs)
    cut = suffix_dedup.cut(rows, length=100, whole_chars=True)
    text = F.when(F.col("n_removed") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    left = cut.where((F.col("n_removed") == 0) | (F.octet_length("kept") > 0)).withColumn("text", text)
    if "n_chars" in rows.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(rows.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(left)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item nor a near copy of one."""
    _ready(spark)
    rows, back = _hide(docs)
    return back(decontam.clean(rows, table(spark, sf_dir, "benchmark")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture draws, with how often (``copies``)."""
    _ready(spark)
    rows, back = _hide(docs)
    copies = "copies" if "copies" not in docs.columns else "mix_copies"
    return back(mixing.mix(rows, MIX_POWERS).where("mix_copies > 0"), F.col("mix_copies").alias(copies))


STAGES = [("language_id", language), ("ngram_jaccard", near_duplicates), ("suffix_dedup", repeated_passages),
          ("decontaminate", decontaminated), ("mix_weights", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's rows are written and read again."""
    _ready(spark)
    base = shared_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
