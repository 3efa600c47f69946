"""Driver tables -> the logical tables of the recommender (FIXTURES.md §2).

Every loader reads only the columns it needs, so Parquet column pruning
reaches the scan; nothing is cached or collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.exprs import (EVENT_TYPE_CODES, MARKET_SEGMENTS, PART_TYPES,
                                       code_lookup, one_based_index)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action log from ``events``: (user_id, sku_id, type, action_time, event_id)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"),
        code_lookup("event_type", EVENT_TYPE_CODES).cast("tinyint").alias("type"),
        F.col("ts").alias("action_time"),
        F.col("event_id").cast("bigint").alias("event_id"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger action log from ``lineitem ⋈ orders``.

    event_id = l_orderkey * 100 + l_linenumber keeps a total order for ties.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("sku_id"),
        (F.pmod(F.col("l_linenumber") - 1, F.lit(5)) + 1).cast("tinyint").alias("type"),
        F.col("o_orderdate").alias("action_time"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("event_id"),
    )


def actions(spark: SparkSession, sf_dir: str, kind: str = "clicks") -> DataFrame:
    if kind == "clicks":
        return clicks(spark, sf_dir)
    if kind == "purchases":
        return purchases(spark, sf_dir)
    raise ValueError(f"unknown action log {kind!r}")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        one_based_index("c_mktsegment", MARKET_SEGMENTS).cast("tinyint").alias("age"),
        F.pmod(F.col("c_custkey"), F.lit(2)).cast("tinyint").alias("sex"),
        F.col("c_nationkey").cast("smallint").alias("city"),
        (F.col("c_nationkey") * 100 + F.pmod(F.col("c_custkey"), F.lit(10))).cast("int").alias("county"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension: every part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("sku_id"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("brand"),
        F.pmod(F.col("p_partkey"), F.lit(10)).cast("bigint").alias("shop_id"),
        one_based_index("p_type", PART_TYPES).cast("smallint").alias("cate"),
    )


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("shop_id"),
        (F.col("s_nationkey") * 1000 + F.col("s_suppkey")).cast("int").alias("fans_num"),
        F.col("s_acctbal").cast("double").alias("shop_score"),
    )


def kv_log(action: DataFrame) -> DataFrame:
    """Wide-column log rows: rowkey "<ts>,<user>", cells it (sku) and ty (type)."""
    return action.select(
        F.concat(F.date_format("action_time", "yyyy-MM-dd HH:mm:ss"), F.lit(","),
                 F.col("user_id").cast("string")).alias("rowkey"),
        F.col("sku_id").cast("string").alias("it"),
        F.col("type").cast("string").alias("ty"),
    )


def requests(action: DataFrame) -> DataFrame:
    """Request lines "user item", plus one malformed line per 50th event."""
    good = action.select("event_id", "action_time",
                         F.concat_ws(" ", F.col("user_id").cast("string"),
                                     F.col("sku_id").cast("string")).alias("value"))
    bad = (action.where(F.pmod(F.col("event_id"), F.lit(50)) == 0)
           .select("event_id", "action_time",
                   F.concat(F.lit("abc "), F.col("sku_id").cast("string")).alias("value")))
    return good.unionByName(bad)
