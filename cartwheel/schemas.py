"""Declared schemas of the logical tables (no schema inference anywhere)."""

from pyspark.sql import types as T

ACTION = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("type", T.ByteType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()),
])

USER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.ByteType()),
    T.StructField("sex", T.ByteType()),
    T.StructField("city", T.ShortType()),
    T.StructField("county", T.IntegerType()),
])

PRODUCT = T.StructType([
    T.StructField("sku_id", T.LongType()),
    T.StructField("brand", T.IntegerType()),
    T.StructField("shop_id", T.LongType()),
    T.StructField("cate", T.ShortType()),
])

SHOP = T.StructType([
    T.StructField("shop_id", T.LongType()),
    T.StructField("fans_num", T.IntegerType()),
    T.StructField("shop_score", T.DoubleType()),
])

KV_LOG = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("it", T.StringType()),
    T.StructField("ty", T.StringType()),
])

# Column names and order of the reference's ranking input.
# The nine ranking features, in the model's column order (label excluded).
FEATURE_COLUMNS = ["age", "sex", "city", "county", "brand", "shop_id", "cate", "user_id", "sku_id"]

# Enriched variant: shop features are numeric (one feature id each, value kept).
ENRICHED_COLUMNS = ["age", "city", "brand", "shop_id", "cate", "fans_num", "shop_score", "user_id", "sku_id"]
ENRICHED_NUMERIC = ["fans_num", "shop_score"]
