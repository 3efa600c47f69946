"""Keyed snapshot tables: lookups by key read only the buckets that hold a wanted key.

A table is stored in ``buckets`` folders by hash of its key columns, sorted by key inside.  A lookup first finds the
buckets of the wanted keys (at most ``buckets`` numbers reach the driver), reads those folders, and keeps the rows of
the wanted keys with a semi join.  A micro-batch of a few users so reads a few files, however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "kb"
MOST_BUCKETS = 4096


def buckets_for(rows: int, rows_per_bucket: int = 100_000) -> int:
    """How many buckets a table of ``rows`` keys gets: 16 to 4,096."""
    return max(16, min(MOST_BUCKETS, -(-rows // rows_per_bucket)))


def bucket_of(keys: Sequence[str | Column], buckets: int) -> Column:
    """Bucket of a key; the types of the columns do not matter, their text does."""
    return F.pmod(F.xxhash64(*[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, rows_per_file: int = 5_000_000) -> None:
    """Write ``df`` by bucket; a key with very many rows gets several files."""
    (df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET).sortWithinPartitions(BUCKET, *keys)
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(BUCKET).parquet(path))


def pruned(table: DataFrame, keys: Sequence[str], wanted: DataFrame, buckets: int) -> DataFrame:
    """Rows of the buckets that hold a key of ``wanted``, other keys of those buckets included."""
    rows = wanted.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()  # at most ``buckets`` numbers
    return table.where(F.col(BUCKET).isin([r[0] for r in rows])).drop(BUCKET)


def lookup(table: DataFrame, keys: Sequence[str], wanted: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``table`` (read from a folder of ``write_keyed``) whose key is in ``wanted``; a NULL key matches nothing."""
    asked = wanted.select(*keys).dropna().distinct()
    return pruned(table, keys, asked, buckets).join(asked, list(keys), "left_semi")
