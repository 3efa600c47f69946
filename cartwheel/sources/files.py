"""File sources and sinks.

All paths are caller-supplied; jobs write below the cluster's shared
checkpoint folder (see ``cartwheel.session.shared_path``), never to a
machine-local temp folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CORRUPT_COL = "_corrupt_record"


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Delimited text with a header line and no index column."""
    (df.write.mode("overwrite").option("header", header)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             keep_corrupt: bool = True, sep: str = ",") -> DataFrame:
    """Scan CSV with a declared schema; malformed lines go to ``_corrupt_record``."""
    s = schema
    if keep_corrupt and CORRUPT_COL not in schema.fieldNames():
        s = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    r = (spark.read.schema(s).option("header", header).option("sep", sep)
         .option("mode", "PERMISSIVE")
         .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return r.csv(path)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a columnar (Parquet) snapshot, optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_date_partition(df: DataFrame, time_col: str = "action_time", name: str = "dt") -> DataFrame:
    return df.withColumn(name, F.to_date(time_col))


def ffm_path(path: str) -> str:
    """libffm files end in .txt (the suffix is added when missing)."""
    return path if path.endswith(".txt") else path + ".txt"


def write_lines(df: DataFrame, path: str, line_col: str = "line") -> str:
    """Write one text line per row (no header); returns the final path."""
    p = ffm_path(path)
    df.select(F.col(line_col).alias("value")).write.mode("overwrite").text(p)
    return p


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    """Sparse ML vectors as libsvm text (1-based indices), for external trainers."""
    (df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
     .write.mode("overwrite").format("libsvm").save(path))


# ---------------------------------------------------------------- KV log range scan
def write_kv_log(kv: DataFrame, path: str, date_col: str = "dt") -> None:
    """Store the row-key log partitioned by the date prefix of its key."""
    (kv.withColumn(date_col, F.to_date(F.substring("rowkey", 1, 10)))
     .write.mode("overwrite").partitionBy(date_col).parquet(path))


def log_range_scan(kv: DataFrame, start_row: str | None = None, stop_row: str | None = None,
                   reverse: bool = True, limit: int | None = None, with_time: bool = False,
                   date_col: str | None = None) -> DataFrame:
    """Scan ``(rowkey, it, ty)`` over ``[start_row, stop_row)`` and parse it.

    Output (user_id int, item_id int, type tinyint[, ts]) ordered by row key,
    newest first when ``reverse``; ``limit`` caps the scan as the KV scan does.
    On a store partitioned by date the key bounds prune files.
    """
    cond = F.lit(True)
    if start_row is not None:
        cond = cond & (F.col("rowkey") >= F.lit(start_row))
    if stop_row is not None:
        cond = cond & (F.col("rowkey") < F.lit(stop_row))
    if date_col is not None:
        # keys start with "yyyy-MM-dd": the key range implies a date range (partition pruning)
        if start_row is not None and len(start_row) >= 10:
            cond = cond & (F.col(date_col) >= F.lit(start_row[:10]).cast("date"))
        if stop_row is not None and len(stop_row) >= 10:
            cond = cond & (F.col(date_col) <= F.lit(stop_row[:10]).cast("date"))
    rows = kv.where(cond)
    rows = rows.orderBy(F.col("rowkey").desc() if reverse else F.col("rowkey").asc(),
                        F.col("it").asc(), F.col("ty").asc())
    if limit is not None:
        rows = rows.limit(int(limit))
    parts = F.split(F.col("rowkey"), ",")
    cols = []
    if with_time:
        cols.append(F.element_at(parts, 1).alias("ts"))
    cols += [F.element_at(parts, 2).cast("int").alias("user_id"),
             F.col("it").cast("int").alias("item_id"),
             F.col("ty").cast("tinyint").alias("type")]
    return rows.select(*cols)


def file_positions(df: DataFrame) -> DataFrame:
    """``position``: 0-based place of every row in the order of the files it was read from.

    Files are numbered by name, rows by their index in the file; only the counts per file (one row each)
    are broadcast.
    """
    rows = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn("position", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")
