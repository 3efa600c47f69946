"""Request and click streams.

Requests arrive as text lines ``"user item"``; clicks from the web page as
CSV payloads ``"user,item,test,88888,1"``.  Sources are file folders here
(the Kafka connector is not on this classpath); any ``readStream`` source
with a ``value`` string column plugs in unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUEST_PATTERN = r"^[0-9]+ [0-9]+$"
BAD_LINE = "bad_request_line"  # reason code of a rejected line
CLICK_SCHEMA = "user_id BIGINT, sku_id BIGINT, source STRING, code INT, type INT"


def request_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def parse_requests(lines: DataFrame) -> DataFrame:
    """(value, valid, user_id, sku_id, error): the line is trimmed first; a
    valid line is exactly two digit tokens separated by one space."""
    v = F.trim(F.col("value"))
    ok = v.rlike(REQUEST_PATTERN)
    parts = F.split(v, " ")
    return lines.select(
        "*",
        ok.alias("valid"),
        F.when(ok, F.element_at(parts, 1).cast("bigint")).alias("user_id"),
        F.when(ok, F.element_at(parts, 2).cast("bigint")).alias("sku_id"),
        F.when(~ok, F.lit(BAD_LINE)).alias("error"))


def valid_requests(lines: DataFrame) -> DataFrame:
    p = parse_requests(lines)
    return p.where(F.col("valid")).drop("valid", "error")


def rejected_requests(lines: DataFrame) -> DataFrame:
    """Side output: malformed lines with their reason code; the stream goes on."""
    p = parse_requests(lines)
    return p.where(~F.col("valid")).drop("user_id", "sku_id", "valid")


def click_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.format("text").load(path)


def parse_clicks(lines: DataFrame) -> DataFrame:
    """CSV click payload -> typed columns (malformed fields become NULL)."""
    c = F.from_csv(F.col("value"), CLICK_SCHEMA, {"mode": "PERMISSIVE"}).alias("c")
    return lines.select(c).select("c.*")


def click_lines(action: DataFrame) -> DataFrame:
    """Batch twin: the web page's click payload for every action."""
    return action.select(F.concat_ws(",", F.col("user_id").cast("string"), F.col("sku_id").cast("string"),
                                     F.lit("test"), F.lit("88888"), F.lit("1")).alias("value"))


def kafka_lines(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Request / click lines from a Kafka topic as a ``value`` string column.

    Needs the Kafka connector on the classpath (not part of this image); the
    rest of the job is unchanged whichever source feeds it.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).load()
            .select(F.col("value").cast("string").alias("value")))


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str, key_col: str = "user_id"):
    """Publish one message per row (e.g. the candidate payload) to a topic."""
    out = messages.select(F.col(key_col).cast("string").alias("key"), F.col("payload").alias("value"))
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
