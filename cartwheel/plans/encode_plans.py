"""Registered encoding queries (phase 3): dictionary, fields, libffm lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import encode as E
from cartwheel.operators import transform as X
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle_ctes import define, with_ctes
from cartwheel.schemas import ENRICHED_COLUMNS, ENRICHED_NUMERIC, FEATURE_COLUMNS
from cartwheel.session import shared_path
from cartwheel.sources import files as io
from cartwheel.sources import fixtures as fx

TRAIN_END = "2024-01-17"
TEST_END = "2024-01-31"


def _split_clicks(spark, sf, part: str):
    c = fx.clicks(spark, sf)
    t = F.col("action_time")
    if part == "train":
        return c.where(t < F.lit(TRAIN_END).cast("timestamp_ntz"))
    return c.where((t >= F.lit(TRAIN_END).cast("timestamp_ntz")) & (t < F.lit(TEST_END).cast("timestamp_ntz")))


def train_table_of(spark, sf, part: str = "train"):
    return X.train_table(_split_clicks(spark, sf, part), fx.products(spark, sf), fx.users(spark, sf))


def enriched_table_of(spark, sf, part: str = "train"):
    pairs = X.pair_labels(_split_clicks(spark, sf, part))
    return X.enriched_actions(pairs, fx.products(spark, sf), fx.users(spark, sf), fx.shops(spark, sf))


def train_dictionary(spark, sf):
    return E.build_dictionary(train_table_of(spark, sf), FEATURE_COLUMNS)


# ---------------------------------------------------------------- oracle CTEs
def _wide_sql(src: str) -> str:
    return f"""
  SELECT CAST(CASE WHEN p.cnt > 1 THEN 1 ELSE 0 END AS TINYINT) AS label,
         coalesce(u.age, 0) AS age, coalesce(u.sex, 0) AS sex, coalesce(u.city, 0) AS city,
         coalesce(u.county, 0) AS county, coalesce(pr.brand, 0) AS brand,
         coalesce(pr.shop_id, 0) AS shop_id, coalesce(pr.cate, 0) AS cate,
         coalesce(s.fans_num, 0) AS fans_num, coalesce(s.shop_score, 0.0) AS shop_score,
         p.user_id, p.sku_id
  FROM (SELECT user_id, sku_id, count(type) AS cnt FROM {src}
        WHERE user_id IS NOT NULL AND sku_id IS NOT NULL GROUP BY user_id, sku_id) p
  LEFT JOIN products pr ON p.sku_id = pr.sku_id
  LEFT JOIN users u ON p.user_id = u.user_id
  LEFT JOIN shops s ON pr.shop_id = s.shop_id"""


define("clicks_train", ["clicks"], f"SELECT * FROM clicks WHERE action_time < TIMESTAMP '{TRAIN_END}'")
define("clicks_test", ["clicks"], f"""SELECT * FROM clicks
  WHERE action_time >= TIMESTAMP '{TRAIN_END}' AND action_time < TIMESTAMP '{TEST_END}'""")
define("wide_train", ["clicks_train", "products", "users", "shops"], _wide_sql("clicks_train"))
define("wide_test", ["clicks_test", "products", "users", "shops"], _wide_sql("clicks_test"))


def _dict_ctes(columns, numeric=()):
    cat = [(i, c) for i, c in enumerate(columns) if c not in numeric]
    long = "\n  UNION ALL ".join(
        f"SELECT {i} AS field_id, '{c}' AS column_name, CAST({c} AS BIGINT) AS value FROM wide_train" for i, c in cat)
    sizes_num = "".join(f"\n  UNION ALL SELECT {i}, '{c}', 'numeric', 1" for i, c in enumerate(columns) if c in numeric)
    return [
        ("dlong", long),
        ("ddistinct", "SELECT DISTINCT field_id, column_name, value FROM dlong WHERE value IS NOT NULL"),
        ("dcoded", """SELECT field_id, column_name, value,
  row_number() OVER (PARTITION BY field_id ORDER BY value) - 1 AS code FROM ddistinct"""),
        ("dsizes", f"""SELECT field_id, column_name, 'categorical' AS kind, count(*) AS size
  FROM ddistinct GROUP BY field_id, column_name{sizes_num}"""),
        ("dfields", """SELECT field_id, column_name, kind, size,
  sum(size) OVER (ORDER BY field_id) - size AS base FROM dsizes"""),
        ("dict", """SELECT c.field_id, c.column_name, c.value, c.code, f.base + c.code AS feature_id
  FROM dcoded c JOIN dfields f ON c.field_id = f.field_id"""),
    ]


def _lines_sql(columns, numeric=(), table="wide_train", extra_cols="w.user_id, w.sku_id, "):
    joins, terms, values = [], ["CAST(w.label AS VARCHAR)"], ""
    for i, c in enumerate(columns):
        if c in numeric:
            # the value's text differs between engines: compared as a number beside the line
            terms.append(f"'{i}:' || CAST((SELECT base FROM dfields WHERE field_id = {i}) AS VARCHAR) || ':'")
            values += f"CAST(w.{c} AS DOUBLE) AS v_{c}, "
        else:
            joins.append(f"LEFT JOIN dict d{i} ON d{i}.field_id = {i} AND d{i}.value = CAST(w.{c} AS BIGINT)")
            terms.append(f"'{i}:' || CAST(coalesce(d{i}.feature_id, (SELECT sum(size) FROM dfields) + {i}) AS VARCHAR)"
                         f" || ':1'")
    line = " || ' ' || ".join(terms)
    return f"SELECT {extra_cols}{values}CAST(w.label AS TINYINT) AS label, {line} AS line\nFROM {table} w\n" + "\n".join(joins)


@register("ffm_dictionary", with_ctes(["wide_train"], """
SELECT CAST(field_id AS BIGINT) AS field_id, column_name, value, CAST(code AS BIGINT) AS code,
       CAST(feature_id AS BIGINT) AS feature_id FROM dict""", local=_dict_ctes(FEATURE_COLUMNS)))
def ffm_dictionary(spark, sf):
    d = train_dictionary(spark, sf)
    return d.values.select(F.col("field_id").cast("bigint").alias("field_id"), F.col("column").alias("column_name"),
                           "value", "code", "feature_id")


FIRST_END = "2024-01-01 06:00:00"  # the first version of the growing dictionary sees the clicks before
define("clicks_first", ["clicks"], f"SELECT * FROM clicks WHERE action_time < TIMESTAMP '{FIRST_END}'")
define("wide_first", ["clicks_first", "products", "users", "shops"], _wide_sql("clicks_first"))


def _first_ctes():
    return [(name, sql.replace("wide_train", "wide_first")) for name, sql in _dict_ctes(FEATURE_COLUMNS)]


def _all_long(columns):
    return "\n  UNION ALL ".join(f"SELECT {i} AS field_id, '{c}' AS column_name, CAST({c} AS BIGINT) AS value FROM wide_train" for i, c in enumerate(columns))


@register("ffm_dictionary_incremental", with_ctes(["wide_train", "wide_first"], """
SELECT CAST(field_id AS BIGINT) AS field_id, column_name, value, CAST(feature_id AS BIGINT) AS feature_id FROM dict
UNION ALL
SELECT n.field_id, n.column_name, n.value, CAST((SELECT sum(size) FROM dfields) + b.base + n.code AS BIGINT)
FROM new_coded n JOIN (SELECT field_id, sum(size) OVER (ORDER BY field_id) - size AS base FROM (
  SELECT field_id, count(*) AS size FROM new_coded GROUP BY field_id) x) b USING (field_id)""", local=_first_ctes() + [
    ("new_coded", f"""SELECT field_id, column_name, value, row_number() OVER (PARTITION BY field_id ORDER BY value) - 1 AS code FROM (
  SELECT DISTINCT field_id, column_name, value FROM ({_all_long(FEATURE_COLUMNS)}) l WHERE value IS NOT NULL) d
  WHERE NOT EXISTS (SELECT 1 FROM dict o WHERE o.field_id = d.field_id AND o.value = d.value)""")]))
def ffm_dictionary_incremental(spark, sf):
    """A dictionary of the first hours' clicks, then the new values of the training slice appended: ids given once never change."""
    clicks = fx.clicks(spark, sf).where(F.col("action_time") < F.lit(FIRST_END).cast("timestamp_ntz"))
    first = E.build_dictionary(X.train_table(clicks, fx.products(spark, sf), fx.users(spark, sf)), FEATURE_COLUMNS)
    d = E.extend_dictionary(first, train_table_of(spark, sf), version=1)
    return d.values.select(F.col("field_id").cast("bigint").alias("field_id"), F.col("column").alias("column_name"), "value", "feature_id")


@register("libsvm_sink", with_ctes(["wide_train"], """
SELECT CAST(w.label AS VARCHAR) || '.0 ' || """ + " || ' ' || ".join(f"CAST(d{i}.feature_id + 1 AS VARCHAR) || ':1.0'" for i in range(len(FEATURE_COLUMNS))) + """ AS line
FROM wide_train w """ + " ".join(f"JOIN dict d{i} ON d{i}.field_id = {i} AND d{i}.value = CAST(w.{c} AS BIGINT)" for i, c in enumerate(FEATURE_COLUMNS)),
                                 local=_dict_ctes(FEATURE_COLUMNS)))
def libsvm_sink(spark, sf):
    """Training rows as sparse ML vectors, written as libsvm text and read back as lines."""
    d = train_dictionary(spark, sf)
    path = shared_path(spark, "train_libsvm")
    io.write_libsvm(E.one_hot(E.encode_columns(train_table_of(spark, sf), d), d), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("ffm_fields", with_ctes(["wide_train"], """
SELECT CAST(field_id AS BIGINT) AS field_id, column_name, kind, CAST(size AS BIGINT) AS size,
       CAST(base AS BIGINT) AS base FROM dfields""", local=_dict_ctes(ENRICHED_COLUMNS, ENRICHED_NUMERIC)))
def ffm_fields(spark, sf):
    d = E.build_dictionary(enriched_table_of(spark, sf), ENRICHED_COLUMNS, ENRICHED_NUMERIC)
    return d.fields.select(F.col("field_id").cast("bigint").alias("field_id"), F.col("column").alias("column_name"),
                           "kind", "size", "base")


@register("ffm_lines", with_ctes(["wide_train"], _lines_sql(FEATURE_COLUMNS), local=_dict_ctes(FEATURE_COLUMNS)))
def ffm_lines(spark, sf):
    d = train_dictionary(spark, sf)
    return E.ffm_lines(train_table_of(spark, sf), d, keep=["user_id", "sku_id"])


@register("ffm_lines_test", with_ctes(["wide_train", "wide_test"], _lines_sql(FEATURE_COLUMNS, table="wide_test"),
                                      local=_dict_ctes(FEATURE_COLUMNS)))
def ffm_lines_test(spark, sf):
    """Test pairs encoded with the *train* dictionary; unseen ids -> reserved id."""
    d = train_dictionary(spark, sf)
    return E.ffm_lines(train_table_of(spark, sf, "test"), d, unseen="keep", keep=["user_id", "sku_id"])


@register("ffm_lines_enriched", with_ctes(["wide_train"], _lines_sql(ENRICHED_COLUMNS, ENRICHED_NUMERIC),
                                          local=_dict_ctes(ENRICHED_COLUMNS, ENRICHED_NUMERIC)))
def ffm_lines_enriched(spark, sf):
    t = enriched_table_of(spark, sf)
    d = E.build_dictionary(t, ENRICHED_COLUMNS, ENRICHED_NUMERIC)
    return parsed_numeric(E.ffm_lines(t, d, keep=["user_id", "sku_id"]), d)


def parsed_numeric(lines, d):
    """Numeric tokens of a line read back as doubles (``v_<column>``), the line without their values."""
    for r in d.field_rows:
        if r["kind"] == "numeric":
            token = f"(?<= ){r['field_id']}:{r['base']}:"
            lines = (lines.withColumn(f"v_{r['column']}", F.nullif(F.regexp_extract("line", token + r"(\S+)", 1), F.lit("")).cast("double"))
                     .withColumn("line", F.regexp_replace("line", f"({token})\\S+", "$1")))
    return lines


TEXT_COLUMNS, TEXT_NUMERIC = ["segment", "nation", "balance"], ["balance"]


def customer_table(spark, sf):
    """Customers with a text feature, an integral one and a numeric one, each NULL for some."""
    c, key = fx.table(spark, sf, "customer"), F.col("c_custkey")
    return c.select(F.col("c_custkey").alias("user_id"), (F.col("c_acctbal") > 0).cast("tinyint").alias("label"),
                    F.when(key % 5 != 0, F.col("c_mktsegment")).alias("segment"), F.when(key % 7 != 0, F.col("c_nationkey").cast("int")).alias("nation"),
                    F.when(key % 11 != 0, F.col("c_acctbal").cast("double") / 3e7).alias("balance"))


@register("ffm_lines_text", """
WITH w AS (SELECT c_custkey AS user_id, CAST(c_acctbal > 0 AS TINYINT) AS label, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment,
  CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS nation, CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_acctbal AS DOUBLE) / 3e7 END AS balance FROM customer),
s AS (SELECT segment, row_number() OVER (ORDER BY segment) - 1 AS id FROM (SELECT DISTINCT segment FROM w WHERE segment IS NOT NULL)),
n AS (SELECT nation, (SELECT count(*) FROM s) + row_number() OVER (ORDER BY nation) - 1 AS id FROM (SELECT DISTINCT nation FROM w WHERE nation IS NOT NULL))
SELECT user_id, label, balance AS v_balance, concat_ws(' ', CAST(label AS VARCHAR), '0:' || CAST(s.id AS VARCHAR) || ':1', '1:' || CAST(n.id AS VARCHAR) || ':1',
  CASE WHEN balance IS NOT NULL THEN '2:' || CAST((SELECT count(*) FROM s) + (SELECT count(*) FROM n) AS VARCHAR) || ':' END) AS line
FROM w LEFT JOIN s USING (segment) LEFT JOIN n USING (nation)""")
def ffm_lines_text(spark, sf):
    """Text categories and missing values: no token for a NULL, numbers read back exactly."""
    t = customer_table(spark, sf)
    d = E.build_dictionary(t, TEXT_COLUMNS, TEXT_NUMERIC)
    return parsed_numeric(E.ffm_lines(t, d, keep=["user_id"]), d)


@register("ffm_text_sink", with_ctes(["wide_train"], "SELECT line FROM (" + _lines_sql(FEATURE_COLUMNS) + ") l",
                                     local=_dict_ctes(FEATURE_COLUMNS)))
def ffm_text_sink(spark, sf):
    """libffm lines written as a text file (".txt" appended) and read back."""
    d = train_dictionary(spark, sf)
    lines = E.ffm_lines(train_table_of(spark, sf), d)
    written = io.write_lines(lines, shared_path(spark, "train_ffm"))
    return spark.read.text(written).select(F.col("value").alias("line"))
