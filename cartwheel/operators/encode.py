"""Global categorical dictionary and field-aware (libffm) feature lines.

* Every categorical column is a *field*; its sorted distinct values get codes
  0..n-1 and the field a ``base`` = running sum of the sizes of the fields
  before it (in column order), so ``feature_id = base + code`` is globally
  unique.  A numeric field takes exactly one feature id and keeps its value.
* Codes come from an exact distributed ranking (``functions.ranking``), never
  from a window over a whole field in one task.
* Encoding joins each field with its slice of the dictionary; the planner
  picks the join from the slice's size in bytes.
* Integral columns sort by number, text columns by code point.  A missing
  (NULL) feature has no token in a line and a NULL id in a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.ranking import sorted_index
from cartwheel.session import shared_path

UNSEEN_POLICIES = ("error", "skip", "keep")


@dataclass
class FeatureDictionary:
    """``fields``: (field_id, column, kind, size, base); ``values``: (field_id,
    column, value, text_value, code, feature_id); an integral column's values
    stand in ``value``, a text column's in ``text_value``.  ``total`` = number of feature ids."""
    fields: DataFrame
    values: DataFrame
    columns: list[str]
    numeric: list[str]
    field_rows: list[dict]

    @property
    def total(self) -> int:
        return int(sum(r["size"] for r in self.field_rows))

    def field(self, column: str) -> dict:
        for r in self.field_rows:
            if r["column"] == column:
                return r
        raise KeyError(column)


def _is_integral(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long", "boolean")


def _value_of(df: DataFrame, column: str) -> list[Column]:
    """(value, text_value) of a categorical column, one of them NULL."""
    if _is_integral(df, column):
        return [F.col(column).cast("bigint").alias("value"), F.lit(None).cast("string").alias("text_value")]
    return [F.lit(None).cast("bigint").alias("value"), F.col(column).cast("string").alias("text_value")]


def build_dictionary(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = (),
                     num_partitions: int | None = None, path: str | None = None) -> FeatureDictionary:
    """Dictionary of ``columns`` (field id = position in ``columns``).

    Integral columns keep numeric order, any other categorical column is
    taken as text in code point order.
    """
    columns, numeric = list(columns), [c for c in numeric if c in columns]
    cat = [c for c in columns if c not in numeric]
    spark = df.sparkSession
    fid = {c: i for i, c in enumerate(columns)}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(fid[c]).alias("field_id"), F.lit(c).alias("column"), *_value_of(df, c))
        for c in cat])).alias("kv")).select("kv.*")
    distinct = long.where("value is not null or text_value is not null").distinct()
    coded, counts = sorted_index(distinct, ["value", "text_value"], within=["field_id"], index_col="code",
                                 num_partitions=num_partitions, with_counts=True, settle=True)
    rows = {r["field_id"]: r["n"] for r in counts.collect()}  # one row per field
    field_rows, base = [], 0
    for c in columns:
        size = 1 if c in numeric else int(rows.get(fid[c], 0))
        field_rows.append({"field_id": fid[c], "column": c, "kind": "numeric" if c in numeric else "categorical",
                           "size": size, "base": base})
        base += size
    fields = spark.createDataFrame(field_rows, "field_id int, column string, kind string, size bigint, base bigint")
    values = (coded.join(F.broadcast(fields.select("field_id", "base")), "field_id")  # F rows
              .select("field_id", "column", "value", "text_value", "code", (F.col("base") + F.col("code")).alias("feature_id")))
    # persist once, partitioned by field: every per-field lookup then reads
    # only its own partition instead of recomputing the ranking
    path = path or shared_path(spark, "dictionary")
    values.write.mode("overwrite").partitionBy("field_id").parquet(path)
    values = spark.read.parquet(path).select("field_id", "column", "value", "text_value", "code", "feature_id")
    return FeatureDictionary(fields, values, columns, numeric, field_rows)


def extend_dictionary(d: FeatureDictionary, df: DataFrame, version: int, path: str | None = None, num_partitions: int | None = None) -> FeatureDictionary:
    """``d`` with ids for the values of ``df`` it lacks; ids given before stay as they are.

    New values are coded per field in order, and a field's new ids follow those of the fields before it, from the old
    total on: ``base`` and ``size`` of its new ids are a row of ``fields`` with the ``version``.  The memo grows by a folder
    of new values; nothing is recoded.
    """
    spark = df.sparkSession
    fid = {r["column"]: r["field_id"] for r in d.field_rows}
    cat = [c for c in d.columns if c not in d.numeric]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(fid[c]).alias("field_id"), F.lit(c).alias("column"), *_value_of(df, c)) for c in cat])).alias("kv")).select("kv.*")
    distinct = long.where("value is not null or text_value is not null").distinct()
    old = d.values.select("field_id", F.col("value").alias("_v"), F.col("text_value").alias("_t"))
    same = (distinct["field_id"] == old["field_id"]) & distinct["value"].eqNullSafe(old["_v"]) & distinct["text_value"].eqNullSafe(old["_t"])
    coded, counts = sorted_index(distinct.join(old, same, "left_anti"), ["value", "text_value"], within=["field_id"], index_col="code",
                                 num_partitions=num_partitions, with_counts=True, settle=True)
    sizes = {r["field_id"]: int(r["n"]) for r in counts.collect()}  # one row per field
    base, rows = d.total, []
    for r in d.field_rows:
        if r["field_id"] in fid.values() and r["kind"] == "categorical" and r.get("version", 0) == 0:
            rows.append({"field_id": r["field_id"], "column": r["column"], "kind": "categorical", "size": sizes.get(r["field_id"], 0), "base": base, "version": version})
            base += rows[-1]["size"]
    shape = "field_id int, column string, kind string, size bigint, base bigint, version int"
    field_rows = [{"version": 0, **r} for r in d.field_rows] + rows
    new_bases = spark.createDataFrame(rows, shape).select("field_id", "base")
    values = (coded.join(F.broadcast(new_bases), "field_id")  # F rows
              .select("field_id", "column", "value", "text_value", "code", (F.col("base") + F.col("code")).alias("feature_id")))
    path = path or shared_path(spark, "dictionary", f"version_{version}")
    values.write.mode("overwrite").partitionBy("field_id").parquet(path)
    added = spark.read.schema(d.values.schema).parquet(path).select(*d.values.columns)
    return FeatureDictionary(spark.createDataFrame(field_rows, shape), d.values.unionByName(added), d.columns, d.numeric, field_rows)


def one_hot(encoded: DataFrame, d: FeatureDictionary, label: str = "label", prefix: str = "f_") -> DataFrame:
    """(label, features): rows as sparse ML vectors over all feature ids; a numeric field keeps its value.

    Codes become one-hot blocks that the assembler puts one after the other, in field order; unseen values have no entry."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    out, blocks = encoded, []
    for r in d.field_rows:
        c, size = r["column"], int(r["size"])
        if r["kind"] == "numeric":
            out = out.withColumn(f"_x_{c}", F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
        else:
            code = F.col(f"{prefix}{c}") - F.lit(r["base"])
            inside = (code >= 0) & (code < size)
            # one code more, which the encoder drops, stands for unseen
            out = out.withColumn(f"_c_{c}", F.when(inside, code).otherwise(size).cast("double"))
        blocks.append(f"_x_{c}")
    sizes = {f"_c_{r['column']}": float(r["size"]) for r in d.field_rows if r["kind"] != "numeric"}
    largest = encoded.sparkSession.createDataFrame([tuple(sizes.values())], ", ".join(f"{c} double" for c in sizes))  # its codes tell the sizes
    encoder = OneHotEncoder(inputCols=list(sizes), outputCols=[c.replace("_c_", "_x_", 1) for c in sizes], dropLast=True).fit(largest)
    out = VectorAssembler(inputCols=blocks, outputCol="features").transform(encoder.transform(out))
    return out.select(F.col(label).cast("double").alias("label"), "features")


def _slice(d: FeatureDictionary, column: str, out: str, integral: bool) -> DataFrame:
    return d.values.where(F.col("field_id") == d.field(column)["field_id"]).select(
        F.col("value" if integral else "text_value").alias(f"_v_{out}"), F.col("feature_id").alias(out))


def encode_columns(df: DataFrame, d: FeatureDictionary, unseen: str = "keep", prefix: str = "f_",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``f_<col>`` = global feature id for every categorical dictionary column (or those in ``columns``).

    Unseen values: ``keep`` maps to a reserved id per field (total + field_id),
    ``skip`` drops the row, ``error`` fails the job.  NULL stays NULL.
    """
    if unseen not in UNSEEN_POLICIES:
        raise ValueError(f"unseen must be one of {UNSEEN_POLICIES}")
    out = df
    missing = []
    for c in d.columns:
        if c in d.numeric or (columns is not None and c not in columns):
            continue
        name = f"{prefix}{c}"
        integral = _is_integral(df, c)
        out = (out.join(_slice(d, c, name, integral), F.col(c).cast("bigint" if integral else "string") == F.col(f"_v_{name}"),
                        "left").drop(f"_v_{name}"))
        m = F.col(name).isNull() & F.col(c).isNotNull()
        missing.append((c, m))
        if unseen == "keep":
            reserved = F.lit(d.total + d.field(c)["field_id"]).cast("bigint")
            out = out.withColumn(name, F.when(m, reserved).otherwise(F.col(name)))
    if unseen == "skip" and missing:
        out = out.where(~F.greatest(*[m.cast("int") for _, m in missing] + [F.lit(0)]).cast("boolean"))
    elif unseen == "error" and missing:
        # a filter (not a dropped column) so the optimizer cannot prune the check
        checks = [F.when(m, F.raise_error(F.lit(f"unseen value in column {c}"))) for c, m in missing]
        out = out.where(F.coalesce(*checks, F.lit(True)))
    return out


def numeric_text(c) -> Column:
    """A numeric feature value as the shortest text that reads back as the same double."""
    return F.col(c).cast("double").cast("string")


def ffm_line(d: FeatureDictionary, label: str = "label", prefix: str = "f_") -> Column:
    """``label field:index:value ...`` in column order (value 1 if categorical); a NULL feature has no token."""
    terms = [F.col(label).cast("string")]
    for r in d.field_rows:
        c, f = r["column"], str(r["field_id"])
        if r["kind"] == "numeric":  # concat is NULL if a part is, and concat_ws leaves NULL out
            terms.append(F.concat(F.lit(f"{f}:{r['base']}:"), numeric_text(c)))
        else:
            terms.append(F.concat(F.lit(f"{f}:"), F.col(f"{prefix}{c}").cast("string"), F.lit(":1")))
    return F.concat_ws(" ", *terms)


def ffm_lines(df: DataFrame, d: FeatureDictionary, label: str = "label", unseen: str = "keep",
              keep: Sequence[str] = ()) -> DataFrame:
    enc = encode_columns(df, d, unseen)
    return enc.select(*keep, F.col(label).alias("label"), ffm_line(d, label).alias("line"))


def encode_candidates(candidates: DataFrame, product: DataFrame, user: DataFrame, d: FeatureDictionary,
                      unseen: str = "keep") -> DataFrame:
    """Candidates (user_id, sku_id) -> product/user features, 0-filled, encoded.

    Output: user_id, item_id (raw ids) and ``f_<col>`` = global id of every
    feature column, in the dictionary's column order; set-based over all users.
    """
    from cartwheel.operators.transform import fill_zero
    cols = [c for c in d.columns if c not in d.numeric]
    pairs = candidates.select("user_id", "sku_id").distinct()
    out = pairs
    # every dimension row is encoded once, then joined: two joins on the candidates
    for key, dimension, own in (("sku_id", product, ("brand", "shop_id", "cate", "sku_id")),
                                ("user_id", user, ("age", "sex", "city", "county", "user_id"))):
        own = [c for c in own if c in cols]
        attrs = [c for c in own if c != key]
        rows = fill_zero(pairs.select(key).distinct().join(dimension.select(key, *attrs), key, "left"))
        out = out.join(encode_columns(rows, d, unseen, columns=own).select(key, *[f"f_{c}" for c in own]), key)
    return out.select("user_id", F.col("sku_id").alias("item_id"), *[f"f_{c}" for c in cols])
