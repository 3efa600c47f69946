"""Training-table construction, casts, type narrowing, splits and windows
over the action log (operators P*, J1-J3, A1, E9, E11, S6, T3).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import ENRICHED_COLUMNS, FEATURE_COLUMNS

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def pair_labels(action: DataFrame) -> DataFrame:
    """Interactions per (user, sku); label 1 when the pair repeats (cnt > 1)."""
    return (action.where(F.col("user_id").isNotNull() & F.col("sku_id").isNotNull())
            .groupBy("user_id", "sku_id")
            .agg(F.count("type").alias("cnt"))
            .withColumn("label", F.when(F.col("cnt") > 1, 1).otherwise(0).cast("tinyint")))


def fill_zero(df: DataFrame) -> DataFrame:
    """pandas ``fillna(0)``: every numeric column, integral and fractional."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    return df.fillna(0, subset=numeric)


def join_dimensions(facts: DataFrame, product: DataFrame, user: DataFrame,
                    shop: DataFrame | None = None,
                    product_cols: Sequence[str] = ("brand", "shop_id", "cate"),
                    user_cols: Sequence[str] = ("age", "sex", "city", "county")) -> DataFrame:
    """facts ⋈ product (sku) ⋈ user (user) [⋈ shop via product.shop_id], all left.

    Join strategy is left to the planner: AQE turns a join into a broadcast
    only when the dimension's materialised size is under the threshold.
    """
    out = facts.join(product.select("sku_id", *product_cols), "sku_id", "left")
    out = out.join(user.select("user_id", *user_cols), "user_id", "left")
    if shop is not None:
        out = out.join(shop.select("shop_id", "fans_num", "shop_score"), "shop_id", "left")
    return out


# Target widths of the ranking input (main training table).
TRAIN_CASTS = {"label": "tinyint", "age": "tinyint", "sex": "tinyint",
               "city": "smallint", "cate": "smallint", "county": "int",
               "shop_id": "bigint", "brand": "bigint", "user_id": "bigint", "sku_id": "bigint"}

ENRICHED_CASTS = {"label": "tinyint", "age": "tinyint", "city": "smallint", "cate": "smallint",
                  "shop_id": "int", "brand": "int", "user_id": "int", "sku_id": "int", "fans_num": "int"}


def cast_failures(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """One aggregate row: per column, how many non-null values fail the cast."""
    aggs = [F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS {t})").isNull()).alias(c)
            for c, t in spec.items()]
    return df.agg(*aggs)


_INT_RANK = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def _always_fits(src: str, dst: str) -> bool:
    """Identity or widening casts cannot fail (no data check needed)."""
    if src == dst:
        return True
    if src in _INT_RANK and dst in _INT_RANK:
        return _INT_RANK[src] <= _INT_RANK[dst]
    return dst == "double" and (src in _INT_RANK or src in ("float", "double"))


def cast_columns(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast columns, leaving a column unchanged if any value would not fit.

    Matches ``astype(t, errors='ignore')``.  Only narrowing casts need a data
    check: one aggregate pass (one row comes back) decides them; identity and
    widening casts are applied without touching the data.
    """
    spec = {c: t for c, t in spec.items() if c in df.columns}
    if not spec:
        return df
    types = dict(df.dtypes)
    ok = {c for c, t in spec.items() if _always_fits(types[c], t)}
    risky = {c: t for c, t in spec.items() if c not in ok}
    if risky:
        fails = cast_failures(df, risky).first().asDict()
        ok |= {c for c, n in fails.items() if n == 0}
    return df.select(*[F.expr(f"try_cast(`{c}` AS {spec[c]})").alias(c) if c in ok else F.col(c)
                       for c in df.columns])


def train_table(action: DataFrame, product: DataFrame, user: DataFrame,
                casts: Mapping[str, str] | None = TRAIN_CASTS) -> DataFrame:
    """Labelled (user, sku) pairs with features, filled and cast, model column order."""
    pairs = pair_labels(action)
    wide = fill_zero(join_dimensions(pairs, product, user))
    wide = wide.select("label", *FEATURE_COLUMNS)
    return cast_columns(wide, casts) if casts else wide


def enriched_actions(labelled: DataFrame, product: DataFrame, user: DataFrame, shop: DataFrame,
                     casts: Mapping[str, str] | None = None) -> DataFrame:
    """Labelled pairs with product, user (age, city) and shop features."""
    wide = join_dimensions(labelled.select("user_id", "sku_id", "label"), product, user, shop,
                           user_cols=("age", "city"))
    wide = fill_zero(wide).select("label", *ENRICHED_COLUMNS)
    return cast_columns(wide, casts) if casts else wide


# ---------------------------------------------------------------- type narrowing
_INT_STEPS = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -9223372036854775808, 9223372036854775807)]
_FLOAT32_MAX = 3.4028234663852886e38
_FLOAT16_MAX = 65504.0
_TYPE_NAMES = {T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "int",
               T.LongType: "bigint", T.FloatType: "float", T.DoubleType: "double"}
_BYTES = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}


def _pick_type(kind: str, lo, hi, is_id: bool) -> str:
    if lo is None or hi is None:
        return kind
    if kind in ("tinyint", "smallint", "int", "bigint"):
        for name, tmin, tmax in _INT_STEPS:
            if lo > tmin and hi < tmax:  # open range, as in the reference
                return name
        return kind
    if is_id:
        return kind
    # float16 has no Spark type: its range maps to float (4 bytes)
    if lo > -_FLOAT16_MAX and hi < _FLOAT16_MAX:
        return "float"
    if lo > -_FLOAT32_MAX and hi < _FLOAT32_MAX:
        return "float"
    return "double"


def narrowing_plan(df: DataFrame, id_columns: Sequence[str] = ()) -> list[tuple[str, str, str, object, object]]:
    """(column, from, to, min, max) for every numeric column, from one aggregate."""
    numeric = [(f.name, _TYPE_NAMES[type(f.dataType)]) for f in df.schema.fields
               if type(f.dataType) in _TYPE_NAMES]
    if not numeric:
        return []
    aggs = []
    for c, _ in numeric:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    stats = df.agg(*aggs).first().asDict()
    out = []
    for c, kind in numeric:
        lo, hi = stats[f"{c}__min"], stats[f"{c}__max"]
        out.append((c, kind, _pick_type(kind, lo, hi, c in id_columns), lo, hi))
    return out


def narrow_types(df: DataFrame, id_columns: Sequence[str] = ("user_id", "sku_id", "shop_id")) -> DataFrame:
    """Cast each numeric column to the smallest type whose open range holds it."""
    plan = {c: to for c, _, to, _, _ in narrowing_plan(df, id_columns)}
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c) for c in df.columns])


def narrowing_report(df: DataFrame, id_columns: Sequence[str] = ("user_id", "sku_id", "shop_id")) -> DataFrame:
    """Report table (column, from_type, to_type, bytes_before, bytes_after) per row."""
    plan = narrowing_plan(df, id_columns)
    spark = df.sparkSession
    rows = [(c, a, b, _BYTES[a], _BYTES[b]) for c, a, b, _, _ in plan]
    schema = "column_name string, from_type string, to_type string, bytes_before bigint, bytes_after bigint"
    return spark.createDataFrame(rows, schema)


def narrowing_summary(df: DataFrame, id_columns: Sequence[str] = ("user_id", "sku_id", "shop_id")) -> DataFrame:
    """One row: rows, columns, bytes before / after narrowing, reduction in %.

    Sizes are the fixed widths of the column types times the row count (the
    columnar analogue of the in-memory usage the reference reports).
    """
    plan = narrowing_plan(df, id_columns)
    before = sum(_BYTES[a] for _, a, _, _, _ in plan)
    after = sum(_BYTES[b] for _, _, b, _, _ in plan)
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"),
        (F.col("rows") * before).alias("bytes_before"), (F.col("rows") * after).alias("bytes_after"),
        F.round(F.lit(100.0 * (before - after) / before if before else 0.0), 6).alias("reduction_pct"))


# ---------------------------------------------------------------- time slicing
def temporal_split(action: DataFrame, boundaries: Sequence[str], names: Sequence[str] | None = None,
                   time_col: str = "action_time") -> DataFrame:
    """Label rows with half-open time slices; rows past the last boundary drop.

    ``boundaries`` b0 < b1 < ... give train = [-inf, b0), test1 = [b0, b1), ...
    """
    names = list(names) if names else ["train"] + [f"test{i}" for i in range(1, len(boundaries))]
    if len(names) != len(boundaries):
        raise ValueError("one name per boundary")
    t = F.col(time_col)
    expr = None
    for name, b in zip(names, boundaries):
        cond = t < F.lit(b).cast("timestamp_ntz")
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    out = action.withColumn("split", expr)
    return out.where(F.col("split").isNotNull())


def rolling_history(action: DataFrame, months: int = 2, anchor=None, time_col: str = "action_time") -> DataFrame:
    """Rows in (anchor - months, anchor]; anchor defaults to the newest action."""
    a = action.select(F.max(time_col)).scalar() if anchor is None else F.lit(anchor).cast("timestamp_ntz")
    t = F.col(time_col)
    return action.where((t > a - F.expr(f"INTERVAL {int(months)} MONTHS")) & (t <= a))


def sorted_log(action: DataFrame, keys: Sequence[str] = ("action_time", "user_id", "sku_id", "event_id")) -> DataFrame:
    """Global sort (range-partitioned; no single-partition step)."""
    return action.orderBy(*keys)
