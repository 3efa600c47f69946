"""Offline refresh: compute every snapshot the online path reads.

``refresh(...)`` is the Spark form of the reference's offline job: sets,
training table + dictionary, content / hottest lists, brand similarity and
latest items.  A refresh writes a new version folder below ``out_dir`` (in the
cluster's shared storage) and then adds one pointer record; nothing that a
reader may have open is overwritten.  The online job looks the pointer up every
micro-batch (``Snapshots.current``), so it sees a refresh without a restart and
all tables of one version together.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import bloom
from cartwheel.operators import encode as E
from cartwheel.operators import recall as R
from cartwheel.operators import similarity as S
from cartwheel.operators import topk_graph as T
from cartwheel.operators import transform as X
from cartwheel.schemas import FEATURE_COLUMNS
from cartwheel.sources import keyed

USER_FEATURES = ("age", "sex", "city", "county", "user_id")
ITEM_FEATURES = ("brand", "shop_id", "cate", "sku_id")


KEYS = {"users": ["user_id"], "items": ["sku_id"], "latest": ["user_id"], "content": ["list_kind", "list_key"], "brand_sim": ["brand1"]}


@dataclass
class Snapshots:
    """One version of the tables that a refresh writes; ``users``, ``items``, ``latest``, ``content`` and ``brand_sim`` are keyed."""
    root: str
    version: str
    buckets: int = 16
    _open: dict = field(default_factory=dict, repr=False)  # tables by path, as a version never changes; the newest version

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.version}/{name}"

    def _pointers(self) -> str:
        return f"{self.root.rstrip('/')}/pointers"

    def current(self, spark: SparkSession) -> Snapshots:
        """The newest complete version."""
        newest = spark.read.parquet(self._pointers()).agg(F.max(F.struct("written_us", "version", "buckets"))).first()[0]
        if newest["version"] == self.version:
            return self
        held = self._open.get("newest")
        if held is None or held.version != newest["version"]:
            held = self._open["newest"] = Snapshots(self.root, newest["version"], newest["buckets"])
        return held

    def publish(self, spark: SparkSession) -> None:
        """Add this version's pointer record: the last step of a refresh."""
        row = [(time.time_ns() // 1000, self.version, self.buckets)]
        (spark.createDataFrame(row, "written_us long, version string, buckets int").coalesce(1)
         .write.mode("append").parquet(self._pointers()))

    def retire(self, spark: SparkSession, keep: int = 3) -> list[str]:
        """Delete all versions but the newest ``keep``, with their pointer records; returns their names.

        ``keep`` leaves readers that hold an older version the time of ``keep`` - 1 refreshes.
        """
        rows = (spark.read.parquet(self._pointers()).select("written_us", "version", F.input_file_name().alias("file"))
                .orderBy(F.desc("written_us"), F.desc("version")).collect())  # a row a version kept so far
        old = rows[keep:]
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for r in old:
            for target in (r["file"], f"{self.root.rstrip('/')}/{r['version']}"):  # the pointer first: nobody opens it then
                path = jvm.org.apache.hadoop.fs.Path(target)
                path.getFileSystem(conf).delete(path, True)
        return [r["version"] for r in old]

    def _table(self, spark: SparkSession, name: str) -> DataFrame:
        if self.path(name) not in self._open:
            self._open[self.path(name)] = spark.read.parquet(self.path(name))
        return self._open[self.path(name)]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self._table(spark, name).drop(keyed.BUCKET)

    def lookup(self, spark: SparkSession, name: str, wanted: DataFrame) -> DataFrame:
        """Rows of a keyed table for the keys in ``wanted``, from their buckets only."""
        return keyed.lookup(self._table(spark, name), KEYS[name], wanted, self.buckets)

    def defaults(self, spark: SparkSession) -> dict[str, int]:
        """Feature ids of a user or an item that no table knows."""
        if "defaults" not in self._open:
            self._open["defaults"] = self.read(spark, "defaults").first().asDict()
        return self._open["defaults"]

    def dictionary(self, spark: SparkSession) -> E.FeatureDictionary:
        fields = self.read(spark, "dict_fields")
        rows = [r.asDict() for r in fields.orderBy("field_id").collect()]  # one row per field
        values = self.read(spark, "dict_values")
        cols = [r["column"] for r in rows]
        numeric = [r["column"] for r in rows if r["kind"] == "numeric"]
        return E.FeatureDictionary(fields, values, cols, numeric, rows)


def encoded_dimension(dimension: DataFrame, key: str, known: DataFrame, d: E.FeatureDictionary, own: Sequence[str],
                      also: Sequence[str] = ()) -> DataFrame:
    """Every key of the dimension, the log or the dictionary: (key, known, ``also``, f_<column> of ``own``).

    Attributes are 0-filled before they are encoded, as a candidate's are; ``also`` columns stay as they are.
    """
    trained = d.values.where(F.col("column") == key).select(F.col("value").alias(key))
    logged = known.select(key).distinct().withColumn("known", F.lit(True))
    keys = dimension.select(key).union(trained).union(logged.select(key)).where(F.col(key).isNotNull()).distinct()
    attrs = [c for c in own if c != key]
    rows = keys.join(dimension.select(key, *dict.fromkeys([*attrs, *also])), key, "left")
    rows = rows.select("*", *[F.col(c).alias(f"raw_{c}") for c in also])
    encoded = E.encode_columns(rows.fillna(0, subset=attrs), d, "keep", columns=list(own))
    return (encoded.join(logged, key, "left")
            .select(key, F.coalesce("known", F.lit(False)).alias("known"), *[F.col(f"raw_{c}").alias(c) for c in also], *[f"f_{c}" for c in own]))


def history_until(action: DataFrame, anchor=None, months: int | None = None) -> DataFrame:
    """The log a refresh sees: (anchor - months, anchor] (both optional)."""
    if months:
        return X.rolling_history(action, months, anchor)
    if anchor is not None:
        return action.where(F.col("action_time") <= F.lit(anchor).cast("timestamp_ntz"))
    return action


def refresh(action: DataFrame, train_action: DataFrame, product: DataFrame, user: DataFrame,
            out_dir: str, history_months: int | None = None, list_len: int = 10, anchor=None,
            with_lines: bool = False, with_item_cf: bool = False, buckets: int | None = None, keep: int | None = None) -> Snapshots:
    """Compute and write all snapshots; returns their locations.

    ``anchor`` (a timestamp) limits both logs to actions up to it, and with
    ``history_months`` to the rolling window before it (README: two months).
    ``buckets`` of the keyed tables follow the number of users unless given;
    ``keep`` retires all but that many versions.  The enriched log (action ⋈ product ⋈ user) feeds several lists, so it is
    written once and re-read.  ``with_lines`` also writes the libffm training
    text; ``with_item_cf`` the top-k item graph and per-user top-20 CF lists.
    """
    from cartwheel.operators import candidates as C
    from cartwheel.sources import files as io

    spark = action.sparkSession
    snap = Snapshots(out_dir, f"version_{uuid.uuid4().hex[:12]}")
    log = history_until(action, anchor, history_months)
    R.recall_input(log, product, user).write.mode("overwrite").parquet(snap.path("enriched"))
    enriched = snap.read(spark, "enriched")

    R.distinct_sets(enriched).write.mode("overwrite").parquet(snap.path("sets"))
    sets = snap.read(spark, "sets")
    snap.buckets = buckets or keyed.buckets_for(sets.where("set_name = 'user'").count())

    def put(name: str, table: DataFrame) -> None:
        keyed.write_keyed(table, snap.path(name), KEYS[name], snap.buckets)

    train = X.train_table(history_until(train_action, anchor, history_months), product, user)
    d = E.build_dictionary(train, FEATURE_COLUMNS, path=snap.path("dict_values"))
    d.fields.write.mode("overwrite").parquet(snap.path("dict_fields"))
    if with_lines:
        io.write_lines(E.ffm_lines(train, d), snap.path("train_ffm"))
    known_users = sets.where("set_name = 'user'").select(F.col("id").alias("user_id"))
    known_items = sets.where("set_name = 'item'").select(F.col("id").alias("sku_id"))
    bloom.build(known_users, "user_id", bloom.bits_for(known_users.count())).write.mode("overwrite").parquet(snap.path("known_user_bloom"))
    put("users", encoded_dimension(user, "user_id", known_users, d, USER_FEATURES, also=("city", "age")))
    put("items", encoded_dimension(product, "sku_id", known_items, d, ITEM_FEATURES, also=("brand",)))
    nobody = spark.range(1).select(*[F.lit(0).cast("bigint").alias(c) for c in FEATURE_COLUMNS])
    ids = E.encode_columns(nobody, d, "keep").select(*[f"f_{c}" for c in FEATURE_COLUMNS])
    for c in ("user_id", "sku_id"):  # an unknown key is unseen, whatever the dictionary says of 0
        ids = ids.withColumn(f"f_{c}", F.lit(d.total + d.field(c)["field_id"]).cast("bigint"))
    ids.write.mode("overwrite").parquet(snap.path("defaults"))
    put("content", R.content_lists(enriched, R.CONTENT_KINDS, list_len))
    R.hottest_lists(enriched, (1, 7, 30), list_len).write.mode("overwrite").parquet(snap.path("hottest"))
    R.toplists(snap.read(spark, "content"), snap.read(spark, "hottest")) \
        .write.mode("overwrite").parquet(snap.path("toplists"))
    active = R.active_actions(enriched, 5)
    put("brand_sim", S.brand_similarity(active))
    if with_item_cf:
        graph = T.topk_cosine(active.select(F.col("user_id").alias("user"), F.col("sku_id").alias("entity")))
        graph.select(F.col("e1").alias("sku1"), F.col("e2").alias("sku2"), "rnk", "co", "sim").write.mode("overwrite").parquet(snap.path("item_sim"))
        C.user_topn_cf(enriched.where("user_id is not null and sku_id is not null"), snap.read(spark, "item_sim"), 20) \
            .write.mode("overwrite").parquet(snap.path("user_cf"))
    put("latest", R.latest_items(enriched, 10))
    snap.publish(spark)
    if keep:
        snap.retire(spark, keep)
    return snap
