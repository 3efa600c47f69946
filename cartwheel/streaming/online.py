"""Online candidate generation for the users of one micro-batch.

The same batch operators as the offline path, on rows that keyed lookups fetch from the snapshot: the buckets of
the batch's users, then of their items, their brands, and the brands like them.  No snapshot table is read whole
but the hottest lists (three lists of a fixed length).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import bloom
from cartwheel.operators import candidates as C
from cartwheel.plans.offline import ITEM_FEATURES, USER_FEATURES, Snapshots
from cartwheel.schemas import FEATURE_COLUMNS


class Batch:
    """Lookups of one micro-batch in one version; small sets that several lookups read are kept until ``release``."""

    def __init__(self, users: DataFrame, snap: Snapshots, latest: DataFrame | None = None):
        self.spark = users.sparkSession
        self.snap = snap.current(self.spark)
        self.latest = latest
        self._held: list[DataFrame] = []
        self.users = self._keep(users.select("user_id").distinct())
        self.known = self._keep(self.find("users", self.users))

    def _keep(self, df: DataFrame) -> DataFrame:
        self._held.append(df.persist())
        return df

    def release(self) -> None:
        for df in self._held:
            df.unpersist()

    def find(self, name: str, wanted: DataFrame) -> DataFrame:
        return self.snap.lookup(self.spark, name, wanted)

    def candidates(self, users: DataFrame, k: int = 10, n: int = 10) -> DataFrame:
        """(user_id, sku_id, channels) of ``users``."""
        live = self.latest.join(users, "user_id", "left_semi") if self.latest is not None else self.find("latest", users)
        seen = self._keep(live.select("user_id", "rnk", "sku_id"))
        items = self._keep(self.find("items", seen).where("known").select("sku_id", "brand"))
        seeds = seen.join(items, "sku_id", "left_semi")  # known items only
        alike = self.find("brand_sim", items.select(F.col("brand").cast("bigint").alias("brand1")))
        top = self._keep(C.cf_brands(seeds, items, alike, k))
        brand_lists = self.find("content", top.select(F.lit("brand").alias("list_kind"), F.col("brand").alias("list_key")))
        cf = C.pick_from_brands(top, brand_lists, k)
        mine = self.known.join(users, "user_id", "left_semi")
        keys = mine.select(F.explode(F.array(*[F.struct(F.lit(c).alias("list_kind"), F.col(c).cast("bigint").alias("list_key")) for c in ("city", "age")])).alias("x")).select("x.*")
        hot = self.snap.read(self.spark, "hottest").where(F.col("days") == 1)
        return C.candidates_union(users, mine, self.find("content", keys), hot, cf, n)

    def encoded(self, candidates: DataFrame) -> DataFrame:
        """user_id, item_id and the feature ids of every candidate, from the encoded rows of users and items."""
        pairs = self._keep(candidates.select("user_id", "sku_id").distinct())
        users = self.known.select("user_id", *[f"f_{c}" for c in USER_FEATURES])
        items = self.find("items", pairs).select("sku_id", *[f"f_{c}" for c in ITEM_FEATURES])
        none = self.snap.defaults(self.spark)
        out = pairs.join(users, "user_id", "left").join(items, "sku_id", "left")
        return out.select("user_id", F.col("sku_id").alias("item_id"), *[F.coalesce(f"f_{c}", F.lit(none[f"f_{c}"])).alias(f"f_{c}") for c in FEATURE_COLUMNS])


Answer = tuple[DataFrame, Callable[[], None]]


def candidates_for(users: DataFrame, snap: Snapshots, k: int = 10, n: int = 10, latest: DataFrame | None = None) -> DataFrame:
    """Candidates of the requesting users.  ``latest`` (user_id, rnk, sku_id) overrides the snapshot's latest
    lists, e.g. by the live keyed state (``jobs.latest_from_state``)."""
    batch = Batch(users, snap, latest)
    return batch.candidates(batch.users, k, n)


def payload_for(users: DataFrame, snap: Snapshots, latest: DataFrame | None = None) -> Answer:
    """Encoded candidate message per requesting user (K7), and what frees the batch's kept rows."""
    batch = Batch(users, snap, latest)
    enc = batch.encoded(batch.candidates(batch.users))
    return C.candidate_payload(enc, [f"f_{c}" for c in FEATURE_COLUMNS]), batch.release


def rerank_for(users: DataFrame, snap: Snapshots, weights: DataFrame, bias: float = 0.0, top: int = 3, cold_days: int = 7,
               latest: DataFrame | None = None) -> Answer:
    """Web click -> candidates -> FM score -> top-``top`` recommendation.

    Users outside the known-user set take the cold-start path instead: the
    top-``top`` hottest items of the last ``cold_days`` days (score NULL).
    """
    snap = snap.current(users.sparkSession)
    asked = users.select("user_id").distinct()
    # the filter settles most new users in the scan of the batch; only the others are looked up
    maybe = bloom.might_contain(F.col("user_id"), bloom.as_column(snap.read(users.sparkSession, "known_user_bloom")))
    batch = Batch(asked.where(maybe), snap, latest)
    warm = batch.users.join(batch.known.where("known"), "user_id", "left_semi")
    cold = asked.join(batch.known.where("known"), "user_id", "left_anti")
    enc = batch.encoded(batch.candidates(warm))
    scores = C.fm_scores(enc, [f"f_{c}" for c in FEATURE_COLUMNS], weights, bias)
    ranked = C.rank_by_score(scores, top)
    hot = (batch.snap.read(batch.spark, "hottest").where((F.col("days") == cold_days) & (F.col("rnk") <= top))
           .select("rnk", F.col("sku_id").alias("item_id")))
    hot_arr = hot.agg(F.array_sort(F.collect_list(F.struct("rnk", "item_id")))).scalar()  # ≤ top rows
    new = cold.select("user_id", F.explode(hot_arr).alias("h")).select(
        "user_id", "h.rnk", "h.item_id", F.lit(None).cast("double").alias("score"))
    return ranked.unionByName(new), batch.release
