"""Registered sampling queries (phase 6): negatives, shuffle split, assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import sampling as SM
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle_ctes import h64_sql, with_ctes
from cartwheel.sources import fixtures as fx

SEED = 42
TRAIN_SHARE = 0.8  # of the negatives; a production run may give a number instead (30 million)
TRAIN_END = "2024-01-17"
TEST_END = "2024-01-31"


def negatives_sql_ctes(src: str = "clicks", seed: int = SEED) -> list[tuple[str, str]]:
    s = f"'{seed}'"
    primes = ", ".join(str(p) for p in SM.step_primes())
    return [
        ("ng_items", f"SELECT DISTINCT sku_id FROM {src} WHERE sku_id IS NOT NULL"),
        ("ng_idx", f"""SELECT sku_id, row_number() OVER (ORDER BY {h64_sql(s, "'item'", "sku_id")}, sku_id) - 1 AS idx
  FROM ng_items"""),
        ("ng_n", "SELECT count(*) AS n FROM ng_items"),
        ("ng_cnt", f"SELECT user_id, count(*) AS cnt FROM {src} WHERE user_id IS NOT NULL GROUP BY user_id"),
        ("ng_params", f"""SELECT user_id, n,
  CAST(least(greatest(cnt + floor(-cnt / 10) + ({h64_sql(s, "'m'", "user_id")}
        % CAST(floor(cnt / 10) + 2 - floor(-cnt / 10) + 1 AS BIGINT)), 0), n) AS BIGINT) AS m,
  [{primes}][CAST(1 + {h64_sql(s, "'a'", "user_id")} % {SM.N_STEP_PRIMES} AS INTEGER)] % n AS a,
  {h64_sql(s, "'b'", "user_id")} % n AS b
  FROM ng_cnt, ng_n"""),
        ("ng_draws", "SELECT user_id, (a * i + b) % n AS idx FROM (SELECT *, unnest(range(m)) AS i FROM ng_params) t"),
        ("ng_touched", f"SELECT DISTINCT user_id, sku_id FROM {src} WHERE user_id IS NOT NULL AND sku_id IS NOT NULL"),
        ("negatives", """SELECT d.user_id, x.sku_id, CAST(0 AS TINYINT) AS label
  FROM ng_draws d JOIN ng_idx x ON d.idx = x.idx
  WHERE NOT EXISTS (SELECT 1 FROM ng_touched t WHERE t.user_id = d.user_id AND t.sku_id = x.sku_id)"""),
    ]


def _split_sql_ctes(share: float, seed: int = SEED) -> list[tuple[str, str]]:
    s = f"'{seed}'"
    return negatives_sql_ctes() + [
        ("neg_ranked", f"""SELECT user_id, sku_id, label,
  row_number() OVER (ORDER BY {h64_sql(s, "'shuffle'", "user_id", "sku_id")}, user_id, sku_id) AS r FROM negatives"""),
        ("assembled", f"""
  SELECT user_id, sku_id, CAST(1 AS TINYINT) AS label, 'train' AS part FROM clicks
    WHERE action_time < TIMESTAMP '{TRAIN_END}'
  UNION ALL
  SELECT user_id, sku_id, CAST(1 AS TINYINT), 'test' FROM clicks
    WHERE action_time >= TIMESTAMP '{TRAIN_END}' AND action_time < TIMESTAMP '{TEST_END}'
  UNION ALL
  SELECT user_id, sku_id, label, CASE WHEN r <= (SELECT CAST(floor(count(*) * {share}) AS BIGINT) FROM negatives) THEN 'train' ELSE 'test' END FROM neg_ranked"""),
    ]


def _assembled(spark, sf, k: int | None = None, train_fraction: float = TRAIN_SHARE):
    """Positives + negatives with a train/test part.  ``k`` negatives go to
    train; without it ``train_fraction`` of the counted ones, so both parts
    hold negatives at any scale."""
    clicks = fx.clicks(spark, sf)
    t = F.col("action_time")
    train_pos = clicks.where(t < F.lit(TRAIN_END).cast("timestamp_ntz"))
    test_pos = clicks.where((t >= F.lit(TRAIN_END).cast("timestamp_ntz")) & (t < F.lit(TEST_END).cast("timestamp_ntz")))
    neg = SM.negative_samples(clicks, SEED)
    return SM.train_test_with_negatives(train_pos, test_pos, neg, k, SEED, share=train_fraction)


@register("negative_samples", with_ctes(["clicks"], "SELECT user_id, sku_id, label FROM negatives",
                                        local=negatives_sql_ctes()))
def negative_samples(spark, sf):
    return SM.negative_samples(fx.clicks(spark, sf), SEED).select("user_id", "sku_id", "label")


@register("train_test_negatives", with_ctes(["clicks"], "SELECT user_id, sku_id, label, part FROM assembled",
                                            local=_split_sql_ctes(TRAIN_SHARE)))
def train_test_negatives(spark, sf):
    return _assembled(spark, sf)


@register("train_with_negatives", with_ctes(["clicks"], """
SELECT user_id, sku_id, label FROM assembled WHERE part = 'train'""", local=_split_sql_ctes(TRAIN_SHARE)))
def train_with_negatives(spark, sf):
    return _assembled(spark, sf).where(F.col("part") == "train").select("user_id", "sku_id", "label")
