"""Registered model queries (phase 8): training, grids, CV, exact metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions.exprs import h64
from cartwheel.operators import blocked as BL
from cartwheel.operators import candidates as C
from cartwheel.operators import encode as E
from cartwheel.operators import ffm as FF
from cartwheel.operators import gbdt as G
from cartwheel.operators import metrics as MT
from cartwheel.operators import models as M
from cartwheel.operators import transform as X
from cartwheel.plans.catalog import register
from cartwheel.plans.encode_plans import _dict_ctes, enriched_table_of, train_dictionary, train_table_of
from cartwheel.plans.oracle_ctes import h64_sql, with_ctes
from cartwheel.plans.sampling_plans import TRAIN_SHARE, _assembled, _split_sql_ctes
from cartwheel.schemas import ENRICHED_COLUMNS, ENRICHED_NUMERIC, FEATURE_COLUMNS
from cartwheel.session import shared_path
from cartwheel.sources import fixtures as fx

MODEL_TRAIN_FRACTION = 0.8


def model_inputs(spark, sf):
    """Labelled train/test pairs with encoded features, written once to the
    shared folder (iterative solvers then re-read a table, not the lineage).
    80% of the shuffled negatives train, the rest evaluate (the 30M cut of the
    reference leaves no test negatives at small scale)."""
    a = _assembled(spark, sf, train_fraction=MODEL_TRAIN_FRACTION)
    wide = X.fill_zero(X.join_dimensions(a, fx.products(spark, sf), fx.users(spark, sf)))
    d = train_dictionary(spark, sf)
    enc = E.encode_columns(wide, d, unseen="keep")
    path = shared_path(spark, "model_inputs")
    enc.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    return table.where(F.col("part") == "train"), table.where(F.col("part") == "test"), d


def enriched_inputs(spark, sf):
    a = _assembled(spark, sf, train_fraction=MODEL_TRAIN_FRACTION)
    t = X.enriched_actions(a, fx.products(spark, sf), fx.users(spark, sf), fx.shops(spark, sf))
    path = shared_path(spark, "gbt_inputs")
    t.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _blocks(spark, sf):
    """(blocks of the train and test part, dictionary) of the AdaGrad models, written once."""
    train, test, d = model_inputs(spark, sf)
    cols = [f"f_{c}" for c in d.columns]
    parts = []
    for part in (train, test):
        rows = FF.training_rows(part, cols)
        parts.append(BL.by_hash(rows, rows.count()))
    return BL.write_blocks(*parts, len(cols)), d


FM_K, FM_REG, RATE, EPOCHS = 16, 0.002, 0.2, 10  # fixed values: k, λ, rate and epochs of the production model


def _report(spark, blocks, points):
    """Train a grid in one go; AUC and log-loss of every point on the test part."""
    trained = BL.fit(blocks, points, RATE, EPOCHS)
    path = shared_path(spark, "grid_scores")
    trained.predict(blocks).write.parquet(path)
    scored = spark.read.parquet(path)
    auc = {r["point"]: r["auc"] for r in MT.auc_exact(scored, group=["point"]).collect()}  # a row a point
    loss = {r["point"]: r["logloss"] for r in MT.logloss(scored, group=["point"]).collect()}
    return M.grid_report(spark, [{"model": {"linear": "lr"}.get(p.kind, p.kind), "lambda": p.reg, "k": p.k, "auc": auc.get(k), "logloss": loss.get(k)} for k, p in enumerate(points)])


@register("fm_train")
def fm_train(spark, sf):
    """FM by AdaGrad; exact AUC and log-loss on the test part."""
    blocks, _ = _blocks(spark, sf)
    return _report(spark, blocks, [BL.Point("fm", FM_K, FM_REG)])


def _fm_model(spark, sf):
    """The production FM, stored: (folder of its weight rows, encoded test pairs, dictionary)."""
    train, test, d = model_inputs(spark, sf)
    cols = [f"f_{c}" for c in d.columns]
    parts = [BL.by_hash(rows, rows.count()) for rows in (FF.training_rows(train, cols), FF.training_rows(test, cols))]
    trained = BL.fit(BL.write_blocks(*parts, len(cols)), [BL.Point("fm", FM_K, FM_REG)], RATE, EPOCHS)
    path = shared_path(spark, "fm_model")
    M.write_model(trained.table(spark), path)
    return path, test, d


@register("fm_weights")
def fm_weights(spark, sf):
    """Weight keys and values of the trained FM, from the stored model; the parameters never leave their table."""
    path, _, _ = _fm_model(spark, sf)
    return M.read_kv(spark, path)


@register("fm_rerank")
def fm_rerank(spark, sf):
    """Stored FM weights -> score the labelled test pairs -> top-3 per user."""
    path, test, d = _fm_model(spark, sf)
    table, bias = M.read_model(spark, path)
    enc = test.select("user_id", F.col("sku_id").alias("item_id"), *[f"f_{c}" for c in d.columns])
    return C.rank_by_score(C.fm_scores(enc.distinct(), [f"f_{c}" for c in d.columns], table, bias), 3)


_STEP_ROWS = [("enc_rows", "SELECT row_number() OVER () AS rid, label, " + f"{h64_sql("'block'", 'user_id', 'sku_id')} % 2 AS blk, {h64_sql("'batch'", 'user_id', 'sku_id')} % 2 AS bat, "
               + ", ".join(FEATURE_COLUMNS) + " FROM wide_train"),
              ("long_rows", "SELECT r.rid, r.blk, r.bat, CASE WHEN r.label > 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y, d.feature_id FROM enc_rows r JOIN dict d ON " + " OR ".join(
                  f"(d.field_id = {i} AND d.value = CAST(r.{c} AS BIGINT))" for i, c in enumerate(FEATURE_COLUMNS))
               + " UNION ALL SELECT rid, blk, bat, CASE WHEN label > 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END, -1 FROM enc_rows"),
              ("sizes", "SELECT blk, bat, count(*) AS n FROM enc_rows GROUP BY blk, bat"),
              ("s1", "SELECT l.blk, l.feature_id, sum(-l.y / 2) / any_value(s.n) AS g FROM long_rows l JOIN sizes s USING (blk, bat) WHERE bat = 0 GROUP BY l.blk, l.feature_id"),
              ("w1", "SELECT blk, feature_id, -0.2::DOUBLE * g / sqrt(g * g + 1e-8::DOUBLE) AS w, g * g AS a FROM s1"),
              ("phi", "SELECT l.rid, sum(coalesce(w1.w, 0.0::DOUBLE)) AS phi FROM long_rows l LEFT JOIN w1 USING (blk, feature_id) WHERE l.bat = 1 GROUP BY l.rid"),
              ("s2", "SELECT l.blk, l.feature_id, sum(-l.y / (1 + exp(l.y * p.phi))) / any_value(s.n) AS g FROM long_rows l JOIN phi p USING (rid) JOIN sizes s USING (blk, bat) GROUP BY l.blk, l.feature_id"),
              ("w2", """SELECT blk, feature_id, coalesce(w1.w, 0.0::DOUBLE) - coalesce(0.2::DOUBLE * s2.g / sqrt(coalesce(w1.a, 0.0::DOUBLE) + s2.g * s2.g + 1e-8::DOUBLE), 0.0::DOUBLE) AS w
  FROM w1 FULL JOIN s2 USING (blk, feature_id)"""),
              ("held", "SELECT blk, feature_id, count(*) AS n FROM long_rows GROUP BY blk, feature_id")]


@register("linear_minibatch_epoch", with_ctes(["clicks_train", "wide_train"], """
SELECT feature_id, round(sum(w * n) / sum(n), 6) AS weight FROM w2 JOIN held USING (blk, feature_id) GROUP BY feature_id""", local=_dict_ctes(FEATURE_COLUMNS) + _STEP_ROWS))
def linear_minibatch_epoch(spark, sf):
    """One epoch of the linear model from zero, two blocks of two mini-batches each, checked by value."""
    d = train_dictionary(spark, sf)
    enc = E.encode_columns(train_table_of(spark, sf), d)
    rows = enc.select("label", F.array(*[f"f_{c}" for c in d.columns]).alias("ids"), F.xxhash64("user_id", "sku_id").alias("row_id"),
                      *[F.pmod(h64(F.lit(what), "user_id", "sku_id"), F.lit(2)).alias(what) for what in ("block", "batch")])
    blocks = BL.write_blocks(rows, None, len(d.columns))
    trained = BL.fit(blocks, [BL.Point("linear", 0, 0.0)], rate=0.2, epochs=1)
    return trained.table(spark).select("feature_id", F.round("w", 6).alias("weight"))


@register("linear_adagrad_step", with_ctes(["clicks_train", "wide_train"], """
SELECT feature_id, round(-0.2 * g / sqrt(g * g + 1e-8), 6) AS weight FROM (
  SELECT feature_id, sum(CASE WHEN label > 0 THEN -0.5 ELSE 0.5 END) / (SELECT count(*) FROM wide_train) AS g FROM (
    SELECT w.label, d.feature_id FROM wide_train w JOIN dict d ON """ + " OR ".join(
    f"(d.field_id = {i} AND d.value = CAST(w.{c} AS BIGINT))" for i, c in enumerate(FEATURE_COLUMNS)) + """) x
  GROUP BY feature_id) y""", local=_dict_ctes(FEATURE_COLUMNS)))
def linear_adagrad_step(spark, sf):
    """One AdaGrad step of the linear model from zero, checked by value."""
    d = train_dictionary(spark, sf)
    enc = E.encode_columns(train_table_of(spark, sf), d)
    rows = FF.training_rows(enc, [f"f_{c}" for c in d.columns])
    params = FF.fit(rows, len(d.columns), k=0, reg=0.0, lr=0.2, epochs=1, kind="linear")
    return params.where("feature_id >= 0 and pos = -1").select("feature_id", F.round("value", 6).alias("weight"))


@register("lr_grid")
def lr_grid(spark, sf):
    return _report(spark, _blocks(spark, sf)[0], [BL.Point("linear", 0, reg) for reg in M.LR_LAMBDAS])


@register("fm_grid")
def fm_grid(spark, sf):
    return _report(spark, _blocks(spark, sf)[0], [BL.Point("fm", k, reg) for reg in M.FM_LAMBDAS for k in M.FM_FACTORS])


@register("ffm_grid")
def ffm_grid(spark, sf):
    """All nine points of the FFM comparison."""
    return _report(spark, _blocks(spark, sf)[0], [BL.Point("ffm", k, reg) for reg in M.FFM_LAMBDAS for k in M.FFM_FACTORS])


@register("gbt_cv")
def gbt_cv(spark, sf):
    t = enriched_inputs(spark, sf)
    return M.gbt_cv(t, ENRICHED_COLUMNS, folds=5, categorical=[c for c in ENRICHED_COLUMNS if c not in ENRICHED_NUMERIC], fold_keys=["user_id", "sku_id"])


TREE_LEAVES = 16


def _tree_sql(leaves: int) -> str:
    """Best-first growth, one split a step: histograms of all leaves, candidate cuts, the cut of largest gain, new leaves."""
    n, scale = len(ENRICHED_COLUMNS), "16777216.0::DOUBLE"
    numeric = [k for k, c in enumerate(ENRICHED_COLUMNS) if c in ENRICHED_NUMERIC]
    bins = ", ".join(f"lpad(CAST(dense_rank() OVER (ORDER BY {c}) AS VARCHAR), 5, '0')" if c in ENRICHED_NUMERIC else f"CAST({c} AS VARCHAR)" for c in ENRICHED_COLUMNS)
    ctes = [("share", "SELECT sum(CASE WHEN label > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / count(*) AS p FROM wide_train"),
            ("t0", f"""SELECT CAST(floor((p - CASE WHEN label > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * {scale}) AS BIGINT) AS g,
  CAST(floor(p * (1.0::DOUBLE - p) * {scale}) AS BIGINT) AS h, '' AS node, 0 AS leaf, [{bins}] AS bins FROM wide_train, share""")]

    def score(g: str, h: str, l2: str) -> str:
        g, h = f"(CAST({g} AS DOUBLE) / {scale})", f"(CAST({h} AS DOUBLE) / {scale})"
        return f"({g} * {g} / ({h} + {l2}))"

    for k in range(1, leaves):
        ends = []
        for way, order in ((1, "ratio, bin"), (2, "ratio DESC, bin")):
            ends.append(f"""SELECT leaf, node, f, {way} AS way, row_number() OVER w AS pos, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln,
  {G.CAT_L2}::DOUBLE AS l2, NULL AS upto, list(bin) OVER w AS cats
  FROM (SELECT *, row_number() OVER (PARTITION BY node, f ORDER BY {order}) AS r FROM cat{k}) x WHERE r <= {G.MOST_CATEGORIES}
  WINDOW w AS (PARTITION BY node, f ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
        ctes += [
            (f"h{k}", f"""SELECT leaf, node, f, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM (
  SELECT leaf, node, g, h, unnest(range(0, {n})) AS f, unnest(bins) AS bin FROM t{k - 1}) x GROUP BY leaf, node, f, bin"""),
            (f"cat{k}", f"""SELECT *, (CAST(g AS DOUBLE) / {scale}) / (CAST(h AS DOUBLE) / {scale} + {float(G.CAT_SMOOTH)}::DOUBLE) AS ratio
  FROM h{k} WHERE f NOT IN ({", ".join(map(str, numeric))}) AND n >= {G.CAT_SMOOTH}"""),
            (f"tot{k}", f"SELECT node, sum(g) AS tg, sum(h) AS th, sum(n) AS tn FROM h{k} WHERE f = 0 GROUP BY node"),
            (f"cut{k}", f"""SELECT leaf, node, f, 0 AS way, row_number() OVER w AS pos, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln,
  0.0::DOUBLE AS l2, bin AS upto, NULL AS cats FROM h{k} WHERE f IN ({", ".join(map(str, numeric))})
  WINDOW w AS (PARTITION BY node, f ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL {ends[0]} UNION ALL {ends[1]}"""),
            (f"best{k}", f"""SELECT * FROM (SELECT c.*, {score("lg", "lh", "l2")} + {score("(tg - lg)", "(th - lh)", "l2")} - {score("tg", "th", "0.0::DOUBLE")} AS gain
  FROM cut{k} c JOIN tot{k} USING (node) WHERE ln >= {G.MIN_ROWS} AND tn - ln >= {G.MIN_ROWS}) x WHERE gain > 0 ORDER BY gain DESC, node, f, way, pos LIMIT 1"""),
            (f"t{k}", f"""SELECT g, h, CASE WHEN here THEN node || CASE WHEN goes_left THEN 'L' ELSE 'R' END ELSE node END AS node,
  CASE WHEN here AND NOT goes_left THEN {k} ELSE leaf END AS leaf, bins FROM (
  SELECT t.*, coalesce(b.node = t.node, false) AS here, CASE WHEN b.cats IS NULL THEN t.bins[b.f + 1] <= b.upto ELSE list_contains(b.cats, t.bins[b.f + 1]) END AS goes_left
  FROM t{k - 1} t LEFT JOIN best{k} b ON true) x"""),
        ]
    names = "[" + ", ".join(f"'{c}'" for c in ENRICHED_COLUMNS) + "]"
    splits = " UNION ALL ".join(f"""SELECT 'split' AS row_kind, {k} AS no, leaf, {names}[f + 1] AS feature,
  CASE WHEN cats IS NULL THEN '<= ' || upto ELSE 'in ' || array_to_string(list_sort(cats), ',') END AS rule, CAST(ln AS BIGINT) AS rows, round(gain, 6) AS value FROM best{k}""" for k in range(1, leaves))
    return with_ctes(["clicks_train", "wide_train"], f"""{splits} UNION ALL
SELECT 'leaf', leaf, leaf, NULL, NULL, count(*), round({G.RATE}::DOUBLE * -((CAST(sum(g) AS DOUBLE) / {scale}) / (CAST(sum(h) AS DOUBLE) / {scale})), 6) FROM t{leaves - 1} GROUP BY leaf""",
                     local=ctes).replace(" AS (\n", " AS MATERIALIZED (\n")


@register("gbt_leafwise_tree", _tree_sql(TREE_LEAVES))
def gbt_leafwise_tree(spark, sf):
    """Splits in order of gain, and leaf values, of one best-first tree over the enriched training pairs."""
    table = enriched_table_of(spark, sf)
    categorical = [c for c in ENRICHED_COLUMNS if c not in ENRICHED_NUMERIC]
    bins = G.fit_bins(table, ENRICHED_COLUMNS, categorical)
    data = G.Data.write(table.withColumn("fold", F.lit(-1)), bins)
    trees = G.grow(data, spark, TREE_LEAVES)
    return G.describe(trees[0], bins, spark)


# ---------------------------------------------------------------- exact metrics
def _popularity_scored(spark, sf):
    """Labelled pairs scored by item popularity (an integer score; ties abound)."""
    a = _assembled(spark, sf)
    pop = fx.clicks(spark, sf).groupBy("sku_id").agg(F.count(F.lit(1)).alias("score"))
    top = pop.agg(F.max("score")).scalar()
    s = a.join(pop, "sku_id", "left").fillna(0, subset=["score"])
    return s.withColumn("prob", F.col("score") / (top + 1))


_SCORED = _split_sql_ctes(TRAIN_SHARE) + [
    ("pop", "SELECT sku_id, count(*) AS score FROM clicks GROUP BY sku_id"),
    ("scored", """SELECT a.part, a.label, coalesce(p.score, 0) AS score,
  coalesce(p.score, 0) / ((SELECT max(score) FROM pop) + 1) AS prob
  FROM assembled a LEFT JOIN pop p ON a.sku_id = p.sku_id"""),
]


@register("auc_exact", with_ctes(["clicks"], """
SELECT part, round(sum(pos * (coalesce(below, 0) + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM (SELECT *, sum(neg) OVER (PARTITION BY part ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS below
      FROM (SELECT part, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY part, score) g) c
GROUP BY part""", local=_SCORED))
def auc_exact(spark, sf):
    r = MT.auc_exact(_popularity_scored(spark, sf), group=["part"])
    return r.select("part", F.round("auc", 6).alias("auc"), "positives", "negatives")


@register("logloss_exact", with_ctes(["clicks"], """
SELECT part, round(avg(-(label * ln(greatest(least(prob, 1 - 1e-15), 1e-15))
                    + (1 - label) * ln(1 - greatest(least(prob, 1 - 1e-15), 1e-15)))), 6) AS logloss,
       count(*) AS rows
FROM scored GROUP BY part""", local=_SCORED))
def logloss_exact(spark, sf):
    r = MT.logloss(_popularity_scored(spark, sf), prob="prob", group=["part"])
    return r.select("part", F.round("logloss", 6).alias("logloss"), "rows")


@register("ffm_train")
def ffm_train(spark, sf):
    """FFM (k=4, λ=0.002); test AUC and log-loss."""
    return _report(spark, _blocks(spark, sf)[0], [BL.Point("ffm", 4, 0.002)])
