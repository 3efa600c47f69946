"""Mixing sources to target weights: iterative proportional fitting over source, language and topic.

Token counts per (source, language, topic) are raked until each margin has its target share:
``weight(cell) = a[source] * b[language] * c[topic]``.  One raking round is one Spark job: every source row
holds its own language x topic counts (a bounded list), so ``a`` follows row by row, and the sums that update
``b`` and ``c`` come back as one small row per (language, topic).  Sources may be many (hosts); the number of
language x topic pairs is checked against ``max_pairs``.  A document is then drawn ``floor(weight)`` times and
once more with the probability of the rest, so the expected tokens of every margin meet its target; the draw is
a hash of its id and the seed, so a rerun draws the same documents.

Defined results: a null source, language or topic is a category of its own (``(none)``); a document without a
word takes no part in the raking and is kept once (weight 1); a target of 0 or a value without a target gets
weight 0; an empty table gives no rows; further columns pass through; repeated ids share their draw.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import unused

NONE = "(none)"
MAX_PAIRS = 20_000
#: the counted cells are far fewer than documents; rounds over them use tasks of this size
SOURCES_A_TASK, CELLS_A_TASK = 20_000, 200_000
WORD = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def register_topic(text: Column) -> Column:
    """A topic every text has: numeric, symbols, capitals or prose, by shares of its characters."""
    n = F.length(text)
    return (F.when(n.isNull() | (n == 0), F.lit(None).cast("string"))
            .when(F.regexp_count(text, F.lit("[0-9]")) * 20 > n, "numeric")
            .when(F.regexp_count(text, F.lit(r"[#$%&*|!@~^{}<>=_]")) * 20 > n, "symbols")
            .when(F.regexp_count(text, F.lit("[A-Z]")) * 4 > n, "capitals")
            .otherwise("prose"))


def uniform(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from the id and the seed, the same in every engine with MD5."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit("|" + seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def tempered(counts: DataFrame, value: str, tokens: str, power: float) -> DataFrame:
    """Target shares proportional to ``tokens ** power`` (1: as they are, 0: all equal): (value, share)."""
    sums = counts.groupBy(value).agg(F.sum(tokens).cast("double").alias("_t")).where("_t > 0")
    total = sums.agg(F.sum(F.pow("_t", F.lit(power)))).first()[0] or 1.0
    return sums.select(value, (F.pow("_t", F.lit(power)) / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], iterations: int = 15, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Cells (source, lang, topic, tokens) with ``weight``; targets: (value, share) for each of the three.

    ``targets["lang"]`` and ``targets["topic"]`` must be small (their pairs are checked); ``targets["source"]``
    is joined.
    """
    cells = cells.where("tokens > 0")
    total = cells.agg(F.sum("tokens")).first()[0]
    empty = cells.withColumn("weight", F.lit(None).cast("double")).limit(0)
    if not total:
        return empty
    pairs = cells.select("lang", "topic").distinct().limit(max_pairs + 1).collect()
    if len(pairs) > max_pairs:
        raise ValueError(f"more than {max_pairs} (language, topic) pairs: rake coarser topics")
    small = {d: {r[0]: r[1] * total for r in targets[d].select(d, "share").limit(max_pairs + 1).collect()} for d in ("lang", "topic")}
    rows = (cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("own"))
            .join(targets["source"].select("source", (F.col("share") * total).alias("goal")), "source").checkpoint())
    rows = rows.coalesce(1 + rows.count() // SOURCES_A_TASK)
    b = {r["lang"]: 1.0 for r in pairs}
    c = {r["topic"]: 1.0 for r in pairs}

    def with_a() -> DataFrame:
        """The source rows with ``a`` under the present ``b`` and ``c`` (one literal map of at most max_pairs)."""
        f = F.from_json(F.lit(json.dumps({f"{r['lang']}\x00{r['topic']}": b[r["lang"]] * c[r["topic"]] for r in pairs})), "map<string,double>")
        scaled = F.transform("own", lambda x: F.struct(x["lang"].alias("lang"), x["topic"].alias("topic"), x["tokens"].alias("tokens"),
                                                       f[F.concat(x["lang"], F.lit("\x00"), x["topic"])].alias("f")))
        mass = F.aggregate("own", F.lit(0.0), lambda s, x: s + x["tokens"] * x["f"])
        return (rows.withColumn("own", scaled).withColumn("mass", mass)
                .withColumn("a", F.when(F.col("mass") > 0, F.col("goal") / F.col("mass")).otherwise(0.0)))

    for _ in range(iterations):
        sums = (with_a().select("a", F.explode("own").alias("x")).groupBy("x.lang", "x.topic")
                .agg(F.sum(F.col("a") * F.col("x.tokens")).alias("g")).collect())
        g = {(r["lang"], r["topic"]): r["g"] for r in sums}
        for name in b:
            have = sum(v * c[t] for (x, t), v in g.items() if x == name)
            b[name] = small["lang"].get(name, 0.0) / have if have > 0 else 0.0
        for name in c:
            have = sum(v * b[x] for (x, t), v in g.items() if t == name)
            c[name] = small["topic"].get(name, 0.0) / have if have > 0 else 0.0
    last = with_a().select("source", "a", F.explode("own").alias("x"))
    return last.select("source", "x.lang", "x.topic", "x.tokens", (F.col("a") * F.col("x.f")).alias("weight"))


OUTPUTS = ("mix_topic", "mix_tokens", "mix_weight", "mix_copies")


def mix(docs: DataFrame, powers: dict[str, float], topic: Column | None = None, seed: str = "mix", iterations: int = 15,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with mix_topic, mix_tokens, mix_weight and mix_copies (draws), raked to the tempered margins.

    Weights are relative to the corpus: 1 keeps a cell's tokens, 2 doubles them.
    """
    spark_text = F.col(text_col).cast("string")
    own = [c for c in docs.columns if c.lower() not in OUTPUTS]
    inner = {d: unused(f"_{d}", own) for d in ("source", "lang", "topic", "w")}   # names no column of ``docs`` has
    tagged = docs.select(*own, F.coalesce(register_topic(spark_text) if topic is None else topic, F.lit(NONE)).alias("mix_topic"),
                         n_tokens(spark_text).alias("mix_tokens"))
    key = {"source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)), "lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)), "topic": F.col("mix_topic")}
    cells = (tagged.select(*[v.alias(k) for k, v in key.items()], F.col("mix_tokens").alias("tokens"))
             .groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")).checkpoint())
    cells = cells.coalesce(1 + cells.count() // CELLS_A_TASK)
    targets = {d: tempered(cells, d, "tokens", powers[d]) for d in ("source", "lang", "topic")}
    raked = rake(cells, targets, iterations).checkpoint()
    weights = raked.select(*[F.col(d).alias(inner[d]) for d in key], F.col("weight").alias(inner["w"]))
    joined = tagged.withColumns({inner[d]: v for d, v in key.items()}).join(weights, [inner[d] for d in key], "left")
    weight = F.when(F.col("mix_tokens") == 0, 1.0).otherwise(F.coalesce(F.col(inner["w"]), F.lit(0.0)))
    once_more = uniform(F.col(id_col), seed) < F.col("mix_weight") - F.floor("mix_weight")
    return (joined.withColumn("mix_weight", weight).drop(*inner.values())
            .withColumn("mix_copies", F.floor("mix_weight").cast("bigint") + once_more.cast("bigint")))


def mix_sql(powers: dict[str, float], seed: str = "mix", iterations: int = 15, documents: str = "documents") -> str:
    """The same in DuckDB: CTEs up to ``mixed`` with every document, its weight and its draws."""
    steps = [f"""
tagged AS MATERIALIZED (SELECT *, coalesce(CASE WHEN text IS NULL OR text = '' THEN NULL
   WHEN len(regexp_extract_all(text, '[0-9]')) * 20 > length(text) THEN 'numeric'
   WHEN len(regexp_extract_all(text, '[#$%&*|!@~^{{}}<>=_]')) * 20 > length(text) THEN 'symbols'
   WHEN len(regexp_extract_all(text, '[A-Z]')) * 4 > length(text) THEN 'capitals' ELSE 'prose' END, '{NONE}') AS mix_topic,
   coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS mix_tokens,
   coalesce(source, '{NONE}') AS _source, coalesce(lang, '{NONE}') AS _lang FROM {documents}),
cells AS MATERIALIZED (SELECT _source AS s, _lang AS l, mix_topic AS t, sum(mix_tokens)::DOUBLE AS n FROM tagged GROUP BY ALL HAVING sum(mix_tokens) > 0)"""]
    for d, name in (("s", "source"), ("l", "lang"), ("t", "topic")):
        steps.append(f"goal_{d} AS MATERIALIZED (SELECT {d}, power(x, {powers[name]}) / sum(power(x, {powers[name]})) OVER () * sum(x) OVER () AS goal FROM (SELECT {d}, sum(n) AS x FROM cells GROUP BY {d}))")
    steps += ["b0 AS (SELECT l, 1.0::DOUBLE AS b FROM goal_l)", "c0 AS (SELECT t, 1.0::DOUBLE AS c FROM goal_t)"]
    for k in range(iterations + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT s, any_value(goal) / sum(n * b * c) AS a FROM cells JOIN b{k} USING (l) JOIN c{k} USING (t) JOIN goal_s USING (s) GROUP BY s)")
        if k < iterations:
            steps += [f"g{k} AS MATERIALIZED (SELECT l, t, sum(n * a) AS g FROM cells JOIN a{k} USING (s) GROUP BY l, t)",
                      f"b{k + 1} AS MATERIALIZED (SELECT l, any_value(goal) / sum(g * c) AS b FROM g{k} JOIN c{k} USING (t) JOIN goal_l USING (l) GROUP BY l)",
                      f"c{k + 1} AS MATERIALIZED (SELECT t, any_value(goal) / sum(g * b) AS c FROM g{k} JOIN b{k + 1} USING (l) JOIN goal_t USING (t) GROUP BY t)"]
    n = iterations
    steps.append(f"""
weights AS MATERIALIZED (SELECT s, l, t, a * b * c AS w FROM cells JOIN a{n} USING (s) JOIN b{n} USING (l) JOIN c{n} USING (t)),
weighed AS (SELECT tagged.* EXCLUDE (_source, _lang), CASE WHEN mix_tokens = 0 THEN 1.0 ELSE coalesce(w, 0) END AS mix_weight,
   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{seed}'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS mix_u
   FROM tagged LEFT JOIN weights ON s = _source AND l = _lang AND t = mix_topic),
mixed AS (SELECT * EXCLUDE (mix_u), floor(mix_weight)::BIGINT + (mix_u < mix_weight - floor(mix_weight))::BIGINT AS mix_copies FROM weighed)""")
    return ",".join(steps)
