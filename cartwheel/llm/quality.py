"""Quality classifier: overlapping heuristic labellers, a label model fitted by EM, a hashed linear scorer.

Two heads with the same machinery:

* ``quality``: labellers look at a document's own statistics (symbols, capitals, separators, repeated words and
  lines, length) and vote good, bad or abstain;
* ``toxic``: a lexicon is learned from at most ``labelled_rows`` labelled documents (words that occur almost only
  in toxic ones) and dealt to three labellers by hash, plus one for several different lexicon words.

All documents vote; the votes are counted as patterns in Spark (3 ** labellers patterns at most).  EM on the pattern
counts estimates the share of the positive class and each labeller's accuracy on either class.  The patterns of
the labelled sample keep their given class and weigh as much as all others together, which ties the latent class
to the label; without labels EM starts from the votes weighed by rarity.  The posterior of its pattern is a document's soft label.  The linear scorer (hashed words, log-scaled
counts, plus the labellers' statistics) is fitted on at most about ``fit_rows`` documents drawn by hash, half from
either side of posterior 1/2; then every document gets the scorer's probability.

Defined results: a null or empty text, or one without a word, is bad quality (0) and not toxic (0); without
labelled toxic rows the lexicon is empty and nothing is toxic; extra columns are ignored; repeated rows are
scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import U, Words, mix, text_blocks

LABELLED_ROWS = 20_000
FIT_ROWS = 8_000
HASH_BITS = 18
ABSTAIN, NEGATIVE, POSITIVE = 0, 1, 2

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|!@~^{}<>=_+"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = _UPPER.copy()
_ALPHA[97:123] = True
_TOXIC_PARTS = 3


@dataclass
class Block:
    """Features of the documents of one block of text."""
    words: Words
    stats: np.ndarray    # (docs, features), see STATS


STATS = ["words", "symbols", "capitals", "separators", "repeated", "echo", "lines", "shortness"]


def _sum_by(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    run = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return run[off[1:]] - run[off[:-1]]


def _distinct(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """Distinct values of ``h`` per document."""
    key = np.unique(mix(h + doc.astype(np.uint64) * U(0x9E3779B97F4A7C15)), return_index=True)[1]
    return np.bincount(doc[key], minlength=n_docs)


def features(raw: np.ndarray, off: np.ndarray) -> Block:
    """Word spans and the labellers' statistics."""
    words = Words(raw, off)
    n_docs = len(off) - 1
    count = np.maximum(words.count, 1)
    size = np.maximum(np.diff(off), 1)
    alpha = np.maximum(_sum_by(_ALPHA[raw], off), 1)
    # lines: spans between newlines, compared by length and the sum of their word hashes
    line_of_byte = np.cumsum(raw == 10)
    line = line_of_byte[words.start] if len(words.start) else np.zeros(0, np.int64)
    new_line = np.ones(len(line), bool)
    new_line[1:] = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
    begin = np.flatnonzero(new_line)
    line_hash = np.add.reduceat(words.hash, begin) if len(begin) else np.zeros(0, np.uint64)
    line_doc = words.doc[begin]
    same = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    lines = np.maximum(np.bincount(line_doc, minlength=n_docs), 1)
    stats = np.stack([
        np.log1p(words.count),
        _sum_by(_SYMBOL[raw], off) / size,
        _sum_by(_UPPER[raw], off) / alpha,
        _sum_by(raw == 124, off) / count,
        1.0 - _distinct(words.doc, words.hash, n_docs) / count,
        np.bincount(words.doc[1:][same], minlength=n_docs) / count,
        1.0 - _distinct(line_doc, line_hash, n_docs) / lines,
        1.0 / count], axis=1).astype(np.float32)
    return Block(words, stats)


def quality_votes(b: Block) -> np.ndarray:
    """(docs, labellers) of ABSTAIN, NEGATIVE (bad) and POSITIVE (good)."""
    s = {name: b.stats[:, k] for k, name in enumerate(STATS)}
    n = b.words.count

    def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.where(bad, NEGATIVE, np.where(good, POSITIVE, ABSTAIN))

    return np.stack([
        vote(s["symbols"] < 0.01, s["symbols"] > 0.04),
        vote(s["capitals"] < 0.15, s["capitals"] > 0.4),
        vote(s["separators"] < 0.05, s["separators"] > 0.2),
        vote((n >= 20) & (s["repeated"] < 0.5), (n >= 20) & (s["repeated"] > 0.75)),
        vote(s["echo"] < 0.02, (n >= 6) & (s["echo"] > 0.1)),
        vote(s["lines"] < 0.1, s["lines"] > 0.3),
        vote(n >= 40, n < 3),
    ], axis=1).astype(np.int8)


def toxic_votes(b: Block, lexicon: np.ndarray) -> np.ndarray:
    """Three labellers own a third of the lexicon each, a fourth asks for two different words of it."""
    n_docs = len(b.words.count)
    out = np.full((n_docs, _TOXIC_PARTS + 1), NEGATIVE, np.int8)
    if len(lexicon) and len(b.words.hash):
        bare = bare_words(b.words)
        pos = np.minimum(np.searchsorted(lexicon, bare), len(lexicon) - 1)
        at = np.flatnonzero(lexicon[pos] == bare)
        part = (mix(bare[at]) % U(_TOXIC_PARTS)).astype(np.int64)
        out[b.words.doc[at], part] = POSITIVE
        kinds = _distinct(b.words.doc[at], bare[at], n_docs) if len(at) else np.zeros(n_docs)
        out[:, -1] = np.where(kinds >= 2, POSITIVE, np.where(kinds == 0, NEGATIVE, ABSTAIN))
    return out


def bare_words(words: Words) -> np.ndarray:
    """Word hashes without ASCII punctuation at either end."""
    from cartwheel.llm.blocks import PrefixHash

    punct = np.zeros(256, bool)
    punct[[ord(c) for c in ".,;:!?\"'()[]{}*#$%&|-_"]] = True
    lo, hi = words.start.copy(), words.end.copy()
    for _ in range(3):
        lo += (lo < hi - 1) & punct[words.data[np.minimum(lo, len(words.data) - 1)]]
        hi -= (hi > lo + 1) & punct[words.data[hi - 1]]
    return mix(PrefixHash(words.data).of(lo, hi) + (hi - lo).astype(np.uint64))


# ---------------------------------------------------------------- label model

@dataclass
class LabelModel:
    prior: float
    rates: np.ndarray  # (labellers, class 0/1, vote)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(positive) of each row of votes."""
        if not len(votes):
            return np.zeros(0)
        k = np.arange(self.rates.shape[0])
        log = np.log(self.rates)
        pos = np.log(self.prior) + log[k, 1, votes].sum(axis=1)
        neg = np.log(1 - self.prior) + log[k, 0, votes].sum(axis=1)
        return 1.0 / (1.0 + np.exp(np.clip(neg - pos, -500, 500)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM over vote patterns and how many documents have each.

    ``known`` (patterns, 2): how many labelled documents of either class have the pattern; they keep their class and
    are scaled to the mass of all others.  Without any, EM starts from the votes weighed by their information: a
    vote that a labeller seldom gives counts for more.
    """
    k = votes.shape[1]
    anchored = (known.sum(axis=0) > 0).all()
    known = known * (counts.sum() / max(1.0, known.sum()))
    odds = np.zeros(len(votes))
    for j in range(k):
        share = (np.bincount(votes[:, j], weights=counts, minlength=3) + 0.5) / (counts.sum() + 1.5)
        odds += np.array([0.0, np.log(share[NEGATIVE]), -np.log(share[POSITIVE])])[votes[:, j]]
    post = 1.0 / (1.0 + np.exp(-odds))
    if anchored:
        counts = counts.astype(np.float64)
        post = (known[:, 1] + 0.01) / (known.sum(axis=1) + 0.02)
    else:
        known = np.zeros_like(known)
    model = None
    for _ in range(rounds):
        rates = np.empty((k, 2, 3))
        for c, w in ((1, counts * post + known[:, 1]), (0, counts * (1 - post) + known[:, 0])):
            for j in range(k):
                hist = np.bincount(votes[:, j], weights=w, minlength=3) + 0.5
                rates[j, c] = hist / hist.sum()
        prior = float(np.clip((counts * post + known[:, 1]).sum() / max(1e-9, counts.sum() + known.sum()), 1e-6, 1 - 1e-6))
        model = LabelModel(prior, rates)
        new = model.posterior(votes)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return model


# ---------------------------------------------------------------- scorer

def _rows(b: Block, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words of every document as (document, bucket, value): value log2(1 + count) / sqrt(distinct)."""
    bucket = (bare_words(b.words) >> U(64 - bits)).astype(np.int64)
    key, times = np.unique(b.words.doc * (1 << bits) + bucket, return_counts=True)
    doc = key >> bits
    distinct = np.bincount(doc, minlength=len(b.words.count))
    return doc, key & ((1 << bits) - 1), np.log2(1.0 + times) / np.sqrt(np.maximum(distinct[doc], 1))


@dataclass
class Scorer:
    weights: np.ndarray   # (2 ** bits,) hashed words
    dense: np.ndarray     # (features,) standardised statistics
    centre: np.ndarray
    scale: np.ndarray
    bias: float

    def score(self, b: Block, rows=None) -> np.ndarray:
        doc, bucket, value = rows
        z = np.bincount(doc, weights=self.weights[bucket] * value, minlength=len(b.words.count))
        z += ((b.stats - self.centre) / self.scale) @ self.dense + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def fit_scorer(samples: list[tuple], bits: int, epochs: int = 12, rate: float = 0.3, l2: float = 1e-6, seed: int = 7) -> Scorer | None:
    """Logistic regression on soft labels by AdaGrad mini-batches; samples: (buckets, values, stats, label)."""
    if not samples:
        return None
    stats = np.stack([s[2] for s in samples]).astype(np.float64)
    centre, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    stats = (stats - centre) / scale
    y = np.array([s[3] for s in samples])
    weight = np.where(y > 0.5, 0.5 / max(1e-9, (y > 0.5).mean()), 0.5 / max(1e-9, (y <= 0.5).mean()))
    w, gw = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
    d, gd = np.zeros(stats.shape[1] + 1), np.full(stats.shape[1] + 1, 1e-8)
    dense = np.hstack([stats, np.ones((len(stats), 1))])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for lo in range(0, len(order), 64):
            batch = order[lo:lo + 64]
            bucket = np.concatenate([samples[i][0] for i in batch])
            value = np.concatenate([samples[i][1] for i in batch])
            doc = np.repeat(np.arange(len(batch)), [len(samples[i][0]) for i in batch])
            z = np.bincount(doc, weights=w[bucket] * value, minlength=len(batch)) + dense[batch] @ d
            err = (1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))) - y[batch]) * weight[batch] / len(batch)
            g = np.bincount(bucket, weights=err[doc] * value, minlength=1 << bits)
            used = np.unique(bucket)
            gu = g[used] + l2 * w[used]
            gw[used] += gu * gu
            w[used] -= rate * gu / np.sqrt(gw[used])
            gg = dense[batch].T @ err
            gd += gg * gg
            d -= rate * gg / np.sqrt(gd)
    return Scorer(w, d[:-1], centre, scale, float(d[-1]))


# ---------------------------------------------------------------- Spark

def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, quality, toxic) of about ``rows`` labelled documents drawn by hash."""
    n = labels.count()
    chosen = (labels.where(F.col("doc_id").isNotNull())
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, rows / max(1, n)) * (1 << 20)))
              .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")))
    return (docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "_id").select("text", "quality", "toxic"))  # at most about ``rows`` ids


def learn_lexicon(sample: DataFrame, least: int = 4, purity: float = 0.9) -> np.ndarray:
    """Sorted hashes of words that occur in ``least`` toxic documents of the sample and almost only there."""
    joined = sample.where("toxic is not null").select("text", F.col("toxic").alias("_label"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in text_blocks(batches):
            w = Words(raw, off)
            toxic = batch.column("_label").to_numpy(zero_copy_only=False)[w.doc] > 0
            bare = bare_words(w)
            _, first = np.unique(mix(bare + w.doc.astype(np.uint64) * U(0x9E3779B97F4A7C15)), return_index=True)
            u, where = np.unique(bare[first], return_inverse=True)
            yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(np.bincount(where, weights=toxic[first], minlength=len(u)).astype(np.int64)),
                                   pa.array(np.bincount(where, minlength=len(u)).astype(np.int64))], ["h", "bad", "n"])

    found = (joined.mapInArrow(words, "h bigint, bad bigint, n bigint").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
             .where((F.col("bad") >= least) & (F.col("bad") >= purity * F.col("n"))).select("h").toPandas())
    return np.sort(found["h"].to_numpy(dtype=np.int64).view(np.uint64))


def _code(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def _uncode(code: np.ndarray, k: int) -> np.ndarray:
    return (code[:, None] // 3 ** np.arange(k)) % 3


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS,
             bits: int = HASH_BITS, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, quality_label, quality_score, toxic_label, toxic_score): posterior of the votes, and the scorer."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sample = labelled_sample(rows, labels, labelled_rows)
    lexicon = spark.sparkContext.broadcast(learn_lexicon(sample))

    def both(b: Block) -> tuple[np.ndarray, np.ndarray]:
        return _code(quality_votes(b)), _code(toxic_votes(b, lexicon.value))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(head, code, given class or -1, documents)."""
        total: dict[tuple[int, int, int], int] = {}
        for batch, raw, off in text_blocks(batches):
            b = features(raw, off)
            has = b.words.count > 0
            for head, code in enumerate(both(b)):
                given = np.full(len(code), -1)
                if batch.num_columns > 1:
                    given = batch.column(("quality", "toxic")[head]).fill_null(-1).to_numpy(zero_copy_only=False)
                pairs, times = np.unique((code * 4 + np.clip(given, -1, 1) + 1)[has], return_counts=True)
                for c, n in zip(pairs, times, strict=True):
                    key = (head, int(c) // 4, int(c) % 4 - 1)
                    total[key] = total.get(key, 0) + int(n)
        if total:
            yield pa.record_batch([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int64()),
                                   pa.array([k[2] for k in total], pa.int32()), pa.array(list(total.values()), pa.int64())], ["head", "code", "given", "n"])

    def patterns(frame: DataFrame):
        counted = frame.mapInArrow(count, "head int, code bigint, given int, n bigint")
        return counted.groupBy("head", "code", "given").agg(F.sum("n").alias("n")).toPandas()

    everything, labelled = patterns(rows.select("text")), patterns(sample)
    models, tables, scorers = [], [], []
    for head, k in ((0, 7), (1, _TOXIC_PARTS + 1)):
        own = everything[everything["head"] == head]
        votes = _uncode(own["code"].to_numpy(dtype=np.int64), k)
        given = labelled[labelled["head"] == head]
        known = np.stack([own["code"].map(given[given["given"] == c].set_index("code")["n"]).fillna(0).to_numpy(dtype=np.float64) for c in (0, 1)], axis=1)
        models.append(fit_label_model(votes, own["n"].to_numpy(dtype=np.float64), known) if len(own) else LabelModel(0.5, np.full((k, 2, 3), 1 / 3)))
        post = models[-1].posterior(votes)
        yes = own["n"].to_numpy()[post > 0.5].sum() if len(own) else 0
        no = own["n"].sum() - yes
        # share of either side that is drawn, so that about fit_rows / 2 documents come from each
        tables.append((min(1.0, fit_rows / 2 / max(1, no)), min(1.0, fit_rows / 2 / max(1, yes))))
    shared = spark.sparkContext.broadcast((models, tables))
    widest = max(max(t) for t in tables)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, tables = shared.value
        for batch, raw, off in text_blocks(batches):
            b = features(raw, off)
            u = batch.column("u").to_numpy(zero_copy_only=False)
            posts = [m.posterior(_uncode(c, m.rates.shape[0])) for m, c in zip(models, both(b), strict=True)]
            chosen = [(b.words.count > 0) & (u < np.where(p > 0.5, t[1], t[0])) for p, t in zip(posts, tables, strict=True)]
            doc, bucket, value = _rows(b, bits)
            edge = np.searchsorted(doc, np.arange(len(b.words.count) + 1))
            out = [(int(chosen[0][d]), int(chosen[1][d]), posts[0][d], posts[1][d], bucket[edge[d]:edge[d + 1]].astype(np.int32).tobytes(),
                    value[edge[d]:edge[d + 1]].astype(np.float32).tobytes(), b.stats[d].tobytes()) for d in np.flatnonzero(chosen[0] | chosen[1])]
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()),
                                       *[pa.array(c, pa.binary()) for c in cols[4:]]], ["c0", "c1", "p0", "p1", "b", "v", "s"])

    u = (F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)).alias("u")
    drawn = (rows.select("text", u).where(F.col("u") < widest)
             .mapInArrow(draw, "c0 int, c1 int, p0 double, p1 double, b binary, v binary, s binary").collect())
    for head in (0, 1):
        mine = sorted(((bytes(r["b"]), bytes(r["v"]), bytes(r["s"]), r[f"p{head}"]) for r in drawn if r[f"c{head}"]))
        samples = [(np.frombuffer(x, np.int32), np.frombuffer(v, np.float32), np.frombuffer(s, np.float32), p) for x, v, s, p in mine]
        one_sided = not samples or len({p > 0.5 for *_, p in samples}) < 2
        scorers.append(None if one_sided else fit_scorer(samples, bits))
    fitted = spark.sparkContext.broadcast(scorers)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, _ = shared.value
        for batch, raw, off in text_blocks(batches):
            b = features(raw, off)
            has = b.words.count > 0
            cols = [batch.column("doc_id")]
            hashed = _rows(b, bits)
            for m, s, code in zip(models, fitted.value, both(b), strict=True):
                post = np.where(has, m.posterior(_uncode(code, m.rates.shape[0])), 0.0)
                cols += [pa.array(post), pa.array(np.where(has, s.score(b, hashed), 0.0) if s is not None else post)]
            yield pa.record_batch(cols, ["doc_id", "quality_label", "quality_score", "toxic_label", "toxic_score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, quality_label double, quality_score double, toxic_label double, toxic_score double")
