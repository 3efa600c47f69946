"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in NumPy.

A word (lower-cased, without punctuation at its ends) is the sum of three rows of one hashed embedding table: the word's,
that of its first four bytes and that of its first six, so inflected forms share what they begin with.  Filters of
one, two and three words slide over the whole text (words beyond its end are zero vectors), each filter's largest
activation over the text is kept (max pooling, ReLU), and a logistic output reads the maxima.

Training takes every labelled document whole.  A fifth of them, by hash, does not train but fits the final scale and shift
of the score (Platt) and the thresholds by language, which maximise F1 there.  The others lie in blocks of about ``BLOCK_ROWS``
documents: every epoch each block takes the common network through its documents (AdaGrad), and the networks are
averaged, a table row over the blocks that changed it; one block trains through all epochs.  Platt's sums and the
counts of the thresholds are Spark aggregates.  Every text is scored whole, in pieces of about a megabyte, so memory
does not follow a text's length.

The language chooses the threshold that ``flagged`` uses and nothing else: scores see words only.

Defined results: a null or empty text, or one without words, has the score of no activation; without labels of both
classes every score is the share of toxic labels (0 without labels); a null id is never labelled; several labels of an
id count as one, the largest; an unknown or null language has the threshold of all languages together; repeated rows
are scored each; extra columns are ignored; a word longer than a piece counts as several.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.ranking import prefix_sums
from cartwheel.llm.blocks import _WHITE, U, PrefixHash, Words, flat, give_back, mix, pack, unpack
from cartwheel.session import shared_path

BLOCK_ROWS = 4_000
BLOCK_BYTES = 1 << 25   # of word rows in a block
PIECE_WORDS = 1 << 18
MOST_SENT = 4_000_000   # labels sent to all tasks; more are joined by a shuffle of the texts
SHARDS = 32             # of the table, for averaging
BITS = 18
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PIECE_BYTES = 1 << 20
EPOCHS = 6
BATCH = 32
LEAST_POSITIVE = 10   # toxic documents of a language below which the common threshold stands

_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?\"'()[]{}*#$%&|-_"]] = True


# ---------------------------------------------------------------- words as table rows

def buckets(raw: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(words, 3) table rows of the words of all texts, and the index of each text's first word (texts + 1)."""
    words = Words(raw, off)
    lo, hi = words.start.copy(), words.end.copy()
    for _ in range(3):  # junk comes in threes
        lo += (lo < hi - 1) & _PUNCT[words.data[np.minimum(lo, len(raw) - 1)]]
        hi -= (hi > lo + 1) & _PUNCT[words.data[hi - 1]]
    prefix = PrefixHash(words.data)
    out = np.empty((len(lo), 3), np.int32)
    for k, most in enumerate((1 << 40, 4, 6)):
        end = np.minimum(hi, lo + most)
        out[:, k] = mix(prefix.of(lo, end) + (end - lo).astype(np.uint64) * U(4) + U(k)) >> U(64 - bits)
    return out, words.first


def cuts(raw: np.ndarray, most: int = PIECE_BYTES, overlap: int = max(WIDTHS) - 1) -> list[tuple[int, int, bool]]:
    """(start, end, last) pieces of a text, cut between words; the next piece repeats ``overlap`` words.

    A run of ``most`` bytes without white space is cut within: no piece then repeats any word.
    """
    out, at = [], 0
    while len(raw) - at > most:
        window = raw[at:at + most]
        white = np.flatnonzero(_WHITE[window])
        if len(white) == 0 or white[-1] == 0:
            out.append((at, at + most, True))
            at += most
            continue
        end = int(white[-1])
        solid = ~_WHITE[window[:end]]
        starts = np.flatnonzero(solid & ~np.concatenate(([False], solid[:-1])))
        if len(starts) <= overlap or starts[-overlap] == 0:   # too few words to repeat: a piece of its own
            out.append((at, at + end, True))
            at += end
        else:
            out.append((at, at + end, False))
            at += int(starts[-overlap])
    out.append((at, len(raw), True))
    return out


# ---------------------------------------------------------------- the network

@dataclass
class Net:
    table: np.ndarray                  # (2**bits, DIM)
    filters: list[np.ndarray]          # one (width, DIM, FILTERS) a width
    bias: np.ndarray                   # (widths * FILTERS)
    out: np.ndarray                    # (widths * FILTERS)
    shift: float = 0.0
    scale: float = 1.0                 # of the calibrated score
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    common: float = 0.5

    def activations(self, rows: np.ndarray, first: np.ndarray, last: np.ndarray | None = None) -> list[np.ndarray]:
        """(words, FILTERS) for each width; windows that begin in the repeated end of a piece that is not a text's last are -inf."""
        x = self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]]
        count = np.diff(first)
        left = np.repeat(first[1:], count) - np.arange(len(rows))     # words from here to the text's end
        out = []
        for w in self.filters:
            y = x @ w[0]
            for k in range(1, len(w)):
                inside = left[:-k] > k if len(left) > k else np.zeros(0, bool)
                y[:max(0, len(y) - k)] += np.where(inside[:, None], x[k:] @ w[k], 0)
            if last is not None and not last.all():
                y[(left <= max(WIDTHS) - 1) & ~np.repeat(last, count)] = -np.inf
            out.append(y)
        return out

    def pool(self, rows: np.ndarray, first: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
        """Largest raw activation of every filter over every text; -inf for a text without words."""
        out = np.full((len(first) - 1, len(self.bias)), -np.inf, np.float32)
        some = np.flatnonzero(np.diff(first) > 0)
        if len(some):
            parts = [np.maximum.reduceat(y, first[some], axis=0) for y in self.activations(rows, first, last)]
            out[some] = np.hstack(parts)
        return out

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0).astype(np.float64) @ self.out + self.shift

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.logit(pooled) + self.offset)

    def dump(self) -> bytes:
        flat_filters = np.concatenate([f.ravel() for f in self.filters])
        names = "\n".join(self.thresholds).encode()
        return pack([self.table.ravel().astype(np.float32), flat_filters.astype(np.float32), self.bias, self.out,
                     np.array([self.shift, self.scale, self.offset, self.common, *self.thresholds.values()]), np.frombuffer(names, np.uint8)])

    @staticmethod
    def load(blob: bytes) -> Net:
        table, flat_filters, bias, out, numbers, names = unpack(blob)
        filters, at = [], 0
        for w in WIDTHS:
            size = w * DIM * FILTERS
            filters.append(flat_filters[at:at + size].reshape(w, DIM, FILTERS))
            at += size
        langs = names.tobytes().decode().split("\n") if len(names) else []
        return Net(table.reshape(-1, DIM), filters, bias, out, *map(float, numbers[:3]), dict(zip(langs, map(float, numbers[4:]), strict=True)), float(numbers[3]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def new_net(bits: int = BITS, seed: int = 11) -> Net:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (1 << bits, DIM)).astype(np.float32)
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    n = FILTERS * len(WIDTHS)
    return Net(table, filters, np.zeros(n, np.float32), np.abs(rng.normal(0, 0.3, n)) * np.where(np.arange(n) % 4 == 3, -1, 1))


def strongest(net: Net, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, filters) places and values of the largest raw activations of texts that have words, a bounded number of words at a time."""
    if len(rows) > PIECE_WORDS and len(first) > 2:
        parts = [strongest(net, rows[a:b], np.array([0, b - a])) for a, b in zip(first, first[1:], strict=False)]
        return np.vstack([at + a for (at, _), a in zip(parts, first, strict=False)]), np.vstack([value for _, value in parts])
    if len(rows) > PIECE_WORDS:
        at, value = np.zeros((1, len(net.bias)), np.int64), np.full((1, len(net.bias)), -np.inf, np.float32)
        for lo in range(0, len(rows), PIECE_WORDS):
            part = rows[lo:lo + PIECE_WORDS + max(WIDTHS) - 1]
            y = np.hstack(net.activations(part, np.array([0, len(part)])))[:PIECE_WORDS]
            here = y.argmax(axis=0)
            best = y[here, np.arange(y.shape[1])]
            more = best > value[0]
            at[0, more], value[0, more] = here[more] + lo, best[more]
        return at, value
    acts = np.hstack(net.activations(rows, first))
    at = np.stack([a + acts[a:b].argmax(axis=0) for a, b in zip(first, first[1:], strict=False)])
    return at, np.take_along_axis(acts, at, axis=0)


@dataclass
class State:
    """A network in training with its AdaGrad sums and the table rows that have decided something."""
    net: Net
    g_table: np.ndarray
    g_rest: np.ndarray      # of the filters, bias, out and shift, in that order
    touched: np.ndarray

    @staticmethod
    def new(bits: int = BITS, seed: int = 11) -> State:
        net = new_net(bits, seed)
        size = sum(f.size for f in net.filters) + 2 * len(net.bias) + 1
        return State(net, np.full(len(net.table), 1e-4, np.float32), np.full(size, 1e-4), np.zeros(len(net.table), bool))

    def rest(self) -> np.ndarray:
        return np.concatenate([*[f.ravel() for f in self.net.filters], self.net.bias, self.net.out, [self.net.shift]]).astype(np.float64)

    def set_rest(self, rest: np.ndarray) -> None:
        at = 0
        for f in self.net.filters:
            f[:] = rest[at:at + f.size].reshape(f.shape)
            at += f.size
        n = len(self.net.bias)
        self.net.bias, self.net.out, self.net.shift = rest[at:at + n].astype(np.float32), rest[at + n:at + 2 * n].copy(), float(rest[-1])

    def dump(self) -> bytes:
        return pack([self.net.table.ravel(), self.g_table, self.rest(), self.g_rest, self.touched.astype(np.uint8)])

    @staticmethod
    def load(blob: bytes) -> State:
        table, g_table, rest, g_rest, touched = (a.copy() for a in unpack(blob))
        state = State.new(int(np.log2(len(g_table))))
        state.net.table, state.g_table, state.g_rest, state.touched = table.reshape(-1, DIM), g_table, g_rest, touched.astype(bool)
        state.set_rest(rest)
        return state


def fit_net(docs: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-4, seed: int = 11) -> Net:
    """A network trained on texts given as (words, 3) table rows."""
    state = State.new(bits, seed)
    run_epochs(state, docs, labels, float((labels > 0).mean()), 0, epochs, rate, decay, seed)
    state.net.table[~state.touched] = 0   # words that never decided anything
    return state.net


def run_epochs(state: State, docs: list[np.ndarray], labels: np.ndarray, share: float, first_epoch: int = 0, epochs: int = EPOCHS, rate: float = 0.1,
               decay: float = 1e-4, seed: int = 11) -> None:
    """AdaGrad mini-batches; a filter's gradient goes to the words it was largest at.  ``share``: of label 1 among all training texts."""
    net, g_table, touched = state.net, state.g_table, state.touched
    rng = np.random.default_rng(seed + 1)
    n = len(net.bias)
    ends_at = np.cumsum([f.size for f in net.filters])
    g_filters = [state.g_rest[e - f.size:e].reshape(f.shape).astype(np.float32) for e, f in zip(ends_at, net.filters, strict=True)]
    g_bias, g_out, g_shift = state.g_rest[-2 * n - 1:-n - 1].copy(), state.g_rest[-n - 1:-1].copy(), float(state.g_rest[-1])
    weight = np.where(labels > 0, 0.5 / max(1e-9, share), 0.5 / max(1e-9, 1 - share))
    for epoch in range(first_epoch + epochs):
        order = rng.permutation(len(docs))
        if epoch < first_epoch:
            continue
        for lo in range(0, len(order), BATCH):
            batch = [i for i in order[lo:lo + BATCH] if len(docs[i])]
            if not batch:
                continue
            rows = np.concatenate([docs[i] for i in batch])
            first = np.concatenate(([0], np.cumsum([len(docs[i]) for i in batch])))
            at, value = strongest(net, rows, first)
            hidden = np.maximum(value + net.bias, 0)
            err = (_sigmoid(hidden @ net.out + net.shift) - labels[batch]) * weight[batch] / len(batch)
            back = err[:, None] * net.out * (hidden > 0)              # (docs, n): gradient of each pooled activation
            grad_out = hidden.T @ err + decay * net.out
            ends = np.repeat(first[1:][:, None], n, axis=1)
            touch_rows, touch_grad = [], []
            for j, w in enumerate(net.filters):
                part = slice(j * FILTERS, (j + 1) * FILTERS)
                a, b = at[:, part], back[:, part].astype(np.float32)
                grad_w = np.zeros_like(w)
                for k in range(len(w)):
                    inside = a + k < ends[:, part]
                    pos = np.where(inside, a + k, 0)
                    x = net.table[rows[pos]].sum(axis=2)              # (docs, FILTERS, DIM)
                    bb = b * inside
                    grad_w[k] = np.einsum("df,dfe->ef", bb, x)
                    gx = bb[:, :, None] * w[k].T[None]                # (docs, FILTERS, DIM)
                    used = bb.ravel() != 0
                    touch_rows.append(rows[pos.ravel()[used]])
                    touch_grad.append(gx.reshape(-1, DIM)[used])
                grad_w += decay * w
                g_filters[j] += grad_w * grad_w
                w -= rate * grad_w / np.sqrt(g_filters[j])
            hit = np.concatenate(touch_rows)
            if len(hit):
                grads = np.concatenate(touch_grad)
                for c in range(3):
                    u, where = np.unique(hit[:, c], return_inverse=True)
                    sums = np.zeros((len(u), DIM), np.float32)
                    np.add.at(sums, where, grads)
                    g_table[u] += (sums * sums).mean(axis=1)
                    net.table[u] -= rate * sums / np.sqrt(g_table[u])[:, None]
                    touched[u] = True
            grad_bias = back.sum(axis=0)
            g_bias += grad_bias * grad_bias
            net.bias -= (rate * grad_bias / np.sqrt(g_bias)).astype(np.float32)
            g_out += grad_out * grad_out
            net.out -= rate * grad_out / np.sqrt(g_out)
            grad_shift = err.sum()
            g_shift += grad_shift * grad_shift
            net.shift -= rate * grad_shift / np.sqrt(g_shift)
    state.g_rest = np.concatenate([*[g.ravel() for g in g_filters], g_bias, g_out, [g_shift]]).astype(np.float64)


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Scale (at least 0.01) and offset of the weighted logistic regression of y on z, pulled weakly to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = _sigmoid(a * z + b)
        r = (p - y) * weight
        h = weight * p * (1 - p) + 1e-9
        g = np.array([(r * z).sum() + (a - 1), r.sum() + 1e-3 * b])
        hess = np.array([[(h * z * z).sum() + 1, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        step = step / max(1.0, np.abs(step).max())
        a, b = max(0.01, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The threshold of largest weighted F1, half way between two neighbouring scores; 0.5 without positives."""
    if not (y > 0).any():
        return 0.5
    order = np.argsort(-score, kind="stable")
    s, w, t = score[order], weight[order], y[order] > 0
    hit, flagged = np.cumsum(w * t), np.cumsum(w)
    f1 = 2 * hit / (flagged + (w * t).sum())
    f1[:-1][s[:-1] == s[1:]] = -1          # a threshold lies between different scores
    k = int(f1.argmax())
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)


# ---------------------------------------------------------------- Spark

def _unpacked(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    words, labels, rows = unpack(blob)
    first = np.concatenate(([0], np.cumsum(words)))
    rows = rows.reshape(-1, 3)
    return [rows[a:b] for a, b in zip(first, first[1:], strict=False)], labels


def _blocks(learn: DataFrame, n: int) -> DataFrame:
    """(block, blob): the texts of every block packed in one row, written once."""
    def packed(key: tuple, table: pa.Table) -> pa.Table:
        told = sorted(zip(*[table.column(c).to_pylist() for c in ("key", "rows", "lang", "toxic")], strict=True), key=lambda r: (r[0], r[1], r[2] or "", r[3]))
        blob = pack([np.array([len(r[1]) // 12 for r in told], np.int64), np.array([r[3] for r in told], np.float64), np.frombuffer(b"".join(r[1] for r in told), np.int32)])
        del told
        give_back()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "blob": pa.array([blob], pa.binary())})

    path = shared_path(learn.sparkSession, "toxicity_blocks")
    block = F.pmod(F.xxhash64("key"), F.lit(n)).alias("block")
    learn.select(block, "key", "rows", "lang", "toxic").groupBy("block").applyInArrow(packed, "block long, blob binary").repartition(n, "block").write.parquet(path)
    return learn.sparkSession.read.parquet(path)


def _trained(blocks: DataFrame, n: int, share: float, bits: int) -> Net:
    """One block: all epochs in its task.  Several: an epoch a round, then the mean of the blocks' networks."""
    spark, state = blocks.sparkSession, State.new(bits)
    rounds = [(0, EPOCHS)] if n == 1 else [(k, 1) for k in range(EPOCHS)]
    shards = min(SHARDS, 1 << bits)
    wide = (1 << bits) // shards
    for first_epoch, epochs in rounds:
        start = spark.sparkContext.broadcast(state.dump())   # a fixed number of weights

        def step(batches: Iterator[pa.RecordBatch], start=start, first_epoch=first_epoch, epochs=epochs) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, blob in zip(batch.column("block").to_pylist(), batch.column("blob"), strict=True):
                    mine = State.load(start.value)
                    mine.touched[:] = False
                    docs, labels = _unpacked(blob.as_py())
                    run_epochs(mine, docs, labels, share, first_epoch, epochs)
                    hit = np.flatnonzero(mine.touched)
                    out = [(-1, pack([mine.rest(), mine.g_rest, np.array([len(docs)], np.float64)]))]
                    for k in np.unique(hit // wide).tolist():
                        some = hit[hit // wide == k]
                        out.append((k, pack([some, mine.net.table[some].ravel(), mine.g_table[some]])))
                    yield pa.record_batch([pa.array([k for k, _ in out], pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array([b for _, b in out], pa.binary())],
                                          ["shard", "block", "blob"])
            give_back()

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest, table = None, {}
            for batch in batches:
                for k, blob in zip(batch.column("shard").to_pylist(), batch.column("blob"), strict=True):
                    if k < 0:
                        a, g, (w,) = unpack(blob.as_py())
                        add = np.stack([a * w, g * w, np.full(len(a), w)])
                        rest = add if rest is None else rest + add
                        continue
                    some, values, g = unpack(blob.as_py())
                    sums = table.setdefault(k, np.zeros((wide, DIM + 2)))
                    sums[some - k * wide] += np.column_stack([values.reshape(-1, DIM), g, np.ones(len(some))])
            out = [] if rest is None else [(-1, pack([rest[0] / rest[2], rest[1] / rest[2]]))]
            for k, sums in table.items():
                at = np.flatnonzero(sums[:, -1])
                out.append((k, pack([at + k * wide, (sums[at, :DIM] / sums[at, -1:]).astype(np.float32).ravel(), (sums[at, DIM] / sums[at, -1]).astype(np.float32)])))
            if out:
                yield pa.record_batch([pa.array([k for k, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], ["shard", "blob"])

        parts = blocks.mapInArrow(step, "shard int, block long, blob binary").repartition(shards, "shard").sortWithinPartitions("shard", "block")
        for r in parts.mapInArrow(mean, "shard int, blob binary").collect():   # the network, in shards
            if r["shard"] < 0:
                rest, state.g_rest = (a.copy() for a in unpack(bytes(r["blob"])))
                state.set_rest(rest)
            else:
                at, values, g = unpack(bytes(r["blob"]))
                state.net.table[at], state.g_table[at], state.touched[at] = values.reshape(-1, DIM), g, True
        start.destroy()
    state.net.table[~state.touched] = 0   # words that never decided anything
    return state.net


def _logits(rows: DataFrame, net: Net) -> DataFrame:
    """(lang, toxic, z) of packed texts."""
    blob = rows.sparkSession.sparkContext.broadcast(net.dump())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Net.load(blob.value)
        for batch in batches:
            pooled = np.full((batch.num_rows, len(model.bias)), -np.inf, np.float32)
            for k, words in enumerate(batch.column("rows")):
                if len(text := np.frombuffer(words.as_py(), np.int32).reshape(-1, 3)):
                    pooled[k] = strongest(model, text, np.array([0, len(text)]))[1][0]
            yield pa.record_batch([batch.column("lang"), batch.column("toxic"), pa.array(model.logit(pooled))], ["lang", "toxic", "z"])

    return rows.select("rows", "lang", "toxic").mapInArrow(run, "lang string, toxic int, z double")


def _sure(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))


def platt_of(told: DataFrame, clean: float, toxic: float, rounds: int = 50) -> tuple[float, float]:
    """``platt`` over (toxic, z) rows whose classes weigh ``clean`` and ``toxic`` a row."""
    a, b = 1.0, 0.0
    weight = F.when(F.col("toxic") > 0, toxic).otherwise(clean)
    for _ in range(rounds):
        p, z = _sure(F.lit(a) * F.col("z") + F.lit(b)), F.col("z")
        r, h = (p - F.col("toxic")) * weight, weight * p * (1 - p) + 1e-9
        s = told.agg(F.sum(r * z).alias("rz"), F.sum(r).alias("r"), F.sum(h * z * z).alias("hzz"), F.sum(h * z).alias("hz"), F.sum(h).alias("h")).first()
        step = np.linalg.solve(np.array([[s["hzz"] + 1, s["hz"]], [s["hz"], s["h"] + 1e-3]]), np.array([s["rz"] + (a - 1), s["r"] + 1e-3 * b]))
        step = step / max(1.0, np.abs(step).max())
        a, b = max(0.01, a - float(step[0])), b - float(step[1])
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def thresholds_of(told: DataFrame, clean: float, toxic: float) -> dict[str | None, float]:
    """``best_threshold`` over (lang, toxic, score) rows: of all (None) and of every language with enough positives."""
    kinds = F.array(F.struct(F.lit(True).alias("all"), F.lit("").alias("lang")), F.struct(F.lit(False).alias("all"), F.col("lang").alias("lang")))
    rows = told.select("toxic", "score", F.explode(kinds).alias("k")).select("toxic", "score", "k.all", "k.lang").where(F.col("all") | ((F.col("lang") != "") & ~F.col("lang").contains("\n")))
    group = ["all", "lang"]
    per = rows.groupBy(*group, (-F.col("score")).alias("down")).agg(F.sum(F.col("toxic").cast("long")).alias("pos"), F.sum((1 - F.col("toxic")).cast("long")).alias("neg"))
    pre = prefix_sums(per, [*group, "down"], ["pos", "neg"], settle=True)
    sums = pre.groupBy(*group).agg(F.min("pos_before").alias("p0"), F.min("neg_before").alias("n0"), F.sum("pos").alias("p")).where((F.col("p") > 0) & (F.col("all") | (F.col("p") >= LEAST_POSITIVE)))
    found = pre.join(sums, group)
    hit, wrong = toxic * (F.col("pos_before") - F.col("p0") + F.col("pos")), clean * (F.col("neg_before") - F.col("n0") + F.col("neg"))
    f1 = 2 * hit / (hit + wrong + toxic * F.col("p"))
    best = found.groupBy(*group).agg(F.max_by(F.col("down"), F.struct(f1, -F.col("down"))).alias("at"))
    below = pre.join(best, group).groupBy(*group, "at").agg(F.min(F.when(F.col("down") > F.col("at"), F.col("down"))).alias("next"))
    return {None if r["all"] else r["lang"]: (-r["at"] - (r["next"] or 0.0)) / 2 for r in below.collect()}   # a row a language


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", toxic_col: str = "toxic",
        block_rows: int = BLOCK_ROWS, bits: int = BITS) -> Net:
    """Train on all labelled documents."""
    spark = docs.sparkSession
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(toxic_col).cast("int").alias("toxic")).where("id is not null and toxic is not null")
    told = marks.groupBy("id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in told.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    clean, toxic = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    picked = texts.where("text is not null").join(F.broadcast(told) if clean + toxic <= MOST_SENT else told, "id").select(F.xxhash64("id", "text").alias("key"), "text", "lang", "toxic")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for k in range(batch.num_rows):
                raw, off = flat(batch.column("text").slice(k, 1))
                packed.append(buckets(raw, off, bits)[0].tobytes())
            aside = mix(batch.column("key").to_numpy().view(np.uint64)) % U(5) == U(0)
            yield pa.record_batch([batch.column("key"), pa.array(packed, pa.binary()), batch.column("lang"), batch.column("toxic"), pa.array(aside)],
                                  ["key", "rows", "lang", "toxic", "aside"])

    path = shared_path(spark, "toxicity_rows")
    picked.mapInArrow(words, "key long, rows binary, lang string, toxic int, aside boolean").write.parquet(path)
    rows = spark.read.parquet(path)
    have = {(r["aside"], r["toxic"]): (r["n"], r["size"]) for r in rows.groupBy("aside", "toxic").agg(F.count("*").alias("n"), F.sum(F.octet_length("rows")).alias("size")).collect()}
    if {t for _, t in have} != {0, 1}:
        net = new_net(bits)
        net.table[:], net.out[:] = 0, 0
        share = toxic / max(1e-9, clean + toxic)
        net.scale, net.offset = 1.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return net
    apart = len(have) == 4                # both sides have both classes
    learn, hold = (rows.where("not aside"), rows.where("aside")) if apart else (rows, rows)
    used = [(t, *v) for (aside, t), v in have.items() if not (apart and aside)]
    n, size = sum(u[1] for u in used), sum(u[2] for u in used)
    blocks = max(1, -(-n // block_rows), -(-size // BLOCK_BYTES))
    net = _trained(_blocks(learn, blocks), blocks, sum(u[1] for u in used if u[0]) / n, bits)
    held = {c: sum(v[0] for (aside, t), v in have.items() if t == c and (aside or not apart)) for c in (0, 1)}
    weights = [total / held[c] / (clean + toxic) * (held[0] + held[1]) for c, total in ((0, clean), (1, toxic))]
    at = shared_path(spark, "toxicity_logits")
    _logits(hold, net).write.parquet(at)
    z = spark.read.parquet(at)
    net.scale, net.offset = platt_of(z, *weights)
    found = thresholds_of(z.select("lang", "toxic", _sure(F.lit(net.scale) * F.col("z") + F.lit(net.offset)).alias("score")), *weights)
    net.common = found.pop(None, 0.5)
    net.thresholds = dict(sorted(found.items()))
    return net


def score(docs: DataFrame, net: Net, text_col: str = "text", lang_col: str | None = "lang", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with score, threshold (of the document's language) and flagged of every document."""
    keep = docs.columns if keep is None else keep
    names = [f"k{i}" for i in range(len(keep))]
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    blob = docs.sparkSession.sparkContext.broadcast(net.dump())   # a fixed number of weights
    bits = int(np.log2(len(net.table)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Net.load(blob.value)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            raw, off = flat(batch.column("text"))
            best = np.full((batch.num_rows, len(model.bias)), -np.inf, np.float32)
            held: list[tuple[int, int, int, bool]] = []
            size = 0
            for d in range(batch.num_rows):
                text = raw[off[d]:off[d + 1]]
                for a, b, last in cuts(text) if len(text) > PIECE_BYTES else [(0, len(text), True)]:
                    if held and size + b - a > PIECE_BYTES:
                        _pool_into(model, raw, held, best, bits)
                        held, size = [], 0
                    held.append((d, int(off[d]) + a, int(off[d]) + b, last))
                    size += b - a
            if held:
                _pool_into(model, raw, held, best, bits)
            threshold = [model.thresholds.get(v, model.common) for v in batch.column("lang").to_pylist()]
            s = model.score(best)
            yield pa.record_batch([*[batch.column(n) for n in names], pa.array(s), pa.array(threshold, pa.float64()), pa.array(s >= np.array(threshold))],
                                  [*names, "score", "threshold", "flagged"])
        give_back()

    types = [f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)]
    found = rows.mapInArrow(run, ", ".join([*types, "score double, threshold double, flagged boolean"]))
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "score", "threshold", "flagged")


def _pool_into(model: Net, raw: np.ndarray, held: list[tuple[int, int, int, bool]], best: np.ndarray, bits: int) -> None:
    """Raise the documents' maxima ``best`` by those of the pieces (document, start, end, last)."""
    data = np.concatenate([raw[a:b] for _, a, b, _ in held])
    off = np.concatenate(([0], np.cumsum([b - a for _, a, b, _ in held])))
    rows, first = buckets(data, off, bits)
    pooled = model.pool(rows, first, np.array([h[3] for h in held]))
    np.maximum.at(best, np.array([h[0] for h in held]), pooled)
