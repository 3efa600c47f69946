"""LM scoring with an Elias-Fano n-gram trie.

Model: bigrams over the words of a text and its end, with a Dirichlet prior on smoothed unigrams,

    p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),     p(w | u) = (c(u, w) + mu p(w)) / (c(u) + mu),

which is a distribution over the vocabulary and one unknown word, and whose logarithm splits into a term that the owner
of w can compute and one that the owner of u can.  So one exchange serves training and scoring: every occurrence
(context u, word w, document) travels to the task that owns w.  That task counts, builds its part of the trie
and looks up each pair that occurs:

* level 1: the words, their smoothed unigram value (quantised) and an Elias-Fano pointer to their contexts;
* level 2: contexts as an Elias-Fano sequence, made monotone by the word's position, with a quantised value each;
* both levels are one memory-mapped file; a lookup is a successor search within the word's range.

Quantisation: ``LEVELS`` values per level, means of narrow cells of log10 values.  Per-document sums of all tasks
meet by document in a second exchange.  On the way a document is the flush that sent it and its place there; what names it
travels once, in the flush's directory.

Skew: words above a task's fair share are split by context, with their count broadcast; pairs above it are
split by document too, each part getting all counts of the pair.  Both lists have at most ``HOT_LIST`` entries
by their thresholds.

Defined results: a null or empty text is the end token alone; repeated rows are scored each; a null id counts as empty text in
the fold and keeps its row; without training text every count is 0; extra columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import U, Words, as_int64, give_back, mix, pack, text_blocks, unpack

MU = 50.0
LEVELS = 4096
FLUSH = 1_000_000       # tokens a task holds before it sends them
BUCKET = 2_400_000      # tokens a receiving task gets, about
HOT_LEAST = 200_000
CONTEXT_BITS = 40       # contexts of a word are told apart by so many bits of their hash
FIXED = float(1 << 24)  # partial sums travel in fixed point, so their order does not matter
SUMS_A_TASK = 1_000_000
HOT_LIST = 1 << 16
END = U(0x2545F4914F6CDD1D)
BEGIN = U(0x9E6C63D0876A9A4B)


# ---------------------------------------------------------------- Elias-Fano

class EliasFano:
    """A monotone sequence: low bits packed, high bits as gaps in a bit vector; arrays may be memory-mapped."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, rank: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.rank = n, low_bits, low, high, rank

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * low_bits + 63) // 64 + 1, np.uint64)
        if low_bits and n:
            at = np.arange(n, dtype=np.int64) * low_bits
            part = values & U((1 << low_bits) - 1)
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = np.flatnonzero((at & 63) + low_bits > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U(64) - shift[over]))
        place = (values >> U(low_bits)).astype(np.int64) + np.arange(n)
        size = (int(place[-1]) if n else 0) // 64 + 1
        bits = np.zeros(size * 64, np.uint8)
        bits[place] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        rank = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64))).astype(np.uint32)
        return cls(n, low_bits, low, high, rank)

    def get(self, i: np.ndarray) -> np.ndarray:
        """values[i]."""
        word = np.searchsorted(self.rank, i, "right") - 1
        rest = (i - self.rank[word]).astype(np.uint64)  # which set bit of the word
        x = np.asarray(self.high[word])
        bit = np.zeros(len(i), np.uint64)
        for step in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count((x >> bit) & U((1 << step) - 1)).astype(np.uint64)
            go = ones <= rest
            rest -= np.where(go, ones, U(0))
            bit += np.where(go, U(step), U(0))
        value = (word.astype(np.uint64) * U(64) + bit - i.astype(np.uint64)) << U(self.low_bits)
        if self.low_bits:
            at = i.astype(np.int64) * self.low_bits
            w, s = at >> 6, (at & 63).astype(np.uint64)
            part = self.low[w] >> s
            part |= np.where(s > 0, self.low[w + 1] << ((U(64) - s) & U(63)), U(0))
            value |= part & U((1 << self.low_bits) - 1)
        return value


def quantise(values: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """(codes, codebook): cells are the cuts of equal widths and of equal fullness together, each standing for its mean."""
    u, inverse, times = np.unique(values, return_inverse=True, return_counts=True)
    kind = np.uint8 if levels <= 256 else np.uint16
    if len(u) <= levels:
        return inverse.astype(kind), u if len(u) else np.zeros(1)
    half = levels // 2
    wide = np.minimum((u - u[0]) / (u[-1] - u[0]) * half, half - 1).astype(np.int64)
    full = np.minimum((np.cumsum(times) - times / 2) * half // times.sum(), half - 1).astype(np.int64)
    _, cell = np.unique(wide * half + full, return_inverse=True)  # both grow with u: fewer than ``levels`` cells
    book = np.bincount(cell, weights=u * times) / np.bincount(cell, weights=times)
    return cell[inverse].astype(kind), book


class Trie:
    """Two levels in one memory-mapped file.

    ``words`` sorted; ``contexts`` of word k are numbers below ``n_contexts``, sorted; see the module's text.
    """

    def __init__(self, folder: str, unigram: np.ndarray, pointer: np.ndarray, context: np.ndarray, value: np.ndarray, n_contexts: int):
        codes1, self.book1 = quantise(unigram)
        codes2, self.book2 = quantise(value)
        owner = np.repeat(np.arange(len(unigram)), np.diff(pointer))
        self.n_contexts = n_contexts
        first, second = EliasFano.encode(pointer), EliasFano.encode(owner * n_contexts + context)
        arrays = [codes1, codes2, first.low, first.high, first.rank, second.low, second.high, second.rank]
        path = os.path.join(folder, "trie")
        with open(path, "wb") as f:
            for a in arrays:
                f.write(a.tobytes())
                f.write(b"\0" * (-a.nbytes % 8))
        mapped = np.memmap(path, np.uint8, "r")
        out, at = [], 0
        for a in arrays:
            out.append(mapped[at:at + a.nbytes].view(a.dtype))
            at += a.nbytes + (-a.nbytes % 8)
        self.code1, self.code2 = out[:2]
        self.pointer = EliasFano(first.n, first.low_bits, *out[2:5])
        self.context = EliasFano(second.n, second.low_bits, *out[5:8])

    def unigram(self, word: np.ndarray) -> np.ndarray:
        return self.book1[self.code1[word]]

    def lookup(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value) of pairs, by successor search in the word's own range."""
        low = self.pointer.get(word).astype(np.int64)
        end = self.pointer.get(word + 1).astype(np.int64)
        target = (word * self.n_contexts + context).astype(np.uint64)
        high = end.copy()
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            mid = (low[live] + high[live]) // 2
            before = self.context.get(mid) < target[live]
            low[live] = np.where(before, mid + 1, low[live])
            high[live] = np.where(before, high[live], mid)
        found = np.zeros(len(word), bool)
        inside = np.flatnonzero(low < end)
        found[inside] = self.context.get(low[inside]) == target[inside]
        value = np.zeros(len(word))
        value[found] = self.book2[self.code2[low[found]]]
        return found, value


# ---------------------------------------------------------------- tokens

def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, document) of every token, ends included."""
    n_docs = len(words.count)
    size = words.count + 1
    off = np.concatenate(([0], np.cumsum(size)))
    word = np.empty(off[-1], np.uint64)
    word[off[1:] - 1] = END
    inner = np.ones(off[-1], bool)
    inner[off[1:] - 1] = False
    word[inner] = words.hash
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[off[:-1]] = BEGIN
    return word, context, np.repeat(np.arange(n_docs), size)


def pair_hash(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(word * U(0x9E3779B97F4A7C15) + mix(context + U(3)))


def short(context: np.ndarray) -> np.ndarray:
    return mix(context) >> U(64 - CONTEXT_BITS)


def _planes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).ravel()


def _unplanes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(8, -1).T).reshape(-1).view(np.uint64)


def _sorted_planes(x: np.ndarray) -> np.ndarray:
    return _planes(np.diff(x, prepend=U(0)))


def _unsorted_planes(x: np.ndarray) -> np.ndarray:
    return np.cumsum(_unplanes(x), dtype=np.uint64)


def _edges(h: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(h >> U(32), (np.arange(n + 1, dtype=np.float64) / n * (1 << 32)).astype(np.uint64))


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return np.minimum(((h >> U(32)).astype(np.float64) / (1 << 32) * n).astype(np.int64), n - 1)


# ---------------------------------------------------------------- counts of words

def word_counts(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Rows (kind, bucket, payload): per bucket of words their sorted hashes and training counts; frequent pairs."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            word, context = (np.concatenate([h[k] for h in held]) for k in range(2))
            u, times = np.unique(word, return_counts=True)
            edge = _edges(u, n_buckets)
            rows = [(0, b, pack([_sorted_planes(u[edge[b]:edge[b + 1]]), times[edge[b]:edge[b + 1]].astype(np.uint32)])) for b in range(n_buckets) if edge[b + 1] > edge[b]]
            # pairs that may be frequent: both words are frequent here
            limit = max(8, len(word) // (2 * HOT_LIST))
            often = u[times >= limit]
            pos = np.minimum(np.searchsorted(often, word), max(0, len(often) - 1))
            both = often[pos] == word if len(often) else np.zeros(len(word), bool)
            p, t = np.unique(pair_hash(word[both], context[both]), return_counts=True)
            p, t = p[t >= limit], t[t >= limit]
            edge = _edges(p, n_buckets)
            rows += [(1, b, pack([_sorted_planes(p[edge[b]:edge[b + 1]]), t[edge[b]:edge[b + 1]].astype(np.uint32)])) for b in range(n_buckets) if edge[b + 1] > edge[b]]
            cols = list(zip(*rows, strict=True))
            yield pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["kind", "bucket", "payload"])

        for batch, raw, off in text_blocks(batches):
            word, context, _ = tokens(Words(raw, off))
            held.append((word, context))
            count += len(word)
            if count >= FLUSH:
                yield from flush()
                held, count = [], 0
        if count:
            yield from flush()
        held.clear()
        give_back()

    return docs.where("not held").select("text").mapInArrow(send, "kind int, bucket bigint, payload binary")


def _summed(payloads) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(p) for p in payloads]
    h = np.concatenate([_unsorted_planes(p[0]) for p in parts])
    n = np.concatenate([p[1] for p in parts]).astype(np.float64)
    u, inverse = np.unique(h, return_inverse=True)
    return u, np.bincount(inverse, weights=n).astype(np.int64)


def statistics(counts: DataFrame, least: int) -> DataFrame:
    """One row per bucket: kind, distinct, total, and the hashes and counts that may be frequent."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        u, n = _summed(group["payload"])
        top = n >= least // (1 if key[0] == 0 else 2)
        return pd.DataFrame({"kind": [key[0]], "distinct": [len(u)], "total": [int(n.sum())], "top": [pack([u[top], n[top]])]})

    return counts.groupBy("kind", "bucket").applyInPandas(run, "kind int, distinct bigint, total bigint, top binary")


# ---------------------------------------------------------------- scoring

SUMS = "part bigint, kind int, payload binary"
SUM, DIRECTORY = 0, 1
TOTALS = "doc_id bigint, held boolean, n bigint, known bigint, base double, score double"
FLUSH_BITS = 24         # a task's flushes are numbered below this


def _signed(x: np.ndarray) -> np.ndarray:
    """Small numbers of either sign as small unsigned ones."""
    x = x.astype(np.int64)
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def _unsigned(x: np.ndarray) -> np.ndarray:
    return (x >> U(1)).view(np.int64) ^ -(x & U(1)).view(np.int64)


def flush_number(task: int, k: int) -> int:
    """Names the ``k``-th flush of a scanning task; a document is the flush that sent it and its place there."""
    return (task << FLUSH_BITS) + k


def part_of(flush: np.ndarray, n_parts: int) -> np.ndarray:
    return (mix(flush.astype(np.uint64) + U(0x5BD1E995)) % U(n_parts)).astype(np.int64)


def pack_sums(flush: np.ndarray, place: np.ndarray, numbers: list[np.ndarray], n_parts: int) -> pd.DataFrame:
    """Per-document integers of one task as one row per part of the documents."""
    part = part_of(flush, n_parts)
    order = np.lexsort((place, flush, part))
    edge = np.searchsorted(part[order], np.arange(n_parts + 1))
    rows = []
    for k in range(n_parts):
        own = order[edge[k]:edge[k + 1]]
        if len(own):
            used, count = np.unique(flush[own], return_counts=True)
            rows.append((k, pack([used, count, _planes(_signed(np.diff(place[own], prepend=0))), *[_planes(_signed(x[own])) for x in numbers]])))
    return pd.DataFrame({"part": pd.Series([r[0] for r in rows], dtype="int64"), "kind": pd.Series([SUM] * len(rows), dtype="int32"), "payload": [r[1] for r in rows]})


def add_sums(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The totals of a part's documents, one row each: their directories name them, every task's sums are added by place."""
    directory = sorted((unpack(b) for b in group["payload"][group["kind"] == DIRECTORY]), key=lambda p: int(p[0][0]))
    flushes = np.array([int(p[0][0]) for p in directory], np.int64)
    size = np.array([len(p[1]) for p in directory], np.int64)
    start = np.concatenate(([0], np.cumsum(size)))
    total = [np.zeros(start[-1], np.int64) for _ in range(4)]
    for blob in group["payload"][group["kind"] == SUM]:
        p = unpack(blob)
        at = np.repeat(start[np.searchsorted(flushes, p[0])], p[1]) + np.cumsum(_unsigned(_unplanes(p[2])))
        for sums, planes in zip(total, p[3:], strict=True):
            sums[at] += _unsigned(_unplanes(planes))   # a task has one row a document
    doc_id, held = (np.concatenate([p[k] for p in directory]) if directory else np.zeros(0, np.int64) for k in (1, 2))
    give_back()
    return pd.DataFrame({"doc_id": doc_id, "held": held.astype(bool), "n": total[0], "known": total[1], "base": total[2] / FIXED, "score": total[3] / FIXED})


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", mu: float = MU, hot_least: int = HOT_LEAST) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); rows with ``held_out`` do not train."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), F.coalesce(held_out, F.lit(False)).alias("held"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n"), F.sum((~F.col("held")).cast("bigint")).alias("t")).first()
    if not size["n"]:
        return spark.createDataFrame([], "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    n_tokens = size["b"] // 6 + size["n"]
    n_buckets = max(1, -(-n_tokens // BUCKET))
    n_parts = max(1, -(-min(n_tokens, size["n"] * n_buckets) // SUMS_A_TASK))
    stats = statistics(word_counts(rows, n_buckets), hot_least).toPandas() if size["t"] else pd.DataFrame({"kind": [], "distinct": [], "total": [], "top": []})
    own = stats[stats["kind"] == 0]
    n_train, vocabulary = int(own["total"].sum()), int(own["distinct"].sum())
    limit = max(hot_least, n_train // HOT_LIST)  # so a list has at most HOT_LIST entries (pairs: twice)

    def hot(kind: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [unpack(bytes(p)) for p in stats[stats["kind"] == kind]["top"]]
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(h)
        order = order[n[order] >= least]
        return h[order], n[order]

    shared = spark.sparkContext.broadcast((hot(0, limit), hot(1, limit // 2)))
    denominator = n_train + 0.1 * (vocabulary + 1)
    prior = mu / denominator

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (hot_words, _), (hot_pairs, hot_pair_n) = shared.value
        held, docs_held, count, n_docs, flushes = [], [], 0, 0, 0
        task = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            word, context, doc = (np.concatenate([h[k] for h in held]) for k in range(3))
            doc_id, mark, out = (np.concatenate([d[k] for d in docs_held]) for k in range(3))
            vocab, around = np.unique(word), np.unique(short(context))
            w, u = np.searchsorted(vocab, word), np.searchsorted(around, short(context))
            bucket = _bucket(mix(vocab), n_buckets)[w]
            number = np.array([flush_number(task, flushes)], np.int64)
            # the directory of the flush goes straight to the part that adds its documents' sums
            rows = [(n_buckets + int(part_of(number, n_parts)[0]), pack([number, doc_id, out]), False)]
            pair = None
            if len(hot_words):
                pos = np.minimum(np.searchsorted(hot_words, vocab), len(hot_words) - 1)
                split = (hot_words[pos] == vocab)[w]
                at = np.flatnonzero(split)
                pair = pair_hash(word[at], context[at])
                bucket[at] = _bucket(pair, n_buckets)
                if len(hot_pairs):
                    p = np.minimum(np.searchsorted(hot_pairs, pair), len(hot_pairs) - 1)
                    often = hot_pairs[p] == pair
                    at, pair, p = at[often], pair[often], p[often]
                    parts = np.maximum(1, -(-hot_pair_n[p] // limit)) + 1
                    salt = (mark[doc[at]].astype(np.uint64) % parts.astype(np.uint64)).astype(np.int64)
                    bucket[at] = (bucket[at] + salt) % n_buckets
                    # every part gets this task's whole training count of the pair
                    k, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
                    train = np.bincount(inverse, weights=~out[doc[at]])
                    for i, f in enumerate(first):
                        home = int(_bucket(pair[f:f + 1], n_buckets)[0])
                        for b in {(home + s) % n_buckets for s in range(int(parts[f]))}:
                            here = int((~out[doc[at[(inverse == i) & (bucket[at] == b)]]]).sum())
                            if train[i] > here:
                                rows.append((b, pack([np.array([word[at[f]]]), short(np.array([context[at[f]]])), np.array([train[i] - here])]), True))
            order = np.argsort((bucket.astype(np.uint64) * U(len(vocab)) + w.astype(np.uint64)) * U(len(around)) + u.astype(np.uint64), kind="stable")
            bucket, w, u, doc = bucket[order], w[order], u[order], doc[order]
            edge = np.searchsorted(bucket, np.arange(n_buckets + 1))
            for b in range(n_buckets):
                lo, hi = edge[b], edge[b + 1]
                if hi > lo:
                    uw, times = np.unique(w[lo:hi], return_counts=True)
                    uu, iu = np.unique(u[lo:hi], return_inverse=True)
                    blob = pack([_sorted_planes(vocab[uw]), _planes(times), _sorted_planes(around[uu]), _planes(iu), _planes(2 * doc[lo:hi] + out[doc[lo:hi]]), number])
                    rows.append((b, blob, False))
            for lo in range(0, len(rows), 8):
                cols = list(zip(*rows[lo:lo + 8], strict=True))
                yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.bool_())], ["bucket", "payload", "counts"])

        for batch, raw, off in text_blocks(batches):
            word, context, doc = tokens(Words(raw, off))
            held.append((word, context, doc + n_docs))
            docs_held.append((as_int64(batch.column("doc_id")), as_int64(batch.column("mark")), batch.column("held").to_numpy(zero_copy_only=False).astype(bool)))
            n_docs += len(off) - 1
            count += len(word)
            if count >= FLUSH:
                yield from flush()
                held, docs_held, count, n_docs, flushes = [], [], 0, 0, flushes + 1
                give_back()
        if count:
            yield from flush()
        held.clear()
        give_back()

    def owned(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= n_buckets:
            return pd.DataFrame({"part": group["bucket"] - n_buckets, "kind": np.full(len(group), DIRECTORY, np.int32), "payload": group["payload"]})
        (hot_words, hot_n), _ = shared.value
        ws, us, ds, keys, shift = [], [], [], [], 0
        for blob in group["payload"][~group["counts"]]:
            p = unpack(blob)
            ws.append((_unsorted_planes(p[0]), _unplanes(p[1]).astype(np.int64)))
            us.append((_unsorted_planes(p[2]), _unplanes(p[3]).astype(np.int32)))
            place, at = np.unique(_unplanes(p[4]), return_inverse=True)
            ds.append(at.astype(np.int32) + shift)
            keys.append((np.full(len(place), p[5][0], np.int64), (place >> U(1)).astype(np.int64), (place & U(1)).astype(bool)))
            shift += len(place)
        extra = [unpack(b) for b in group["payload"][group["counts"]]]
        if not ws:
            return pd.DataFrame({"part": pd.Series(dtype="int64"), "kind": pd.Series(dtype="int32"), "payload": []})
        words = np.unique(np.concatenate([x[0] for x in ws] + [e[0] for e in extra]))
        contexts = np.unique(np.concatenate([x[0] for x in us] + [e[1] for e in extra]))
        n_ctx = len(contexts)
        code = np.concatenate([np.repeat(np.searchsorted(words, x[0]), x[1]) * n_ctx + np.searchsorted(contexts, y[0])[y[1]] for x, y in zip(ws, us, strict=True)])
        del ws, us
        doc = np.concatenate(ds)
        flush, place, out = (np.concatenate(c) for c in zip(*keys, strict=True))
        order = np.argsort(code, kind="stable")
        code, doc = code[order], doc[order]
        begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        pair = code[begin]
        train = (~out)[doc]
        n_pair = np.add.reduceat(train.astype(np.int64), begin)
        for e in extra:  # counts of split pairs from the other parts
            k = np.searchsorted(pair, np.searchsorted(words, e[0][0]) * n_ctx + np.searchsorted(contexts, e[1][0]))
            if k < len(pair) and pair[k] == np.searchsorted(words, e[0][0]) * n_ctx + np.searchsorted(contexts, e[1][0]):
                n_pair[k] += int(e[2][0])
        w_of, u_of = pair // n_ctx, pair % n_ctx
        n_word = np.bincount(w_of, weights=n_pair, minlength=len(words)).astype(np.int64)
        if len(hot_words):  # split words: the count of all parts
            pos = np.minimum(np.searchsorted(hot_words, words), len(hot_words) - 1)
            n_word = np.where(hot_words[pos] == words, hot_n[pos], n_word)
        seen = n_pair > 0
        pointer = np.searchsorted(w_of[seen], np.arange(len(words) + 1))
        backoff = np.log10(prior * (n_word + 0.1))
        value = np.log10(n_pair[seen] + prior * (n_word[w_of[seen]] + 0.1))
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(folder, backoff, pointer, u_of[seen], value, n_ctx)
            term = np.empty(len(pair))
            for lo in range(0, len(pair), 500_000):
                found, got = trie.lookup(w_of[lo:lo + 500_000], u_of[lo:lo + 500_000])
                term[lo:lo + 500_000] = np.where(found, got, trie.unigram(w_of[lo:lo + 500_000]))
            del trie
        # what a pair adds per occurrence: its numerator, and the denominator of w as the next word's context
        is_end = (words == END)[w_of]
        term -= np.where(is_end, 0.0, np.log10(n_word[w_of] + mu))
        base = np.log10(n_word[w_of] + 0.1)
        times = np.diff(np.append(begin, len(code)))
        n_docs = len(flush)
        del code, train, n_pair
        add = lambda x: np.bincount(doc, weights=np.repeat(x, times), minlength=n_docs)
        fixed = lambda x: np.rint(add(x) * FIXED).astype(np.int64)
        sums = pack_sums(flush, place, [np.bincount(doc, minlength=n_docs), add(n_word[w_of] > 0).astype(np.int64), fixed(base), fixed(term)], n_parts)
        give_back()
        return sums

    partial = rows.mapInArrow(send, "bucket bigint, payload binary, counts boolean").groupBy("bucket").applyInPandas(owned, SUMS)
    total = partial.groupBy("part").applyInPandas(add_sums, TOTALS)
    first = np.log10(size["t"] + mu)  # the context of every first token
    missing = F.lit(int(np.iinfo(np.int64).min))
    return total.select(F.when(F.col("doc_id") != missing, F.col("doc_id")).alias("doc_id"), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"),
                        F.col("known").alias("n_known"), F.lit(n_train).cast("bigint").alias("train_tokens"),
                        (F.col("base") - F.col("n") * float(np.log10(denominator))).alias("base_score"), (F.col("score") - float(first)).alias("score"))
