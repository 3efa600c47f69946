"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks, exact verification.

A benchmark item of m words is compared with every window of m words that holds at least one of the benchmark's
5-word shingles (any other window has similarity 0 with every item).  Both sides get a 64-bit SimHash over their
weighted shingles (weight: letters of the five words).  The index cuts fingerprints into ``BLOCKS`` blocks; within radius r one
block differs in at most r // BLOCKS bits, so listing every block value within that distance of an item's finds
*all* fingerprints within r.  Candidates within r are verified by exact weighted Jaccard over shingle multisets,
which must reach ``threshold``.

The benchmark is broadcast in slices of at most ``slice_items`` items; a larger benchmark takes several passes.

Defined results: null or empty texts and items match nothing; an item of fewer than five words counts as one shingle of all its words;
a document shorter than the item is one window; repeated items are reported each; on ties the earliest window of
a (document, item) wins; an empty benchmark or table gives no rows; rows with a null doc_id are examined too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import U, Words, flat, give_back, mix, ranges, text_blocks

BLOCKS, BLOCK_BITS = 4, 16
RADIUS = 19
THRESHOLD = 0.75
SLICE_ITEMS = 5_000
SCAN_BYTES = 1 << 18   # of text at a time: a byte of it takes some hundred while its windows are compared
_PROBE_BITS = 22


def _rolled(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-word shingle hash and letter weight at every word position (meaningless where they would cross a document)."""
    size = len(words.hash)
    h = np.zeros(size, np.uint64)
    weight = np.zeros(size, np.int64)
    m = size - n + 1
    if m > 0:
        salts = mix(np.arange(101, 101 + n, dtype=np.uint64)) | U(1)
        length = (words.end - words.start).astype(np.int64)
        for k in range(n):
            h[:m] += words.hash[k:k + m] * salts[k]
            weight[:m] += length[k:k + m]
    return mix(h), weight


def _bit_votes(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(n, 64): +weight where the hash has the bit, else -weight."""
    bits = np.unpackbits(mix(h ^ U(0x5851F42D4C957F2D)).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    return (2 * bits - 1) * weight.astype(np.int32)[:, None]


def _fingerprint(votes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.packbits(votes > 0, axis=1)).view(np.uint64).ravel()


def _near_values(value: int, distance: int) -> list[int]:
    return [value ^ sum(1 << b for b in flips) for d in range(distance + 1) for flips in combinations(range(BLOCK_BITS), d)]


class Index:
    """Items of one slice: per (shingle length, window size) a multi-index over fingerprints."""

    def __init__(self, item_ids: list[int], texts: list[str], radius: int):
        raw, off = flat(pa.array(texts, pa.string()))
        words = Words(raw, off)
        self.ids = np.array(item_ids, np.int64)
        self.radius = radius
        masks = [np.array([x], np.uint16) for x in _near_values(0, radius // BLOCKS)]
        flips = np.concatenate(masks)
        self.groups: dict[int, dict[int, tuple]] = {}
        keys, counts, weights, owner, total = [], [], [], [], np.zeros(len(texts))
        rolled = {n: _rolled(words, n) for n in sorted({min(5, int(c)) for c in words.count if c})}
        prints: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.shingles: dict[int, np.ndarray] = {}
        per_length: dict[int, list[np.ndarray]] = {}
        for i, c in enumerate(words.count):
            if not c:
                continue
            n = min(5, int(c))
            at = words.first[i] + np.arange(c - n + 1)
            h, w = rolled[n][0][at], rolled[n][1][at]
            prints.setdefault((n, int(c)), []).append((i, int(_fingerprint(_bit_votes(h, w).sum(axis=0, keepdims=True))[0])))
            u, first, k = np.unique(h, return_index=True, return_counts=True)
            keys.append(self.key(u, np.full(len(u), i)))
            counts.append(k)
            weights.append(w[first])
            owner.append(np.full(len(u), i))
            total[i] = w.sum()
            per_length.setdefault(n, []).append(u)
        self.total = total
        if keys:
            order = np.argsort(np.concatenate(keys))
            self.keys, self.counts = np.concatenate(keys)[order], np.concatenate(counts)[order]
            self.weights = np.concatenate(weights)[order]
        for n, parts in per_length.items():
            u = np.unique(np.concatenate(parts))
            probe = np.zeros(1 << _PROBE_BITS, bool)
            probe[(u & U((1 << _PROBE_BITS) - 1)).astype(np.int64)] = True
            self.shingles[n] = (u, probe)
        for (n, size), found in prints.items():
            items = np.array([i for i, _ in found])
            fp = np.array([p for _, p in found], np.uint64)
            tables = []
            for b in range(BLOCKS):
                value = ((fp >> U(b * BLOCK_BITS)) & U(0xFFFF)).astype(np.uint16)
                near = (value[:, None] ^ flips[None, :]).ravel()
                who = np.repeat(np.arange(len(items)), len(flips))
                order = np.argsort(near, kind="stable")
                off = np.concatenate(([0], np.cumsum(np.bincount(near, minlength=1 << BLOCK_BITS))))
                tables.append((off.astype(np.int32), who[order].astype(np.int32)))   # a slice of items has few entries
            self.groups.setdefault(n, {})[size] = (items, fp, tables)

    @staticmethod
    def key(h: np.ndarray, item: np.ndarray) -> np.ndarray:
        return mix(h + (item.astype(np.uint64) + U(1)) * U(0x9E3779B97F4A7C15))

    def hits(self, n: int, h: np.ndarray) -> np.ndarray:
        u, probe = self.shingles[n]
        at = np.flatnonzero(probe[(h & U((1 << _PROBE_BITS) - 1)).astype(np.int64)])
        pos = np.minimum(np.searchsorted(u, h[at]), len(u) - 1)
        return at[u[pos] == h[at]]

    def near(self, n: int, size: int, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, distance) with fingerprints within the radius."""
        items, own, tables = self.groups[n][size]
        pairs = []
        for b, (off, who) in enumerate(tables):
            value = ((fp >> U(b * BLOCK_BITS)) & U(0xFFFF)).astype(np.int64)
            first = off[value].astype(np.int64)
            length = off[value + 1] - first
            pairs.append(np.repeat(np.arange(len(fp)), length) * len(items) + who[ranges(first, length)])
        pair = np.unique(np.concatenate(pairs))
        window, k = pair // len(items), pair % len(items)
        distance = np.bitwise_count(fp[window] ^ own[k])
        ok = distance <= self.radius
        return window[ok], items[k[ok]], distance[ok]


def find(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text", slice_items: int = SLICE_ITEMS) -> DataFrame:
    """(doc_id, item_id, similarity, hamming, start_word, n_words): the best window of each contaminated pair."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, similarity double, hamming int, start_word bigint, n_words bigint"
    found = None
    for shared in _slices(docs.sparkSession, benchmark, slice_items):
        one = rows.mapInArrow(_matcher(shared, radius, threshold), schema)
        found = one if found is None else found.unionByName(one)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD, text_col: str = "text",
          slice_items: int = SLICE_ITEMS) -> DataFrame:
    """``docs`` without the contaminated rows: a filter, no join."""
    for shared in _slices(docs.sparkSession, benchmark, slice_items):
        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value, radius)
            for batch, raw, off in text_blocks(batches, text_col, SCAN_BYTES):
                words = Words(raw, off)
                sound = np.ones(batch.num_rows, bool)
                for n in index.groups:
                    for doc, *_ in _scan(index, n, words, threshold):
                        sound[doc] = False
                yield batch.filter(pa.array(sound))
                give_back()

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def _slices(spark, benchmark: DataFrame, slice_items: int) -> list:
    """The items, broadcast in slices of at most about ``slice_items``."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    n_slices = max(1, -(-items.count() // slice_items))
    out = []
    for k in range(n_slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_slices)) == k).orderBy("item_id", "text").collect()
        out.append(spark.sparkContext.broadcast(([r[0] if r[0] is not None else -1 for r in part], [r[1] for r in part])))
    return out


def _matcher(shared, radius: int, threshold: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value, radius)
        for batch, raw, off in text_blocks(batches, max_bytes=SCAN_BYTES):
            words = Words(raw, off)
            best: dict[tuple[int, int], tuple] = {}
            for n in index.groups:
                for doc, item, sim, ham, start, size in _scan(index, n, words, threshold):
                    old = best.get((doc, item))
                    if old is None or (-sim, start) < (-old[0], old[2]):
                        best[doc, item] = (sim, ham, start, size)
            if best:
                ids = batch.column("doc_id").to_pylist()
                keys = sorted(best)
                cols = list(zip(*(best[k] for k in keys), strict=True))
                yield pa.record_batch([pa.array([ids[d] for d, _ in keys], pa.int64()), pa.array([int(index.ids[i]) for _, i in keys], pa.int64()),
                                       pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                      ["doc_id", "item_id", "similarity", "hamming", "start_word", "n_words"])
    return match


def _scan(index: Index, n: int, words: Words, threshold: float) -> Iterator[tuple]:
    total = len(words.hash)
    if total < n:
        return
    h, weight = _rolled(words, n)
    hit = index.hits(n, h)
    doc_end = words.first[words.doc + 1] if total else np.zeros(0, np.int64)
    hit = hit[hit + n <= doc_end[hit]]  # a shingle within one document
    if not len(hit):
        return
    d_first, d_end = words.first[words.doc[hit]], doc_end[hit]
    sizes = sorted(index.groups[n])
    # positions that some window can touch, compressed; votes are summed over these alone
    reach = max(sizes)
    touched = _union(np.maximum(d_first, hit - reach), np.minimum(d_end - n, hit + reach) + 1, total)
    place = np.cumsum(touched) - 1
    at = np.flatnonzero(touched)
    votes = np.zeros((len(at) + 1, 64), np.int32)
    np.cumsum(_bit_votes(h[at], weight[at]), axis=0, out=votes[1:])
    mass = np.concatenate(([0], np.cumsum(weight[at])))
    for size in sizes:
        lo = np.maximum(d_first, hit - (size - n))
        hi = np.minimum(hit, np.maximum(d_end - size, d_first))
        start = np.flatnonzero(_union(lo, hi + 1, total))
        if not len(start):
            continue
        last = np.minimum(start + size, doc_end[start]) - n  # position of the window's last shingle
        a, b = place[start], place[last] + 1
        window, item, distance = index.near(n, size, _fingerprint(votes[b] - votes[a]))
        if not len(window):
            continue
        # exact multiset intersection of each candidate window and its item
        count = (b - a)[window]
        cand = np.repeat(np.arange(len(window)), count)
        key = index.key(h[ranges(start[window], count)], np.repeat(item, count))
        pos = np.minimum(np.searchsorted(index.keys, key), len(index.keys) - 1)
        same = index.keys[pos] == key
        pair, times = np.unique(cand[same] * len(index.keys) + pos[same], return_counts=True)
        pos = pair % len(index.keys)
        inter = np.bincount(pair // len(index.keys), weights=np.minimum(times, index.counts[pos]) * index.weights[pos], minlength=len(window))
        union = (mass[b] - mass[a])[window] + index.total[item] - inter
        good = np.flatnonzero(inter >= threshold * union)
        for g in good:
            s = start[window[g]]
            doc = int(words.doc[s])
            yield doc, int(item[g]), float(inter[g] / union[g]), int(distance[g]), int(s - words.first[doc]), int(last[window[g]] + n - s)


def _union(lo: np.ndarray, hi: np.ndarray, total: int) -> np.ndarray:
    """Mask of [lo, hi) intervals."""
    ok = hi > lo
    step = np.bincount(lo[ok], minlength=total + 1) - np.bincount(hi[ok], minlength=total + 1)
    return np.cumsum(step[:total]) > 0
