"""Suffix-array dedup: remove every byte of a ``length``-byte string that also starts earlier in the corpus.

Only suffixes that can repeat are sorted.  Every window of ``length`` bytes picks an anchor, the 24-byte string in it
with the least hash, so equal windows pick equal anchors at the same place; about one position in 39 is one.

1. *Anchors.*  A task sends each anchor's hash with a hash of its block (the text of all windows that picked it) to the
   task that owns the hash.  Of equal blocks the first stays and the others are repeats as a whole; an anchor that occurs in
   different blocks needs a closer look.  The blocks to look at go into a bitmap of bounded size (a false hit
   only adds work).
2. *Suffix sort.*  A second scan sends those blocks' text to the anchor's task.  There the suffixes that begin a
   window, and have a partner of equal hash, are merge-sorted among those with the same anchor and offset: prefix polynomial hashes and binary search
   give the longest common extension of two suffixes in a logarithmic number of steps, one byte decides.
   Neighbours whose extension reaches ``length`` are compared byte by byte (collision check); all but the first
   of equal windows are repeats.
3. *Cut.*  The repeats of a document are united and cut from its text.

"First" is the smaller (document id, start).  Hot strings: equal blocks and equal windows meet within the sending task before they are sent;
an anchor with ``cap`` different blocks in one task sends a marker instead of its rows, and one with ``hot`` of them in
all is looked at window by window, dealt by the window's own hash.

Defined results: null and empty texts have nothing removed; rows with the same id and text are one document (each
row gets its result); rows with one id and different texts are ordered by a hash of the text; a null id comes first; matches never
cross documents; extra columns pass through ``cut`` and are ignored elsewhere; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import bitmap
from cartwheel.llm.blocks import U, PrefixHash, as_int64, flat, give_back, mix, pack, ranges, text_blocks, unpack

GRAM = 24
BLOCK_BYTES = 1 << 19   # of text at a time
CAP = 256
FLUSH = 150_000        # anchors a task holds before it sends them
BUCKET = 400_000       # anchors a receiving task gets, about
BLOCK_BUCKET = 20_000   # blocks of text a sorting task gets, about
PART_BYTES = 64 << 20   # of text whose ranges one task unites, about
RANGES = "doc_id bigint, mark bigint, ranges binary"
PACKED = "part bigint, ranges binary"


class Anchors:
    """Anchors of a block of texts: hash, block hash, first and last window, anchor position, document."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, length: int):
        self.prefix = PrefixHash(raw)
        n_windows = np.maximum(np.diff(off) - length + 1, 0)
        if not n_windows.any():
            self.n = 0
            return
        grams = len(raw) - GRAM + 1
        at = np.arange(grams)
        h = mix(self.prefix.of(at, at + GRAM))
        low = (h & U(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        width, span = length - GRAM + 1, 1
        while 2 * span <= width:  # least value of each window by doubling
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if width > span:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        window = ranges(off[:-1], n_windows)
        doc = np.repeat(np.arange(len(off) - 1), n_windows)
        pos = (low[window] & U(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(window), bool)
        new[1:] = (pos[1:] != pos[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(window)) - 1
        self.n = len(begin)
        self.first, self.last, self.pos, self.doc = window[begin], window[end], pos[begin], doc[begin]
        self.hash = mix(h[self.pos] ^ U(0x5851F42D4C957F2D))  # least hashes crowd at 0: spread again
        self.block = mix(self.prefix.of(self.first, self.last + length) + (self.last - self.first).astype(np.uint64))
        self.start = self.first - off[self.doc]  # within the document


def anchor_id(h: np.ndarray, doc_id: np.ndarray, mark: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(h ^ mix(doc_id.view(np.uint64) + U(1)) ^ mix(mark.view(np.uint64) + U(2)) + start.astype(np.uint64) * U(0x9E3779B97F4A7C15))


def _united(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of a document as one: (document, start, end), sorted."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    reach = np.maximum.accumulate(end + doc * (1 << 40)) - doc * (1 << 40)  # documents are numbered small, texts stay below 2**40
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last]


def _part(doc_id: np.ndarray, mark: np.ndarray, n_parts: int) -> np.ndarray:
    """Which of the parts of the documents gets a document's ranges."""
    return (mix(doc_id.view(np.uint64) ^ mix(mark.view(np.uint64) + U(5))) % U(n_parts)).astype(np.int64)


def _range_rows(doc_id: np.ndarray, mark: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, n_parts: int) -> list[tuple[int, int, bytes]]:
    """(part, documents, ranges): the ranges of numbered documents as one packed row a part."""
    doc, start, end = _united(doc, start, end)
    if not len(doc):
        return []
    part = _part(doc_id[doc], mark[doc], n_parts)
    order = np.argsort(part, kind="stable")
    doc, start, end = doc[order], start[order], end[order]
    edge, out = np.searchsorted(part[order], np.arange(n_parts + 1)), []
    for k in range(n_parts):
        lo, hi = edge[k], edge[k + 1]
        if hi > lo:
            used, count = np.unique(doc[lo:hi], return_counts=True)
            out.append((k, len(used), pack([doc_id[used], mark[used], count, start[lo:hi], end[lo:hi] - start[lo:hi]])))
    return out


def _document_ranges(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, mark, ranges): all ranges of a part's documents, united, one row a document."""
    parts = [unpack(b) for b in group["ranges"]]
    doc_id, mark, count, start, size = (np.concatenate([p[k] for p in parts]) for k in range(5))
    rank = _doc_order(doc_id, mark)
    doc, start, end = _united(np.repeat(rank, count), start, start + size)
    first = np.unique(rank, return_index=True)[1]
    cut = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    blobs = [np.stack([start[lo:hi], end[lo:hi]]).astype(np.int64).tobytes() for lo, hi in zip(cut, np.append(cut[1:], len(doc)), strict=True)]
    own = first[doc[cut]]
    give_back()
    return pd.DataFrame({"doc_id": doc_id[own], "mark": mark[own], "ranges": blobs})


def _firsts(keys: list[np.ndarray], doc_order: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, is_first): entries sorted by the keys, the first of equal keys by (document, start)."""
    order = np.lexsort((start, doc_order, *keys[::-1]))
    first = np.ones(len(order), bool)
    if len(order) > 1:
        same = np.ones(len(order) - 1, bool)
        for k in keys:
            same &= k[order][1:] == k[order][:-1]
        first[1:] = ~same
    return order, first


def _doc_order(doc_id: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Rank of (doc_id, mark): equal pairs share it."""
    order = np.lexsort((mark, doc_id))
    new = np.ones(len(order), np.int64)
    if len(order):
        new[0] = 0
        new[1:] = (doc_id[order][1:] != doc_id[order][:-1]) | (mark[order][1:] != mark[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return as_int64(batch.column("doc_id")), as_int64(batch.column("mark"))


def _planes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.diff(x, prepend=U(0)).view(np.uint8).reshape(-1, 8).T).ravel()


def _unplanes(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(x.reshape(8, -1).T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _edges(h: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(h >> U(32), (np.arange(n + 1, dtype=np.float64) / n * (1 << 32)).astype(np.uint64))


OUT = "kind int, bucket bigint, weight bigint, ranges binary"
ENTRY, NEEDED, REPEAT, HOT = 0, 1, 2, 3


def _out(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["kind", "bucket", "weight", "ranges"])


def _batches(rows: list[tuple], n: int = 512) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows), n):
        yield _out(rows[lo:lo + n])


def anchor_groups(docs: DataFrame, n_bytes: int, length: int, cap: int, hot: int, n_parts: int) -> DataFrame:
    """Rows of kind NEEDED (ids of blocks to look at), REPEAT (ranges of a part's documents) and HOT (an anchor hash)."""
    n_buckets = max(1, -(-n_bytes // (39 * BUCKET)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs_held, count, n_docs = [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, block, doc, start, last = (np.concatenate([x[k] for x in held]) for k in range(5))
            doc_id, mark = (np.concatenate([x[k] for x in docs_held]) for k in range(2))
            rank = _doc_order(doc_id, mark)
            order, first = _firsts([h, block], rank[doc], start)
            h, block, doc, start, last = h[order], block[order], doc[order], start[order], last[order]
            again = ~first
            if again.any():  # the very same place of a document that came twice is no repeat
                lead = np.flatnonzero(first)[np.cumsum(first) - 1]
                again &= (rank[doc] != rank[doc[lead]]) | (start != start[lead])
            rows = [(REPEAT, *r) for r in _range_rows(doc_id, mark, doc[again], start[again], start[again] + last[again] + length, n_parts)]
            h, block, doc, start, last = h[first], block[first], doc[first], start[first], last[first]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            times = np.diff(np.append(np.flatnonzero(new), len(h)))
            common = np.repeat(times >= cap, times)
            if common.any():
                ids = anchor_id(h[common], doc_id[doc[common]], mark[doc[common]], start[common])
                rows += [(NEEDED, int(ids[0] % U(n_buckets)), len(ids), ids.tobytes())]
            keep = ~common | new
            weight = np.where(common, np.repeat(times, times), 0).astype(np.uint32)[keep]
            h, block, doc, start, last = h[keep], block[keep], doc[keep], start[keep], last[keep]
            edge = _edges(h, n_buckets)
            for b in range(n_buckets):
                lo, hi = edge[b], edge[b + 1]
                if hi > lo:
                    used, who = np.unique(doc[lo:hi], return_inverse=True)
                    blob = pack([_planes(h[lo:hi]), block[lo:hi], who.astype(np.uint32), start[lo:hi].astype(np.uint32 if start[lo:hi].max() < 1 << 32 else np.uint64),
                                 last[lo:hi].astype(np.uint16), weight[lo:hi], doc_id[used], mark[used]])
                    rows.append((ENTRY, b, hi - lo, blob))
            yield from _batches(rows, 64)

        for batch, raw, off in text_blocks(batches, max_bytes=BLOCK_BYTES):
            a = Anchors(raw, off, length)
            doc_id, mark = _keys(batch)
            if a.n:
                held.append((a.hash, a.block, a.doc + n_docs, a.start, a.last - a.first))
                docs_held.append((doc_id, mark))
                n_docs += len(doc_id)
                count += a.n
            if count >= FLUSH:
                yield from flush()
                held, docs_held, count, n_docs = [], [], 0, 0
                give_back()
        if count:
            yield from flush()
        held.clear()
        give_back()

    def owned(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] != ENTRY:
            return group[["kind", "bucket", "weight", "ranges"]]
        parts, shift = [], 0
        for blob in group["ranges"]:
            p = unpack(blob)
            parts.append([_unplanes(p[0]), p[1], p[2].astype(np.int64) + shift, p[3].astype(np.int64), p[4].astype(np.int64), p[5].astype(np.int64), p[6], p[7]])
            shift += len(p[6])
        h, block, doc, start, last, weight, doc_id, mark = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.argsort(h, kind="stable")
        sorted_h = h[order]
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = sorted_h[1:] == sorted_h[:-1]
        keep = order[(same[1:] | same[:-1]) | (weight[order] > 0)]
        h, block, doc, start, last, weight = h[keep], block[keep], doc[keep], start[keep], last[keep], weight[keep]
        rank = _doc_order(doc_id, mark)
        order, first = _firsts([h, block], rank[doc], start)
        h, block, doc, start, last, weight = h[order], block[order], doc[order], start[order], last[order], weight[order]
        rows = []
        if len(h):
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            # (a marker's other blocks are all looked at; its own row is one of them)
            again = ~first & ((rank[doc] != rank[doc[lead]]) | (start != start[lead])) & (weight == 0)
            rows = [(REPEAT, *r) for r in _range_rows(doc_id, mark, doc[again], start[again], start[again] + last[again] + length, n_parts)]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            group_no = np.cumsum(new) - 1
            classes = np.bincount(group_no, weights=first + np.maximum(weight - 1, 0))
            look = first & (classes[group_no] > 1) & (weight == 0)
            ids = anchor_id(h[look], doc_id[doc[look]], mark[doc[look]], start[look])
            rows.append((NEEDED, -1, len(ids), ids.tobytes()))
            hots = h[new][classes >= hot]
            if len(hots):
                rows.append((HOT, -1, len(hots), hots.tobytes()))
        give_back()
        return _out(rows).to_pandas()

    return docs.mapInArrow(send, OUT).groupBy("kind", "bucket").applyInPandas(owned, OUT)


# ---------------------------------------------------------------- suffix sort

class Suffixes:
    """Suffixes of a byte array that are compared on their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.prefix = data, length, PrefixHash(data)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common extension, at most ``length``: binary search over prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            same = self.prefix.of(x, x + mid) == self.prefix.of(y, y + mid)
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """x before y (or equal to it, where told)."""
        same = self.prefix.of(x, x + self.length) == self.prefix.of(y, y + self.length)
        out = same & or_equal
        differ = np.flatnonzero(~same)
        k = self.extension(x[differ], y[differ])
        k = np.minimum(k, self.length - 1)
        out[differ] = self.data[x[differ] + k] < self.data[y[differ] + k]
        return out

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Stable merge sort of suffixes within groups (``group`` ascending): the sorted order of indices.

        All pairs of runs of one width are merged together: an element's place is its own rank plus its rank in
        the other run, found by binary search.
        """
        n = len(start)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if n else np.zeros(0, np.int64)
        size = np.diff(np.append(first, n))
        base, total = np.repeat(first, size), np.repeat(size, size)
        local = np.arange(n) - base
        width = 1
        while n and width < size.max():
            busy = np.flatnonzero(total > width)
            run = local[busy] // width
            other = run ^ 1
            lo = np.minimum(base[busy] + other * width, base[busy] + total[busy])
            hi = np.minimum(lo + width, base[busy] + total[busy])
            from_left = (run & 1) == 0
            begin = lo.copy()
            suffix = start[order[busy]]
            while True:
                live = np.flatnonzero(lo < hi)
                if not len(live):
                    break
                mid = (lo[live] + hi[live]) // 2
                # the other run's middle goes before this element: strictly less, or equal if that run is the left one
                before = self.less(start[order[mid]], suffix[live], ~from_left[live])
                lo[live] = np.where(before, mid + 1, lo[live])
                hi[live] = np.where(before, hi[live], mid)
            pair = base[busy] + (run // 2) * 2 * width
            place = pair + (local[busy] % width) + (lo - begin)
            merged = order.copy()
            merged[place] = order[busy]
            order = merged
            width *= 2
        return order

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whole ``length`` bytes equal, checked on the bytes themselves where the hashes agree."""
        out = self.prefix.of(x, x + self.length) == self.prefix.of(y, y + self.length)
        at = np.flatnonzero(out)
        span = np.arange(self.length)
        for lo in range(0, len(at), 50_000):
            part = at[lo:lo + 50_000]
            out[part] = (self.data[x[part][:, None] + span] == self.data[y[part][:, None] + span]).all(axis=1)
        return out


def repeated_windows(data: np.ndarray, context: np.ndarray, n_windows: np.ndarray, key: np.ndarray, offset: np.ndarray, order_key: tuple[np.ndarray, np.ndarray],
                     length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, window) of all windows that are not the first of their kind.

    ``context``: where each block starts in ``data``; ``key``: its anchor; ``offset``: the anchor's place in it; ``order_key``: (document rank, start).
    """
    who = np.repeat(np.arange(len(context)), n_windows)
    w = ranges(np.zeros(len(context), np.int64), n_windows)
    rank, start = order_key
    _, key = np.unique(key, return_inverse=True)
    group = key[who] * 4096 + (offset[who] - w) + 1024
    s = Suffixes(data, length)
    # a window whose hash is alone in its group has no partner and need not be sorted
    x = context[who] + w
    _, tag, times = np.unique(mix(s.prefix.of(x, x + length) ^ mix(group.astype(np.uint64))), return_inverse=True, return_counts=True)
    many = times[tag] > 1
    who, w, group = who[many], w[many], group[many]
    order = np.lexsort((start[who] + w, rank[who], group))
    who, w, group = who[order], w[order], group[order]
    at = context[who] + w
    order = s.sort(at, group)
    who, w, group, at = who[order], w[order], group[order], at[order]
    same = np.zeros(len(at), bool)
    if len(at) > 1:
        next_to = np.flatnonzero(group[1:] == group[:-1])
        same[next_to + 1] = s.equal(at[next_to], at[next_to + 1])
    lead = np.flatnonzero(~same)[np.cumsum(~same) - 1] if len(at) else np.zeros(0, np.int64)
    same &= (rank[who] != rank[who[lead]]) | (start[who] + w != start[who[lead]] + w[lead])
    return who[same], w[same]


def sort_blocks(docs: DataFrame, needed, bits: int, hots, n_needed: int, length: int, n_parts: int) -> DataFrame:
    """Ranges of repeated windows among the blocks in the bitmap: PACKED rows."""
    n_buckets = max(1, -(-n_needed // BLOCK_BUCKET))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hot = needed.value, hots.value
        held, docs_held, count, n_docs = [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, doc, start, n_win, offset, size = (np.concatenate([x[k] for x in held]) for k in range(6))
            data = np.concatenate([x[6] for x in held])
            doc_id, mark = (np.concatenate([x[k] for x in docs_held]) for k in range(2))
            rank = _doc_order(doc_id, mark)
            context = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else np.zeros(0, np.int64)
            rows = []
            is_hot = np.isin(h, hot)
            if is_hot.any():  # window by window, dealt by the window's hash; equal windows of this task meet here
                at = np.flatnonzero(is_hot)
                who = np.repeat(at, n_win[at])
                w = ranges(np.zeros(len(at), np.int64), n_win[at])
                x = context[who] + w
                wh = mix(PrefixHash(data).of(x, x + length) + U(77))
                order, first = _firsts([wh], rank[doc[who]], start[who] + w)
                who, w, x, wh = who[order], w[order], x[order], wh[order]
                lead = np.flatnonzero(first)[np.cumsum(first) - 1]
                again = ~first & ((rank[doc[who]] != rank[doc[who[lead]]]) | (start[who] + w != start[who[lead]] + w[lead]))
                rest = np.flatnonzero(again)
                true = Suffixes(data, length).equal(x[rest], x[lead[rest]])
                first[rest[~true]] = True  # a collision: goes on as a window of its own
                rest = rest[true]
                rows += [(REPEAT, *r) for r in _range_rows(doc_id, mark, doc[who[rest]], start[who[rest]] + w[rest], start[who[rest]] + w[rest] + length, n_parts)]
                f = np.flatnonzero(first)
                single = data[(x[f][:, None] + np.arange(length))].ravel() if len(f) else np.zeros(0, np.uint8)
                cool = ~is_hot
                data = np.concatenate([data[ranges(context[cool], size[cool])], single])
                h, doc = np.concatenate([h[cool], wh[f]]), np.concatenate([doc[cool], doc[who[f]]])
                start = np.concatenate([start[cool], (start[who] + w)[f]])
                n_win, offset = np.concatenate([n_win[cool], np.ones(len(f), np.int64)]), np.concatenate([offset[cool], np.full(len(f), 200)])
                size = np.concatenate([size[cool], np.full(len(f), length)])
                context = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else np.zeros(0, np.int64)
            order = np.argsort(h, kind="stable")
            h, doc, start, n_win, offset, size, context = h[order], doc[order], start[order], n_win[order], offset[order], size[order], context[order]
            edge = _edges(h, n_buckets)
            for b in range(n_buckets):
                lo, hi = edge[b], edge[b + 1]
                if hi > lo:
                    used, who = np.unique(doc[lo:hi], return_inverse=True)
                    blob = pack([_planes(h[lo:hi]), who.astype(np.uint32), start[lo:hi], n_win[lo:hi].astype(np.uint16), offset[lo:hi].astype(np.uint16),
                                 doc_id[used], mark[used], data[ranges(context[lo:hi], size[lo:hi])]], level=3)
                    rows.append((ENTRY, b, hi - lo, blob))
            yield from _batches(rows, 16)

        for batch, raw, off in text_blocks(batches, max_bytes=BLOCK_BYTES):
            a = Anchors(raw, off, length)
            if a.n:
                doc_id, mark = _keys(batch)
                ids = anchor_id(a.hash, doc_id[a.doc], mark[a.doc], a.start)
                at = np.flatnonzero(bitmap.has(own, ids, bits))
                if len(at):
                    size = a.last[at] - a.first[at] + length
                    held.append((a.hash[at], a.doc[at] + n_docs, a.start[at], a.last[at] - a.first[at] + 1, a.pos[at] - a.first[at], size, raw[ranges(a.first[at], size)]))
                    docs_held.append((doc_id, mark))
                    n_docs += len(doc_id)
                    count += int(size.sum())
            if count >= 2 << 20:
                yield from flush()
                held, docs_held, count, n_docs = [], [], 0, 0
                give_back()
        if count:
            yield from flush()
        held.clear()
        give_back()

    def owned(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] == REPEAT:
            return group[["bucket", "ranges"]].rename(columns={"bucket": "part"})
        parts, shift = [], 0
        for blob in group["ranges"]:
            p = unpack(blob)
            parts.append([_unplanes(p[0]), p[1].astype(np.int64) + shift, p[2], p[3].astype(np.int64), p[4].astype(np.int64), p[5], p[6], p[7]])
            shift += len(p[5])
        h, doc, start, n_win, offset, doc_id, mark, data = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        size = n_win + length - 1
        context = np.concatenate(([0], np.cumsum(size)[:-1]))
        rank = _doc_order(doc_id, mark)
        found = []
        # anchors in pieces of bounded size (an anchor's blocks stay together)
        order = np.argsort(h, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        load = np.cumsum(n_win[order])
        piece = np.searchsorted(load[cut], np.arange(0, load[-1] + 400_000, 400_000))
        piece = np.unique(np.append(cut[np.minimum(piece, len(cut) - 1)], [0, len(order)]))
        for lo, hi in zip(piece[:-1], piece[1:], strict=True):
            own = order[lo:hi]
            text = data[ranges(context[own], size[own])]
            at = np.concatenate(([0], np.cumsum(size[own])[:-1]))
            who, w = repeated_windows(text, at, n_win[own], h[own], offset[own], (rank[doc[own]], start[own]), length)
            begin = start[own][who] + w
            found.append(_united(doc[own][who], begin, begin + length))
        rows = _range_rows(doc_id, mark, *(np.concatenate(c) for c in zip(*found, strict=True)), n_parts)
        give_back()
        return pd.DataFrame({"part": pd.Series([r[0] for r in rows], dtype="int64"), "ranges": [r[2] for r in rows]})

    return docs.mapInArrow(send, OUT).groupBy("kind", "bucket").applyInPandas(owned, PACKED)


def repeats(docs: DataFrame, length: int = 100, cap: int = CAP, hot: int | None = None) -> DataFrame:
    """(doc_id, mark, ranges) of the keyed documents (see ``keyed``) that repeat something."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if hot is None:  # at most 4096 anchors can be as hot as this
        hot = max(5_000, n_bytes // 39 // 4096)
    n_parts = max(1, -(-n_bytes // PART_BYTES))
    groups = anchor_groups(docs, n_bytes, length, cap, hot, n_parts).checkpoint()
    n_needed = groups.where(F.col("kind") == NEEDED).agg(F.sum("weight")).first()[0] or 0
    bits = bitmap.bits_for(n_needed)
    needed = spark.sparkContext.broadcast(bitmap.union(groups.where(F.col("kind") == NEEDED).select(F.col("ranges").alias("payload")), bits))
    hots = [np.frombuffer(bytes(r[0]), np.uint64) for r in groups.where(F.col("kind") == HOT).select("ranges").collect()]
    hots = spark.sparkContext.broadcast(np.concatenate(hots) if hots else np.zeros(0, np.uint64))
    whole = groups.where(F.col("kind") == REPEAT).select(F.col("bucket").alias("part"), "ranges")
    return whole.unionByName(sort_blocks(docs, needed, bits, hots, n_needed, length, n_parts)).groupBy("part").applyInPandas(_document_ranges, RANGES)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, whole_chars: bool = False,
        keep: list[str] | None = None, cap: int = CAP, hot: int | None = None) -> DataFrame:
    """``docs`` (columns ``keep``) with kept (binary), n_bytes, n_removed and n_spans.

    ``whole_chars`` shrinks a removed run to whole UTF-8 characters, so that the rest is a text again.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("kept", "n_bytes", "n_removed", "n_spans")]
    own = keyed(docs, id_col, text_col)
    found = repeats(own, length, cap, hot).withColumnRenamed("ranges", "_ranges")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    kept_text = text_col in keep and fields[text_col] == "string"  # then the text travels once
    body = f"k_{text_col}" if kept_text else "_text"
    rows = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("doc_id"), F.xxhash64(text).alias("mark"),
                       *[text.alias("_text")] * (not kept_text))
    joined = rows.join(found, ["doc_id", "mark"], "left").select(*[f"k_{c}" for c in keep], *["_text"] * (not kept_text), "_ranges")
    names = keep + ["kept", "n_bytes", "n_removed", "n_spans"]
    schema = "".join(f"`{c}` {fields[c]}, " for c in keep) + "kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                raw, off = flat(part.column(body))
                kept, removed, spans = [], np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for d, blob in enumerate(part.column("_ranges").to_pylist()):
                    text = raw[off[d]:off[d + 1]]
                    if blob:
                        start, end = np.frombuffer(blob, np.int64).reshape(2, -1).copy()
                        if whole_chars:
                            inside = (text & 0xC0) == 0x80
                            safe = np.append(inside, False)
                            for _ in range(3):
                                start += (start < end) & safe[start]
                                end -= (start < end) & safe[end]
                        removed[d], spans[d] = (end - start).sum(), len(start)
                        gone = np.cumsum(np.bincount(start, minlength=len(text) + 1) - np.bincount(end, minlength=len(text) + 1))[:len(text)] > 0
                        text = text[~gone]
                    kept.append(text.tobytes())
                give_back()
                yield pa.record_batch([part.column(f"k_{c}") for c in keep] + [pa.array(kept, pa.binary()), pa.array(np.diff(off)), pa.array(removed), pa.array(spans)], names)

    return joined.mapInArrow(run, schema)
