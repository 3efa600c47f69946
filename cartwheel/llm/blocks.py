"""Texts as flat byte arrays inside a task: tokens, polynomial hashes, packed exchange rows.

Spark partitions and shuffles; these helpers only turn the Arrow batches of one task into NumPy arrays, a few
megabytes at a time, so a task's memory does not depend on its partition.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
U = np.uint64

_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64)) | U(1)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (or of the base's inverse); kept and grown by doubling."""
    base = _BASE_INV if inverse else _BASE
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * len(have) if have is not None else 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


class PrefixHash:
    """Prefix polynomial hashes of a byte array: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        h = np.empty(len(data) + 1, np.uint64)
        h[0] = 0
        np.cumsum(_BYTE_CODE[data] * powers(len(data)), dtype=np.uint64, out=h[1:])
        self.h = h
        self.inv = powers(len(data) + 1, inverse=True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hash of data[start:end]; equal substrings have equal hashes."""
        return (self.h[end] - self.h[start]) * self.inv[start]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary Arrow column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
                max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about ``max_bytes`` of text: (rows, bytes, offsets).  A longer text is a slice of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        raw, off = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, end - at), raw[off[at]:off[end]], off[at:end + 1] - off[at]
            at = end


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block after lower-casing A-Z: byte spans, document and 64-bit hash."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.data = LOWER[raw]
        solid = ~_WHITE[raw]
        n = len(raw)
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        inner = off[:-1][off[:-1] < n]
        before[inner] = False
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        ends = off[1:]
        after[ends[ends > 0] - 1] = False
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        #: index of the first word of each document, and the total
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        self.hash = mix(PrefixHash(self.data).of(self.start, self.end) + (self.end - self.start).astype(np.uint64))


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingle hashes of every document, sorted within it: (hashes, offsets).

    A document with fewer words has its whole sequence as its one shingle; one without words has none.
    """
    w, first, count = words.hash, words.first, words.count
    weights = mix(np.arange(11, 11 + n, dtype=np.uint64)) | U(1)
    size = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    off = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(off[-1], np.uint64)
    if len(w) >= n:
        rolled = np.zeros(len(w) - n + 1, np.uint64)
        for k in range(n):
            rolled += w[k:len(w) - n + 1 + k] * weights[k]
        rolled = mix(rolled)
    long_docs = np.flatnonzero(count >= n)
    for d in long_docs:
        part = rolled[first[d]:first[d] + size[d]].copy()
        part.sort()
        out[off[d]:off[d + 1]] = part
    for d in np.flatnonzero((count > 0) & (count < n)):
        seq = w[first[d]:first[d + 1]]
        out[off[d]] = mix(np.array([(seq * weights[:len(seq)]).sum(dtype=np.uint64) + U(len(seq))], np.uint64))[0]
    keep = np.ones(len(out), bool)
    if len(out) > 1:
        keep[1:] = out[1:] != out[:-1]
        starts = off[:-1][size > 0]
        keep[starts] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], kept[off]


def pack(arrays: list[np.ndarray], level: int = 1) -> bytes:
    """Arrays as one compressed byte string (Zstandard over npy-like headers)."""
    import zstandard

    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(head).to_bytes(4, "little") + head + zstandard.ZstdCompressor(level=level).compress(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    n = int.from_bytes(blob[:4], "little")
    body = zstandard.ZstdDecompressor().decompress(blob[4 + n:])
    out, at = [], 0
    for part in blob[4:4 + n].decode().split(";"):
        kind, length = part.split(",")
        dtype = np.dtype(kind)
        out.append(np.frombuffer(body, dtype, int(length), at))
        at += dtype.itemsize * int(length)
    return out


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, .. (length[0] of them), then start[1] ..: concatenated index ranges."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    return np.arange(total) + shift


def as_int64(column: pa.Array) -> np.ndarray:
    """An integer column as int64; nulls become the smallest value (callers carry a validity flag)."""
    if column.null_count:
        column = pc.fill_null(column, np.iinfo(np.int64).min)
    return column.cast(pa.int64()).to_numpy(zero_copy_only=False)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a Python worker, and what its heap holds, for later tasks."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it until no column is called so (in any letter case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
