"""A set of 64-bit ids as one bitmap of bounded size, built in Spark: partial bitmaps, two rounds of OR."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 27  # 16 MB; beyond it the map only lets more false candidates through
_CHUNK = 1 << 16


def bits_for(n: int) -> int:
    """log2 of the bitmap's size for n ids: 16 bits an id within the bounds."""
    return int(np.clip(np.ceil(np.log2(16 * max(1, n))), 19, MOST_BITS))


def union(ids: DataFrame, bits: int, salt: int = 64) -> np.ndarray:
    """Bytes of the bitmap with bit ``id >> (64 - bits)`` set for every id; ``ids``: binary column ``payload`` of uint64."""
    import zstandard

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                add(own, np.frombuffer(payload, np.uint64), bits)
        where = int(np.random.default_rng(int(own.sum())).integers(salt))
        for c in range(0, len(own), _CHUNK):
            piece = own[c:c + _CHUNK]
            if piece.any():
                yield pa.record_batch([pa.array([c // _CHUNK], pa.int32()), pa.array([where], pa.int32()),
                                       pa.array([zstandard.ZstdCompressor(level=1).compress(piece.tobytes())], pa.binary())], ["chunk", "salt", "piece"])

    def fuse(group: pd.DataFrame) -> pd.DataFrame:
        got = np.bitwise_or.reduce([np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8) for p in group["piece"]])
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "salt": [0], "piece": [zstandard.ZstdCompressor(level=1).compress(got.tobytes())]})

    kind = "chunk int, salt int, piece binary"
    rows = ids.select("payload").mapInArrow(part, kind).groupBy("chunk", "salt").applyInPandas(fuse, kind).groupBy("chunk").applyInPandas(fuse, kind).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        got = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["piece"])), np.uint8)
        out[r["chunk"] * _CHUNK:r["chunk"] * _CHUNK + len(got)] = got
    return out


def add(own: np.ndarray, ids: np.ndarray, bits: int) -> None:
    at = ids >> np.uint64(64 - bits)
    np.bitwise_or.at(own, (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))


def has(own: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    at = ids >> np.uint64(64 - bits)
    return (own[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
