"""Bloom filters of id sets as arrays of 64-bit words, built by partial OR.

``build`` hashes every id to ``HASHES`` bits; the words are OR-ed by a map-side combined aggregate, so what travels is at most
the filter itself per task.  ``might_contain`` reads the bits inside a scan's projection.  A filter never denies a
member; what it lets through by chance is settled by an exact join, so results do not depend on its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 5
BITS_PER_ID = 10              # about 1 % false positives
MOST_BITS = 1 << 25           # 4 MB: beyond 3.3 million ids more pass by chance, and the exact check has more to do


def bits_for(ids: int, most: int = MOST_BITS) -> int:
    """Bits of a filter for ``ids`` ids: a multiple of 64, at most ``most``."""
    return max(64, min(most, -(-ids * BITS_PER_ID // 64) * 64))


def _bit(value: Column, bits: Column, k: int) -> Column:
    return F.pmod(F.xxhash64(value.cast("string"), F.lit(k)), bits.cast("bigint"))


def build(ids: DataFrame, column: str, bits: int) -> DataFrame:
    """One row (bits, words): the filter of the non-null values of ``column``."""
    size = F.lit(bits)
    places = ids.where(F.col(column).isNotNull()).select(F.explode(F.array(*[_bit(F.col(column), size, k) for k in range(HASHES)])).alias("bit"))
    words = (places.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("set")))
    held = words.agg(F.map_from_entries(F.collect_list(F.struct("word", "set"))).alias("held"))  # bits / 64 words at most
    return held.select(F.lit(bits).cast("bigint").alias("bits"),
                       F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda w: F.coalesce(F.try_element_at("held", w), F.lit(0).cast("bigint"))).alias("words"))


def might_contain(value: Column, sketch: Column) -> Column:
    """False only if ``value`` is surely not in the filter ``sketch``, a struct (bits, words); NULL for a NULL value."""
    found = None
    for k in range(HASHES):
        bit = _bit(value, sketch["bits"], k)
        word = F.get(sketch["words"], F.floor(bit / 64).cast("int"))
        hit = F.getbit(word, F.pmod(bit, F.lit(64)).cast("int")) == 1
        found = hit if found is None else found & hit
    return F.when(value.isNotNull(), found)


def as_column(sketch: DataFrame) -> Column:
    """The filter of ``build`` as a scalar subquery."""
    return sketch.select(F.struct("bits", "words")).scalar()
