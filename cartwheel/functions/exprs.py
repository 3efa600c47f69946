"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# Behaviour weight per action type code (type 1..5); unknown codes -> NULL.
BEHAVIOUR_WEIGHTS = {1: 0.1, 2: 0.5, 3: 0.2, 4: 0.3, 5: 0.4}

# Fixture vocabulary (FIXTURES.md §2): event type -> action type code,
# and the alphabetical category lists used to derive age and cate codes.
EVENT_TYPE_CODES = {"view": 1, "purchase": 2, "click": 3, "signup": 4, "error": 5}
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# ---------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def h64(*parts) -> Column:
    """Deterministic 60-bit hash of the '-'-joined parts.

    md5 is computed identically by Spark and DuckDB, so samples and shuffles
    driven by this hash can be checked against an SQL oracle.  DuckDB twin:
    ``('0x' || substr(md5(x), 1, 15))::BIGINT``.
    """
    text = F.concat_ws("-", *[F.lit(p).cast("string") if not isinstance(p, (Column, str)) else col(p).cast("string")
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def code_lookup(c, mapping: dict) -> Column:
    """Dictionary map: code -> value; a missing key gives NULL (never throws)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), col(c))


def one_based_index(c, values: list[str]) -> Column:
    """1-based position of ``c`` in a fixed value list, NULL when absent."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), col(c))
    return F.when(pos > 0, pos)


def round6(c) -> Column:
    return F.round(col(c).cast("double"), 6)


def ts_text(c) -> Column:
    """Timestamp as text with microseconds (same text as the oracle's strftime)."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


_DAY_US = 86_400_000_000


def utc_micros(c) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` wall time read as UTC.

    Built from the date and clock fields, so it does not depend on the
    session time zone (a plain cast to ``timestamp`` would).
    """
    t = col(c)
    secs = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    frac = F.date_format(t, "SSSSSS").cast("bigint")
    return F.unix_date(F.to_date(t)).cast("bigint") * _DAY_US + secs.cast("bigint") * 1_000_000 + frac


def utc_instant(c) -> Column:
    """``timestamp`` (instant) of a ``timestamp_ntz`` wall time read as UTC."""
    return F.timestamp_micros(utc_micros(c))


def ntz_from_utc(c) -> Column:
    """``timestamp_ntz`` UTC wall time of an instant (session-zone independent)."""
    us = F.unix_micros(col(c))
    days = F.floor(us / _DAY_US)
    rest = us - days * _DAY_US
    d = F.date_from_unix_date(days.cast("int"))
    secs = F.floor(rest / 1_000_000)
    frac = (rest - secs * 1_000_000) / 1_000_000
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.floor(secs / 3600).cast("int"),
                                F.floor(F.pmod(secs, F.lit(3600)) / 60).cast("int"),
                                (F.pmod(secs, F.lit(60)) + frac).cast("decimal(16,6)"))


#: fixed-point scale 2**44: sums of these integers do not depend on the order of their terms
FIXED = float(1 << 44)


def fixed(x: Column) -> Column:
    """A double as a 64-bit fixed-point integer (resolution 2**-44), exact to add in any order."""
    return F.floor(x * F.lit(FIXED)).cast("bigint")


def unfixed(x: Column) -> Column:
    return x.cast("double") / F.lit(FIXED)
