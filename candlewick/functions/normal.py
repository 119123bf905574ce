"""Column expressions that bring differently spelled market identifiers to one spelling.

All of them map null to null and never raise: text that fits no known spelling is kept (trimmed and in one case),
so that two rows spelled alike still meet.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the two book sides.
BID_SPELLINGS = ("bid", "b", "buy")
ASK_SPELLINGS = ("ask", "a", "sell")


def side(c: Column) -> Column:
    """``bid`` or ``ask``; blank text is null, unknown text is kept in lower case."""
    s = F.lower(F.trim(c))
    return F.when(s.isin(*BID_SPELLINGS), "bid").when(s.isin(*ASK_SPELLINGS), "ask").when(s != "", s)


def trade_side(c: Column) -> Column:
    """``BUY`` if it says so in whatever case, else ``SELL``, also for null."""
    return F.when(F.upper(c) == "BUY", "BUY").otherwise("SELL")


def exchange(c: Column) -> Column:
    return F.lower(F.trim(c))


def symbol(c: Column) -> Column:
    """``QUOTE-BASE`` in upper case: ``vlt_krw`` and ``krw-vlt`` are both ``KRW-VLT``."""
    s = F.upper(F.trim(c))
    return F.when(s.contains("_"), F.concat_ws("-", F.substring_index(s, "_", -1), F.substring_index(s, "_", 1))).otherwise(s)


def instant_us(c: Column) -> Column:
    """Epoch microseconds of ISO 8601 text (any offset, ``Z``, or none, which is UTC) or of epoch milliseconds in digits."""
    s = F.trim(c)
    zoned = F.regexp_like(s, F.lit(r"([Zz]|[+-]\d\d:?\d\d)$"))
    iso = F.unix_micros(F.try_to_timestamp(F.when(zoned, s).otherwise(F.concat(s, F.lit("Z")))))
    return F.when(F.regexp_like(s, F.lit(r"^-?\d+$")), F.try_multiply(s.try_cast("bigint"), F.lit(1000))).otherwise(iso)


def timeframe_seconds(c: Column) -> Column:
    """Seconds of ``1m``, ``1min``, ``60s``, ``1h``, ``1d``; null for anything else."""
    s = F.lower(F.trim(c))
    n = F.regexp_extract(s, r"^(\d+)\s*[a-z]+$", 1).try_cast("bigint")
    unit = F.regexp_extract(s, r"^\d+\s*([a-z]+)$", 1)
    scale = (
        F.when(unit.isin("s", "sec"), 1)
        .when(unit.isin("m", "min"), 60)
        .when(unit.isin("h", "hour"), 3600)
        .when(unit.isin("d", "day"), 86400)
    )
    return n * scale


def bucket(c: Column, width: Column | int) -> Column:
    """floor(c / width) of whole numbers, exact and right for negative ones too."""
    w = F.lit(width) if isinstance(width, int) else width
    return ((c - F.pmod(c, w)) / w).cast("bigint")


def last_closed(now: Column, timeframe: str) -> Column:
    """The end of the last bar that is closed at ``now``: the epoch floor of the timeframe; for ``1d`` midnight in Korea (nine hours ahead of UTC all year)."""
    seconds = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "4h": 14400, "1d": 86400}.get(timeframe)
    if seconds is None:
        raise ValueError(f"not a timeframe: {timeframe!r}")
    ahead = 9 * 3600 if timeframe == "1d" else 0
    us = F.unix_micros(now) + F.lit(ahead * 1_000_000)
    return F.timestamp_micros(bucket(us, seconds * 1_000_000) * F.lit(seconds * 1_000_000) - F.lit(ahead * 1_000_000))
