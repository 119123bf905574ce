"""Bars from ticks: time, tick-count, volume and dollar bars with exact decimals.

Ticks have (exchange, symbol, ts_utc, price, quantity, seq); (ts_utc, seq) is a total order within a series. A bar's fields: open and close are
the first and last price in that order, volume the sum of quantities, value the exact sum of price times quantity.
"""

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass, fields
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import hashing, normal
from candlewick.operators import walks

SERIES = ("exchange", "symbol")
BUCKET_S = 3600  # seconds of a series that one task ranks or walks at a time
#: Prices and quantities are narrowed so that their product is exact: (20,8) x (16,8) is (37,16). A value that doesn't fit raises.
PRICE, QUANTITY, NOTIONAL = "decimal(20,8)", "decimal(16,8)", "decimal(38,16)"
# The closed set of timeframes, in seconds.
TIMEFRAMES = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "4h": 14400, "1d": 86400}


@dataclass(frozen=True)
class BarRule:
    """Kind (one of ``KINDS``) and threshold of a bar label such as ``vol_50``."""

    kind: str
    threshold: int

    @property
    def label(self) -> str:
        return f"{self.kind}_{self.threshold}"


def parse_label(label: str) -> BarRule:
    m = re.fullmatch(r"([a-z][a-z0-9]*)_(\d+)", label)
    if not m or m[1] not in KINDS or int(m[2]) <= 0:
        raise ValueError(f"not a bar label with a positive whole threshold: {label!r}; kinds: {', '.join(KINDS)}")
    return BarRule(m[1], int(m[2]))


def timeframe_rule(timeframe: str) -> BarRule:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"closed set of timeframes: {', '.join(TIMEFRAMES)}; not {timeframe!r}")
    return BarRule("time", TIMEFRAMES[timeframe])


def _bars(assigned: DataFrame, rule: BarRule, genesis: Column, close: Column, series: tuple[str, ...]) -> DataFrame:
    order = F.struct("ts_utc", "seq")
    notional = F.col("price").cast(PRICE) * F.col("quantity").cast(QUANTITY)
    aggs = [
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum(F.col("quantity").cast(QUANTITY)).alias("volume"), F.sum(notional).cast(NOTIONAL).alias("value"), F.count(F.lit(1)).alias("n_ticks"),
        F.min("ts_utc").alias("_first"), F.max("ts_utc").alias("_last"), F.max_by("exchange", order).alias("_exchange"),
    ]
    if "closes" in assigned.columns:
        aggs.append(F.max("closes").alias("_closed"))
    got = assigned.groupBy(*series, "bar").agg(*aggs)
    if "exchange" not in series:
        got = got.withColumnRenamed("_exchange", "exchange")
    if "closes" in assigned.columns:
        got = got.where("_closed = 1")
    return got.select("bar", F.lit(rule.label).alias("bar_label"), genesis.alias("genesis_ts"), close.alias("ts_close"), F.lit(rule.threshold).cast("decimal(38,18)").alias("threshold"), "exchange", "symbol", "open", "high", "low", "close", "volume", "value", "n_ticks")


def time_bars(ticks: DataFrame, rule: BarRule, series: tuple[str, ...] = SERIES) -> DataFrame:
    """Windows [k*s, (k+1)*s) from the epoch. Only windows with ticks yield bars, and a series' last window none: a later tick closes a bar.

    One aggregation; the last windows are known from a second, small one, and taken away by an anti-join on series and window, which has no hot key.
    """
    width = rule.threshold * 1_000_000
    placed = ticks.withColumn("bar", normal.bucket(F.unix_micros("ts_utc"), F.lit(width)))
    start = F.timestamp_micros(F.col("bar") * width)
    bars = _bars(placed, rule, start, F.timestamp_micros((F.col("bar") + 1) * width), series)
    last = placed.groupBy(*series).agg(F.max("bar").alias("_bar")).withColumnsRenamed({s: f"_{s}" for s in series})
    met = F.col("bar") == F.col("_bar")
    for s in series:
        met = met & F.col(s).eqNullSafe(F.col(f"_{s}"))
    return bars.join(last, met, "left_anti").drop("bar")


def _closing(last: Column, first: Column) -> Column:
    """A bar's end is its last tick's instant, a microsecond after its first if that isn't later."""
    return F.when(last > first, last).otherwise(F.timestamp_micros(F.unix_micros(first) + 1))


def positions(ticks: DataFrame, series: tuple[str, ...] = SERIES, bucket_s: int = BUCKET_S) -> DataFrame:
    """``ticks`` with ``position``, counted from 0 along each series by (ts_utc, seq).

    A tick's position is its rank in its time bucket plus the ticks of earlier buckets, whose counts are summed along a table of one row a bucket;
    so a series that holds a third of all ticks is ranked by many tasks.
    """
    placed = ticks.withColumn("_bucket", normal.bucket(F.unix_micros("ts_utc"), bucket_s * 1_000_000))
    counts = placed.groupBy(*series, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*series).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*(F.col(s).alias(f"_b_{s}") for s in series), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    met = F.col("_bucket").eqNullSafe(F.col("_b"))
    for s in series:
        met = met & F.col(s).eqNullSafe(F.col(f"_b_{s}"))
    rank = F.row_number().over(Window.partitionBy(*series, "_bucket").orderBy("ts_utc", "seq"))
    ranked = placed.withColumn("_rank", rank).join(before, met)
    return ranked.withColumn("position", F.col("_before") + F.col("_rank") - 1).select(*ticks.columns, "position")


def trades(ticks: DataFrame, series: tuple[str, ...] = SERIES) -> DataFrame:
    """Ticks with ``side`` as BUY or SELL and ``trade_id``: exchange, symbol, ISO instant and position in the series, joined by colons."""
    placed = positions(ticks, series)
    return placed.withColumns({"side": normal.trade_side(F.col("side")), "trade_id": F.concat_ws(":", "exchange", "symbol", hashing.iso_short(F.col("ts_utc")), F.col("position").cast("string"))})


def tick_bars(ticks: DataFrame, rule: BarRule, series: tuple[str, ...] = SERIES) -> DataFrame:
    """Every N ticks; an unfinished bar is dropped."""
    placed = positions(ticks, series).withColumn("bar", normal.bucket(F.col("position"), rule.threshold))
    return _bars(placed, rule, F.col("_first"), _closing(F.col("_last"), F.col("_first")), series).where(F.col("n_ticks") == rule.threshold).drop("bar")


def summed_bars(amount: Column, digits: int) -> Callable[..., DataFrame]:
    """A kind of bar that closes when the sum of ``amount`` (a decimal with so many digits behind the point, per tick) reaches the threshold: ``register("lots", summed_bars(...))``."""

    def build(ticks: DataFrame, rule: BarRule, series: tuple[str, ...] = SERIES, bucket_s: int = BUCKET_S) -> DataFrame:
        kept = ticks.select("exchange", "symbol", "ts_utc", "price", "quantity", "seq", hashing.units(amount, digits).alias("_amount"))
        bucket = walks.time_blocks(ticks, series, "ts_utc", bucket_s)
        assigned = walks.events(kept, series, ["ts_utc", "seq"], F.col("_amount"), rule.threshold * 10**digits, True, bucket, ("closes", "bar"))
        return _bars(assigned, rule, F.col("_first"), _closing(F.col("_last"), F.col("_first")), series).drop("bar")

    return build


def accumulating_bars(ticks: DataFrame, rule: BarRule, series: tuple[str, ...] = SERIES, bucket_s: int = BUCKET_S) -> DataFrame:
    """Volume and dollar bars: a bar closes with the tick at which the sum since the last close reaches the threshold; overshoot is discarded.

    Where a bar ends depends on where the one before ended; ``walks.events`` finds the ends by time buckets of ``bucket_s`` or less, so a hot series is many tasks'. A null amount, and
    one below 0, adds nothing.
    """
    if rule.kind == "vol":
        return summed_bars(F.col("quantity").cast("decimal(38,8)"), 8)(ticks, rule, series, bucket_s)
    return summed_bars((F.col("price").cast(PRICE) * F.col("quantity").cast(QUANTITY)).cast(NOTIONAL), 16)(ticks, rule, series, bucket_s)


#: Kinds of bars by the first part of their label. A builder takes ticks, rule and series and gives the columns of ``time_bars``.
KINDS: dict[str, Callable[..., DataFrame]] = {"time": time_bars, "tick": tick_bars, "vol": accumulating_bars, "dollar": accumulating_bars}


def register(kind: str, builder: Callable[..., DataFrame]) -> None:
    """Adds a kind of bar, so that ``<kind>_<threshold>`` is a label; one that exists can't be replaced."""
    if not re.fullmatch(r"[a-z][a-z0-9]*", kind) or kind in KINDS:
        raise ValueError(f"not a new kind of bar: {kind!r}")
    KINDS[kind] = builder


def resample(ticks: DataFrame, label: str, start: str | None = None, end: str | None = None, symbol: str | None = None, exchange: str | None = None, compat: bool = False) -> DataFrame:
    """Bars of one label over [start, end). ``compat`` keys series by symbol alone, venues interleaved, and takes the exchange of the closing tick."""
    rule = parse_label(label)
    t = ticks
    if start is not None:
        t = t.where(F.col("ts_utc") >= F.to_timestamp(F.lit(start)))
    if end is not None:
        t = t.where(F.col("ts_utc") < F.to_timestamp(F.lit(end)))
    for name, value in (("symbol", symbol), ("exchange", exchange)):
        if value is not None:
            t = t.where(F.col(name) == value)
    series = ("symbol",) if compat else SERIES
    return KINDS[rule.kind](t, rule, series)


def candles(bars: DataFrame, timeframe: str) -> DataFrame:
    """Time bars as candles derived from transactions."""
    timeframe_rule(timeframe)
    return bars.select(F.col("genesis_ts").alias("ts_utc"), "exchange", "symbol", F.lit(timeframe).alias("timeframe"), "open", "high", "low", "close", "volume", "value", F.lit("transaction_derived").alias("source"))


@dataclass(frozen=True)
class Contract:
    """What information bars were made by; ``contract_id`` is the same for equal contracts and different otherwise."""

    bar_label: str
    genesis_ts: datetime
    threshold: Decimal
    precision: int
    rounding_rule: str
    source_cutoff: datetime
    tie_breaking: str
    version: str = "info_bar.v1"

    def __post_init__(self) -> None:
        if not self.bar_label:
            raise ValueError("a contract needs a bar label")
        if self.threshold <= 0 or self.precision < 0:
            raise ValueError("threshold must be above 0, precision at least 0")
        if self.tie_breaking not in ("current_tick", "next_tick"):
            raise ValueError(f"unknown tie breaking {self.tie_breaking!r}")
        for name in ("genesis_ts", "source_cutoff"):
            t = getattr(self, name)
            if t.tzinfo is None or t.utcoffset() != timedelta(0):
                raise ValueError(f"{name} must be in UTC")

    @property
    def contract_id(self) -> str:
        """16 hex digits over name=value of the fields in order."""
        text = lambda v: v.isoformat() if isinstance(v, datetime) else str(v)
        return hashlib.sha256("|".join(f"{f.name}={text(getattr(self, f.name))}" for f in fields(self)).encode()).hexdigest()[:16]
