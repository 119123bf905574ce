"""Order books from events: last writer wins per level."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators import quality

SERIES = ["exchange", "symbol"]


class GapError(ValueError):
    """Events before the instant are further apart than allowed."""


def flatten_snapshots(events: DataFrame) -> DataFrame:
    """One row a level of snapshot events with arrays ``bids`` and ``asks``: bids first, ``level`` counts from 0 within a side."""
    rest = [c for c in events.columns if c not in ("bids", "asks")]
    side = lambda c, s: events.select(*rest, F.lit(s).alias("side"), F.posexplode(c).alias("level", "l"))
    both = side("bids", "bid").unionByName(side("asks", "ask"))
    return both.select(*rest, F.lit("snapshot").alias("event_type"), "side", "level", F.col("l.price").alias("price"), F.col("l.quantity").alias("quantity"))


def flatten_deltas(events: DataFrame) -> DataFrame:
    """One row a change of events with an array ``changes``; the level of a delta is -1."""
    rest = [c for c in events.columns if c != "changes"]
    return events.select(*rest, F.explode("changes").alias("c")).select(*rest, F.lit("delta").alias("event_type"), "c.side", F.lit(-1).alias("level"), "c.price", "c.quantity")


def book_at(events: DataFrame, instant: str, max_gap_s: float | None = None) -> DataFrame:
    """(exchange, symbol, side, price, quantity): every level at an instant, from events (ts_utc, seq, event_type, side, price, quantity).

    The last snapshot at or before the instant is the baseline and clears both sides; later events set levels, quantity 0 removes
    one. A series without a snapshot has no book. All of it is aggregation, so no series is gathered in a task. With ``max_gap_s``, a
    longer silence between baseline and instant raises ``GapError`` when the function is called.
    """
    known = events.where(F.col("ts_utc") <= F.to_timestamp(F.lit(instant)))
    base = known.where("event_type = 'snapshot'").groupBy(*SERIES).agg(F.max("ts_utc").alias("base_ts"))
    since = known.join(base, SERIES).where((F.col("ts_utc") > F.col("base_ts")) | ((F.col("ts_utc") == F.col("base_ts")) & (F.col("event_type") == "snapshot")))
    if max_gap_s is not None:
        worst = quality.bucketed_gaps(since, SERIES, "ts_utc", max_gap_s).orderBy(F.desc("gap_s")).limit(1).collect()
        if worst:
            raise GapError(f"{worst[0].exchange} {worst[0].symbol}: {worst[0].gap_s} s before {worst[0].before_ts}")
    order = F.struct("ts_utc", "seq")
    last = since.groupBy(*SERIES, "side", "price").agg(F.max_by("quantity", order).alias("quantity"))
    return last.where("quantity > 0")


def top_of_book(book: DataFrame) -> DataFrame:
    """Best bid and ask of each series; null where a side is empty."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    price = lambda s: F.when(s, F.col("price"))
    return book.groupBy(*SERIES).agg(
        F.max(price(bid)).alias("bid_price"), F.max_by("quantity", price(bid)).alias("bid_quantity"), F.min(price(ask)).alias("ask_price"), F.min_by("quantity", price(ask)).alias("ask_quantity")
    )
