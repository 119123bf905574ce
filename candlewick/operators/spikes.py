"""Implausible readings of a series relative to its own behaviour: a Kalman filter per source.

Impossible readings contradict their own bar. Spikes are readings whose standardised innovation, against a local-level model
of the source's log readings, is above a threshold; a flagged reading doesn't update the level. A flagged reading is reported if
it is also several times the largest one that passed as ordinary. Stuck readings are those at which the innovations of the
last-value model vanish for several bars on end.

A source may hold a third of all rows, so its series is cut into blocks of ``BLOCK_BARS`` bar lengths. A block's filter starts
from the source's statistics over all its rows, so blocks are independent; runs that cross blocks are joined afterwards.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import normal
from candlewick.plans.lineage import cut

SERIES = ["exchange", "symbol", "timeframe"]
FIELDS = ("high", "low", "volume")
NO_NAME = "\x00"  # stands for a null key part, so that such series are series like others
BLOCK_BARS = 1440
THRESHOLD = 4.0  # standard deviations of the innovation
DRIFT = 0.01  # variance of the level's step, as a share of the readings' variance
TIMES = 2.0  # a spike is more than so many times the largest reading that passed as ordinary
STUCK_BARS = 8
TRADING_SHARE = 0.5  # stuck readings are reported where more than this share of bars has volume


def readings(candles: DataFrame) -> DataFrame:
    """candle_id, series, ``ts``, ``block``; per field the value, its excess ``e_`` (null if there is none) and ``bad_`` (impossible).

    The excess of a high or low is how far it lies outside the span of open and close, relative to it; that of a volume is the
    volume. Null values have no excess and are never bad. Rows without an instant belong to no series position: only bad ones count.
    """
    top, bottom = F.greatest("open", "close"), F.least("open", "close")
    d = lambda c: c.cast("double")
    bad = {"high": F.col("high") < top, "low": (F.col("low") > bottom) | (F.col("low") <= 0), "volume": F.col("volume") < 0}
    excess = {
        "high": F.when((F.col("high") > top) & (top > 0), d(F.col("high")) / d(top) - 1),
        "low": F.when((F.col("low") < bottom) & (F.col("low") > 0), d(bottom) / d(F.col("low")) - 1),
        "volume": F.when(F.col("volume") > 0, d(F.col("volume"))),
    }
    bar = F.coalesce(normal.timeframe_seconds(F.col("timeframe")), F.lit(60)) * F.lit(BLOCK_BARS * 1_000_000)
    ts = F.unix_micros("ts_utc")
    return candles.select(
        "candle_id", *(F.coalesce(F.col(s), F.lit(NO_NAME)).alias(s) for s in SERIES), ts.alias("ts"), normal.bucket(ts, bar).alias("block"), F.unix_micros("source_ingested_at").alias("ingested"),
        *(F.coalesce(bad[f], F.lit(False)).alias(f"bad_{f}") for f in FIELDS), *(excess[f].alias(f"e_{f}") for f in FIELDS), *(F.when(F.col(f).isNotNull(), F.xxhash64(f)).otherwise(F.xxhash64(F.lit("no value"), ts)).alias(f"v_{f}") for f in FIELDS),
    )


def _statistics(rows: DataFrame) -> DataFrame:
    """Quartiles of each excess, and the share of bars with volume, of each series; partially aggregated."""
    quartiles = [F.percentile_approx(f"e_{f}", [0.25, 0.5, 0.75], 1000).alias(f"q_{f}") for f in FIELDS]
    return rows.groupBy(*SERIES).agg(*quartiles, F.avg(F.when(F.col("e_volume").isNotNull(), 1.0).otherwise(0.0)).alias("trading"))


VERDICT = "exchange string, symbol string, timeframe string, block bigint, field string, kind string, ts_from bigint, ts_to bigint, value_id bigint, size double"


def _filter(x: np.ndarray, most: np.ndarray, prior: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Standardised innovations of the largest and of the smallest reading of each instant; nan where there is none."""
    level, spread = prior
    variance, step = spread, DRIFT * spread
    z_most, z_least = np.full(len(x), np.nan), np.full(len(x), np.nan)
    for i, (least, greatest) in enumerate(zip(x.tolist(), most.tolist(), strict=True)):
        variance += step
        if least != least:
            continue
        scale = (variance + spread) ** 0.5
        innovation = least - level
        z_least[i], z_most[i] = innovation / scale, (greatest - level) / scale
        if z_least[i] <= THRESHOLD:  # withheld otherwise
            gain = variance / (variance + spread)
            level += gain * innovation
            variance *= 1 - gain
    return z_most, z_least


def _runs(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) positions of maximal stretches over which the innovation variance of the last-value model vanishes.

    The model forecasts each bar's value by the one before. The variance of its innovations over any bars is zero if and only if each of
    them is, so the sum of squared innovations (1 for a value that differs, however little) stands still along a stretch and nowhere else.
    """
    squared = np.r_[1.0, (ids[1:] != ids[:-1]).astype(float)]
    energy = np.cumsum(squared)
    first = np.flatnonzero(squared)
    last = np.searchsorted(energy, energy[first], "right") - 1
    yield from zip(first.tolist(), last.tolist(), strict=True)


def _judge(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("ts", kind="stable")
    ts, out = block["ts"].to_numpy(), []
    for f in FIELDS:
        quartiles = block[f"q_{f}"].iloc[0]
        if quartiles is not None and len(quartiles) == 3:
            q = np.asarray(quartiles, float)
            least, most = (block[c].to_numpy(float) for c in (f"least_{f}", f"most_{f}"))
            a, b = np.log1p(least / q[1]), np.log1p(most / q[1])
            deviation = max((np.log1p(q[2] / q[1]) - np.log1p(q[0] / q[1])) / 1.349, 0.05)
            z_most, z_least = _filter(a, b, (np.log(2.0), deviation**2))
            with np.errstate(invalid="ignore"):
                ordinary, flagged = z_least <= THRESHOLD, z_most > THRESHOLD
            if ordinary.any():
                out.append((f, "ordinary", ts[0], ts[-1], None, float(least[ordinary].max())))
            out += [(f, "spike", t, t, None, None) for t in ts[flagged]]
        if block["trading"].iloc[0] > TRADING_SHARE:
            ids = block[f"v_{f}"].to_numpy()
            runs = list(_runs(ids))
            for k, (i, j) in enumerate(runs):
                edge = ("lead" if k == 0 else "") + ("trail" if k == len(runs) - 1 else "")
                if edge or j - i + 1 >= STUCK_BARS:
                    out.append((f, edge or "inner", ts[i], ts[j], ids[i], float(j - i + 1)))
    kinds = {"field": "object", "kind": "object", "ts_from": "Int64", "ts_to": "Int64", "value_id": "Int64", "size": "Float64"}
    parts = list(zip(*out, strict=True)) or [()] * len(kinds)
    got = pd.DataFrame({n: pd.array(list(v), dtype=k) for (n, k), v in zip(kinds.items(), parts, strict=True)})
    for i, name in enumerate([*SERIES, "block"]):
        got.insert(i, name, key[i])
    return got


def verdicts(rows: DataFrame) -> DataFrame:
    """What the filters say of each block: ``spike`` instants, the largest ``ordinary`` excess, runs of equal values."""
    placed = rows.where(F.col("ts").isNotNull())
    last = lambda f: F.max(F.struct("ingested", "candle_id", f"v_{f}"))[f"v_{f}"]
    aggs = [g(F.when(~F.col(f"bad_{f}"), F.col(f"e_{f}"))).alias(f"{n}_{f}") for f in FIELDS for n, g in (("least", F.min), ("most", F.max))]
    instants = placed.groupBy(*SERIES, "block", "ts").agg(*aggs, *(last(f).alias(f"v_{f}") for f in FIELDS))
    # the statistics go to the blocks, not to the rows: a hot source would be a hot join key
    per_block = placed.select(*SERIES, "block").distinct().join(_statistics(placed), SERIES)
    return instants.join(per_block, [*SERIES, "block"]).groupBy(*SERIES, "block").applyInPandas(_judge, VERDICT)


def _stuck(found: DataFrame) -> DataFrame:
    """Runs of at least ``STUCK_BARS`` bars, those across blocks joined; the window sees at most two runs a block."""
    edges = found.where(F.col("kind").isin("lead", "trail", "leadtrail"))
    along = Window.partitionBy(*SERIES, "field").orderBy("ts_from")
    joins = F.lag("kind").over(along).isin("trail", "leadtrail") & F.col("kind").isin("lead", "leadtrail") & (F.lag("value_id").over(along) == F.col("value_id"))
    islands = edges.withColumn("starts", F.when(joins, 0).otherwise(1)).withColumn("island", F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = islands.withColumn("total", F.sum("size").over(Window.partitionBy(*SERIES, "field", "island")))
    keep = [*SERIES, "block", "field", "ts_from", "ts_to", "value_id"]
    return whole.where(F.col("total") >= STUCK_BARS).select(*keep).unionByName(found.where(F.col("kind") == "inner").select(*keep))


def kinds(candles: DataFrame) -> DataFrame:
    """(candle_id, field_name, kind): every ``impossible``, ``spike`` or ``stuck`` reading; each copy of a bar that has it. A reading may be impossible and stuck.

    Series keys are taken as they are; a null key part is a value of its own. Null values are never stuck.
    A source without readings or with equal ones has no spikes. Empty candles give an empty result.
    """
    rows = readings(candles)
    found = cut(verdicts(rows))  # a few rows a block; used four times
    most = found.where(F.col("kind") == "ordinary").groupBy(*SERIES, "field").agg(F.max("size").alias("most"))
    spikes = found.where(F.col("kind") == "spike").join(most, [*SERIES, "field"], "left")
    spikes = spikes.select(*SERIES, "block", "field", "ts_from", "ts_to", F.lit(None).cast("bigint").alias("value_id"), (F.lit(TIMES) * F.coalesce("most", F.lit(0.0))).alias("limit"))
    marks = spikes.unionByName(_stuck(found).withColumn("limit", F.lit(None).cast("double")))
    pick = lambda p: F.when(F.col("field") == "high", F.col(f"{p}_high")).when(F.col("field") == "low", F.col(f"{p}_low")).otherwise(F.col(f"{p}_volume"))
    met = rows.join(marks, [*SERIES, "block"]).where(F.col("ts").between(F.col("ts_from"), F.col("ts_to")))
    is_spike, is_stuck = ~pick("bad") & (pick("e") > F.col("limit")), pick("v") == F.col("value_id")
    met = met.where(is_spike | is_stuck).select("candle_id", F.col("field").alias("field_name"), F.when(is_spike, "spike").otherwise("stuck").alias("kind"))
    bad: Column = F.array_compact(F.array(*(F.when(F.col(f"bad_{f}"), F.lit(f)) for f in FIELDS)))
    return met.unionByName(rows.select("candle_id", F.explode(bad).alias("field_name")).withColumn("kind", F.lit("impossible"))).distinct()


def implausible(candles: DataFrame) -> DataFrame:
    """(candle_id, field_name) of ``kinds``, each once."""
    return kinds(candles).select("candle_id", "field_name").distinct()
