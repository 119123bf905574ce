"""Data quality of candles and events: predicates, gaps, and the checks that depend on what was accepted before."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import hashing, normal
from candlewick.operators import walks

# The fields a candle must have.
REQUIRED = ("ts_utc", "exchange", "symbol", "timeframe", "open", "high", "low", "close", "volume")
# What each reason leads to under the quarantining policy.
DECISIONS = {"SCHEMA_MISMATCH": "HALT", "GAP": "HALT", "VALUE_OUT_OF_RANGE": "QUARANTINE", "DUPLICATE_DIFFERENT_HASH": "QUARANTINE", "VALUE_ABSENCE": "QUARANTINE", "ACTIVE_ACTIVE_MISMATCH": "QUARANTINE"}


def lacks_field() -> Column:
    out = F.lit(False)
    for c in REQUIRED:
        out = out | F.col(c).isNull()
    return out


def out_of_range() -> Column:
    """A price not above zero, a negative volume, or a high or low that doesn't enclose open and close; false where that can't be told."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return F.coalesce((F.least(o, h, lo, c) <= 0) | (F.col("volume") < 0) | (h < F.greatest(o, c, lo)) | (lo > F.least(o, c)), F.lit(False))


def decision(reason: Column, policy: str = "quarantine") -> Column:
    """HALT for every reason under ``halt``, SKIP under ``skip``, else as ``DECISIONS`` says; null stays null."""
    if policy not in ("halt", "skip", "quarantine"):
        raise ValueError(f"unknown policy: {policy!r}")
    if policy != "quarantine":
        return F.when(reason.isNotNull(), policy.upper())
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in DECISIONS.items() for x in kv)), reason)


def provenance(ts: Column, cutoff: str) -> Column:
    """Which derivation a candle comes from: before the cut-off (the first instant of a month) the legacy one."""
    if not cutoff[7:].startswith("-01") or cutoff[10:].strip("T 0:Z+.") not in ("",):
        raise ValueError("the cut-off must be the first instant of a month")
    return F.when(ts < F.to_timestamp(F.lit(cutoff)), "legacy_candle").otherwise("transaction_derived")


def allowed(rows: DataFrame, allowlist: Sequence[tuple[str, ...]], columns: Sequence[str] = ("exchange", "channel")) -> tuple[DataFrame, DataFrame]:
    """(kept, refused): rows whose ``columns`` are one of the combinations of the list (a configuration), and the others, with ``reason``: ``UNKNOWN`` and the first column whose value the list doesn't know at all, or ``UNSUPPORTED``. Null is never known."""
    known = F.lit(False)
    for combination in allowlist:
        one = F.lit(True)
        for c, v in zip(columns, combination, strict=True):
            one = one & F.col(c).eqNullSafe(F.lit(v))
        known = known | one
    reason = F.lit("UNSUPPORTED")
    for c, values in reversed([(c, sorted({a[i] for a in allowlist})) for i, c in enumerate(columns)]):
        reason = F.when(~F.coalesce(F.col(c).isin(values), F.lit(False)), f"UNKNOWN {c}").otherwise(reason)
    return rows.where(known), rows.where(~known).withColumn("reason", reason)


def require_allowed(values: Sequence[str], allowlist: Sequence[tuple[str, ...]], columns: Sequence[str] = ("exchange", "channel")) -> None:
    """Raises unless one combination is listed, and says which value is unknown."""
    if tuple(values) in set(map(tuple, allowlist)):
        return
    for i, (c, v) in enumerate(zip(columns, values, strict=True)):
        if v not in {a[i] for a in allowlist}:
            raise ValueError(f"unknown {c} {v!r}; known: {', '.join(sorted({a[i] for a in allowlist}))}")
    raise ValueError(f"unsupported combination of {', '.join(columns)}: {', '.join(values)}")


def closed_days(rows: DataFrame, today: Column | str, day: str = "date") -> DataFrame:
    """Rows of days before ``today`` (UTC); a day that is null or isn't one is left out."""
    limit = F.to_date(F.lit(today)) if isinstance(today, str) else today
    return rows.where(F.col(day).cast("string").try_cast("date") < limit)


def redacted(rows: DataFrame, keep_chars: int | None = None, column: str = "raw_json") -> DataFrame:
    """Rows without raw payloads, or with ``keep_chars`` with what is longer cut and marked with its length."""
    if column not in rows.columns:
        return rows
    if keep_chars is None:
        return rows.drop(column)
    c = F.col(column)
    cut = F.concat(F.left(c, F.lit(keep_chars)), F.lit(" [truncated, len="), F.length(c).cast("string"), F.lit("]"))
    return rows.withColumn(column, F.when(F.length(c) > keep_chars, cut).otherwise(c))


def bucketed_gaps(rows: DataFrame, series: Sequence[str], ts: str, threshold_s: float | Column) -> DataFrame:
    """(series..., after_ts, before_ts, gap_s): consecutive distinct instants more than ``threshold_s`` apart; it may differ between series.

    Buckets are ``threshold_s`` wide, so a gap always spans two buckets; each bucket is reduced to its first and last instant before the shuffle, and only
    those meet in one task a series. Rows without an instant play no part.
    """
    limit = F.greatest((threshold_s.cast("double") * 1e6).cast("bigint"), F.lit(1)) if isinstance(threshold_s, Column) else F.lit(max(int(threshold_s * 1_000_000), 1)).cast("bigint")
    placed = rows.where(F.col(ts).isNotNull()).select(*series, ts, limit.alias("_limit"))
    ends = placed.groupBy(*series, normal.bucket(F.unix_micros(ts), F.col("_limit")).alias("bucket")).agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.max("_limit").alias("_limit"))
    w = Window.partitionBy(*series).orderBy("bucket")
    d = F.unix_micros("first") - F.unix_micros("after_ts")
    return ends.withColumn("after_ts", F.lag("last").over(w)).where(d > F.col("_limit")).select(*series, "after_ts", F.col("first").alias("before_ts"), (d / F.lit(1e6)).alias("gap_s"))


def unordered(rows: DataFrame, series: Sequence[str], ts: str, position: str, width: int = 100_000) -> DataFrame:
    """(series..., n_rows, n_steps_back): how often an instant is before the one at the position before it; equal ones are in order.

    Positions (whole numbers) are looked at in parts of ``width``; the ends of the parts, one row each, are compared along the series.
    """
    placed = rows.select(*series, ts, position, normal.bucket(F.col(position).cast("bigint"), width).alias("_part"))
    inside = Window.partitionBy(*series, "_part").orderBy(position)
    at = F.struct(F.col(position), F.col(ts))
    parts = placed.withColumn("_back", (F.col(ts) < F.lag(ts).over(inside)).cast("int")).groupBy(*series, "_part")
    ends = parts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_back"), F.lit(0)).alias("back"), F.min(at)[ts].alias("first"), F.max(at)[ts].alias("last"))
    along = Window.partitionBy(*series).orderBy("_part")
    step = F.when(F.col("first") < F.lag("last").over(along), 1).otherwise(0)
    return ends.withColumn("_step", step).groupBy(*series).agg(F.sum("n").alias("n_rows"), F.sum(F.col("back") + F.col("_step")).alias("n_steps_back"))


def ordered_or_quarantined(rows: DataFrame, series: Sequence[str], ts: str, position: str) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): series in which an instant steps back go to quarantine as a whole, with reason ``NOT_MONOTONIC``."""
    bad = unordered(rows, series, ts, position).where("n_steps_back > 0").select(*(F.col(s).alias(f"_q_{s}") for s in series))
    met = F.lit(True)
    for s in series:
        met = met & F.col(s).eqNullSafe(F.col(f"_q_{s}"))
    return rows.join(bad, met, "left_anti"), rows.join(bad, met, "left_semi").withColumn("reason", F.lit("NOT_MONOTONIC"))


def policy_pipeline(candles: DataFrame, tie: str) -> DataFrame:
    """(candle_id, outcome): in order of instant, ``tie`` and id along each series, null fields, gaps, ranges and duplicates are checked.

    ``accepted``, ``DUPLICATE_SAME_HASH`` or the reason of rejection. A rejected candle isn't what the next is compared with, so after a gap everything later is a
    gap too: all that matters of a series is the last instant before its first gap. That comes from the ends of buckets, the accepted candle of an instant from an
    aggregate with the instant in its key; no series is walked.
    """
    key = ["exchange", "symbol", "timeframe"]
    checked = candles.select(
        "candle_id", *key, "ts_utc", F.col(tie).alias("tie"), F.when(lacks_field(), "SCHEMA_MISMATCH").alias("schema"),
        F.when(out_of_range(), "VALUE_OUT_OF_RANGE").alias("range"), hashing.candle_policy_hash().alias("hash"), (F.coalesce(normal.timeframe_seconds(F.col("timeframe")), F.lit(60))).alias("bar"),
    )
    whole = checked.where("schema is null")  # none of the key columns is null here
    good = whole.where("range is null")
    first = good.groupBy(*key, "ts_utc").agg(F.min(F.struct("tie", "candle_id", "hash")).alias("first"))
    broken = bucketed_gaps(good, [*key, "bar"], "ts_utc", F.col("bar")).groupBy(*key).agg(F.min("after_ts").alias("broken"))
    ends = good.groupBy(*key).agg(F.max("ts_utc").alias("end")).join(broken, key, "left").select(*key, F.coalesce("broken", "end").alias("last"))  # a row a series
    judged = whole.join(first, [*key, "ts_utc"], "left").join(ends, key, "left")
    late = F.unix_micros("ts_utc") - F.unix_micros("last") > F.col("bar") * 1_000_000
    outcome = (
        F.when(F.coalesce(late, F.lit(False)), "GAP").when(F.col("range").isNotNull(), F.col("range")).when(F.col("candle_id") == F.col("first.candle_id"), "accepted")
        .when(F.col("hash") == F.col("first.hash"), "DUPLICATE_SAME_HASH").otherwise("DUPLICATE_DIFFERENT_HASH")
    )
    return judged.select("candle_id", outcome.alias("outcome")).unionByName(checked.where("schema is not null").select("candle_id", F.col("schema").alias("outcome")))


def throttled(rows: DataFrame, series: Sequence[str], ts: str, seconds: float, tie: str, bucket_s: int = 3600) -> DataFrame:
    """Rows at least ``seconds`` after the last accepted one of their series; the first is accepted. Rows without an instant aren't."""
    us = F.unix_micros(ts)
    timed = rows.where(F.col(ts).isNotNull())
    block = walks.time_blocks(timed, series, ts, max(bucket_s, int(seconds * 64) + 1))
    return walks.events(timed, series, [ts, tie], us, max(int(seconds * 1_000_000), 1), False, block, ("__ok", "__n")).where("__ok = 1").drop("__ok", "__n")


def blocked(rows: DataFrame, series: Sequence[str], ts: str, ratio: str, high: float, gap: float, tie: str, bucket_s: int = 3600) -> DataFrame:
    """``rows`` with ``blocked``: true from the row whose ratio reaches ``high`` until one falls below ``high - gap``. A null ratio changes nothing."""
    x = F.col(ratio)
    decides = F.when(x >= high, True).when(x < high - gap, False)
    us = F.unix_micros(ts) if dict(rows.dtypes)[ts] == "timestamp" else F.col(ts).cast("bigint") * 1_000_000  # whole seconds will do too
    return walks.followed(rows, series, [ts, tie], decides, normal.bucket(us, bucket_s * 1_000_000), "blocked", F.lit(False))
