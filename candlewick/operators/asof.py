"""As-of joins: to each left row the latest right row of its key at or before its instant."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import normal


def asof(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str, right_ts: str, take: Sequence[str], bucket_s: int | None = 7 * 86_400) -> DataFrame:
    """``left`` with the ``take`` columns of the last right row (named ``asof_...``) with right_ts <= left_ts; null where there is none.

    Both sides are put on one time line and the last right row is carried forward: one shuffle, no join. Of right rows at one instant the one with the
    greatest ``take`` values counts. Null instants match nothing. A key may hold a third of all rows, so the time line of each
    key is cut into buckets of ``bucket_s``, each carried forward by itself, and the last right row of earlier buckets is filled in from a table of one
    row a bucket. None carries each key forward as a whole, which saves that join where keys are small.
    """
    names = [f"asof_{c}" for c in take]
    value = F.struct(F.col(right_ts).alias("_at"), *(F.col(c).alias(n) for c, n in zip(take, names, strict=True)))
    cols = left.columns
    r = right.where(F.col(right_ts).isNotNull()).groupBy(*key, right_ts).agg(F.max(value).alias("_value"))
    r = r.select(*(F.col(k).alias(f"_k_{k}") for k in key), F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), "_value", F.lit(None).cast(left.schema).alias("_left"))
    a = left.select(*(F.col(k).alias(f"_k_{k}") for k in key), F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_value"].dataType).alias("_value"), F.struct(*cols).alias("_left"))
    keys = [f"_k_{k}" for k in key]
    both = r.unionByName(a)
    part = keys
    if bucket_s:
        both = both.withColumn("_bucket", normal.bucket(F.unix_micros("_ts"), F.lit(bucket_s * 1_000_000)))
        part = [*keys, "_bucket"]
    w = Window.partitionBy(*part).orderBy("_ts", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_value", F.last("_value", ignorenulls=True).over(w))
    if bucket_s:
        ends = both.groupBy(*part).agg(F.max("_value").alias("_end"))
        prior = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn("_prior", F.last("_end", ignorenulls=True).over(prior)).drop("_end").withColumnsRenamed({c: f"_r{c}" for c in part})
        met = F.lit(True)
        for c in part:
            met = met & F.col(c).eqNullSafe(F.col(f"_r{c}"))
        carried = carried.where("_side = 1").join(ends, met, "left").withColumn("_value", F.coalesce("_value", "_prior"))
    picked = carried.where("_side = 1").withColumn("_value", F.when(F.col("_ts").isNotNull(), F.col("_value")))
    return picked.select(*(F.col(f"_left.{c}").alias(c) for c in cols), *(F.col(f"_value.{n}").alias(n) for n in names))


def at_instant(right: DataFrame, key: Sequence[str], ts: str, instant: str) -> DataFrame:
    """The latest row of each key at or before one instant (no lookahead)."""
    known = right.where(F.col(ts) <= F.to_timestamp(F.lit(instant)))
    rest = [c for c in right.columns if c not in key]
    return known.groupBy(*key).agg(F.max(F.struct(F.col(ts).alias("_order"), *rest)).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in rest))
