"""History of changing attributes: a type-two dimension kept by merging dated snapshots.

A snapshot's attribute hash is compared with the current version's; a changed version is closed with an end date and a new
open version is inserted. A batch may hold many dates: the comparisons then run along each entity's dates in one pass.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("exchange", "symbol")
ATTRIBUTES = ("tick_size", "fee_maker", "asset_status")


def attribute_hash(names: Sequence[str]) -> Column:
    """Digest over all attributes; null differs from every value. Decimals have one scale here, so equal values have equal text."""
    parts = [F.when(F.col(n).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(n).cast("string"))) for n in names]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def daily(snapshots: DataFrame, key: Sequence[str] = KEY, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """One row an entity and date: that of the latest ``fetched_at`` (null is earliest; of equal ones the greatest values count).

    Text attributes are trimmed, blank ones are null. Rows without a date are dropped. Repeated rows are reduced before the shuffle.
    """
    kind = dict(snapshots.dtypes)
    clean = [(F.when(F.trim(a) != "", F.trim(a)) if kind[a] == "string" else F.col(a)).alias(a) for a in attributes]
    flat = snapshots.where(F.col("fetched_date").isNotNull()).select(*key, F.col("fetched_date").alias("date"), F.struct("fetched_at", *clean).alias("row"))
    last = flat.groupBy(*key, "date").agg(F.max("row").alias("row"))
    return last.select(*key, "date", *(F.col(f"row.{a}").alias(a) for a in attributes))


def merge(dimension: DataFrame | None, snapshots: DataFrame, key: Sequence[str] = KEY, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """The dimension (key, attributes, attribute_hash, valid_from, valid_to) after merging a batch of snapshots.

    ``valid_to`` of an open version is null. A null attribute means not fetched: the value known from earlier dates stays, and
    before any is known it is null, which is a version too. A return to earlier values is a new version. Snapshots dated before
    the current version's start can't be merged (the rows that followed them are gone); they leave the dimension as it is: for
    these, merge the whole log into an empty dimension. After the reduction to one row a date, an entity has as many rows as
    there are dates, however many rows its snapshots had.
    """
    new = daily(snapshots, key, attributes).withColumn("held", F.lit(0))
    closed = None
    if dimension is not None:
        closed = dimension.where(F.col("valid_to").isNotNull())
        new = new.unionByName(dimension.where(F.col("valid_to").isNull()).select(*key, F.col("valid_from").alias("date"), *attributes, F.lit(1).alias("held")))
    along = Window.partitionBy(*key).orderBy("date", F.desc("held"))
    past = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*key)
    start = F.max(F.when(F.col("held") == 1, F.col("date"))).over(whole)
    states = new.withColumn("start", start).where(F.col("start").isNull() | (F.col("date") >= F.col("start")))
    states = states.withColumns({a: F.last(a, ignorenulls=True).over(past) for a in attributes})
    if dimension is not None:  # a snapshot of the very day on which the version began replaces it
        states = states.withColumn("next", F.lead("date").over(along)).where(F.col("next").isNull() | (F.col("next") != F.col("date")))
    states = states.withColumn("attribute_hash", attribute_hash(attributes))
    before = F.lag("attribute_hash").over(along)
    first = states.withColumn("before", before).where(F.col("before").isNull() | (F.col("before") != F.col("attribute_hash")))
    ended = F.date_sub(F.lead("date").over(along), 1)
    out = first.select(*key, *attributes, "attribute_hash", F.col("date").alias("valid_from"), ended.alias("valid_to"))
    return out if closed is None else closed.select(*out.columns).unionByName(out)


def history(snapshots: DataFrame, key: Sequence[str] = KEY, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """All versions, from the whole log merged into an empty dimension."""
    return merge(None, snapshots, key, attributes)
