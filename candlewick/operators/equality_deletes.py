"""Current state from a feed of inserts, updates and deletes: equality-delete files with sequence numbers.

A change never rewrites what is stored. It appends (a) to the data files a row, if it sets a value, and (b) to the delete
files its key. Both carry the change's sequence number. A reader drops each row for whose key there is a later delete.
Order comes from the sequence number alone, so that repeated, late and out-of-order changes need no care when appended.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import normal


@dataclass(frozen=True)
class Feed:
    """How to read changes: expressions for key columns, sequence numbers (most significant first) and deletion.

    ``row_id`` is unique; of changes with equal sequence numbers (repeated deliveries) the smallest ``row_id`` counts.
    """

    key: dict[str, Column]
    sequence: tuple[Column, ...]
    row_id: str
    valid: Column
    deletes: Column
    payload: dict[str, Column] = field(default_factory=dict)  # other columns of a row, carried with inserts


def depth_feed(payload: bool = False) -> Feed:
    """``orderbook_depth.v1``: a row sets one level; quantity 0 (or less) removes it. Rows lacking side, price or quantity aren't changes. ``payload`` carries the quantity."""
    return Feed(
        key={"exchange": F.col("exchange"), "symbol": F.col("symbol"), "side": normal.side(F.col("side")), "price": F.col("price")},
        sequence=(F.unix_micros("ts_utc"), F.col("ingest_seq")),
        row_id="depth_id",
        valid=normal.side(F.col("side")).isNotNull() & F.col("price").isNotNull() & F.col("quantity").isNotNull() & F.col("ts_utc").isNotNull(),
        deletes=F.col("quantity") <= 0,
        payload={"quantity": F.col("quantity")} if payload else {},
    )


def _seq(feed: Feed) -> Column:
    least = F.lit(-(2**63))
    parts = [F.coalesce(c.cast("bigint"), least).alias(f"s{i}") for i, c in enumerate(feed.sequence)]
    return F.struct(*parts, (-F.col(feed.row_id)).alias("row"))


def split(changes: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """(inserts, deletes) of the changes, as they are appended: key columns named ``k_...``, ``seq``, and of inserts ``p_...``.

    An update is a delete of the key's earlier rows and an insert, so every change yields a delete key. A null key part is a
    value of its own. Other columns of ``changes`` play no part, whatever their names.
    """
    keys = [c.alias(f"k_{n}") for n, c in feed.key.items()]
    kept = changes.where(feed.valid)
    payload = [c.alias(f"p_{n}") for n, c in feed.payload.items()]
    return kept.where(~feed.deletes).select(*keys, _seq(feed).alias("seq"), *payload), kept.select(*keys, _seq(feed).alias("seq"))


def read_current(inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """Rows of ``inserts`` for whose key ``deletes`` has no later sequence number: key columns and ``seq``, one row a key.

    Of the inserts of one key only the last can survive, and of its deletes only the last matters; both are reduced to
    those before the shuffle (partial aggregation), so a key with a third of all changes sends one row a task.
    """
    keys, payload = ([c for c in inserts.columns if c.startswith(p)] for p in ("k_", "p_"))
    if payload:  # travels in the struct that the maximum is taken of
        last = inserts.groupBy(*keys).agg(F.max(F.struct("seq", *payload)).alias("r")).select(*keys, "r.*")
    else:
        last = inserts.groupBy(*keys).agg(F.max("seq").alias("seq"))
    gone = deletes.groupBy(*keys).agg(F.max("seq").alias("later")).select(*(F.col(k).alias(f"d_{k}") for k in keys), "later")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"d_{k}"))
    return last.join(gone, same & (F.col("later") > F.col("seq")), "left_anti")


def current_rows(changes: DataFrame, feed: Feed | None = None) -> DataFrame:
    """The surviving ``row_id`` of each key, with the key's columns and the payload. Empty changes give an empty result."""
    feed = feed or depth_feed()
    return _named(read_current(*split(changes, feed)), feed)


def _named(out: DataFrame, feed: Feed) -> DataFrame:
    return out.select((-F.col("seq.row")).alias(feed.row_id), *(F.col(f"k_{n}").alias(n) for n in feed.key), *(F.col(f"p_{n}").alias(n) for n in feed.payload))


class EqualityDeleteTable:
    """The same on disk: ``data`` and ``deletes`` are append-only Parquet folders; ``compact`` merges them."""

    def __init__(self, spark: SparkSession, path: str, feed: Feed | None = None) -> None:
        self.spark, self.path, self.feed = spark, path.rstrip("/"), feed or depth_feed()

    def append(self, changes: DataFrame) -> None:
        """Deletes are appended first: should the job die in between, appending the same batch again changes nothing."""
        inserts, deletes = split(changes, self.feed)
        deletes.write.mode("append").parquet(f"{self.path}/deletes")
        inserts.write.mode("append").parquet(f"{self.path}/data")

    def read(self) -> DataFrame:
        got = self.spark.read.parquet
        return _named(read_current(got(f"{self.path}/data"), got(f"{self.path}/deletes")), self.feed)

    def compact(self, target: str) -> "EqualityDeleteTable":
        """A new table with one row and one delete key a key; the delete keys stay, for changes that arrive still later."""
        got = self.spark.read.parquet
        data, deletes = got(f"{self.path}/data"), got(f"{self.path}/deletes")
        keys = [c for c in data.columns if c.startswith("k_")]
        read_current(data, deletes).write.parquet(f"{target}/data")
        deletes.groupBy(*keys).agg(F.max("seq").alias("seq")).write.parquet(f"{target}/deletes")
        return EqualityDeleteTable(self.spark, target, self.feed)
