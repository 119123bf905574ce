"""Per-period figures by event time, corrected by late changes up to a cut-off: lambda views.

The fast layer adds arriving changes to provisional figures. A scheduled batch recomputes the periods that are still open
from the full log, replaces their figures, and freezes periods whose cut-off has passed. A change that arrives after the
cut-off changes no figure; it is counted as cut off.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import normal
from candlewick.plans.lineage import scratch

PERIOD_S, PUBLISH_S, CLOSE_S = 300, 5, 900
STEPS = 4  # of the scheduler over a log that is replayed
KEY = ["exchange", "symbol", "period_start"]


def changes(log: DataFrame, period_s: int = PERIOD_S) -> DataFrame:
    """One row a change, with its earliest arrival. Rows lacking side, price, quantity or an instant aren't changes.

    Deliveries are reduced to the earliest before the shuffle; its key has six columns, so no source is a hot key.
    """
    s = normal.side(F.col("side"))
    kept = log.where(s.isNotNull() & F.col("price").isNotNull() & F.col("quantity").isNotNull() & F.col("ts_utc").isNotNull() & F.col("received_at").isNotNull())
    one = kept.select("exchange", "symbol", F.unix_micros("ts_utc").alias("ts"), "ingest_seq", s.alias("side"), "price", F.unix_micros("received_at").alias("at"), (F.col("quantity") <= 0).cast("int").alias("removes"))
    out = one.groupBy("exchange", "symbol", "ts", "ingest_seq", "side", "price").agg(F.min("at").alias("arrived"), F.max("removes").alias("removes"))
    return out.withColumn("period_start", _start(F.col("ts"), period_s))


def _start(ts: Column, period_s: int) -> Column:
    return normal.bucket(ts, F.lit(period_s * 1_000_000)) * F.lit(period_s)


def _due(seconds: int, period_s: int) -> Column:
    return (F.col("period_start") + F.lit(period_s + seconds)) * F.lit(1_000_000)


def view(of: DataFrame) -> DataFrame:
    """The figures of each period over the given changes. Partially aggregated, so a hot source or period sends one row a task."""
    return of.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_changes"), F.sum("removes").alias("n_removes"), F.max("ts").alias("last_ts_us"))


def period_views(log: DataFrame, period_s: int = PERIOD_S, publish_s: int = PUBLISH_S, close_s: int = CLOSE_S) -> DataFrame:
    """What the layers show of each period in the end, in one pass over the log; ``layered_views`` runs them.

    ``published``: changes in the fast view when the period was published (inclusive instant); ``final``: in the view the batch
    froze; ``corrected``: those that arrived in between; ``cut_off``: those that arrived later still and are in no view.
    A period all of whose changes came after its cut-off has final 0. Empty log: no rows.
    """
    at = F.col("arrived")
    n = lambda cond: F.count(F.when(cond, 1))
    publish, close = _due(publish_s, period_s), _due(close_s, period_s)
    return changes(log, period_s).groupBy(*KEY).agg(
        n(at <= publish).alias("published"), n(at <= close).alias("final"), n((at > publish) & (at <= close)).alias("corrected"), n(at > close).alias("cut_off")
    )


def layered_views(log: DataFrame, period_s: int = PERIOD_S, publish_s: int = PUBLISH_S, close_s: int = CLOSE_S, steps: int = STEPS) -> DataFrame:
    """The rows of ``period_views``, from the layers: the log is replayed in ``steps`` parts by arrival, until every period is closed."""
    at, ts = F.unix_micros("received_at"), F.unix_micros("ts_utc")
    first, last, ends = log.agg(F.min(at), F.max(at), F.max(_start(ts, period_s))).first()
    if first is None or ends is None:
        return period_views(log.limit(0), period_s, publish_s, close_s)
    views = LambdaViews(log.sparkSession, scratch(log.sparkSession, "views"), period_s, publish_s, close_s, log)
    for k in range(1, steps):
        views.run_batch(first + (last - first) * k // steps)
    views.run_batch(max(last, (ends + period_s + close_s) * 1_000_000))
    return views.outcome()


def period_kinds(log: DataFrame, **clock: int) -> DataFrame:
    """(exchange, symbol, period_start, kind): ``corrected`` and ``cut_off`` periods of ``layered_views``."""
    kinds = F.array_compact(F.array(F.when(F.col("corrected") > 0, "corrected"), F.when(F.col("cut_off") > 0, "cut_off")))
    return layered_views(log, **clock).select(*KEY, F.explode(kinds).alias("kind"))


class LambdaViews:
    """The layers as stored tables under ``path``: ``log`` (by day of event), ``fast/v=N`` (increments since step N), ``batch/v=N`` (open periods), ``frozen/v=N``, and ``state``.

    ``add`` and ``run_batch`` are called by the scheduler, in whatever process. A step ends with a row in ``state`` (its number and instant); tables of
    a step that isn't there aren't read, and a step that died is written anew, so it is repeated without harm. (``add`` of the same batch again counts twice
    in the provisional figures until the next step.) ``run_batch`` must not be called for an instant before which deliveries are still to be added.

    A table that holds all deliveries can be given as ``log``; it isn't copied, and ``run_batch`` writes the fast increments too, with ``n_published``.
    """

    def __init__(self, spark: SparkSession, path: str, period_s: int = PERIOD_S, publish_s: int = PUBLISH_S, close_s: int = CLOSE_S, log: DataFrame | None = None) -> None:
        self.spark, self.path, self.period_s, self.publish_s, self.close_s = spark, path.rstrip("/"), period_s, publish_s, close_s
        self.given = log

    def _read(self, name: str) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.parquet(f"{self.path}/{name}") if there else None

    def state(self) -> tuple[int, int | None]:
        """Number and instant of the last step that ended; (0, None) before the first."""
        rows = self._read("state")
        last = None if rows is None else rows.agg(F.max(F.struct("version", "now_us"))).first()[0]
        return (0, None) if last is None else (last.version, last.now_us)

    def log(self) -> DataFrame | None:
        return self._read("log") if self.given is None else self.given

    def add(self, arrived: DataFrame) -> None:
        """Fast layer: log the deliveries and add their figures to the provisional ones."""
        version, _ = self.state()
        arrived.withColumn("log_day", F.to_date("ts_utc")).write.mode("append").partitionBy("log_day").parquet(f"{self.path}/log")
        view(changes(arrived, self.period_s)).write.mode("append").parquet(f"{self.path}/fast/v={version}")

    def _open(self, log: DataFrame, before: int | None, now_us: int) -> DataFrame:
        """Deliveries up to ``now_us`` (inclusive) that came in time for a period that was open after the step before. Those of earlier periods are in ``frozen``."""
        closes = (_start(F.unix_micros("ts_utc"), self.period_s) + F.lit(self.period_s + self.close_s)) * F.lit(1_000_000)
        got = log.where((F.col("received_at") <= F.timestamp_micros(F.lit(now_us))) & (F.unix_micros("received_at") <= closes))
        if before is None:
            return got
        oldest = F.timestamp_micros(F.lit(before - (self.period_s + self.close_s) * 1_000_000))  # no open period began earlier
        got = got.where((closes > before) & (F.col("ts_utc") >= oldest))
        return got.where(F.col("log_day") >= F.to_date(oldest)) if self.given is None else got

    def run_batch(self, now_us: int) -> None:
        """Batch layer at instant ``now_us``: recompute the open periods from the log, replace them, and freeze those whose cut-off has passed.

        The log is aggregated once; of a given log the figures of changes not seen in the step before are the fast increments.
        """
        version, before = self.state()
        log = self.log()
        if log is not None:
            fresh = F.lit(True) if before is None else F.col("arrived") > before
            close, published = _due(self.close_s, self.period_s), F.col("arrived") <= _due(self.publish_s, self.period_s)
            figures = [F.count(F.lit(1)).alias("n_changes"), F.sum("removes").alias("n_removes"), F.max("ts").alias("last_ts_us")]
            increments = [F.count(F.when(fresh, 1)).alias("f_changes"), F.sum(F.when(fresh, F.col("removes"))).alias("f_removes"), F.max(F.when(fresh, F.col("ts"))).alias("f_last"), F.count(F.when(fresh & published, 1)).alias("n_published")]
            every = changes(self._open(log, before, now_us), self.period_s).groupBy(*KEY).agg(*figures, *increments)
            every.write.mode("overwrite").parquet(f"{self.path}/step/v={version + 1}")
            step = self.spark.read.schema(every.schema).parquet(f"{self.path}/step/v={version + 1}")  # a row a period
            if self.given is not None:
                new = step.where("f_changes > 0").select(*KEY, F.col("f_changes").alias("n_changes"), F.col("f_removes").alias("n_removes"), F.col("f_last").alias("last_ts_us"), "n_published")
                new.write.mode("overwrite").parquet(f"{self.path}/fast/v={version}")
            seen = step.select(*KEY, "n_changes", "n_removes", "last_ts_us")
            seen.where(close > now_us).write.mode("overwrite").parquet(f"{self.path}/batch/v={version + 1}")
            seen.where(close <= now_us).write.mode("overwrite").parquet(f"{self.path}/frozen/v={version + 1}")
        self.spark.range(1, numPartitions=1).select(F.lit(version + 1).alias("version"), F.lit(now_us).cast("bigint").alias("now_us")).write.mode("append").parquet(f"{self.path}/state")

    def cut_off(self) -> DataFrame | None:
        """(KEY..., cut_off): changes of the log that arrived after their period had closed and are in no view, also of periods that have no others."""
        log = self.log()
        if log is None:
            return None
        return changes(log, self.period_s).where(F.col("arrived") > _due(self.close_s, self.period_s)).groupBy(*KEY).agg(F.count(F.lit(1)).alias("cut_off"))

    def outcome(self) -> DataFrame:
        """Of a given log all of whose periods are closed, the columns of ``period_views``: the published view against the frozen one; changes of the log that are in neither are cut off."""
        parts = {"published": (self._read("fast"), "n_published"), "final": (self._frozen(self.state()[0]), "n_changes"), "cut_off": (self.cut_off(), "cut_off")}
        rows = None
        for name, (df, figure) in parts.items():
            part = df.select(*KEY, *(F.col(figure).alias(n) if n == name else F.lit(0).cast("bigint").alias(n) for n in parts))
            rows = part if rows is None else rows.unionByName(part)
        n = rows.groupBy(*KEY).agg(*(F.sum(x).alias(x) for x in parts))
        return n.select(*KEY, "published", "final", (F.col("final") - F.col("published")).alias("corrected"), "cut_off")

    def _frozen(self, version: int) -> DataFrame | None:
        got = self._read("frozen")
        return None if got is None else got.where(F.col("v") <= version).select(*KEY, "n_changes", "n_removes", "last_ts_us")

    def read(self) -> DataFrame:
        """Frozen periods as they are; of open ones the last batch plus the fast increments since. ``state`` says which. What was added since for a closed period shows in ``cut_off`` alone."""
        version, now = self.state()
        live = None
        for p in (self._read(f"batch/v={version}"), self._read(f"fast/v={version}")):
            if p is not None:
                p = p.select(*KEY, "n_changes", "n_removes", "last_ts_us")
                live = p if live is None else live.unionByName(p)
        frozen = self._frozen(version)
        if live is not None:
            live = live if now is None else live.where(_due(self.close_s, self.period_s) > now)
            live = live.groupBy(*KEY).agg(F.sum("n_changes").alias("n_changes"), F.sum("n_removes").alias("n_removes"), F.max("last_ts_us").alias("last_ts_us")).withColumn("state", F.lit("provisional"))
        if frozen is None:
            return live
        frozen = frozen.withColumn("state", F.lit("frozen"))
        return frozen if live is None else frozen.unionByName(live)
