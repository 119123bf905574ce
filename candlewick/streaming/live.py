"""The same operators on streams: log routing, micro-batch compaction, incremental bars, replica dedup."""

import time
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from candlewick.operators import bars, tiers
from candlewick.sources import catalog

BAR = "bar_label string, exchange string, symbol string, genesis_us bigint, close_us bigint, open string, high string, low string, close string, volume string, value string, n_ticks bigint"
_STATE = "window bigint, first_us bigint, last_us bigint, open string, high string, low string, close string, volume string, value string, n bigint"


def wal_stream(spark: SparkSession, path: str, channel: str, files_per_batch: int = 1000) -> DataFrame:
    """Records of one channel from sealed segments as they appear; the checkpoint knows which were read."""
    raw = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.sealed").option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True)
    return catalog.numbered_lines(raw.select("value", F.col("_metadata.file_path").alias("file")), channel)


def compact_stream(stream: DataFrame, out: str, checkpoint: str, channel: str, trigger: dict | None = None) -> StreamingQuery:
    """L1 as a stream: each micro-batch writes its segments by ``write_l1``, so a batch that is run again after a failure replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            tiers.write_l1(tiers.rows_of(batch, channel, "file"), out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def merge_stream(spark: SparkSession, source: str, out: str, checkpoint: str, unit: str, trigger: dict | None = None) -> StreamingQuery:
    """L2 or L3 as a scheduled job: whenever the tier below has new files, the hours or days they belong to are read whole and replaced."""
    schema = spark.read.parquet(source).schema
    keys = ["exchange", "symbol", "date", *(["hour"] if unit == "hour" else [])]
    fresh = tiers.merged(spark.readStream.schema(schema).parquet(source), unit).select(*keys)

    def write(batch: DataFrame, number: int) -> None:
        touched = batch.distinct()
        if touched.isEmpty():
            return
        days = [r.date for r in touched.select("date").distinct().collect()]  # of one batch; they prune the folders that are read
        rows = tiers.merged(spark.read.parquet(source).where(F.col("date").cast("date").isin(days) if unit == "day" else F.lit(True)).drop("hour", "segment"), unit)
        tiers.write_merged(rows.join(touched, keys, "left_semi").drop("date", "hour"), out, unit)

    return fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_rows(stream: DataFrame, out: str, checkpoint: str, delay_s: int, trigger: dict | None = None) -> StreamingQuery:
    """Rows that arrived more than ``delay_s`` after their instant, appended to a table of their own: what ``watermarked_bars`` may have dropped can be merged from there."""
    late = stream.where(F.unix_micros("received_at") - F.unix_micros("ts_utc") > delay_s * 1_000_000).withColumn("late_day", F.to_date("ts_utc"))
    return late.writeStream.partitionBy("late_day").option("path", out).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def coverage_counters(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """(symbol, tier, day, row_count, byte_count, last_event_ts) as they grow; rows need symbol, tier, ts_utc and bytes (null counts as 0)."""
    return stream.withWatermark("ts_utc", delay).groupBy("symbol", "tier", F.window("ts_utc", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("byte_count"), F.max("ts_utc").alias("last_event_ts")
    ).select("symbol", "tier", F.to_date("w.start").alias("day"), "row_count", "byte_count", "last_event_ts")


def restarting(start: Callable[[], StreamingQuery], waits_s: Sequence[float] = (5, 30, 120), sleep: Callable[[float], None] = time.sleep) -> int:
    """Runs a query to its end; after a failure it is started again from its checkpoint, after waiting; the last wait's failure is raised. Returns how many restarts it took."""
    for n, wait in enumerate((*waits_s, None)):
        try:
            start().awaitTermination()
            return n
        except StreamingQueryException:
            if wait is None:
                raise
            sleep(wait)
    return len(waits_s)


def without_replicas(ticks: DataFrame, key: tuple[str, ...], delay: str = "10 minutes") -> DataFrame:
    """One delivery of each tick; deliveries later than ``delay`` behind the newest instant may pass again."""
    return ticks.withWatermark("ts_utc", delay).dropDuplicatesWithinWatermark(list(key))


def watermarked_bars(ticks: DataFrame, seconds: int, delay: str) -> DataFrame:
    """Time bars that are final once the watermark has passed them; later ticks are dropped. Windows without ticks give none."""
    notional = F.col("price").cast(bars.PRICE) * F.col("quantity").cast(bars.QUANTITY)
    order = F.struct("ts_utc", "seq")
    w = F.window("ts_utc", f"{seconds} seconds").alias("w")
    got = ticks.withWatermark("ts_utc", delay).groupBy(w, "exchange", "symbol").agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("quantity").alias("volume"), F.sum(notional).alias("value"), F.count(F.lit(1)).alias("n_ticks")
    )
    return got.select(F.col("w.start").alias("genesis_ts"), F.col("w.end").alias("ts_close"), "exchange", "symbol", "open", "high", "low", "close", "volume", "value", "n_ticks")


def incremental_bars(ticks: DataFrame, label: str) -> DataFrame:
    """Bars of any kind, emitted when a tick closes one, as the batch operators define them; state is the open bar of each series.

    A micro-batch is put in order before it is applied. A tick older than the open time bar merges into it, since what was emitted stays.
    """
    rule = bars.parse_label(label)
    width = rule.threshold * 1_000_000
    need = Decimal(rule.threshold)
    flat = ticks.select("exchange", "symbol", F.unix_micros("ts_utc").alias("us"), "seq", F.col("price").cast(bars.PRICE).cast("string").alias("price"), F.col("quantity").cast(bars.QUANTITY).cast("string").alias("quantity"))

    def apply(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["us", "seq"])
        bar = list(state.get) if state.exists else None
        out = []

        def emit(b: list, close: int) -> None:
            out.append((label, key[0], key[1], b[0] * width if rule.kind == "time" else b[1], close, *b[3:9], b[9]))

        for us, price, quantity in zip(rows["us"].tolist(), rows["price"], rows["quantity"], strict=True):
            p, q = Decimal(price), Decimal(quantity)
            if rule.kind == "time" and bar is not None and us // width > bar[0]:
                emit(bar, (bar[0] + 1) * width)
                bar = None
            if bar is None:
                bar = [us // width, us, us, price, price, price, price, "0", "0", 0]
            high, low = max(Decimal(bar[4]), p), min(Decimal(bar[5]), p)
            bar = [bar[0], bar[1], max(bar[2], us), bar[3], str(high), str(low), price, str(Decimal(bar[7]) + q), str(Decimal(bar[8]) + p * q), bar[9] + 1]
            full = {"time": False, "tick": bar[9] >= rule.threshold, "vol": Decimal(bar[7]) >= need, "dollar": Decimal(bar[8]) >= need}[rule.kind]
            if full:
                emit(bar, bar[2] if bar[2] > bar[1] else bar[1] + 1)
                bar = None
        if bar is None:
            if state.exists:
                state.remove()
        else:
            state.update(tuple(bar))
        if out:
            yield pd.DataFrame(out, columns=[x.split()[0] for x in BAR.split(", ")])

    return flat.groupBy("exchange", "symbol").applyInPandasWithState(apply, BAR, _STATE, "append", GroupStateTimeout.NoTimeout)


def append_log(stream: DataFrame, wal: str, channel: str, node: str, checkpoint: str, seconds: int = 300, trigger: dict | None = None) -> StreamingQuery:
    """Records of a channel as sealed log segments, one a series and micro-batch: ``<exchange>/<channel>/<symbol>/<day>/segment-<batch>-<node>.ndjson.sealed``.

    A batch is by default what arrives in ``seconds`` of processing time. One that is run again writes the same names again, so the log holds each once. Rows need exchange and symbol.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("channel", F.lit(channel))
        day = F.date_format(F.current_timestamp() if "received_at" not in batch.columns else F.coalesce("received_at", F.current_timestamp()), "yyyy-MM-dd")
        keyed = rows.select("exchange", "symbol", day.alias("day"), F.to_json(F.struct(*rows.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))
        beside = f"{wal}/_batch-{channel}-{node}-{number}"
        keyed.repartition("exchange", "symbol", "day").write.mode("overwrite").partitionBy("exchange", "symbol", "day").text(beside)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = lambda x: jvm.org.apache.hadoop.fs.Path(x)
        fs = path(wal).getFileSystem(conf)
        for f in fs.globStatus(path(f"{beside}/exchange=*/symbol=*/day=*/part-*")) or []:  # a file a series of the batch
            parts = dict(x.split("=", 1) for x in f.getPath().toString().split("/") if "=" in x)
            folder = f"{wal}/{parts['exchange']}/{channel}/{parts['symbol']}/{parts['day']}"
            target = path(f"{folder}/segment-{number:012d}-{node}.ndjson.sealed")
            fs.mkdirs(path(folder))
            fs.delete(target, False)
            if not fs.rename(f.getPath(), target):
                raise OSError(f"can't seal {target}")
        fs.delete(path(beside), True)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": f"{seconds} seconds"})).start()


def retrying(publish: Callable[[DataFrame, int], None], tries: int = 5, wait_s: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame, int], None]:
    """``publish`` tried several times, the waits doubling; the last failure is raised, and the stream stops at this batch rather than drop it."""

    def run(batch: DataFrame, number: int) -> None:
        for n in range(tries):
            try:
                return publish(batch, number)
            except Exception:
                if n == tries - 1:
                    raise
                sleep(wait_s * 2**n)

    return run


class Progress(StreamingQueryListener):
    """The latest figures of each query: rows in, rows a second, milliseconds a batch, and how often queries ended in failure. ``spark.streams.addListener(Progress())``."""

    def __init__(self) -> None:
        self.latest: dict[str, dict] = {}
        self.failures = 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.latest.setdefault(str(event.name or event.id), {})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        have = self.latest.setdefault(str(p.name or p.id), {})
        have.update({"batch": p.batchId, "rows": have.get("rows", 0) + p.numInputRows, "rows_per_second": p.processedRowsPerSecond, "batch_ms": p.batchDuration})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.failures += event.exception is not None


def alternate_sink(stream: DataFrame, checkpoint: str, publish, trigger: dict | None = None) -> StreamingQuery:
    """Hands each micro-batch and its number to ``publish`` (a message broker, a second store); numbers repeat after failures."""
    return stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
