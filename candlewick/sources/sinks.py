"""Writers. Partitions come from each row, never from the first of a batch; writing a batch again changes nothing."""

import hashlib
import json
import os
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions import hashing, paths
from candlewick.plans import placement
from candlewick.plans.lineage import cut, stored
from candlewick.sources import catalog


def storable(candles: DataFrame, snapshot_id: str) -> DataFrame:
    """Candles with the columns that storage adds: completeness, version, instant of writing, hash."""
    have = candles.columns
    add = {
        "is_complete": F.lit(True), "trade_count": F.lit(None).cast("bigint"), "value": F.lit(None).cast(schemas.DEC), "schema_version": F.lit("ohlcv.v1"),
        "source_ingested_at": F.current_timestamp(), "data_snapshot_id": F.lit(snapshot_id), "data_hash": hashing.candle_hash(),
    }
    return candles.withColumns({k: v for k, v in add.items() if k not in have}).select(*schemas.schema("ohlcv.v1").names)


def write_candles(candles: DataFrame, root: str, snapshot_id: str, mode: str | None = None) -> None:
    """Appends candles whose hash isn't stored yet, partitioned by exchange, symbol, timeframe, year, month and day of month of each row."""
    spark = candles.sparkSession
    base = f"{root}/market/ohlcv/schema_version=ohlcv.v1" + (f"/mode={mode}" if mode else "")
    rows = storable(candles, snapshot_id)
    schemas.reject_floats(rows.schema)
    parts = {"year": F.date_format("ts_utc", "yyyy"), "month": F.date_format("ts_utc", "MM"), "date": F.date_format("ts_utc", "dd")}
    keys = ["exchange", "symbol", "timeframe", *parts]
    if catalog.exists(spark, base):
        first, last = rows.agg(F.min(F.to_date("ts_utc")), F.max(F.to_date("ts_utc"))).first()
        series = rows.select("exchange", "symbol", "timeframe").distinct().collect()  # of one batch
        roots = [f"{base}/exchange={r.exchange}/symbol={r.symbol}/timeframe={r.timeframe}" for r in series]
        old = catalog.read(spark, roots, "ohlcv.v1", first, last) if first else None  # only the folders that the batch goes to
        if old is not None:
            same = ["exchange", "symbol", "timeframe", "ts_utc", "data_hash"]
            rows = rows.join(old.select(*same), same, "left_anti").select(*rows.columns)
    placement.by_time(stored(rows.withColumns(parts), "batch"), base, keys, "ts_utc", ["ts_utc"], span_s=3600)


def write_paper_candles(candles: DataFrame, root: str, run_id: str, snapshot_id: str, lineage: dict) -> None:
    """Candles of a paper run under ``mode=paper``, and the run's lineage beside them. Run and snapshot must be named."""
    if not run_id or not snapshot_id:
        raise ValueError("a paper run needs a run id and a snapshot id")
    write_candles(candles, root, snapshot_id, mode="paper")
    write_json(f"{root}/market/lineage/run={paths.safe(run_id)}.json", {**lineage, "run_id": run_id, "snapshot_id": snapshot_id})


def write_metadata(rows: DataFrame, root: str) -> DataFrame:
    """Stores the first row of each (exchange, symbol, day) that isn't stored yet, quarantines rows that differ from it; returns counts an outcome."""
    spark = rows.sparkSession
    base = f"{root}/market/exchange_metadata/schema_version=exchange_metadata.v1"
    names = schemas.schema("exchange_metadata.v1").names
    key = ["exchange", "symbol", "fetched_date"]
    first_day, last_day = rows.agg(F.min("fetched_date"), F.max("fetched_date")).first()
    venues = [r.exchange for r in rows.select("exchange").distinct().collect()]  # of one batch
    old = catalog.read(spark, [f"{base}/exchange={e}" for e in venues], "exchange_metadata.v1", first_day, last_day) if first_day else None
    every = rows.select(*names).withColumn("_old", F.lit(False))
    if old is not None:
        every = every.unionByName(old.select(*names).withColumn("_old", F.lit(True)))
    first = every.groupBy(*key).agg(F.min(F.struct(~F.col("_old"), "fetched_at", "data_hash")).alias("_first"), F.max("_old").alias("_have"))
    own = rows.select(*names).distinct().join(first, key)
    is_first = ~F.col("_have") & (F.col("fetched_at") == F.col("_first.fetched_at")) & (F.col("data_hash") == F.col("_first.data_hash"))
    judged = cut(own.withColumn("outcome", F.when(is_first, "written").when(F.col("data_hash") == F.col("_first.data_hash"), "skipped").otherwise("quarantined")))
    new = judged.where("outcome = 'written'").select(*names)
    new.repartition("exchange", "fetched_date").write.mode("append").partitionBy("exchange", "fetched_date").parquet(base)
    quarantine(judged.where("outcome = 'quarantined'").select(*names, F.lit("HASH_CONFLICT").alias("reason")), f"{root}/quarantine/exchange_metadata", "reason")
    return judged.groupBy("outcome").count()


def append_events(rows: DataFrame, root: str, folder: str, name: str, tier: str | None = None, node: str | None = None) -> None:
    """Appends ticks, order book events, snapshots or depth rows under exchange, symbol and day of instant (and node)."""
    schemas.reject_floats(rows.select(*schemas.schema(name).names).schema)
    base = f"{root}/market/{folder}/schema_version={name}" + (f"/tier={tier}" if tier else "")
    keyed = rows.select(*schemas.schema(name).names).withColumns({"date": F.to_date("ts_utc").cast("string"), **({"node": F.lit(node)} if node else {})})
    keys = ["exchange", "symbol", "date", *(["node"] if node else [])]
    placement.by_time(keyed, base, keys, "ts_utc", ["ts_utc"])


def quarantine(rows: DataFrame, path: str, reason: str) -> None:
    """Appends rows with a column ``reason`` under reason and day of detection."""
    rows.withColumn("reason", F.col(reason)).withColumn("detected_date", F.current_date()).write.mode("append").partitionBy("detected_date", "reason").parquet(path)


def write_text(path: str, text: str) -> None:
    """A small artefact, replaced as a whole, on any file system that the session knows: written beside its place and renamed."""
    spark = SparkSession.active()
    target, beside = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path}.{os.urandom(6).hex()}.tmp"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, target):  # file systems differ in whether renaming replaces
        fs.delete(target, False)
        if not fs.rename(beside, target):
            raise OSError(f"can't replace {path}")


def read_text(path: str) -> str:
    return "".join(r.value for r in SparkSession.active().read.text(path, wholetext=True).collect())


def write_json(path: str, value: dict) -> None:
    """A small artefact (manifest, lineage, report)."""
    write_text(path, json.dumps(value, sort_keys=True, default=str))


def read_json(path: str) -> dict:
    return json.loads(read_text(path))


MANIFEST = "collector_run_id string, selected_symbols array<string>"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """The manifests under a folder, one JSON object a file, however it is laid out, with ``path``."""
    got = spark.read.schema(MANIFEST).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
    return got.select("*", F.col("_metadata.file_path").alias("path"))


def manifests_of(manifests_: DataFrame, symbol: str) -> DataFrame:
    """Manifests whose ``selected_symbols`` contain the symbol."""
    return manifests_.where(F.array_contains("selected_symbols", symbol))


def front_matter(values: dict) -> str:
    """A flat dictionary as the YAML block at the head of a manifest; values are JSON, which YAML includes."""
    return "---\n" + "".join(f"{k}: {json.dumps(v, default=str)}\n" for k, v in values.items()) + "---\n"


def put_batch(rows: DataFrame, path: str, body: str) -> str:
    """A batch written back under ``path`` once: ``written``, ``skipped`` if the same ``body`` (its request) was written before, ``conflict`` if another was."""
    digest = hashlib.sha256(body.encode()).hexdigest()
    spark = rows.sparkSession
    if catalog.exists(spark, f"{path}.sha256"):
        return "skipped" if read_text(f"{path}.sha256").strip() == digest else "conflict"
    rows.write.mode("overwrite").parquet(path)
    write_text(f"{path}.sha256", digest)  # last, so that a batch that died is written again
    return "written"


def request_hash(request: dict) -> str:
    """SHA-256 of a request's canonical JSON: keys in order, no white space."""
    return hashlib.sha256(json.dumps(request, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def day_of_events(spark: SparkSession, root: str, name: str, exchange: str, symbol: str, start: str, end: str) -> bytes:
    """Events of at most 24 hours of one series as an Arrow stream; a longer window raises."""
    a, b = catalog.window(start, end)
    if b - a > timedelta(hours=24):
        raise ValueError("at most 24 hours")
    return ipc_bytes(catalog.scan_events(spark, root, name, exchange, symbol, a, b))


def day_of_candles(spark: SparkSession, root: str, exchange: str, symbol: str, timeframe: str, start: str, end: str, mode: str | list[str] = "historical") -> bytes:
    """Candles of at most 24 hours of one series as an Arrow stream; a longer window raises."""
    a, b = catalog.window(start, end)
    if b - a > timedelta(hours=24):
        raise ValueError("at most 24 hours")
    return ipc_bytes(catalog.scan_candles(spark, root, exchange, symbol, timeframe, a, b, mode))


def ipc_bytes(df: DataFrame) -> bytes:
    """A bounded result (a scan of at most a day of one series) as an Arrow IPC stream."""
    table = df.toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def ipc_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()
