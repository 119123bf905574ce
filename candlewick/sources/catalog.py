"""Scans of the lake's layouts: explicit schemas, columns from the path, half-open windows, no lookahead."""

import hashlib
import re
from datetime import UTC, date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas
from candlewick.functions import hashing, paths
from candlewick.operators import reconcile, replicas

TIMED = ("ts_utc", "received_at")


def window(start: str | datetime, end: str | datetime) -> tuple[datetime, datetime]:
    """Both bounds in UTC; raises unless both have an offset and end is after start."""
    out = []
    for x in (start, end):
        t = datetime.fromisoformat(x) if isinstance(x, str) else x
        if t.tzinfo is None:
            raise ValueError(f"a bound needs an offset: {x}")
        if t.utcoffset() != timedelta(0):
            raise ValueError(f"a bound must be in UTC: {x}")
        out.append(t)
    if out[1] <= out[0]:
        raise ValueError("end must be after start")
    return out[0], out[1]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def subfolders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Folders under ``root`` that match a pattern such as ``date=*``; one listing of folder names, no files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{pattern}")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(f.getPath().toString() for f in found if f.isDirectory()) if found else []


def pruned(spark: SparkSession, roots: list[str], since: date | None, until: date | None) -> list[str]:
    """The roots' day folders from ``since`` to ``until`` (inclusive, None is open): ``date=YYYY-MM-DD``, ``fetched_date=`` or ``year=/month=/date=DD``. Roots without such folders as they are."""
    out = []
    for root in roots:
        iso = [*subfolders(spark, root, "date=*"), *subfolders(spark, root, "fetched_date=*")]
        split = subfolders(spark, root, "year=*/month=*/date=*")
        if not iso and not split:
            out.append(root)
        for f in [*iso, *split]:
            values = dict(x.split("=", 1) for x in f.split("/") if "=" in x)
            text = values.get("fetched_date") or (values["date"] if f in iso else f"{values['year']}-{values['month']}-{values['date']}")
            try:
                day = date.fromisoformat(text)
            except ValueError:
                out.append(f)  # unknown days are read
                continue
            if (since is None or day >= since) and (until is None or day <= until):
                out.append(f)
    return out


def read(spark: SparkSession, roots: list[str], name: str, since: date | None = None, until: date | None = None) -> DataFrame | None:
    """All Parquet files under those roots that exist, of the day folders from ``since`` to ``until``, in the declared schema, with ``node_id``, ``file`` and ``row`` of each row.

    Folders outside the days aren't listed, let alone opened. Files written with nanosecond instants are read as whole numbers and scaled; columns that the files lack come
    from the path, or are null (older versions). Folders may or may not have a node level.
    """
    have = [r for r in dict.fromkeys(roots) if exists(spark, r)]
    have = pruned(spark, have, since, until) if since or until else have
    if not have:
        return None
    want = schemas.schema(name)
    got = _raw(spark, have)
    cols = []
    for f in want.fields:
        if f.name not in got.columns:
            cols.append(paths.hive(F.col("_metadata.file_path"), f.name).try_cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType) and dict(got.dtypes)[f.name] == "bigint":
            cols.append(F.timestamp_micros(F.expr(f"{f.name} div 1000")).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    file = F.col("_metadata.file_path")
    node = F.col("node_id") if "node_id" in got.columns else F.coalesce(paths.hive(file, "node"), F.lit(replicas.NO_NODE))
    extra = [] if "node_id" in want.names else [node.alias("node_id")]
    return got.select(*cols, *extra, file.alias("file"), F.col("_metadata.row_index").alias("row"))


NANOS = "spark.sql.legacy.parquet.nanosAsLong"


def _raw(spark: SparkSession, have: list[str]) -> DataFrame:
    """The files as they are, columns of all of them; nanosecond instants as whole numbers. Only the lookup of the schema needs the setting for that, which is put back."""
    before = spark.conf.get(NANOS)
    spark.conf.set(NANOS, "true")
    try:
        return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*have)
    finally:
        spark.conf.set(NANOS, before)


def candle_roots(root: str, exchange: str, symbol: str, timeframe: str, modes: list[str]) -> list[str]:
    """``historical`` is the layout without mode and the one with it; other modes have their own folder."""
    e, s, t = paths.safe(exchange), paths.safe(symbol), paths.safe(timeframe)
    base = f"{root}/market/ohlcv/schema_version=ohlcv.v1"
    out = []
    for m in modes:
        if m == "historical":
            out.append(f"{base}/exchange={e}/symbol={s}/timeframe={t}")
        out.append(f"{base}/mode={paths.safe(m)}/exchange={e}/symbol={s}/timeframe={t}")
    return list(dict.fromkeys(out))


def _empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.schema(name))


def scan_candles(spark: SparkSession, root: str, exchange: str, symbol: str, timeframe: str, start: str | datetime, end: str | datetime, mode: str | list[str] = "historical") -> DataFrame:
    """Candles of [start, end) in order; replicas are reduced to one row a candle if two nodes or more delivered."""
    a, b = window(start, end)
    rows = read(spark, candle_roots(root, exchange, symbol, timeframe, [mode] if isinstance(mode, str) else mode), "ohlcv.v1", a.date(), b.date())
    if rows is None:
        return _empty(spark, "ohlcv.v1")
    rows = rows.where((F.col("ts_utc") >= F.lit(a)) & (F.col("ts_utc") < F.lit(b)) & (F.col("symbol") == symbol))
    if replicas.several_nodes(rows):
        rows = replicas.candles(rows)
    return rows.orderBy("ts_utc", "node_id", "file", "row").select(*schemas.schema("ohlcv.v1").names)


def scan_events(spark: SparkSession, root: str, name: str, exchange: str, symbol: str, start: str | datetime, end: str | datetime, clock: datetime | None = None, latest_arrival_days: int | None = None) -> DataFrame:
    """Ticks, order book events or snapshots of [start, end), both generations of layout; with ``clock`` only what had been received by then.

    Replicas of ticks and order book events are reduced if two nodes or more delivered.
    Folders of days before the window aren't read; those after it are, since tiers may be filed by day of arrival, unless ``latest_arrival_days`` says after how many days nothing arrives any more. Order is total: instant, arrival, file, row.
    """
    a, b = window(start, end)
    e, s = paths.safe(exchange), paths.safe(symbol)
    folder = {"tick.v1": ["ticks", "transaction"], "orderbook.v1": ["orderbook"], "orderbook_snapshot.v1": ["orderbook_snapshot", "orderbooksnapshot"], "orderbook_depth.v1": ["orderbookdepth"]}[name]
    tiers = ["", "/tier=L1", "/tier=L2", "/tier=L3"]
    roots = [f"{root}/market/{f}/schema_version={name}{t}/exchange={e}/symbol={s}" for f in folder for t in tiers]
    until = None if latest_arrival_days is None else b.date() + timedelta(days=latest_arrival_days)
    rows = read(spark, roots, name, a.date() - timedelta(days=1), until)  # clocks of arrival may be slightly behind
    if rows is None:
        return _empty(spark, name)
    rows = rows.where((F.col("ts_utc") >= F.lit(a)) & (F.col("ts_utc") < F.lit(b)) & (F.col("symbol") == symbol))
    if clock is not None:
        rows = rows.where(F.col("received_at") <= F.lit(clock))
    key = {"tick.v1": replicas.TICK_KEY, "orderbook.v1": replicas.ORDERBOOK_KEY}.get(name)
    if key and replicas.several_nodes(rows):
        rows = replicas.reduced(rows, key, ["ts_utc", "received_at", "file", "row"])
    order = ["ts_utc", "baseline_seq", "file", "row"] if name == "orderbook_snapshot.v1" else ["ts_utc", "received_at", "file", "row"]
    return rows.orderBy(*order).select(*schemas.schema(name).names)


def scan_metadata(spark: SparkSession, root: str, exchange: str, symbol: str, at: datetime) -> DataFrame:
    """The row of the latest fetch at or before an instant; none if there is none."""
    rows = read(spark, [f"{root}/market/exchange_metadata/schema_version=exchange_metadata.v1/exchange={paths.safe(exchange)}"], "exchange_metadata.v1", None, at.date())
    if rows is None:
        return _empty(spark, "exchange_metadata.v1")
    names = schemas.schema("exchange_metadata.v1").names
    return rows.where((F.col("symbol") == symbol) & (F.col("fetched_at") <= F.lit(at))).orderBy(F.desc("fetched_at"), "file", "row").limit(1).select(*names)


class Missing(FileNotFoundError):
    """No store has the partition."""


def located(spark: SparkSession, stores: list[str], partition: str) -> str:
    """The first store's folder that has the partition; raises ``Missing`` where none has. Later stores are fallbacks. The default node's rows may lie in a folder without a node level."""
    plain = partition.strip("/")
    spelt = [plain, *([plain.replace("/node=DEFAULT", "")] if "/node=DEFAULT" in plain else [])]
    for store in stores:
        for name in spelt:
            if exists(spark, f"{store.rstrip('/')}/{name}"):
                return f"{store.rstrip('/')}/{name}"
    raise Missing(f"{partition} in {', '.join(stores)}")


def tier_of(partition: str) -> str:
    """``L1``, ``L2`` or ``L3`` of a partition path; anything else raises."""
    m = re.search(r"(?:^|/)tier=(L[123])(?:/|$)", partition)
    if not m:
        raise ValueError(f"no tier in {partition!r}")
    return m[1]


def scan_partition(spark: SparkSession, stores: list[str], partition: str, name: str) -> DataFrame:
    """The rows of one partition of a tier, wherever it lies, in the declared schema; ``node_id`` where its path has none is the default node."""
    tier_of(partition)
    return read(spark, [located(spark, stores, partition)], name)


def polled_metadata(tickers: DataFrame, statuses: DataFrame, exchange: str, at: datetime) -> DataFrame:
    """Records of ``exchange_metadata.v1`` from a public poll: ``tickers`` (code, acc_trade_value_24h as text), ``statuses`` (currency, deposit_status, withdrawal_status).

    Values that are no numbers count as 0; codes without a status have ``0``. The snapshot id is a digest of all that was polled, the same for the same content in any order.
    """
    names = schemas.schema("exchange_metadata.v1")
    value = F.coalesce(hashing.half_even(F.col("acc_trade_value_24h")), F.lit(0).cast("decimal(38,18)"))
    codes = tickers.where(F.col("code").isNotNull() & (F.col("code") != "date")).select(F.col("code").alias("currency"), value.alias("acc_trade_value_24h"))
    content = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(F.lit(1), *df.columns)), F.bit_xor(F.xxhash64(F.lit(2), *df.columns))).first()
    snapshot = hashlib.sha256(repr((exchange, tuple(content(tickers)), tuple(content(statuses)))).encode()).hexdigest()[:16]
    got = reconcile.with_status(codes, statuses, "currency")
    fixed = {"exchange": F.lit(exchange), "symbol": F.concat(F.lit("KRW-"), "currency"), "fetched_date": F.lit(at.date()), "fetched_at": F.lit(at), "source_snapshot_id": F.lit(snapshot), "available_from_ts": F.lit(at)}
    rows = got.withColumns(fixed)
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in names.fields if f.name not in rows.columns})
    hashed = ["symbol", "exchange", "asset_status", "acc_trade_value_24h", "tick_size", "min_order_qty", "fee_maker", "fee_taker", "min_order_notional_krw"]
    return rows.withColumn("data_hash", hashing.metadata_hash(hashed)).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in names.fields))


def numbered_lines(files_: DataFrame, channel: str, value: str = "value") -> DataFrame:
    """Records of whole log segments (``value``, ``file``) in the channel's schema, decimals exact; ``line`` counts a file's records from 0. A line that is no object has nulls only."""
    line = F.posexplode(F.filter(F.split(value, r"\r?\n"), lambda x: F.trim(x) != "")).alias("line", "json")
    got = files_.select("file", line).select(F.from_json("json", schemas.wal_schema(channel)).alias("r"), "file", F.col("line").cast("bigint").alias("line"))
    return got.select("r.*", "file", "line").where((F.col("channel") == channel) | F.col("channel").isNull())


def wal_files(spark: SparkSession, names: list[str], channel: str) -> DataFrame:
    """Records of the named segments, each of which is a few minutes' log and is read as a whole, as lines are numbered within it."""
    return numbered_lines(spark.read.text(names, wholetext=True).select("value", F.col("_metadata.file_path").alias("file")), channel)


def wal(spark: SparkSession, path: str, channel: str, pattern: str = "*.ndjson*") -> DataFrame:
    """Records of all segments under a folder whose names match, markers (which are empty) and active ones too."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    return numbered_lines(raw.select("value", F.col("_metadata.file_path").alias("file")), channel)


def encoded(rows: DataFrame) -> DataFrame:
    """Rows as log lines (``value``): JSON with plain exact decimals and ISO instants; nulls are left out. Double and float columns, which may hold what JSON can't, raise."""
    schemas.reject_floats(rows.schema)
    return rows.select(F.to_json(F.struct(*rows.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))


def touch(spark: SparkSession, names: list[str]) -> None:
    """Creates empty files; those there are stay."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        p.getFileSystem(conf).createNewFile(p)


def write_lines(spark: SparkSession, name: str, lines: list[str]) -> None:
    """A text file that is there wholly or not at all."""
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = new(name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    half = new(f"{name}.part")
    file = fs.create(half, True)
    file.write(bytearray("".join(f"{x}\n" for x in lines), "utf-8"))
    file.close()
    if not fs.rename(half, new(name)):
        raise OSError(f"{name} could not be written")


def read_lines(spark: SparkSession, name: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(name)
    file = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(file.readAllBytes()).decode().splitlines()
    finally:
        file.close()


LISTING = "path string, length bigint, modified timestamp"


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified, exchange, symbol, tier, date, hour, node, channel) of every file whose name matches; contents aren't read. A missing folder has none.

    The file source leaves out empty files, such as markers; these are added from its index, one look-up each.
    """
    got = spark.createDataFrame([], LISTING)
    if exists(spark, path):
        source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
        got = source.select("path", "length", F.col("modificationTime").alias("modified"))
        names = spark.createDataFrame([(re.sub("^file:/+", "file:/", unquote(n)),) for n in source.inputFiles()], "path string")
        conf, empty = spark.sparkContext._jsc.hadoopConfiguration(), []
        for r in names.join(got, "path", "left_anti").toLocalIterator():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(r.path)
            empty.append((r.path, 0, datetime.fromtimestamp(p.getFileSystem(conf).getFileStatus(p).getModificationTime() / 1000, UTC)))
        if empty:
            got = got.unionByName(spark.createDataFrame(empty, LISTING))
    p = F.col("path")
    return got.select("path", "length", "modified", *(paths.hive(p, k).alias(k) for k in ("exchange", "symbol", "tier", "date", "hour")), paths.node(p).alias("node"), F.regexp_extract(p, r"/market/([^/]+)/", 1).alias("channel"))


def pending(listing: DataFrame) -> DataFrame:
    """Sealed segments that have no compacted marker, from a listing with ``path``."""
    base = F.regexp_replace("path", r"\.compacted$", "")
    sealed = listing.where(F.col("path").endswith(".sealed"))
    done = listing.where(F.col("path").endswith(".sealed.compacted")).select(base.alias("path"))
    return sealed.join(done, "path", "left_anti")


def register(spark: SparkSession, folder: str, tables: list[str]) -> None:
    """Views over Parquet tables of a folder, for ad-hoc SQL."""
    for t in tables:
        spark.read.parquet(f"{folder}/{paths.safe(t)}.parquet").createOrReplaceTempView(t)


def sql_text(spark: SparkSession, query: str, limit: int = 1000) -> str:
    """The result of a query as a padded table; at most ``limit`` rows are fetched for printing."""
    df = spark.sql(query)
    rows = [[("" if v is None else str(v)) for v in r] for r in df.limit(limit).collect()]
    widths = [max(len(c), *(len(r[i]) for r in rows)) if rows else len(c) for i, c in enumerate(df.columns)]
    line = lambda r: "  ".join(x.ljust(w) for x, w in zip(r, widths, strict=True)).rstrip()
    return "\n".join([line(df.columns), *map(line, rows)])
