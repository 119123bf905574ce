"""Tiered compaction: log segments to sorted Parquet (L1), hours (L2) and days (L3)."""

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions import hashing, paths
from candlewick.operators import book
from candlewick.plans import placement
from candlewick.plans.lineage import scratch
from candlewick.sources import catalog

SEQ = ["exchange", "symbol", "ts_utc", "received_at"]


def _instants(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.to_timestamp(c) for c in ("ts_utc", "received_at")})


def snapshot_hash() -> Column:
    """16 hex digits over the compact JSON text, keys in order, of asks, baseline_seq, bids, exchange and symbol; prices and quantities as text without trailing zeros."""
    number = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ""), F.lit('"'))
    levels = lambda c: F.concat(F.lit("["), F.concat_ws(",", F.transform(c, lambda x: F.concat(F.lit("["), number(x["price"]), F.lit(","), number(x["quantity"]), F.lit("]")))), F.lit("]"))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.coalesce(F.col(c), F.lit("")).alias("v"))), r'^\{"v":(.*)\}$', 1)
    side = lambda c: F.when(F.col(c).isNull(), F.lit("[]")).otherwise(levels(F.col(c)))
    seq = F.unix_micros("ts_utc").cast("string")
    body = F.concat(F.lit('{"asks":'), side("asks"), F.lit(',"baseline_seq":'), seq, F.lit(',"bids":'), side("bids"), F.lit(',"exchange":'), quoted("exchange"), F.lit(',"symbol":'), quoted("symbol"), F.lit("}"))
    return F.substring(F.sha2(body, 256), 1, 16)


def rows_of(wal: DataFrame, channel: str, *carry: str) -> DataFrame:
    """Log records of a channel as rows of its table, with columns ``carry``. Depth rows have the ordinal of their frame within its file (``line``) as sequence; a change lacking side, price or quantity raises."""
    events = _instants(wal)
    if channel == "transaction":
        return events.select(*schemas.schema("tick.v1").names, *carry)
    if channel == "orderbooksnapshot":
        keyed = events.withColumns({"baseline_seq": F.unix_micros("ts_utc"), "payload_hash": snapshot_hash()})
        return book.flatten_snapshots(keyed).select(*schemas.schema("orderbook_snapshot.v1").names, *carry)
    if channel == "orderbookdepth":
        c = F.col("c")
        whole = c["side"].isNotNull() & c["price"].isNotNull() & c["quantity"].isNotNull()
        flat = events.withColumn("ingest_seq", F.col("line")).withColumn("c", F.explode("changes")).withColumn("c", F.when(whole, c).otherwise(F.raise_error(F.lit("a change lacks side, price or quantity"))))
        return flat.withColumns({k: F.col(f"c.{k}") for k in ("side", "price", "quantity")}).select(*schemas.schema("orderbook_depth.v1").names, *carry)
    raise ValueError(f"unknown channel {channel!r}")


def snapshots_as_depth(snapshots: DataFrame) -> DataFrame:
    """Snapshot events (arrays of levels) as rows of the depth table, to recover a book from them: bids, then asks, each level sets its price; ``ingest_seq`` numbers nothing and is null."""
    keyed = snapshots.withColumns({"baseline_seq": F.unix_micros("ts_utc"), "payload_hash": F.lit(None).cast("string")})
    want = schemas.schema("orderbook_depth.v1")
    flat = book.flatten_snapshots(keyed)
    return flat.select(*((F.col(f.name) if f.name in flat.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields))


def segment_id(path: Column) -> Column:
    """The same for a segment whatever its state: sealed or compacted."""
    return hashing.short_id(F.regexp_replace(path, r"(\.sealed)?(\.compacted)?$", ""))


STAGE = "_l1-"  # hidden folders of runs under way; readers skip them
_UNIT = ["exchange", "symbol", "date", "segment"]


def write_l1(rows: DataFrame, out: str) -> None:
    """Rows with ``file``, the log segment they are from, as Parquet by exchange, symbol and day, sorted by instant, with the column ``segment``. The segments of one run share files, so their number is that of days, not of segments.

    A segment's rows of a day are replaced if they are written again: repeating changes nothing. Files that hold some are replaced as a whole, and rows of other segments in them are written anew, so none is lost, whether or not its
    segment is still in the log. All is made ready in a hidden folder; then the files that go are listed there, removed, and the new ones moved in. A run that died after listing them is finished by the next one, one that
    died before has changed nothing. One run at a time.
    """
    spark = rows.sparkSession
    for stage in catalog.subfolders(spark, out, f"{STAGE}*"):
        if catalog.exists(spark, f"{stage}/gone"):
            _swap(spark, stage, out)
    stage = f"{out}/{STAGE}{os.urandom(8).hex()}"
    keyed = rows.withColumns({"date": F.coalesce(F.to_date("ts_utc").cast("string"), F.lit("unknown")), "segment": segment_id(F.col("file"))}).drop("file")
    keyed.write.parquet(f"{stage}/rows")  # decoded once, read several times
    fresh = spark.read.schema(keyed.schema).parquet(f"{stage}/rows")
    place = lambda df: placement.by_time(df, f"{stage}/files", _UNIT[:3], "ts_utc", ["ts_utc", "received_at"], span_s=3600)
    place(fresh)
    days = ["/".join(f.split("/")[-3:]) for f in catalog.subfolders(spark, f"{stage}/files", "*/*/*")]
    there = [f"{out}/{day}" for day in days if catalog.exists(spark, f"{out}/{day}")]
    gone: list[str] = []
    if there:
        read = lambda names: spark.read.schema(keyed.schema).option("basePath", out).parquet(*names)
        units = fresh.select(*(F.col(c).alias(f"_{c}") for c in _UNIT)).distinct()
        same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _UNIT))
        gone = [r.file for r in read(there).select(*_UNIT, F.col("_metadata.file_path").alias("file")).distinct().join(units, same, "left_semi").select("file").distinct().collect()]
        if gone:
            kept = read([_path(spark, f).toString() for f in gone]).join(units, same, "left_anti")
            if not kept.isEmpty():
                place(kept)
    catalog.write_lines(spark, f"{stage}/gone", gone)
    _swap(spark, stage, out)


def _path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))


def _swap(spark: SparkSession, stage: str, out: str) -> None:
    """Removes the files that the run's list names and moves its own in; may be repeated from any point."""
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = new(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in catalog.read_lines(spark, f"{stage}/gone"):
        fs.delete(_path(spark, name), False)
    for folder in catalog.subfolders(spark, f"{stage}/files", "*/*/*"):
        day = new(f"{out}/{'/'.join(folder.split('/')[-3:])}")
        if fs.exists(day):
            moves = [(f.getPath(), new(day, f.getPath().getName())) for f in fs.globStatus(new(f"{folder}/*.parquet"))]
        else:
            fs.mkdirs(day.getParent())
            moves = [(new(folder), day)]
        for source, target in moves:
            if not fs.rename(source, target):
                raise OSError(f"{source.toString()} could not be moved to {target.toString()}")
    fs.delete(new(stage), True)


def compact_segments(spark: SparkSession, wal_path: str, out: str, channel: str, upto: str | None = None, since: str | None = None, until: str | None = None) -> int:
    """L1: pending segments of a channel (sealed, without a marker) are written by ``write_l1`` and get their markers; returns how many there were.

    ``upto`` freezes the list at segments whose name's instant isn't later; ``since`` and ``until`` choose days of the log (``date=``, or a folder of that name), both inclusive.
    Active segments and markers aren't read. A run that died before its markers is repeated without harm.
    """
    listing = catalog.pending(catalog.files(spark, wal_path, "*.sealed*")).where(F.col("path").contains(f"/{channel}/"))
    if upto is not None:
        listing = listing.where(paths.segment_fields(F.element_at(F.split("path", "/"), -1))["segment_ts"] <= upto)
    day = F.regexp_extract("path", r"/(?:date=)?(\d{4}-\d{2}-\d{2})/", 1)
    for bound, keep in ((since, day >= since), (until, day <= until)):
        if bound is not None:
            listing = listing.where(keep)
    names = [r.path for r in listing.select("path").collect()]  # the backlog of one run; a path a segment
    if names:
        write_l1(rows_of(catalog.wal_files(spark, names, channel), channel, "file"), out)
        catalog.touch(spark, [f"{n}.compacted" for n in names])
    return len(names)


def merged(rows: DataFrame, unit: str) -> DataFrame:
    """Rows with ``date`` (and ``hour`` for unit ``hour``) of their instant: the folders that L2 and L3 write."""
    if unit not in ("hour", "day"):
        raise ValueError(f"unit is hour or day, not {unit!r}")
    return rows.withColumns({"date": F.to_date("ts_utc"), **({"hour": F.date_format("ts_utc", "HH")} if unit == "hour" else {})})


def write_merged(rows: DataFrame, out: str, unit: str) -> None:
    """Replaces the hours or days that occur in ``rows``. A large one is cut into files by instant, by exact counts; small ones share tasks."""
    keys = ["exchange", "symbol", "date", *(["hour"] if unit == "hour" else [])]
    placement.by_time(merged(rows, unit), out, keys, "ts_utc", ["ts_utc", "received_at"], mode="overwrite")


def merge_tier(spark: SparkSession, source: str, out: str, unit: str, since: str | None = None, until: str | None = None) -> None:
    """L2 (hours) from L1, or L3 (days) from L2; each hour holds its own rows only. ``since`` and ``until`` are days of the source's folders, both inclusive: history is promoted so."""
    rows = spark.read.parquet(source)
    for bound, keep in ((since, F.col("date").cast("string") >= since), (until, F.col("date").cast("string") <= until)):
        rows = rows if bound is None else rows.where(keep)
    write_merged(rows.drop("date", "hour", "segment"), out, unit)


def verify_merge(source: DataFrame, merged_: DataFrame) -> DataFrame:
    """(exchange, symbol, n_source, n_merged, equal): counts and two xors of row digests of each series in two tiers, before the lower one is given up."""
    names = [c for c in source.columns if c in merged_.columns and c not in ("date", "hour", "segment", "node")]
    sums = lambda df, n: df.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias(f"n_{n}"), F.bit_xor(F.xxhash64(F.lit(1), *names)).alias(f"x_{n}"), F.bit_xor(F.xxhash64(F.lit(2), *names)).alias(f"y_{n}"))
    both = sums(source, "source").join(sums(merged_, "merged"), ["exchange", "symbol"], "full_outer")
    same = lambda p: F.col(f"{p}_source").eqNullSafe(F.col(f"{p}_merged"))
    return both.select("exchange", "symbol", F.coalesce("n_source", F.lit(0)).alias("n_source"), F.coalesce("n_merged", F.lit(0)).alias("n_merged"), (same("n") & same("x") & same("y")).alias("equal"))


def removable_segments(listing: DataFrame, now: Column, grace_s: int = 86_400, archived: DataFrame | None = None, grace_unarchived_s: int = 7 * 86_400) -> DataFrame:
    """Sealed segments of a listing (path, modified) whose marker is at least ``grace_s`` old; with ``archived`` (path), those that aren't in it only after ``grace_unarchived_s``. A query: nothing is removed."""
    marker = listing.where(F.col("path").endswith(".sealed.compacted")).select(F.regexp_replace("path", r"\.compacted$", "").alias("path"), "modified")
    age = (F.unix_micros(now) - F.unix_micros("modified")) / F.lit(1e6)
    if archived is None:
        return marker.where(age >= grace_s).select("path")
    known = marker.join(archived.select("path").distinct().withColumn("_archived", F.lit(True)), "path", "left")
    return known.where(age >= F.when(F.col("_archived"), grace_s).otherwise(grace_unarchived_s)).select("path")


def merge_report(rows: DataFrame, unit: str, path: str | None = None) -> DataFrame:
    """Merges into ``path`` (a new folder by default): ``tier_summary`` of the rows that its files hold, by the folders they are in."""
    spark = rows.sparkSession
    path = path or scratch(spark, "merged")
    write_merged(rows, path, unit)
    keys = ["exchange", "symbol", "date", *(["hour"] if unit == "hour" else [])]
    return spark.read.schema(merged(rows, unit).schema).parquet(path).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"))


def upgrade_ticks(rows: DataFrame) -> DataFrame:
    """tick.v1 rows as tick.v1.1: no sequence, no payload hash, status OK. Rows of v1.1 stay as they are."""
    want = schemas.schema("tick.v1.1")
    fill = {"ingest_seq": F.lit(None), "payload_hash": F.lit(None), "validation_status": F.lit("OK")}
    return rows.select(*((F.col(f.name) if f.name in rows.columns else fill[f.name]).cast(f.dataType).alias(f.name) for f in want.fields))


def tier_summary(rows: DataFrame, unit: str) -> DataFrame:
    """(exchange, symbol, date[, hour], n_rows, first_ts, last_ts) of what ``merged`` writes."""
    parts = {"date": F.to_date("ts_utc"), **({"hour": F.date_format("ts_utc", "HH")} if unit == "hour" else {})}
    return rows.withColumns(parts).groupBy("exchange", "symbol", *parts).agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"))
