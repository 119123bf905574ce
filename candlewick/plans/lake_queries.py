"""Queries of the lake's tiers, logs, inventories and checks over whole tables, and the SQL that must give the same rows.

Logs are packed from ``orderbook_depth``: a file is an hour of a source, a line a frame of all its changes at one instant.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions import hashing, normal
from candlewick.operators import bars, book, health, quality, reconcile, replicas, tiers
from candlewick.plans import market_queries
from candlewick.plans.lineage import scratch, stored
from candlewick.plans.market_queries import _BOOK_EVENTS, _FILES, _book_events, _files, _t, fold_sql, ticks, us
from candlewick.sources import catalog
from candlewick.streaming import live

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


_VALID = "side IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL AND ts_utc IS NOT NULL"


def _depth_log(spark: SparkSession, d: str) -> DataFrame:
    """(value, file): the depth table as log segments."""
    o = _t(spark, d, "orderbook_depth").where("side is not null and price is not null and quantity is not null and ts_utc is not null")
    hour = F.date_format("ts_utc", "yyyyMMdd'T'HH'0000Z'")
    change = F.struct("depth_id", "side", "price", "quantity")
    frames = o.groupBy("exchange", "symbol", "ts_utc").agg(F.array_sort(F.collect_list(change)).alias("c"), F.min("received_at").alias("received_at"))
    body = F.struct(
        "ts_utc", "received_at", "exchange", "symbol", F.transform("c", lambda x: F.struct(x["side"].alias("side"), x["price"].alias("price"), x["quantity"].alias("quantity"))).alias("changes"), F.lit("orderbookdepth").alias("channel")
    )
    line = F.to_json(body, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    lines = frames.select(F.concat(F.lit("/wal/"), "exchange", F.lit("/orderbookdepth/"), "symbol", F.lit("/segment-"), hour, F.lit("-NODE_A.ndjson.sealed")).alias("file"), F.struct("ts_utc", line.alias("line")).alias("l"))
    return lines.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("value"))


@query(f"""WITH v AS (SELECT *, epoch_us(ts_utc) AS us, epoch_us(ts_utc) // 3600000000 AS h FROM orderbook_depth WHERE {_VALID})
SELECT exchange, symbol, us AS ts_us, side, CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity, dense_rank() OVER (PARTITION BY exchange, symbol, h ORDER BY us) - 1 AS ingest_seq FROM v""")
def depth_frames(spark, d):
    """Depth rows decoded from log segments; each carries the ordinal of its frame within the file."""
    rows = tiers.rows_of(catalog.numbered_lines(_depth_log(spark, d), "orderbookdepth"), "orderbookdepth")
    return rows.select("exchange", "symbol", us("ts_utc").alias("ts_us"), "side", F.col("price").cast("string").alias("price"), F.col("quantity").cast("string").alias("quantity"), "ingest_seq")


@query(f"""SELECT exchange, symbol, strftime(ts_utc AT TIME ZONE 'UTC', '%Y-%m-%d') AS date, count(*) AS n_rows, count(DISTINCT epoch_us(ts_utc) // 3600000000) AS n_segments, epoch_us(min(ts_utc)) AS first_us, epoch_us(max(ts_utc)) AS last_us
FROM orderbook_depth WHERE {_VALID} GROUP BY 1, 2, 3""")
def l1_compacted(spark, d):
    """Log segments written as L1 twice (the second time changes nothing): what the files of each day hold."""
    log, out = stored(_depth_log(spark, d), "log"), scratch(spark, "l1")
    for segments in (log, log.where(F.col("file").startswith("/wal/norwex/"))):
        tiers.write_l1(tiers.rows_of(catalog.numbered_lines(segments, "orderbookdepth"), "orderbookdepth", "file"), out)
    got = spark.read.parquet(out)
    return got.groupBy("exchange", "symbol", F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("segment").alias("n_segments"), us(F.min("ts_utc")).alias("first_us"), us(F.max("ts_utc")).alias("last_us")
    )


@query("SELECT exchange, symbol, count(*) AS n_source, count(*) AS n_merged, TRUE AS equal FROM orderbook_depth GROUP BY 1, 2")
def tier_promotion_check(spark, d):
    """Days merged from the depth table, compared with it by counts and digests before the lower tier could go."""
    o = _t(spark, d, "orderbook_depth")
    out = scratch(spark, "l3")
    tiers.write_merged(o, out, "day")
    return tiers.verify_merge(o, spark.read.schema(tiers.merged(o, "day").schema).parquet(out))


@query(f"""WITH {_BOOK_EVENTS}, g AS (SELECT exchange, symbol, us // 3600000000 AS h, side, us, seq, price, quantity FROM e)
SELECT exchange, symbol, h, left(sha256('{{"asks":[' || coalesce(string_agg('["' || price || '","' || quantity || '"]', ',' ORDER BY us, seq) FILTER (side = 'ask'), '') || '],"baseline_seq":' || h * 3600000000 || ',"bids":['
|| coalesce(string_agg('["' || price || '","' || quantity || '"]', ',' ORDER BY us, seq) FILTER (side = 'bid'), '') || '],"exchange":"' || exchange || '","symbol":"' || symbol || '"}}'), 16) AS payload_hash FROM g GROUP BY 1, 2, 3""")
def snapshot_hashes(spark, d):
    """Hashes of an hour's levels packed as a snapshot."""
    return _packed(spark, d).select("exchange", "symbol", "h", tiers.snapshot_hash().alias("payload_hash"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    e = _book_events(spark, d).withColumn("h", normal.bucket(us("ts_utc"), 3_600_000_000))
    level = F.struct("ts_utc", "seq", F.col("price").cast(schemas.DEC).alias("price"), F.col("quantity").cast(schemas.DEC).alias("quantity"))
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, level))), lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity")))
    return e.groupBy("exchange", "symbol", "h").agg(side("bid").alias("bids"), side("ask").alias("asks")).withColumn("ts_utc", F.timestamp_micros(F.col("h") * 3_600_000_000))


@query(f"""WITH {_BOOK_EVENTS} SELECT exchange, symbol, us // 3600000000 * 3600000000 AS ts_us, side, price, quantity, CAST(NULL AS BIGINT) AS ingest_seq FROM e""")
def snapshots_as_depth(spark, d):
    """Levels of packed snapshots as depth rows."""
    p = _packed(spark, d).withColumns({"received_at": F.col("ts_utc"), "raw_json": F.lit(None).cast("string")})
    return tiers.snapshots_as_depth(p).select("exchange", "symbol", us("ts_utc").alias("ts_us"), "side", F.col("price").cast("bigint").alias("price"), F.col("quantity").cast("bigint").alias("quantity"), "ingest_seq")


@query(f"""WITH {_BOOK_EVENTS}, g AS (SELECT exchange, symbol, us // 3600000000 AS h, side, us, seq, price, quantity FROM e)
SELECT exchange, symbol, h * 3600000000 AS ts_us, side, -1 AS level, price, quantity FROM g""")
def delta_flatten(spark, d):
    """An hour's levels packed as a delta event and flattened again."""
    e = _book_events(spark, d).withColumn("h", normal.bucket(us("ts_utc"), 3_600_000_000))
    packed = e.groupBy("exchange", "symbol", "h").agg(F.collect_list(F.struct("side", "price", "quantity")).alias("changes"))
    return book.flatten_deltas(packed).select("exchange", "symbol", (F.col("h") * 3_600_000_000).alias("ts_us"), "side", "level", "price", "quantity")


_TWO_BOOKS = f"""{_BOOK_EVENTS}, c AS (SELECT *, 'NODE_B' AS node, 'x' || seq AS raw, seq * 2 AS arrival FROM e UNION ALL
SELECT *, 'NODE_A' AS node, CASE WHEN seq % 7 = 0 THEN NULL WHEN seq % 11 = 0 THEN 'y' || seq ELSE 'x' || seq END AS raw, seq * 2 + 1 AS arrival FROM e)"""
_BOOK_KEY = "exchange, symbol, us, kind, side, price, quantity"


def _two_books(spark: SparkSession, d: str) -> DataFrame:
    e = _book_events(spark, d).withColumn("level", F.lit(-1))
    a = e.withColumns({"node_id": F.lit("NODE_B"), "raw_json": F.concat(F.lit("x"), "seq"), "arrival": F.col("seq") * 2})
    raw = F.when(F.col("seq") % 7 == 0, F.lit(None)).when(F.col("seq") % 11 == 0, F.concat(F.lit("y"), "seq")).otherwise(F.concat(F.lit("x"), "seq"))
    return a.unionByName(e.withColumns({"node_id": F.lit("NODE_A"), "raw_json": raw, "arrival": F.col("seq") * 2 + 1}))


@query(f"SELECT exchange, symbol, ts_us, side, price, quantity, node_id FROM ({fold_sql(_TWO_BOOKS, _BOOK_KEY, 'n.exchange, n.symbol, n.us AS ts_us, n.side, n.price, n.quantity')})")
def dedup_book_events(spark, d):
    """Order book events of two nodes, one kept of each 8-part key."""
    got = replicas.reduced(_two_books(spark, d), replicas.ORDERBOOK_KEY, ["arrival"])
    return got.select("exchange", "symbol", us("ts_utc").alias("ts_us"), "side", "price", "quantity", "node_id")


@query(f"SELECT exchange, symbol, CAST(sum(n_conflicts) AS BIGINT) AS n_conflicts FROM ({fold_sql(_TWO_BOOKS, _BOOK_KEY, 'n.exchange, n.symbol')}) GROUP BY 1, 2 HAVING sum(n_conflicts) > 0")
def book_conflicts(spark, d):
    """Pairs of events of one key whose payloads differ."""
    return replicas.conflicting(_two_books(spark, d), replicas.ORDERBOOK_KEY, ["arrival"]).groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n_conflicts"))


@query("""SELECT event_id, epoch_us(ts) // 3600000000 * 3600000000 AS hour_us, (epoch_us(ts) + 32400000000) // 86400000000 * 86400000000 - 32400000000 AS day_us FROM events""")
def last_closed(spark, d):
    """The last hour and the last day (of Korea) that was closed at each event."""
    t = F.col("ts").cast("timestamp")
    return _t(spark, d, "events").select("event_id", us(normal.last_closed(t, "1h")).alias("hour_us"), us(normal.last_closed(t, "1d")).alias("day_us"))


@query("SELECT symbol, date, count(*) AS n_files FROM chunks WHERE TRY_CAST(date AS DATE) < DATE '2025-02-10' GROUP BY 1, 2")
def closed_days(spark, d):
    """Files of days before one."""
    return quality.closed_days(_t(spark, d, "chunks"), "2025-02-10").groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("n_files"))


#: A configuration of what is collected, for the query below.
ALLOWED = (("north", "click"), ("north", "view"), ("north", "purchase"), ("south", "click"), ("south", "view"))


@query("""WITH e AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'north' ELSE 'south' END AS exchange, event_type AS channel FROM events)
SELECT event_id, CASE WHEN channel NOT IN ('click', 'view', 'purchase') THEN 'UNKNOWN channel' ELSE 'UNSUPPORTED' END AS reason FROM e
WHERE NOT (exchange = 'north' AND channel IN ('click', 'view', 'purchase') OR exchange = 'south' AND channel IN ('click', 'view'))""")
def refused_channels(spark, d):
    """Events of combinations that aren't on the list, with the reason."""
    e = _t(spark, d, "events").select("event_id", F.when(F.col("user_id") % 2 == 0, "north").otherwise("south").alias("exchange"), F.col("event_type").alias("channel"))
    return quality.allowed(e, ALLOWED)[1].select("event_id", "reason")


@query("""SELECT depth_id, CASE WHEN length(raw_json) > 20 THEN left(raw_json, 20) || ' [truncated, len=' || length(raw_json) || ']' ELSE raw_json END AS raw_json FROM orderbook_depth""")
def redacted_payloads(spark, d):
    """Payloads cut for error logs."""
    return quality.redacted(_t(spark, d, "orderbook_depth").select("depth_id", "raw_json"), 20)


@query("""WITH m AS (SELECT collector_run_id, list(DISTINCT symbol) AS s FROM orderbook_depth GROUP BY 1), t AS (SELECT min(symbol) AS symbol FROM orderbook_depth)
SELECT collector_run_id, len(s) AS n_symbols FROM m, t WHERE list_contains(s, t.symbol)""")
def manifests_of_symbol(spark, d):
    """Runs that collected the first symbol, from their manifests (written as JSON lines and read again)."""
    from candlewick.sources import sinks

    o = _t(spark, d, "orderbook_depth")
    path = scratch(spark, "manifests")
    o.groupBy("collector_run_id").agg(F.collect_set("symbol").alias("selected_symbols")).write.json(path)
    first = o.agg(F.min("symbol")).first()[0]
    return sinks.manifests_of(spark.read.schema(sinks.MANIFEST).json(path), first or "").select("collector_run_id", F.size("selected_symbols").alias("n_symbols"))


@query("""WITH i AS (SELECT DISTINCT symbol FROM candles UNION SELECT 'none'), s AS (SELECT symbol, max(CASE WHEN trim(asset_status) = '1' AND fee_maker IS NOT NULL THEN '1' ELSE '0' END) AS st FROM exchange_metadata GROUP BY 1)
SELECT i.symbol, coalesce(s.st, '0') AS asset_status FROM i LEFT JOIN s USING (symbol)""")
def ticker_status(spark, d):
    """Symbols with their status, 0 where none is known."""
    items = _t(spark, d, "candles").select("symbol").union(spark.createDataFrame([("none",)], "symbol string")).distinct()
    m = _t(spark, d, "exchange_metadata").select("symbol", F.trim("asset_status").alias("deposit_status"), F.col("fee_maker").isNotNull().cast("int").cast("string").alias("withdrawal_status"))
    return reconcile.with_status(items, m, "symbol")


@query("""WITH q AS (SELECT CASE WHEN is_legacy_node THEN 'retry' ELSE 'pending' END AS status, size_bytes FROM chunks)
SELECT status, count(*) AS depth, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes FROM q GROUP BY 1 UNION ALL SELECT 'all', count(*), CAST(coalesce(sum(size_bytes), 0) AS BIGINT) FROM q""")
def queue_depth(spark, d):
    """Depth and bytes of a queue a status, and in all."""
    q = _t(spark, d, "chunks").select(F.when(F.col("is_legacy_node"), "retry").otherwise("pending").alias("status"), F.col("size_bytes").alias("bytes"))
    return health.queue_depth(q)


@query("""SELECT symbol, 'depth' AS tier, CAST(ts_utc AT TIME ZONE 'UTC' AS DATE)::VARCHAR AS day, count(*) AS row_count, CAST(coalesce(sum(length(raw_json)), 0) AS BIGINT) AS byte_count, epoch_us(max(ts_utc)) AS last_us
FROM orderbook_depth WHERE ts_utc IS NOT NULL GROUP BY 1, 2, 3""")
def coverage_counters(spark, d):
    """The streaming counters, over the table as a batch."""
    o = _t(spark, d, "orderbook_depth").select("symbol", F.lit("depth").alias("tier"), "ts_utc", F.length("raw_json").alias("bytes")).where("ts_utc is not null")
    return live.coverage_counters(o).select("symbol", "tier", F.col("day").cast("string").alias("day"), "row_count", "byte_count", us("last_event_ts").alias("last_us"))


@query("""SELECT event_id, CAST(CASE WHEN r * 2 > 10000 OR r * 2 = 10000 AND w % 2 = 1 THEN w + 1 ELSE w END / CAST(100 AS DECIMAL(3,0)) AS DOUBLE) AS price
FROM (SELECT event_id, CAST(floor(v * 100) AS BIGINT) AS w, CAST(v * 1000000 AS BIGINT) % 10000 AS r FROM (SELECT event_id, CAST(value AS DECIMAL(18,6)) AS v FROM events WHERE value >= 0))""")
def half_even_prices(spark, d):
    """Values at two digits, ties to the even one."""
    e = _t(spark, d, "events").where("value >= 0")
    return e.select("event_id", hashing.half_even(F.col("value").cast("decimal(18,6)"), 2).cast("double").alias("price"))


_PAIR = """l AS (SELECT chunk_id AS name, max(n_rows) AS n, min(date) AS v FROM chunks GROUP BY 1), r AS (SELECT chunk_id AS name, count(*) AS n, min(symbol) AS s FROM chunk_rows WHERE chunk_id IS NOT NULL GROUP BY 1),
p AS (SELECT l.name, l.n AS ln, r.n AS rn FROM l JOIN r USING (name))"""


@query(f"""WITH {_PAIR}, c AS (SELECT abs((SELECT count(*) FROM l) - (SELECT count(*) FROM r)) AS n)
SELECT 'object_count' AS invariant, n = 0 AS ok, n AS n_bad FROM c UNION ALL SELECT 'sha256', count(*) FILTER (ln % 5 = 0) = 0, count(*) FILTER (ln % 5 = 0) FROM p
UNION ALL SELECT 'row_count', count(*) FILTER (ln <> rn) = 0, count(*) FILTER (ln <> rn) FROM p UNION ALL SELECT 'column_count', TRUE, 0 UNION ALL SELECT 'column_order', count(*) FILTER (rn > 15) = 0, count(*) FILTER (rn > 15) FROM p
UNION ALL SELECT 'dtype', TRUE, 0 UNION ALL SELECT 'schema_version', TRUE, 0 UNION ALL SELECT 'ambiguity', TRUE, 0""")
def file_checks(spark, d):
    """Eight checks of the listed files against those stored; digests and column orders of some are made to differ."""
    names = F.array(F.lit("a"), F.lit("b"))
    base = {"types": F.array(F.lit("int"), F.lit("int")), "schema_version": F.lit("s.v1")}
    left = _t(spark, d, "chunks").groupBy(F.col("chunk_id").alias("name")).agg(F.max("n_rows").cast("bigint").alias("rows")).withColumns({"digest": F.lit("d"), "names": names, **base})
    left = left.withColumn("digest", F.when(F.col("rows") % 5 == 0, "x").otherwise("d"))
    right = _t(spark, d, "chunk_rows").where("chunk_id is not null").groupBy(F.col("chunk_id").alias("name")).agg(F.count(F.lit(1)).alias("rows")).withColumns({"digest": F.lit("d"), **base})
    right = right.withColumn("names", F.when(F.col("rows") > 15, F.reverse(names)).otherwise(names))
    return reconcile.file_invariants(left, right, {"s.v1": ["a", "b"]})


@query(f"""WITH {_FILES}, m AS (SELECT DISTINCT exchange, symbol, CAST(date AS DATE) AS day FROM f), b AS (SELECT exchange, symbol, min(day) AS a, max(day) AS z FROM m GROUP BY 1, 2),
g AS (SELECT exchange, symbol, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b), k AS (SELECT count(*) AS expected, count(*) - (SELECT count(*) FROM m) AS missing FROM g),
s AS (SELECT coalesce(sum(bytes), 0) / 1073741824.0 AS gib, count(*) AS n FROM f), t AS (SELECT max(greatest((epoch_us(TIMESTAMPTZ '2025-03-15 00:00:00+00') - u) / 1e6, 0)) AS lag FROM (SELECT exchange, max(epoch_us(modified)) AS u FROM f GROUP BY 1))
SELECT 'volume' AS layer, CASE WHEN abs(gib - 0.004) <= 0.0008 THEN 'PASS' ELSE 'FAIL' END AS verdict, round(gib, 3) AS actual FROM s UNION ALL SELECT 'gap', CASE WHEN missing = 0 THEN 'PASS' ELSE 'FAIL' END, missing FROM k
UNION ALL SELECT 'file_count', 'PASS', n FROM s UNION ALL SELECT 'lag', CASE WHEN lag <= 60 THEN 'PASS' ELSE 'FAIL' END, round(lag, 1) FROM t""")
def health_report(spark, d):
    """The four layers of the report over the listed files."""
    f = _files(spark, d)
    days = f.select("exchange", "symbol", F.to_date("date").alias("day"))
    missing = reconcile.grid_gaps(days, ["exchange", "symbol"], "day")
    got = health.report(f, missing, days.distinct().unionByName(missing), F.lit("2025-03-15 00:00:00").cast("timestamp"), 0.004)
    return got.select("layer", "verdict", "actual")


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """A listing of log segments, every second sealed and every sixth with a marker."""
    e = _t(spark, d, "events")
    path = F.concat(F.lit("/lake/wal/"), F.when(F.col("user_id") % 2 == 0, "north").otherwise("south"), F.lit("/"), "event_type", F.lit("/segment-"), F.col("event_id").cast("string"), F.lit("-NODE_A.ndjson"))
    one = e.select(path.alias("p"), "event_id", F.col("event_id").alias("length"), F.col("ts").cast("timestamp").alias("modified"))
    sealed = F.when(F.col("event_id") % 2 == 0, F.concat("p", F.lit(".sealed"))).otherwise(F.col("p"))
    marks = one.where("event_id % 6 = 0").select(F.concat("p", F.lit(".sealed.compacted")).alias("path"), F.lit(0).cast("bigint").alias("length"), "modified")
    return one.select(sealed.alias("path"), "length", "modified").unionByName(marks)


@query("""SELECT CASE WHEN user_id % 2 = 0 THEN 'north' ELSE 'south' END AS exchange, event_type AS channel, CASE WHEN event_id % 6 = 0 THEN 'compacted' WHEN event_id % 2 = 0 THEN 'sealed' ELSE 'active' END AS state,
count(*) AS n_segments, CAST(sum(event_id) AS BIGINT) AS bytes FROM events GROUP BY 1, 2, 3""")
def segment_inventory(spark, d):
    """Log segments a state."""
    return health.segment_inventory(_segments(spark, d)).select("exchange", "channel", "state", "n_segments", "bytes")


@query("SELECT count(*) AS n FROM events WHERE event_id % 2 = 0 AND event_id % 6 <> 0")
def pending_segments(spark, d):
    """Sealed segments without a marker."""
    return catalog.pending(_segments(spark, d)).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT '/lake/wal/' || CASE WHEN user_id % 2 = 0 THEN 'north' ELSE 'south' END || '/' || event_type || '/segment-' || event_id || '-NODE_A.ndjson.sealed' AS path
FROM events WHERE event_id % 6 = 0 AND epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts) >= 86400000000""")
def removable_segments(spark, d):
    """Segments whose marker is a day old."""
    return tiers.removable_segments(_segments(spark, d), F.lit("2024-01-20 00:00:00").cast("timestamp"))


@query(f"""WITH {market_queries.TICKS}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY us, seq) AS rn FROM t), b AS (SELECT symbol, (rn - 1) // 40 AS bar, count(*) AS n, last(exchange ORDER BY us, seq) AS exchange,
min(us) AS genesis_us, CAST(sum(quantity) AS DOUBLE) AS volume FROM n GROUP BY 1, 2) SELECT symbol, exchange, genesis_us, volume FROM b WHERE n = 40""")
def venues_interleaved(spark, d):
    """Tick bars of symbols, venues interleaved."""
    got = bars.resample(ticks(spark, d), "tick_40", compat=True)
    return got.select("symbol", "exchange", us("genesis_ts").alias("genesis_us"), F.col("volume").cast("double").alias("volume"))


@query("""WITH l AS (SELECT exchange, symbol, ts_utc < lag(ts_utc) OVER (PARTITION BY exchange, symbol ORDER BY candle_id) AS back FROM candles), q AS (SELECT exchange, symbol FROM l GROUP BY 1, 2 HAVING count(*) FILTER (back) > 0)
SELECT exchange, symbol, CASE WHEN q.exchange IS NULL THEN 'kept' ELSE 'NOT_MONOTONIC' END AS outcome, count(*) AS n FROM candles c LEFT JOIN q USING (exchange, symbol) GROUP BY 1, 2, 3""")
def monotonic_or_quarantined(spark, d):
    """Sources whose instants step back in the order of their ids go to quarantine whole."""
    kept, bad = quality.ordered_or_quarantined(_t(spark, d, "candles"), ["exchange", "symbol"], "ts_utc", "candle_id")
    n = lambda df, o: df.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", o)
    return n(kept, F.lit("kept")).unionByName(bad.groupBy("exchange", "symbol", F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n")).select("exchange", "symbol", "n", "outcome"))


@query("""WITH m AS (SELECT collector_run_id, node_id, epoch_us(max(received_at)) AS at FROM orderbook_depth GROUP BY 1, 2), g AS (SELECT exchange, symbol, epoch_us(ts_utc) AS us FROM orderbook_depth WHERE ts_utc IS NOT NULL GROUP BY 1, 2, 3),
l AS (SELECT exchange, symbol, lag(us) OVER (PARTITION BY exchange, symbol ORDER BY us) AS after_us, us AS before_us FROM g)
SELECT exchange, symbol, after_us, before_us, CASE WHEN EXISTS (SELECT 1 FROM m WHERE abs(m.at - l.before_us) <= 1800000000) THEN 'UNKNOWN' ELSE 'LIKELY_NODE_DOWN' END AS cause FROM l WHERE before_us - after_us > 3600000000""")
def gap_causes(spark, d):
    """Silences of over an hour, and whether any run's last sign of life is near their end."""
    o = _t(spark, d, "orderbook_depth")
    gaps = quality.bucketed_gaps(o, ["exchange", "symbol"], "ts_utc", 3600)
    beats = o.groupBy("collector_run_id", "node_id").agg(F.max("received_at").alias("at"))
    got = reconcile.gap_causes(gaps, beats, 1800)
    return got.select("exchange", "symbol", us("after_ts").alias("after_us"), us("before_ts").alias("before_us"), "cause")


@query("""WITH k AS (SELECT exchange, symbol, min(n) AS n, min(origin) AS origin FROM (SELECT DISTINCT exchange, symbol, 'flat' AS origin, 1 AS n FROM candles UNION ALL SELECT DISTINCT exchange, symbol, 'legacy', 2 FROM exchange_metadata
WHERE (exchange, symbol) NOT IN (SELECT (exchange, symbol) FROM candles)) GROUP BY 1, 2) SELECT exchange, symbol, origin FROM k""")
def flat_or_legacy(spark, d):
    """Series of two layouts, the flat one's where both have them."""
    keys = lambda t, o: _t(spark, d, t).select("exchange", "symbol").distinct().withColumn("origin", F.lit(o))
    return reconcile.flat_first(keys("candles", "flat"), keys("exchange_metadata", "legacy"), ["exchange", "symbol"])


@query("""SELECT count(*) FILTER (s = 'blocked') AS blocked, count(*) FILTER (s = 'quarantined') AS quarantined, count(*) FILTER (s = 'pending') AS pending, count(*) FILTER (s = 'done') AS done,
CASE WHEN count(*) FILTER (s = 'blocked') > 0 THEN 'BLOCKED' WHEN count(*) FILTER (s = 'quarantined') > 0 THEN 'QUARANTINED' WHEN count(*) FILTER (s = 'pending') > 0 THEN 'RESUMABLE' ELSE 'DONE' END AS overall
FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'quarantined' END AS s FROM orders)""")
def backfill_rollup(spark, d):
    """Counts of statuses and the state of all by priority."""
    s = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("quarantined")
    return health.status_rollup(_t(spark, d, "orders").select(s.alias("s")), "s")


@query("""WITH u AS (SELECT CASE WHEN is_legacy_node THEN 'L1' ELSE 'store' END AS layer, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM chunks GROUP BY 1), r AS (SELECT layer, bytes, bytes / CASE layer WHEN 'L1' THEN 1000000.0 ELSE 20000000.0 END AS ratio FROM u)
SELECT layer, bytes, round(ratio, 9) AS ratio FROM r UNION ALL SELECT 'max', max(bytes), round(max(ratio), 9) FROM r""")
def capacity_ratios(spark, d):
    """Bytes a layer against its limit, and the highest ratio."""
    used = _t(spark, d, "chunks").select(F.when(F.col("is_legacy_node"), "L1").otherwise("store").alias("layer"), F.col("size_bytes").alias("bytes"))
    return health.capacity(used, {"L1": 1_000_000, "store": 20_000_000}).select("layer", "bytes", F.round("ratio", 9).alias("ratio"))
