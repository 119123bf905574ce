"""Queries of the market operators over whole tables, and the SQL that must give the same rows.

Ticks, books and replicas are read from ``events``, which has no market columns, through the adapters below.
Instants come out as epoch microseconds, exact decimals as text.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import hashing, normal, paths
from candlewick.operators import asof, bars, book, health, quality, reconcile, replicas, tiers
from candlewick.sources import catalog

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
INSTANT = "2024-01-16 12:00:00"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def ticks(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("decimal(16,8)")
    return e.select(
        F.col("ts").cast("timestamp").alias("ts_utc"), F.when(F.col("user_id") % 2 == 0, "north").otherwise("south").alias("exchange"), F.col("event_type").alias("symbol"),
        F.col("value").cast("decimal(20,8)").alias("price"), (k + 1).cast("decimal(16,8)").alias("quantity"), F.when(F.col("event_id") % 2 == 0, "buy").otherwise("sell").alias("side"), F.col("event_id").alias("seq"),
    )


TICKS = """t AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'north' ELSE 'south' END AS exchange, event_type AS symbol, epoch_us(ts) AS us, event_id AS seq, CAST(value AS DECIMAL(20,8)) AS price,
CAST(CAST(json_extract_string(props, '$.k') AS DECIMAL(16,8)) + 1 AS DECIMAL(16,8)) AS quantity, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side FROM events)"""


def us(c: str | Column) -> Column:
    return F.unix_micros(c)


def _bar_rows(df: DataFrame) -> DataFrame:
    return df.select("exchange", "symbol", us("genesis_ts").alias("genesis_us"), us("ts_close").alias("close_us"), *(F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume", "value")), "n_ticks")


_BAR_AGG = """CAST(first(price ORDER BY us, seq) AS VARCHAR) AS open, CAST(max(price) AS VARCHAR) AS high, CAST(min(price) AS VARCHAR) AS low, CAST(last(price ORDER BY us, seq) AS VARCHAR) AS close,
CAST(CAST(sum(quantity) AS DECIMAL(26,8)) AS VARCHAR) AS volume, CAST(CAST(sum(CAST(price AS DECIMAL(20,8)) * quantity) AS DECIMAL(38,16)) AS VARCHAR) AS value, count(*) AS n_ticks"""


def _time_sql(seconds: int) -> str:
    w = seconds * 1_000_000
    return f"""WITH {TICKS}, b AS (SELECT exchange, symbol, us // {w} AS k, {_BAR_AGG} FROM t GROUP BY 1, 2, 3),
m AS (SELECT *, max(k) OVER (PARTITION BY exchange, symbol) AS last FROM b)
SELECT exchange, symbol, k * {w} AS genesis_us, (k + 1) * {w} AS close_us, open, high, low, close, volume, value, n_ticks FROM m WHERE k < last"""


def _walk_sql(amount: str, need: int, kind: str) -> str:
    return f"""WITH RECURSIVE {TICKS}, n AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY us, seq) AS rn, CAST({amount} AS {kind}) AS a FROM t),
r AS (SELECT exchange, symbol, rn, CAST(0 AS BIGINT) AS bar, a AS total FROM n WHERE rn = 1
UNION ALL SELECT n.exchange, n.symbol, n.rn, r.bar + CASE WHEN r.total >= {need} THEN 1 ELSE 0 END, CAST(CASE WHEN r.total >= {need} THEN n.a ELSE r.total + n.a END AS {kind})
FROM r JOIN n ON n.exchange = r.exchange AND n.symbol = r.symbol AND n.rn = r.rn + 1),
b AS (SELECT exchange, symbol, bar, min(us) AS genesis_us, max(us) AS l, max(CASE WHEN total >= {need} THEN 1 ELSE 0 END) AS closed, {_BAR_AGG} FROM n JOIN r USING (exchange, symbol, rn) GROUP BY 1, 2, 3)
SELECT exchange, symbol, genesis_us, CASE WHEN l > genesis_us THEN l ELSE genesis_us + 1 END AS close_us, open, high, low, close, volume, value, n_ticks FROM b WHERE closed = 1"""


@query(_time_sql(3600))
def time_bars_1h(spark, d):
    return _bar_rows(bars.resample(ticks(spark, d), "time_3600"))


@query(_time_sql(13))
def time_bars_13s(spark, d):
    return _bar_rows(bars.resample(ticks(spark, d), "time_13"))


@query(f"""WITH {TICKS}, n AS (SELECT *, (row_number() OVER (PARTITION BY exchange, symbol ORDER BY us, seq) - 1) // 5 AS bar FROM t),
b AS (SELECT exchange, symbol, bar, min(us) AS genesis_us, max(us) AS l, {_BAR_AGG} FROM n GROUP BY 1, 2, 3)
SELECT exchange, symbol, genesis_us, CASE WHEN l > genesis_us THEN l ELSE genesis_us + 1 END AS close_us, open, high, low, close, volume, value, n_ticks FROM b WHERE n_ticks = 5""")
def tick_bars_5(spark, d):
    return _bar_rows(bars.resample(ticks(spark, d), "tick_5"))


@query(_walk_sql("quantity", 777, "DECIMAL(38,8)"))
def volume_bars(spark, d):
    return _bar_rows(bars.resample(ticks(spark, d), "vol_777"))


@query(_walk_sql("price * quantity", 20000, "DECIMAL(38,16)"))
def dollar_bars(spark, d):
    return _bar_rows(bars.resample(ticks(spark, d), "dollar_20000"))


@query(f"""WITH {TICKS}, b AS (SELECT exchange, symbol, us // 300000000 AS k, {_BAR_AGG} FROM t GROUP BY 1, 2, 3), m AS (SELECT *, max(k) OVER (PARTITION BY exchange, symbol) AS last FROM b)
SELECT exchange, symbol, '5m' AS timeframe, k * 300000000 AS ts_us, open, high, low, close, volume, value, 'transaction_derived' AS source FROM m WHERE k < last""")
def derived_candles_5m(spark, d):
    c = bars.candles(bars.time_bars(ticks(spark, d), bars.timeframe_rule("5m")), "5m")
    return c.select("exchange", "symbol", "timeframe", us("ts_utc").alias("ts_us"), *(F.col(x).cast("string").alias(x) for x in ("open", "high", "low", "close", "volume", "value")), "source")


@query(f"""WITH {TICKS} SELECT exchange, symbol, us AS ts_us, seq, CAST(price AS VARCHAR) AS price, upper(side) AS side,
exchange || ':' || symbol || ':' || us || ':' || (row_number() OVER (PARTITION BY exchange, symbol ORDER BY us, seq) - 1) AS trade_id
FROM t WHERE us >= epoch_us(TIMESTAMP '2024-01-10 00:00:00') AND us < epoch_us(TIMESTAMP '{INSTANT}')""")
def scan_window(spark, d):
    """Half-open window of ticks in one spelling of side, with ids by position in the series' order."""
    t = ticks(spark, d).where((F.col("ts_utc") >= F.lit("2024-01-10 00:00:00").cast("timestamp")) & (F.col("ts_utc") < F.lit(INSTANT).cast("timestamp")))
    return bars.trades(t).select("exchange", "symbol", us("ts_utc").alias("ts_us"), "seq", F.col("price").cast("string").alias("price"), "side", F.concat_ws(":", "exchange", "symbol", us("ts_utc"), "position").alias("trade_id"))


@query(f"""WITH {TICKS} SELECT seq, upper(side) AS side, exchange || ':' || symbol || ':' || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S') || CASE WHEN us % 1000000 = 0 THEN '' ELSE strftime(make_timestamp(us), '.%f') END || '+00:00:'
|| (row_number() OVER (PARTITION BY exchange, symbol ORDER BY us, seq) - 1) AS trade_id FROM t""")
def trade_ids(spark, d):
    """Every tick with its side and id."""
    return bars.trades(ticks(spark, d)).select("seq", "side", "trade_id")


@query("""WITH p AS (SELECT DISTINCT exchange, symbol, epoch_us(fetched_at) + 43200000000 AS at FROM exchange_metadata),
m AS (SELECT exchange, symbol, epoch_us(fetched_at) AS f, max(struct_pack(t := tick_size, a := asset_status)) AS v FROM exchange_metadata GROUP BY 1, 2, 3)
SELECT p.exchange, p.symbol, p.at AS at_us, CAST(m.v.t AS VARCHAR) AS asof_tick_size, m.v.a AS asof_asset_status FROM p ASOF LEFT JOIN m ON p.exchange = m.exchange AND p.symbol = m.symbol AND p.at >= m.f""")
def asof_metadata(spark, d):
    m = _t(spark, d, "exchange_metadata")
    probes = m.select("exchange", "symbol", F.timestamp_micros(us("fetched_at") + 43_200_000_000).alias("at")).distinct()
    got = asof.asof(probes, m, ["exchange", "symbol"], "at", "fetched_at", ["tick_size", "asset_status"], bucket_s=7 * 86_400)
    return got.select("exchange", "symbol", us("at").alias("at_us"), F.col("asof_tick_size").cast("string").alias("asof_tick_size"), "asof_asset_status")


@query("""SELECT exchange, symbol, arg_max(CAST(tick_size AS VARCHAR), fetched_at) AS tick_size, epoch_us(max(fetched_at)) AS fetched_us FROM
(SELECT DISTINCT exchange, symbol, fetched_at, coalesce(tick_size, -1) AS tick_size FROM exchange_metadata WHERE fetched_at <= TIMESTAMPTZ '2025-02-01 00:00:00+00') GROUP BY 1, 2""")
def metadata_at(spark, d):
    m = _t(spark, d, "exchange_metadata").select("exchange", "symbol", "fetched_at", F.coalesce("tick_size", F.lit(-1).cast("decimal(38,18)")).alias("tick_size"))
    got = asof.at_instant(m, ["exchange", "symbol"], "fetched_at", "2025-02-01 00:00:00")
    return got.select("exchange", "symbol", F.col("tick_size").cast("string").alias("tick_size"), us("fetched_at").alias("fetched_us"))


@query("""SELECT exchange, symbol, timeframe, epoch_us(ts_utc) AS ts_us, candle_id FROM (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, timeframe, ts_utc ORDER BY source_ingested_at DESC NULLS LAST, candle_id) AS k FROM candles) WHERE k = 1""")
def dedup_candles(spark, d):
    got = replicas.latest(_t(spark, d, "candles"), replicas.CANDLE_KEY, "source_ingested_at", [F.col("candle_id")])
    return got.select("exchange", "symbol", "timeframe", us("ts_utc").alias("ts_us"), "candle_id")


def _two_nodes(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d)
    a = t.withColumns({"node_id": F.lit("NODE_A"), "raw_json": F.concat(F.lit("a"), "seq"), "arrival": F.col("seq") * 2 + 1})
    b = t.withColumns({"node_id": F.lit("NODE_B"), "raw_json": F.when(F.col("seq") % 50 == 0, F.concat(F.lit("b"), "seq")).otherwise(F.concat(F.lit("a"), "seq")), "arrival": F.col("seq") * 2})
    return a.unionByName(b)


_COPIES = f"""{TICKS}, c AS (SELECT *, 'NODE_A' AS node, 'a' || seq AS raw, seq * 2 + 1 AS arrival FROM t UNION ALL SELECT *, 'NODE_B' AS node, CASE WHEN seq % 50 = 0 THEN 'b' || seq ELSE 'a' || seq END AS raw, seq * 2 AS arrival FROM t)"""


def fold_sql(copies: str, key: str, columns: str) -> str:
    """The fold over each key's copies in order of arrival, walked copy by copy."""
    same = "f.raw IS NULL OR n.raw IS NULL OR f.raw = n.raw"
    return f"""WITH RECURSIVE {copies}, n AS (SELECT *, dense_rank() OVER (ORDER BY {key}) AS g, row_number() OVER (PARTITION BY {key} ORDER BY arrival) AS rn FROM c),
f AS (SELECT g, rn, node, raw, 0 AS n_skipped, 0 AS n_conflicts FROM n WHERE rn = 1
UNION ALL SELECT n.g, n.rn, CASE WHEN NOT ({same}) AND n.node < f.node THEN n.node ELSE f.node END, CASE WHEN NOT ({same}) AND n.node < f.node THEN n.raw ELSE f.raw END,
f.n_skipped + CASE WHEN {same} THEN 1 ELSE 0 END, f.n_conflicts + CASE WHEN {same} THEN 0 ELSE 1 END FROM f JOIN n ON n.g = f.g AND n.rn = f.rn + 1),
z AS (SELECT g, max(rn) AS last FROM n GROUP BY 1)
SELECT {columns}, f.node AS node_id, f.n_skipped, f.n_conflicts FROM f JOIN z ON f.g = z.g AND f.rn = z.last JOIN n ON n.g = f.g AND n.rn = 1"""


@query(fold_sql(_COPIES, "exchange, symbol, us, price, quantity, side", "n.exchange, n.symbol, n.us AS ts_us, CAST(n.price AS VARCHAR) AS price, n.side"))
def dedup_ticks(spark, d):
    got = replicas.folded(_two_nodes(spark, d), replicas.TICK_KEY, "arrival")
    return got.select("exchange", "symbol", us("ts_utc").alias("ts_us"), F.col("price").cast("string").alias("price"), "side", "node_id", F.col("n_skipped").cast("int").alias("n_skipped"), F.col("n_conflicts").cast("int").alias("n_conflicts"))


@query(f"""WITH {_COPIES}, q AS (SELECT *, CASE WHEN seq % 3 = 0 AND node = 'NODE_B' THEN 2 ELSE 1 END AS iseq, row_number() OVER w AS rn, count(*) OVER (PARTITION BY exchange, symbol, us, price, quantity, side) AS n
FROM c WINDOW w AS (PARTITION BY exchange, symbol, us, price, quantity, side ORDER BY arrival)),
p AS (SELECT a.*, b.node AS node2, a.raw = b.raw AND a.iseq = b.iseq AS again, a.raw <> b.raw AS clash FROM q a JOIN q b ON a.exchange = b.exchange AND a.symbol = b.symbol AND a.us = b.us AND a.price = b.price AND a.quantity = b.quantity AND a.side = b.side
WHERE a.rn = 1 AND b.rn = 2 AND a.n = 2)
SELECT exchange, symbol, us AS ts_us, CAST(price AS VARCHAR) AS price, side, CASE WHEN again OR clash THEN 1 ELSE 2 END AS n_kept, CASE WHEN clash AND node2 < node THEN node2 ELSE node END AS first_node,
CASE WHEN again THEN 1 ELSE 0 END AS n_skipped, CASE WHEN clash THEN 1 ELSE 0 END AS n_conflicts FROM p""")
def dedup_ticks_v11(spark, d):
    two = _two_nodes(spark, d).withColumnRenamed("raw_json", "payload_hash")
    two = two.withColumn("ingest_seq", F.when((F.col("seq") % 3 == 0) & (F.col("node_id") == "NODE_B"), 2).otherwise(1))
    got = replicas.folded_v11(two, "arrival")
    n = lambda c: F.col(c).cast("int").alias(c)
    return got.select("exchange", "symbol", us("ts_utc").alias("ts_us"), F.col("price").cast("string").alias("price"), "side", F.size("kept").alias("n_kept"), F.col("kept")[0]["node_id"].alias("first_node"), n("n_skipped"), n("n_conflicts"))


@query("""WITH f AS (SELECT exchange, symbol, fetched_date, min(struct_pack(a := fetched_at, h := data_hash)) AS v FROM exchange_metadata GROUP BY 1, 2, 3),
n AS (SELECT exchange, symbol, fetched_date, fetched_at, data_hash, count(*) AS copies FROM exchange_metadata GROUP BY 1, 2, 3, 4, 5)
SELECT CASE WHEN fetched_at = v.a AND data_hash = v.h THEN 'written' WHEN data_hash = v.h THEN 'skipped' ELSE 'quarantined' END AS outcome, count(*) AS n, CAST(sum(copies) AS BIGINT) AS copies FROM n JOIN f USING (exchange, symbol, fetched_date) GROUP BY 1""")
def metadata_outcomes(spark, d):
    got = replicas.classified_metadata(_t(spark, d, "exchange_metadata"))
    return got.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"))


_BOOK_EVENTS = """e AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'north' ELSE 'south' END AS exchange, event_type AS symbol, epoch_us(ts) AS us, event_id AS seq, CASE WHEN event_id % 1000 = 0 THEN 'snapshot' ELSE 'delta' END AS kind,
CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, CAST(floor(value / 10) * 10 AS BIGINT) AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS quantity FROM events)"""


def _book_events(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    return e.select(
        F.col("ts").cast("timestamp").alias("ts_utc"), F.when(F.col("user_id") % 2 == 0, "north").otherwise("south").alias("exchange"), F.col("event_type").alias("symbol"), F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 1000 == 0, "snapshot").otherwise("delta").alias("event_type"), F.when(F.col("event_id") % 2 == 0, "bid").otherwise("ask").alias("side"),
        (F.floor(F.col("value") / 10) * 10).cast("bigint").alias("price"), (F.get_json_object("props", "$.k").cast("bigint") % 5).alias("quantity"),
    )


_BOOK = f"""WITH {_BOOK_EVENTS}, k AS (SELECT * FROM e WHERE us <= epoch_us(TIMESTAMP '{INSTANT}')), b AS (SELECT exchange, symbol, max(us) AS base FROM k WHERE kind = 'snapshot' GROUP BY 1, 2),
s AS (SELECT k.* FROM k JOIN b USING (exchange, symbol) WHERE us > base OR us = base AND kind = 'snapshot'),
l AS (SELECT exchange, symbol, side, price, last(quantity ORDER BY us, seq) AS quantity FROM s GROUP BY 1, 2, 3, 4), w AS (SELECT * FROM l WHERE quantity > 0)"""


@query(f"{_BOOK} SELECT * FROM w")
def book_at(spark, d):
    return book.book_at(_book_events(spark, d), INSTANT)


@query(f"""{_BOOK} SELECT exchange, symbol, max(price) FILTER (side = 'bid') AS bid_price, arg_max(quantity, price) FILTER (side = 'bid') AS bid_quantity,
min(price) FILTER (side = 'ask') AS ask_price, arg_min(quantity, price) FILTER (side = 'ask') AS ask_quantity FROM w GROUP BY 1, 2""")
def top_of_book(spark, d):
    return book.top_of_book(book.book_at(_book_events(spark, d), INSTANT))


@query(f"""WITH {_BOOK_EVENTS}, g AS (SELECT exchange, symbol, us // 3600000000 AS h, side, list(struct_pack(price := price, quantity := quantity) ORDER BY us, seq) AS l FROM e GROUP BY 1, 2, 3, 4)
SELECT exchange, symbol, h, side, unnest(range(len(l)))::INT AS level, unnest(l).price AS price, unnest(l).quantity AS quantity FROM g""")
def snapshot_flatten(spark, d):
    """An hour's levels packed as a snapshot event with arrays, and flattened again."""
    e = _book_events(spark, d).withColumn("h", normal.bucket(us("ts_utc"), 3_600_000_000))
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("ts_utc", "seq", "price", "quantity")))), lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity")))
    packed = e.groupBy("exchange", "symbol", "h").agg(side("bid").alias("bids"), side("ask").alias("asks"))
    return book.flatten_snapshots(packed).select("exchange", "symbol", "h", "side", "level", "price", "quantity")


@query("""WITH c AS (SELECT exchange, symbol, epoch_us(ts_utc) AS us, candle_id FROM candles), g AS (SELECT DISTINCT exchange, symbol, us FROM c),
l AS (SELECT *, lag(us) OVER (PARTITION BY exchange, symbol ORDER BY us) AS before FROM g) SELECT exchange, symbol, before AS after_us, us AS before_us, (us - before) / 1e6 AS gap_s FROM l WHERE us - before > 60000000""")
def gap_list(spark, d):
    got = quality.bucketed_gaps(_t(spark, d, "candles"), ["exchange", "symbol"], "ts_utc", 60)
    return got.select("exchange", "symbol", us("after_ts").alias("after_us"), us("before_ts").alias("before_us"), "gap_s")


@query("""SELECT exchange, symbol, epoch_us(min(ts_utc)) AS first_us, epoch_us(max(ts_utc)) AS last_us, count(*) AS n_rows, count(DISTINCT node_id) AS n_nodes, count(DISTINCT collector_run_id) AS n_runs,
count(DISTINCT CAST(ts_utc AT TIME ZONE 'UTC' AS DATE)) AS n_days FROM orderbook_depth GROUP BY 1, 2""")
def coverage(spark, d):
    got = health.coverage(_t(spark, d, "orderbook_depth"))
    return got.select("exchange", "symbol", us("first_ts").alias("first_us"), us("last_ts").alias("last_us"), "n_rows", "n_nodes", "n_runs", "n_days")


_GAPS = """g AS (SELECT DISTINCT {key}, epoch_us(ts_utc) AS us FROM orderbook_depth WHERE ts_utc IS NOT NULL), l AS (SELECT *, us - lag(us) OVER (PARTITION BY {key} ORDER BY us) AS d FROM g),
s AS (SELECT {key}, count(*) FILTER (d > 300000000) AS n_gaps, coalesce(max(d) FILTER (d > 300000000), 0) / 1e6 AS longest_gap_s FROM l GROUP BY {key})"""


@query(f"WITH {_GAPS.format(key='exchange, symbol')} SELECT * FROM s")
def coverage_gaps(spark, d):
    """How many silences of over five minutes a source has, and the longest."""
    return health.coverage(_t(spark, d, "orderbook_depth")).select("exchange", "symbol", "n_gaps", "longest_gap_s")


@query(f"WITH {_GAPS.format(key='exchange, symbol, node_id')} SELECT * FROM s")
def node_gaps(spark, d):
    """The same of each node by itself."""
    return health.node_coverage(_t(spark, d, "orderbook_depth")).select("exchange", "symbol", "node_id", "n_gaps", "longest_gap_s")


@query("""SELECT exchange, symbol, node_id, epoch_us(min(ts_utc)) AS first_us, epoch_us(max(ts_utc)) AS last_us, count(*) AS n_rows, max(epoch_us(received_at) - epoch_us(ts_utc)) AS worst_delay_us FROM orderbook_depth GROUP BY 1, 2, 3""")
def node_coverage(spark, d):
    got = health.node_coverage(_t(spark, d, "orderbook_depth"))
    return got.select("exchange", "symbol", "node_id", us("first_ts").alias("first_us"), us("last_ts").alias("last_us"), "n_rows", "worst_delay_us")


@query("""SELECT CASE WHEN ts_utc < TIMESTAMPTZ '2025-01-01 00:00:00+00' THEN 'legacy_candle' ELSE 'transaction_derived' END AS provenance, count(*) AS n FROM candles GROUP BY 1""")
def provenance(spark, d):
    return _t(spark, d, "candles").groupBy(quality.provenance(F.col("ts_utc"), "2025-01-01").alias("provenance")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT candle_id, CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR ts_utc IS NULL OR exchange IS NULL OR symbol IS NULL OR timeframe IS NULL THEN 'SCHEMA_MISMATCH' ELSE 'VALUE_OUT_OF_RANGE' END AS reason,
CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR ts_utc IS NULL OR exchange IS NULL OR symbol IS NULL OR timeframe IS NULL THEN 'HALT' ELSE 'QUARANTINE' END AS decision
FROM candles WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR ts_utc IS NULL OR exchange IS NULL OR symbol IS NULL OR timeframe IS NULL
OR least(open, high, low, close) <= 0 OR volume < 0 OR high < greatest(open, close, low) OR low > least(open, close)""")
def range_violations(spark, d):
    reason = F.when(quality.lacks_field(), "SCHEMA_MISMATCH").when(quality.out_of_range(), "VALUE_OUT_OF_RANGE")
    return _t(spark, d, "candles").select("candle_id", reason.alias("reason")).where("reason is not null").withColumn("decision", quality.decision(F.col("reason")))


_LACKS = "open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR ts_utc IS NULL OR exchange IS NULL OR symbol IS NULL OR timeframe IS NULL"
_WRONG = "coalesce(least(open, high, low, close) <= 0 OR volume < 0 OR high < greatest(open, close, low) OR low > least(open, close), FALSE)"


@query(f"""WITH RECURSIVE n AS (SELECT candle_id, exchange || ' ' || symbol || ' ' || timeframe AS s, epoch_us(ts_utc) AS us, struct_pack(o := open, h := high, l := low, c := close, v := volume, w := value) AS v, {_WRONG} AS wrong,
CASE timeframe WHEN '1m' THEN 60 WHEN '5m' THEN 300 WHEN '15m' THEN 900 WHEN '1h' THEN 3600 WHEN '4h' THEN 14400 WHEN '1d' THEN 86400 ELSE 60 END * 1000000 AS bar,
row_number() OVER (PARTITION BY exchange, symbol, timeframe ORDER BY ts_utc, source_ingested_at NULLS FIRST, candle_id) AS rn FROM candles WHERE NOT ({_LACKS})),
o AS (SELECT candle_id, s, rn, us, v, CASE WHEN wrong THEN 'VALUE_OUT_OF_RANGE' ELSE 'accepted' END AS outcome, CASE WHEN NOT wrong THEN us END AS last_us, CASE WHEN NOT wrong THEN v END AS last_v FROM n WHERE rn = 1
UNION ALL SELECT q.candle_id, q.s, q.rn, q.us, q.v, q.outcome, CASE WHEN q.outcome = 'accepted' THEN q.us ELSE q.last_us END, CASE WHEN q.outcome = 'accepted' THEN q.v ELSE q.last_v END FROM (
SELECT n.*, o.last_us, o.last_v, CASE WHEN n.us - o.last_us > n.bar THEN 'GAP' WHEN n.wrong THEN 'VALUE_OUT_OF_RANGE' WHEN n.us = o.last_us THEN CASE WHEN n.v IS NOT DISTINCT FROM o.last_v THEN 'DUPLICATE_SAME_HASH' ELSE 'DUPLICATE_DIFFERENT_HASH' END
ELSE 'accepted' END AS outcome FROM o JOIN n ON n.s = o.s AND n.rn = o.rn + 1) q)
SELECT candle_id, outcome FROM o UNION ALL SELECT candle_id, 'SCHEMA_MISMATCH' AS outcome FROM candles WHERE {_LACKS}""")
def policy_pipeline(spark, d):
    return quality.policy_pipeline(_t(spark, d, "candles"), "source_ingested_at")


@query("""WITH RECURSIVE n AS (SELECT depth_id, exchange || ' ' || symbol AS s, epoch_us(ts_utc) AS us, row_number() OVER (PARTITION BY exchange, symbol ORDER BY ts_utc, depth_id) AS rn FROM orderbook_depth WHERE ts_utc IS NOT NULL),
r AS (SELECT depth_id, s, rn, us AS last, TRUE AS ok FROM n WHERE rn = 1
UNION ALL SELECT n.depth_id, n.s, n.rn, CASE WHEN n.us - r.last >= 1000000 THEN n.us ELSE r.last END, n.us - r.last >= 1000000 FROM r JOIN n ON n.s = r.s AND n.rn = r.rn + 1) SELECT depth_id FROM r WHERE ok""")
def throttled_depth(spark, d):
    """Depth rows of each series at least a second after the last accepted one."""
    o = _t(spark, d, "orderbook_depth").select("exchange", "symbol", "ts_utc", "depth_id")
    return quality.throttled(o, ["exchange", "symbol"], "ts_utc", 1.0, "depth_id").select("depth_id")


_HASHED = """sha256(strftime(ts_utc AT TIME ZONE 'UTC', '%Y-%m-%d{}%H:%M:%S.%f') || '+00:00|' || CAST(open AS VARCHAR) || '|' || CAST(high AS VARCHAR) || '|' || CAST(low AS VARCHAR) || '|' || CAST(close AS VARCHAR) || '|' || CAST(volume AS VARCHAR))"""


@query(f"SELECT candle_id, {_HASHED.format('T')} AS hash_t, {_HASHED.format(' ')} AS hash_space FROM candles")
def data_hash(spark, d):
    return _t(spark, d, "candles").select("candle_id", hashing.candle_hash("T").alias("hash_t"), hashing.candle_hash(" ").alias("hash_space"))


@query(f"""WITH s AS (SELECT candle_id, {_HASHED.format('T')} AS h, exchange, symbol, timeframe, ts_utc FROM candles),
f AS (SELECT exchange, symbol, timeframe, ts_utc, min(candle_id) AS first FROM s GROUP BY 1, 2, 3, 4)
SELECT a.candle_id, CASE WHEN a.candle_id = f.first THEN 'UNIQUE' WHEN a.h IS NOT DISTINCT FROM b.h THEN 'SAME_HASH' ELSE 'HASH_CONFLICT' END AS status
FROM s a JOIN f ON a.exchange IS NOT DISTINCT FROM f.exchange AND a.symbol IS NOT DISTINCT FROM f.symbol AND a.timeframe IS NOT DISTINCT FROM f.timeframe AND a.ts_utc IS NOT DISTINCT FROM f.ts_utc JOIN s b ON b.candle_id = f.first""")
def duplicate_status(spark, d):
    """Each candle against the first of its key, by the hash of instant and OHLCV."""
    return replicas.duplicate_status(_t(spark, d, "candles"))


@query("""SELECT event_id, CAST(CAST(CAST(value AS DECIMAL(20,8)) * 100000000 AS DECIMAL(38,0)) AS VARCHAR) AS scaled, CAST(CAST(value AS DECIMAL(20,8)) AS VARCHAR) AS price FROM events""")
def scaled_int(spark, d):
    p = F.col("value").cast("decimal(20,8)")
    return _t(spark, d, "events").select("event_id", hashing.scaled(p, 8).cast("string").alias("scaled"), p.cast("string").alias("price"))


_PATH = "replace(source_path, '\\', '/')"


@query(f"""SELECT chunk_id, nullif(regexp_extract({_PATH}, '/exchange=([^/]+)', 1), '') AS exchange, nullif(regexp_extract({_PATH}, '/symbol=([^/]+)', 1), '') AS symbol, nullif(regexp_extract({_PATH}, '/date=([^/]+)', 1), '') AS date,
nullif(regexp_extract({_PATH}, '/hour=([^/]+)', 1), '') AS hour, coalesce(nullif(regexp_extract({_PATH}, '/node=([^/]+)', 1), ''), 'DEFAULT') AS node, nullif(regexp_extract({_PATH}, '/tier=([^/]+)', 1), '') AS tier FROM chunks""")
def path_fields(spark, d):
    p = F.col("source_path")
    return _t(spark, d, "chunks").select("chunk_id", *(paths.hive(p, k).alias(k) for k in ("exchange", "symbol", "date", "hour")), paths.node(p).alias("node"), paths.hive(p, "tier").alias("tier"))


@query("""WITH k AS (SELECT DISTINCT regexp_replace(regexp_replace(regexp_replace(replace(nas_object_key, '\\', '/'), '/+', '/', 'g'), '(/\\.)+/', '/', 'g'), '^l1/', '') AS key, chunk_id FROM chunks WHERE nas_object_key IS NOT NULL)
SELECT CASE WHEN contains(key, '/node=') THEN key ELSE regexp_replace(key, '(/date=[^/]+(/hour=[^/]+)?)/', '\\1/node=DEFAULT/') END AS key, count(DISTINCT chunk_id) AS n_chunks FROM k GROUP BY 1 HAVING count(DISTINCT chunk_id) > 1""")
def contested_keys(spark, d):
    """Object keys, in canonical form, that more than one file claims."""
    c = _t(spark, d, "chunks").where(F.col("nas_object_key").isNotNull())
    return c.groupBy(paths.canonical_key(F.col("nas_object_key")).alias("key")).agg(F.count_distinct("chunk_id").alias("n_chunks")).where("n_chunks > 1")


def _files(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("source_path")
    return _t(spark, d, "chunks").select("chunk_id", paths.hive(p, "exchange").alias("exchange"), normal.symbol(F.col("symbol")).alias("symbol"), "date", F.col("size_bytes").alias("bytes"), F.col("discovered_at").alias("modified"), "n_rows")


_SYMBOL = "CASE WHEN contains(symbol, '_') THEN upper(split_part(trim(symbol), '_', 2) || '-' || split_part(trim(symbol), '_', 1)) ELSE upper(trim(symbol)) END"
_FILES = f"f AS (SELECT chunk_id, regexp_extract({_PATH}, '/exchange=([^/]+)', 1) AS exchange, {_SYMBOL} AS symbol, date, size_bytes AS bytes, discovered_at AS modified, n_rows FROM chunks)"


@query(f"""WITH {_FILES} SELECT CASE grouping(exchange, symbol, date) WHEN 7 THEN 'total' WHEN 1 THEN 'series' ELSE 'day' END AS level, exchange, symbol, date, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes, count(*) AS n_files
FROM f GROUP BY GROUPING SETS ((exchange, symbol), (date), ())""")
def health_volume(spark, d):
    return health.volume(_files(spark, d))


@query(f"WITH {_FILES} SELECT exchange, symbol, date, count(*) AS n_files FROM f GROUP BY 1, 2, 3")
def health_file_counts(spark, d):
    return health.file_counts(_files(spark, d))


@query(f"""WITH {_FILES}, l AS (SELECT exchange, greatest((epoch_us(TIMESTAMPTZ '2025-03-15 00:00:00+00') - epoch_us(max(modified))) / 1e6, 0.0) AS lag_s FROM f GROUP BY 1)
SELECT exchange, lag_s, CASE WHEN lag_s <= 60 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM l""")
def health_lag(spark, d):
    got = health.lag_seconds(_files(spark, d), F.lit("2025-03-15 00:00:00").cast("timestamp"))
    return got.withColumn("verdict", health.lag_verdict(F.col("lag_s"), 60))


@query(f"""WITH {_FILES}, p AS (SELECT DISTINCT exchange, symbol, CAST(date AS DATE) AS day FROM f), r AS (SELECT exchange, symbol, min(day) AS a, max(day) AS b FROM p GROUP BY 1, 2),
g AS (SELECT exchange, symbol, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM r) SELECT exchange, symbol, strftime(day, '%Y-%m-%d') AS day FROM g ANTI JOIN p USING (exchange, symbol, day)""")
def partition_gap(spark, d):
    f = _files(spark, d).select("exchange", "symbol", F.to_date("date").alias("day"))
    return reconcile.grid_gaps(f, ["exchange", "symbol"], "day").select("exchange", "symbol", F.col("day").cast("string").alias("day"))


_BARKEY = "bar_label, genesis_us, ts_close_us, exchange, symbol"


def _unique_bars(spark: SparkSession, d: str, name: str) -> DataFrame:
    from candlewick.operators import chunk_diff

    b = chunk_diff.bars(_t(spark, d, name))
    return b.groupBy(*chunk_diff.BAR_KEY).agg(F.min(F.struct(*chunk_diff.BAR_FIELDS)).alias("v")).select(*chunk_diff.BAR_KEY, "v.*")


_UNIQUE = f"""(SELECT bar_label, epoch_us(CAST(genesis_ts AS TIMESTAMPTZ)) AS genesis_us, epoch_us(CAST(ts_close AS TIMESTAMPTZ)) AS ts_close_us, lower(trim(exchange)) AS exchange, {_SYMBOL} AS symbol,
min(struct_pack(open := open, high := high, low := low, close := close, volume := volume, value := value)) AS v FROM {{}} GROUP BY 1, 2, 3, 4, 5)"""
_STATUS = f"""s AS (SELECT {_BARKEY}, CASE WHEN h.v IS NULL THEN 'right_only' WHEN c.v IS NULL THEN 'left_only' WHEN h.v = c.v THEN 'matched' ELSE 'mismatch' END AS status
FROM {_UNIQUE.format("hot_bars")} h FULL JOIN {_UNIQUE.format("cold_bars")} c USING ({_BARKEY}))"""


def _hot_cold(spark: SparkSession, d: str) -> DataFrame:
    from candlewick.operators import chunk_diff

    return reconcile.keyed_diff(_unique_bars(spark, d, "hot_bars"), _unique_bars(spark, d, "cold_bars"), chunk_diff.BAR_KEY, chunk_diff.BAR_FIELDS)


@query(f"WITH {_STATUS} SELECT * FROM s WHERE status <> 'matched'")
def hot_cold_diff(spark, d):
    return _hot_cold(spark, d).where("status <> 'matched'")


@query(f"""WITH {_STATUS}, n AS (SELECT count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'mismatch') AS mismatch, count(*) FILTER (status = 'left_only') AS left_only, count(*) FILTER (status = 'right_only') AS right_only FROM s)
SELECT *, round(CAST(mismatch + left_only + right_only AS DOUBLE) / greatest(matched + mismatch + left_only, matched + mismatch + right_only), 9) AS drift FROM n""")
def drift(spark, d):
    return reconcile.drift(_hot_cold(spark, d)).withColumn("drift", F.round(F.col("drift").cast("double"), 9))


@query(f"""WITH {TICKS}, a AS (SELECT exchange, symbol, us // 3600000000 AS k, CAST(sum(quantity) AS DECIMAL(27,8)) AS volume FROM t GROUP BY 1, 2, 3),
b AS (SELECT exchange, symbol, k, CASE WHEN k % 10 = 0 THEN volume + 1 ELSE volume END AS volume FROM a),
j AS (SELECT coalesce(a.exchange, b.exchange) AS exchange, coalesce(a.symbol, b.symbol) AS symbol, a.volume IS DISTINCT FROM b.volume AS bad FROM a FULL JOIN b ON a.exchange = b.exchange AND a.symbol = b.symbol AND a.k = b.k)
SELECT exchange, symbol, count(*) AS n_bars, count(*) FILTER (bad) AS n_mismatches, count(*) FILTER (bad) / CAST(count(*) AS DOUBLE) AS share FROM j GROUP BY 1, 2""")
def dual_write_diff(spark, d):
    """Hourly volumes against a copy in which every tenth is altered."""
    t = ticks(spark, d).withColumn("k", normal.bucket(us("ts_utc"), 3_600_000_000))
    a = t.groupBy("exchange", "symbol", "k").agg(F.sum("quantity").cast("decimal(27,8)").alias("volume"))
    b = a.withColumn("volume", F.when(F.col("k") % 10 == 0, (F.col("volume") + 1).cast("decimal(27,8)")).otherwise(F.col("volume")))
    diff = reconcile.keyed_diff(a, b, ["exchange", "symbol", "k"], ["volume"])
    bad = F.count(F.when(F.col("status") != "matched", 1))
    return diff.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n_bars"), bad.alias("n_mismatches"), (bad / F.count(F.lit(1))).alias("share"))


@query("""SELECT c.chunk_id, c.n_rows, coalesce(r.n, 0) AS n_stored, CASE WHEN r.n IS NULL THEN 'SKIP' WHEN r.n = c.n_rows THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (SELECT chunk_id, max(n_rows) AS n_rows FROM chunks GROUP BY 1) c LEFT JOIN (SELECT chunk_id, count(*) AS n FROM chunk_rows GROUP BY 1) r USING (chunk_id)""")
def listed_counts(spark, d):
    """Row counts as listed against those stored."""
    c = _t(spark, d, "chunks").groupBy("chunk_id").agg(F.max("n_rows").alias("n_left"))
    n = _t(spark, d, "chunk_rows").groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_right"))
    got = reconcile.compared_counts(c, n, ["chunk_id"]).where("n_left is not null")
    return got.select("chunk_id", F.col("n_left").alias("n_rows"), F.coalesce("n_right", F.lit(0)).alias("n_stored"), "verdict")


@query("SELECT DISTINCT chunk_id FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM chunk_rows WHERE chunk_id IS NOT NULL)")
def missing_chunks(spark, d):
    return reconcile.missing(_t(spark, d, "chunks"), _t(spark, d, "chunk_rows"), ["chunk_id"])


@query("""WITH s AS (SELECT exchange, symbol, max(acc_trade_value_24h) AS v FROM exchange_metadata GROUP BY 1, 2) SELECT exchange, symbol, CAST(v AS VARCHAR) AS value_24h FROM s WHERE v IS NOT NULL ORDER BY v DESC, exchange, symbol LIMIT 10""")
def top_n(spark, d):
    """The ten symbols of the greatest value."""
    s = _t(spark, d, "exchange_metadata").groupBy("exchange", "symbol").agg(F.max("acc_trade_value_24h").alias("v")).where("v is not null")
    return s.orderBy(F.desc("v"), "exchange", "symbol").limit(10).select("exchange", "symbol", F.col("v").cast("string").alias("value_24h"))


@query("""SELECT exchange, symbol, CAST(ts_utc AT TIME ZONE 'UTC' AS DATE)::VARCHAR AS date, strftime(ts_utc AT TIME ZONE 'UTC', '%H') AS hour, count(*) AS n_rows, epoch_us(min(ts_utc)) AS first_us, epoch_us(max(ts_utc)) AS last_us FROM orderbook_depth GROUP BY 1, 2, 3, 4""")
def l2_hour_merge(spark, d):
    """The merge itself: what each hour's merged files hold."""
    got = tiers.merge_report(_t(spark, d, "orderbook_depth"), "hour")
    return got.select("exchange", "symbol", F.col("date").cast("string").alias("date"), "hour", "n_rows", us("first_ts").alias("first_us"), us("last_ts").alias("last_us"))


@query(f"""WITH {TICKS} SELECT exchange, symbol, us AS ts_us, seq, 'OK' AS validation_status, TRUE AS no_hash FROM t""")
def tick_upgrade(spark, d):
    t = ticks(spark, d).withColumns({"received_at": F.col("ts_utc"), "raw_json": F.lit(None).cast("string")})
    got = tiers.upgrade_ticks(t.select("ts_utc", "received_at", "exchange", "symbol", "price", "quantity", F.concat("side", F.lit(":"), "seq").alias("side"), "raw_json"))
    return got.select("exchange", "symbol", us("ts_utc").alias("ts_us"), F.split_part("side", F.lit(":"), F.lit(2)).cast("bigint").alias("seq"), "validation_status", F.col("payload_hash").isNull().alias("no_hash"))


@query(f"""WITH {TICKS} SELECT exchange, symbol, us AS ts_us, seq, CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity FROM t""")
def wal_round_trip(spark, d):
    """Ticks written as JSON lines and decoded with exact decimals."""
    t = ticks(spark, d).select("ts_utc", "exchange", "symbol", F.col("price").cast("decimal(38,18)").alias("price"), F.col("quantity").cast("decimal(38,18)").alias("quantity"), F.concat("side", F.lit(":"), "seq").alias("side"), F.lit("transaction").alias("channel"))
    r = catalog.numbered_lines(catalog.encoded(t).withColumn("file", F.lit("log")), "transaction").withColumn("ts_utc", F.to_timestamp("ts_utc"))
    text = lambda c, kind: F.col(c).cast(kind).cast("string").alias(c)
    return r.select("exchange", "symbol", us("ts_utc").alias("ts_us"), F.split_part("side", F.lit(":"), F.lit(2)).cast("bigint").alias("seq"), text("price", "decimal(20,8)"), text("quantity", "decimal(16,8)"))


@query("""SELECT node_id, quantile_disc(epoch_us(received_at) - epoch_us(ts_utc), 0.99) AS p99_us, CAST(avg(epoch_us(received_at) - epoch_us(ts_utc)) AS BIGINT) AS mean_us FROM orderbook_depth GROUP BY 1""")
def delay_p99(spark, d):
    """Nearest-rank percentile and mean of the delays a node."""
    x = _t(spark, d, "orderbook_depth").select("node_id", (us("received_at") - us("ts_utc")).alias("x"))
    p99 = health.nearest_rank(x, ["node_id"], "x", 0.99).select("node_id", F.col("x").alias("p99_us"))  # a row a node, as are the means
    return p99.join(x.groupBy("node_id").agg(F.round(F.avg("x")).cast("bigint").alias("mean_us")), "node_id")


@query("""SELECT node_id, epoch_us(max(received_at)) AS last_us, CASE WHEN (epoch_us(TIMESTAMPTZ '2025-03-15 00:00:00+00') - epoch_us(max(received_at))) / 1e6 <= 30 THEN 'GREEN'
WHEN (epoch_us(TIMESTAMPTZ '2025-03-15 00:00:00+00') - epoch_us(max(received_at))) / 1e6 <= 60 THEN 'YELLOW' ELSE 'RED' END AS level FROM orderbook_depth GROUP BY 1""")
def node_status(spark, d):
    """Level of each collector node by its last delivery."""
    o = _t(spark, d, "orderbook_depth").select("node_id", F.col("received_at").alias("at"))
    return health.node_levels(o, F.lit("2025-03-15 00:00:00").cast("timestamp"), 30, 60).select("node_id", us("last_at").alias("last_us"), "level")


@query("""WITH d AS (SELECT DISTINCT chunk_id, symbol FROM chunks), r AS (SELECT DISTINCT chunk_id, symbol FROM chunk_rows)
SELECT 'left' AS side, * FROM (SELECT * FROM d EXCEPT SELECT * FROM r) UNION ALL SELECT 'right' AS side, * FROM (SELECT * FROM r EXCEPT SELECT * FROM d)""")
def inventory_difference(spark, d):
    """(chunk, symbol) pairs of the listing and of the stored rows that the other side lacks."""
    pairs = lambda t: _t(spark, d, t).select("chunk_id", "symbol").distinct()
    return reconcile.symmetric_difference(pairs("chunks"), pairs("chunk_rows")).select("side", "chunk_id", "symbol")


@query("""WITH c AS (SELECT exchange, symbol, epoch_us(ts_utc) AS us, candle_id FROM candles) , l AS (SELECT *, us < lag(us) OVER (PARTITION BY exchange, symbol ORDER BY candle_id) AS back FROM c)
SELECT exchange, symbol, count(*) AS n_rows, count(*) FILTER (back) AS n_steps_back FROM l GROUP BY 1, 2""")
def order_audit(spark, d):
    """How often a source's instants step back in the order of its candle ids."""
    return quality.unordered(_t(spark, d, "candles"), ["exchange", "symbol"], "ts_utc", "candle_id")


@query(f"""WITH f AS (SELECT DISTINCT {_SYMBOL} AS symbol, date FROM chunks), r AS (SELECT DISTINCT symbol, CAST(ts_utc AT TIME ZONE 'UTC' AS DATE)::VARCHAR AS date FROM chunk_rows)
SELECT f.symbol, count(*) AS n_listed, count(r.date) AS n_stored, count(r.date) / CAST(count(*) AS DOUBLE) AS ratio FROM f LEFT JOIN r ON f.symbol = r.symbol AND f.date = r.date GROUP BY 1""")
def tier_coverage_ratio(spark, d):
    """Of the days listed for each symbol, the share that has stored rows."""
    f = _files(spark, d).select("symbol", "date").distinct()
    r = _t(spark, d, "chunk_rows").select(F.col("symbol"), F.to_date("ts_utc").cast("string").alias("date")).distinct()
    return reconcile.coverage_ratio(f, r, ["symbol"], ["date"]).select("symbol", F.col("n_expected").alias("n_listed"), F.col("n_present").alias("n_stored"), "ratio")


@query("""WITH g AS (SELECT exchange, symbol, count(DISTINCT data_hash) AS hashes, count(*) AS n FROM candles GROUP BY 1, 2)
SELECT exchange, symbol, n, hashes, n - hashes AS n_repeated FROM g""")
def hash_inventory(spark, d):
    """Rows and distinct hashes of each source."""
    g = _t(spark, d, "candles").groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("data_hash").alias("hashes"))
    return g.withColumn("n_repeated", F.col("n") - F.col("hashes"))
