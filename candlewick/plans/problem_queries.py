"""Queries of the general data-pipeline problems over their whole tables, and the SQL that must give the same rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import chunk_diff, compact, equality_deletes, lambda_views, spikes, versions


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible(_t(spark, d, "candles"))


def p1_certain(spark: SparkSession, d: str) -> DataFrame:
    """Of the readings of p1_found, those that are impossible or stuck, with which."""
    return spikes.kinds(_t(spark, d, "candles")).where("kind <> 'spike'")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return compact.contained_files(_t(spark, d, "chunk_rows"))


def p3_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The compaction itself: what went into each partition's files, with the outcome of the digest comparison."""
    return compact.compaction_report(_t(spark, d, "chunk_rows"), _t(spark, d, "chunks"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return chunk_diff.bar_differences(_t(spark, d, "hot_bars"), _t(spark, d, "cold_bars"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return equality_deletes.current_rows(_t(spark, d, "orderbook_depth")).select("depth_id")


def p5_book(spark: SparkSession, d: str) -> DataFrame:
    """The current book with its quantities."""
    book = equality_deletes.current_rows(_t(spark, d, "orderbook_depth"), equality_deletes.depth_feed(payload=True))
    return book.select("exchange", "symbol", "side", "price", "quantity", "depth_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return lambda_views.period_kinds(_t(spark, d, "orderbook_depth"))


def p6_views(spark: SparkSession, d: str) -> DataFrame:
    """Figures of every period: when published, when frozen, corrected and cut off."""
    return lambda_views.layered_views(_t(spark, d, "orderbook_depth"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    h = versions.history(_t(spark, d, "exchange_metadata"))
    return h.select("exchange", "symbol", F.col("valid_from").cast("string").alias("valid_from"), F.coalesce(F.col("valid_to").cast("string"), F.lit("")).alias("valid_to"))


def p7_versions(spark: SparkSession, d: str) -> DataFrame:
    """The versions with their attributes."""
    return versions.history(_t(spark, d, "exchange_metadata")).drop("attribute_hash")


QUERIES = {f.__name__: f for f in (p1_found, p1_certain, p3_found, p3_compacted, p4_found, p5_found, p5_book, p6_found, p6_views, p7_found, p7_versions)}

_SIDE = "CASE lower(trim(side)) WHEN 'bid' THEN 'bid' WHEN 'b' THEN 'bid' WHEN 'buy' THEN 'bid' WHEN 'ask' THEN 'ask' WHEN 'a' THEN 'ask' WHEN 'sell' THEN 'ask' END"
_BOOK = f"""
WITH c AS (SELECT *, {_SIDE} AS s FROM orderbook_depth),
r AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, s, price ORDER BY ts_utc DESC, ingest_seq DESC, depth_id) AS k
      FROM c WHERE s IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL)
"""
_PERIODS = f"""
WITH c AS (SELECT exchange, symbol, epoch_us(ts_utc) AS ts, ingest_seq, {_SIDE} AS s, price, min(epoch_us(received_at)) AS arr
           FROM orderbook_depth WHERE {_SIDE} IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL GROUP BY ALL),
p AS (SELECT exchange, symbol, ts // 300000000 * 300 AS period_start, arr - (ts // 300000000 + 1) * 300000000 AS after FROM c)
"""
_VERSIONS = """
WITH d AS (SELECT exchange, symbol, fetched_date, tick_size, fee_maker, trim(asset_status) AS asset_status,
                  row_number() OVER (PARTITION BY exchange, symbol, fetched_date ORDER BY fetched_at DESC) AS k FROM exchange_metadata),
f AS (SELECT exchange, symbol, fetched_date, last_value(tick_size IGNORE NULLS) OVER w AS tick_size, last_value(fee_maker IGNORE NULLS) OVER w AS fee_maker,
             last_value(asset_status IGNORE NULLS) OVER w AS asset_status
      FROM d WHERE k = 1 WINDOW w AS (PARTITION BY exchange, symbol ORDER BY fetched_date ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, row_number() OVER w AS n, lag(tick_size) OVER w AS t0, lag(fee_maker) OVER w AS f0, lag(asset_status) OVER w AS a0
      FROM f WINDOW w AS (PARTITION BY exchange, symbol ORDER BY fetched_date)),
v AS (SELECT * FROM l WHERE n = 1 OR tick_size IS DISTINCT FROM t0 OR fee_maker IS DISTINCT FROM f0 OR asset_status IS DISTINCT FROM a0),
e AS (SELECT *, lead(fetched_date) OVER (PARTITION BY exchange, symbol ORDER BY fetched_date) - 1 AS ends FROM v)
"""
_SYMBOL = "CASE WHEN symbol LIKE '%\\_%' ESCAPE '\\' THEN upper(split_part(trim(symbol), '_', 2) || '-' || split_part(trim(symbol), '_', 1)) ELSE upper(trim(symbol)) END"
_UNIX = lambda c: f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\\\\', '/', 'g'), '/+', '/', 'g'), '(/\\.)+/', '/', 'g'), '^\\./', '')"
_BAR = f"""SELECT DISTINCT bar_label, epoch_us(CAST(genesis_ts AS TIMESTAMPTZ)) AS genesis_us, epoch_us(CAST(ts_close AS TIMESTAMPTZ)) AS ts_close_us,
lower(trim(exchange)) AS exchange, {_SYMBOL} AS symbol, open, high, low, close, volume, value"""
_CHANGED = " UNION ALL ".join(f"SELECT bar_label, genesis_us, ts_close_us, exchange, symbol, '{f}' AS difference FROM h JOIN c USING (bar_label, genesis_us, ts_close_us, exchange, symbol) WHERE h.{f} IS DISTINCT FROM c.{f}" for f in chunk_diff.BAR_FIELDS)

_STUCK = " UNION ALL ".join(
    f"SELECT exchange, symbol, timeframe, ts_utc, '{f}' AS field_name, {f} AS v, row_number() OVER (PARTITION BY exchange, symbol, timeframe ORDER BY ts_utc) - row_number() OVER (PARTITION BY exchange, symbol, timeframe, {f} ORDER BY ts_utc) AS island FROM b WHERE trading"
    for f in spikes.FIELDS
)

ORACLES = {
    "p1_certain": f"""
WITH b AS (SELECT exchange, symbol, timeframe, ts_utc, high, low, volume, avg(CASE WHEN volume > 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY exchange, symbol, timeframe) > {spikes.TRADING_SHARE} AS trading
           FROM (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, timeframe, ts_utc ORDER BY source_ingested_at DESC NULLS LAST, candle_id DESC) AS k FROM candles WHERE ts_utc IS NOT NULL) WHERE k = 1),
i AS ({_STUCK}),
r AS (SELECT exchange, symbol, timeframe, field_name, v, island, min(ts_utc) AS a, max(ts_utc) AS z FROM i WHERE v IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) >= {spikes.STUCK_BARS}),
c AS (SELECT candle_id, exchange, symbol, timeframe, ts_utc, 'high' AS field_name, high AS v, high < greatest(open, close) AS bad FROM candles UNION ALL SELECT candle_id, exchange, symbol, timeframe, ts_utc, 'low', low, low > least(open, close) OR low <= 0 FROM candles
      UNION ALL SELECT candle_id, exchange, symbol, timeframe, ts_utc, 'volume', volume, volume < 0 FROM candles)
SELECT candle_id, field_name, 'impossible' AS kind FROM c WHERE bad
UNION SELECT c.candle_id, c.field_name, 'stuck' AS kind FROM c JOIN r ON c.exchange = r.exchange AND c.symbol = r.symbol AND c.timeframe = r.timeframe AND c.field_name = r.field_name AND c.v = r.v AND c.ts_utc BETWEEN r.a AND r.z""",
    "p3_found": """
WITH r AS (SELECT DISTINCT * EXCLUDE (row_no) FROM chunk_rows WHERE chunk_id IS NOT NULL),
n AS (SELECT chunk_id, count(*) AS n FROM r GROUP BY 1),
s AS (SELECT a.chunk_id AS x, b.chunk_id AS y, count(*) AS k FROM r a JOIN r b
      ON a.chunk_id < b.chunk_id AND a.ts_utc IS NOT DISTINCT FROM b.ts_utc AND a.exchange IS NOT DISTINCT FROM b.exchange AND a.symbol IS NOT DISTINCT FROM b.symbol
      AND a.baseline_seq IS NOT DISTINCT FROM b.baseline_seq AND a.side IS NOT DISTINCT FROM b.side AND a.level IS NOT DISTINCT FROM b.level
      AND a.price IS NOT DISTINCT FROM b.price AND a.quantity IS NOT DISTINCT FROM b.quantity GROUP BY 1, 2)
SELECT x AS chunk_id_a, y AS chunk_id_b FROM s JOIN n a ON a.chunk_id = x JOIN n b ON b.chunk_id = y WHERE k = least(a.n, b.n)""",
    "p3_compacted": f"""
WITH p AS (SELECT *, coalesce(lower(trim(exchange)), 'unknown') AS p_exchange, coalesce({_SYMBOL}, 'unknown') AS p_symbol, coalesce(CAST(ts_utc AS DATE), DATE '1970-01-01') AS p_date FROM chunk_rows),
l AS (SELECT chunk_id, source_path, {_UNIX("nas_object_key")} AS k FROM chunks WHERE chunk_id IS NOT NULL),
k AS (SELECT chunk_id, {_UNIX("source_path")} AS path, CASE WHEN contains(regexp_replace(k, '^l1/', ''), '/node=') THEN regexp_replace(k, '^l1/', '')
             ELSE regexp_replace(regexp_replace(k, '^l1/', ''), '(/date=[^/]+(?:/hour=[^/]+)?)/', '\\1/node=DEFAULT/') END AS key FROM l),
c AS (SELECT chunk_id, path, key FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY path NULLS FIRST, key NULLS FIRST) AS n FROM k) WHERE n = 1),
f AS (SELECT p_exchange, p_symbol, p_date, chunk_id, count(*) AS n FROM p GROUP BY ALL),
s AS (SELECT p_exchange, p_symbol, p_date, CAST(sum(n) AS BIGINT) AS n_stored, count(chunk_id) AS n_source_files, count(path) AS n_listed_files, count(DISTINCT key) AS n_object_keys
      FROM f LEFT JOIN c USING (chunk_id) GROUP BY ALL),
r AS (SELECT p_exchange, p_symbol, p_date, count(*) AS n_records
      FROM (SELECT DISTINCT p_exchange, p_symbol, p_date, ts_utc, exchange, symbol, baseline_seq, side, level, price, quantity FROM p) GROUP BY ALL)
SELECT p_exchange, p_symbol, p_date, n_stored, n_source_files, n_listed_files, n_object_keys, n_records, CAST(ceil(n_records / {compact.TARGET_ROWS}) AS BIGINT) AS n_files, TRUE AS equal
FROM s JOIN r USING (p_exchange, p_symbol, p_date)""",
    "p4_found": f"""
WITH h AS ({_BAR} FROM hot_bars), c AS ({_BAR} FROM cold_bars)
SELECT bar_label, genesis_us, ts_close_us, exchange, symbol, 'hot_only' AS difference FROM h ANTI JOIN c USING (bar_label, genesis_us, ts_close_us, exchange, symbol)
UNION ALL SELECT bar_label, genesis_us, ts_close_us, exchange, symbol, 'cold_only' AS difference FROM c ANTI JOIN h USING (bar_label, genesis_us, ts_close_us, exchange, symbol)
UNION ALL {_CHANGED}""",
    "p5_found": f"{_BOOK} SELECT depth_id FROM r WHERE k = 1 AND quantity > 0",
    "p5_book": f"{_BOOK} SELECT exchange, symbol, s AS side, price, quantity, depth_id FROM r WHERE k = 1 AND quantity > 0",
    "p6_found": f"""{_PERIODS}
SELECT DISTINCT exchange, symbol, period_start, CASE WHEN after > 900000000 THEN 'cut_off' ELSE 'corrected' END AS kind FROM p WHERE after > 5000000""",
    "p6_views": f"""{_PERIODS}
SELECT exchange, symbol, period_start, count(*) FILTER (after <= 5000000) AS published, count(*) FILTER (after <= 900000000) AS final,
count(*) FILTER (after > 5000000 AND after <= 900000000) AS corrected, count(*) FILTER (after > 900000000) AS cut_off FROM p GROUP BY 1, 2, 3""",
    "p7_found": f"{_VERSIONS} SELECT exchange, symbol, strftime(fetched_date, '%Y-%m-%d') AS valid_from, coalesce(strftime(ends, '%Y-%m-%d'), '') AS valid_to FROM e",
    "p7_versions": f"{_VERSIONS} SELECT exchange, symbol, tick_size, fee_maker, asset_status, fetched_date AS valid_from, CAST(ends AS DATE) AS valid_to FROM e",
}
