"""The physical schemas, declared once. Instants are microseconds in UTC."""

from pyspark.sql import types as T

DEC = "decimal(38,18)"
# Column names and types of the stored tables.
DDL = {
    "ohlcv.v1": f"ts_utc timestamp, exchange string, symbol string, timeframe string, open {DEC}, high {DEC}, low {DEC}, close {DEC}, volume {DEC}, value {DEC}, trade_count bigint, is_complete boolean, schema_version string, source_ingested_at timestamp, data_snapshot_id string, data_hash string",
    "tick.v1": f"ts_utc timestamp, received_at timestamp, exchange string, symbol string, price {DEC}, quantity {DEC}, side string, raw_json string",
    "tick.v1.1": f"ts_utc timestamp, received_at timestamp, exchange string, symbol string, price {DEC}, quantity {DEC}, side string, raw_json string, ingest_seq decimal(20,0), payload_hash string, validation_status string",
    "orderbook.v1": f"ts_utc timestamp, received_at timestamp, exchange string, symbol string, event_type string, side string, level int, price {DEC}, quantity {DEC}, raw_json string",
    "orderbook_snapshot.v1": f"ts_utc timestamp, received_at timestamp, exchange string, symbol string, baseline_seq bigint, side string, level int, price {DEC}, quantity {DEC}, payload_hash string, raw_json string",
    "orderbook_depth.v1": f"ts_utc timestamp, received_at timestamp, exchange string, symbol string, side string, price {DEC}, quantity {DEC}, raw_json string, node_id string, collector_run_id string, ingest_seq bigint",
    "exchange_metadata.v1": f"exchange string, symbol string, fetched_date date, fetched_at timestamp, source_snapshot_id string, data_hash string, asset_status string, acc_trade_value_24h {DEC}, tick_size {DEC}, min_order_qty {DEC}, fee_maker {DEC}, fee_taker {DEC}, min_order_notional_krw {DEC}, available_from_ts timestamp",
}
LEVEL = f"struct<price: {DEC}, quantity: {DEC}>"
WAL = {
    "transaction": f"ts_utc string, received_at string, exchange string, symbol string, price {DEC}, quantity {DEC}, side string, raw_json string, channel string",
    "orderbooksnapshot": f"ts_utc string, received_at string, exchange string, symbol string, bids array<{LEVEL}>, asks array<{LEVEL}>, raw_json string, channel string",
    "orderbookdepth": f"ts_utc string, received_at string, exchange string, symbol string, changes array<struct<side: string, price: {DEC}, quantity: {DEC}>>, raw_json string, node_id string, collector_run_id string, channel string",
}
CHANNEL_SCHEMA = {"transaction": "tick.v1", "orderbooksnapshot": "orderbook_snapshot.v1", "orderbookdepth": "orderbook_depth.v1"}


def schema(name: str) -> T.StructType:
    if name not in DDL:
        raise ValueError(f"unknown schema {name!r}; known: {', '.join(DDL)}")
    return T.StructType.fromDDL(DDL[name])


def wal_schema(channel: str) -> T.StructType:
    if channel not in WAL:
        raise ValueError(f"unknown channel {channel!r}; known: {', '.join(WAL)}")
    return T.StructType.fromDDL(WAL[channel])


def reject_floats(s: T.StructType) -> None:
    """Prices and quantities are exact; a float or double column raises."""
    bad = [f.name for f in s.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if bad:
        raise TypeError(f"float columns: {', '.join(bad)}")
