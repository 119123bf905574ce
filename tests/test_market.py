"""Market operators: hand-computed cases, round trips, streams against batch."""

import datetime as dt
import json
import random
from bisect import bisect_left
from decimal import Decimal
from itertools import accumulate

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions import hashing, normal, paths
from candlewick.operators import asof, bars, book, health, quality, reconcile, replicas, tiers, walks
from candlewick import __main__ as cli
from candlewick.plans import market_queries, placement
from candlewick.sources import catalog, session, sinks
from candlewick.streaming import live
from tests import edge_cases

T0 = dt.datetime(2025, 1, 6, tzinfo=dt.UTC)
TICK = "ts_utc timestamp, exchange string, symbol string, price decimal(20,8), quantity decimal(16,8), seq bigint"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def ticks(spark, rows, symbol="KRW-A"):
    return spark.createDataFrame([(at(s), "north", symbol, Decimal(str(p)), Decimal(str(q)), i) for i, (s, p, q) in enumerate(rows)], TICK)


def out(df, *names):
    return [tuple(r) for r in df.orderBy("genesis_ts").select(*names).collect()]


def test_minute_bars_without_the_last_window(spark):
    t = ticks(spark, [(0, 100, 1), (30, 110, 2), (60, 105, 1), (90, 115, 3), (120, 120, 1)])
    assert out(bars.resample(t, "time_60"), "open", "high", "low", "close", "volume") == [(100, 110, 100, 110, 3), (105, 115, 105, 115, 4)]


def test_volume_tick_and_dollar_bars(spark):
    assert out(bars.resample(ticks(spark, [(i, 100, 3) for i in range(8)]), "vol_10"), "volume") == [(12,), (12,)]
    assert len(out(bars.resample(ticks(spark, [(i, 100, 1) for i in range(10)]), "tick_5"), "volume")) == 2
    assert out(bars.resample(ticks(spark, [(i, 100, 1) for i in range(10)]), "dollar_500"), "value") == [(500,), (500,)]
    assert out(bars.resample(ticks(spark, [(0, 100, 50)]), "dollar_1000"), "value", "ts_close") == [(5000, at(0).replace(tzinfo=None) + dt.timedelta(microseconds=1))]
    t = ticks(spark, [(0, 200, 10), (1, 300, 20), (2, 250, 8)])
    assert out(bars.resample(t, "dollar_10000"), "open", "high", "low", "close", "volume", "value") == [(200, 300, 200, 250, 38, 10000)]


@pytest.mark.parametrize("label", ["garbage", "minute_60", "vol_", "vol_-1", "vol_0", "time_1.5"])
def test_bad_labels(label):
    with pytest.raises(ValueError, match="label"):
        bars.parse_label(label)


def test_closed_timeframes():
    with pytest.raises(ValueError, match="closed"):
        bars.timeframe_rule("47s")


def test_no_ticks_and_one_series_of_many(spark):
    t = ticks(spark, [])
    assert all(bars.resample(t, x).collect() == [] for x in ("time_60", "tick_2", "vol_3", "dollar_4"))
    both = ticks(spark, [(i, 1, 1) for i in range(10)]).unionByName(ticks(spark, [(i, 2, 5) for i in range(10)], "KRW-B"))
    assert {r.symbol for r in bars.resample(both, "tick_3", symbol="KRW-B").collect()} == {"KRW-B"}
    assert {r.open for r in bars.resample(both, "vol_10").where("symbol = 'KRW-B'").collect()} == {2}


def test_accumulation_in_batches_equals_a_fold(spark):
    r = random.Random(3)
    rows = [(i, r.randrange(1, 9), round(r.random() * 5, 8)) for i in range(25_000)]
    want, total, n = [], Decimal(0), 0
    for _, _, q in rows:
        total, n = total + Decimal(str(q)), n + 1
        if total >= 100:
            want.append((n, total))
            total, n = Decimal(0), 0
    assert out(bars.resample(ticks(spark, rows), "vol_100"), "n_ticks", "volume") == want


def test_asof(spark):
    left = spark.createDataFrame([(1, "a", at(5)), (2, "a", at(0)), (3, "b", at(9)), (4, None, at(9)), (5, "a", None), (6, "a", at(500))], "i int, k string, ts timestamp")
    right = spark.createDataFrame([("a", at(1), "x"), ("a", at(5), "y"), ("a", at(5), "x"), ("a", at(7), "z"), (None, at(1), "n"), ("a", None, "q")], "k string, at timestamp, v string")
    for bucket in (None, 4):
        got = {r.i: r.asof_v for r in asof.asof(left, right, ["k"], "ts", "at", ["v"], bucket).collect()}
        assert got == {1: "y", 2: None, 3: None, 4: "n", 5: None, 6: "z"}
    assert asof.asof(left.limit(0), right, ["k"], "ts", "at", ["v"]).collect() == []
    assert [r.v for r in asof.at_instant(right.where("k is not null"), ["k"], "at", at(6).strftime("%Y-%m-%d %H:%M:%S")).collect()] == ["y"]


EVENT = "ts_utc timestamp, seq bigint, exchange string, symbol string, event_type string, side string, price int, quantity int"


def events(spark, rows):
    return spark.createDataFrame([(at(s), i, "north", "KRW-A", *x) for i, (s, *x) in enumerate(rows)], EVENT)


def test_book_at_an_instant(spark):
    e = events(spark, [(0, "snapshot", "bid", 100, 1), (0, "snapshot", "ask", 101, 2), (5, "delta", "bid", 100, 0), (6, "delta", "ask", 102, 4), (20, "snapshot", "bid", 90, 9), (700, "delta", "bid", 91, 1)])
    when = lambda s: at(s).strftime("%Y-%m-%d %H:%M:%S")
    levels = lambda s, **kw: sorted((r.side, r.price, r.quantity) for r in book.book_at(e, when(s), **kw).collect())
    assert levels(10) == [("ask", 101, 2), ("ask", 102, 4)]
    assert levels(30) == [("bid", 90, 9)]  # a new snapshot clears both sides
    top = book.top_of_book(book.book_at(e, when(10))).first()
    assert (top.bid_price, top.ask_price, top.ask_quantity) == (None, 101, 2)
    with pytest.raises(book.GapError):
        book.book_at(e, when(800), max_gap_s=300)
    assert book.book_at(e.where("event_type = 'delta'"), when(30)).collect() == []


def test_flattening(spark):
    level = "array<struct<price: int, quantity: int>>"
    s = spark.createDataFrame([(1, [(5, 1), (4, 1)], [(6, 2)]), (2, None, [])], f"i int, bids {level}, asks {level}")
    assert sorted((r.i, r.side, r.level, r.price) for r in book.flatten_snapshots(s).collect()) == [(1, "ask", 0, 6), (1, "bid", 0, 5), (1, "bid", 1, 4)]
    c = spark.createDataFrame([(1, [("bid", 5, 0), ("ask", 6, 1)])], "i int, changes array<struct<side: string, price: int, quantity: int>>")
    assert sorted((r.side, r.level, r.quantity) for r in book.flatten_deltas(c).collect()) == [("ask", -1, 1), ("bid", -1, 0)]


def test_candle_replicas(spark):
    ddl = "exchange string, symbol string, timeframe string, ts_utc timestamp, source_ingested_at timestamp, node_id string, close int"
    rows = [("n", "A", "1m", at(0), at(1), "B", 1), ("n", "A", "1m", at(0), at(2), "B", 2), ("n", "A", "1m", at(60), at(1), "B", 3), ("n", "A", "1m", at(60), at(1), "A", 4), ("n", "A", "1m", at(120), None, "", 5), ("n", "A", "1m", at(120), None, "Z", 6)]
    df = spark.createDataFrame(rows, ddl)
    assert sorted(r.close for r in replicas.candles(df).collect()) == [2, 4, 6]
    assert replicas.several_nodes(df) and not replicas.several_nodes(df.where("node_id = 'B'"))


def test_tick_replicas_fold(spark):
    ddl = "k int, node_id string, raw_json string, tie int"
    rows = [(1, "B", "x", 1), (1, "A", "y", 2), (1, "C", None, 3), (2, "A", "x", 1), (2, "B", "x", 2), (2, "B", "x", 3), (3, "A", None, 1)]
    got = {r.k: (r.node_id, r.n_skipped, r.n_conflicts) for r in replicas.folded(spark.createDataFrame(rows, ddl), ["k"], "tie").collect()}
    assert got == {1: ("A", 1, 1), 2: ("A", 2, 0), 3: ("A", 0, 0)}


D = "decimal(38,18)"
CANDLE = f"candle_id bigint, ts_utc timestamp, exchange string, symbol string, timeframe string, open {D}, high {D}, low {D}, close {D}, volume {D}, value {D}"


def candle(i, minute, o=1, h=2, lo=1, c=1, v=1, symbol="KRW-A"):
    return (i, at(60 * minute), "north", symbol, "1m", *(None if x is None else Decimal(x) for x in (o, h, lo, c, v)), None)


def test_policy_pipeline_ignores_what_it_rejected(spark):
    rows = [candle(1, 0), candle(2, 1, h=0), candle(3, 1), candle(4, 1), candle(5, 1, c=2), candle(6, 2, o=None), candle(7, 2), candle(8, 9), candle(9, 10), candle(10, 0, symbol="KRW-B")]
    got = {r.candle_id: r.outcome for r in quality.policy_pipeline(spark.createDataFrame(rows, CANDLE), "candle_id").collect()}
    assert got == {1: "accepted", 2: "VALUE_OUT_OF_RANGE", 3: "accepted", 4: "DUPLICATE_SAME_HASH", 5: "DUPLICATE_DIFFERENT_HASH", 6: "SCHEMA_MISMATCH", 7: "accepted", 8: "GAP", 9: "GAP", 10: "accepted"}


def test_gaps(spark):
    r = random.Random(1)
    rows = [("a", at(r.randrange(100_000))) for _ in range(60)] + [("a", None), ("b", at(5)), ("b", at(5))]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    times = sorted({t for k, t in rows if k == "a" and t})
    want = [("a", x.replace(tzinfo=None), y.replace(tzinfo=None), (y - x).total_seconds()) for x, y in zip(times, times[1:]) if (y - x).total_seconds() > 300]
    assert sorted(map(tuple, quality.bucketed_gaps(df, ["k"], "ts", 300).collect())) == want and want


def test_throttle_counts_from_the_last_accepted(spark):
    df = spark.createDataFrame([("a", at(s), i) for i, s in enumerate([0, 0.5, 1.0, 1.9, 2.0, 2.5])] + [("a", None, 9)], "k string, ts timestamp, i int")
    assert sorted(r.i for r in quality.throttled(df, ["k"], "ts", 1.0, "i").collect()) == [0, 2, 4]


def sum_events(amounts, need):
    total, out = 0, []
    for a in amounts:
        total += max(a or 0, 0)
        out.append(total >= need)
        total = 0 if total >= need else total
    return out


@given(st.lists(st.tuples(st.integers(0, 40), st.one_of(st.none(), st.integers(0, 9), st.just(10**25))), max_size=40), st.integers(1, 30), st.integers(1, 50))
@settings(max_examples=60, deadline=None)
def test_steps_of_a_block_are_those_of_a_walk(rows, need, entry_parts):
    marks = list(accumulate(a or 0 for _, a in rows))
    if not marks:
        return
    first, last, count = walks._steps(marks, need)
    for entry in range(need):  # the sum since the last event before the block
        i = bisect_left(first, need - entry)
        inside = sum_events([entry] + [a for _, a in rows], need)[1:]
        at = [k for k, e in enumerate(inside) if e]
        if i == len(first):
            assert not at
        else:
            assert count[i] == len(at) and marks[at[-1]] == last[i]


def test_events_of_a_hot_series_in_many_blocks(spark):
    r = random.Random(21)
    rows = [("a" if i % 3 else r.choice("bc"), i, r.choice([0, 1, 2, 3, None, 50]), r.randrange(100)) for i in range(1500)] + [(None, 1, 9, 0), (None, 1, 9, 1)]
    df = spark.createDataFrame(rows, "k string, t int, amount int, tie int").repartition(5)
    got = {}
    for x in walks.events(df, ["k"], ["t", "tie"], F.col("amount").cast("bigint"), 11, True, F.floor(F.col("t") / 50)).collect():
        got.setdefault(x.k, []).append((x.t, x.tie, bool(x.event), x.n_before))
    for k in (None, "a", "b", "c"):
        own = sorted((t, tie, a) for kk, t, a, tie in rows if kk == k)
        events = sum_events([a for *_, a in own], 11)
        before = [0, *accumulate(map(int, events))]
        assert sorted(got[k]) == [(t, tie, e, n) for (t, tie, _), e, n in zip(own, events, before)]
    assert walks.events(df.limit(0), ["k"], ["t", "tie"], F.col("amount"), 11, True, F.col("t")).collect() == []


def test_crowded_blocks_are_made_narrower(spark, monkeypatch):
    rows = [(i // 50, 3, 1) for i in range(2000)]  # fifty ticks a second
    t = ticks(spark, rows)
    sizes = lambda most: t.groupBy(walks.time_blocks(t, ["exchange", "symbol"], "ts_utc", 3600, most)).count().agg(F.max("count")).first()[0]
    assert sizes(10_000) == 2000 and sizes(300) <= 300 and sizes(7) == 50
    whole = out(bars.resample(t, "vol_7"), "volume", "n_ticks", "open")
    monkeypatch.setattr(walks, "BLOCK_ROWS", 60)
    assert out(bars.resample(t, "vol_7"), "volume", "n_ticks", "open") == whole and len(whole) == 2000 // 7
    assert bars.resample(t.limit(0), "vol_7").collect() == []


def test_no_shuffle_is_by_series_alone_where_rows_are_moved(spark):
    """Of one series only, rows of volume bars, throttles and blocking land in several tasks."""
    t = ticks(spark, [(i * 60, 10, 1) for i in range(3000)])
    bucket = normal.bucket(F.unix_micros("ts_utc"), 3_600_000_000)
    walked = walks.events(t, ["exchange", "symbol"], ["ts_utc", "seq"], F.col("quantity").cast("bigint"), 7, True, bucket)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert walked.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(out(bars.resample(t, "vol_7"), "volume")) == 3000 // 7
    assert quality.throttled(t, ["exchange", "symbol"], "ts_utc", 90.0, "seq").count() == 1500


def test_steps_back_across_parts(spark):
    r = random.Random(2)
    rows = [(r.choice("ab"), i, at(r.choice([i, i - 3]))) for i in range(500)] + [("a", 501, None), ("c", 1, None)]
    got = {x.k: (x.n_rows, x.n_steps_back) for x in quality.unordered(spark.createDataFrame(rows, "k string, i int, ts timestamp"), ["k"], "ts", "i", width=37).collect()}
    for k in "abc":
        own = [t for kk, _, t in sorted(rows, key=lambda x: x[1]) if kk == k]
        assert got[k] == (len(own), sum(1 for x, y in zip(own, own[1:]) if x and y and y < x))
    kept, bad = quality.ordered_or_quarantined(spark.createDataFrame(rows, "k string, i int, ts timestamp"), ["k"], "ts", "i")
    assert {x.k for x in kept.collect()} == {"c"} and {(x.k, x.reason) for x in bad.select("k", "reason").distinct().collect()} == {("a", "NOT_MONOTONIC"), ("b", "NOT_MONOTONIC")}


def test_policy_pipeline_against_a_walk(spark):
    r = random.Random(8)
    rows = []
    for i in range(600):
        m = i // 4 + (40 if i > 500 else 0)
        rows.append(candle(i, m, h=r.choice([2, 2, 2, 0]), o=r.choice([1, 1, 1, None]), c=r.choice([1, 2]), symbol=r.choice(["KRW-A", "KRW-B"])))
    got = {x.candle_id: x.outcome for x in quality.policy_pipeline(spark.createDataFrame(rows, CANDLE), "candle_id").collect()}
    state: dict = {}
    for c in rows:
        last = state.get(c[3])
        if c[5] is None:
            want = "SCHEMA_MISMATCH"
        elif last and (c[1] - last[0]).total_seconds() > 60:
            want = "GAP"
        elif c[6] == 0:
            want = "VALUE_OUT_OF_RANGE"
        elif last and last[0] == c[1]:
            want = "DUPLICATE_SAME_HASH" if last[1] == c[5:] else "DUPLICATE_DIFFERENT_HASH"
        else:
            want, state[c[3]] = "accepted", (c[1], c[5:])
        assert got[c[0]] == want, c


def test_decisions(spark):
    df = spark.createDataFrame([("GAP",), ("VALUE_OUT_OF_RANGE",), (None,)], "r string")
    pick = lambda p: [x[0] for x in df.select(quality.decision(F.col("r"), p)).collect()]
    assert pick("quarantine") == ["HALT", "QUARANTINE", None] and pick("halt") == ["HALT", "HALT", None] and pick("skip") == ["SKIP", "SKIP", None]
    with pytest.raises(ValueError, match="policy"):
        pick("maybe")


def test_drift(spark):
    a = spark.range(20_000).withColumn("v", F.lit(1))
    b = a.where("id > 0")
    got = reconcile.drift(reconcile.keyed_diff(a, b, ["id"], ["v"])).first()
    assert got.drift == Decimal("0.00005")
    reconcile.assert_within(reconcile.keyed_diff(a, b, ["id"], ["v"]))
    with pytest.raises(reconcile.DriftError):
        reconcile.assert_within(reconcile.keyed_diff(a, b.select((F.col("id") + 10**6).alias("id"), "v"), ["id"], ["v"]))


def test_sets_samples_and_causes(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert sorted((r.x, r.side) for r in reconcile.symmetric_difference(a, b).collect()) == [(1, "left"), (2, "left"), (3, "right")]
    names = [f"s{i}" for i in range(50)]
    assert reconcile.sampled(names, Decimal("0.02"), 10, 500, 3) == random.Random(3).sample(names, 10)
    g = spark.createDataFrame([("a", at(100)), ("b", at(500))], "k string, before_ts timestamp")
    h = spark.createDataFrame([(at(120),), (None,)], "at timestamp")
    assert {r.k: r.cause for r in reconcile.gap_causes(g, h, 30).collect()} == {"a": "UNKNOWN", "b": "LIKELY_NODE_DOWN"}
    flat = reconcile.flat_first(spark.createDataFrame([(1, "f")], "k int, v string"), spark.createDataFrame([(1, "l"), (2, "l")], "k int, v string"), ["k"])
    assert sorted(map(tuple, flat.collect())) == [(1, "f"), (2, "l")]


def test_eight_file_checks(spark):
    ddl = "name string, rows int, digest string, names array<string>, types array<string>, schema_version string, authoritative boolean"
    row = lambda **k: tuple({"name": "a", "rows": 1, "digest": "d", "names": ["x", "y"], "types": ["int", "dec"], "schema_version": "s.v1", "authoritative": False, **k}.values())
    cases = {
        "all_pass": {}, "sha256": {"digest": "e"}, "row_count": {"rows": 2}, "column_order": {"names": ["y", "x"]}, "dtype": {"types": ["int", "str"]}, "schema_version": {"schema_version": "s.v2"},
        "column_count": {"names": ["x"]}, "object_count": None, "ambiguity": {"authoritative": True},
    }
    for name, change in cases.items():
        left = [row(authoritative=name == "ambiguity")]
        right = [row(**change)] if change is not None else [row(), row(name="b")]
        got = reconcile.file_invariants(spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl), {"s.v1": ["x", "y"]})
        assert [r.invariant for r in got.collect()] == list(reconcile.INVARIANTS)
        assert reconcile.invariant_status(got) == (name if name == "all_pass" else f"{name}_fail")
    x = spark.createDataFrame([row()], ddl)
    assert reconcile.invariant_status(reconcile.file_invariants(x, x, {})) == "column_count_fail"
    assert reconcile.invariant_status(reconcile.file_invariants(x.limit(0), x.limit(0), {"s.v1": ["x", "y"]})) == "all_pass"


def test_health(spark):
    rows = spark.createDataFrame([("blocked",), ("pending",)], "s string")
    assert health.status_rollup(rows, "s").first().overall == "BLOCKED"
    nodes = health.node_levels(spark.createDataFrame([("a", at(0)), ("b", at(95)), ("c", None)], "node_id string, at timestamp"), F.lit(at(100)), 30, 60)
    assert {r.node_id: r.level for r in nodes.collect()} == {"a": "RED", "b": "GREEN", "c": "RED"}
    cap = health.capacity(spark.createDataFrame([("wal", 10), ("wal", 5), ("l1", 1), ("x", 1)], "layer string, bytes bigint"), {"wal": 30, "l1": 20})
    assert {r.layer: r.ratio for r in cap.collect()} == {"wal": 0.5, "l1": 0.05, "max": 0.5}


def test_spellings(spark):
    row = spark.createDataFrame([(" B ", "vlt_krw", "1min", "2025-01-06T09:00:00+09:00", "1736121600000", "2025-01-06 00:00:00", "nonsense", "")], "a string, b string, c string, d string, e string, f string, g string, h string")
    c = F.col
    got = row.select(normal.side(c("a")), normal.symbol(c("b")), normal.timeframe_seconds(c("c")), *(normal.instant_us(c(x)) for x in "defgh"), normal.side(c("h"))).first()
    us = int(T0.timestamp() * 1e6)
    assert tuple(got) == ("bid", "KRW-VLT", 60, us, us, us, None, None, None)


def test_hashes(spark):
    import hashlib

    c = spark.createDataFrame([candle(1, 0)], CANDLE)
    text = "2025-01-06T00:00:00.000000+00:00|" + "|".join(f"{x}." + "0" * 18 for x in (1, 2, 1, 1, 1))
    assert c.select(hashing.candle_hash()).first()[0] == hashlib.sha256(text.encode()).hexdigest()
    assert c.select(hashing.scaled(F.lit(Decimal("1.25")), 2)).first()[0] == 125
    for digits, x in ((2, "1.255"), (8, "1.00000000001"), (0, "0.000000000000000001")):
        with pytest.raises(Exception, match="more digits"):
            c.select(hashing.scaled(F.lit(Decimal(x)), digits)).collect()
    assert c.select(hashing.scaled(F.lit(Decimal("-12345678901234.000000000000000001")), 18)).first()[0] == -12345678901234000000000000000001
    assert c.select(hashing.unscaled(F.lit(125), 2), hashing.unscaled(F.lit(-(10**18) - 1), 18), hashing.unscaled(F.lit(7), 0)).first()[:] == (Decimal("1.25"), Decimal("-1.000000000000000001"), 7)
    assert c.select(hashing.units(F.lit(Decimal("-12345.0000000000000067")), 16)).first()[0] == -123450000000000000067
    got = c.select(*(hashing.half_even(F.lit(x), 2) for x in ("1.005", "1.015", "-2.345", "x", "1.0051")), hashing.half_even(F.lit("0.0000000000000000015"))).first()
    assert tuple(got) == (Decimal("1.00"), Decimal("1.02"), Decimal("-2.34"), None, Decimal("1.01"), Decimal("0.000000000000000002"))


def test_paths(spark):
    p = spark.createDataFrame([("D:\\lake\\exchange=a\\date=2025-01-01\\hour=06\\x.parquet", "l1/market//./exchange=a/date=2025-01-01/x.parquet")], "a string, b string")
    got = p.select(paths.hive(F.col("a"), "exchange"), paths.hive(F.col("a"), "hour"), paths.node(F.col("a")), paths.canonical_key(F.col("b"))).first()
    assert tuple(got) == ("a", "06", "DEFAULT", "market/exchange=a/date=2025-01-01/node=DEFAULT/x.parquet")
    for bad in ("..", "a/b", "", "a..b", "/x"):
        with pytest.raises(ValueError, match="component"):
            paths.safe(bad)


def test_candles_are_written_once_and_scanned_half_open(spark, tmp_path):
    root = str(tmp_path)
    c = spark.createDataFrame([candle(i, m) for i, m in enumerate([0, 1, 2, 60 * 30])], CANDLE).drop("candle_id")
    for _ in range(2):
        sinks.write_candles(c, root, "snap")
    got = catalog.scan_candles(spark, root, "north", "KRW-A", "1m", "2025-01-06T00:00:00+00:00", "2025-01-06T00:02:00+00:00").collect()
    assert [r.ts_utc for r in got] == [at(0).replace(tzinfo=None), at(60).replace(tzinfo=None)] and got[0].symbol == "KRW-A"
    assert catalog.scan_candles(spark, root, "north", "KRW-A", "1m", "2025-01-06T00:00:00+00:00", "2025-02-06T00:00:00+00:00").count() == 4
    assert catalog.scan_candles(spark, root, "north", "KRW-X", "1m", "2025-01-06T00:00:00+00:00", "2025-01-07T00:00:00+00:00").count() == 0
    for a, b in (("2025-01-06", "2025-01-07"), ("2025-01-06T00:00:00+00:00", "2025-01-06T00:00:00+00:00"), ("2025-01-06T00:00:00+09:00", "2025-01-08T00:00:00+09:00")):
        with pytest.raises(ValueError):
            catalog.window(a, b)


def test_ticks_with_a_clock_and_nanosecond_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "market/ticks/schema_version=tick.v1/exchange=north/symbol=KRW-A/date=2025-01-06/node=NODE_A"
    folder.mkdir(parents=True)
    ts = pa.array([int(at(s).timestamp() * 1e9) for s in (0, 10, 20)], pa.int64()).cast(pa.timestamp("ns", "UTC"))
    dec = pa.array([Decimal(1)] * 3, pa.decimal128(38, 18))
    pq.write_table(pa.table({"ts_utc": ts, "received_at": ts, "exchange": ["north"] * 3, "symbol": ["KRW-A"] * 3, "price": dec, "quantity": dec, "side": ["buy"] * 3, "raw_json": pa.array([None] * 3, pa.string())}), folder / "a.parquet")
    span = ("2025-01-06T00:00:00+00:00", "2025-01-06T00:00:15+00:00")
    assert catalog.scan_events(spark, str(tmp_path), "tick.v1", "north", "KRW-A", *span).count() == 2
    got = catalog.scan_events(spark, str(tmp_path), "tick.v1", "north", "KRW-A", span[0], "2025-01-07T00:00:00+00:00", clock=at(11)).collect()
    assert [r.ts_utc for r in got] == [at(0).replace(tzinfo=None), at(10).replace(tzinfo=None)]


def test_append_events_and_arrow(spark, tmp_path):
    t = ticks(spark, [(0, 1, 1), (90_000, 2, 2)]).withColumns({"received_at": F.col("ts_utc"), "side": F.lit("buy"), "raw_json": F.lit(None).cast("string"), "price": F.col("price").cast(D), "quantity": F.col("quantity").cast(D)})
    sinks.append_events(t, str(tmp_path), "ticks", "tick.v1", node="NODE_A")
    got = catalog.scan_events(spark, str(tmp_path), "tick.v1", "north", "KRW-A", "2025-01-06T00:00:00+00:00", "2025-01-09T00:00:00+00:00")
    assert got.count() == 2 and sinks.ipc_table(sinks.ipc_bytes(got)).num_rows == 2
    with pytest.raises(TypeError, match="price"):
        sinks.append_events(t.withColumn("price", F.col("price").cast("double")), str(tmp_path), "ticks", "tick.v1")


def test_metadata_is_written_skipped_or_quarantined(spark, tmp_path):
    ddl = schemas.DDL["exchange_metadata.v1"]
    row = lambda day, hour, h: ("north", "KRW-A", dt.date(2025, 1, day), dt.datetime(2025, 1, day, hour, tzinfo=dt.UTC), "s", h, "1", None, None, None, None, None, None, None)
    first = spark.createDataFrame([row(6, 1, "x"), row(6, 2, "x"), row(6, 3, "y"), row(6, 1, "x")], ddl)
    assert {r.outcome: r["count"] for r in sinks.write_metadata(first, str(tmp_path)).collect()} == {"written": 1, "skipped": 1, "quarantined": 1}
    again = spark.createDataFrame([row(6, 0, "x"), row(7, 1, "z")], ddl)
    assert {r.outcome: r["count"] for r in sinks.write_metadata(again, str(tmp_path)).collect()} == {"skipped": 1, "written": 1}
    got = catalog.scan_metadata(spark, str(tmp_path), "north", "KRW-A", dt.datetime(2025, 1, 6, 12, tzinfo=dt.UTC)).collect()
    assert [(r.fetched_date, r.data_hash) for r in got] == [(dt.date(2025, 1, 6), "x")]
    assert spark.read.parquet(str(tmp_path / "quarantine/exchange_metadata")).count() == 1


def test_paper_candles_and_day_limit(spark, tmp_path):
    c = spark.createDataFrame([candle(1, 0)], CANDLE).drop("candle_id")
    sinks.write_paper_candles(c, str(tmp_path), "run1", "snap", {"strategy": "s"})
    span = ("2025-01-06T00:00:00+00:00", "2025-01-07T00:00:00+00:00")
    assert catalog.scan_candles(spark, str(tmp_path), "north", "KRW-A", "1m", *span, mode="paper").count() == 1
    assert catalog.scan_candles(spark, str(tmp_path), "north", "KRW-A", "1m", *span).count() == 0
    assert sinks.read_json(str(tmp_path / "market/lineage/run=run1.json"))["run_id"] == "run1"
    with pytest.raises(ValueError, match="24"):
        sinks.day_of_events(spark, str(tmp_path), "tick.v1", "north", "KRW-A", span[0], "2025-01-08T00:00:00+00:00")
    assert sinks.ipc_table(sinks.day_of_events(spark, str(tmp_path), "tick.v1", "north", "KRW-A", *span)).num_rows == 0
    assert sinks.ipc_table(sinks.day_of_candles(spark, str(tmp_path), "north", "KRW-A", "1m", *span, mode="paper")).num_rows == 1


def test_blocking_with_hysteresis(spark):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([0.5, 0.95, 0.92, None, 0.9, 0.89, 0.94, 0.96])], "k string, i int, r double")
    got = [x.blocked for x in quality.blocked(df, ["k"], "i", "r", 0.95, 0.05, "i").orderBy("i").collect()]
    assert got == [False, True, True, True, True, False, False, True]


def wal_lines(channel, n):
    base = lambda i: f'"ts_utc": "{at(i).isoformat()}", "received_at": "{at(i).isoformat()}", "exchange": "north", "symbol": "KRW-A", "channel": "{channel}"'
    body = {"transaction": '"price": 1.123456789012345678, "quantity": 2, "side": "buy"', "orderbooksnapshot": '"bids": [{"price": 5, "quantity": 1}], "asks": [{"price": 6, "quantity": 1}, {"price": 7, "quantity": 1}]', "orderbookdepth": '"changes": [{"side": "bid", "price": 5, "quantity": 0}]'}[channel]
    return "".join("{" + base(i) + ", " + body + "}\n" for i in range(n))


def test_segments_are_compacted_once_and_nothing_is_lost(spark, tmp_path):
    """Active segments and markers aren't read; a repeated run changes nothing; removing segments from the log loses no rows; frames are numbered within their file."""
    seg = tmp_path / "wal/north/orderbookdepth/KRW-A/2025-01-06"
    seg.mkdir(parents=True)
    out = str(tmp_path / "l1")
    name = lambda i, end: seg / f"segment-20250106T00{i:02d}00Z-NODE_A.ndjson{end}"
    name(0, ".sealed").write_text(wal_lines("orderbookdepth", 5) + "\n")
    name(5, ".sealed").write_text(wal_lines("orderbookdepth", 3))
    name(10, "").write_text(wal_lines("orderbookdepth", 7))
    (tmp_path / "wal/north/transaction").mkdir()
    (tmp_path / "wal/north/transaction/segment-20250106T000000Z-NODE_A.ndjson.sealed").write_text(wal_lines("transaction", 4))
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), out, "orderbookdepth", upto="20250106T000000Z") == 1
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), out, "orderbookdepth", since="2025-01-07") == 0
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), out, "orderbookdepth") == 1
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), out, "orderbookdepth") == 0
    name(0, ".sealed.compacted").unlink()
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), out, "orderbookdepth") == 1  # again: its marker is gone
    for f in seg.glob("*.sealed*"):
        f.unlink()
    name(15, ".sealed").write_text(wal_lines("orderbookdepth", 2))
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), out, "orderbookdepth") == 1
    rows = spark.read.parquet(out)
    assert sorted(r.ingest_seq for r in rows.collect()) == sorted([*range(5), *range(3), *range(2)])
    assert rows.select("segment").distinct().count() == 3
    tiers.merge_tier(spark, out, str(tmp_path / "l2"), "hour", since="2025-01-06", until="2025-01-06")
    tiers.merge_tier(spark, out, str(tmp_path / "none"), "hour", since="2025-01-07")
    assert tiers.verify_merge(rows, spark.read.parquet(str(tmp_path / "l2"))).collect()[0][:] == ("north", "KRW-A", 10, 10, True)
    assert not tiers.verify_merge(rows.limit(9), spark.read.parquet(str(tmp_path / "l2"))).first().equal


def test_segments_of_a_run_share_files(spark, tmp_path, monkeypatch):
    """l1_compacted: files are as many as days, not segments. A segment written again replaces its own rows only, also where it shares a file; a run that died is finished by the next."""
    out = str(tmp_path / "l1")
    files = lambda: sorted(str(f.relative_to(out)) for f in (tmp_path / "l1").rglob("*.parquet"))

    def log(*segments):
        made = [(f"/wal/north/orderbookdepth/KRW-A/segment-{i}.ndjson.sealed", wal_lines("orderbookdepth", n)) for i, n in segments]
        return tiers.rows_of(catalog.numbered_lines(spark.createDataFrame(made, "file string, value string"), "orderbookdepth"), "orderbookdepth", "file")

    def sizes():
        return sorted(r["count"] for r in spark.read.parquet(out).groupBy("segment").count().collect())

    tiers.write_l1(log(*((i, i + 1) for i in range(20))), out)
    assert sizes() == list(range(1, 21)) and len(files()) == 1
    first = files()
    tiers.write_l1(log((20, 30)), out)
    assert sizes() == [*range(1, 21), 30] and len(files()) == 2 and set(first) < set(files())
    tiers.write_l1(log((0, 40), (1, 50)), out)  # of a file that holds 18 others
    assert sizes() == [*range(3, 21), 30, 40, 50]
    tiers.write_l1(log(*((i, i + 1) for i in range(20))), out)
    assert sizes() == [*range(1, 21), 30]
    swap, before = tiers._swap, files()
    monkeypatch.setattr(tiers, "_swap", lambda *a: None)
    tiers.write_l1(log((5, 60)), out)
    assert files() != before and sizes() == [*range(1, 21), 30]  # all is ready, nothing has changed
    monkeypatch.setattr(tiers, "_swap", swap)
    tiers.write_l1(log((6, 70)), out)
    assert sizes() == [*range(1, 6), *range(8, 21), 30, 60, 70]
    assert not [f for f in (tmp_path / "l1").iterdir() if f.name.startswith("_l1")]


def test_a_malformed_frame_raises(spark):
    bad = wal_lines("orderbookdepth", 1).replace('"side": "bid", ', "")
    got = catalog.numbered_lines(spark.createDataFrame([("f", bad)], "file string, value string"), "orderbookdepth")
    with pytest.raises(Exception, match="lacks side"):
        tiers.rows_of(got, "orderbookdepth").collect()


def test_tiers_follow_in_streams(spark, tmp_path):
    seg = tmp_path / "wal/north/transaction"
    seg.mkdir(parents=True)
    (seg / "segment-1-NODE_A.ndjson.sealed").write_text(wal_lines("transaction", 5))
    tiers.compact_segments(spark, str(tmp_path / "wal"), str(tmp_path / "l1"), "transaction")
    step = lambda: live.restarting(lambda: live.merge_stream(spark, str(tmp_path / "l1"), str(tmp_path / "l2"), str(tmp_path / "cp"), "hour"))
    assert step() == 0 and spark.read.parquet(str(tmp_path / "l2")).count() == 5
    (seg / "segment-2-NODE_A.ndjson.sealed").write_text(wal_lines("transaction", 3))
    tiers.compact_segments(spark, str(tmp_path / "wal"), str(tmp_path / "l1"), "transaction")
    step()
    assert spark.read.parquet(str(tmp_path / "l2")).count() == 8
    waits = []

    def failing():
        stream = spark.readStream.format("rate").load().withColumn("x", F.raise_error(F.lit("boom")))
        return stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp2")).start()

    with pytest.raises(Exception, match="boom"):
        live.restarting(failing, (1, 2), waits.append)
    assert waits == [1, 2]


def test_late_rows_and_counters(spark, tmp_path):
    rows = [("KRW-A", "depth", at(i), at(i + (900 if i == 3 else 1)), i) for i in range(6)]
    spark.createDataFrame(rows, "symbol string, tier string, ts_utc timestamp, received_at timestamp, bytes int").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("symbol string, tier string, ts_utc timestamp, received_at timestamp, bytes int").parquet(str(tmp_path / "in"))
    live.late_rows(stream(), str(tmp_path / "late"), str(tmp_path / "cp"), 600).awaitTermination(60)
    assert [r.bytes for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [3]
    q = live.coverage_counters(stream()).writeStream.outputMode("update").format("memory").queryName("counters").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.awaitTermination(60)
    assert [(r.row_count, r.byte_count) for r in spark.sql("select * from counters").collect()] == [(6, 15)]


def test_scans_read_the_days_they_need(spark, tmp_path):
    c = spark.createDataFrame([candle(i, 1440 * i) for i in range(4)], CANDLE).drop("candle_id")
    sinks.write_candles(c, str(tmp_path), "snap")
    days = lambda df: sorted(f.split("date=")[1][:2] for f in df.inputFiles())
    base = str(tmp_path / "market/ohlcv/schema_version=ohlcv.v1/exchange=north/symbol=KRW-A/timeframe=1m")
    assert days(catalog.read(spark, [base], "ohlcv.v1", dt.date(2025, 1, 7), dt.date(2025, 1, 8))) == ["07", "08"]
    assert days(catalog.read(spark, [base], "ohlcv.v1")) == ["06", "07", "08", "09"]
    got = catalog.scan_candles(spark, str(tmp_path), "north", "KRW-A", "1m", "2025-01-07T00:00:00+00:00", "2025-01-08T00:00:00+00:00")
    assert got.count() == 1 and days(got) == ["07", "08"]
    assert catalog.scan_candles(spark, str(tmp_path), "north", "KRW-A", "1m", "2025-03-07T00:00:00+00:00", "2025-03-08T00:00:00+00:00").count() == 0


def test_a_hot_day_is_cut_into_files_by_time(spark, tmp_path):
    t = ticks(spark, [(i, 1, 1) for i in range(2000)]).unionByName(ticks(spark, [(i, 1, 1) for i in range(5)], "KRW-B"))
    placement.by_time(t, str(tmp_path / "t"), ["exchange", "symbol"], "ts_utc", ["ts_utc"], span_s=60, target_rows=300)
    got = spark.read.parquet(str(tmp_path / "t")).selectExpr("symbol", "_metadata.file_path f", "ts_utc").groupBy("symbol", "f").agg(F.count(F.lit(1)).alias("n"), F.min("ts_utc").alias("a"), F.max("ts_utc").alias("b")).collect()
    hot = sorted((r.a, r.b, r.n) for r in got if r.symbol == "KRW-A")
    assert len(hot) == 7 and sum(n for *_, n in hot) == 2000 and max(n for *_, n in hot) <= 400 and all(x[1] < y[0] for x, y in zip(hot, hot[1:]))
    assert [r.n for r in got if r.symbol == "KRW-B"] == [5]
    placement.by_time(t.limit(0), str(tmp_path / "t"), ["exchange", "symbol"], "ts_utc", ["ts_utc"])
    one = ticks(spark, [(0, 1, 1)] * 900).withColumn("exchange", F.lit(None).cast("string"))  # one instant, no exchange
    placement.by_time(one, str(tmp_path / "one"), ["exchange"], "ts_utc", ["seq"], target_rows=300)
    assert spark.read.parquet(str(tmp_path / "one")).where("exchange is null").count() == 900


def test_small_artefacts(spark, tmp_path):
    path = str(tmp_path / "a/b.json")
    for v in ({"x": 1}, {"x": "ü"}):
        sinks.write_json(path, v)
    assert sinks.read_json(path) == {"x": "ü"} and [f.name for f in (tmp_path / "a").iterdir() if not f.name.startswith(".")] == ["b.json"]
    for run, symbols in (("r1", ["KRW-A", "KRW-B"]), ("r2", ["KRW-B"])):
        sinks.write_text(str(tmp_path / f"m/{run}.json"), json.dumps({"collector_run_id": run, "selected_symbols": symbols}, indent=2))
    assert [r.collector_run_id for r in sinks.manifests_of(sinks.manifests(spark, str(tmp_path / "m")), "KRW-A").collect()] == ["r1"]
    rows = spark.range(3)
    assert [sinks.put_batch(rows, str(tmp_path / "p"), b) for b in ("a", "a", "b")] == ["written", "skipped", "conflict"] and spark.read.parquet(str(tmp_path / "p")).count() == 3
    assert sinks.request_hash({"b": 1, "a": 2}) == sinks.request_hash({"a": 2, "b": 1}) != sinks.request_hash({"a": 1})
    assert sinks.front_matter({"a": 1, "b": "x"}) == '---\na: 1\nb: "x"\n---\n'
    with pytest.raises(TypeError, match="x"):
        catalog.encoded(spark.range(1).select(F.lit(0.5).alias("x")))


def test_partitions_are_found_in_the_first_store(spark, tmp_path):
    part = "market/transaction/schema_version=tick.v1/tier=L2/exchange=north/symbol=KRW-A/date=2025-01-06/hour=03"
    t = ticks(spark, [(0, 1, 1)]).withColumns({"received_at": F.col("ts_utc"), "side": F.lit("buy"), "raw_json": F.lit(None).cast("string")}).drop("seq", "exchange", "symbol")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    t.write.parquet(f"{b}/{part}/node=DEFAULT")
    assert catalog.located(spark, [a, b], part) == f"{b}/{part}" and catalog.located(spark, [a, b], f"{part}/node=DEFAULT") == f"{b}/{part}/node=DEFAULT"
    t.unionByName(t).write.parquet(f"{a}/{part}")
    assert catalog.located(spark, [a, b], f"{part}/node=DEFAULT") == f"{a}/{part}"
    got = catalog.scan_partition(spark, [a, b], part, "tick.v1").collect()
    assert [(r.exchange, r.symbol, r.node_id) for r in got] == [("north", "KRW-A", replicas.NO_NODE)] * 2
    with pytest.raises(catalog.Missing):
        catalog.located(spark, [a, b], part.replace("06", "07"))
    with pytest.raises(ValueError, match="tier"):
        catalog.tier_of("market/date=2025-01-06")


def test_polled_metadata(spark):
    tick = spark.createDataFrame([("BTC", "1.0000000000000000015"), ("ETH", "n/a"), ("date", "5"), (None, "1")], "code string, acc_trade_value_24h string")
    status = spark.createDataFrame([("BTC", "1", "1"), ("ETH", "1", "0"), ("", "1", "1"), (None, "1", "1")], "currency string, deposit_status string, withdrawal_status string")
    now = dt.datetime(2025, 1, 6, 3, tzinfo=dt.UTC)
    got = {r.symbol: r for r in catalog.polled_metadata(tick, status, "north", now).collect()}
    assert {s: (r.asset_status, str(r.acc_trade_value_24h)) for s, r in got.items()} == {"KRW-BTC": ("1", "1.000000000000000002"), "KRW-ETH": ("0", "0E-18")}
    again = catalog.polled_metadata(tick.orderBy(F.desc("code")), status.repartition(3), "north", now).first()
    assert again.source_snapshot_id == got["KRW-BTC"].source_snapshot_id and len(got["KRW-BTC"].data_hash) == 32
    assert catalog.polled_metadata(tick.limit(0), status, "north", now).collect() == []


def test_a_log_is_appended_sealed_and_compacted(spark, tmp_path):
    src = str(tmp_path / "in")
    t = ticks(spark, [(i, 1, 1) for i in range(4)]).unionByName(ticks(spark, [(0, 1, 1)], "KRW-B")).withColumns({"received_at": F.col("ts_utc"), "side": F.lit("buy"), "price": F.col("price").cast(D), "quantity": F.col("quantity").cast(D)}).drop("seq")
    t.write.parquet(src)
    listener = live.Progress()
    spark.streams.addListener(listener)
    try:
        live.append_log(spark.readStream.schema(t.schema).parquet(src), str(tmp_path / "wal"), "transaction", "NODE_A", str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination(60)
    finally:
        spark.streams.removeListener(listener)
    names = sorted(str(f.relative_to(tmp_path / "wal")) for f in (tmp_path / "wal").rglob("*.sealed"))
    assert names == [f"north/transaction/KRW-{s}/2025-01-06/segment-000000000000-NODE_A.ndjson.sealed" for s in "AB"]
    assert tiers.compact_segments(spark, str(tmp_path / "wal"), str(tmp_path / "l1"), "transaction") == 2
    got = spark.read.parquet(str(tmp_path / "l1"))
    assert got.count() == 5 and got.where("symbol = 'KRW-A'").first().price == 1
    waits, calls = [], []

    def publish(batch, number):
        calls.append(number)
        if len(calls) < 3:
            raise OSError("away")

    live.retrying(publish, sleep=waits.append)(spark.range(1), 7)
    assert calls == [7, 7, 7] and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        live.retrying(lambda b, n: (_ for _ in ()).throw(OSError("gone")), 2, sleep=waits.append)(spark.range(1), 1)


def test_fold_of_replicas_against_a_walk(spark):
    r = random.Random(17)
    rows = [(r.choice([1, 2, 3, None]), r.choice("ABCD"), r.choice(["x", "y", "z", None]), i) for i in range(300)] + [(9, "D", f"p{i}", 1000 + i) for i in range(200)] + [(9, "C", f"p{i}", 2000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, node_id string, raw_json string, tie int").repartition(3)
    got = {x.k: (x.node_id, x.raw_json, x.n_skipped, x.n_conflicts) for x in replicas.folded(df, ["k"], "tie").collect()}
    pairs = sorted((x.kept.tie, x.other.tie) for x in replicas.conflicting(df, ["k"], ["tie"]).collect())
    want_pairs = []
    for k in (1, 2, 3, None, 9):
        first: dict = {}
        for _, node, raw, tie in sorted((x for x in rows if x[0] == k), key=lambda x: x[3]):
            first.setdefault((node, raw), [tie, 0])[1] += 1
        order = sorted((tie, node, raw, n) for (node, raw), (tie, n) in first.items())
        kept, skipped, conflicts = order[0], order[0][3] - 1, 0
        for x in order[1:]:
            if kept[2] is None or x[2] is None or kept[2] == x[2]:
                skipped += x[3]
                continue
            conflicts, skipped = conflicts + 1, skipped + x[3] - 1
            want_pairs.append((kept[0], x[0]))
            kept = x if x[1] < kept[1] else kept
        assert got[k] == (kept[1], kept[2], skipped, conflicts)
    assert pairs == sorted(want_pairs)
    assert replicas.folded(df.limit(0), ["k"], "tie").collect() == [] and replicas.reduced(df.limit(0), ["k"], ["tie"]).collect() == []


def test_replicas_of_book_events(spark):
    """Equal or unknown payloads keep the first row, differing ones the lower node's; both rows of a conflict are put out."""
    ddl = "exchange string, symbol string, ts_utc timestamp, event_type string, side string, level int, price int, quantity int, node_id string, raw_json string, n int"
    row = lambda p, node, raw, n: ("e", "s", at(0), "delta", "bid", -1, p, 1, node, raw, n)
    df = spark.createDataFrame([row(1, "B", "x", 1), row(1, "A", "y", 2), row(1, "C", "z", 3), row(2, "B", None, 1), row(2, "A", "y", 2), row(3, "B", "x", 1), row(3, "B", "x", 2), (None, None, None, None, None, None, None, None, None, None, 1)], ddl)
    got = replicas.reduced(df, replicas.ORDERBOOK_KEY, ["n"])
    assert sorted((r.price or 0, r.node_id or "", r.n) for r in got.collect()) == [(0, "", 1), (1, "A", 2), (2, "B", 1), (3, "B", 1)] and got.columns == df.columns
    assert sorted((r.kept.node_id, r.other.node_id) for r in replicas.conflicting(df, replicas.ORDERBOOK_KEY, ["n"]).collect()) == [("A", "C"), ("B", "A")]
    assert reconcile.same_set(df, df.limit(5), "node_id") is False and reconcile.same_set(df, df, "raw_json")


@pytest.mark.parametrize("seed", [1, 2])
def test_bars_on_their_edges(spark, seed):
    def made(series):
        rows = [("north", "KRW-A", t, p, q, i) for i, (t, p, q) in enumerate(series)]
        return spark.createDataFrame(rows, "exchange string, symbol string, ts_utc timestamp, price decimal(20,8), quantity decimal(16,8), seq bigint")

    series, n = edge_cases.sums_that_meet_the_threshold(seed, 7, 9)
    assert out(bars.resample(made(series), "vol_7"), "volume") == [(7,)] * n
    series, n = edge_cases.ticks_at_the_ends_of_windows(seed, 60, 8)
    assert out(bars.resample(made(series), "time_60"), "n_ticks", "open", "close") == [(2, series[2 * k][1], series[2 * k + 1][1]) for k in range(n)]
    series, n = edge_cases.notionals_between_digits(seed, 1000, 6)
    assert out(bars.resample(made(series), "dollar_1000"), "value", "n_ticks") == [(1000, 4)] * n


def test_causes_by_the_present_state(spark):
    g = spark.createDataFrame([("a",)], "k string")
    beat = lambda *rows: spark.createDataFrame(list(rows), "ws_state string, at timestamp")
    cause = lambda h: reconcile.gap_causes_now(g, h, F.lit(at(100)), 30).first().cause
    assert cause(beat(("connected", at(80)))) == "UNKNOWN" and cause(beat(("connected", at(80)), ("connected", at(70)))) == "LIKELY_NODE_DOWN"
    assert cause(beat(("disconnected", at(99)))) == "LIKELY_NODE_DOWN" and cause(beat()) == "UNKNOWN" and cause(beat(("connected", None))) == "UNKNOWN"


def test_lists_days_and_closed_bars(spark):
    rows = spark.createDataFrame([("n", "t"), ("n", "d"), ("s", "d"), ("x", "t"), ("n", None)], "exchange string, channel string")
    kept, refused = quality.allowed(rows, [("n", "t"), ("n", "d"), ("s", "t")])
    assert kept.count() == 2 and {(r.exchange, r.channel): r.reason for r in refused.collect()} == {("s", "d"): "UNSUPPORTED", ("x", "t"): "UNKNOWN exchange", ("n", None): "UNKNOWN channel"}
    quality.require_allowed(("n", "t"), [("n", "t")])
    for bad, text in ((("x", "t"), "unknown exchange"), (("s", "d"), "unsupported")):
        with pytest.raises(ValueError, match=text):
            quality.require_allowed(bad, [("n", "t"), ("n", "d"), ("s", "t")])
    d = spark.createDataFrame([("2025-01-05",), ("2025-01-06",), ("x",), (None,)], "date string")
    assert [r.date for r in quality.closed_days(d, "2025-01-06").collect()] == ["2025-01-05"]
    now = spark.createDataFrame([(dt.datetime(2025, 1, 6, 14, 59, 30, tzinfo=dt.UTC),), (dt.datetime(2025, 1, 6, 15, 0, tzinfo=dt.UTC),)], "t timestamp")
    assert [r[0].isoformat() for r in now.select(normal.last_closed(F.col("t"), "1d")).collect()] == ["2025-01-05T15:00:00", "2025-01-06T15:00:00"]
    assert now.select(normal.last_closed(F.col("t"), "15m")).first()[0].isoformat() == "2025-01-06T14:45:00"
    with pytest.raises(ValueError, match="timeframe"):
        normal.last_closed(F.col("t"), "2m")
    raw = spark.createDataFrame([("x" * 9,), ("short",), (None,)], "raw_json string")
    assert quality.redacted(raw).columns == [] and [r[0] for r in quality.redacted(raw, 5).collect()] == ["xxxxx [truncated, len=9]", "short", None]


def test_ranks_reports_and_queues(spark, tmp_path):
    r = random.Random(4)
    rows = [("a", r.choice([r.randrange(-(10**12), 10**12), 7])) for _ in range(700)] + [("b", 5), ("b", None), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, x bigint")
    for q in (0.01, 0.5, 0.99, 1.0):
        got = {x.k: (x.n, x.x) for x in health.nearest_rank(df, ["k"], "x", q).collect()}
        for k in ("a", "b", None):
            own = sorted(v for kk, v in rows if kk == k and v is not None)
            assert got[k] == (len(own), own[max(-(-int(q * 100) * len(own) // 100), 1) - 1])
    assert health.nearest_rank(df.limit(0), ["k"], "x", 0.5).collect() == []
    files = spark.createDataFrame([("n", "A", "2025-01-06", 2**30, at(0)), ("s", "A", "2025-01-06", None, at(50))], "exchange string, symbol string, date string, bytes bigint, modified timestamp")
    none = spark.createDataFrame([], "day date")
    rep = health.report(files, none, none, F.lit(at(70)), 1.1)
    assert [(x.layer, x.verdict, x.actual) for x in rep.collect()] == [("volume", "PASS", 1.0), ("gap", "PASS", 0.0), ("file_count", "PASS", 2.0), ("lag", "FAIL", 70.0)]
    assert json.loads(health.formatted(rep, "json"))["overall"] == "FAIL" and health.formatted(rep, "csv").count("\n") == 5 and "| volume | 1.0 | 1.1 |" in health.formatted(rep, "markdown")
    assert [x.verdict for x in health.report(files.limit(0), none, none, F.lit(at(70)), 0).collect()] == ["FAIL", "PASS", "PASS", "N/A"]
    q = spark.createDataFrame([("p", 5), ("p", None), (None, 1)], "status string, bytes bigint")
    assert {(x.status, x.depth, x.bytes) for x in health.queue_depth(q).collect()} == {("p", 2, 5), ("unknown", 1, 1), ("all", 3, 6)}
    assert spark.range(1).select(health.hit_ratio(F.lit(3), F.lit(1)), health.hit_ratio(F.lit(0), F.lit(0))).first()[:] == (0.75, None)
    names = spark.createDataFrame([("/x/part-r1.parquet",), ("/x/run-7-0003.parquet",), ("plain.parquet",)], "p string")
    assert [x[0] for x in names.select(health.run_id(F.col("p"))).collect()] == ["r1", "run-7", "plain"]


def test_contracts_and_kinds_of_bars(spark):
    c = bars.Contract("vol_5", at(0), Decimal(5), 8, "HALF_EVEN", at(9), "current_tick")
    assert len(c.contract_id) == 16 and c.contract_id == bars.Contract("vol_5", at(0), Decimal(5), 8, "HALF_EVEN", at(9), "current_tick").contract_id != bars.Contract("vol_5", at(0), Decimal(6), 8, "HALF_EVEN", at(9), "current_tick").contract_id
    for bad in ({"bar_label": ""}, {"threshold": Decimal(0)}, {"precision": -1}, {"tie_breaking": "x"}, {"genesis_ts": dt.datetime(2025, 1, 1)}):
        with pytest.raises(ValueError):
            bars.Contract(**({"bar_label": "vol_5", "genesis_ts": at(0), "threshold": Decimal(5), "precision": 8, "rounding_rule": "x", "source_cutoff": at(9), "tie_breaking": "current_tick"} | bad))
    bars.register("lots", bars.summed_bars(F.col("price").cast("decimal(38,8)"), 8))
    try:
        assert out(bars.resample(ticks(spark, [(i, 3, 1) for i in range(7)]), "lots_6"), "n_ticks", "bar_label") == [(2, "lots_6")] * 3
        with pytest.raises(ValueError, match="new kind"):
            bars.register("vol", bars.tick_bars)
    finally:
        bars.KINDS.pop("lots")


def test_sessions_and_command_line(spark, tmp_path, monkeypatch):
    got = session.settings(session.ObjectStore("http://store:9000", "a", "b"), {"spark.sql.adaptive.enabled": "false"})
    assert got["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000" and got["spark.hadoop.fs.s3a.path.style.access"] == "true" and got["spark.sql.adaptive.enabled"] == "false"
    assert "spark.hadoop.fs.s3a.access.key" not in session.settings(session.ObjectStore("x"))
    monkeypatch.setattr(session, "session", lambda **k: spark)
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert cli.run(["query", "--folder", str(tmp_path), "--table", "t", "--sql", "select count(*) n from t"]) == (0, "n\n3")
    assert cli.run(["compact", "--wal", str(tmp_path / "no"), "--out", str(tmp_path / "o"), "--channel", "transaction"])[1] == "0 segments"
    c = spark.createDataFrame([candle(i, 1440 * i) for i in (0, 2)], CANDLE).drop("candle_id")
    placement.by_time(c.withColumn("date", F.to_date("ts_utc").cast("string")), str(tmp_path / "h"), ["exchange", "symbol", "date"], "ts_utc", ["ts_utc"])
    code, text = cli.run(["health-check", "--folder", str(tmp_path / "h"), "--expected-gib", "1", "--format", "json"])
    layers = {x["layer"]: x["verdict"] for x in json.loads(text)["layers"]}
    assert code == 1 and layers["gap"] == "FAIL" and layers["volume"] == "FAIL"
    assert cli.run(["effective-config"])[0] == 0


@pytest.mark.parametrize(("channel", "rows"), [("transaction", 5), ("orderbooksnapshot", 15), ("orderbookdepth", 5)])
def test_log_to_tiers_in_batch_and_stream(spark, tmp_path, channel, rows):
    seg = tmp_path / "wal/north" / channel
    seg.mkdir(parents=True)
    (seg / "segment-20250106T000000Z-NODE_A.ndjson.sealed").write_text(wal_lines(channel, 5))
    listing = catalog.files(spark, str(tmp_path / "wal"))
    assert [r.node for r in catalog.pending(listing).collect()] == ["DEFAULT"]
    tiers.compact_segments(spark, str(tmp_path / "wal"), str(tmp_path / "l1"), channel)
    l1 = spark.read.parquet(str(tmp_path / "l1"))
    assert l1.count() == rows
    if channel == "transaction":
        assert l1.first().price == Decimal("1.123456789012345678")
    tiers.merge_tier(spark, str(tmp_path / "l1"), str(tmp_path / "l2"), "hour")
    tiers.merge_tier(spark, str(tmp_path / "l2"), str(tmp_path / "l3"), "day")
    assert spark.read.parquet(str(tmp_path / "l3")).count() == rows
    q = live.compact_stream(live.wal_stream(spark, str(tmp_path / "wal"), channel), str(tmp_path / "s"), str(tmp_path / "cp"), channel)
    q.awaitTermination(120)
    assert spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "s")).count() == rows
    assert catalog.pending(catalog.files(spark, str(tmp_path / "wal"))).count() == 0


def test_a_copy_revised_in_any_field_of_its_hash_is_a_conflict(spark, tmp_path):
    copies = [candle(1, 0), candle(2, 0), candle(3, 0, h=3), candle(4, 0, lo=0), candle(5, 0, v=2), candle(6, 0, c=2), candle(7, 0, o=2), candle(8, 1, v=None), candle(9, 1, v=None), candle(10, 1)]
    copies[1] = (*copies[1][:-1], Decimal(7))  # the value is not in the hash
    spark.createDataFrame(copies, CANDLE).write.parquet(str(tmp_path / "candles.parquet"))
    got = {r.candle_id: r.status for r in market_queries.duplicate_status(spark, str(tmp_path)).collect()}
    assert got == {1: "UNIQUE", 2: "SAME_HASH", **dict.fromkeys((3, 4, 5, 6, 7, 10), "HASH_CONFLICT"), 8: "UNIQUE", 9: "SAME_HASH"}


def test_the_hour_merge_summarises_what_it_wrote(spark, tmp_path, monkeypatch):
    ddl = "ts_utc timestamp, received_at timestamp, exchange string, symbol string, price double"
    rows = spark.createDataFrame([(at(s), at(s + 1), "north", f"KRW-{'AB'[s % 2]}", float(s)) for s in range(0, 9000, 30)] + [(at(5), at(6), "north", "KRW-A", 1.0)] * 3, ddl)
    rows.write.parquet(str(tmp_path / "orderbook_depth.parquet"))
    monkeypatch.setattr(tiers, "scratch", lambda spark, name: str(tmp_path / name))
    got = sorted(map(tuple, market_queries.l2_hour_merge(spark, str(tmp_path)).collect()))
    for unit in ("hour", "day"):
        assert sorted(map(tuple, tiers.merge_report(rows, unit, str(tmp_path / unit)).collect())) == sorted(map(tuple, tiers.tier_summary(rows, unit).collect()))
    assert [(r[1:5]) for r in got] == [("KRW-A", "2025-01-06", "00", 123), ("KRW-A", "2025-01-06", "01", 120), ("KRW-A", "2025-01-06", "02", 60)]
    assert len(list((tmp_path / "merged").rglob("hour=*/*.parquet"))) == len(got)
    assert spark.read.parquet(str(tmp_path / "merged")).drop("date", "hour").exceptAll(rows.select("ts_utc", "received_at", "price", "exchange", "symbol")).count() == 0
    assert spark.read.parquet(str(tmp_path / "merged")).count() == rows.count()


def test_unknown_channels_fail():
    for f in (schemas.schema, schemas.wal_schema):
        with pytest.raises(ValueError, match="unknown"):
            f("nothing")


@pytest.mark.parametrize("label", ["time_60", "tick_7", "vol_20", "dollar_900"])
def test_streamed_bars_equal_batch_bars(spark, tmp_path, label):
    r = random.Random(4)
    rows = sorted((r.randrange(3000), r.randrange(1, 99), r.randrange(1, 9)) for _ in range(300))
    t = ticks(spark, rows)
    for k in range(3):
        t.where(f"seq >= {k * 100} and seq < {k * 100 + 100}").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("latestFirst", "false").parquet(str(tmp_path / "in"))
    q = live.incremental_bars(s, label).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    got = sorted((x.genesis_us, x.close_us, Decimal(x.volume), Decimal(x.value), x.n_ticks) for x in spark.read.schema(live.BAR).parquet(str(tmp_path / "out")).collect())
    want = sorted((x.g, x.c, x.volume, x.value, x.n_ticks) for x in bars.resample(t, label).select(F.unix_micros("genesis_ts").alias("g"), F.unix_micros("ts_close").alias("c"), "volume", "value", "n_ticks").collect())
    assert got == want


def test_sql_over_views(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    catalog.register(spark, str(tmp_path), ["t"])
    assert catalog.sql_text(spark, "select count(*) as n from t").split() == ["n", "3"]


def test_entry_points_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "time_bars_1h" in e.queries()
