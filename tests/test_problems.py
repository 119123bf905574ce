"""The general data-pipeline operators against brute force on small tables: nulls, ties, repeats, empty tables, clashing columns, hot keys."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from candlewick.functions import hilbert
from candlewick.operators import chunk_diff, compact, equality_deletes, lambda_views, spikes, versions
from candlewick.plans import problem_queries

T0 = dt.datetime(2025, 1, 6, tzinfo=dt.UTC)
D = "decimal(38,18)"
CANDLE = f"candle_id bigint, ts_utc timestamp, exchange string, symbol string, timeframe string, open {D}, high {D}, low {D}, close {D}, volume {D}, source_ingested_at timestamp, block bigint, e_high string"
DEPTH = f"depth_id bigint, ts_utc timestamp, received_at timestamp, exchange string, symbol string, side string, price {D}, quantity {D}, ingest_seq bigint, seq string, k_side string"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def bar(i, minute, o, h, lo, c, v, symbol="KRW-A", ingested=None):
    x = [None if y is None else Decimal(str(y)) for y in (o, h, lo, c, v)]
    return (i, None if minute is None else at(60 * minute), "north", symbol, "1m", *x, at(60 * (minute or 0) + 65) if ingested is None else ingested, 7, "clash")


def ordinary(n, symbol, start_id, seed):
    r = random.Random(seed)
    out, p = [], 100.0
    for m in range(n):
        o, c = p, p * (1 + r.uniform(-0.001, 0.001))
        out.append(bar(start_id + m, m, round(o, 6), round(max(o, c) * (1 + r.uniform(0.0002, 0.002)), 6), round(min(o, c) * (1 - r.uniform(0.0002, 0.002)), 6), round(c, 6), round(r.lognormvariate(3, 0.5), 6), symbol))
        p = c
    return out


def found(spark, rows):
    return sorted(tuple(r) for r in spikes.implausible(spark.createDataFrame(rows, CANDLE)).collect())


def change(row, **new):
    names = [x.split()[0] for x in CANDLE.split(", ")]
    return tuple(new.get(n, v) for n, v in zip(names, row, strict=True))


def test_spikes_impossible_and_stuck(spark):
    rows = ordinary(3000, "KRW-A", 0, 1)
    rows[100] = change(rows[100], high=rows[100][6] * 3)
    rows[200] = change(rows[200], volume=rows[200][9] * 500)
    rows[300] = change(rows[300], low=Decimal(-1))
    rows[301] = change(rows[301], volume=Decimal(-2))
    rows[302] = change(rows[302], high=Decimal(1))
    want = [(100, "high"), (200, "volume"), (300, "low"), (301, "volume"), (302, "high")]
    for m in range(1434, 1446):  # a run across the end of a block, with a missing minute
        rows[m] = change(rows[m], volume=Decimal("33.5"))
        want.append((m, "volume"))
    want.remove((1440, "volume"))
    rows.append(change(rows[1436], candle_id=9001))  # a copy of a stuck bar counts too
    want.append((9001, "volume"))
    for m in range(500, 507):  # seven are too few
        rows[m] = change(rows[m], volume=Decimal("44.5"))
    gone = rows.pop(1440)
    assert gone[0] == 1440
    rows.append(bar(9100, 900, None, None, None, None, None, ingested=at(0)))
    rows.append(bar(9101, None, 5, 1, 2, 5, -3))
    want += [(9101, "high"), (9101, "volume")]
    assert found(spark, rows) == sorted(want)


def test_a_source_that_hardly_trades_is_not_stuck(spark):
    rows = [bar(i, i, 5, 5, 5, 5, 0 if i % 5 else 3, "KRW-B") for i in range(200)]
    assert found(spark, rows) == []


def test_recall_of_planted_spikes(spark):
    """Sources of very different scale and restlessness; readings planted at 2.3 to 30 times the source's largest ordinary one are found, and nothing else."""
    r = random.Random(41)
    rows, want = [], set()
    for k in range(12):
        scale, unrest, depth_ = 10.0 ** r.uniform(-3, 6), r.uniform(0.2, 0.9), 10.0 ** r.uniform(-4, -2)
        own, size = [], {"high": [], "low": [], "volume": []}
        for m in range(1500):
            p = scale * (1 + 0.01 * r.gauss(0, 1))
            e = {f: depth_ * min(r.lognormvariate(0, unrest), 8) for f in ("high", "low")} | {"volume": scale * min(r.lognormvariate(0, unrest), 8)}
            own.append([m, p, e])
            for f, v in e.items():
                size[f].append(v)
        for f in size:
            for m in r.sample(range(1500), 6):
                own[m][2][f] = max(size[f]) * r.uniform(2.3, 30)
                want.add((1500 * k + m, f))
        rows += [bar(1500 * k + m, m, f"{p:.12f}", f"{p * (1 + e['high']):.12f}", f"{p / (1 + e['low']):.12f}", f"{p:.12f}", f"{e['volume']:.9f}", f"KRW-{k}") for m, p, e in own]
    got = set(found(spark, rows))
    assert len(got & want) >= 0.99 * len(want) and not got - want, (len(got & want), len(want), len(got - want))


def test_series_with_null_keys_and_null_values(spark):
    rows = [change(r, exchange=None, symbol=None) for r in ordinary(600, "KRW-A", 0, 5)]
    rows[50] = change(rows[50], high=rows[50][6] * 3)
    for m in range(100, 110):
        rows[m] = change(rows[m], volume=Decimal("5"))
    for m in range(200, 212):  # absent values aren't stuck, nor do they break the ids of those that are
        rows[m] = change(rows[m], volume=None)
    assert found(spark, rows) == sorted([(50, "high"), *((m, "volume") for m in range(100, 110))])
    kinds = {(r.candle_id, r.kind) for r in spikes.kinds(spark.createDataFrame(rows, CANDLE)).collect()}
    assert kinds == {(50, "spike"), *((m, "stuck") for m in range(100, 110))}


def test_no_candles(spark):
    assert found(spark, []) == []


def test_a_corrected_copy_is_not_a_spike(spark):
    rows = ordinary(400, "KRW-A", 0, 3)
    rows.append(change(rows[50], candle_id=5000, volume=rows[50][9] * 900))
    assert found(spark, rows) == [(5000, "volume")]


def depth(i, ts, recv, side, price, q, seq, symbol="KRW-A"):
    return (i, at(ts), at(recv), "north", symbol, side, None if price is None else Decimal(str(price)), None if q is None else Decimal(str(q)), seq, "clash", "clash")


def random_depth(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        ts = r.randrange(0, 2000)
        hot = i % 3 == 0
        row = depth(i, ts, ts + r.choice([0, 1, 100, 400, 1300, 5000]), r.choice(["bid", " BID", "b", "buy", "ask", "a ", "Sell", None]) if not hot else "bid", 100 if hot else r.choice([99, 100, 101, None]), r.choice([0, 0, 1, 2, None]), r.randrange(5))
        out.append(row)
        if r.random() < 0.3:
            out.append((10_000 + i, row[1], at(ts + 1), *row[3:]))
    r.shuffle(out)
    return out


def side_of(s):
    s = (s or "").strip().lower()
    return "bid" if s in ("bid", "b", "buy") else "ask" if s in ("ask", "a", "sell") else None


def valid(r):
    return side_of(r[5]) and r[6] is not None and r[7] is not None


@pytest.mark.parametrize("seed", [1, 2])
def test_current_rows(spark, seed):
    rows = random_depth(400, seed)
    last = {}
    for r in rows:
        if valid(r):
            k, s = (r[3], r[4], side_of(r[5]), r[6]), (r[1], r[8], -r[0])
            if k not in last or s > last[k][0]:
                last[k] = (s, r)
    want = sorted(r[0] for _, r in last.values() if r[7] > 0)
    df = spark.createDataFrame(rows, DEPTH)
    assert sorted(r.depth_id for r in equality_deletes.current_rows(df).collect()) == want


def test_equality_delete_files_in_any_order(spark, tmp_path):
    rows = random_depth(300, 5)
    df = spark.createDataFrame(rows, DEPTH)
    want = sorted(r.depth_id for r in equality_deletes.current_rows(df).collect())
    table = equality_deletes.EqualityDeleteTable(spark, str(tmp_path / "t"))
    for k in (2, 0, 1, 1):  # a batch may come twice
        table.append(df.where(f"depth_id % 3 = {k}"))
    assert sorted(r.depth_id for r in table.read().collect()) == want
    small = table.compact(str(tmp_path / "c"))
    assert sorted(r.depth_id for r in small.read().collect()) == want
    assert equality_deletes.current_rows(df.limit(0)).collect() == []


def test_periods(spark):
    rows = random_depth(500, 9)
    arrived = {}
    for r in rows:
        if valid(r):
            k = (r[3], r[4], r[1], r[8], side_of(r[5]), r[6])
            arrived[k] = min(arrived.get(k, r[2]), r[2])
    want = set()
    for k, a in arrived.items():
        start = int(k[2].timestamp()) // 300 * 300
        late = a.timestamp() - start - 300
        if late > 900:
            want.add((k[0], k[1], start, "cut_off"))
        elif late > 5:
            want.add((k[0], k[1], start, "corrected"))
    df = spark.createDataFrame(rows, DEPTH)
    assert {tuple(r) for r in lambda_views.period_kinds(df).collect()} == want
    assert lambda_views.period_kinds(df.limit(0)).collect() == []


def test_lambda_layers_end_where_one_pass_ends(spark, tmp_path):
    rows = sorted(random_depth(300, 11), key=lambda r: r[2])
    df = spark.createDataFrame(rows, DEPTH)
    views = lambda_views.LambdaViews(spark, str(tmp_path / "v"))
    for a, b in ((0, 500), (500, 1500), (1500, 3200), (3200, 10**6)):
        views.add(df.where(f"unix_micros(received_at) >= {int(at(a).timestamp()) * 10**6} and unix_micros(received_at) < {int(at(b).timestamp()) * 10**6}"))
        views.run_batch(int(at(b).timestamp() * 1e6))
    got = {tuple(r)[:4] for r in views.read().where("state = 'frozen'").collect()}
    once = lambda_views.period_views(df).collect()
    assert got == {(r.exchange, r.symbol, r.period_start, r.final) for r in once if r.final}
    late = {(r.exchange, r.symbol, r.period_start, r.cut_off) for r in once if r.cut_off}
    assert {tuple(r) for r in views.cut_off().collect()} == late


def test_another_process_goes_on_with_the_layers(spark, tmp_path):
    """The step's number is stored; a step whose end wasn't recorded leaves no trace."""
    us = lambda s: int(at(s).timestamp()) * 10**6
    rows = [depth(i, i, i + 1, "bid", i, 1, 0) for i in range(5)]
    new = lambda: lambda_views.LambdaViews(spark, str(tmp_path / "v"))
    new().add(spark.createDataFrame(rows[:2], DEPTH))
    new().run_batch(us(100))
    new().add(spark.createDataFrame(rows[2:], DEPTH))
    assert [(r.n_changes, r.state) for r in new().read().collect()] == [(5, "provisional")]
    spark.createDataFrame([("north", "KRW-A", 0, 99, 0, 0)], "exchange string, symbol string, period_start bigint, n_changes bigint, n_removes bigint, last_ts_us bigint").write.parquet(str(tmp_path / "v/frozen/v=2"))  # died
    assert new().state() == (1, us(100)) and new().read().count() == 1
    new().run_batch(us(1300))
    assert [(r.n_changes, r.state) for r in new().read().collect()] == [(5, "frozen")]
    new().add(spark.createDataFrame([depth(9, 1000, 9000, "ask", 1, 1, 0), depth(10, 2000, 9000, "ask", 1, 1, 0)], DEPTH))  # a period that has nothing else
    new().run_batch(us(10_000))
    assert new().read().count() == 1 and new().cut_off().count() == 2


@pytest.mark.parametrize("steps", [1, 3, 7])
def test_replayed_layers_count_each_change_once(spark, steps):
    df = spark.createDataFrame(random_depth(400, 13), DEPTH)
    got = sorted(map(tuple, lambda_views.layered_views(df, steps=steps).collect()))
    assert got == sorted(map(tuple, lambda_views.period_views(df).collect()))
    assert lambda_views.layered_views(df.limit(0), steps=steps).collect() == []


def test_registered_views_run_the_layers(spark, tmp_path, monkeypatch):
    spark.createDataFrame(random_depth(200, 17), DEPTH).write.parquet(str(tmp_path / "orderbook_depth.parquet"))
    ran, run_batch = [], lambda_views.LambdaViews.run_batch
    monkeypatch.setattr(lambda_views.LambdaViews, "run_batch", lambda self, now: (ran.append(now), run_batch(self, now)))
    assert problem_queries.p6_found(spark, str(tmp_path)).count() and len(ran) == lambda_views.STEPS
    assert problem_queries.p6_views(spark, str(tmp_path)).count() and len(ran) == 2 * lambda_views.STEPS


META = f"exchange string, symbol string, fetched_date date, fetched_at timestamp, asset_status string, tick_size {D}, fee_maker {D}, held int"


def meta(day, hour, status, tick, fee, symbol="A"):
    d = lambda x: None if x is None else Decimal(str(x))
    return ("north", symbol, None if day is None else dt.date(2025, 1, day), None if day is None else dt.datetime(2025, 1, day, hour, tzinfo=dt.UTC), status, d(tick), d(fee), 3)


def test_history(spark):
    rows = [meta(1, 1, "1", 5, 0.1), meta(1, 9, " 1", 6, 0.1), meta(1, 9, " 1", 6, 0.1), meta(2, 1, "1 ", None, 0.1), meta(4, 1, "1", 7, None), meta(5, 1, "1", 6, 0.1), meta(None, 1, "0", 1, 1), meta(3, 1, "1", None, None, "B")]
    got = sorted((r.symbol, str(r.valid_from), str(r.valid_to or ""), r.tick_size) for r in versions.history(spark.createDataFrame(rows, META)).collect())
    assert got == [("A", "2025-01-01", "2025-01-03", 6), ("A", "2025-01-04", "2025-01-04", 7), ("A", "2025-01-05", "", 6), ("B", "2025-01-03", "", None)]
    assert versions.history(spark.createDataFrame([], META)).collect() == []


def test_merging_day_by_day_gives_the_same_history(spark):
    r = random.Random(4)
    rows = [meta(d, h, r.choice(["1", "0", None]), r.choice([1, 2, None]), r.choice([0.1, None]), s) for d in range(1, 9) for h in (1, 5) for s in "ABC" if r.random() < 0.8]
    whole = {tuple(x) for x in versions.history(spark.createDataFrame(rows, META)).collect()}
    dim = None
    for a, b in ((1, 3), (4, 4), (5, 8)):
        dim = versions.merge(dim, spark.createDataFrame([x for x in rows if a <= x[2].day <= b], META))
    assert {tuple(x) for x in dim.collect()} == whole


BAR = f"bar_label string, genesis_ts string, ts_close string, exchange string, symbol string, open {D}, high {D}, low {D}, close {D}, volume {D}, value {D}, _chunk string"


def info_bar(i, close=1, value=2, spell=0):
    a, b = at(60 * i), at(60 * i + 60)
    text = (lambda t: t.isoformat(), lambda t: t.isoformat().replace("+00:00", "Z"), lambda t: t.astimezone(dt.timezone(dt.timedelta(hours=9))).isoformat())[spell % 3]
    x = [None if v is None else Decimal(v) for v in (1, 3, 1, close, 5, value)]
    return ("time_60", text(a), text(b), ("north", "NORTH ", "North")[spell % 3], ("KRW-A", "krw-a", "A_KRW")[spell % 3], *x, "clash")


def test_bar_differences(spark):
    hot = [info_bar(i, spell=i) for i in range(400)] + [info_bar(7), info_bar(7, spell=1)]
    cold = [info_bar(i, spell=i + 1, close=2 if i == 50 else 1, value=None if i == 60 else 2) for i in range(400) if not 100 <= i < 140 and i != 3] + [info_bar(1000)]
    random.Random(1).shuffle(cold)
    a, b = spark.createDataFrame(hot, BAR), spark.createDataFrame(cold, BAR)
    got = sorted(((r.genesis_us // 10**6 - int(T0.timestamp())) // 60, r.difference) for r in chunk_diff.bar_differences(a, b).collect())
    assert got == sorted([(50, "close"), (60, "value"), (1000, "cold_only"), (3, "hot_only"), *((i, "hot_only") for i in range(100, 140))])
    assert chunk_diff.bar_differences(a, a).collect() == []
    assert chunk_diff.bar_differences(a.limit(0), a.limit(0)).collect() == []
    assert len(chunk_diff.bar_differences(a, a.limit(0)).collect()) == 400


def test_only_chunks_near_a_difference_are_compared(spark):
    a = spark.createDataFrame([info_bar(i) for i in range(3000)], BAR)
    b = spark.createDataFrame([info_bar(i, close=2 if i == 1500 else 1) for i in range(3000)], BAR)
    hashed = [chunk_diff.chunked(chunk_diff.bars(t), chunk_diff.BAR_KEY, chunk_diff.BAR_FIELDS) for t in (a, b)]
    x, y = map(chunk_diff._prints, hashed)
    assert x.count() > 40
    assert x.join(y, ["_chunk", "_n", "_x1", "_x2"], "left_anti").count() <= 4
    assert 1 <= chunk_diff.unmatched(*hashed).count() <= 60


def test_few_rows_are_compared_at_a_high_rate_of_differences(spark):
    """One bar in twenty differs or is missing: of two copies of 4000 bars fewer than three in ten are compared."""
    r = random.Random(6)
    a = spark.createDataFrame([info_bar(i) for i in range(4000)], BAR)
    b = spark.createDataFrame([info_bar(i, close=2 if r.random() < 0.035 else 1) for i in range(4000) if r.random() > 0.015], BAR)
    hashed = [chunk_diff.chunked(chunk_diff.bars(t), chunk_diff.BAR_KEY, chunk_diff.BAR_FIELDS) for t in (a, b)]
    assert chunk_diff.unmatched(*hashed).count() < 1200


ROWS = f"chunk_id string, row_no int, ts_utc timestamp, exchange string, symbol string, baseline_seq bigint, side string, level int, price {D}, quantity {D}, code string"


def stored(chunk, no, k, price=1):
    return (chunk, no, None if k is None else at(k), "north", "KRW-A", k, "bid", k, None if price is None else Decimal(price), Decimal(2), "clash")


def test_contained_files(spark):
    files = {"a": [1, 2, 3], "b": [2, 3], "c": [3, 2], "d": [9], "e": [1, 2, 3, 3], "f": [None], "g": [None, 5], "h": [3, 9]}
    rows = [stored(c, i, k) for c, ks in files.items() for i, k in enumerate(ks)] + [stored(None, 0, 1)]
    want = sorted((x, y) for x in files for y in files if x < y and (set(files[x]) <= set(files[y]) or set(files[y]) <= set(files[x])))
    assert sorted(map(tuple, compact.contained_files(spark.createDataFrame(rows, ROWS)).collect())) == want
    assert compact.contained_files(spark.createDataFrame([], ROWS)).collect() == []


def test_contained_files_are_compared_over_the_compacted_records(spark, tmp_path):
    files = {"a": range(60), "b": range(10, 50), "c": range(40, 90), "d": range(90)}
    df = spark.createDataFrame([stored(c, i, k) for c, ks in files.items() for i, k in enumerate(ks)], ROWS)
    got = sorted(map(tuple, compact.contained_files(df, target_rows=20, path=str(tmp_path / "out")).collect()))
    assert got == [("a", "b"), ("a", "d"), ("b", "d"), ("c", "d")]
    sizes = [x["count"] for x in spark.read.parquet(str(tmp_path / "out")).selectExpr("_metadata.file_path f").groupBy("f").count().collect()]
    assert sum(sizes) == 90 and len(sizes) >= 90 / 40 and max(sizes) <= 40  # each record once, in files of at most twice the target


def test_compaction_keeps_each_record_once(spark, tmp_path):
    r = random.Random(2)
    rows = [stored(f"c{r.randrange(40)}", i, r.randrange(300), r.choice([1, 2, None])) for i in range(900)]
    df = spark.createDataFrame(rows, ROWS)
    chunks = spark.createDataFrame([(f"c{i % 30}", f"/a/{i % 30}", f"l1/k{i % 10}") for i in range(60)], "chunk_id string, source_path string, nas_object_key string")
    got = compact.compaction_report(df, chunks, target_rows=100, path=str(tmp_path / "out")).collect()
    distinct = len({x[2:10] for x in rows})
    assert [(x.n_stored, x.n_records, x.equal) for x in got] == [(900, distinct, True)]
    assert [(x.n_source_files, x.n_listed_files, x.n_object_keys) for x in got] == [(40, 30, 10)]
    assert distinct / 200 <= got[0].n_files <= distinct / 100 + 4
    sizes = [x["count"] for x in spark.read.parquet(str(tmp_path / "out")).selectExpr("_metadata.file_path f").groupBy("f").count().collect()]
    assert max(sizes) <= 200
    assert compact.compaction_report(df.limit(0), chunks, path=str(tmp_path / "none")).collect() == []


def test_files_follow_the_histogram(spark, tmp_path):
    """A partition of several files: balanced, and cut along the curve. Many small partitions share tasks."""
    rows = [stored("c", i, i % 40_000, i % 7) for i in range(4000)] + [(f"s{k}", 0, at(86400 * k), "north", "KRW-B", k, "bid", 0, Decimal(1), Decimal(2), "clash") for k in range(30)]
    df = spark.createDataFrame(rows, ROWS)
    records, n_tasks = compact.placed(df, 700)
    assert n_tasks <= 6 + 5 + 1  # six files of the large partition; the small ones are packed
    compact.write(df, str(tmp_path / "out"), 700, keep=(compact.CODE,))
    got = spark.read.parquet(str(tmp_path / "out")).where("p_symbol = 'KRW-A'").selectExpr("_metadata.file_path f", compact.CODE).groupBy("f").agg({"*": "count", compact.CODE: "min"}).collect()
    sizes = [x["count(1)"] for x in got]
    assert len(sizes) == 6 and sum(sizes) == 4000 and max(sizes) <= 2 * min(sizes)
    ends = sorted((r.lo, r.hi) for r in spark.read.parquet(str(tmp_path / "out")).where("p_symbol = 'KRW-A'").selectExpr("_metadata.file_path f", f"{compact.CODE} c").groupBy("f").agg({"c": "min"}).withColumnRenamed("min(c)", "lo").join(
        spark.read.parquet(str(tmp_path / "out")).selectExpr("_metadata.file_path f", f"{compact.CODE} c").groupBy("f").agg({"c": "max"}).withColumnRenamed("max(c)", "hi"), "f").collect())
    cells = 1 << (3 * compact.BITS - compact.CELL_BITS)
    assert all(a[1] // cells <= b[0] // cells for a, b in zip(ends, ends[1:]))  # ranges of the curve follow each other
    assert spark.read.parquet(str(tmp_path / "out")).where("p_symbol = 'KRW-B'").count() == 30


def test_hilbert_codes_are_a_walk():
    import numpy as np

    n = 4
    grid = np.stack(np.meshgrid(*[np.arange(1 << n)] * 3, indexing="ij"), -1).reshape(-1, 3)
    codes = hilbert.codes([grid[:, i] for i in range(3)], n)
    assert sorted(codes.tolist()) == list(range(1 << (3 * n)))
    path = grid[np.argsort(codes)]
    assert (np.abs(np.diff(path.astype(int), axis=0)).sum(1) == 1).all()
