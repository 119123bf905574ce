"""Events along a series, each a given distance after the last: volume and dollar bars, throttles.

Rows have a mark that never falls along the series (a running sum, an instant). A row is an event if its mark is at least ``need`` above that of the event
before. Where events lie depends on all earlier ones, yet a series that holds a third of all rows is walked by many tasks:

1. A series is cut into blocks. Within a block the event after any given row is known without what came before, so a block is a function from
   the mark of the last event before it to the mark of its own last event and the number of events: a few steps, one for each row within ``need`` of the block's first.
2. Only these steps (not rows) are followed along the series, which gives each block its entry.
3. All blocks are walked at once from their entries.
"""

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import normal, schemas

DIGITS = "decimal(38,0)"
BLOCK_ROWS = 500_000  # of a series in a block, which a task holds in memory


def time_blocks(rows: DataFrame, series: Sequence[str], ts: str, width_s: float, most_rows: int | None = None) -> Column:
    """Blocks of ``width_s``, or narrower ones if some would hold more than ``most_rows`` (``BLOCK_ROWS``) of a series: counted before, with as many jobs as the width is lowered, and one.

    Nothing is left out whatever the counts; at a millisecond the width stays.
    """
    us, width, most_rows = F.unix_micros(ts), max(int(width_s * 1_000_000), 1000), most_rows or BLOCK_ROWS
    while True:
        most = rows.groupBy(*series, normal.bucket(us, width).alias("_block")).count().agg(F.max("count")).first()[0] or 0
        if most <= most_rows or width == 1000:
            return normal.bucket(us, width)
        width = max(width // max(2, -(-most // most_rows)), 1000)


def _steps(marks: list[int], need: int) -> tuple[list[int], list[int], list[int]]:
    """For each row that can be a block's first event: its mark, and the mark of the last event and the number of events that follow from it."""
    n = len(marks)
    after = [bisect_left(marks, m + need) for m in marks]
    last, count = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        j = after[i]
        last[i], count[i] = (marks[i], 1) if j == n else (last[j], count[j] + 1)
    firsts = [i for i in range(bisect_left(marks, marks[0] + need) + 1) if i < n and (i == 0 or marks[i] > marks[i - 1])]
    return [marks[i] for i in firsts], [last[i] for i in firsts], [count[i] for i in firsts]


def _rows_of_blocks(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[list, dict[str, list], list[pa.RecordBatch]]]:
    """Sorted batches, cut where the block changes: (key, columns, the rows themselves)."""
    key, held, parts = None, {c: [] for c in columns}, []
    for b in batches:
        keys = list(zip(b.column("_series").to_pylist(), b.column("_block").to_pylist(), strict=True))
        values = {c: b.column(c).to_pylist() for c in columns}
        i = 0
        while i < len(keys):
            j = i
            while j < len(keys) and keys[j] == keys[i]:
                j += 1
            if keys[i] != key and key is not None:
                yield key, held, parts
                held, parts = {c: [] for c in columns}, []
            key = keys[i]
            for c in columns:
                held[c] += values[c][i:j]
            parts.append(b.slice(i, j - i))
            i = j
    if key is not None:
        yield key, held, parts


def events(rows: DataFrame, series: Sequence[str], order: Sequence[str], mark: Column, need: int, running: bool, block: Column, names: tuple[str, str] = ("event", "n_before")) -> DataFrame:
    """``rows`` with whether each is an event (1 or 0), and how many events of its series come before it.

    ``mark`` is a whole number. If ``running``, it is an amount (null or below 0 counts as 0) whose running sum along ``order`` is the mark, and the walk begins at 0: an event is the row with
    which the sum since the last event reaches ``need``. Otherwise it must not fall along ``order``, and a series' first row with a mark is an event; rows without are none.
    ``block`` numbers parts of a series in the same order; each is held in memory by a task (``time_blocks`` bounds them) and should hold many more rows than lie between two events.
    Null series keys are values. Empty rows: none.
    """
    kept = rows.columns
    series_key = F.concat_ws("\x1f", *(F.coalesce(F.col(s).cast("string"), F.lit("\x00")) for s in series))
    m = F.greatest(F.coalesce(mark, F.lit(0)), F.lit(0)) if running else mark
    placed = rows.withColumns({"_series": series_key, "_block": F.coalesce(block, F.lit(-(2**62))).cast("bigint"), "_mark": m.cast(DIGITS).cast("string")})
    chained = ["_series", "_block"]

    def numbered(values: list[str | None]) -> tuple[list[int], list[int]]:
        """Positions with a mark, and the marks; running sums from the block's start."""
        at = [i for i, v in enumerate(values) if v is not None]
        got = [int(values[i]) for i in at]
        return at, list(accumulate(got)) if running else got

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held, _ in _rows_of_blocks(batches, ["_mark"]):
            _, marks = numbered(held["_mark"])
            first, last, count = _steps(marks, need) if marks else ([], [], [])
            texts = [pa.array([list(map(str, x))], pa.list_(pa.string())) for x in (first, last)]
            yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), *texts, pa.array([count], pa.list_(pa.int64())), pa.array([str(marks[-1]) if marks and running else "0"])], names=[*chained, "first", "last", "count", "total"])

    steps = placed.select(*dict.fromkeys([*chained, *order, "_mark"])).repartition(*chained).sortWithinPartitions(*chained, *order)
    steps = steps.mapInArrow(summary, "_series string, _block bigint, first array<string>, last array<string>, count array<bigint>, total string")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, base, last, n = None, 0, None, 0
        for b in batches:
            entries = []
            for r in b.to_pylist():
                if r["_series"] != now:
                    now, base, last, n = r["_series"], 0, 0 if running else None, 0
                entries.append((r["_series"], r["_block"], None if last is None else str(last - base), n))
                marks = list(map(int, r["first"]))
                i = 0 if last is None else bisect_left(marks, last + need - base)
                if i < len(marks):
                    last, n = int(r["last"][i]) + base, n + r["count"][i]
                base += int(r["total"])
            yield pa.RecordBatch.from_pylist([dict(zip((*chained, "_entry", "_n"), e, strict=True)) for e in entries], schema=pa.schema([("_series", pa.string()), ("_block", pa.int64()), ("_entry", pa.string()), ("_n", pa.int64())]))

    entries = steps.repartition("_series").sortWithinPartitions("_series", "_block").mapInArrow(chain, "_series string, _block bigint, _entry string, _n bigint")
    # a block's entry travels as its first row, so that rows are shuffled once and not joined
    led = placed.withColumn("_lead", F.lit(1)).unionByName(entries.withColumn("_lead", F.lit(0)), allowMissingColumns=True)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, parts in _rows_of_blocks(batches, ["_mark", "_entry", "_n"]):
            entry, n = held["_entry"][0], held["_n"][0]
            at, marks = numbered(held["_mark"][1:])
            i = bisect_left(marks, int(entry) + need) if entry is not None else 0
            is_event = [0] * (len(held["_mark"]) - 1)
            while i < len(marks):
                is_event[at[i]] = 1
                i = bisect_left(marks, marks[i] + need, i + 1)
            before = [n, *(n + x for x in accumulate(is_event))]
            k = -1
            for p in parts:
                q = p.slice(1) if k < 0 else p
                k = max(k, 0)
                if q.num_rows:
                    yield pa.RecordBatch.from_arrays([*(q.column(c) for c in kept), pa.array(is_event[k : k + q.num_rows], pa.int32()), pa.array(before[k : k + q.num_rows], pa.int64())], names=[*kept, *names])
                k += q.num_rows

    return led.repartition(*chained).sortWithinPartitions(*chained, "_lead", *order).mapInArrow(walk, schemas.plus(rows.schema, **{names[0]: "int", names[1]: "bigint"}))


def followed(rows: DataFrame, series: Sequence[str], order: Sequence[str], decides: Column, block: Column, name: str, start: Column) -> DataFrame:
    """``rows`` with the value of the last row, up to and with each, for which ``decides`` isn't null; ``start`` before the first of a series.

    Rows look back within their block; what holds at a block's start comes from a table of one row a block.
    """
    placed = rows.withColumns({"_block": block, "_d": decides})
    inside = Window.partitionBy(*series, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*series).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    key = F.struct(*order)
    ends = placed.groupBy(*series, "_block").agg(F.max_by("_d", F.when(F.col("_d").isNotNull(), key)).alias("_end"))
    entry = ends.select(*(F.col(s).alias(f"_e_{s}") for s in series), F.col("_block").alias("_b"), F.last("_end", ignorenulls=True).over(before).alias("_entry"))
    met = F.col("_block").eqNullSafe(F.col("_b"))
    for s in series:
        met = met & F.col(s).eqNullSafe(F.col(f"_e_{s}"))
    return placed.withColumn("_in", F.last("_d", ignorenulls=True).over(inside)).join(entry, met).select(*rows.columns, F.coalesce("_in", "_entry", start).alias(name))
