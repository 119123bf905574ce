"""Differences between two copies of a table by content-defined chunking.

Each copy's rows, sorted by key, are cut where a rolling hash over the last keys meets a condition, so both copies are cut at
the same places except near a difference. Chunks are reduced to fingerprints; chunks with a fingerprint that the other copy
has too hold the same rows and are done with. The other chunks are cut again, by a weaker condition, and compared in the same way.
Only rows of the small chunks that then remain are fetched and compared field by field; until then only keys and digests move.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import normal, schemas
from candlewick.plans.lineage import stored

BAR_KEY = ("bar_label", "genesis_us", "ts_close_us", "exchange", "symbol")
BAR_FIELDS = ("open", "high", "low", "close", "volume", "value")
WINDOW = 3  # keys in the rolling hash
MASK, SUB_MASK = 31, 1  # a chunk ends every 32 keys on average, a small one every 2; cuts of chunks are cuts of small ones too


def bars(df: DataFrame) -> DataFrame:
    """Bars with instants as epoch microseconds and exchange and symbol in one spelling."""
    return df.select(
        "bar_label", normal.instant_us(F.col("genesis_ts")).alias("genesis_us"), normal.instant_us(F.col("ts_close")).alias("ts_close_us"),
        normal.exchange(F.col("exchange")).alias("exchange"), normal.symbol(F.col("symbol")).alias("symbol"), *BAR_FIELDS,
    )


def _hash(names: Sequence[str], seed: int) -> Column:
    nulls = F.concat(*(F.when(F.col(n).isNull(), "1").otherwise("0") for n in names))
    return F.xxhash64(F.lit(seed), nulls, *names)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row the hashes of the first keys of its chunk and of its small chunk. Rows of one key are never parted. Keeps the last keys between batches."""
    past, last, at_end = np.zeros(0, np.uint64), None, {"_chunk": 0, "_sub": 0}
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("_key").to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.empty(len(key), bool)
        new[0], new[1:] = last is None or key[0] != last, key[1:] != key[:-1]
        fresh = np.concatenate([past, key[new].view(np.uint64)])
        rolled = np.zeros(len(fresh), np.uint64)
        for j in range(WINDOW):
            h = fresh[: len(fresh) - j]
            s = np.uint64(13 * j)
            rolled[j:] += (h << s) | (h >> (np.uint64(64) - s)) if j else h
        rolled ^= rolled >> np.uint64(32)
        ids = {}
        for name, mask in (("_chunk", MASK), ("_sub", SUB_MASK)):
            opens = np.zeros(len(key), bool)
            opens[new] = (rolled[len(past) :] & np.uint64(mask)) == 0
            if last is None:
                opens[0] = True
            at = np.maximum.accumulate(np.where(opens, np.arange(len(key)), -1))
            ids[name] = np.where(at < 0, at_end[name], key[np.maximum(at, 0)])
            at_end[name] = int(ids[name][-1])
        past, last = fresh[-(WINDOW - 1) :], key[-1]
        kept = ("_key", "_d1", "_d2")
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(pa.array(v, pa.int64()) for v in ids.values())], names=[*kept, *ids])


def chunked(rows: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(_key, _d1, _d2, _chunk, _sub): hashes of the distinct rows with their chunks, stored in the shared folder.

    Repeated rows are reduced before the range shuffle, so that the ranges (bounds by sampling) can't be hot. It is stored
    because a second sampling would move the ranges' ends, at which chunks end too.
    """
    every = [*key, *fields]
    hashed = rows.select(*key, _hash(key, 1).alias("_key"), _hash(every, 2).alias("_d1"), _hash(every, 3).alias("_d2")).distinct()
    ordered = hashed.repartitionByRange(*key).sortWithinPartitions(*key)
    return stored(ordered.mapInArrow(_cuts, "_key bigint, _d1 bigint, _d2 bigint, _chunk bigint, _sub bigint"), "chunks")


def _prints(rows: DataFrame, by: str = "_chunk") -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.bit_xor("_d1").alias("_x1"), F.bit_xor("_d2").alias("_x2"))


def unmatched(a: DataFrame, b: DataFrame) -> DataFrame:
    """The ``_key`` of rows of either side in small chunks whose fingerprint the other side lacks, looked for in chunks whose fingerprint it lacks."""
    for by in ("_chunk", "_sub"):
        pa_, pb = _prints(a, by), _prints(b, by)
        only = lambda x, y: x.join(y, [by, "_n", "_x1", "_x2"], "left_anti").select(by)  # noqa: B023, E731
        a, b = a.join(only(pa_, pb), by, "left_semi"), b.join(only(pb, pa_), by, "left_semi")
    return a.select("_key").unionByName(b.select("_key")).distinct()


def differences(left: DataFrame, right: DataFrame, key: Sequence[str], fields: Sequence[str], left_only: str, right_only: str) -> DataFrame:
    """(key..., difference): keys on one side only, and the name of each field that isn't exactly equal (null equals only null).

    Repeated rows count once. If a side has several different rows of one key, a field is equal if its least and greatest value
    and whether it is ever null agree. Null key parts are values. Other columns play no part. Empty sides are fine.
    """
    keys = unmatched(chunked(left, key, fields), chunked(right, key, fields))
    rest = lambda side, is_left: side.select(*key, *fields, _hash(key, 1).alias("_key")).join(keys, "_key", "left_semi").select(*key, *fields, F.lit(is_left).alias("_left"))
    rest_a, rest_b = rest(left, True), rest(right, False)
    aggs = [F.max("_left").alias("_any_left"), F.min("_left").alias("_all_left")]
    for f in fields:
        for s, mine in (("l", F.col("_left")), ("r", ~F.col("_left"))):
            value = F.when(mine, F.col(f))
            aggs += [F.min(value).alias(f"_{f}_{s}0"), F.max(value).alias(f"_{f}_{s}1"), F.max(mine & F.col(f).isNull()).alias(f"_{f}_{s}n")]
    both = rest_a.unionByName(rest_b).groupBy(*key).agg(*aggs)
    differs = [
        F.when(~(F.col(f"_{f}_l0").eqNullSafe(F.col(f"_{f}_r0")) & F.col(f"_{f}_l1").eqNullSafe(F.col(f"_{f}_r1")) & F.col(f"_{f}_ln").eqNullSafe(F.col(f"_{f}_rn"))), F.lit(f))
        for f in fields
    ]
    kinds = F.when(F.col("_all_left"), F.array(F.lit(left_only))).when(~F.col("_any_left"), F.array(F.lit(right_only))).otherwise(F.array_compact(F.array(*differs)))
    return both.select(*key, F.explode(kinds).alias("difference"))


def bar_differences(hot: DataFrame, cold: DataFrame) -> DataFrame:
    return differences(bars(hot), bars(cold), BAR_KEY, BAR_FIELDS, "hot_only", "cold_only")
