"""Consolidating many tiny files into few well-sized ones, clustered along a Hilbert curve.

Every record gets a multidimensional code (time of day, price, level). An exact histogram of code cells cuts each partition
(exchange, symbol, day) into ranges of equal size, and the ranges' numbers place the records: a shuffle by range number brings each
range to one task, which writes one file; partitions smaller than a file share tasks. Row digests of source and destination are then compared.
The same codes and digests tell which source files hold nothing that another lacks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import hilbert, normal, paths, schemas
from candlewick.plans import placement
from candlewick.plans.lineage import cut, scratch, stored

RECORD = ("ts_utc", "exchange", "symbol", "baseline_seq", "side", "level", "price", "quantity")
PARTITION = ("p_exchange", "p_symbol", "p_date")
CODE = "hilbert_code"
BITS, CELL_BITS = 20, 20  # bits an axis; leading bits of a code that make a histogram cell
TARGET_ROWS = 1_000_000


def digest(seed: int) -> Column:
    nulls = F.concat(*(F.when(F.col(n).isNull(), "1").otherwise("0") for n in RECORD))
    return F.xxhash64(F.lit(seed), nulls, *RECORD)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    top = (1 << BITS) - 1
    for b in batches:
        us = pc.fill_null(b.column("_us"), 0).to_numpy(zero_copy_only=False)
        price = pc.fill_null(b.column("_price"), 0.0).to_numpy(zero_copy_only=False)
        level = pc.fill_null(b.column("_level"), 0).to_numpy(zero_copy_only=False)
        day = (us % 86_400_000_000) * (top + 1) // 86_400_000_000
        with np.errstate(all="ignore"):
            log = np.where(price > 0, np.log2(np.where(price > 0, price, 1)), -64)
        scaled = np.clip((log + 64) / 192 * top, 0, top)  # decimals of 38 digits lie within 2**-60 and 2**67
        code = hilbert.codes([day.astype(np.uint64), scaled.astype(np.uint64), np.clip(level, 0, top).astype(np.uint64)], BITS)
        keep = [n for n in b.schema.names if n not in ("_us", "_price", "_level")]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(code)], names=[*keep, CODE])


def coded(rows: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns of ``rows`` with two row digests ``d1``, ``d2`` and the Hilbert code. Null parts count as 0 in a code."""
    picked = rows.select(*carry, digest(11).alias("d1"), digest(12).alias("d2"), F.unix_micros("ts_utc").alias("_us"), F.col("price").cast("double").alias("_price"), F.col("level").cast("bigint").alias("_level"))
    schema = schemas.plus(picked.drop("_us", "_price", "_level").schema, **{CODE: "bigint"})
    return picked.mapInArrow(_coded, schema)


def _partition() -> list[Column]:
    return [
        F.coalesce(normal.exchange(F.col("exchange")), F.lit("unknown")).alias("p_exchange"),
        F.coalesce(normal.symbol(F.col("symbol")), F.lit("unknown")).alias("p_symbol"),
        F.coalesce(F.to_date("ts_utc"), F.lit("1970-01-01").cast("date")).alias("p_date"),
    ]


def placed(rows: DataFrame, target_rows: int = TARGET_ROWS) -> tuple[DataFrame, int]:
    """Distinct records with partition, code, ``file_no`` within the partition and ``task``, by the exact histogram of code cells (``placement.placed``). Copies go before the shuffle by partial aggregation."""
    return placement.placed(_records(rows), PARTITION, "cell", "d1", target_rows)


def _records(rows: DataFrame) -> DataFrame:
    once = rows.select(*RECORD).distinct()
    got = coded(once.select(*RECORD, *_partition()), *RECORD, *PARTITION).withColumn("cell", F.shiftright(CODE, 3 * BITS - CELL_BITS))
    return stored(got.drop("d2"), "coded")


def write(rows: DataFrame, path: str, target_rows: int = TARGET_ROWS, keep: tuple[str, ...] = (), flat: bool = False) -> None:
    """The records of ``rows``, each exactly once, as Parquet partitioned by exchange, symbol and day, clustered by code; ``keep`` may name ``CODE``. ``flat`` makes no folders, so that small partitions share files."""
    placement.write(_records(rows), path, PARTITION, "cell", "d1", [CODE], PARTITION, target_rows, "errorifexists", () if CODE in keep else (CODE,), flat)


def _sums(records: DataFrame, name: str) -> DataFrame:
    d = records.select(*_partition(), digest(11).alias("d1"), digest(12).alias("d2"))
    return d.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.bit_xor("d1").alias(f"x1_{name}"), F.bit_xor("d2").alias(f"x2_{name}"))


def compaction_report(rows: DataFrame, chunks: DataFrame, target_rows: int = TARGET_ROWS, path: str | None = None) -> DataFrame:
    """Compacts into ``path`` (a new folder by default) and compares digests: one row a partition.

    (p_exchange, p_symbol, p_date, n_stored, n_source_files, n_listed_files, n_object_keys, n_records, n_files, equal). ``n_stored`` counts rows as
    stored, copies too; ``n_listed_files`` are the source files whose path ``chunks`` lists, ``n_object_keys`` the different object keys these
    claim (in canonical form); ``equal`` says that source and destination hold the same set of records. Rows of unlisted files are moved as
    well; empty files move nothing. A file listed several times counts once, with its least path and key. Empty rows: no partitions, no rows.
    """
    spark = rows.sparkSession
    path = path or scratch(spark, "compacted")
    write(rows, path, target_rows)
    schema = rows.select(*RECORD, *_partition()).schema
    dest = spark.read.schema(schema).parquet(path)
    listed = chunks.where(F.col("chunk_id").isNotNull()).groupBy("chunk_id").agg(F.min(F.struct(paths.unix(F.col("source_path")).alias("path"), paths.canonical_key(F.col("nas_object_key")).alias("key"))).alias("at"))
    per_file = rows.select("chunk_id", *_partition()).groupBy("chunk_id", *PARTITION).agg(F.count(F.lit(1)).alias("n"))  # files are joined, not rows
    source_files = per_file.join(listed, "chunk_id", "left").groupBy(*PARTITION).agg(
        F.sum("n").alias("n_stored"), F.count("chunk_id").alias("n_source_files"), F.count("at.path").alias("n_listed_files"), F.count_distinct("at.key").alias("n_object_keys")
    )
    files = dest.select(*PARTITION, F.col("_metadata.file_path").alias("file")).groupBy(*PARTITION).agg(F.count_distinct("file").alias("n_files"))
    source = _sums(rows.select(*RECORD).distinct(), "source")
    target = _sums(dest.select(*RECORD), "target")
    both = source.join(target, list(PARTITION), "full_outer").join(files, list(PARTITION), "left").join(source_files, list(PARTITION), "left")
    equal = F.col("n_source").eqNullSafe(F.col("n_target")) & F.col("x1_source").eqNullSafe(F.col("x1_target")) & F.col("x2_source").eqNullSafe(F.col("x2_target"))
    return both.select(*PARTITION, "n_stored", "n_source_files", "n_listed_files", "n_object_keys", F.col("n_target").alias("n_records"), "n_files", equal.alias("equal"))


def containment(rows: DataFrame, target_rows: int = TARGET_ROWS, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, inside): of each file (chunk_id, rep), its class of files with the same records; of each pair of classes (a, b), that a's records are all in b.

    The records are first compacted into ``path`` (a new folder by default), with their codes. Each source record is looked up by digest among
    those written; one that isn't there raises. Files with equal record sets (size and two xors of digests) form a class, compared by one
    representative. A file can only lie within files that hold its rarest record (by the exact histogram) and whose code range covers its own; only
    the records of such pairs are compared, digest by digest. Files without records and null chunk_ids play no part.
    """
    spark = rows.sparkSession
    named = rows.where(F.col("chunk_id").isNotNull())
    path = path or scratch(spark, "compacted")
    write(named, path, target_rows, keep=(CODE,), flat=True)
    schema = schemas.plus(named.select(*RECORD).schema, **{CODE: "bigint"})
    laid = spark.read.schema(schema).parquet(path).select(digest(11).alias("d1"), digest(12).alias("d2"), F.col(CODE).alias("code"))
    held = named.select("chunk_id", digest(11).alias("d1"), digest(12).alias("d2")).distinct()
    met = held.join(laid, ["d1", "d2"], "left").withColumn("code", F.when(F.col("code").isNull(), F.raise_error(F.lit("a source record is not in the destination"))).otherwise(F.col("code")))
    recs = stored(met.select("chunk_id", "d1", "d2", "code"), "records")
    sets = cut(recs.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("d1").alias("x1"), F.bit_xor("d2").alias("x2"), F.min("code").alias("lo"), F.max("code").alias("hi")))  # a row a file
    same = ["n", "x1", "x2"]
    members = cut(sets.join(sets.groupBy(*same).agg(F.min("chunk_id").alias("rep")), same).select("chunk_id", "rep", "n", "lo", "hi"))
    own = stored(recs.join(members.where("chunk_id = rep").select("chunk_id", "n", "lo", "hi"), "chunk_id"), "representatives")
    histogram = own.groupBy("code").agg(F.count(F.lit(1)).alias("freq"))
    rarest = own.join(histogram, "code").groupBy("chunk_id", "n", "lo", "hi").agg(F.min(F.struct("freq", "code", "d1", "d2")).alias("r"))
    a = rarest.select(F.col("chunk_id").alias("a"), F.col("n").alias("n_a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), "r.code", "r.d1", "r.d2")
    b = own.select(F.col("chunk_id").alias("b"), F.col("n").alias("n_b"), "lo", "hi", "code", "d1", "d2")
    covers = (F.col("n_b") > F.col("n_a")) & (F.col("lo") <= F.col("lo_a")) & (F.col("hi") >= F.col("hi_a"))
    maybe = cut(a.join(b, ["code", "d1", "d2"]).where(covers).select("a", "b", "n_a"))
    mine = own.select(F.col("chunk_id").alias("a"), "code", "d1", "d2").join(maybe, "a")
    shared = mine.join(b.select("b", "code", "d1", "d2"), ["b", "code", "d1", "d2"]).groupBy("a", "b", "n_a").agg(F.count(F.lit(1)).alias("n"))
    return members.select("chunk_id", "rep"), shared.where(F.col("n") == F.col("n_a")).select("a", "b")


def contained_files(rows: DataFrame, target_rows: int = TARGET_ROWS, path: str | None = None) -> DataFrame:
    """(chunk_id_a, chunk_id_b), smaller first: pairs of files of which one holds every record of the other; ``containment``, written out for all members of the classes."""
    members, inside = containment(rows, target_rows, path)
    in_a = members.select(F.col("rep").alias("a"), F.col("chunk_id").alias("x"))
    in_b = members.select(F.col("rep").alias("b"), F.col("chunk_id").alias("y"))
    across = inside.join(in_a, "a").join(in_b, "b").select("x", "y")
    within = in_a.join(in_b, F.col("a") == F.col("b")).where(F.col("x") < F.col("y")).select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("chunk_id_a"), F.greatest("x", "y").alias("chunk_id_b"))
