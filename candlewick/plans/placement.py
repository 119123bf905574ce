"""Placing rows in files: which file a row belongs to and which task writes it, from exact counts.

Rows belong to partitions (folders), and within one to cells in order (parts of a curve, spans of time). A partition is cut into files of equal size
at cell bounds, a file is written by one task, and partitions smaller than a file share tasks; so neither a hot partition nor millions of tiny ones matter.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.plans.lineage import cut

LANE_ROWS = 1_000_000  # partitions whose sizes are summed up by one task
FILE_ROWS = 5_000_000


def placed(records: DataFrame, parts: Sequence[str], cell: str, tie: str, target_rows: int = FILE_ROWS) -> tuple[DataFrame, int]:
    """``records`` with ``file_no`` within the partition and ``task``; and how many tasks there are.

    ``parts`` and ``cell`` (in the files' order) are columns without nulls, ``tie`` a bigint by whose remainder a cell that alone exceeds a file is cut, so that
    no file exceeds twice the target. ``records`` are read twice. A task holds one file of a partition of several, or whole smaller partitions
    up to the target (fewer where that would leave cores idle).
    """
    spark, parts = records.sparkSession, list(parts)
    cells = records.groupBy(*parts, cell).agg(F.count(F.lit(1)).alias("n"))
    sizes = cut(cells.groupBy(*parts).agg(F.sum("n").alias("total")))  # a row a partition
    n_partitions, n_rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("total"), F.lit(0))).first()
    share = max(1, min(target_rows, n_rows // (2 * spark.sparkContext.defaultParallelism)))
    several = lambda x: F.when(F.col("files") > 1, x).otherwise(0)
    small = F.when(F.col("files") == 1, F.col("total")).otherwise(0)
    # task numbers: prefix sums within lanes of partitions, then over lanes
    lane = sizes.withColumns({"files": F.ceil(F.col("total") / F.lit(target_rows)).cast("bigint"), "lane": F.pmod(F.xxhash64(*parts), F.lit(n_partitions // LANE_ROWS + 1))})
    before = Window.partitionBy("lane").orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    lane = cut(lane.withColumns({"pack": (F.coalesce(F.sum(small).over(before), F.lit(0)) / F.lit(share)).cast("bigint"), "own": F.coalesce(F.sum(several(F.col("files"))).over(before), F.lit(0))}))
    ends = lane.groupBy("lane").agg((F.max("pack") + 1).alias("packs"), F.sum(several(F.col("files"))).alias("owns"))
    up_to = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)  # over one row a lane
    bases = ends.select(F.col("lane").alias("l"), "packs", F.coalesce(F.sum(F.col("packs") + F.col("owns")).over(up_to), F.lit(0)).alias("base"))
    n_tasks = ends.agg(F.coalesce(F.sum(F.col("packs") + F.col("owns")), F.lit(0))).first()[0]
    first_task = F.when(F.col("files") > 1, F.col("base") + F.col("packs") + F.col("own")).otherwise(F.col("base") + F.col("pack"))
    plan = lane.join(bases, F.col("lane") == F.col("l")).select(*parts, "files", F.ceil(F.col("total") / F.col("files")).alias("size"), first_task.alias("first_task"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy(*parts).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over the cells of a partition
    cuts = cells.withColumn("before", earlier).join(plan, parts).select(
        *parts, cell, "files", "first_task", (F.col("before") / F.col("size")).cast("bigint").alias("first"), F.ceil(F.col("n") / F.col("size")).alias("pieces")
    )
    file_no = F.least(F.col("first") + F.pmod(F.col(tie), "pieces"), F.col("files") - 1)
    got = records.join(cuts, [*parts, cell]).withColumn("file_no", file_no)
    return got.select(*records.columns, "file_no", (F.col("first_task") + several(F.col("file_no"))).alias("task")), int(n_tasks)


def write(records: DataFrame, path: str, parts: Sequence[str], cell: str, tie: str, order: Sequence[str], folders: Sequence[str] | None = None, target_rows: int = FILE_ROWS, mode: str = "append", drop: Sequence[str] = (), flat: bool = False) -> None:
    """The records under ``path``, in files of one span of cells each, sorted by ``order``; without ``cell``, ``tie`` and those of ``drop``. ``overwrite`` replaces the partitions that occur.

    ``folders`` names the columns that folders are made of, in place of those of ``parts`` in the same order, which are then not written. ``flat`` makes no folders: the columns are
    written, small partitions share files.
    """
    rows, n_tasks = placed(records, parts, cell, tie, target_rows)
    made = list(folders or parts)
    files = rows.repartitionById(max(n_tasks, 1), F.col("task").cast("int")).sortWithinPartitions(*made, "file_no", *order)
    gone = {cell, tie, *made, *parts, *drop}
    out = files.select(*(c for c in records.columns if c not in gone), *made).write.option("maxRecordsPerFile", 2 * target_rows).option("partitionOverwriteMode", "dynamic")
    out = out.mode(mode)
    (out if flat else out.partitionBy(*made)).parquet(path)


def by_time(rows: DataFrame, path: str, parts: Sequence[str], ts: str, order: Sequence[str], span_s: int = 60, target_rows: int = FILE_ROWS, mode: str = "append") -> None:
    """``write`` of rows whose files are spans of time; cells are ``span_s`` wide. Rows without an instant go first; nulls of partition columns make a folder of their own."""
    us = F.coalesce(F.unix_micros(ts), F.lit(-(2**62)))
    named = rows.withColumns({f"__{p}": F.coalesce(F.col(p).cast("string"), F.lit("\x00")) for p in parts})
    celled = named.withColumns({"__cell": F.floor(us / F.lit(span_s * 1_000_000)).cast("bigint"), "__tie": F.xxhash64(*rows.columns)})
    write(celled, path, [f"__{p}" for p in parts], "__cell", "__tie", order, list(parts), target_rows, mode)
