"""Health figures over a listing of files: (exchange, symbol, date, bytes, modified), and verdicts on them."""

import csv
import io
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators import quality


def volume(files: DataFrame) -> DataFrame:
    """Bytes in all, of each series and of each day: one rollup-like pass with grouping sets; ``level`` says which."""
    got = files.groupingSets([["exchange", "symbol"], ["date"], []], "exchange", "symbol", "date").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n_files"), F.grouping_id().alias("g"))
    return got.select(F.when(F.col("g") == 7, "total").when(F.col("g") == 1, "series").otherwise("day").alias("level"), "exchange", "symbol", "date", "bytes", "n_files")


def file_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("exchange", "symbol", "date").agg(F.count(F.lit(1)).alias("n_files"))


def lag_seconds(files: DataFrame, now: Column) -> DataFrame:
    """Seconds since an exchange's latest file, at least 0."""
    return files.groupBy("exchange").agg(F.greatest((F.unix_micros(now) - F.unix_micros(F.max("modified"))) / F.lit(1e6), F.lit(0.0)).alias("lag_s"))


def within(actual: Column, expected: Column, tolerance: float) -> Column:
    return F.when(F.abs(actual - expected) <= expected * F.lit(tolerance), "PASS").otherwise("FAIL")


def lag_verdict(lag_s: Column, limit_s: float) -> Column:
    return F.when(lag_s <= limit_s, "PASS").otherwise("FAIL")


def node_levels(rows: DataFrame, now: Column, yellow_s: float, red_s: float) -> DataFrame:
    """Each node's level by the age of its last sign of life: GREEN, YELLOW or RED (also if it never gave one)."""
    age = (F.unix_micros(now) - F.unix_micros(F.max("at"))) / F.lit(1e6)
    return rows.groupBy("node_id").agg(F.max("at").alias("last_at"), age.alias("age_s")).withColumn("level", F.when(F.col("age_s") <= yellow_s, "GREEN").when(F.col("age_s") <= red_s, "YELLOW").otherwise("RED"))


def status_rollup(rows: DataFrame, status: str) -> DataFrame:
    """One row: counts of each status and the overall state by priority: blocked, quarantined, resumable, done."""
    n = lambda s: F.count(F.when(F.col(status) == s, 1))
    got = rows.agg(n("blocked").alias("blocked"), n("quarantined").alias("quarantined"), n("pending").alias("pending"), n("done").alias("done"))
    return got.withColumn("overall", F.when(F.col("blocked") > 0, "BLOCKED").when(F.col("quarantined") > 0, "QUARANTINED").when(F.col("pending") > 0, "RESUMABLE").otherwise("DONE"))


def capacity(used: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(layer, bytes, ratio) of each layer with a limit, and the layer ``max`` with the greatest ratio."""
    lim = F.create_map(*(F.lit(x) for kv in limits.items() for x in kv))
    got = used.groupBy("layer").agg(F.sum("bytes").alias("bytes")).withColumn("ratio", F.col("bytes").cast("double") / F.try_element_at(lim, F.col("layer"))).where("ratio is not null")
    return got.unionByName(got.agg(F.lit("max").alias("layer"), F.max("bytes").alias("bytes"), F.max("ratio").alias("ratio")))


def coverage(rows: DataFrame, series: Sequence[str] = ("exchange", "symbol"), gap_s: float = 300.0) -> DataFrame:
    """(series..., first_ts, last_ts, n_rows, n_nodes, n_runs, n_days, n_gaps, longest_gap_s, gap_total_s) of events (ts_utc, node_id, collector_run_id).

    Distinct counts are exact and partially aggregated; gaps come from buckets' ends. Rows without an instant count in n_rows, n_nodes and n_runs only; a null node or run isn't counted.
    """
    a = rows.groupBy(*series).agg(
        F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("node_id").alias("n_nodes"), F.count_distinct("collector_run_id").alias("n_runs"),
        F.count_distinct(F.to_date("ts_utc")).alias("n_days"),
    )
    return _with_gaps(a, quality.bucketed_gaps(rows, series, "ts_utc", gap_s), series)


def _with_gaps(a: DataFrame, gaps: DataFrame, series: Sequence[str]) -> DataFrame:
    g = gaps.groupBy(*(F.col(s).alias(f"_g_{s}") for s in series)).agg(F.count(F.lit(1)).alias("n_gaps"), F.max("gap_s").alias("longest_gap_s"), F.sum("gap_s").alias("gap_total_s"))
    met = F.lit(True)
    for s in series:
        met = met & F.col(s).eqNullSafe(F.col(f"_g_{s}"))
    return a.join(g, met, "left").drop(*(f"_g_{s}" for s in series)).fillna(0, ["n_gaps", "longest_gap_s", "gap_total_s"])


def node_coverage(rows: DataFrame, series: Sequence[str] = ("exchange", "symbol"), gap_s: float = 300.0) -> DataFrame:
    """``coverage`` of each node by itself, its own gaps included, with the worst delay of arrival (epoch microseconds)."""
    key = [*series, "node_id"]
    a = rows.groupBy(*key).agg(F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"), F.count(F.lit(1)).alias("n_rows"), F.max(F.unix_micros("received_at") - F.unix_micros("ts_utc")).alias("worst_delay_us"))
    return _with_gaps(a, quality.bucketed_gaps(rows, key, "ts_utc", gap_s), key)


def run_id(path: Column) -> Column:
    """The collector run in a file's name: ``part-<run>.parquet``, or ``<run>-<batch>.parquet``."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/\\\\]+)$", 1), r"\.[^.]*$", "")
    return F.when(stem.startswith("part-"), F.substring(stem, 6, 2**30)).otherwise(F.regexp_replace(stem, r"-[^-]*$", ""))


def nearest_rank(rows: DataFrame, key: Sequence[str], value: str, q: float) -> DataFrame:
    """(key..., n, ``value``): of each key the value of rank ceil(q * n), counted from 1, of whole numbers; nulls don't count.

    Exact, by narrowing: counts of ranges of 2**32, then 2**16, then of single values, each within the range that holds the rank. A key has at most 65536 ranges at a
    step (for values within 2**48 of each other), so a key with a third of all rows is no large group; rows are read three times and only counts move.
    """
    left = rows.where(F.col(value).isNotNull()).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), F.col(value).cast("bigint").alias("_x"))
    keys = [f"_k{i}" for i in range(len(key))]
    goal = None
    for shift in (32, 16, 0):
        if goal is not None:
            met = F.shiftright("_x", shift + 16) == F.col("_range")
            for k in keys:
                met = met & F.col(k).eqNullSafe(F.col(f"g{k}"))
            inside = left.join(goal, met).select(*keys, "_x", "_rank", "_n")
        else:
            totals = left.groupBy(*(F.col(k).alias(f"g{k}") for k in keys)).agg(F.count(F.lit(1)).alias("_n"))
            met = F.lit(True)
            for k in keys:
                met = met & F.col(k).eqNullSafe(F.col(f"g{k}"))
            counts0 = left.groupBy(*keys, F.shiftright("_x", shift).alias("_range")).agg(F.count(F.lit(1)).alias("_c"))
            inside = None
        if inside is None:
            counts = counts0.join(totals, met).select(*keys, "_range", "_c", F.greatest(F.ceil(F.col("_n") * F.lit(q)), F.lit(1)).alias("_rank"), "_n")
        else:
            counts = inside.groupBy(*keys, F.shiftright("_x", shift).alias("_range"), "_rank", "_n").agg(F.count(F.lit(1)).alias("_c"))
        w = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counts.withColumn("_upto", F.sum("_c").over(w))
        hit = placed.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank")))
        goal = hit.select(*(F.col(k).alias(f"g{k}") for k in keys), "_range", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_rank"), "_n")
    return goal.select(*(F.col(f"g{k}").alias(n) for k, n in zip(keys, key, strict=True)), F.col("_n").alias("n"), F.col("_range").alias(value))


def hit_ratio(hits: Column, misses: Column) -> Column:
    """Hits over all, null if there were none."""
    return F.when(hits + misses > 0, hits.cast("double") / (hits + misses))


def queue_depth(queue: DataFrame, status: str = "status", size: str = "bytes") -> DataFrame:
    """(status, depth, bytes) of a table of queued items, and a row ``all``."""
    agg = [F.count(F.lit(1)).alias("depth"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")]
    return queue.groupBy(F.coalesce(status, F.lit("unknown")).alias("status")).agg(*agg).unionByName(queue.agg(*agg).select(F.lit("all").alias("status"), "depth", "bytes"))


def segment_inventory(listing: DataFrame) -> DataFrame:
    """(exchange, channel, state, n_segments, bytes, first_modified, last_modified) of log segments by state, from a listing (path, length, modified) under ``.../<exchange>/<channel>/...``.

    States: ``active``, ``sealed`` (still to be compacted), ``compacted`` (a segment with a marker; the marker is not counted).
    """
    base = F.regexp_replace("path", r"\.compacted$", "")
    marks = listing.where(F.col("path").endswith(".sealed.compacted")).select(base.alias("_m")).distinct()
    segments = listing.where(F.col("path").rlike(r"\.ndjson(\.sealed)?$")).join(marks, F.col("path") == F.col("_m"), "left")
    state = F.when(F.col("_m").isNotNull(), "compacted").when(F.col("path").endswith(".sealed"), "sealed").otherwise("active")
    part = lambda i: F.regexp_extract("path", r"/wal/([^/]+)/([^/]+)/", i)
    return segments.groupBy(part(1).alias("exchange"), part(2).alias("channel"), state.alias("state")).agg(
        F.count(F.lit(1)).alias("n_segments"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.min("modified").alias("first_modified"), F.max("modified").alias("last_modified")
    )


GIB = 1024**3


def report(files: DataFrame, missing: DataFrame, expected: DataFrame, now: Column, expected_gib: float, tolerance: float = 0.2, lag_limit_s: float = 60.0) -> DataFrame:
    """Four rows (layer, actual, expected, unit, verdict, detail): volume within ``tolerance`` of what is expected, no missing partitions, the file count (always PASS), the longest lag of an exchange.

    ``missing`` are rows of ``expected`` (partitions). Without files the lag is null and its verdict N/A; an expected volume of 0 is only met by 0 files, never within a tolerance.
    """
    none = F.lit(0).cast("bigint")
    per = files.groupBy("exchange").agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("n_files"), F.max("modified").alias("at"))
    age = F.greatest((F.unix_micros(now) - F.unix_micros("at")) / F.lit(1e6), F.lit(0.0))
    parts = [per.select("bytes", "n_files", age.alias("lag"), none.alias("n_missing"), none.alias("n_expected"))]
    for df, name in ((missing, "n_missing"), (expected, "n_expected")):
        n = df.agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(none.alias("bytes"), none.alias("n_files"), F.lit(None).cast("double").alias("lag"), *((F.col("n") if c == name else none).alias(c) for c in ("n_missing", "n_expected"))))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    row = every.agg((F.sum("bytes") / F.lit(float(GIB))).alias("gib"), *(F.sum(c).alias(c) for c in ("n_files", "n_missing", "n_expected")), F.max("lag").alias("lag"))
    d = lambda c: c.cast("double")
    volume_ok = F.lit(False) if expected_gib == 0 else F.abs(F.col("gib") - expected_gib) <= expected_gib * tolerance
    verdict = lambda ok: F.when(ok, "PASS").otherwise("FAIL")
    layers = F.array(
        _layer("volume", F.round(F.col("gib"), 3), F.lit(float(expected_gib)), "GiB", verdict(volume_ok), F.format_string("%.3f GiB of %.3f", d(F.col("gib")), F.lit(float(expected_gib)))),
        _layer("gap", d(F.col("n_missing")), F.lit(0.0), "missing_partitions", verdict(F.col("n_missing") == 0), F.format_string("%d missing of %d expected", "n_missing", "n_expected")),
        _layer("file_count", d(F.col("n_files")), F.lit(None).cast("double"), "files", F.lit("PASS"), F.format_string("%d files", "n_files")),
        _layer("lag", F.round(F.col("lag"), 1), F.lit(float(lag_limit_s)), "seconds", F.when(F.col("lag").isNull(), "N/A").otherwise(verdict(F.col("lag") <= lag_limit_s)), F.coalesce(F.format_string("%.0f s, limit %.0f s", d(F.col("lag")), F.lit(float(lag_limit_s))), F.lit("no files"))),
    )
    return row.select(F.inline(layers))


def _layer(name: str, actual: Column, expected: Column, unit: str, verdict: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("layer"), actual.alias("actual"), expected.alias("expected"), F.lit(unit).alias("unit"), verdict.alias("verdict"), detail.alias("detail"))


def formatted(layers: DataFrame, form: str) -> str:
    """A report (a few rows) as ``json``, ``csv`` or ``markdown`` text."""
    rows = [r.asDict() for r in layers.collect()]
    names = layers.columns
    if form == "json":
        return json.dumps({"layers": rows, "overall": overall(rows)}, indent=2)
    if form == "csv":
        out = io.StringIO()
        w = csv.DictWriter(out, names, lineterminator="\n")
        w.writeheader()
        w.writerows(rows)
        return out.getvalue()
    if form == "markdown":
        cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
        lines = ["| " + " | ".join(names) + " |", "|" + " --- |" * len(names), *("| " + " | ".join(cell(r[n]) for n in names) + " |" for r in rows)]
        return "\n".join([*lines, "", f"Overall: {overall(rows)}", ""])
    raise ValueError(f"json, csv or markdown, not {form!r}")


def overall(rows: list[dict]) -> str:
    return "FAIL" if any(r["verdict"] == "FAIL" for r in rows) else "PASS"
