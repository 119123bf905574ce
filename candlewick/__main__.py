"""Command line: ad-hoc SQL, compaction, promotion of history, health reports, status of nodes, effective settings."""

import argparse
import sys

from pyspark.sql import functions as F

from candlewick.operators import health, reconcile, tiers
from candlewick.sources import catalog, session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m candlewick")
    p.add_argument("--master")
    p.add_argument("--endpoint", help="of an S3-compatible store")
    sub = p.add_subparsers(dest="command", required=True)
    q = sub.add_parser("query", help="SQL over the Parquet tables of a folder")
    q.add_argument("--folder", required=True)
    q.add_argument("--table", action="append", required=True)
    q.add_argument("--sql", required=True)
    q.add_argument("--rows", type=int, default=1000, help="rows that are printed")
    c = sub.add_parser("compact", help="pending log segments to L1")
    c.add_argument("--wal", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--channel", required=True)
    c.add_argument("--upto")
    c.add_argument("--since")
    c.add_argument("--until")
    m = sub.add_parser("promote", help="a tier's days to the next tier")
    m.add_argument("--source", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--unit", choices=("hour", "day"), required=True)
    m.add_argument("--since")
    m.add_argument("--until")
    h = sub.add_parser("health-check", help="four-layer report over the files of a folder")
    h.add_argument("--folder", required=True)
    h.add_argument("--expected-gib", type=float, required=True)
    h.add_argument("--since", help="first day, inclusive")
    h.add_argument("--until", help="last day, inclusive")
    h.add_argument("--format", choices=("json", "csv", "markdown"), default="markdown")
    s = sub.add_parser("status", help="levels of nodes by their latest row")
    s.add_argument("--table", required=True)
    s.add_argument("--yellow", type=float, default=30)
    s.add_argument("--red", type=float, default=60)
    sub.add_parser("effective-config", help="the session's settings")
    return p


def run(argv: list[str]) -> tuple[int, str]:
    """Exit code and text to print."""
    a = parser().parse_args(argv)
    spark = session.session(master=a.master, store=session.ObjectStore(a.endpoint) if a.endpoint else None)
    if a.command == "query":
        catalog.register(spark, a.folder, a.table)
        return 0, catalog.sql_text(spark, a.sql, a.rows)
    if a.command == "compact":
        return 0, f"{tiers.compact_segments(spark, a.wal, a.out, a.channel, a.upto, a.since, a.until)} segments"
    if a.command == "promote":
        tiers.merge_tier(spark, a.source, a.out, a.unit, a.since, a.until)
        return 0, "done"
    if a.command == "health-check":
        listing = catalog.files(spark, a.folder, "*.parquet").withColumnsRenamed({"length": "bytes"})
        for bound, keep in ((a.since, F.col("date") >= a.since), (a.until, F.col("date") <= a.until)):
            listing = listing if bound is None else listing.where(keep)
        days = listing.select("exchange", "symbol", F.col("date").try_cast("date").alias("day")).where("day is not null")
        missing = reconcile.grid_gaps(days, ["exchange", "symbol"], "day")
        expected = days.distinct().unionByName(missing)
        layers = health.report(listing, missing, expected, F.current_timestamp(), a.expected_gib)
        return int(layers.where("verdict = 'FAIL'").count() > 0), health.formatted(layers, a.format)
    if a.command == "status":
        rows = spark.read.parquet(a.table).select("node_id", F.col("received_at").alias("at"))
        got = health.node_levels(rows, F.current_timestamp(), a.yellow, a.red).orderBy("node_id").collect()
        return int(any(r.level == "RED" for r in got)), "\n".join(f"{r.node_id}  {r.level}  {r.last_at}" for r in got)
    return 0, "\n".join(f"{k} = {v}" for k, v in session.effective(spark).items())


if __name__ == "__main__":
    code, text = run(sys.argv[1:])
    print(text)
    sys.exit(code)
