"""Comparing two derivations, listings and inventories by set operations, joins and aggregates."""

import random
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import normal

DRIFT_LIMIT = Decimal("0.0001")


class DriftError(ValueError):
    """Two derivations differ by the limit or more."""


def keyed_diff(left: DataFrame, right: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key..., status): ``matched``, ``mismatch``, ``left_only`` or ``right_only`` of every key; null equals only null. Keys must be unique a side."""
    a = left.select(*key, F.struct(*values).alias("_l"))
    b = right.select(*key, F.struct(*values).alias("_r"))
    both = a.join(b, list(key), "full_outer")
    return both.select(*key, F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").when(F.col("_l").eqNullSafe(F.col("_r")), "matched").otherwise("mismatch").alias("status"))


def drift(diff: DataFrame) -> DataFrame:
    """One row: counts a status and drift = (mismatches and one-sided) / larger side, as a decimal; 0 for two empty sides."""
    n = lambda *s: F.count(F.when(F.col("status").isin(*s), 1))
    got = diff.agg(n("matched").alias("matched"), n("mismatch").alias("mismatch"), n("left_only").alias("left_only"), n("right_only").alias("right_only"))
    bad = F.col("mismatch") + F.col("left_only") + F.col("right_only")
    side = F.greatest(F.col("matched") + F.col("mismatch") + F.col("left_only"), F.col("matched") + F.col("mismatch") + F.col("right_only"))
    return got.withColumn("drift", F.when(side > 0, (bad.cast("decimal(18,0)") / side.cast("decimal(18,0)")).cast("decimal(18,12)")).otherwise(F.lit(0).cast("decimal(18,12)")))


def assert_within(diff: DataFrame, limit: Decimal = DRIFT_LIMIT) -> None:
    got = drift(diff).first()
    if got["drift"] >= limit:
        raise DriftError(f"drift {got['drift']} is not below {limit}")


def sampled(universe: Sequence[str], fraction: Decimal, least: int, most: int, seed: int) -> list[str]:
    """A seeded sample of a small universe: int(n * fraction), at least ``least``, at most ``most`` and n."""
    k = min(max(int(len(universe) * fraction), least), most, len(universe))
    return random.Random(seed).sample(list(universe), k)


def missing(expected: DataFrame, actual: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of ``expected`` that ``actual`` lacks."""
    return expected.select(*key).distinct().join(actual.select(*key).distinct(), list(key), "left_anti")


def grid_gaps(present: DataFrame, series: Sequence[str], day: str) -> DataFrame:
    """(series..., day): days between a series' own first and last that it lacks; the grid is generated a series, not by a cross join."""
    days = present.groupBy(*series).agg(F.min(day).alias("a"), F.max(day).alias("b"))
    grid = days.select(*series, F.explode(F.sequence("a", "b")).alias(day))
    return missing(grid, present, [*series, day])


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with ``side``; repeated rows count as often as they are more on that side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def same_set(left: DataFrame, right: DataFrame, column: str) -> bool:
    """Whether both sides have the same distinct values of a column (hashes of a batch and of what is stored), null included."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def compared_counts(left: DataFrame, right: DataFrame, key: Sequence[str], tolerance: int = 0) -> DataFrame:
    """(key..., n_left, n_right, verdict) of two tables of counts: PASS if they agree within ``tolerance``, FAIL otherwise, SKIP if one side has none."""
    both = left.select(*key, "n_left").join(right.select(*key, "n_right"), list(key), "full_outer")
    verdict = F.when(F.col("n_left").isNull() | F.col("n_right").isNull(), "SKIP").when(F.abs(F.col("n_left") - F.col("n_right")) <= tolerance, "PASS").otherwise("FAIL")
    return both.select(*key, "n_left", "n_right", verdict.alias("verdict"))


def count_verdicts(left: DataFrame, right: DataFrame, key: Sequence[str], tolerance: int = 0) -> DataFrame:
    """``compared_counts`` of the rows of two tables; counted before they are joined."""
    n = lambda df, name: df.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    return compared_counts(n(left, "n_left"), n(right, "n_right"), key, tolerance)


def coverage_ratio(expected: DataFrame, present: DataFrame, key: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """(key..., n_expected, n_present, ratio): of the distinct parts (days, hours) that ``expected`` has of a key, those that ``present`` has too."""
    names = [*key, *parts]
    there = present.select(*names).distinct().withColumn("_there", F.lit(1))
    got = expected.select(*names).distinct().join(there, names, "left").groupBy(*key).agg(F.count(F.lit(1)).alias("n_expected"), F.count("_there").alias("n_present"))
    return got.withColumn("ratio", F.col("n_present") / F.col("n_expected"))


def flat_first(flat: DataFrame, legacy: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of both by key, those of ``flat`` where both have one; both have the same columns and unique keys."""
    return flat.unionByName(legacy.join(flat.select(*key), list(key), "left_anti").select(*flat.columns))


def gap_causes(gaps: DataFrame, heartbeats: DataFrame, fresh_s: float) -> DataFrame:
    """Gaps with ``cause``: LIKELY_NODE_DOWN if no node's heartbeat lies within ``fresh_s`` of the gap's end, else UNKNOWN.

    Heartbeats are put in buckets of that width, each gap meets three; a gap isn't compared with all heartbeats.
    """
    width = int(fresh_s * 1_000_000)
    h = heartbeats.where(F.col("at").isNotNull()).select(F.col("at").alias("_at"), normal.bucket(F.unix_micros("at"), F.lit(width)).alias("_b")).distinct()
    b = normal.bucket(F.unix_micros("before_ts"), F.lit(width))
    g = gaps.withColumn("_id", F.xxhash64(*gaps.columns))
    near = g.withColumn("_b", F.explode(F.array(b - 1, b, b + 1))).join(h, "_b").where(F.abs(F.unix_micros("_at") - F.unix_micros("before_ts")) <= width).select("_id").distinct().withColumn("_alive", F.lit(True))
    return g.join(near, "_id", "left").withColumn("cause", F.when(F.col("_alive"), "UNKNOWN").otherwise("LIKELY_NODE_DOWN")).drop("_id", "_alive")


def gap_causes_now(gaps: DataFrame, heartbeats: DataFrame, now: Column, stale_s: float) -> DataFrame:
    """Gaps with ``cause`` by the state of the nodes at ``now``: LIKELY_NODE_DOWN if any is disconnected (``ws_state``) or its heartbeat (``at``) is ``stale_s`` old or older, else UNKNOWN. Nodes that never gave one tell nothing."""
    old = F.coalesce((F.unix_micros(now) - F.unix_micros("at")) >= int(stale_s * 1_000_000), F.lit(False))
    down = heartbeats.where(old | F.coalesce(F.col("ws_state") == "disconnected", F.lit(False)))
    return gaps.withColumn("cause", F.lit("UNKNOWN" if down.isEmpty() else "LIKELY_NODE_DOWN"))


#: Checks in the order in which the first that fails names the outcome.
INVARIANTS = ("object_count", "sha256", "row_count", "column_count", "column_order", "dtype", "schema_version", "ambiguity")


def file_invariants(left: DataFrame, right: DataFrame, columns: dict[str, Sequence[str]]) -> DataFrame:
    """(invariant, ok, n_bad) of eight checks over two listings (name, rows, digest, names array<string>, types array<string>, schema_version), in the order of ``INVARIANTS``.

    Files pair by name. object_count: as many files on both sides. Of pairs: digests and row counts agree; both have as many columns, and just those, as ``columns`` declares for the
    left side's schema version (an unknown version fails); types agree in order; schema version: all are declared and the sides agree. ambiguity: a file is at both places at once
    (``left`` and ``right`` having a column ``authoritative`` that is true on both sides; without it nothing is ambiguous).
    """
    claims = "authoritative" in left.columns and "authoritative" in right.columns
    fields = ["name", "rows", "digest", "names", "types", "schema_version", *(["authoritative"] if claims else [])]
    r = right.select(*(F.col(c).alias(f"r_{c}") for c in fields))
    both = left.select(*fields).join(r, F.col("name") == F.col("r_name"), "full_outer")
    paired = F.col("name").isNotNull() & F.col("r_name").isNotNull()
    bad = lambda c: F.count(F.when(paired & ~F.coalesce(c, F.lit(False)), 1))
    same = lambda n: F.col(n).eqNullSafe(F.col(f"r_{n}"))
    declared = F.create_map(*(x for k, v in columns.items() for x in (F.lit(k), F.array(*map(F.lit, v))))) if columns else F.lit(None).cast("map<string,array<string>>")
    want = F.try_element_at(declared, F.col("schema_version"))
    count_ok = (F.size("names") == F.size(want)) & (F.size("r_names") == F.size(want))
    versions = F.col("schema_version").isin(list(columns)) & same("schema_version")
    n = {
        "object_count": F.abs(F.count("name") - F.count("r_name")), "sha256": bad(same("digest")), "row_count": bad(same("rows")), "column_count": bad(count_ok & want.isNotNull()),
        "column_order": bad((F.col("names") == want) & (F.col("r_names") == want)), "dtype": bad(same("types")), "schema_version": bad(versions),
        "ambiguity": F.count(F.when(paired & F.col("authoritative") & F.col("r_authoritative"), 1)) if claims else F.lit(0).cast("bigint"),
    }
    got = both.agg(*(c.alias(k) for k, c in n.items()))
    rows = F.array(*(F.struct(F.lit(i).alias("k"), F.lit(k).alias("invariant"), (F.col(k) == 0).alias("ok"), F.col(k).alias("n_bad")) for i, k in enumerate(INVARIANTS)))
    return got.select(F.inline(rows)).orderBy("k").select("invariant", "ok", "n_bad")


def invariant_status(checks: DataFrame) -> str:
    """``all_pass``, or the first of ``INVARIANTS`` that fails, with ``_fail``; of eight rows."""
    bad = {r.invariant for r in checks.where(~F.col("ok")).collect()}
    return next((f"{k}_fail" for k in INVARIANTS if k in bad), "all_pass")


def with_status(items: DataFrame, statuses: DataFrame, key: str, default: str = "0") -> DataFrame:
    """``items`` with ``asset_status`` of their key: ``1`` if deposit and withdrawal are both open; ``default`` for items without a status. Of several statuses of a key the most open counts."""
    opened = (F.coalesce(F.col("deposit_status"), F.lit("0")) == "1") & (F.coalesce(F.col("withdrawal_status"), F.lit("0")) == "1")
    one = statuses.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("_key")).agg(F.max(F.when(opened, "1").otherwise("0")).alias("asset_status"))
    return items.join(one, F.col(key) == F.col("_key"), "left").drop("_key").withColumn("asset_status", F.coalesce("asset_status", F.lit(default)))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double"))
