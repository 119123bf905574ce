"""Mixing sources to target shares of all tokens, with capped repetition.

Weights come from temperature mixing: a source's share is raised to an exponent, which is bisected to meet a target entropy or the
repetition limits. The weights are then realised as budgeted block permutations: a source is taken whole as often as its budget
holds it, and for the rest blocks of documents are taken in a permuted order until the budget is used up.
"""

import base64
import math
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.plans.lineage import cut

try:
    import public_tokenizers
except ImportError:
    public_tokenizers = None

#: The vocabulary's file unless a call or the session (``spark.candlewick.vocabulary``) names another: that of the package of public tokenizers, where it is installed.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken") if public_tokenizers else None
# Fixed value: how this vocabulary splits text before merging bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCKS = 1024
MOST_SOURCES = 10_000  # targets are a configuration; more of them are refused
_ENCODINGS: dict[str, object] = {}


def source_key(c: Column) -> Column:
    """One spelling a source: lower case, trimmed, ``-`` and blanks as ``_``; blank is null."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[-\s]+", "_")
    return F.when(s != "", s)


def token_counts(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, h, n_tokens) of every document; ``h`` is a hash of id and text. Null and empty texts have no tokens; whole texts are counted."""
    vocabulary = vocabulary or documents.sparkSession.conf.get("spark.candlewick.vocabulary", None) or VOCABULARY
    if not vocabulary:
        raise ValueError("spark.candlewick.vocabulary must name a vocabulary of ranks")
    with open(vocabulary, "rb") as f:
        data = f.read()  # of fixed size, some hundred kB; shipped with the function, for the file need not be on the workers

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        if vocabulary not in _ENCODINGS:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}
            _ENCODINGS[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        encode = _ENCODINGS[vocabulary].encode_ordinary
        for b in rows:
            n = [len(encode(t.as_py())) if t.is_valid else 0 for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64())], names=["doc_id", "source", "h", "n_tokens"])

    picked = documents.select(F.col("doc_id").cast("bigint"), source_key(F.col("source")).alias("source"), F.xxhash64("doc_id", "text").alias("h"), "text")
    return picked.mapInArrow(count, "doc_id bigint, source string, h bigint, n_tokens bigint")


def bisect(ok: Callable[[float], bool], low: float, high: float) -> float:
    """The least x in [low, high] with ok(x), where ok holds at ``high`` and from some x on."""
    if ok(low):
        return low
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if ok(middle) else (middle, high)
    return high


def powered(shares: Mapping[str, float], exponent: float) -> dict[str, float]:
    logs = {s: exponent * math.log(x) for s, x in shares.items()}
    top = max(logs.values(), default=0.0)
    w = {s: math.exp(x - top) for s, x in logs.items()}
    total = sum(w.values())
    return {s: x / total for s, x in w.items()}


def entropy(shares: Mapping[str, float]) -> float:
    return -sum(x * math.log(x) for x in shares.values() if x > 0)


def by_entropy(tokens: Mapping[str, int], target: float) -> tuple[dict[str, float], float]:
    """Shares n_s ** a and the exponent a, bisected so that their entropy is ``target`` nats (at most that of equal shares)."""
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items() if n > 0}
    if not shares:
        return {}, 0.0
    a = 16 - bisect(lambda x: entropy(powered(shares, 16 - x)) >= min(target, math.log(len(shares)) - 1e-9), 0.0, 16.0)
    return powered(shares, a), a


def tempered_plan(tokens: Mapping[str, int], repeats: Mapping[str, int], target: float, budget: int | None = None) -> "Plan":
    """Shares n_s ** a of the sources' tokens. Without ``budget`` a meets the target entropy, and the total is the largest that the repetition limits allow.

    With one, a lies as near to that exponent as the limits allow at this total, between it and 1 (natural shares); a budget beyond what they allow there is reduced.
    """
    have = {s: n for s, n in tokens.items() if n > 0 and repeats.get(s, 0) > 0}
    if not have:
        return Plan({}, {}, 0.0)
    natural = {s: n / sum(have.values()) for s, n in have.items()}
    most = {s: n * repeats[s] for s, n in have.items()}
    limit = lambda w: min(most[s] / w[s] for s in w)
    w, a = by_entropy(have, target)
    total = limit(w)
    if budget is not None:
        total = min(float(budget), max(total, limit(natural)))
        wanted = a
        x = bisect(lambda x: limit(powered(natural, wanted + (1 - wanted) * x)) >= total * (1 - 1e-12), 0.0, 1.0)
        a = wanted + (1 - wanted) * x
        w = powered(natural, a)
    return Plan(w, {s: min(int(total * w[s]), most[s]) for s in w}, a)


@dataclass(frozen=True)
class Plan:
    """What to take: per source the share, and the tokens to draw."""

    shares: dict[str, float]
    draw: dict[str, int]
    exponent: float


def plan(tokens: Mapping[str, int], targets: Mapping[str, float], repeats: Mapping[str, int], budget: int | None = None) -> Plan:
    """Weights and budgets of the sources that have both tokens and a target.

    Targets of other sources are spread over these in proportion. Without ``budget`` the largest total is taken at which no source
    exceeds its repetitions and every share is met exactly. With one, targets are tempered towards the natural shares,
    t_s * (n_s / t_s) ** b, by the least b at which the repetitions suffice; a budget beyond all repetitions is reduced.
    """
    have = {s: n for s, n in tokens.items() if n > 0 and targets.get(s, 0) > 0 and repeats.get(s, 0) > 0}
    if not have:
        return Plan({}, {}, 0.0)
    wanted = powered({s: targets[s] for s in have}, 1.0)
    most = {s: n * repeats[s] for s, n in have.items()}
    limit = lambda w: min(most[s] / w[s] for s in w)
    ratio = {s: have[s] / sum(have.values()) / wanted[s] for s in have}
    tempered = lambda b: powered({s: wanted[s] * ratio[s] ** b for s in have}, 1.0)
    if budget is None:
        total, b = limit(wanted), 0.0
    else:
        total = min(float(budget), limit(tempered(1.0))) if budget > limit(wanted) else float(budget)
        b = bisect(lambda x: limit(tempered(x)) >= total * (1 - 1e-12), 0.0, 1.0)
    w = tempered(b)
    return Plan(w, {s: min(int(total * w[s]), most[s]) for s in w}, b)


def _sums(counted: DataFrame) -> dict[str, int]:
    return {r.source: int(r.n) for r in counted.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}


def _targets(targets: DataFrame) -> tuple[dict[str, float], dict[str, int]]:
    rows = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").where(F.col("source").isNotNull()).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} targets")
    shares: dict[str, float] = {}
    repeats: dict[str, int] = {}
    for r in rows:  # a source that is listed again adds its share
        if r.target_share and r.target_share > 0 and not math.isnan(r.target_share):
            shares[r.source] = shares.get(r.source, 0.0) + r.target_share
            repeats[r.source] = max(repeats.get(r.source, 0), 1 if r.max_repeats is None else r.max_repeats)
    return shares, repeats


def realised(counted: DataFrame, draw: Mapping[str, int], sums: Mapping[str, int]) -> DataFrame:
    """(doc_id, source, n_tokens, repeats) of the documents taken; each source's tokens miss its budget by less than one document.

    Blocks, sub-blocks and at last documents are put in a permuted order, and those taken whose running total stays within the rest of the budget.
    Joins are on source and block, so that no source is a hot key. The windows see at most ``BLOCKS`` rows a source, and documents of one sub-block of one block (a millionth of a source).
    """
    spark = counted.sparkSession
    rows = [(s, d // sums[s], d % sums[s]) for s, d in draw.items()]
    budgets = F.broadcast(spark.createDataFrame(rows, "source string, passes bigint, rest bigint"))  # at most MOST_SOURCES rows
    block = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(BLOCKS))
    sub = F.pmod(F.xxhash64("h", F.lit(2)), F.lit(BLOCKS))
    docs = counted.join(budgets, "source").withColumns({"block": block, "sub": sub})

    def running(of: DataFrame, key: list[str], by: str, rest: str) -> DataFrame:
        """Of each part, the total before it in a permuted order and whether it fits (1), is cut (0), or lies beyond (-1)."""
        order = Window.partitionBy(*key).orderBy(F.xxhash64(by, *key), by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        got = of.groupBy(*key, by).agg(F.sum("n_tokens").alias("n"), F.max(rest).alias("rest_")).withColumn("upto", F.sum("n").over(order))
        before = F.col("upto") - F.col("n")
        fits = F.when(F.col("upto") <= F.col("rest_"), 1).when(before < F.col("rest_"), 0).otherwise(-1)
        return got.select(*key, by, fits.alias("fits"), (F.col("rest_") - before).alias("left"))

    first = running(docs, ["source"], "block", "rest")
    placed = docs.join(first, ["source", "block"])
    cut_blocks = placed.where("fits = 0").drop("fits")
    second = running(cut_blocks, ["source", "block"], "sub", "left").withColumnsRenamed({"fits": "fits2", "left": "left2"})
    inner = cut_blocks.drop("left").join(second, ["source", "block", "sub"])
    order = Window.partitionBy("source", "block", "sub").orderBy("h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = inner.where("fits2 = 0").withColumn("one", F.when(F.sum("n_tokens").over(order) <= F.col("left2"), 1).otherwise(0))
    keep = ["doc_id", "source", "n_tokens", "passes"]
    parts = (
        placed.where("fits <> 0").select(*keep, (F.col("fits") == 1).cast("int").alias("one")),
        inner.where("fits2 <> 0").select(*keep, (F.col("fits2") == 1).cast("int").alias("one")),
        last.select(*keep, "one"),
    )
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.select("doc_id", "source", "n_tokens", (F.col("passes") + F.col("one")).alias("repeats")).where("repeats > 0")


EMPTY = "doc_id bigint, source string, n_tokens bigint, repeats bigint"
REPORT = "source string, target_share double, max_repeats int, available bigint, exponent double, planned_share double, drawn bigint, documents bigint, repeats bigint, actual_share double"


def mixture(documents: DataFrame, targets: DataFrame, budget: int | None = None, vocabulary: str | None = None) -> DataFrame:
    """One row a document of the mixture with how often it is taken, at most ``max_repeats`` times.

    Sources are compared in one spelling. Documents of a null source or of one without target aren't taken. No documents, or no
    target that has documents: an empty mixture. Counts are stored once, for the sums and the choice both need them.
    """
    counted = cut(token_counts(documents, vocabulary))
    shares, repeats = _targets(targets)
    sums = _sums(counted.where(F.col("source").isin(list(shares))))
    draw = plan(sums, shares, repeats, budget).draw
    return realised(counted, draw, sums) if draw else documents.sparkSession.createDataFrame([], EMPTY)


def shares(documents: DataFrame, targets: DataFrame, budget: int | None = None, vocabulary: str | None = None) -> DataFrame:
    """``REPORT``: per target source the tokens there are, the exponent and the share planned, what was drawn, and the actual share of all tokens drawn."""
    return _report(documents, targets, vocabulary, lambda sums, wanted, repeats: plan(sums, wanted, repeats, budget))


def temperature_shares(documents: DataFrame, targets: DataFrame, budget: int | None = None, vocabulary: str | None = None) -> DataFrame:
    """``REPORT`` of the mixture by temperature alone (``tempered_plan``): natural shares of the sources with a target, tempered to the entropy of the target shares."""
    return _report(documents, targets, vocabulary, lambda sums, wanted, repeats: tempered_plan({s: n for s, n in sums.items() if s in wanted}, repeats, entropy(powered(wanted, 1.0)), budget))


def _report(documents: DataFrame, targets: DataFrame, vocabulary: str | None, planner: Callable[[dict, dict, dict], Plan]) -> DataFrame:
    counted = cut(token_counts(documents, vocabulary))
    wanted, repeats = _targets(targets)
    spark = documents.sparkSession
    if not wanted:
        return spark.createDataFrame([], REPORT)
    sums = _sums(counted.where(F.col("source").isin(list(wanted))))
    made = planner(sums, wanted, repeats)
    mixed = realised(counted, made.draw, sums) if made.draw else spark.createDataFrame([], EMPTY)
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("drawn"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("repeats"))
    rows = [(s, float(wanted[s]), int(repeats[s]), sums.get(s, 0), made.exponent, float(made.shares.get(s, 0.0))) for s in wanted]
    listed = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, available bigint, exponent double, planned_share double")
    both = listed.join(got, "source", "left").fillna(0, ["drawn", "documents", "repeats"])
    total = F.sum("drawn").over(Window.partitionBy(F.lit(0)))  # over at most MOST_SOURCES rows
    return both.withColumn("actual_share", F.when(total > 0, F.col("drawn") / total).otherwise(0.0)).select(*(x.split()[0] for x in REPORT.split(", ")))
