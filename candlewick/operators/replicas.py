"""Deduplication of what redundant collectors delivered, and the records that disagree."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import hashing

# The name that stands for no node (it sorts after every node), and the columns by which two rows are one logical record.
NO_NODE = "zzz_DEFAULT"
TICK_KEY = ("exchange", "symbol", "ts_utc", "price", "quantity", "side")
ORDERBOOK_KEY = ("exchange", "symbol", "ts_utc", "event_type", "side", "level", "price", "quantity")
CANDLE_KEY = ("exchange", "symbol", "timeframe", "ts_utc")


def node_priority(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NO_NODE))


def several_nodes(rows: DataFrame) -> bool:
    """Whether the rows come from two nodes or more; those of one node are kept as they are, repeated or not."""
    return rows.select(node_priority(F.col("node_id")).alias("n")).distinct().limit(2).count() > 1


def latest(rows: DataFrame, key: Sequence[str], newest: str, prefer: Sequence[Column]) -> DataFrame:
    """One row a key: the greatest ``newest`` (null is least), then the least of ``prefer``. Reduced before the shuffle."""
    order = F.struct(F.col(newest).isNull().alias("n"), (-F.unix_micros(newest)).alias("t"), *(p.alias(f"p{i}") for i, p in enumerate(prefer)), F.struct(*rows.columns).alias("r"))
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in key)).agg(F.min(order).alias("w")).select("w.r.*")


def candles(rows: DataFrame, newest: str = "source_ingested_at", node: str = "node_id") -> DataFrame:
    return latest(rows, CANDLE_KEY, newest, [node_priority(F.col(node))])


def _walked(rows: DataFrame, key: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One row a (key, node, raw_json), the first by ``order`` with columns ``carry`` in ``r`` and ``n`` copies, in the order of the walk: (_k..., node, raw, o, n, r, kept, before).

    ``kept`` is the key's row in the end, ``before`` what was kept until this row (null for the first). A kept row gives way to the first later one whose payload differs, neither being null, and
    whose node is lower; so it changes at most as often as there are nodes, and each change is a minimum over the key's rows: no key's rows are collected, and Spark's windows spill.
    """
    node = node_priority(F.col("node_id"))
    n_nodes = rows.select(node.alias("n")).distinct().count()
    own = F.struct(*carry) if carry else F.lit(None).cast("struct<x:int>")
    once = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), node.alias("node"), F.col("raw_json").alias("raw")).agg(F.min(F.struct(F.struct(*order).alias("o"), own.alias("r"))).alias("x"), F.count(F.lit(1)).alias("n"))
    keys = [f"_k{i}" for i in range(len(key))]
    whole, along = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("o", "node", "raw")
    it = F.struct("o", "node", "raw", "r")
    walked = once.select(*keys, "node", "raw", F.col("x.o").alias("o"), F.col("x.r").alias("r"), "n").withColumn("_c0", F.first(it).over(along))
    place = lambda c: F.struct(c["o"].alias("o"), c["node"].alias("node"), c["raw"].alias("raw"))
    steps = max(n_nodes, 1)
    for i in range(1, steps):
        last = F.coalesce(*(F.col(f"_c{j}") for j in range(i - 1, -1, -1)))
        wins = (F.col("node") < last["node"]) & F.col("raw").isNotNull() & last["raw"].isNotNull() & (F.col("raw") != last["raw"]) & (F.struct("o", "node", "raw") > place(last))
        walked = walked.withColumn(f"_c{i}", F.min(F.when(wins, it)).over(whole))
    chain = [F.col(f"_c{i}") for i in range(steps)]
    before = F.coalesce(*(F.when(place(c) < F.struct("o", "node", "raw"), c) for c in reversed(chain)))
    return walked.select(*keys, "node", "raw", "o", "n", "r", F.coalesce(*reversed(chain)).alias("kept"), before.alias("before"))


def _conflict() -> Column:
    return F.coalesce(F.col("before.raw").isNotNull() & F.col("raw").isNotNull() & (F.col("before.raw") != F.col("raw")), F.lit(False))


def folded(rows: DataFrame, key: Sequence[str], tie: str) -> DataFrame:
    """Rows of ``key`` seen by several nodes: (key..., kept node and raw_json, n_skipped, n_conflicts).

    Nodes are taken in arrival order (``tie``). A copy whose raw_json equals the kept one, or one of which is null, is skipped; a differing
    one is a conflict, after which the row of the lower node is kept. Copies of a node with one payload are reduced before the shuffle. Null key parts are values.
    """
    w = _walked(rows, key, [tie], ())
    keys = [f"_k{i}" for i in range(len(key))]
    first, clash = F.col("before").isNull(), _conflict()
    skipped = F.when(first | clash, F.col("n") - 1).otherwise(F.col("n"))
    got = w.groupBy(*keys).agg(F.first("kept").alias("kept"), F.sum(skipped).alias("n_skipped"), F.count(F.when(clash, 1)).alias("n_conflicts"))
    return got.select(*(F.col(k).alias(n) for k, n in zip(keys, key, strict=True)), F.col("kept.node").alias("node_id"), F.col("kept.raw").alias("raw_json"), "n_skipped", "n_conflicts")


def reduced(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with one kept of each key, by the rules of ``folded``; all columns of the kept row."""
    w = _walked(rows, key, order, rows.columns)
    return w.where(F.struct("o", "node", "raw").eqNullSafe(F.struct("kept.o", "kept.node", "kept.raw"))).select("r.*")


def conflicting(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(key..., kept, other): the pairs that ``folded`` counts as conflicts, as structs of whole rows: what was kept until then and what differed from it."""
    w = _walked(rows, key, order, rows.columns).where(_conflict())
    return w.select(*(F.col(f"_k{i}").alias(k) for i, k in enumerate(key)), F.col("before.r").alias("kept"), F.col("r").alias("other"))


def classified_metadata(rows: DataFrame) -> DataFrame:
    """(exchange, symbol, fetched_at, data_hash, outcome): the first of each key is ``written``, one with its hash ``skipped``, another ``quarantined``."""
    key = ["exchange", "symbol", "fetched_date"]
    first = rows.groupBy(*key).agg(F.min(F.struct("fetched_at", "data_hash")).alias("first"))
    n = rows.groupBy(*key, "fetched_at", "data_hash").agg(F.count(F.lit(1)).alias("copies"))
    both = n.join(first, key)
    is_first = (F.col("fetched_at") == F.col("first.fetched_at")) & (F.col("data_hash") == F.col("first.data_hash"))
    return both.select(*key, "fetched_at", "data_hash", "copies", F.when(is_first, "written").when(F.col("data_hash") == F.col("first.data_hash"), "skipped").otherwise("quarantined").alias("outcome"))


def folded_v11(rows: DataFrame, tie: str, body: Sequence[str] = TICK_KEY) -> DataFrame:
    """tick.v1.1 deliveries of each body: (body..., kept, n_skipped, n_conflicts), ``kept`` being structs (node_id, payload_hash, ingest_seq).

    In order of ``tie``: a delivery with body, hash and sequence of a kept one is skipped. One whose hash differs from that of a kept one (both known)
    is a conflict: of the two the lower node stays, and later deliveries are compared with it alone. Any other is a tick of its own. Equal deliveries
    of one node are reduced before the fold, so a group has a few structs a node.
    """
    once = rows.groupBy(*body, node_priority(F.col("node_id")).alias("node"), F.col("payload_hash").alias("hash"), F.col("ingest_seq").alias("seq")).agg(F.min(tie).alias("tie"), F.count(F.lit(1)).alias("n"))
    group = once.groupBy(*body).agg(F.array_sort(F.collect_list(F.struct("tie", "node", "hash", "seq", "n"))).alias("g"))
    one = lambda x: F.struct(x["node"].alias("node_id"), x["hash"].alias("payload_hash"), x["seq"].alias("ingest_seq"))
    first = F.col("g")[0]
    start = F.struct(F.array(one(first)).alias("kept"), F.array(one(first)).alias("compared"), (first["n"] - 1).alias("skipped"), F.lit(0).cast("bigint").alias("conflicts"))

    def step(a: Column, x: Column) -> Column:
        new = F.array(one(x))
        same = F.exists(a["kept"], lambda k: k["payload_hash"].eqNullSafe(x["hash"]) & k["ingest_seq"].eqNullSafe(x["seq"]))
        against = F.filter(a["compared"], lambda k: k["payload_hash"].isNotNull() & x["hash"].isNotNull() & (k["payload_hash"] != x["hash"]))
        clash = ~same & (F.size(against) > 0)
        wins = clash & (x["node"] < F.get(against, F.lit(0))["node_id"])
        own = ~same & ~clash
        without = F.filter(a["kept"], lambda k: ~k.eqNullSafe(F.get(against, F.lit(0))))
        return F.struct(
            F.when(wins, F.concat(without, new)).when(own, F.concat(a["kept"], new)).otherwise(a["kept"]).alias("kept"),
            F.when(wins, new).when(own, F.concat(a["compared"], new)).otherwise(a["compared"]).alias("compared"),
            (a["skipped"] + F.when(same, x["n"]).otherwise(x["n"] - 1)).alias("skipped"),
            (a["conflicts"] + F.when(clash, 1).otherwise(0)).cast("bigint").alias("conflicts"),
        )

    f = F.aggregate(F.slice("g", 2, F.greatest(F.size("g") - 1, F.lit(0))), start, step)
    return group.select(*body, f.alias("f")).select(*body, "f.kept", F.col("f.skipped").alias("n_skipped"), F.col("f.conflicts").alias("n_conflicts"))


def duplicate_status(candles: DataFrame, key: Sequence[str] = CANDLE_KEY, tie: str = "candle_id", digest: Column | None = None) -> DataFrame:
    """(``tie``, status) of each row against the first of its key by ``tie``: ``UNIQUE`` (the first), ``SAME_HASH`` or ``HASH_CONFLICT``, by ``digest`` (the candle hash by default). Null key parts are values."""
    c = candles.select(F.col(tie), *key, (hashing.candle_hash() if digest is None else digest).alias("_h"))
    first = c.groupBy(*key).agg(F.min(F.struct(tie, "_h")).alias("_f")).withColumnsRenamed({k: f"_k_{k}" for k in key})
    met = F.lit(True)
    for k in key:
        met = met & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return c.join(first, met).select(tie, F.when(F.col(tie) == F.col(f"_f.{tie}"), "UNIQUE").when(F.col("_h").eqNullSafe(F.col("_f._h")), "SAME_HASH").otherwise("HASH_CONFLICT").alias("status"))
