"""Queries of the problems on texts and duplicate groups over their whole tables, and the SQL that must give the same rows."""

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import consensus, langid, leaks, mixing


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return consensus.candle_survivors(_t(spark, d, "quarantine")).select("group_id", "field_name", "row_id")


def p2_consensus(spark: SparkSession, d: str) -> DataFrame:
    """The same groups with graded weights: what most of the weight agrees on, token by token."""
    return consensus.candle_survivors(_t(spark, d, "quarantine"), graded=True)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.corrections(_t(spark, d, "documents")).select("doc_id", "first_cue", "last_cue", "lang")


def p10_languages(spark: SparkSession, d: str) -> DataFrame:
    """Every text and stretch with its language, confidence and the label it came with."""
    return langid.assigned(_t(spark, d, "documents"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is taken."""
    return mixing.mixture(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares."""
    return mixing.shares(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p9_temperature(spark: SparkSession, d: str) -> DataFrame:
    """The mixture by temperature alone: token shares raised to the exponent at which they have the entropy of the targets, drawn as far as the repetition limits allow."""
    return mixing.temperature_shares(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))


QUERIES = {f.__name__: f for f in (p2_found, p2_consensus, p8_found, p9_mixture, p9_shares, p9_temperature, p10_found, p10_languages)}
_VALUE = lambda f: f"CASE WHEN lower(trim(json_extract_string(r, '$.{f}'))) NOT IN ('', '-', 'null', 'nan', 'none', 'n/a', 'na') THEN json_extract_string(r, '$.{f}') END"
_FIELDS = ", ".join(f'{_VALUE(f)} AS "{f}"' for f in consensus.FIELDS)
_WRITTEN = " || '|' || ".join(f"coalesce(\"{f}\", '')" for f in consensus.FIELDS)
_STATED = " UNION ALL ".join(f"SELECT k, row_id, intact, at_us, node, '{f}' AS field_name FROM c WHERE \"{f}\" IS NOT NULL" for f in consensus.FIELDS)
_INSTANT = lambda c: f"CASE WHEN regexp_matches({c}, '^-?[0-9]+$') THEN TRY_CAST({c} AS BIGINT) * 1000 ELSE epoch_us(TRY_CAST({c} AS TIMESTAMPTZ)) END"

ORACLES = {
    "p2_found": f"""
WITH e AS (SELECT logical_key AS l, unnest(rows) AS r FROM quarantine WHERE tier = 'candle'),
x AS (SELECT lower(trim(l[1])) || ' ' || CASE WHEN contains(l[2], '_') THEN upper(split_part(trim(l[2]), '_', 2) || '-' || split_part(trim(l[2]), '_', 1)) ELSE upper(trim(l[2])) END
             || ' ' || CASE l[3] WHEN '1m' THEN 60 WHEN '60s' THEN 60 WHEN '1min' THEN 60 WHEN '5m' THEN 300 WHEN '5min' THEN 300 WHEN '300s' THEN 300 ELSE 3600 END || ' ' || {_INSTANT("l[4]")} AS k,
             CAST(json_extract_string(r, '$.row_id') AS BIGINT) AS row_id, json_extract_string(r, '$.node_id') AS node, json_extract_string(r, '$.data_hash') AS h,
             json_extract_string(r, '$.source_ingested_at') AS t, {_FIELDS} FROM e),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, row_id) AS n FROM x) WHERE n = 1),
c AS (SELECT *, coalesce(lower(trim(h)) = left(sha256({_WRITTEN}), 32), FALSE) AS intact, {_INSTANT("t")} AS at_us FROM d),
g AS (SELECT k, min(row_id) AS group_id FROM c GROUP BY k HAVING count(*) > 1),
s AS ({_STATED}),
w AS (SELECT *, row_number() OVER (PARTITION BY k, field_name ORDER BY intact DESC, at_us DESC NULLS LAST, node, row_id) AS n FROM s)
SELECT group_id, field_name, row_id FROM w JOIN g USING (k) WHERE n = 1""",
}
