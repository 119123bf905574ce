"""Ad-hoc SQL over registered views: one query text, run by Spark as it is and by the oracle as it is.

Sums of floating columns are taken over decimals, so that they don't depend on the order of rows.
"""

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "candles", "exchange_metadata", "orderbook_depth", "embeddings", "documents")
QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_REVENUE = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))"

SQL = {
    "sql_pricing_summary": """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base,
count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""",
    "sql_segment_revenue": f"""SELECT c_mktsegment, o_orderpriority, CAST(sum({_REVENUE}) AS DOUBLE) AS revenue, count(DISTINCT o_orderkey) AS n_orders
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_mktsegment, o_orderpriority""",
    "sql_nation_revenue": f"""SELECT n_name, CAST(sum({_REVENUE}) AS DOUBLE) AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY n_name""",
    "sql_discount_filter": """SELECT count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",
    "sql_rollup": """SELECT r_name, n_name, count(*) AS n_customers, grouping(n_name) AS g FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""",
    "sql_cube": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "sql_grouping_sets": """SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size), ())""",
    "sql_semi_join": """SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
    "sql_anti_join": """SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "sql_outer_join": """SELECT n_name, count(s_suppkey) AS n_suppliers FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name""",
    "sql_full_join": """SELECT coalesce(a.k, b.k) AS k, a.n AS n_customers, b.n AS n_suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey) a
FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY s_nationkey) b ON a.k = b.k""",
    "sql_theta_join": """SELECT a.r_name AS low, b.r_name AS high FROM region a JOIN region b ON a.r_regionkey < b.r_regionkey""",
    "sql_window_rank": """SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) q WHERE rn <= 3""",
    "sql_window_frames": """SELECT event_id, count(*) OVER w AS n, lag(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before, max(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS recent
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "sql_percent": """SELECT event_type, ntile(4) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS quarter, event_id FROM events""",
    "sql_set_operations": """SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 0 INTERSECT SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1""",
    "sql_union_all": """SELECT 'customer' AS kind, c_nationkey AS k, count(*) AS n FROM customer GROUP BY c_nationkey UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY s_nationkey""",
    "sql_correlated": """SELECT p_partkey FROM part p WHERE p_retailprice > (SELECT avg(q.p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)""",
    "sql_having": """SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15""",
    "sql_case_pivot": """SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS n_open, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_filled, sum(CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 1 ELSE 0 END) AS n_other FROM orders GROUP BY o_orderpriority""",
    "sql_recursive": """WITH RECURSIVE n(i) AS (SELECT 1 UNION ALL SELECT i + 1 FROM n WHERE i < 20) SELECT i, count(p_partkey) AS n_parts FROM n LEFT JOIN part ON p_size = i GROUP BY i""",
    "sql_top_k": """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "sql_strings": """SELECT p_partkey, upper(p_name) AS u, length(p_type) AS n, substring(p_brand, 1, 5) AS b, replace(p_name, ' ', '_') AS r, p_type LIKE '%STEEL%' AS steel FROM part""",
    "sql_candle_days": """SELECT exchange, symbol, CAST(date_trunc('day', ts_utc) AS DATE) AS day, count(*) AS n, min(low) AS low, max(high) AS high FROM candles GROUP BY exchange, symbol, CAST(date_trunc('day', ts_utc) AS DATE)""",
    "sql_label_counts": """SELECT label, count(*) AS n FROM embeddings GROUP BY label""",
    "sql_source_sizes": """SELECT source, count(*) AS n, sum(n_chars) AS chars, max(n_chars) AS longest FROM documents GROUP BY source""",
}


def _run(text: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        for t in TABLES:
            if t in text:
                spark.read.parquet(f"{d}/{t}.parquet").createOrReplaceTempView(t)
        return spark.sql(text)

    return run


for _name, _text in SQL.items():
    QUERIES[_name] = _run(_text)
    ORACLES[_name] = _text
