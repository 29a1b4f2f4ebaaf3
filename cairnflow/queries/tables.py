"""Queries that exercise sources and sinks: open JSON, documents, summaries, status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as rel
from ..sources import sinks
from .registry import query, read


@query("SELECT count(*) AS files, count(*) FILTER (WHERE NOT json_valid(body)) AS corrupt FROM (SELECT CASE WHEN event_id % 11 = 0 THEN substr(props, 1, 3) ELSE props END AS body FROM events)")
def q_bad_json_count(spark, d):
    body = F.when(F.col("event_id") % 11 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    e = read(spark, d, "events").select(F.try_parse_json(body).isNull().alias("bad"))
    return e.agg(F.count(F.lit(1)).alias("files"), F.count_if("bad").alias("corrupt"))


@query("SELECT p_partkey, coalesce(c.color, 'grey') AS color FROM part LEFT JOIN (VALUES (1, 'red'), (7, 'green'), (33, 'blue')) c(k, color) ON p_size = c.k")
def q_lookup_default(spark, d):
    colors = spark.createDataFrame([(1, "red"), (7, "green"), (33, "blue")], "p_size int, color string")
    return read(spark, d, "part").join(F.broadcast(colors), "p_size", "left").select("p_partkey", F.coalesce("color", F.lit("grey")).alias("color"))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, '{\"name\":\"' || n_name || '\",\"region\":' || n_regionkey || '}' AS doc FROM nation")
def q_struct_to_json_col(spark, d):
    n = read(spark, d, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("doc"))


@query("SELECT r_name, string_agg('- [' || n_name || '](#' || lower(n_name) || ')', chr(10) ORDER BY n_name) AS lines, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def q_markdown_lines(spark, d):
    n = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    line = F.format_string("- [%s](#%s)", "n_name", F.lower("n_name"))
    return sinks.markdown_lists(n.withColumn("line", line), "r_name", "n_name", "line")


@query("""WITH s AS (SELECT s_nationkey, '[' || string_agg('{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}', ',' ORDER BY s_suppkey, s_name) || ']' AS j FROM supplier GROUP BY 1),
n AS (SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"' || coalesce(',"suppliers":' || j, '') || '}', ',' ORDER BY n_nationkey, n_name) || ']' AS j FROM nation LEFT JOIN s ON s_nationkey = n_nationkey GROUP BY 1)
SELECT r_regionkey, '{"r_name":"' || r_name || '"' || coalesce(',"nations":' || j, '') || '}' AS doc FROM region LEFT JOIN n ON n_regionkey = r_regionkey""")
def q_nested_document(spark, d):
    """region > nation > suppliers as one JSON document per region."""
    s = read(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("suppliers"))
    n = read(spark, d, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    n = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "suppliers"))).alias("nations"))
    r = read(spark, d, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return r.select("r_regionkey", F.to_json(F.struct("r_name", "nations")).alias("doc"))


@query("SELECT s_nationkey::BIGINT AS k, 'supplier' AS src FROM (SELECT DISTINCT s_nationkey FROM supplier WHERE s_nationkey < 9) UNION ALL SELECT c_nationkey, 'customer' FROM (SELECT DISTINCT c_nationkey FROM customer) WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey < 9)")
def q_upsert_if_absent(spark, d):
    s = read(spark, d, "supplier").where("s_nationkey < 9").select(F.col("s_nationkey").cast("long").alias("k"), F.lit("supplier").alias("src")).distinct()
    c = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("k"), F.lit("customer").alias("src"))
    return rel.upsert_if_absent(s, c, ["k"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'skipped' WHEN o_orderkey % 7 = 0 THEN 'failed' ELSE 'generated' END AS status, CASE WHEN o_orderkey % 50 <> 0 AND o_orderkey % 7 = 0 THEN 'ValueError: seven' ELSE '' END AS error FROM orders")
def q_try_status(spark, d):
    """A Python callback per row with its failures kept as data."""

    def runner(row: dict) -> None:
        if row["o_orderkey"] % 50 == 0:
            raise sinks.Skip()
        if row["o_orderkey"] % 7 == 0:
            raise ValueError("seven")

    return sinks.run_each(read(spark, d, "orders").select("o_orderkey"), runner)
