"""Ordered-sequence operators over events and keyed rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as rel
from .registry import PLANE, milli, plane, query, read

_BY = ["ts", "event_id"]


def _events(spark, d):
    return read(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("long").alias("k"))


_W = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


@query("SELECT p_partkey, p_brand, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) - 1 AS idx FROM part")
def q_dense_index(spark, d):
    p = rel.dense_index(read(spark, d, "part").select("p_partkey", "p_brand", "p_size"), ["p_brand"], ["p_size"], "idx")
    return p.select("p_partkey", "p_brand", F.col("idx").cast("long").alias("idx"))


def chain_links(spark, d):
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("long")
    li = read(spark, d, "lineitem").select("l_suppkey", "l_returnflag", month.alias("month"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return rel.chain_links(li, ["l_suppkey", "l_returnflag"], "month", order, ["l_orderkey", "l_partkey"])


@query("""WITH m AS (SELECT *, (year(l_shipdate) * 12 + month(l_shipdate))::BIGINT AS month FROM lineitem),
f AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag, month ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS rn FROM m),
l AS (SELECT l_suppkey, l_returnflag, month AS from_month, lead(month) OVER w AS to_month, l_orderkey AS from_l_orderkey, lead(l_orderkey) OVER w AS to_l_orderkey, l_partkey AS from_l_partkey, lead(l_partkey) OVER w AS to_l_partkey
 FROM f WHERE rn = 1 WINDOW w AS (PARTITION BY l_suppkey, l_returnflag ORDER BY month)) SELECT * FROM l WHERE to_month IS NOT NULL""")
def q_chain_links(spark, d):
    """Flagship: the first row of every (supplier, flag, month), each linked to the next month that has one."""
    return chain_links(spark, d)


@query("SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) > 1 THEN p_type || '_' || row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) ELSE p_type END AS id FROM part")
def q_dedupe_ids(spark, d):
    rn = F.row_number().over(Window.partitionBy("p_type").orderBy("p_size", "p_partkey"))
    return rel.dedupe_with_suffix(read(spark, d, "part").withColumn("id", F.col("p_type")).withColumn("rn", rn), [], ["p_size", "p_partkey"], "id", F.concat(F.lit("_"), F.col("rn").cast("string"))).select("p_partkey", "id")


@query("""SELECT s_suppkey, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY s_nationkey, s_suppkey) = 1 THEN name
 WHEN contains(name, '_Set') THEN regexp_replace(name, '(_Set.*)$', '_' || substr(md5(s_suppkey::VARCHAR), 1, 8) || '\\1') ELSE name || '_' || substr(md5(s_suppkey::VARCHAR), 1, 8) END AS name
 FROM (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Room' || (s_suppkey % 9) ELSE 'Stairs' || (s_suppkey % 5) || '_Set1' END AS name FROM supplier)""")
def q_dedupe_names(spark, d):
    k = F.col("s_suppkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("Room"), (k % 9).cast("string"))).otherwise(F.concat(F.lit("Stairs"), (k % 5).cast("string"), F.lit("_Set1")))
    s = read(spark, d, "supplier").select(k, "s_nationkey", name.alias("name"))
    tag = F.concat(F.lit("_"), F.substring(F.md5(k.cast("string").cast("binary")), 1, 8))
    rn = F.row_number().over(Window.partitionBy("name").orderBy("s_nationkey", "s_suppkey"))
    put = F.when(F.col("name").contains("_Set"), F.concat(F.substring_index("name", "_Set", 1), tag, F.lit("_Set"), F.expr("substring_index(name, '_Set', -1)"))).otherwise(F.concat("name", tag))
    return s.select("s_suppkey", F.when(rn == 1, F.col("name")).otherwise(put).alias("name"))


@query(f"""WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS ch FROM events {_W}), i AS (SELECT *, sum(ch) OVER w AS island FROM c {_W})
SELECT user_id, island::BIGINT AS island, any_value(event_type) AS event_type, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi FROM i GROUP BY 1, 2 HAVING count(*) >= 2""")
def q_islands(spark, d):
    e = rel.islands(_events(spark, d), ["user_id"], _BY, rel.changed("event_type", ["user_id"], _BY))
    g = e.groupBy("user_id", F.col("island").cast("long").alias("island"))
    return g.agg(F.first("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).where("n >= 2")


@query(f"""WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS ch FROM events {_W}), i AS (SELECT *, sum(ch) OVER w AS island FROM c {_W}),
g AS (SELECT user_id, island, any_value(event_type) AS event_type, count(*) AS n FROM i GROUP BY 1, 2 HAVING count(*) >= 2) SELECT user_id, max(island)::BIGINT AS island, arg_max(event_type, island) AS event_type, arg_max(n, island) AS n FROM g GROUP BY 1""")
def q_last_island(spark, d):
    runs = q_islands(spark, d)
    return runs.groupBy("user_id").agg(F.max("island").alias("island"), F.max_by("event_type", "island").alias("event_type"), F.max_by("n", "island").alias("n"))


@query(f"SELECT user_id, event_id, before, k FROM (SELECT user_id, event_id, (props->>'$.k')::BIGINT AS k, lag((props->>'$.k')::BIGINT) OVER w AS before FROM events {_W}) WHERE before IS NOT NULL AND abs(k - before) > 50")
def q_transitions(spark, d):
    w = Window.partitionBy("user_id").orderBy(*_BY)
    e = _events(spark, d).withColumn("before", F.lag("k").over(w))
    return e.where((F.col("before").isNotNull()) & (F.abs(F.col("k") - F.col("before")) > 50)).select("user_id", "event_id", "before", "k")


@query(f"""WITH f AS (SELECT user_id, event_id, ts, event_type = 'purchase' AS inside, lag(event_type = 'purchase') OVER w AS was FROM events {_W}),
l AS (SELECT user_id, arg_max(inside, {{'t': ts, 'e': event_id}}) AS ends, max(CASE WHEN inside AND NOT was THEN {{'t': ts, 'e': event_id}} END) AS m FROM f GROUP BY 1) SELECT user_id, m.e AS event_id FROM l WHERE ends AND m IS NOT NULL""")
def q_last_transition(spark, d):
    """Only the last outside-to-inside change, and only where the sequence ends inside."""
    w = Window.partitionBy("user_id").orderBy(*_BY)
    inside = F.col("event_type") == "purchase"
    e = _events(spark, d).select("user_id", "event_id", "ts", inside.alias("inside"), F.lag(inside).over(w).alias("was"))
    at = F.struct("ts", "event_id")
    g = e.groupBy("user_id").agg(F.max_by("inside", at).alias("ends"), F.max(F.when(F.col("inside") & ~F.col("was"), at)).alias("m"))
    return g.where("ends and m is not null").select("user_id", F.col("m.event_id").alias("event_id"))


@query(f"SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS b FROM events {_W}) WHERE b IS NULL OR b <> event_type")
def q_consecutive_distinct(spark, d):
    e = _events(spark, d).withColumn("new", rel.changed("event_type", ["user_id"], _BY))
    return e.where("new").select("user_id", "event_id", "event_type")


@query(f"""WITH o AS (SELECT user_id, event_id, ts, event_id // 3 AS step, event_type, (props->>'$.k')::BIGINT AS k FROM events WHERE event_type <> 'view'),
g AS (SELECT *, lag(step) OVER w AS s, lag(k) OVER w AS k1 FROM o {_W})
SELECT user_id, event_id, k1, k, CASE WHEN s = step THEN event_type ELSE 'connector' END AS class FROM g WHERE s IS NOT NULL AND (s = step OR k1 <> k)""")
def q_gap_stitch(spark, d):
    e = _events(spark, d).withColumns({"step": F.floor(F.col("event_id") / 3), "z": F.lit(0)})
    g = rel.gap_stitch(e, ["user_id"], _BY, "step", "event_type", "k", "z", F.col("event_type") == "view")
    return g.select("user_id", "event_id", F.col("x1").alias("k1"), "k", "class")


@query(f"""WITH {PLANE}, r AS (SELECT vec_id // 4 AS ring, vec_id, x, z, row_number() OVER (PARTITION BY vec_id // 4 ORDER BY vec_id) - 1 AS at, count(*) OVER (PARTITION BY vec_id // 4) AS n FROM p)
SELECT a.ring, a.at, round(a.x * 1000)::BIGINT AS ax, round(b.x * 1000)::BIGINT AS bx FROM r a JOIN r b ON a.ring = b.ring AND b.at = (a.at + 1) % a.n WHERE a.n = 4""")
def q_ring_edges(spark, d):
    from ..functions import geo
    from .scalars import _quads

    e = _quads(spark, d).select("ring", F.explode(geo.ring_edges(F.col("pts"))).alias("e"))
    return e.select("ring", F.col("e.at").cast("long").alias("at"), milli(F.col("e.a.x")).alias("ax"), milli(F.col("e.b.x")).alias("bx"))


@query("SELECT s_suppkey, 'MI_' || s_nationkey || '_ELEV_' || lpad((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey))::VARCHAR, 3, '0') AS id FROM supplier")
def q_group_counter(spark, d):
    rn = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    return read(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("MI_"), F.col("s_nationkey").cast("string"), F.lit("_ELEV_"), F.lpad(rn.cast("string"), 3, "0")).alias("id"))


@query("""WITH n AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT c_nationkey::BIGINT AS nation, c_custkey FROM n WHERE i IN (SELECT j * n // 7 FROM range(7) t(j))""")
def q_systematic_sample(spark, d):
    c = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey")
    return rel.systematic_sample(c, ["nation"], ["c_custkey"], 7)


@query(f"""WITH RECURSIVE {PLANE}, o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM p),
w AS (SELECT label, i, vec_id, x AS kx, z AS kz, true AS kept FROM o WHERE i = 1 UNION ALL SELECT label, i, vec_id, CASE WHEN far THEN x ELSE kx END, CASE WHEN far THEN z ELSE kz END, far
 FROM (SELECT o.*, w.kx, w.kz, sqrt((w.kx - o.x)^2 + (w.kz - o.z)^2) >= 4.0 AS far FROM w JOIN o ON o.label = w.label AND o.i = w.i + 1)) SELECT label, vec_id FROM w WHERE kept""")
def q_last_kept_run(spark, d):
    """Same-label runs without points closer than 4 to the last one kept: sequential, so one array per key."""
    pts = F.array_sort(F.collect_list(F.struct("vec_id", "x", "z")))
    g = plane(spark, d).groupBy("label").agg(pts.alias("p"))
    return g.select("label", F.explode(rel.last_kept(F.col("p"), "x", "z", 4.0)).alias("k")).select("label", "k.vec_id")
