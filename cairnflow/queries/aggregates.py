"""Aggregations, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import relational as rel
from ..operators import spatial
from ..plans import building, doors, group
from .registry import PLANE, milli, plane, query, read



def _n():
    return F.count(F.lit(1)).alias("n")


@query("SELECT coalesce(s.k, c.o_orderstatus) AS status, coalesce(c.n, 0)::BIGINT AS n FROM (VALUES ('F'), ('O'), ('X')) s(k) FULL JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) c ON s.k = c.o_orderstatus")
def q_status_summary(spark, d):
    return rel.status_summary(read(spark, d, "orders").select(F.col("o_orderstatus").alias("status")), "status", ["F", "O", "X"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def q_count_by(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(_n()).orderBy("event_type")


@query(f"WITH {PLANE}, g AS (SELECT label, avg(x) AS ax, max(CASE WHEN vec_id % 10 = 0 THEN x END) AS own FROM p WHERE vec_id % 100 < 60 GROUP BY label) SELECT l.label, round(coalesce(g.own, g.ax, 0) * 1000)::BIGINT AS ox FROM (SELECT DISTINCT label FROM p) l LEFT JOIN g ON l.label = g.label")
def q_avg_with_override(spark, d):
    p = plane(spark, d)
    g = p.where("vec_id % 100 < 60").groupBy("label").agg(F.avg("x").alias("ax"), F.max(F.when(F.col("vec_id") % 10 == 0, F.col("x"))).alias("own"))
    return p.select("label").distinct().join(g, "label", "left").select("label", milli(F.coalesce("own", "ax", F.lit(0.0))).alias("ox"))


@query(f"WITH {PLANE} SELECT label, round(min(x) * 1000)::BIGINT AS x0, round(max(x) * 1000)::BIGINT AS x1, round(greatest(2.0, max(x) - min(x) + 0.5) * 1000)::BIGINT AS sx, round(greatest(2.0, max(z) - min(z) + 0.5) * 1000)::BIGINT AS sz FROM p GROUP BY label")
def q_bbox_agg(spark, d):
    size = lambda c: milli(F.greatest(F.lit(2.0), F.max(c) - F.min(c) + 0.5))
    return plane(spark, d).groupBy("label").agg(milli(F.min("x")).alias("x0"), milli(F.max("x")).alias("x1"), size("x").alias("sx"), size("z").alias("sz"))


@query("SELECT s_nationkey::BIGINT AS nation, string_agg(s_name, ',' ORDER BY s_name, s_suppkey) AS names FROM supplier GROUP BY 1")
def q_collect_sorted(spark, d):
    rows = F.array_sort(F.collect_list(F.struct("s_name", "s_suppkey")))
    return read(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("nation")).agg(F.array_join(rows["s_name"], ",").alias("names"))


@query("SELECT p_brand, p_size::BIGINT AS p_size, arg_min(p_partkey, {'n': p_name, 'k': p_partkey}) AS p_partkey FROM part GROUP BY 1, 2")
def q_first_per_group(spark, d):
    p = rel.first_by(read(spark, d, "part").select("p_brand", F.col("p_size").cast("long").alias("p_size"), "p_name", "p_partkey"), ["p_brand", "p_size"], ["p_name", "p_partkey"])
    return p.drop("p_name")


@query("WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c) SELECT user_id, event_type, n FROM r WHERE rn = 1")
def q_mode(spark, d):
    return rel.mode_by(read(spark, d, "events"), ["user_id"], "event_type")


@query("""SELECT l_suppkey, count(*) AS n, round(avg(l_quantity) * 1000)::BIGINT AS mean, array_to_string(list_sort(list_distinct(list(l_partkey)))[1:25], ',') AS parts, CASE WHEN count(*) >= 620 THEN 'high' WHEN count(*) >= 590 THEN 'medium' ELSE 'low' END AS confidence FROM lineitem GROUP BY 1""")
def q_cluster_summary(spark, d):
    n = F.count(F.lit(1))
    conf = F.when(n >= 620, "high").when(n >= 590, "medium").otherwise("low")
    parts = F.array_join(F.slice(F.sort_array(F.collect_set("l_partkey")), 1, 25).cast("array<string>"), ",")
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(n.alias("n"), milli(F.avg("l_quantity")).alias("mean"), parts.alias("parts"), conf.alias("confidence"))


@query(f"WITH {PLANE}, k AS (SELECT a.vec_id, b.vec_id AS comp, row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt((b.x - a.x)^2 + (b.z - a.z)^2), b.vec_id) AS rn FROM p a, p b WHERE b.vec_id % 50 = 0) SELECT comp, count(*) AS n FROM k WHERE rn = 1 GROUP BY 1")
def q_nearest_counts(spark, d):
    p = plane(spark, d).drop("label")
    right = p.where("vec_id % 50 = 0").select(F.col("vec_id").alias("comp"), F.col("x").alias("cx"), F.col("z").alias("cz"))
    return spatial.nearest_one(p, right, "vec_id", "comp", "x", "z", "cx", "cz", 4.0).groupBy("comp").agg(_n())


@query("WITH r AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice) - 1 AS i, count(*) OVER () AS n FROM orders) SELECT 'p50' AS q, o_totalprice AS value FROM r WHERE i = floor(n * 0.5) UNION ALL SELECT 'p90', o_totalprice FROM r WHERE i = floor(n * 0.9)")
def q_index_percentile(spark, d):
    at = rel.index_percentiles(read(spark, d, "orders"), "o_totalprice", [0.5, 0.9])
    return at.select(F.when(F.col("q") == 0.5, "p50").otherwise("p90").alias("q"), F.col("o_totalprice").alias("value"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS used, count(*) FILTER (WHERE l_returnflag = 'A' AND l_tax > 0.04) AS rejected, count(DISTINCT l_suppkey) AS sources FROM lineitem")
def q_lineage_counts(spark, d):
    return read(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("l_returnflag") == "R").alias("used"), F.count_if((F.col("l_returnflag") == "A") & (F.col("l_tax") > 0.04)).alias("rejected"), F.countDistinct("l_suppkey").alias("sources"))


_PRIO = "CASE l_linestatus || l_returnflag WHEN 'OR' THEN 3 WHEN 'FR' THEN 2 WHEN 'OA' THEN 2 ELSE 1 END"


@query(f"""WITH e AS (SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, l_linestatus || l_returnflag AS class, {_PRIO} AS prio, l_orderkey * 100 + l_linenumber AS ord FROM lineitem WHERE l_partkey <> l_suppkey),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY prio DESC, ord, class) AS rn FROM e) SELECT a, b, class FROM r WHERE rn = 1""")
def q_max_by_priority(spark, d):
    li = read(spark, d, "lineitem").where("l_partkey <> l_suppkey")
    a, b = rel.undirected(F.col("l_partkey"), F.col("l_suppkey"))
    e = li.select(a.alias("a"), b.alias("b"), F.concat("l_linestatus", "l_returnflag").alias("class"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ord"))
    prio = F.when(F.col("class") == "OR", 3).when(F.col("class").isin("FR", "OA"), 2).otherwise(1)
    return rel.first_by(e.withColumn("prio", prio), ["a", "b"], [F.desc("prio"), "ord", "class"]).select("a", "b", "class")


@query("SELECT node, round(avg(v) * 1000)::BIGINT AS mean, count(*) AS visits FROM (SELECT l_partkey AS node, l_quantity AS v FROM lineitem UNION ALL SELECT l_suppkey, l_quantity FROM lineitem) GROUP BY 1")
def q_mean_of_visits(spark, d):
    ends = read(spark, d, "lineitem").select(F.explode(F.array("l_partkey", "l_suppkey")).alias("node"), "l_quantity")
    return ends.groupBy("node").agg(milli(F.avg("l_quantity")).alias("mean"), F.count(F.lit(1)).alias("visits"))


@query("SELECT count(*) AS orders, round(sum(o_totalprice) / 1000)::BIGINT AS thousands, count(DISTINCT o_custkey) AS customers FROM orders")
def q_totals(spark, d):
    return read(spark, d, "orders").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice") / 1000).cast("long").alias("thousands"), F.countDistinct("o_custkey").alias("customers"))


@query(f"WITH {PLANE} SELECT vec_id // 4 AS ring, round(avg(x) * 1000)::BIGINT AS cx, round(avg(z) * 1000)::BIGINT AS cz, least(3, count(DISTINCT label)) AS height FROM p GROUP BY 1")
def q_vertex_centroid(spark, d):
    g = plane(spark, d).groupBy(F.floor(F.col("vec_id") / 4).alias("ring"))
    return g.agg(milli(F.avg("x")).alias("cx"), milli(F.avg("z")).alias("cz"), F.least(F.lit(3), F.countDistinct("label")).cast("long").alias("height"))


@query("SELECT p_brand, p_partkey, coalesce(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_vertex FROM part")
def q_offset_concat(spark, d):
    from ..operators import mesh

    return mesh.offset_concat(read(spark, d, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], ["p_partkey"], "p_size").drop("p_size")


@query(f"""WITH {PLANE}, c AS (SELECT *, unnest(range(floor(x / 0.5)::BIGINT, floor((x + 1.7) / 0.5)::BIGINT + 1)) AS cx FROM p), k AS (SELECT *, unnest(range(floor(z / 0.5)::BIGINT, floor((z + 1.2) / 0.5)::BIGINT + 1)) AS cz FROM c)
SELECT DISTINCT label, cx, cz FROM k WHERE greatest(0, least(x + 1.7, (cx + 1) * 0.5) - greatest(x, cx * 0.5)) * greatest(0, least(z + 1.2, (cz + 1) * 0.5) - greatest(z, cz * 0.5)) >= 0.02 * 0.25""")
def q_raster_union(spark, d):
    p = plane(spark, d).select("label", "x", "z", (F.col("x") + 1.7).alias("x2"), (F.col("z") + 1.2).alias("z2"))
    return spatial.raster_union(p, ["label"], "x", "z", "x2", "z2", 0.5)


# --- order and top-k ---


@query("SELECT c_mktsegment, c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) - 1 AS place FROM customer")
def q_total_order(spark, d):
    c = read(spark, d, "customer").select("c_mktsegment", "c_acctbal", "c_custkey")
    return rel.global_row_number(c, ["c_mktsegment", F.desc("c_acctbal"), "c_custkey"], "place").drop("c_acctbal")


@query("SELECT * FROM (SELECT c_nationkey::BIGINT AS nation, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 5")
def q_topk_per_group(spark, d):
    c = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey", "c_acctbal")
    return rel.top_k(c, ["nation"], [F.desc("c_acctbal"), "c_custkey"], 5).select("nation", "c_custkey", F.col("rank").cast("long").alias("rank"))


@query("WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS rn FROM orders) SELECT o_custkey, o_orderkey FROM r WHERE rn = 1")
def q_argmax_struct(spark, d):
    best = F.min_by("o_orderkey", F.struct(F.col("o_orderpriority"), -F.col("o_totalprice"), F.col("o_orderkey")))
    return read(spark, d, "orders").groupBy("o_custkey").agg(best.alias("o_orderkey"))


@query("WITH r AS (SELECT l_suppkey, l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_discount, -l_quantity, -l_extendedprice, l_orderkey, l_partkey) AS rn FROM lineitem) SELECT l_suppkey, l_orderkey, l_partkey FROM r WHERE rn = 1")
def q_argmin_struct(spark, d):
    pick = F.struct("l_orderkey", "l_partkey")
    by = F.struct(F.col("l_discount"), -F.col("l_quantity"), -F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_partkey"))
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.min_by(pick, by).alias("b")).select("l_suppkey", "b.*")


@query("SELECT l_suppkey, count(*) AS support FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY support DESC, l_suppkey LIMIT 20")
def q_report_topk(spark, d):
    return read(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("support")).orderBy(F.desc("support"), "l_suppkey").limit(20)


# --- sets ---


@query("SELECT 'c:' || c_name AS note, c_nationkey::BIGINT AS nation FROM customer UNION ALL SELECT 's:' || s_name, s_nationkey FROM supplier")
def q_union_all(spark, d):
    part = lambda t, p: read(spark, d, t).select(F.concat(F.lit(f"{p}:"), F.col(f"{p}_name")).alias("note"), F.col(f"{p}_nationkey").cast("long").alias("nation"))
    return part("customer", "c").unionByName(part("supplier", "s"))


@query("""WITH u AS (SELECT 0 AS r, l_partkey AS a, l_suppkey AS b, l_orderkey AS o FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT 1, l_partkey, l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT 1, l_suppkey, l_partkey, l_orderkey FROM lineitem WHERE l_returnflag = 'A'),
k AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY r, o) AS rn FROM u) SELECT a, b, r::BIGINT AS src, o FROM k WHERE rn = 1""")
def q_first_writer_distinct(spark, d):
    li = read(spark, d, "lineitem")
    one = lambda flag, a, b: li.where(F.col("l_returnflag") == flag).select(F.col(a).alias("a"), F.col(b).alias("b"), F.col("l_orderkey").alias("o"))
    second = one("A", "l_partkey", "l_suppkey").unionByName(one("A", "l_suppkey", "l_partkey"))
    return rel.first_writer_distinct([one("R", "l_partkey", "l_suppkey"), second], ["a", "b"], ["o"]).select("a", "b", F.col("source_rank").cast("long").alias("src"), "o")


@query("""WITH e AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS lo, greatest(l_partkey, l_suppkey) AS hi FROM lineitem WHERE l_returnflag = 'R'),
n AS (SELECT l_suppkey AS a, l_partkey AS b, l_orderkey AS o, least(l_partkey, l_suppkey) AS lo, greatest(l_partkey, l_suppkey) AS hi FROM lineitem WHERE l_returnflag = 'N'),
k AS (SELECT *, row_number() OVER (PARTITION BY lo, hi ORDER BY o, a) AS rn FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.lo = n.lo AND e.hi = n.hi)) SELECT a, b, o FROM k WHERE rn = 1""")
def q_undirected_insert(spark, d):
    li = read(spark, d, "lineitem")
    old = li.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    new = li.where("l_returnflag = 'N'").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.col("l_orderkey").alias("o"))
    return rel.insert_undirected(old, new, "a", "b", ["o", "a"])


@query(f"""WITH RECURSIVE {PLANE}, o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM p),
w AS (SELECT label, i, vec_id, x, z, [{{'x': x, 'z': z}}] AS kept, true AS stays FROM o WHERE i = 1
 UNION ALL SELECT label, i, vec_id, x, z, CASE WHEN free THEN list_append(kept, {{'x': x, 'z': z}}) ELSE kept END, free FROM (SELECT o.*, w.kept, len(list_filter(w.kept, lambda k: sqrt((k.x - o.x)^2 + (k.z - o.z)^2) <= 3.0)) = 0 AS free FROM w JOIN o ON o.label = w.label AND o.i = w.i + 1))
SELECT vec_id, x, z, label FROM w WHERE stays""")
def q_greedy_distinct(spark, d):
    return spatial.greedy_distinct(plane(spark, d), ["label"], ["vec_id"], "x", "z", 3.0)


@query("SELECT c_nationkey::BIGINT AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0")
def q_set_difference(spark, d):
    c = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("k")).distinct()
    return c.join(read(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_nationkey").cast("long").alias("k")), "k", "left_anti")


@query("WITH a AS (SELECT p_partkey, lower(p_type) AS alias, p_brand, lag(p_brand) OVER (PARTITION BY lower(p_type) ORDER BY p_partkey) AS seen FROM part) SELECT p_partkey, alias, seen FROM a WHERE seen IS NOT NULL AND seen <> p_brand")
def q_alias_collision(spark, d):
    w = Window.partitionBy("alias").orderBy("p_partkey")
    a = read(spark, d, "part").select("p_partkey", F.lower("p_type").alias("alias"), "p_brand").withColumn("seen", F.lag("p_brand").over(w))
    return a.where("seen is not null and seen <> p_brand").drop("p_brand")


# --- validation and gates ---


@query("""SELECT 'error' AS severity, 'no total' AS code, o_orderkey AS subject FROM orders WHERE o_totalprice < 2000 UNION ALL SELECT 'error', 'no customer', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'warning', 'odd status', o_orderkey FROM orders WHERE o_orderstatus = 'P'""")
def q_rule_violations(spark, d):
    o = read(spark, d, "orders")
    issue = lambda df, severity, code: df.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col("o_orderkey").alias("subject"))
    good = read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return issue(o.where("o_totalprice < 2000"), "error", "no total").unionByName(issue(o.join(good, "o_custkey", "left_anti"), "error", "no customer")).unionByName(issue(o.where("o_orderstatus = 'P'"), "warning", "odd status"))


@query("SELECT o_orderstatus AS status, count(*) FILTER (WHERE o_totalprice > 400000) > 0 OR count(*) = 0 AS passes FROM orders GROUP BY 1")
def q_gate(spark, d):
    health = read(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") > 400000).alias("routable"))
    return group.gate_table(health, spark.range(1), ["status"]).select("status", "passes")


@query(f"WITH {PLANE}, k AS (SELECT a.vec_id, b.vec_id AS anchor, sqrt((b.x - a.x)^2 + (b.z - a.z)^2) AS dist, row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt((b.x - a.x)^2 + (b.z - a.z)^2), -(b.vec_id % 8), b.vec_id) AS rn FROM p a JOIN p b ON a.vec_id % 2 = 1 AND b.vec_id % 40 = 0) SELECT vec_id, anchor, round(dist * 1000)::BIGINT AS dist FROM k WHERE rn = 1 AND dist <= 10")
def q_relocate(spark, d):
    p = plane(spark, d).select(F.lit("b").alias("building"), F.lit("0").alias("floor_name"), "vec_id", "x", "z")
    _, seen = doors.relocate(p.where("vec_id % 2 = 1").withColumnRenamed("vec_id", "door"), p.where("vec_id % 40 = 0").withColumnRenamed("vec_id", "point"), longest=10.0, start=10.0)
    return seen.where("status = 'ok'").select(F.col("door").alias("vec_id"), F.col("point").alias("anchor"), milli(F.col("distance")).alias("dist"))


@query(f"""WITH {PLANE}, g AS (SELECT label, avg(x) AS cx, avg(z) AS cz, max(x) - min(x) AS sx FROM p GROUP BY label), h AS (SELECT label, avg(x) AS cx, avg(z) AS cz, max(x) - min(x) AS sx FROM p WHERE vec_id % 2 = 0 GROUP BY label)
SELECT g.label, sqrt((g.cx - h.cx)^2 + (g.cz - h.cz)^2) > 1 AS off_centre, g.sx / h.sx NOT BETWEEN 0.55 AND 1.1 AS off_size FROM g JOIN h USING (label)""")
def q_threshold_flags(spark, d):
    p = plane(spark, d)
    box = lambda df: df.groupBy("label").agg(F.avg("x").alias("cx"), F.avg("z").alias("cz"), (F.max("x") - F.min("x")).alias("width"), F.avg("x").alias("ex"), F.avg("z").alias("ez"))
    found = doors.audit(box(p), box(p.where("vec_id % 2 = 0")), "label", centre=1.0, size=(0.55, 1.1), entrance=float("inf"))
    flag = lambda check: F.coalesce(F.bool_or(F.col("check") == check), F.lit(False))
    return p.where("vec_id % 2 = 0").select("label").distinct().join(found, "label", "left").groupBy("label").agg(flag("centre offset").alias("off_centre"), flag("size ratio").alias("off_size"))


@query("""WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END DESC, CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey FROM r WHERE rn = 1""")
def q_best_attempt(spark, d):
    exact, conf = (F.col("l_returnflag") == "R").cast("int"), (F.col("l_linestatus") == "O").cast("int")
    best = rel.first_by(read(spark, d, "lineitem"), ["l_orderkey"], [exact.desc(), conf.desc(), "l_linenumber", "l_partkey", "l_suppkey"])
    return best.select("l_orderkey", "l_partkey", "l_suppkey")


@query("""WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag = 'R' DESC, CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linestatus = 'O' THEN 3 ELSE 1 END DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey FROM r WHERE rn = 1""")
def q_first_exact_attempt(spark, d):
    """Attempts at a door: the first exact crossing, else the most confident."""
    source = F.when(F.col("l_returnflag") == "R", "route_boundary_intersection").otherwise("nearest_boundary_to_route_endpoint")
    tries = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"), source.alias("source"), F.when(F.col("l_linestatus") == "O", "high").otherwise("low").alias("confidence"))
    return doors.best_attempt(tries, "l_orderkey").select("l_orderkey", "l_partkey", "l_suppkey")


@query("""WITH b AS (SELECT 'C' || c_custkey AS id, c_acctbal >= 0 AS placed FROM customer UNION ALL SELECT 'S' || s_suppkey, s_acctbal >= 0 FROM supplier)
SELECT 'error' AS severity, 'missing anchor' AS code, id AS subject FROM b WHERE NOT placed UNION ALL SELECT 'warning', 'no shaft group', 'S' || s_suppkey FROM supplier WHERE s_suppkey % 3 < 2 AND s_suppkey % 5 = 0
UNION ALL SELECT 'warning', 'missing polygon geometry', 'P' || p_partkey FROM part WHERE p_size = 50""")
def q_dataset_issues(spark, d):
    """Rule violations of a dataset: customers as its rooms, suppliers as its portals, some parts as rejected input."""
    at = lambda c: [F.when(F.col(c) >= 0, F.lit(1.0)).alias(n) for n in ("lon", "lat")]
    rooms = read(spark, d, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("external_id"), *at("c_acctbal"))
    kind = F.element_at(F.array(F.lit("stair"), F.lit("elevator"), F.lit("door")), (F.col("s_suppkey") % 3).cast("int") + 1)
    group_id = F.when(F.col("s_suppkey") % 5 == 0, "default").otherwise("G1")
    portals = read(spark, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("external_id"), kind.alias("kind"), group_id.alias("group_id"), *at("s_acctbal"))
    rejects = read(spark, d, "part").where("p_size = 50").select(F.lit("warning").alias("severity"), F.lit("missing polygon geometry").alias("code"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("subject"))
    return building.issues(building.Dataset(spark.createDataFrame([], "floor_name string"), rooms, portals, rejects))
