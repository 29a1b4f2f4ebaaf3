"""Joins: keyed, spatial, nearest, fallback and exclusion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import relational as rel
from ..operators import spatial
from ..plans import doors
from .registry import PLANE, milli, plane, query, read

_D = "sqrt((b.x - a.x)^2 + (b.z - a.z)^2)"


@query("""WITH d AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
SELECT c_custkey, c_name, o_orderkey AS last_order FROM customer JOIN d ON c_custkey = o_custkey WHERE rn = 1""")
def q_ordered_inner_join(spark, d):
    last = rel.first_by(read(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], [F.desc("o_orderkey")])
    return read(spark, d, "customer").join(last, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name", F.col("o_orderkey").alias("last_order"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def q_missing_anti_join(spark, d):
    done = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, d, "customer").join(done, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM lineitem c WHERE c.l_returnflag = 'R' AND c.l_partkey = lineitem.l_partkey AND c.l_suppkey = lineitem.l_suppkey)")
def q_cache_miss_anti_join(spark, d):
    li = read(spark, d, "lineitem")
    cache = li.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey")
    return li.select("l_partkey", "l_suppkey").distinct().join(cache, ["l_partkey", "l_suppkey"], "left_anti")


@query("SELECT s_suppkey, s_name, coalesce(n_name, '') AS nation FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) n ON s_nationkey = n_nationkey")
def q_dim_left_join(spark, d):
    n = read(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return read(spark, d, "supplier").join(n, "s_nationkey", "left").select("s_suppkey", "s_name", F.coalesce("n_name", F.lit("")).alias("nation"))


@query("""WITH v AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) rn FROM orders)
SELECT o_custkey, o_orderkey, o_orderpriority FROM v WHERE rn = 1""")
def q_last_wins_dim(spark, d):
    return rel.first_by(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], [F.desc("o_orderkey")])


_KEYS = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 200 END AS k1, o_custkey % 150 AS k2 FROM orders"


@query(f"""WITH o AS ({_KEYS}) SELECT o_orderkey, coalesce(a.s_name, b.s_name) AS name FROM o LEFT JOIN supplier a ON o.k1 = a.s_suppkey LEFT JOIN supplier b ON o.k2 = b.s_suppkey""")
def q_priority_key_join(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderkey") % 200).alias("k1"), (F.col("o_custkey") % 150).alias("k2"))
    s = read(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return rel.priority_join(o, s, [("k1", "s_suppkey"), ("k2", "s_suppkey")], ["name"]).select("o_orderkey", "name")


@query("""WITH r AS (SELECT p_partkey AS ord, (p_partkey % 40)::VARCHAR AS a, p_brand AS b, p_size % 4 AS floor FROM part),
l AS (SELECT s_suppkey AS id, (s_suppkey % 60)::VARCHAR AS a, 'Brand#' || (s_suppkey % 30) AS b, s_nationkey % 4 AS floor FROM supplier),
k AS (SELECT floor, n, v, max(ord) AS ord FROM (SELECT floor, 0 AS n, a AS v, ord FROM r UNION ALL SELECT floor, 1, b, ord FROM r) GROUP BY ALL),
h AS (SELECT l.id, k.n, k.ord FROM l JOIN k ON l.floor = k.floor AND ((k.n = 0 AND k.v = l.a) OR (k.n = 1 AND k.v = l.b)))
SELECT l.id, (SELECT ord FROM h WHERE h.id = l.id ORDER BY n LIMIT 1) AS hit FROM l""")
def q_multi_key_lookup(spark, d):
    k = F.col("p_partkey")
    r = read(spark, d, "part").select(k.alias("ord"), k.alias("hit"), (k % 40).cast("string").alias("ra"), F.col("p_brand").alias("rb"), (F.col("p_size") % 4).alias("floor"))
    s = F.col("s_suppkey")
    l = read(spark, d, "supplier").select(s.alias("id"), (s % 60).cast("string").alias("la"), F.concat(F.lit("Brand#"), (s % 30).cast("string")).alias("lb"), (F.col("s_nationkey") % 4).alias("floor"))
    return rel.multi_key_lookup(l, r, "id", [("la", "ra"), ("lb", "rb")], ["floor"], "hit", "ord").select("id", "hit")


@query(f"WITH {PLANE} SELECT a.vec_id FROM p a WHERE EXISTS (SELECT 1 FROM p b WHERE b.vec_id % 7 = 0 AND a.label = b.label AND {_D} <= 3.0)")
def q_distance_semi_join(spark, d):
    p = plane(spark, d)
    ends = p.where("vec_id % 7 = 0").select(F.col("x").alias("ex"), F.col("z").alias("ez"), "label")
    return spatial.distance_semi_join(p, ends, "x", "z", "ex", "ez", 3.0, "vec_id", ["label"]).select("vec_id")


@query(f"WITH {PLANE} SELECT a.vec_id AS lower, b.vec_id AS upper FROM p a JOIN p b ON a.label = b.label AND a.vec_id % 5 < b.vec_id % 5 AND {_D} <= 5")
def q_band_self_join(spark, d):
    p = plane(spark, d)
    side = lambda n: p.select(F.col("vec_id").alias(f"v{n}"), F.col("x").alias(f"x{n}"), F.col("z").alias(f"z{n}"), "label", (F.col("vec_id") % 5).alias(f"f{n}"))
    pairs = spatial.grid_distance_join(side(1), side(2), "x1", "z1", "x2", "z2", 5.0, ["label"])
    return pairs.where("f1 < f2").select(F.col("v1").alias("lower"), F.col("v2").alias("upper"))


def _two(p):
    right = p.select(F.col("vec_id").alias("to"), F.col("x").alias("tx"), F.col("z").alias("tz"), "label")
    return p, right


@query(f"WITH {PLANE}, k AS (SELECT a.vec_id, b.vec_id AS \"to\", row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D}, b.vec_id) AS rank FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND {_D} > 0.05 AND {_D} <= 20) SELECT vec_id, \"to\", rank FROM k WHERE rank <= 3")
def q_knn_self_join(spark, d):
    p, right = _two(plane(spark, d))
    return spatial.knn_join(p, right, "vec_id", "to", "x", "z", "tx", "tz", 3, 20.0, ["label"], above=0.05).select("vec_id", "to", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {PLANE}, k AS (SELECT a.vec_id, b.vec_id AS \"to\", row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D}, b.vec_id) AS rank FROM p a JOIN p b ON b.vec_id % 4 = 0 AND a.label = b.label AND a.vec_id <> b.vec_id AND {_D} <= 20) SELECT vec_id, \"to\", rank FROM k WHERE rank <= CASE WHEN vec_id % 4 = 0 THEN 8 ELSE 3 END")
def q_knn_variable_k(spark, d):
    p, right = _two(plane(spark, d))
    k = F.when(F.col("vec_id") % 4 == 0, 8).otherwise(3)
    return spatial.knn_join(p, right.where("to % 4 = 0"), "vec_id", "to", "x", "z", "tx", "tz", k, 20.0, ["label"], most=8).select("vec_id", "to", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {PLANE}, k AS (SELECT a.vec_id, b.vec_id AS \"to\", row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D}, b.vec_id) AS rank FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND {_D} <= 20 AND NOT (abs(b.x - a.x) <= 1 AND abs(b.z - a.z) <= 1)) SELECT vec_id, \"to\", rank FROM k WHERE rank <= 5")
def q_knn_filtered(spark, d):
    p, right = _two(plane(spark, d))
    outside = ~((F.abs(F.col("tx") - F.col("x")) <= 1) & (F.abs(F.col("tz") - F.col("z")) <= 1))
    return spatial.knn_join(p, right, "vec_id", "to", "x", "z", "tx", "tz", 5, 20.0, ["label"], keep=outside).select("vec_id", "to", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {PLANE}, k AS (SELECT a.vec_id, b.vec_id AS \"to\", row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D}, b.vec_id) AS rn FROM p a, p b WHERE a.vec_id % 3 <> 0 AND b.vec_id % 50 = 0) SELECT vec_id, \"to\" FROM k WHERE rn = 1")
def q_nearest_one(spark, d):
    p, right = _two(plane(spark, d))
    return spatial.nearest_one(p.where("vec_id % 3 <> 0").drop("label"), right.where("to % 50 = 0").drop("label"), "vec_id", "to", "x", "z", "tx", "tz", 4.0).select("vec_id", "to")


_EDGES = f"""{PLANE}, e AS (SELECT vec_id AS edge, x AS x1, z AS z1, lead(x) OVER w AS x2, lead(z) OVER w AS z2, lead(vec_id) OVER w AS nxt, label FROM p WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
s AS (SELECT * FROM e WHERE x2 IS NOT NULL)"""


def _edges(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("label").orderBy("vec_id")
    e = plane(spark, d).select(F.col("vec_id").alias("edge"), F.col("x").alias("x1"), F.col("z").alias("z1"), F.lead("x").over(w).alias("x2"), F.lead("z").over(w).alias("z2"), F.lead("vec_id").over(w).alias("nxt"), "label")
    return e.where("x2 is not null")


def _seg_dist(px, pz):
    t = f"greatest(0, least(1, (({px} - x1) * (x2 - x1) + ({pz} - z1) * (z2 - z1)) / ((x2 - x1)^2 + (z2 - z1)^2)))"
    return f"sqrt(({px} - x1 - {t} * (x2 - x1))^2 + ({pz} - z1 - {t} * (z2 - z1))^2)"


def _near_edges(spark, d, limit, longest=float("inf")):
    """The nearest edge of its label within the limit of every point that is none of its ends."""
    e = _edges(spark, d).where(geo.distance(*map(F.col, ("x1", "z1", "x2", "z2"))) <= longest)
    return spatial.nearest_line(plane(spark, d), e, "vec_id", "edge", "x", "z", ["x1", "z1", "x2", "z2"], limit, ["label"], F.expr("vec_id <> edge and vec_id <> nxt"))


@query(f"WITH {_EDGES}, k AS (SELECT vec_id, edge, row_number() OVER (PARTITION BY vec_id ORDER BY dist, edge) AS rn FROM (SELECT p.vec_id, s.edge, s.nxt, {_seg_dist('p.x', 'p.z')} AS dist FROM p JOIN s ON p.label = s.label AND sqrt((x2 - x1)^2 + (z2 - z1)^2) <= 15) WHERE dist <= 0.75 AND vec_id <> edge AND vec_id <> nxt) SELECT vec_id, edge FROM k WHERE rn = 1")
def q_nearest_edge(spark, d):
    return _near_edges(spark, d, 0.75, 15.0).select("vec_id", "edge")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 2 = 0), b AS (SELECT o_custkey AS k, min(o_orderkey) AS o FROM orders GROUP BY 1)
SELECT k, o, 'direct' AS how FROM a JOIN b USING (k) UNION SELECT k, o, 'fallback' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def q_fallback_antijoin(spark, d):
    o = read(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    a = o.where("o_orderstatus = 'F' and k % 2 = 0").select("k").distinct()
    b = o.groupBy("k").agg(F.min("o_orderkey").alias("o"))
    return rel.fallback_union(b.join(a, "k").withColumn("how", F.lit("direct")), b.withColumn("how", F.lit("fallback")), ["k"])


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem l WHERE l_returnflag = 'A' AND EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND least(r.l_partkey, r.l_suppkey) = least(l.l_partkey, l.l_suppkey) AND greatest(r.l_partkey, r.l_suppkey) = greatest(l.l_partkey, l.l_suppkey))")
def q_edge_semi_join(spark, d):
    key = geo.edge_key(F.col("l_partkey"), F.lit(0), F.col("l_suppkey"), F.lit(0))
    li = read(spark, d, "lineitem").withColumn("k", key)
    open_ = li.where("l_returnflag = 'R'").select("k").distinct()
    return li.where("l_returnflag = 'A'").join(open_, "k", "left_semi").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def _cr(a, b, c):
    return f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"


_A1, _A2, _B1, _B2 = (("l.x1", "l.z1"), ("l.x2", "l.z2"), ("r.x1", "r.z1"), ("r.x2", "r.z2"))


@query(f"WITH {_EDGES} SELECT l.edge AS edge, r.edge AS other FROM s l JOIN s r ON l.label = r.label AND l.edge < r.edge AND {_cr(_A1, _A2, _B1)} * {_cr(_A1, _A2, _B2)} < 0 AND {_cr(_B1, _B2, _A1)} * {_cr(_B1, _B2, _A2)} < 0")
def q_segment_intersect_join(spark, d):
    e = _edges(spark, d)
    r = e.select(F.col("edge").alias("other"), *(F.col(c).alias(f"r{c}") for c in ("x1", "z1", "x2", "z2")), "label")
    hit = spatial.segment_intersect_join(e, r, "edge", "other", ["x1", "z1", "x2", "z2"], ["rx1", "rz1", "rx2", "rz2"], 6.0, ["label"])
    return hit.where("edge < other").select("edge", "other")


@query("SELECT a.n_nationkey::BIGINT AS a, b.n_nationkey::BIGINT AS b FROM nation a, nation b WHERE a.n_nationkey < b.n_nationkey")
def q_all_pairs(spark, d):
    n = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("a"))
    return n.join(F.broadcast(n.select(F.col("a").alias("b"))), F.col("a") < F.col("b"))  # 25 rows: a dimension


@query("SELECT r_name, n_name FROM region, nation")
def q_cross_product(spark, d):
    return read(spark, d, "nation").select("n_name").crossJoin(F.broadcast(read(spark, d, "region").select("r_name"))).select("r_name", "n_name")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey % 3 = b.s_suppkey % 3 AND a.s_suppkey <> b.s_suppkey")
def q_component_self_join(spark, d):
    s = read(spark, d, "supplier").select("s_nationkey", (F.col("s_suppkey") % 3).alias("part"), F.col("s_suppkey").alias("a"))
    return s.join(s.withColumnRenamed("a", "b"), ["s_nationkey", "part"]).where("a <> b").select("a", "b")


@query(f"WITH {PLANE} SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON a.label = b.label AND a.vec_id % 3 <> b.vec_id % 3 AND {_D} <= 5 AND abs(a.x - b.x) <= 2.5")
def q_band_join_residual(spark, d):
    p = plane(spark, d)
    side = lambda n, v: p.select(F.col("vec_id").alias(v), F.col("x").alias(f"x{n}"), F.col("z").alias(f"z{n}"), "label")
    pairs = spatial.grid_distance_join(side(1, "a"), side(2, "b"), "x1", "z1", "x2", "z2", 5.0, ["label"])
    return pairs.where((F.col("a") % 3 != F.col("b") % 3) & (F.abs(F.col("x1") - F.col("x2")) <= 2.5)).select("a", "b")


@query("SELECT o_orderkey, coalesce(c.c_name, 'unnamed') AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) c ON o_custkey = c_custkey")
def q_update_join(spark, d):
    c = read(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("new"))
    return read(spark, d, "orders").join(c, "o_custkey", "left").select("o_orderkey", F.coalesce("new", F.lit("unnamed")).alias("name"))


@query("SELECT s_nationkey::BIGINT AS k, 'supplier' AS src, s_suppkey AS id FROM supplier WHERE s_nationkey < 12 UNION ALL SELECT c_nationkey, 'customer', c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey < 12)")
def q_fallback_union(spark, d):
    s = read(spark, d, "supplier").where("s_nationkey < 12").select(F.col("s_nationkey").cast("long").alias("k"), F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"))
    c = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("k"), F.lit("customer").alias("src"), F.col("c_custkey").alias("id"))
    return rel.fallback_union(s, c, ["k"])


@query("SELECT p_partkey, p_brand FROM part WHERE upper(p_brand) NOT IN ('BRAND#12', 'BRAND#3', 'BRAND#45')")
def q_exclusion_anti_join(spark, d):
    out = spark.createDataFrame([("brand#12",), ("Brand#3",), ("BRAND#45",)], "k string").select(F.upper("k").alias("k"))
    return read(spark, d, "part").withColumn("k", F.upper("p_brand")).join(out, "k", "left_anti").select("p_partkey", "p_brand")


_GROUPS = [("north", 1, ["311", "325", "340"]), ("north_trial", 2, ["340", "377"]), ("lakeside", 3, ["298", "north"])]


@query("""WITH g(id, ord, alias) AS (VALUES ('north', 1, '311'), ('north', 1, '325'), ('north', 1, '340'), ('north_trial', 2, '340'), ('north_trial', 2, '377'), ('lakeside', 3, '298'), ('lakeside', 3, 'north'),
 ('north', 1, 'north'), ('north_trial', 2, 'north_trial'), ('lakeside', 3, 'lakeside')), k AS (SELECT (295 + s_suppkey % 110)::VARCHAR AS key, s_suppkey FROM supplier)
SELECT s_suppkey, (SELECT id FROM g WHERE lower(alias) = lower(k.key) ORDER BY ord LIMIT 1) AS grp FROM k""")
def q_alias_lookup(spark, d):
    g = spark.createDataFrame(_GROUPS, "id string, ord int, aliases array<string>")
    index = g.select("id", "ord", F.explode(F.concat(F.array("id"), "aliases")).alias("key")).withColumn("key", F.lower("key"))
    index = rel.first_by(index, ["key"], ["ord"]).select("key", F.col("id").alias("grp"))
    s = read(spark, d, "supplier").select("s_suppkey", F.lower((295 + F.col("s_suppkey") % 110).cast("string")).alias("key"))
    return s.join(index, "key", "left").select("s_suppkey", "grp")


@query(f"WITH {PLANE}, l(a, b) AS (VALUES (0, 5), (7, 3), (10, 20), (4, 9999)) SELECT l.a::BIGINT AS a, l.b::BIGINT AS b, round({_D} * 1000)::BIGINT AS dist FROM l JOIN p a ON l.a = a.vec_id JOIN p b ON l.b = b.vec_id WHERE {_D} <= 125")
def q_pair_list_join(spark, d):
    p = plane(spark, d)
    pairs = spark.createDataFrame([(0, 5), (7, 3), (10, 20), (4, 9999)], "a long, b long")
    at = lambda n: p.select(F.col("vec_id").alias(n), F.col("x").alias(f"x{n}"), F.col("z").alias(f"z{n}"))
    out = at("a").join(F.broadcast(pairs), "a").join(at("b"), "b").withColumn("d", geo.distance(*map(F.col, ("xa", "za", "xb", "zb"))))
    return out.where("d <= 125").select("a", "b", milli(F.col("d")).alias("dist"))


@query("""WITH m AS (SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND abs(l_extendedprice - o_totalprice / 4) <= 20000 AND l_quantity > 10) SELECT o_orderkey, l_partkey, l_suppkey FROM m WHERE rn = 1""")
def q_first_match(spark, d):
    li = read(spark, d, "lineitem").where("l_quantity > 10").withColumnRenamed("l_orderkey", "o_orderkey")
    m = read(spark, d, "orders").select("o_orderkey", "o_totalprice").join(li, "o_orderkey").where(F.abs(F.col("l_extendedprice") - F.col("o_totalprice") / 4) <= 20000)
    return rel.first_by(m, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).select("o_orderkey", "l_partkey", "l_suppkey")


@query(f"WITH {_EDGES}, k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, edge) AS rn FROM (SELECT p.vec_id, p.x, p.z, s.*, {_seg_dist('p.x', 'p.z')} AS dist FROM p JOIN s ON p.label = s.label) WHERE dist <= 1 AND vec_id <> edge AND vec_id <> nxt) SELECT vec_id, edge, round(dist * 1000)::BIGINT AS dist FROM k WHERE rn = 1")
def q_nearest_segment(spark, d):
    return _near_edges(spark, d, 1.0).select("vec_id", "edge", milli(F.col("dist")).alias("dist"))


_BOX = ((-6.0, -6.0), (6.0, -6.0), (6.0, 6.0), (-6.0, 6.0))


@query(f"""WITH {_EDGES}, b(i, bx1, bz1, bx2, bz2) AS (VALUES (0, -6.0, -6.0, 6.0, -6.0), (1, 6.0, -6.0, 6.0, 6.0), (2, 6.0, 6.0, -6.0, 6.0), (3, -6.0, 6.0, -6.0, -6.0)),
c AS (SELECT edge, x1, z1, x2, z2, ((bx1 - x1) * (bz2 - bz1) - (bz1 - z1) * (bx2 - bx1)) / nullif((x2 - x1) * (bz2 - bz1) - (z2 - z1) * (bx2 - bx1), 0) AS t,
 ((bx1 - x1) * (z2 - z1) - (bz1 - z1) * (x2 - x1)) / nullif((x2 - x1) * (bz2 - bz1) - (z2 - z1) * (bx2 - bx1), 0) AS u FROM s, b)
SELECT edge, round((x1 + max(t) * (x2 - x1)) * 1000)::BIGINT AS dx, round((z1 + max(t) * (z2 - z1)) * 1000)::BIGINT AS dz FROM c WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1 GROUP BY edge, x1, z1, x2, z2""")
def q_last_crossing(spark, d):
    """The crossing of a boundary that is farthest along the line."""
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(z).alias("z")) for x, z in _BOX))
    e = _edges(spark, d).withColumn("b", F.explode(geo.ring_edges(ring)))
    dx, dz = F.col("x2") - F.col("x1"), F.col("z2") - F.col("z1")
    bx, bz = F.col("b.b.x") - F.col("b.a.x"), F.col("b.b.z") - F.col("b.a.z")
    px, pz = F.col("b.a.x") - F.col("x1"), F.col("b.a.z") - F.col("z1")
    det = F.nullif(dx * bz - dz * bx, F.lit(0.0))
    hits = e.withColumns({"t": (px * bz - pz * bx) / det, "u": (px * dz - pz * dx) / det}).where(F.col("t").between(0, 1) & F.col("u").between(0, 1))
    last = hits.groupBy("edge", "x1", "z1", "x2", "z2").agg(F.max("t").alias("t"))
    return last.select("edge", milli(F.col("x1") + F.col("t") * dx).alias("dx"), milli(F.col("z1") + F.col("t") * dz).alias("dz"))


@query(f"""WITH {_EDGES}, b(i, bx1, bz1, bx2, bz2) AS (VALUES (0, -6.0, -6.0, 6.0, -6.0), (1, 6.0, -6.0, 6.0, 6.0), (2, 6.0, 6.0, -6.0, 6.0), (3, -6.0, 6.0, -6.0, -6.0)),
c AS (SELECT *, ((bx1 - x1) * (bz2 - bz1) - (bz1 - z1) * (bx2 - bx1)) / nullif((x2 - x1) * (bz2 - bz1) - (z2 - z1) * (bx2 - bx1), 0) AS t, ((bx1 - x1) * (z2 - z1) - (bz1 - z1) * (x2 - x1)) / nullif((x2 - x1) * (bz2 - bz1) - (z2 - z1) * (bx2 - bx1), 0) AS u,
 greatest(0, least(1, ((x2 - bx1) * (bx2 - bx1) + (z2 - bz1) * (bz2 - bz1)) / ((bx2 - bx1)^2 + (bz2 - bz1)^2))) AS v FROM s, b),
n AS (SELECT *, bx1 + v * (bx2 - bx1) AS nx, bz1 + v * (bz2 - bz1) AS nz FROM c), m AS (SELECT *, sqrt((nx - x2)^2 + (nz - z2)^2) AS d FROM n),
g AS (SELECT edge, x1, z1, x2, z2, max(CASE WHEN t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1 THEN t END) AS t, arg_min(nx, (d, i)) AS nx, arg_min(nz, (d, i)) AS nz, min(d) AS d FROM m GROUP BY ALL)
SELECT edge, round(coalesce(x1 + t * (x2 - x1), nx) * 1000)::BIGINT AS dx, round(coalesce(z1 + t * (z2 - z1), nz) * 1000)::BIGINT AS dz,
 CASE WHEN t IS NOT NULL THEN 'route_boundary_intersection' WHEN d < 0.000003 THEN 'route_endpoint_on_boundary' ELSE 'nearest_boundary_to_route_endpoint' END AS source,
 CASE WHEN t IS NOT NULL OR d < 0.000003 THEN 'high' WHEN abs(x2) < 6 AND abs(z2) < 6 THEN 'medium' ELSE 'low' END AS confidence FROM g""")
def q_room_doors(spark, d):
    """Every edge as a route to a room: its last crossing of the boundary, else the boundary point next to its end."""
    e = _edges(spark, d)
    lines = e.select("edge", F.lit(0).alias("at"), F.col("x1").alias("lon"), F.col("z1").alias("lat")).unionByName(e.select("edge", F.lit(1).alias("at"), F.col("x2").alias("lon"), F.col("z2").alias("lat")))
    ring = F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(z).alias("lat")) for x, z in _BOX))
    found = doors.room_doors(lines, e.select("edge", ring.alias("ring")), "edge")
    return found.select("edge", milli(F.col("lon")).alias("dx"), milli(F.col("lat")).alias("dz"), "source", "confidence")


@query(f"""WITH {PLANE}, r AS (SELECT vec_id AS ring, label, x AS x0, z AS z0, x + 6 AS x1, z + 4 AS z1 FROM p WHERE vec_id % 8 = 0),
k AS (SELECT p.vec_id, r.ring, sqrt(greatest(x0 - x, 0, x - x1)^2 + greatest(z0 - z, 0, z - z1)^2) AS dist FROM p JOIN r ON p.label = r.label AND p.vec_id % 8 <> 0)
SELECT vec_id, ring, round(dist * 1000)::BIGINT AS dist FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, ring) AS rn FROM k) WHERE rn = 1""")
def q_nearest_ring(spark, d):
    """The box that covers a point, else the nearest one, of its own label."""
    p = plane(spark, d)
    corner = lambda i, j: F.struct((F.col("x") + i).alias("x"), (F.col("z") + j).alias("z"))
    boxes = p.where("vec_id % 8 = 0").select(F.col("vec_id").alias("ring"), "label", F.array(corner(0.0, 0.0), corner(6.0, 0.0), corner(6.0, 4.0), corner(0.0, 4.0)).alias("line"))
    near = spatial.nearest_ring(p.where("vec_id % 8 <> 0"), boxes, "vec_id", "ring", "x", "z", "line", 8.0, ["label"])
    return near.where("ring is not null").select("vec_id", "ring", milli(F.col("distance")).alias("dist"))
