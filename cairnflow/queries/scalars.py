"""Scalar functions and row-wise derivations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import floors, geo, text
from ..operators import relational as rel
from .registry import PLANE, milli, plane, query, read


@query("SELECT event_id, coalesce(nullif(json_extract_string(props, '$.name'), ''), nullif(trim(event_type), ''), 'none') AS name FROM events")
def q_coalesce_chain(spark, d):
    e = read(spark, d, "events")
    return e.select("event_id", text.py_or(F.get_json_object("props", "$.name"), F.trim("event_type"), F.lit("none")).alias("name"))


@query("""SELECT p_partkey, CASE WHEN n = '' THEN a ELSE a || '-' || n END AS slug FROM (SELECT p_partkey,
 trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS n, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS a FROM part)""")
def q_slug(spark, d):
    return read(spark, d, "part").select("p_partkey", text.slug(F.col("p_brand"), F.col("p_name")).alias("slug"))


@query("""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(trim(p_type), '[^A-Za-z0-9]+', '_', 'g'), '_'), ''), 'unknown') AS under,
 coalesce(nullif(array_to_string(list_transform(parts, lambda x: upper(x[1]) || lower(x[2:])), ''), ''), 'Building') AS pascal,
 coalesce(nullif(array_to_string(list_transform(parts, lambda x: upper(x[1]) || x[2:]), ''), ''), 'Building') AS node,
 coalesce(nullif(trim(regexp_replace(upper(p_brand), '[^\\p{L}\\p{N}]', '_', 'g'), '_'), ''), 'UNKNOWN') AS token
 FROM (SELECT *, list_filter(regexp_split_to_array(p_type, '[^a-zA-Z0-9]+'), lambda x: x <> '') AS parts FROM part)""")
def q_identifiers(spark, d):
    c = F.col("p_type")
    return read(spark, d, "part").select("p_partkey", text.underscore_slug(c).alias("under"), text.pascal(c).alias("pascal"), text.node_name(c).alias("node"), text.group_token(F.col("p_brand")).alias("token"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(translate(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'), '/\"', '--'''), '[\x00-\x1f:]+', ' ', 'g'), '\s+', ' ', 'g')) AS folded FROM documents""")
def q_ascii_fold(spark, d):
    return read(spark, d, "documents").select("doc_id", text.clean_node_text(F.col("text")).alias("folded"))


@query("""WITH p AS (SELECT s_suppkey, s_name, CASE s_suppkey % 3 WHEN 0 THEN 'stair' WHEN 1 THEN 'elevator' ELSE 'door' END AS kind,
 lpad((s_nationkey)::VARCHAR, 3, '0') || '-' || (s_suppkey % 90)::VARCHAR AS ext, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'S' || (s_suppkey % 7)::VARCHAR END AS grp FROM supplier)
SELECT s_suppkey, CASE WHEN kind IN ('stair', 'elevator') THEN replace(ext, '-', ' ') || '_' || CASE kind WHEN 'stair' THEN 'Stairs' ELSE 'Elevator' END || '_Set' || split_part(ext, '-', 1) || coalesce(nullif(grp, ''), 'MAIN')
 ELSE replace(ext, '-', ' ') || '_' || s_name END AS portal, replace(ext, '-', ' ') || '_' || s_name AS room FROM p""")
def q_compose_key(spark, d):
    s = read(spark, d, "supplier")
    key = F.col("s_suppkey")
    kind = F.when(key % 3 == 0, "stair").when(key % 3 == 1, "elevator").otherwise("door")
    ext = F.concat(F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), F.lit("-"), (key % 90).cast("string"))
    grp = F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("S"), (key % 7).cast("string")))
    s = s.select(key, "s_name", kind.alias("kind"), ext.alias("ext"), grp.alias("grp"))
    return s.select("s_suppkey", text.portal_node_name(F.col("ext"), F.col("s_name"), F.col("kind"), F.col("grp")).alias("portal"), text.room_node_name(F.col("ext"), F.col("s_name")).alias("room"))


@query("""WITH v AS (SELECT p_partkey, lower(p_brand) || '-' || (p_size)::VARCHAR AS ext, CASE WHEN p_partkey % 2 = 0 THEN 'quay' ELSE '741' END AS b FROM part)
SELECT p_partkey, CASE WHEN position('-' IN ext) = 0 THEN ext ELSE ext || '|' || regexp_extract(ext, '^[^-]*-(.*)$', 1) ||
 CASE WHEN lower(replace(ext, '-', ' ')) IN (lower(ext), lower(regexp_extract(ext, '^[^-]*-(.*)$', 1))) THEN '' ELSE '|' || replace(ext, '-', ' ') END ||
 CASE WHEN b = '741' THEN '' ELSE '|QUAY ' || regexp_extract(ext, '^[^-]*-(.*)$', 1) END END AS aliases FROM v""")
def q_ordered_distinct_ci(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.concat(F.lower("p_brand"), F.lit("-"), F.col("p_size").cast("string")).alias("ext"), F.when(F.col("p_partkey") % 2 == 0, "quay").otherwise("741").alias("b"))
    return p.select("p_partkey", F.array_join(text.aliases(F.col("ext"), F.col("b")), "|").alias("aliases"))


_CATEGORY = " ".join(f"WHEN {' OR '.join(f'''contains(t, '{w}')''' for w in words)} THEN '{name}'" for name, words in text.CATEGORY_RULES)


@query(f"SELECT doc_id, CASE {_CATEGORY} ELSE 'other' END AS category FROM (SELECT doc_id, lower(text || ' ' || source) AS t FROM documents)")
def q_keyword_category(spark, d):
    return read(spark, d, "documents").select("doc_id", text.keyword_category(F.concat("text", F.lit(" "), "source")).alias("category"))


_EXT = "p_brand || '-' || CASE p_partkey % 4 WHEN 0 THEN 'E' WHEN 1 THEN 's' WHEN 2 THEN 'D' ELSE '' END || (p_size)::VARCHAR"


def _portals(spark, d):
    k = F.col("p_partkey")
    letter = F.when(k % 4 == 0, "E").when(k % 4 == 1, "s").when(k % 4 == 2, "D").otherwise("")
    ext = F.concat(F.col("p_brand"), F.lit("-"), letter, F.col("p_size").cast("string"))
    return read(spark, d, "part").select(k, "p_type", "p_name", ext.alias("ext"))


_KIND = """CASE WHEN contains(t, 'elevator') OR contains(t, 'lift') OR regexp_matches(ext, '(?i)e\\d+$') THEN 'elevator'
 WHEN contains(t, 'stair') OR regexp_matches(ext, '(?i)s\\d+$') THEN 'stair' WHEN contains(t, 'entrance') OR contains(t, 'door') THEN 'door' ELSE '' END"""


@query(f"SELECT p_partkey, {_KIND} AS kind FROM (SELECT p_partkey, lower(p_type) AS t, {_EXT} AS ext FROM part)")
def q_regex_kind(spark, d):
    return _portals(spark, d).select("p_partkey", text.portal_kind(F.col("p_type"), F.col("ext")).alias("kind"))


@query(f"""SELECT p_partkey, CASE kind WHEN 'elevator' THEN coalesce(nullif(upper(regexp_extract(ext, '(?i)(E\\d+)$', 1)), ''), 'E' || nullif(regexp_extract(p_name, '(?i)E\\s*(\\d+)', 1), ''), 'DEFAULT')
 WHEN 'stair' THEN coalesce(nullif(upper(regexp_extract(ext, '(?i)(S\\d+)$', 1)), ''), 'S' || nullif(regexp_extract(p_name, '(?i)S\\s*(\\d+)', 1), ''), 'DEFAULT')
 ELSE coalesce(nullif(upper(regexp_extract(ext, '(?i)(D\\d+)$', 1)), ''), 'D' || nullif(regexp_extract(p_name, '(?i)D\\s*(\\d+)', 1), ''), CASE kind WHEN 'door' THEN 'MAIN' ELSE 'DEFAULT' END) END AS grp
 FROM (SELECT *, {_KIND} AS kind FROM (SELECT p_partkey, p_name, lower(p_type) AS t, {_EXT} AS ext FROM part))""")
def q_regex_extract_fallback(spark, d):
    p = _portals(spark, d).withColumn("kind", text.portal_kind(F.col("p_type"), F.col("ext")))
    return p.select("p_partkey", text.portal_group_id(F.col("ext"), F.col("p_name"), F.col("kind")).alias("grp"))


_LABELS = "['G', 'B-1', 'B', 'SB', 'M8', '1M', '2', ' ground ', '-1', '0', 'none', 'roof', 'B-x', '12', '2.5']"


def _labels(spark, d):
    names = [x.strip("'") for x in _LABELS.strip("[]").split(", ")]
    label = F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % len(names) + 1).cast("int"))
    return read(spark, d, "part").select("p_partkey", "p_size", label.alias("label"))


_L = f"l AS (SELECT p_partkey, p_size, {_LABELS}[p_partkey % 15 + 1] AS label FROM part)"
_CANON = "CASE WHEN upper(trim(label)) IN ('', 'NONE', '0', 'G', 'GROUND', 'LEVEL 0') THEN 'G' WHEN upper(trim(label)) = 'B' THEN 'B-1' ELSE upper(trim(label)) END"
_SORT = """CASE WHEN starts_with(c, 'B-') THEN coalesce(-try_cast(substr(c, 3) AS DOUBLE), -1.0) WHEN c = 'G' THEN 0.0 WHEN c = 'SB' THEN -1.5
 WHEN regexp_matches(c, '^M\\d+$') THEN substr(c, 2)::DOUBLE + 0.5 WHEN regexp_matches(c, '^\\d+M$') THEN regexp_replace(c, 'M$', '')::DOUBLE + 0.5 ELSE coalesce(try_cast(c AS DOUBLE), 10000.0) END"""


@query(f"WITH {_L}, c AS (SELECT *, {_CANON} AS c FROM l) SELECT p_partkey, ({_SORT} * 10)::BIGINT AS sort10, coalesce(CASE WHEN regexp_matches(trim(label), '^[+-]?\\d+$') THEN trim(label)::INTEGER END, CASE WHEN upper(label) = 'G' THEN 0 ELSE 10000 END)::BIGINT AS base FROM c")
def q_mixed_sort_key(spark, d):
    c = F.col("label")
    return _labels(spark, d).select("p_partkey", (floors.sort_value(c) * 10).cast("long").alias("sort10"), floors.base_sort_key(c).cast("long").alias("base"))


@query(f"""WITH {_L}, u AS (SELECT *, upper(trim(label)) AS t FROM l)
SELECT p_partkey, {_CANON} AS canon, CASE WHEN t IN ('', '0', 'G', 'GROUND') THEN 'G' ELSE t END AS entry, starts_with(t, 'B') OR coalesce(try_cast(t AS DOUBLE) < 0, false) AS basement,
 (CASE WHEN t IN ('G', 'GROUND') THEN 0 WHEN t = 'B' THEN -1 WHEN starts_with(t, 'B-') THEN coalesce(-try_cast(substr(t, 3) AS INTEGER), 0) WHEN regexp_matches(t, '^M?-?\\d+$') THEN regexp_replace(t, '^M', '')::INTEGER ELSE 0 END)::BIGINT AS scene,
 (CASE WHEN t = 'G' THEN 0 WHEN starts_with(t, 'B-') THEN coalesce(-try_cast(substr(t, 3) AS INTEGER), 0) WHEN regexp_matches(t, '^M\\d+$') THEN substr(t, 2)::INTEGER ELSE coalesce(trunc(try_cast(t AS DOUBLE)), 0) END)::BIGINT AS topology,
 CASE WHEN regexp_matches(lower(trim(label)), '^b-\\d+$') THEN replace(lower(trim(label)), '-', '') WHEN regexp_matches(lower(trim(label)), '^-\\d+$') THEN 'b' || substr(trim(label), 2)
  ELSE coalesce(nullif(trim(regexp_replace(lower(trim(label)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'floor') END AS safe FROM u""")
def q_canonical_label(spark, d):
    c = F.col("label")
    return _labels(spark, d).select("p_partkey", floors.canonical(c).alias("canon"), floors.canonical_entry(c).alias("entry"), floors.is_basement(c).alias("basement"), floors.number_scene(c).cast("long").alias("scene"), floors.number_topology(c).cast("long").alias("topology"), text.safe_floor_label(c).alias("safe"))


@query(f"""WITH {_L}, u AS (SELECT *, upper(trim(label)) AS t FROM l)
SELECT p_partkey, (coalesce(try_cast(label AS DOUBLE), CASE WHEN t IN ('G', 'GROUND') THEN 0.0 WHEN regexp_matches(t, '^M\\d+$') THEN substr(t, 2)::DOUBLE * 10 + 5 ELSE p_size END) * 10)::BIGINT AS level10,
 (coalesce(try_cast(label AS DOUBLE), CASE WHEN t IN ('G', 'GROUND') THEN 0.0 ELSE p_size END) * 10)::BIGINT AS plain10 FROM u""")
def q_trycast_fallback(spark, d):
    c = F.col("label")
    return _labels(spark, d).select("p_partkey", (floors.source_floor(c, F.col("p_size")) * 10).cast("long").alias("level10"), (floors.source_floor(c, F.col("p_size"), False) * 10).cast("long").alias("plain10"))


@query("SELECT p_partkey, trim(split_part(p_brand || '-' || p_name, '-', 1)) AS prefix FROM part")
def q_prefix_key(spark, d):
    return read(spark, d, "part").select("p_partkey", text.prefix_key(F.concat("p_brand", F.lit("-"), "p_name")).alias("prefix"))


@query("SELECT doc_id, trim(lower(regexp_replace(regexp_replace(text, '[^ -~\\n]', 'x', 'g'), '\\s+', ' ', 'g'))) AS key FROM documents")
def q_normalised_key(spark, d):
    return read(spark, d, "documents").select("doc_id", text.alias_key(F.regexp_replace("text", "[^ -~\\n]", "x")).alias("key"))


@query(f"WITH {PLANE} SELECT vec_id, round(sqrt(x * x + z * z) * 1000)::BIGINT AS flat, round(sqrt(((x / 1e4) * 111320 * cos(radians((z / 1e4 + 0) / 2)))^2 + (z / 1e4 * 110540)^2) * 1000)::BIGINT AS metres FROM p")
def q_distances(spark, d):
    x, z, o = F.col("x"), F.col("z"), F.lit(0.0)
    return plane(spark, d).select("vec_id", milli(geo.distance(o, o, x, z)).alias("flat"), milli(geo.degrees_distance(o, o, x / 1e4, z / 1e4)).alias("metres"))


@query(f"""WITH {PLANE}, t AS (SELECT *, greatest(0, least(1, ((x + 5) * 20 + (z + 3) * 7) / 449.0)) AS t FROM p)
SELECT vec_id, round(sqrt((x - (-5 + t * 20))^2 + (z - (-3 + t * 7))^2) * 1000)::BIGINT AS dist, round(t * 1000)::BIGINT AS place FROM t""")
def q_point_segment(spark, d):
    seg = [F.lit(v) for v in (-5.0, -3.0, 15.0, 4.0)]
    return plane(spark, d).select("vec_id", milli(geo.point_segment(F.col("x"), F.col("z"), *seg)).alias("dist"), milli(geo.segment_t(F.col("x"), F.col("z"), *seg)).alias("place"))


_RING = [(-9.0, -7.0), (8.0, -9.0), (1.0, 0.5), (9.0, 10.0), (-8.0, 6.0)]


def _ring(points):
    return F.array(*(F.struct(F.lit(x).alias("x"), F.lit(z).alias("z")) for x, z in points))


_RING_EDGES = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(_RING, _RING[1:] + _RING[:1], strict=True))


@query(f"""WITH {PLANE}, e AS (SELECT * FROM (VALUES {_RING_EDGES}) AS v(ax, az, bx, bz))
SELECT vec_id, (count(*) FILTER (WHERE (az > z) <> (bz > z) AND x < (bx - ax) * (z - az) / nullif(bz - az, 0) + ax)) % 2 = 1 AS inside FROM p, e GROUP BY vec_id""")
def q_point_in_ring(spark, d):
    return plane(spark, d).select("vec_id", geo.point_in_ring(F.col("x"), F.col("z"), _ring(_RING)).alias("inside"))


_QUAD = f"{PLANE}, r AS (SELECT vec_id // 4 AS ring, list({{'x': x, 'z': z}} ORDER BY vec_id) AS pts FROM p GROUP BY ALL HAVING count(*) = 4)"


def _quads(spark, d):
    pts = F.array_sort(F.collect_list(F.struct("vec_id", "x", "z")))
    q = plane(spark, d).groupBy(F.floor(F.col("vec_id") / 4).alias("ring")).agg(pts.alias("p")).where(F.size("p") == 4)
    return q.select("ring", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["z"].alias("z"))).alias("pts"))


@query(f"WITH {_QUAD} SELECT ring, round(500 * list_sum(list_transform(range(1, 5), lambda i: pts[i].x * pts[i % 4 + 1].z - pts[i % 4 + 1].x * pts[i].z)))::BIGINT AS area FROM r")
def q_shoelace(spark, d):
    return _quads(spark, d).select("ring", milli(geo.signed_area(F.col("pts"))).alias("area"))


@query(f"""WITH {_QUAD} SELECT ring, 4::BIGINT AS n_open, round(list_sum(list_transform(range(1, 5), lambda i: sqrt((pts[i].x - pts[i % 4 + 1].x)^2 + (pts[i].z - pts[i % 4 + 1].z)^2))) * 1000)::BIGINT AS perimeter FROM r""")
def q_ring_ops(spark, d):
    closed = F.concat("pts", F.slice("pts", 1, 1))
    r = _quads(spark, d).select("ring", geo.open_ring(closed).alias("pts"))
    length = F.aggregate(geo.ring_edges(F.col("pts")), F.lit(0.0), lambda s, e: s + geo.distance(e["a"]["x"], e["a"]["z"], e["b"]["x"], e["b"]["z"]))
    return r.select("ring", F.size("pts").cast("long").alias("n_open"), milli(length).alias("perimeter"))


@query(f"""WITH {_QUAD} SELECT ring, round(-list_sum(list_transform(range(1, 5), lambda i: (pts[i].x - pts[i % 4 + 1].x) * (pts[i].z + pts[i % 4 + 1].z))) * -1000)::BIGINT AS ny FROM
 (SELECT ring, list_transform(pts, lambda p: {{'x': p.z, 'z': p.x}}) AS pts FROM r)""")
def q_newell(spark, d):
    pts = F.transform("pts", lambda p: F.struct(p["x"].alias("x"), F.lit(0.0).alias("y"), p["z"].alias("z")))
    return _quads(spark, d).select("ring", milli(geo.newell(pts)["y"]).alias("ny"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, least(l_partkey, l_suppkey) AS lo, greatest(l_partkey, l_suppkey) AS hi FROM lineitem")
def q_edge_key(spark, d):
    li = read(spark, d, "lineitem")
    k = geo.edge_key(F.col("l_partkey"), F.lit(0), F.col("l_suppkey"), F.lit(0), 1)
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", k["a"]["x"].alias("lo"), k["b"]["x"].alias("hi"))


@query("SELECT o_orderkey, (CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 2 WHEN '3' THEN 1 ELSE 0 END)::BIGINT AS rank FROM orders")
def q_rank_map(spark, d):
    return read(spark, d, "orders").select("o_orderkey", text.rank_map(F.substring("o_orderpriority", 1, 1), {"1": 3, "2": 2, "3": 1}).cast("long").alias("rank"))


@query(f"""WITH {PLANE} SELECT vec_id, CASE WHEN x >= 0 THEN round(x * 1000)::BIGINT ELSE round(sqrt(x * x + z * z) * 1000)::BIGINT END AS walk, greatest(1, abs(label - 3)) * 20 AS vertical FROM p""")
def q_edge_cost(spark, d):
    x = F.col("x")
    walk = F.when(x >= 0, x).otherwise(geo.distance(F.lit(0.0), F.lit(0.0), x, F.col("z")))
    return plane(spark, d).select("vec_id", milli(walk).alias("walk"), (F.greatest(F.lit(1), F.abs(F.col("label") - 3)) * 20).cast("long").alias("vertical"))


@query("""SELECT n_nationkey::BIGINT AS n_nationkey, sha256('{"key":' || n_nationkey || ',"name":"' || n_name || '","region":' || n_regionkey || '}') AS hash FROM nation""")
def q_sha256(spark, d):
    doc = F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))
    return read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.sha2(doc, 256).alias("hash"))


@query("SELECT event_id, coalesce(nullif(json_extract_string(props, '$.error'), ''), nullif(json_extract_string(props, '$.message'), ''), substr(props, 1, 5)) AS error FROM events")
def q_error_text(spark, d):
    return read(spark, d, "events").select("event_id", text.error_text(F.col("props"), F.get_json_object("props", "$.error"), F.get_json_object("props", "$.message"), most=5).alias("error"))


@query("SELECT s_suppkey, printf('%.12f,%.12f,%d', s_acctbal / 100, s_acctbal / 200, s_nationkey) AS param FROM supplier")
def q_format(spark, d):
    return read(spark, d, "supplier").select("s_suppkey", text.point_param(F.col("s_acctbal") / 100, F.col("s_acctbal") / 200, F.col("s_nationkey")).alias("param"))


@query(f"""WITH {PLANE} SELECT label, round((CASE WHEN label % 3 = 0 THEN 0 WHEN label % 3 = 1 THEN (min(x) + max(x)) / 2 ELSE any_value(a) END) * 1000)::BIGINT AS ox FROM
 (SELECT *, first_value(x) OVER (PARTITION BY label ORDER BY vec_id) AS a FROM p) GROUP BY label""")
def q_bbox_mid(spark, d):
    g = plane(spark, d).groupBy("label").agg(F.min_by("x", "vec_id").alias("a"), ((F.min("x") + F.max("x")) / 2).alias("mid"))
    k = F.col("label") % 3
    anchor, mid = F.when(k == 2, F.col("a")), F.when(k == 1, F.col("mid"))
    return g.select("label", milli(F.coalesce(anchor, mid, F.lit(0.0))).alias("ox"))


@query("SELECT p_partkey, CASE WHEN p_size - 5 BETWEEN 0 AND 31 THEN (1::BIGINT << (p_size - 5)) ELSE 1 END AS layer FROM part")
def q_bit_layer(spark, d):
    return read(spark, d, "part").select("p_partkey", floors.navigation_layer(F.col("p_size") - 5).alias("layer"))


# --- derivations and filters ---


@query("""SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 'low total' WHEN o_orderkey % 97 = 0 THEN 'bad key' WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'ok' END AS reason FROM orders""")
def q_split_with_rejects(spark, d):
    good, bad = rel.split_with_rejects(read(spark, d, "orders"), [("low total", F.col("o_totalprice") < 1000), ("bad key", F.col("o_orderkey") % 97 == 0), ("pending", F.col("o_orderstatus") == "P")])
    return bad.select("o_orderkey", "reason").unionByName(good.select("o_orderkey", F.lit("ok").alias("reason")))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, 'all' AS used FROM nation UNION ALL SELECT n_nationkey, 'some' FROM nation WHERE n_regionkey IN (1, 3)")
def q_optional_in_filter(spark, d):
    n = read(spark, d, "nation")
    part = lambda values, name: rel.optional_in(n, "n_regionkey", values).select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.lit(name).alias("used"))
    return part([], "all").unionByName(part([1, 3], "some"))


@query("SELECT p_partkey, p_brand FROM part WHERE p_size IN (1, 2, 3)")
def q_filter_nonempty(spark, d):
    return rel.nonempty(read(spark, d, "part").where(F.col("p_size").isin(1, 2, 3)), "sizes").select("p_partkey", "p_brand")


@query("SELECT p_partkey, split_part(p_type, ' ', 1) AS head FROM part WHERE NOT starts_with(p_type, 'PROMO') AND p_size BETWEEN 5 AND 25")
def q_prefix_filter(spark, d):
    p = read(spark, d, "part").where(~F.col("p_type").startswith("PROMO") & F.col("p_size").between(5, 25))
    return p.select("p_partkey", F.substring_index("p_type", " ", 1).alias("head"))


@query(f"""WITH {PLANE}, b AS (SELECT min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM p WHERE label = 0)
SELECT vec_id FROM p, b WHERE sqrt(greatest(x0 - x, 0, x - x1)^2 + greatest(z0 - z, 0, z - z1)^2) <= 3""")
def q_bbox_distance_filter(spark, d):
    p = plane(spark, d)
    box = p.where("label = 0").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("z").alias("z0"), F.max("z").alias("z1"))
    return p.join(F.broadcast(box)).where(geo.bbox_distance(*map(F.col, ("x", "z", "x0", "z0", "x1", "z1"))) <= 3).select("vec_id")


@query("SELECT o_orderkey FROM orders WHERE lower(o_orderpriority) IN ('1-urgent', '2-high') AND o_orderstatus IN ('F')")
def q_eligible(spark, d):
    return read(spark, d, "orders").where(F.lower("o_orderpriority").isin("1-urgent", "2-high") & F.col("o_orderstatus").isin("F")).select("o_orderkey")


@query("SELECT event_id, event_type FROM events WHERE coalesce(event_type, '') = '' OR event_type = 'click'")
def q_step_filter(spark, d):
    return read(spark, d, "events").where((F.coalesce("event_type", F.lit("")) == "") | (F.col("event_type") == "click")).select("event_id", "event_type")


@query("SELECT c_custkey, c_acctbal > 0 AND c_name IS NOT NULL AND c_name <> '' AS usable, c_acctbal IS NOT NULL AND isfinite(c_acctbal) AS valid FROM customer")
def q_validity(spark, d):
    bal = F.col("c_acctbal")
    return read(spark, d, "customer").select("c_custkey", ((bal > 0) & F.col("c_name").isNotNull() & (F.col("c_name") != "")).alias("usable"), (bal.isNotNull() & ~F.isnan(bal) & (F.abs(bal) != float("inf"))).alias("valid"))


@query(f"WITH {PLANE} SELECT vec_id FROM p WHERE x BETWEEN -5 AND 10 AND z BETWEEN -10 AND 10 ORDER BY vec_id LIMIT 40")
def q_bbox_limit(spark, d):
    return plane(spark, d).where(F.col("x").between(-5, 10) & F.col("z").between(-10, 10)).orderBy("vec_id").limit(40).select("vec_id")


@query("SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def q_drop_private(spark, d):
    r = read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name", F.lit(1).alias("_rank"), F.lit("x").alias("_tmp"))
    return r.drop(*(c for c in r.columns if c.startswith("_")))


@query(f"WITH {PLANE} SELECT vec_id, round((174.769 + x / 1e5 - 174.77) * 111320 * cos(-36.85 * pi() / 180) * 1000)::BIGINT AS lx, round((-36.851 + z / 1e5 + 36.85) * 111320 * 1000)::BIGINT AS lz FROM p")
def q_local_projection(spark, d):
    x, z = geo.to_local(174.769 + F.col("x") / 1e5, -36.851 + F.col("z") / 1e5, 174.77, -36.85)
    return plane(spark, d).select("vec_id", milli(x).alias("lx"), milli(z).alias("lz"))


@query("SELECT l.s_suppkey, (coalesce(h.h, l.s_nationkey * 42))::BIGINT AS height10 FROM supplier l LEFT JOIN (SELECT n_nationkey, n_nationkey * 100 AS h FROM nation WHERE n_regionkey < 3) h ON l.s_nationkey = h.n_nationkey")
def q_lookup_else_formula(spark, d):
    h = read(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"), (F.col("n_nationkey") * 100).alias("h"))
    return read(spark, d, "supplier").join(h, "s_nationkey", "left").select("s_suppkey", F.coalesce("h", F.col("s_nationkey") * 42).cast("long").alias("height10"))


_REF = geo.Reference(lon=174.77, lat=-36.85, anchor=(12.0, 7.5), origin=(100.0, -40.0), scale=1.5)


@query(f"WITH {PLANE} SELECT vec_id, round((118 + (x / 1e5) * 111320 * cos(-36.85 * pi() / 180) * 1.5) * 1000)::BIGINT AS cx, round((-51.25 - z / 1e5 * 111320 * 1.5) * 1000)::BIGINT AS cz, true AS back FROM p")
def q_projection_roundtrip(spark, d):
    lon, lat = F.lit(174.77) + F.col("x") / 1e5, F.lit(-36.85) + F.col("z") / 1e5
    cx, cz = geo.to_campus(lon, lat, _REF)
    blon, blat = geo.from_campus(cx, cz, _REF)
    return plane(spark, d).select("vec_id", milli(cx).alias("cx"), milli(cz).alias("cz"), ((F.abs(blon - lon) < 1e-9) & (F.abs(blat - lat) < 1e-9)).alias("back"))


@query(f"WITH {PLANE} SELECT vec_id, round((x - 1) / 2 * 1000)::BIGINT AS ax, round((z - 3) * 1000)::BIGINT AS ay, round(((label - 2) - (z - 3) * 4) / 5 * 1000)::BIGINT AS az FROM p")
def q_affine_inverse(spark, d):
    p = geo.affine_inverse([2, 0, 0, 0, 1, 0, 0, 4, 5], [1, 3, 2], F.col("x"), F.col("z"), F.col("label"))
    return plane(spark, d).select("vec_id", *(milli(c).alias(n) for c, n in zip(p, ("ax", "ay", "az"), strict=True)))


@query("SELECT c_custkey, coalesce(o.n, 0)::BIGINT AS n_orders, coalesce(o.status, '') AS status FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderstatus) AS status FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey")
def q_defaults(spark, d):
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderstatus").alias("status"))
    return read(spark, d, "customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("status", F.lit("")).alias("status"))


@query("""WITH s AS (SELECT DISTINCT s_nationkey - 10 AS k FROM supplier)
SELECT k::BIGINT AS k, (CASE WHEN k < 0 THEN -3 * row_number() OVER (PARTITION BY k < 0 ORDER BY k DESC) ELSE 4 * (row_number() OVER (PARTITION BY k < 0 ORDER BY k) - 1) END)::BIGINT AS height FROM s""")
def q_signed_rank_heights(spark, d):
    from pyspark.sql import Window

    s = read(spark, d, "supplier").select((F.col("s_nationkey") - 10).cast("long").alias("k")).distinct()
    down = F.row_number().over(Window.partitionBy(F.col("k") < 0).orderBy(F.desc("k")))
    up = F.row_number().over(Window.partitionBy(F.col("k") < 0).orderBy("k"))
    return s.select("k", F.when(F.col("k") < 0, -3 * down).otherwise(4 * (up - 1)).cast("long").alias("height"))


@query(f"WITH {_L}, c AS (SELECT *, {_CANON} AS c FROM l), s AS (SELECT *, {_SORT} AS v FROM c) SELECT p_partkey, round(CASE WHEN v < 0 THEN v * 3.0 ELSE v * 4.2 END * 1000)::BIGINT AS height FROM s")
def q_piecewise_scale(spark, d):
    return _labels(spark, d).select("p_partkey", milli(floors.height(F.col("label"))).alias("height"))


@query("SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, coalesce(nullif(p_name, ''), p_brand) FROM part")
def q_union_records(spark, d):
    c, s, p = read(spark, d, "customer"), read(spark, d, "supplier"), read(spark, d, "part")
    rows = lambda df, kind, i, name: df.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), name.alias("name"))
    return rows(c, "customer", "c_custkey", F.col("c_name")).unionByName(rows(s, "supplier", "s_suppkey", F.col("s_name"))).unionByName(rows(p, "part", "p_partkey", text.py_or(F.col("p_name"), F.col("p_brand"))))


@query("""WITH f AS (SELECT min(n_nationkey) AS k FROM nation WHERE n_regionkey > 1) SELECT s_suppkey, coalesce(n.n_nationkey, f.k)::BIGINT AS floor,
 CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1 THEN 'MainDoor' ELSE 'Door' || row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) END AS door
 FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey AND n.n_regionkey > 1, f""")
def q_fallback_dim(spark, d):
    from pyspark.sql import Window

    n = read(spark, d, "nation").where("n_regionkey > 1").select("n_nationkey")
    low = n.agg(F.min("n_nationkey").alias("k"))
    s = read(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(low))
    rn = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    return s.select("s_suppkey", F.coalesce("n_nationkey", "k").cast("long").alias("floor"), F.when(rn == 1, "MainDoor").otherwise(F.concat(F.lit("Door"), rn.cast("string"))).alias("door"))
