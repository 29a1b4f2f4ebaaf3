"""Geometry generators and kernels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import mesh, overlay, spatial
from ..plans import walkable
from .joins import _EDGES, _edges
from .registry import PLANE, milli, plane, query, read
from .scalars import _quads


_HULL = f"""{PLANE}, h AS (SELECT a.label, a.x AS x1, a.z AS z1, b.x AS x2, b.z AS z2 FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id
 WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.label = a.label AND c.vec_id <> a.vec_id AND c.vec_id <> b.vec_id AND (b.x - a.x) * (c.z - a.z) - (b.z - a.z) * (c.x - a.x) < 0))"""


@query(f"WITH {_HULL} SELECT label, count(*)::INTEGER AS corners, round(sum(x1 * z2 - x2 * z1) / 2 * 1000)::BIGINT AS area FROM h GROUP BY 1")
def q_convex_hull(spark, d):
    pts = F.array_sort(F.collect_list(F.struct("x", "z")))
    g = plane(spark, d).groupBy("label").agg(pts.alias("p"))
    h = g.select("label", mesh.hull_udf("p").alias("h"))
    return h.select("label", F.size("h").alias("corners"), milli(geo.signed_area(F.col("h"))).alias("area"))


def _ring3(spark, d):
    return _quads(spark, d).select("ring", F.transform("pts", lambda p: F.struct(p["x"].alias("x"), F.lit(3.0).alias("y"), p["z"].alias("z"))).alias("pts"))


@query("""SELECT ring, 8::BIGINT AS vertices, 6::BIGINT AS faces, 84::BIGINT AS indexes, 2800::BIGINT AS low, 8::BIGINT AS wall_vertices, 3::BIGINT AS wall_faces, 42::BIGINT AS wall_indexes, 4500::BIGINT AS top
FROM (SELECT vec_id // 4 AS ring FROM embeddings GROUP BY 1 HAVING count(*) = 4)""")
def q_extrude(spark, d):
    """Slab and wall of a quad: corners, faces, the sum of all corner numbers in faces, and the heights; edge 1 has no wall."""
    v, f = mesh.extrude(F.col("pts"), 0.2)
    wv, wf = mesh.wall(F.col("pts"), 1.5, F.array(F.lit(1)))
    size = lambda c, name: F.size(c).cast("long").alias(name)
    total = lambda c, name: F.aggregate(F.flatten(c), F.lit(0).cast("long"), lambda s, i: s + i).alias(name)
    y = lambda c: F.transform(c, lambda p: p["y"])
    return _ring3(spark, d).select("ring", size(v, "vertices"), size(f, "faces"), total(f, "indexes"), milli(F.array_min(y(v))).alias("low"), size(wv, "wall_vertices"), size(wf, "wall_faces"), total(wf, "wall_indexes"), milli(F.array_max(y(wv))).alias("top"))


@query("SELECT ring, round((3.0 - ring % 4) * 1000)::BIGINT AS y FROM (SELECT DISTINCT vec_id // 4 AS ring, count(*) OVER (PARTITION BY vec_id // 4) AS n FROM embeddings) WHERE n = 4")
def q_localise(spark, d):
    local = mesh.localise(F.col("pts"), (F.col("ring") % 4).cast("double"))
    return _ring3(spark, d).select("ring", milli(local[0]["y"]).alias("y"))


@query(f"WITH {_HULL} SELECT label, (count(*) - 2)::INTEGER AS triangles, true AS same_area FROM h GROUP BY 1")
def q_triangulate_area(spark, d):
    """Ear clipping: the triangles' areas add up to the hull's area."""
    pts = F.array_sort(F.collect_list(F.struct("x", "z")))
    h = plane(spark, d).groupBy("label").agg(mesh.hull_udf(pts).alias("h"))
    h = h.withColumn("t", mesh.triangulate_udf("h"))
    corner = lambda t, k: F.element_at("h", t[k] + 1)
    one = lambda t: F.abs(geo.cross(corner(t, 0)["x"], corner(t, 0)["z"], corner(t, 1)["x"], corner(t, 1)["z"], corner(t, 2)["x"], corner(t, 2)["z"])) / 2
    total = F.aggregate("t", F.lit(0.0), lambda s, t: s + one(t))
    return h.select("label", F.size("t").alias("triangles"), (F.abs(total - F.abs(geo.signed_area(F.col("h")))) < 1e-6).alias("same_area"))


@query(f"""WITH {PLANE}, r AS (SELECT vec_id, x AS x1, z AS z1, x + 1.6 AS x2, z + 1.1 AS z2 FROM p), c AS (SELECT *, unnest(range(floor(x1 / 0.5)::BIGINT, floor(x2 / 0.5)::BIGINT + 1)) AS cx FROM r),
k AS (SELECT *, unnest(range(floor(z1 / 0.5)::BIGINT, floor(z2 / 0.5)::BIGINT + 1)) AS cz FROM c)
SELECT vec_id, cx, cz FROM k WHERE greatest(0, least(x2, (cx + 1) * 0.5) - greatest(x1, cx * 0.5)) * greatest(0, least(z2, (cz + 1) * 0.5) - greatest(z1, cz * 0.5)) >= 0.02 * 0.25""")
def q_raster_cells(spark, d):
    r = plane(spark, d).select("vec_id", F.col("x").alias("x1"), F.col("z").alias("z1"), (F.col("x") + 1.6).alias("x2"), (F.col("z") + 1.1).alias("z2"))
    return spatial.raster_cells(r, "x1", "z1", "x2", "z2", 0.5).select("vec_id", "cx", "cz")


@query(f"""WITH {PLANE}, b AS (SELECT label, greatest(4, ceil((max(x) - min(x) + 4) / 8))::BIGINT AS nx, greatest(4, ceil((max(z) - min(z) + 4) / 8))::BIGINT AS nz FROM p GROUP BY 1), c AS (SELECT *, unnest(range(nx)) AS ix FROM b)
SELECT label, ix, unnest(range(nz)) AS iz FROM c""")
def q_grid_envelope(spark, d):
    g = mesh.grid_envelope(plane(spark, d), ["label"], "x", "z", 2.0, 8.0)
    return g.select("label", F.col("ix").cast("long").alias("ix"), F.col("iz").cast("long").alias("iz"))


@query(f"""WITH {_EDGES} SELECT edge, round((x1 - (z2 - z1) / sqrt((x2 - x1)^2 + (z2 - z1)^2) * 1.5) * 1000)::BIGINT AS ax, round((z2 - (x2 - x1) / sqrt((x2 - x1)^2 + (z2 - z1)^2) * 1.5) * 1000)::BIGINT AS cz FROM s WHERE sqrt((x2 - x1)^2 + (z2 - z1)^2) > 0.000001""")
def q_strip_quads(spark, d):
    q = mesh.strip_quad(*map(F.col, ("x1", "z1", "x2", "z2")), 1.5)
    e = _edges(spark, d).withColumn("q", q).where("q is not null")
    return e.select("edge", milli(F.col("q")[0]["x"]).alias("ax"), milli(F.col("q")[2]["z"]).alias("cz"))


@query(f"""WITH {_EDGES}, c AS (SELECT *, unnest(range(floor((least(x1, x2) - 1) / 2)::BIGINT, floor((greatest(x1, x2) + 1) / 2)::BIGINT + 1)) AS cx FROM s),
k AS (SELECT *, unnest(range(floor((least(z1, z2) - 1) / 2)::BIGINT, floor((greatest(z1, z2) + 1) / 2)::BIGINT + 1)) AS cz FROM c),
t AS (SELECT *, (cx + 0.5) * 2 AS px, (cz + 0.5) * 2 AS pz FROM k), u AS (SELECT *, greatest(0, least(1, ((px - x1) * (x2 - x1) + (pz - z1) * (z2 - z1)) / ((x2 - x1)^2 + (z2 - z1)^2))) AS t FROM t)
SELECT edge, cx, cz FROM u WHERE sqrt((px - x1 - t * (x2 - x1))^2 + (pz - z1 - t * (z2 - z1))^2) <= 1""")
def q_buffer_cells(spark, d):
    return spatial.buffer_cells(_edges(spark, d), "x1", "z1", "x2", "z2", 1.0, 2.0).select("edge", "cx", "cz")


@query("SELECT l_orderkey, min(l_suppkey % 3) AS lo, max(l_suppkey % 3) AS hi FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey % 3) = 2")
def q_face_lines(spark, d):
    """Faces with exactly two distinct footprints are lines."""
    corners = read(spark, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 3).alias("x"), F.lit(0).alias("z"))
    return mesh.face_lines(corners, ["l_orderkey"], "x", "z").select("l_orderkey", F.col("x1").alias("lo"), F.col("x2").alias("hi"))


@query(f"WITH {PLANE} SELECT vec_id, dense_rank() OVER (PARTITION BY label ORDER BY round_even(x / 10, 0), round_even(z / 10, 0)) - 1 AS vertex FROM p")
def q_weld_vertices(spark, d):
    p = plane(spark, d).select("vec_id", "label", (F.col("x") / 10).alias("x"), (F.col("z") / 10).alias("z"))
    return mesh.weld(p, ["label"], "x", "z", 1).select("vec_id", F.col("vertex").cast("long").alias("vertex"))


@query()
def q_glb_bytes(spark, d):
    """One binary file per bucket of rings."""
    m = _ring3(spark, d).select((F.col("ring") % 3).alias("bucket"), F.concat(F.lit("ring"), F.col("ring").cast("string")).alias("name"), F.lit("room").alias("material"), F.col("pts").alias("ring"))
    files = mesh.glb_files(m, "bucket")
    return files.select("bucket", F.length("content").alias("bytes"), (F.substring("content", 1, 4) == F.lit(b"glTF")).alias("magic"))


@query(f"WITH {_EDGES} SELECT edge, round(x1 * 1000)::BIGINT AS x1, round(x2 * 1000)::BIGINT AS x2 FROM s")
def q_polyline_edges(spark, d):
    w = Window.partitionBy("label").orderBy("vec_id")
    p = plane(spark, d).select(F.col("vec_id").alias("edge"), milli(F.col("x")).alias("x1"), milli(F.lead("x").over(w)).alias("x2"))
    return p.where("x2 is not null")


_BOXES = f"""{PLANE}, b AS (SELECT vec_id, label, round_even(x * 1000, 0)::BIGINT AS x1, round_even(z * 1000, 0)::BIGINT AS z1, round_even((x + 1 + vec_id % 7) * 1000, 0)::BIGINT AS x2, round_even((z + 1 + vec_id % 5) * 1000, 0)::BIGINT AS z2 FROM p)"""


def _boxes(spark, d):
    x2, z2 = F.col("x") + 1 + F.col("vec_id") % 7, F.col("z") + 1 + F.col("vec_id") % 5
    corner = lambda x, z: F.struct(x.alias("x"), z.alias("z"))
    return plane(spark, d).select("vec_id", "label", F.array(corner(F.col("x"), F.col("z")), corner(x2, F.col("z")), corner(x2, z2), corner(F.col("x"), z2)).alias("ring"))


@query(f"""WITH {_BOXES}, e AS (SELECT label, x1 AS x FROM b UNION SELECT label, x2 FROM b), s AS (SELECT label, x AS lo, lead(x) OVER (PARTITION BY label ORDER BY x) AS hi FROM e),
i AS (SELECT s.label, lo, hi, z1, z2, max(z2) OVER (PARTITION BY s.label, lo ORDER BY z1, z2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s JOIN b ON b.label = s.label AND b.x1 <= lo AND b.x2 >= hi)
SELECT label, sum((hi - lo) * greatest(0, z2 - greatest(z1, coalesce(before, z1))))::BIGINT AS area FROM i GROUP BY 1""")
def q_polygon_union(spark, d):
    """Area in square millimetres of the union of overlapping boxes; the SQL sweeps them strip by strip."""
    return overlay.union_area(_boxes(spark, d), ["label"]).select("label", (F.col("twice") / 2).cast("long").alias("area"))


_STRIPS = """SELECT label, sum((hi - lo) * greatest(0, z2 - greatest(z1, coalesce(before, z1))))::BIGINT AS area FROM (SELECT s.label, lo, hi, z1, z2,
 max(z2) OVER (PARTITION BY s.label, lo ORDER BY z1, z2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s JOIN {b} b ON b.label = s.label AND b.x1 <= lo AND b.x2 >= hi) GROUP BY 1"""


@query(f"""WITH {_BOXES}, e AS (SELECT label, x1 AS x FROM b UNION SELECT label, x2 FROM b), s AS (SELECT label, x AS lo, lead(x) OVER (PARTITION BY label ORDER BY x) AS hi FROM e),
w AS (SELECT * FROM b WHERE vec_id % 3 = 0), u AS ({_STRIPS.format(b="b")}), v AS ({_STRIPS.format(b="w")}) SELECT u.label, u.area - v.area AS area FROM u JOIN v ON u.label = v.label""")
def q_polygon_difference(spark, d):
    """Area in square millimetres of two thirds of the boxes without the other third; in SQL the union of all less that of the third."""
    edges = overlay.shell_edges(_boxes(spark, d), ["label"], side=F.col("vec_id") % 3 != 0)
    return overlay.areas(overlay.boundary(edges, ["label"], "difference", cell=0.5), ["label"]).select("label", (F.col("twice") / 2).cast("long").alias("area"))


_CELLS = f"""{_BOXES}, x AS (SELECT *, unnest(range(floor(x1 / 2000)::BIGINT, ceil(x2 / 2000)::BIGINT)) AS cx FROM b), z AS (SELECT *, unnest(range(floor(z1 / 2000)::BIGINT, ceil(z2 / 2000)::BIGINT)) AS cz FROM x),
k AS (SELECT label, cx, cz, greatest(x1, cx * 2000) AS x1, least(x2, cx * 2000 + 2000) AS x2, greatest(z1, cz * 2000) AS z1, least(z2, cz * 2000 + 2000) AS z2 FROM z),
e AS (SELECT label, cx, cz, x1 AS x FROM k UNION SELECT label, cx, cz, x2 FROM k), s AS (SELECT label, cx, cz, x AS lo, lead(x) OVER (PARTITION BY label, cx, cz ORDER BY x) AS hi FROM e),
i AS (SELECT label, cx, cz, lo, hi, z1, z2, max(z2) OVER (PARTITION BY label, cx, cz, lo ORDER BY z1, z2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s JOIN k USING (label, cx, cz) WHERE x1 <= lo AND x2 >= hi),
c AS (SELECT label, cx, cz, sum((hi - lo) * greatest(0, z2 - greatest(z1, coalesce(before, z1))))::BIGINT AS area FROM i GROUP BY ALL)"""


@query(f"WITH {_CELLS} SELECT label, cx, cz, area FROM c WHERE area > 0")
def q_cell_areas(spark, d):
    """Exact area, in square millimetres, of the union of boxes in every cell of two metres."""
    whole = overlay.boundary(overlay.shell_edges(_boxes(spark, d), ["label"]), ["label"], cell=0.5)
    return overlay.cell_areas(whole, ["label"], 2.0).select("label", "cx", "cz", F.round(F.col("area") * 1e6).cast("long").alias("area"))


@query(f"""WITH {_EDGES}, x AS (SELECT *, unnest(range(floor(least(x1, x2) / 2)::BIGINT, floor(greatest(x1, x2) / 2)::BIGINT + 1)) AS cx FROM s), k AS (SELECT *, unnest(range(floor(least(z1, z2) / 2)::BIGINT, floor(greatest(z1, z2) / 2)::BIGINT + 1)) AS cz FROM x),
t AS (SELECT edge, cx, cz, sqrt((x2 - x1)^2 + (z2 - z1)^2) AS n, greatest(0, least((cx * 2 - x1) / nullif(x2 - x1, 0), (cx * 2 + 2 - x1) / nullif(x2 - x1, 0)), least((cz * 2 - z1) / nullif(z2 - z1, 0), (cz * 2 + 2 - z1) / nullif(z2 - z1, 0))) AS t0,
 least(1, greatest((cx * 2 - x1) / nullif(x2 - x1, 0), (cx * 2 + 2 - x1) / nullif(x2 - x1, 0)), greatest((cz * 2 - z1) / nullif(z2 - z1, 0), (cz * 2 + 2 - z1) / nullif(z2 - z1, 0))) AS t1 FROM k)
SELECT edge, cx, cz FROM t WHERE (t1 - t0) * n > 0.05""")
def q_cell_runs(spark, d):
    """Cells of two metres in which an edge runs for more than 0.05."""
    runs = overlay.cell_runs(_edges(spark, d), ["edge"], ["x1", "z1", "x2", "z2"], 2.0)
    return runs.groupBy("edge", "cx", "cz").agg(F.sum("run").alias("run")).where("run > 0.05").select("edge", "cx", "cz")


@query(f"""WITH {_CELLS}, o AS (SELECT label, cx, cz FROM c WHERE area >= 80000), q AS (SELECT label, cx + i AS vx, cz + j AS vz, count(*) AS n, sum(2 * i + j) AS m FROM o, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) w(i, j) GROUP BY ALL),
g AS (SELECT label, count(*) FILTER (WHERE n = 1) AS one, count(*) FILTER (WHERE n = 3) AS three, count(*) FILTER (WHERE n = 2 AND m = 3 AND EXISTS (SELECT 1 FROM o WHERE o.label = q.label AND ((o.cx = vx AND o.cz = vz AND EXISTS (SELECT 1 FROM o p WHERE p.label = q.label AND p.cx = vx - 1 AND p.cz = vz - 1))
  OR (o.cx = vx - 1 AND o.cz = vz AND EXISTS (SELECT 1 FROM o p WHERE p.label = q.label AND p.cx = vx AND p.cz = vz - 1))))) AS diagonal FROM q GROUP BY label)
SELECT label, (SELECT count(*) * 4 FROM o WHERE o.label = g.label)::BIGINT AS area, (one + three + 2 * diagonal - (one - three + 2 * diagonal) // 2)::BIGINT AS triangles FROM g""")
def q_ground_mesh(spark, d):
    """Cells of two metres that a union of boxes covers to a fiftieth, dissolved and triangulated: area and triangles. The SQL counts corner patterns: a polygon of n corners and h holes has n + 2 h - 2 triangles."""
    whole = overlay.boundary(overlay.shell_edges(_boxes(spark, d), ["label"]), ["label"], cell=0.5)
    cells = overlay.cell_areas(whole, ["label"], 2.0).where("area >= 0.08 - 1e-9").select("label", (F.col("cx") * 2).alias("x1"), (F.col("cz") * 2).alias("z1"), (F.col("cx") * 2 + 2).alias("x2"), (F.col("cz") * 2 + 2).alias("z2"))
    pieces = walkable.ground_mesh(cells, ["label"])
    return pieces.groupBy("label").agg(F.round(F.sum("area")).cast("long").alias("area"), F.sum(F.size("triangles")).cast("long").alias("triangles"))
