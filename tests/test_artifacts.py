"""Slabs, floor files, packages, nearest boundaries and rings, landed graph details and inventory."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from cairnflow.functions.geo import Reference
from cairnflow.operators import graph, mesh, spatial
from cairnflow.plans import artifacts, building, campus, doors, surfaces
from cairnflow.plans.building import Dataset
from cairnflow.sources import locations, sinks
from cairnflow.sources.config import CampusConfig

XZ = "array<struct<x:double,z:double>>"
XYZ = "array<struct<x:double,y:double,z:double>>"


def box(x, z, w=4.0, h=4.0, y=None):
    pts = [(x, z), (x + w, z), (x + w, z + h), (x, z + h)]
    return [{"x": a, "z": b} if y is None else {"x": a, "y": y, "z": b} for a, b in pts]


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def test_outlines():
    assert artifacts.outlines([]) == []
    assert artifacts.outlines([(0, 0), (1, 0)]) == [[(0, 0), (2, 0), (2, 1), (0, 1)]]
    corner = artifacts.outlines([(0, 0), (1, 1)])
    assert len(corner) == 2 and all(len(r) == 4 for r in corner)
    ring = [(i, j) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    assert [area(r) for r in artifacts.outlines(ring)] == [9.0]
    rnd = random.Random(5)
    for _ in range(30):
        cells = {(rnd.randrange(9), rnd.randrange(9)) for _ in range(rnd.randrange(1, 60))}
        left, parts = set(cells), []
        while left:
            part, front = set(), [left.pop()]
            while front:
                i, j = front.pop()
                part.add((i, j))
                for n in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                    if n in left:
                        left.discard(n)
                        front.append(n)
            parts.append(part)
        outer = artifacts.outlines(list(cells))
        assert len(outer) == len(parts)
        sizes = [area(r) for r in outer]
        assert sizes == sorted(sizes, reverse=True) and sum(sizes) >= len(cells)


def dataset(spark):
    cols = f"building string, floor_name string, external_id string, x double, y double, z double, ring_local {XYZ}"
    rooms = spark.createDataFrame([("B", "1", "r1", 2.0, 4.0, 2.0, box(0.0, 0.0, y=4.0)), ("B", "1", "r2", None, None, None, box(4.0, 0.0, y=4.0)), ("B", "1", "r3", 30.0, 4.0, 1.0, box(30.0, 0.0, 2.0, 2.0, 4.0)), ("B", "2", "r4", 2.0, 8.0, 2.0, box(0.0, 0.0, y=8.0)), ("B", "3", "r5", 2.0, 12.0, 2.0, [])], cols)
    portals = spark.createDataFrame([("B", "2", "p1", 1.0, 8.0, 1.0, box(1.0, 1.0, 1.0, 1.0, 8.0), "stair")], cols + ", kind string")
    return Dataset(spark.createDataFrame([("B", "2", box(-1.0, -1.0, 9.0, 9.0, 8.0))], f"building string, floor_name string, ring_local {XYZ}"), rooms, portals, rooms.limit(0))


def test_floor_slabs_and_markers(spark):
    ds = dataset(spark)
    got = {(r.floor_name, r.name): r for r in artifacts.floor_slabs(ds).collect()}
    assert sorted(got) == [("1", "floor_1"), ("1", "floor_1_part_2"), ("2", "floor_2")]
    big = got["1", "floor_1"]
    top = [(p["x"], p["z"]) for p in big.vertices[: len(big.vertices) // 2]]
    assert abs(abs(area(top)) - 8.5 * 4.5) < 3 and {round(p["y"], 6) for p in big.vertices} == {4.0, 3.88}
    assert len(got["2", "floor_2"].vertices) == 8
    assert sorted(r.name for r in artifacts.markers(ds).collect()) == ["marker_anchor_r1_1", "marker_anchor_r3_1", "marker_anchor_r4_2", "marker_anchor_r5_3", "marker_stair_p1_2"]
    no_own = Dataset(ds.floors.drop("ring_local"), ds.rooms.limit(0), ds.portals.limit(0), ds.issues)
    assert artifacts.floor_slabs(no_own).count() == 0


def test_floor_artifacts(spark):
    schema = f"floor_name string, name string, material string, vertices {XYZ}, faces array<array<int>>"
    visual = spark.createDataFrame([("1", "a", "room", box(0.0, 0.0, y=4.0), [[0, 1, 2, 3]]), ("B1", "b", "room", box(0.0, 0.0, y=-4.0), [[0, 1, 2, 3]])], schema)
    routes = spark.createDataFrame([("1", "w", "route", box(1.0, 1.0, 1.0, 1.0, 4.0), [[0, 1, 2, 3]])], schema)
    table = spark.createDataFrame([("1", 1, 4.0), ("B1", -1, -4.0)], "floor_name string, floor_index int, height double")
    got = {r.filename: json.dumps(mesh.read_glb(bytes(r.content))) for r in artifacts.floor_artifacts(visual, routes, table, "g").collect()}
    assert sorted(got) == ["g_floor_1_route_debug.glb", "g_floor_1_visual.glb", "g_floor_1_walkable_paths.glb", "g_floor_neg1_visual.glb"]
    assert "walkable_path" in got["g_floor_1_walkable_paths.glb"] and '"route"' not in got["g_floor_1_walkable_paths.glb"]
    assert '"a"' in got["g_floor_1_route_debug.glb"] and '"w"' in got["g_floor_1_route_debug.glb"]
    p = visual.select(artifacts.lifted(F.col("vertices"), F.lit(4.0), 0.08).alias("v")).first().v
    assert {q["y"] for q in p} == {0.08}


def test_package(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    ok = mesh.glb([{"name": "m", "material": "room", "vertices": [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)], "triangles": [[0, 1, 2]]}])
    (src / "h_visual.glb").write_bytes(ok)
    (src / "h_nav.glb").write_bytes(ok[:12] + b"\xff\xff\x00\x00" + b"TEXT" + ok[20:])
    (src / "h_manifest.json").write_text("{}")
    files = [("h_visual.glb", "h_full_visual.glb", True), ("h_topology.json", "h_topology.json", False)]
    assert artifacts.package(spark, str(src), str(dst), files) == ["h_full_visual.glb"] and (dst / "h_full_visual.glb").read_bytes() == ok
    with pytest.raises(FileNotFoundError, match="h_gone"):
        artifacts.package(spark, str(src), str(dst / "other"), [*files, ("h_gone.glb", "x", True)])
    assert not (dst / "other").exists()
    assert artifacts.single(spark, str(src), "*_manifest.json").endswith("/h_manifest.json")
    with pytest.raises(FileNotFoundError):
        artifacts.single(spark, str(src), "*.tscn")
    with pytest.raises(ValueError, match="2 files"):
        artifacts.single(spark, str(src), "*.glb")
    found = artifacts.package_issues(spark.read.format("binaryFile").load(str(src)).select("path", "content"), "h")
    assert sorted(map(tuple, found.collect())) == [("README.md", "missing"), ("h_nav.glb", "JSON chunk exceeds the file"), ("h_nav.glb", "first chunk is not JSON")]
    tiny = spark.createDataFrame([("t", bytearray(b"glTF")), ("n", None)], "path string, content binary")
    assert sorted(map(tuple, sinks.glb_problems(tiny).collect())) == [("n", "too small"), ("t", "too small")]


def point_to_segment(px, pz, a, b):
    dx, dz = b[0] - a[0], b[1] - a[1]
    n = dx * dx + dz * dz
    t = 0.0 if n == 0 else max(0.0, min(1.0, ((px - a[0]) * dx + (pz - a[1]) * dz) / n))
    return ((px - a[0] - t * dx) ** 2 + (pz - a[1] - t * dz) ** 2) ** 0.5


def test_nearest_ring_and_segments(spark):
    rnd = random.Random(11)
    rings = [(k, [(x, z), (x + w, z), (x + w, z + w), (x, z + w)]) for k in range(12) for x, z, w in [(rnd.uniform(-40, 40), rnd.uniform(-40, 40), rnd.uniform(2, 15))]]
    pts = [(n, rnd.uniform(-90, 90), rnd.uniform(-90, 90)) for n in range(60)] + [(99, None, 1.0)]
    r = spark.createDataFrame([(k, [{"x": x, "z": z} for x, z in c]) for k, c in rings], f"ring_id long, ring {XZ}")
    p = spark.createDataFrame(pts, "id long, x double, z double")
    got = {q.id: (q.ring_id, q.distance) for q in spatial.nearest_ring(p, r, "id", "ring_id", "x", "z", "ring", 3.0).collect()}
    assert len(got) == len(pts) and got[99] == (None, None)
    for n, x, z in pts[:-1]:
        inside = [k for k, c in rings if c[0][0] <= x <= c[2][0] and c[0][1] <= z <= c[2][1]]
        best = (0.0, min(inside)) if inside else min((min(point_to_segment(x, z, a, b) for a, b in zip(c, c[1:] + c[:1], strict=True)), k) for k, c in rings)
        assert got[n][0] == best[1] and abs(got[n][1] - best[0]) < 1e-9, n
    assert all(q.ring_id is None for q in spatial.nearest_ring(p, r.limit(0), "id", "ring_id", "x", "z", "ring", 3.0).collect())
    cross = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 0.0)], "l string, x1 double, z1 double, x2 double, z2 double")
    other = spark.createDataFrame([("b", 4.0, -1.0, 4.0, 1.0), ("c", 400.0, 0.0, 401.0, 0.0)], "r string, u1 double, v1 double, u2 double, v2 double")
    near = spatial.nearest_segments(cross, other, "l", "r", ["x1", "z1", "x2", "z2"], ["u1", "v1", "u2", "v2"], 1.0).first()
    assert (near.r, near.distance, near.x, near.z) == ("b", 0.0, 4.0, 0.0)


def test_boundary_doors(spark):
    rooms = spark.createDataFrame([("a", "1", box(0.0, 0.0)), ("b", "1", box(50.0, 0.0)), ("c", "1", box(10.5, 0.0)), ("d", "9", box(0.0, 0.0))], f"room string, floor_name string, ring {XZ}")
    origins = spark.createDataFrame([("hall", "1", box(4.0, 1.0, 6.0)), ("a", "1", box(0.0, 0.0)), ("lift", "1", [{"x": 50.0, "z": 90.0}])], f"other string, floor_name string, ring {XZ}")
    got = {r.room: r for r in surfaces.boundary_doors(rooms, origins).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert (got["a"].other, got["a"].source, got["a"].confidence, got["a"].x, got["a"].z) == ("hall", "geometry_shared_boundary_midpoint", "medium", 4.0, 2.5)
    assert (got["c"].other, got["c"].confidence, got["c"].distance, got["c"].x) == ("hall", "medium", 0.5, 10.5)
    assert (got["b"].other, got["b"].confidence, got["b"].distance, got["b"].x) == ("hall", "low", 40.0, 50.0)


def test_included_meshes(spark):
    df = spark.createDataFrame([("1", "a", "floor", box(0.0, 0.0, y=0.0), [[0, 1, 2, 3]]), ("1", "b", "wall", box(9.0, 0.0, y=0.0), [[0, 1, 2, 3]])], f"f string, name string, material string, vertices {XYZ}, faces array<array<int>>")
    assert mesh.navigation_resources(df, "f", include=F.col("material") == "floor")[1].count() == 1
    assert mesh.navigation_resources(df, "f")[1].count() == 2
    with pytest.raises(ValueError):
        mesh.navigation_resources(df, "f", ["1"], include=F.col("material") == "door")


def test_graph_details(spark):
    body = json.dumps({"bbox": [1, 2, 3, 4], "entryPoints": [{"coordinates": [7.5, 8.5, 10]}, {"coordinates": [5]}, {"coordinates": [1, 2]}, 3]})
    entries, graphs = locations.graph_details(spark.createDataFrame([("g", body), ("bad", "{"), ("none", "{}")], "graph_id string, body string"))
    assert sorted(map(tuple, entries.collect())) == [("g", 0, 7.5, 8.5, 10.0), ("g", 2, 1.0, 2.0, 0.0)]
    assert sorted((r.graph_id, r.bbox, r.corrupt) for r in graphs.collect()) == [("bad", None, True), ("g", [1.0, 2.0, 3.0, 4.0], False), ("none", None, False)]


def test_inventory_reads_through(spark, tmp_path):
    asked = []

    def items(name, docs):
        def ask():
            asked.append(name)
            folder = tmp_path / name
            folder.mkdir(exist_ok=True)
            (folder / "all.json").write_text(json.dumps(docs))
            return locations.read_items(spark, str(folder), locations.INVENTORY_KEYS)

        return ask

    b = items("b", [{"id": "i1", "administrativeId": "77", "venueId": "v", "name": "Mill"}, {"id": "i2", "administrativeId": "78", "venueId": "w", "name": "Barn"}])
    v = items("v", [{"id": "v", "name": "North"}])
    urls = dict(sync=["http://s/b", "http://s/v"], locations_url="http://s/l", details_url="http://s/d/{id}.json", solution="sol", take=50)
    for _ in range(2):
        got = locations.inventory(spark, str(tmp_path / "inv"), b, v, ["77"], **urls).collect()
        assert [(r.admin_id, r.venue_name) for r in got] == [("77", "North")]
        assert got[0].source_urls == ["http://s/b?solutionId=sol&v=5", "http://s/v?solutionId=sol&v=5", "http://s/l?building=77&take=50", "http://s/d/i1.json"]
    assert sorted(asked) == ["b", "v"]


def test_placed_lines(spark):
    cfg = CampusConfig("g", Reference(174.0, -36.0, (1.0, 2.0), (10.0, 20.0), 2.0))
    lines = spark.createDataFrame([("u", 0, 10.0, 20.0, " "), ("u", 1, 30.0, 20.0, "steps"), ("u", 2, None, 1.0, "steps")], "line string, at int, x double, z double, class string")
    got = campus.placed_lines(lines, cfg)
    assert [r["class"] for r in got.orderBy("at").collect()] == ["underpass", "steps"]
    from cairnflow.functions import geo

    x, z = geo.to_campus(F.col("lon"), F.col("lat"), cfg.reference)
    assert [(round(r.x, 6), round(r.z, 6)) for r in got.orderBy("at").select(x.alias("x"), z.alias("z")).collect()] == [(10.0, 20.0), (30.0, 20.0)]
    assert campus.extra_segments(got, 5).first().ord == 5


def test_distances_and_probe(spark):
    rnd = random.Random(3)
    spots = {n: (rnd.uniform(0, 50), rnd.uniform(0, 50)) for n in range(40)}
    links = {(min(u, v), max(u, v)): rnd.uniform(1, 20) for u, v in ((rnd.randrange(30), rnd.randrange(30)) for _ in range(60)) if u != v}
    edges = spark.createDataFrame([(u, v, w) for (u, v), w in links.items()], "a long, b long, length double")
    best = {(s, s): 0.0 for s in (0, 7, 35)}
    for s in (0, 7, 35):
        for _ in range(40):
            for (u, v), w in links.items():
                for p, q in ((u, v), (v, u)):
                    if (s, p) in best:
                        best[s, q] = min(best.get((s, q), 1e18), best[s, p] + w)
    starts = spark.createDataFrame([(0,), (7,), (35,), (7,), (None,)], "id long")
    got = {(r.source, r.node): r.distance for r in graph.distances(starts, edges).collect()}
    assert got.keys() == best.keys() and all(abs(got[k] - best[k]) < 1e-9 for k in got)
    near = {(r.source, r.node) for r in graph.distances(starts, edges, within=15.0).collect()}
    assert near == {k for k, d in best.items() if d <= 15.0}

    nodes = spark.createDataFrame([(0, 0.0, 0.0), (1, 100.0, 0.0), (2, 100.0, 10.0), (3, 0.0, 10.0), (4, 500.0, 0.0)], "id long, x double, z double")
    road = spark.createDataFrame([(0, 1, 100.0), (1, 2, 10.0), (2, 3, 100.0)], "a long, b long, length double")
    doors = spark.createDataFrame([("A", 0.0, 1.0, True), ("B", 0.0, 9.0, True), ("C", 99.0, 0.0, True), ("D", 500.0, 0.0, True), ("E", 900.0, 0.0, True), ("A", 9.0, 9.0, False)], "building string, x double, z double, is_primary boolean")
    found = {(r.a, r.b, r.check): r.value for r in campus.probe(nodes, road, doors, 5.0, strict={("A", "C"): 1.01}).collect()}
    assert found.keys() == {("A", "B", "detour"), ("A", "C", "detour"), ("E", "E", "snap"), ("A", "D", "path"), ("B", "D", "path"), ("C", "D", "path")}
    assert abs(found["A", "B", "detour"] - 212 / 8) < 1e-9 and found["E", "E", "snap"] == 400.0
    assert campus.probe(nodes, road, doors.where("building = 'A'"), 5.0).isEmpty()


def test_all_meshes(spark):
    got = artifacts.all_meshes(dataset(spark)).groupBy("material").count().collect()
    assert {r.material: r["count"] for r in got} == {"floor": 3, "room": 4, "wall": 5, "stair": 2, "anchor": 4}
    assert artifacts.all_meshes(dataset(spark), with_markers=False).where("name like 'marker%'").isEmpty()


def test_triangulate_face():
    wall = [(0.0, 0.0, 0.0), (4.0, 0.0, 0.0), (4.0, 3.0, 0.0), (0.0, 3.0, 0.0)]

    def vector(t, v):
        a, b, c = (v[i] for i in t)
        u, w = [b[k] - a[k] for k in range(3)], [c[k] - a[k] for k in range(3)]
        return [u[(k + 1) % 3] * w[(k + 2) % 3] - u[(k + 2) % 3] * w[(k + 1) % 3] for k in range(3)]

    for face, sign in (([0, 1, 2, 3], 1), ([3, 2, 1, 0], -1)):
        got = mesh.triangulate_face(face, wall)
        assert len(got) == 2 and sum(vector(t, wall)[2] for t in got) == sign * 24
    assert mesh.triangulate_face([0, 0, 1, 9, 2, 2, 3, 0, -1], wall) == mesh.triangulate_face([0, 1, 2, 3], wall)
    assert mesh.triangulate_face([0, 1, 1], wall) == [] and mesh.triangulate_face([], wall) == []
    ell = [(0.0, 0.0, 0.0), (0.0, 0.0, 4.0), (0.0, 2.0, 4.0), (0.0, 2.0, 2.0), (0.0, 4.0, 2.0), (0.0, 4.0, 0.0)]
    for face in (range(6), range(5, -1, -1)):
        got = mesh.triangulate_face(face, ell)
        signs = {vector(t, ell)[0] > 0 for t in got}
        assert len(got) == 4 and len(signs) == 1 and sum(abs(vector(t, ell)[0]) for t in got) / 2 == 12
    line = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (2.0, 0.0, 0.0), (3.0, 0.0, 0.0)]
    assert mesh.triangulate_face([0, 1, 2, 3], line) == [[0, 1, 2], [0, 2, 3]]


def test_crossings_of_long_lines(spark):
    rnd = random.Random(8)
    lines = [(n, *(rnd.uniform(-60, 60) for _ in range(4))) for n in range(60)] + [(60, -50.0, 3.0, 50.0, 3.0), (61, 8.0, -50.0, 8.0, 50.0), (62, -48.0, -48.0, 48.0, 48.0)]

    def side(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def cross(p, q):
        a, b, c, d = p[1:3], p[3:5], q[1:3], q[3:5]
        return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0

    names = ["x1", "z1", "x2", "z2"]
    left = spark.createDataFrame(lines, "l long, x1 double, z1 double, x2 double, z2 double")
    right = left.toDF("r", "u1", "v1", "u2", "v2")
    got = {(r.l, r.r) for r in spatial.segment_intersect_join(left, right, "l", "r", names, ["u1", "v1", "u2", "v2"], 4.0).select("l", "r").collect()}
    assert got == {(p[0], q[0]) for p in lines for q in lines if p[0] != q[0] and cross(p, q)}
    n = left.where("l = 62").select(F.size(spatial._cells_of_line(*map(F.col, names), 4.0)).alias("n")).first().n
    assert n < 100


def test_dataset_is_read_back(spark, tmp_path):
    ds = dataset(spark)
    number = lambda df: df.withColumn("floor_index", F.col("floor_name").cast("int"))
    ds = Dataset(ds.floors, number(ds.rooms), number(ds.portals), ds.issues)
    building.write_dataset(ds, str(tmp_path / "ds"))
    again = building.read_dataset(spark, str(tmp_path / "ds"))
    for name in ("floors", "rooms", "portals", "issues"):
        a, b = getattr(ds, name), getattr(again, name)
        assert sorted(map(repr, b.select(a.columns).collect())) == sorted(map(repr, a.collect()))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        building.read_dataset(spark, str(tmp_path / "none"))


def test_transforms(spark):
    ref = Reference(174.0, -36.0, (1.0, 2.0), (10.0, 20.0), 2.0)
    d = spark.createDataFrame([("A", "e1", 174.0, -36.0, 3.0, 1.5, 4.0), ("B", "e2", 174.0, -36.0, 3.0, None, 4.0)], "building string, entry_id string, lon double, lat double, x double, y double, z double")
    got = {r.building: r for r in doors.transforms(d, ref, height=7.0, overrides={"B": (1, 2, 3)}).collect()}
    assert got["A"].basis == [[2.0, 0.0, 0.0], [0.0, 2.0, 0.0], [0.0, 0.0, -2.0]] and got["B"].origin == [1.0, 2.0, 3.0]
    assert got["A"].origin == [ref.x - 6.0, 4.0, ref.z + 8.0]


def test_catalog_pages(spark):
    schema = "admin_id string, display_name string, slug string, status string, venue_name string, rooms int, floors int, portals int, artifacts map<string,string>, warnings array<string>, errors array<string>, source_urls array<string>"
    rows = [("20", "Mill (old)", "20-mill", "generated", "North", 5, 2, 1, {"nav": "m/n.glb", "manifest": "m/m.json"}, ["w1", "w2"], [], ["u1", "u2", "u3", "u4", "u5"]), ("10", "Barn", "10-barn", "failed", None, None, None, None, None, None, ["bad"], None)]
    text = sinks.catalog_pages(spark.createDataFrame(rows, schema), "Campus").first().document
    assert text.startswith("# Campus\n\n- total: 2\n- generated: 1\n- skipped: 0\n- failed: 1\n\n## Index\n\n- [10 - Barn](#10-barn): failed, 0 rooms, 0 floors, 0 portals\n- [20 - Mill (old)](#20-mill-old)")
    assert '<a id="20-mill-old"></a>\n### 20 - Mill (old)' in text and "[manifest](m/m.json), [nav](m/n.glb)" in text and "[source 4](u4)" in text and "u5" not in text
    assert "- Notes: 1 errors, the first: bad" in text and "- Notes: 2 warnings, the first: w1" in text and text.count("- Files: none") == 1
    assert "## Buildings" in sinks.catalog_pages(spark.createDataFrame([], schema), "Campus").first().document


def test_bridges_against_plain_python(spark):
    rnd = random.Random(21)
    spots = {(k, n): (rnd.uniform(0, 90), rnd.uniform(0, 90)) for k in "ab" for n in range(30)}
    links = [(k, *sorted(rnd.sample(range(30), 2))) for k in "ab" for _ in range(16)]
    want = set()
    for k in "ab":
        part = {n: {n} for n in range(30)}
        for _, u, v in (e for e in links if e[0] == k):
            both = part[u] | part[v]
            for n in both:
                part[n] = both
        islands = sorted({frozenset(s) for s in part.values()}, key=lambda s: (-len(s), min(s)))
        main = set(islands[0])
        for island in islands[1:]:
            gap = lambda u, v: ((spots[k, u][0] - spots[k, v][0]) ** 2 + (spots[k, u][1] - spots[k, v][1]) ** 2) ** 0.5
            d, u, v = min((gap(u, v), u, v) for u in island for v in main)  # noqa: B023
            want.add((k, min(u, v), max(u, v), round(d, 9)))
            main |= island
    nodes = spark.createDataFrame([(k, n, *p) for (k, n), p in spots.items()], "g string, id long, x double, z double")
    edges = spark.createDataFrame(links, "g string, a long, b long")
    assert {(r.g, r.a, r.b, round(r.length, 9)) for r in graph.bridge_islands(nodes, edges, "g").collect()} == want


def test_simplify_against_plain_recursion():
    def plain(p, tolerance):
        if len(p) < 3:
            return p
        (ax, az), (bx, bz) = p[0], p[-1]
        d, at = max((abs((bx - ax) * (az - z) - (ax - x) * (bz - az)) / math.hypot(bx - ax, bz - az), -i) for i, (x, z) in enumerate(p[1:-1], 1))
        return [p[0], p[-1]] if d <= tolerance else plain(p[: -at + 1], tolerance)[:-1] + plain(p[-at:], tolerance)

    rnd = random.Random(2)
    for n in (2, 3, 10, 60, 200):
        line = [(float(i), rnd.uniform(0, 9)) for i in range(n)]
        for tolerance in (0.5, 2.0, 6.0):
            assert mesh.simplify(line, tolerance) == plain(line, tolerance)
