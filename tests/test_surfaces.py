import json

from pyspark.sql import functions as F

from cairnflow.operators import mesh
from cairnflow.plans import surfaces
from cairnflow.plans.building import Dataset

XZ = "array<struct<x:double,z:double>>"
XYZ = "array<struct<x:double,y:double,z:double>>"


def box(x, z, w=4.0, h=4.0, y=None):
    pts = [(x, z), (x + w, z), (x + w, z + h), (x, z + h)]
    return [{"x": a, "z": b} if y is None else {"x": a, "y": y, "z": b} for a, b in pts]


def test_clip(spark):
    seg = spark.createDataFrame([("f", 0, -2.0, 2.0, 6.0, 2.0), ("f", 1, 1.0, 1.0, 2.0, 2.0), ("f", 2, 9.0, 9.0, 10.0, 9.0)], "floor string, seg int, x1 double, z1 double, x2 double, z2 double")
    got = sorted((r.seg, r.x1, r.x2) for r in surfaces.clip_segments(seg, spark.createDataFrame([("f", box(0.0, 0.0))], f"floor string, ring {XZ}"), "floor").collect())
    assert got == [(0, 0.0, 4.0), (1, 1.0, 2.0)]


def test_shared_boundary(spark):
    rooms = spark.createDataFrame([("a", "1", box(0.0, 0.0)), ("b", "1", box(4.0, 1.0)), ("c", "1", box(50.0, 0.0)), ("d", "2", box(4.0, 0.0))], f"room string, floor_name string, ring {XZ}")
    got = sorted((r.room, r.other, r.x, r.z, r.length) for r in surfaces.shared_boundaries(rooms).collect())
    assert got == [("a", "b", 4.0, 2.5, 3.0), ("b", "a", 4.0, 2.5, 3.0)]


def test_cells_and_bridges(spark):
    seg = spark.createDataFrame([("1", 0.0, 0.25, 5.0, 0.25), ("1", 9.0, 0.25, 12.0, 0.25), ("2", 0.0, 0.0, 3.0, 0.0)], "floor_name string, x1 double, z1 double, x2 double, z2 double")
    cells = surfaces.walkable_cells(seg, None, 0.5, 0.5)
    comp = surfaces.cell_components(cells).groupBy("floor_name").agg(F.countDistinct("component").alias("n"))
    assert {r.floor_name: r.n for r in comp.collect()} == {"1": 2, "2": 1}
    links = surfaces.bridge_surfaces(cells, 0.5).collect()
    assert len(links) == 1 and links[0].floor_name == "1" and 3 <= abs(links[0].x2 - links[0].x1) <= 4
    wall = spark.createDataFrame([("1", 2.6, -2.0, 2.6, 2.0)], "floor_name string, x1 double, z1 double, x2 double, z2 double")
    cut = surfaces.cell_components(surfaces.walkable_cells(seg.where("floor_name = '1'"), wall, 0.5, 0.5))
    assert cut.select("component").distinct().count() == 3


def test_meshes_per_floor(spark):
    rows = [("b", "1", "r1", box(0.0, 0.0, y=4.2)), ("b", "1", "r2", [*box(4.0, 0.0, y=4.2), box(4.0, 0.0, y=4.2)[0]])]
    rooms = spark.createDataFrame(rows, f"building string, floor_name string, external_id string, ring_local {XYZ}")
    portals = rooms.limit(0).withColumn("kind", F.lit("stair"))
    opening = spark.createDataFrame([("1", ((4000, 0), (4000, 4000)))], "floor_name string, edge struct<a:struct<x:long,z:long>,b:struct<x:long,z:long>>")
    meshes = surfaces.dataset_meshes(Dataset(rooms, rooms, portals, rooms), opening)
    faces = {r.name: len(r.faces) for r in meshes.collect()}
    assert faces == {"plate_r1_1": 1, "plate_r2_1": 1, "wall_r1_1": 3, "wall_r2_1": 3}
    f = surfaces.floor_files(meshes).first()
    doc = mesh.read_glb(bytes(f.content))
    assert len(doc["meshes"]) == 4 and doc["accessors"][0]["min"][1] == 0


def test_small_things(spark, tmp_path):
    got = [r.t for r in spark.createDataFrame([(0.1234567,), (2.0,), (-0.0000001,), (10.5,)], "x double").select(surfaces.number_text(F.col("x")).alias("t")).collect()]
    assert got == ["0.123457", "2", "0", "10.5"]
    (tmp_path / "second.json").write_text(json.dumps({"rooms": [{"id": 1}, 5]}))
    assert surfaces.first_existing(spark, [str(tmp_path / "first.json"), str(tmp_path / "second.json")]).count() == 1
    assert surfaces.first_existing(spark, [str(tmp_path / "none.json")]).count() == 0
    assert surfaces.snapshot({"a": spark.range(3)}, str(tmp_path / "s"))["a"].count() == 3
