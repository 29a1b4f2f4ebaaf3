import pytest
from pyspark.sql import functions as F

from cairnflow.functions.geo import Reference
from cairnflow.operators import mesh
from cairnflow.plans import doors
from cairnflow.sources import sinks

BOX = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]


def test_door_on_the_boundary(spark):
    lines = [("in", 0, -2.0, 2.0), ("in", 1, 2.0, 2.0), ("through", 0, -2.0, 2.0), ("through", 1, 6.0, 2.0), ("on", 0, -2.0, 1.0), ("on", 1, -0.000001, 1.0), ("out", 0, -3.0, 1.0), ("out", 1, -1.0, 1.0), ("core", 0, 1.0, 2.0), ("core", 1, 1.5, 2.0)]
    ring = [{"lon": x, "lat": z} for x, z in [*BOX, BOX[0]]]
    rooms = spark.createDataFrame([(k, ring) for k in ("in", "through", "on", "out", "core")], "route_id string, ring array<struct<lon:double,lat:double>>")
    got = {r.route_id: (r.lon, r.lat, r.source.split("_")[1], r.confidence) for r in doors.room_doors(spark.createDataFrame(lines, "route_id string, at int, lon double, lat double"), rooms).collect()}
    assert got["in"] == (0.0, 2.0, "boundary", "high") and got["through"] == (4.0, 2.0, "boundary", "high")
    assert got["on"][2:] == ("endpoint", "high") and got["out"] == (0.0, 1.0, "boundary", "low") and got["core"] == (0.0, 2.0, "boundary", "medium")


POINTS = "route_id string, r int, l int, s int, p int, lon double, lat double, zlevel double, floor_name string, abutters string"


def test_entries_and_floor_runs(spark):
    out, ins = "OutsideOnVenue", "InsideBuilding"
    rows = [("a", 0, 0, k, 0, float(k), 0.0, 0.0, "G", ab) for k, ab in enumerate((out, ins, out, ins, ""))]
    rows += [("b", 0, 0, k, 0, float(k), 0.0, 0.0, "G", ab) for k, ab in enumerate((out, ins, out))]
    got = {r.route_id: r.lon for r in doors.entries(spark.createDataFrame(rows, POINTS)).collect()}
    assert got == {"a": 3.0}
    levels = [("x", 0, 0, 0, k, float(k), 0.0, z, "", "") for k, z in enumerate((80.0, 80.0, 90.0, 80.0, 80.0, 80.0, 90.0, 80.0))]
    run = doors.last_floor_run(spark.createDataFrame(levels, POINTS), F.lit(80.0)).collect()
    assert sorted(r.lon for r in run) == [3.0, 4.0, 5.0]  # the last point alone is no run


def test_clusters_merge_and_floors(spark):
    obs = [("s", k, x, 0.0, 174.0, -36.0, "0", t) for k, (x, t) in enumerate(((0.0, "r1"), (10.0, "r2"), (0.5, "r3"), (0.9, ""), (11.0, "r2")))]
    c = doors.cluster_entries(spark.createDataFrame(obs, "building string, ord int, x double, z double, lon double, lat double, floor_name string, target string"), "harbour").orderBy("entry_id").collect()
    assert [(r.entry_id, r.supporting_routes, list(r.targets), r.floor_name) for r in c] == [("harbour_entry_001", 3, ["r1", "r3"], "G"), ("harbour_entry_002", 2, ["r2"], "G")]
    one = spark.createDataFrame([("s", 0, 0.0, 0.0, "G"), ("s", 1, 500.0, 0.0, "G")], "building string, ord int, x double, z double, floor_name string")
    two = spark.createDataFrame([("s", 0, 2.0, 0.0, "9"), ("s", 1, 20.0, 0.0, "1")], "building string, ord int, x double, z double, floor_name string")
    rooms = spark.createDataFrame([("s", 0.0, 0.0), ("s", 10.0, 10.0)], "building string, x double, z double")
    kept = doors.merge_doors([one, two], rooms)
    assert sorted(r.x for r in kept.collect()) == [0.0, 20.0]
    flr = spark.createDataFrame([("s", "-1", 0), ("s", "1", 1), ("s", "2", 2)], "building string, floor_name string, floor_index int")
    got = {r.x: (r.floor_name, r.floor_index, r.node_name) for r in doors.normalise_doors(kept, flr, "harbour", ["src", "ord"]).collect()}
    assert got == {0.0: ("1", 1, "MainDoor"), 20.0: ("1", 1, "Door2")}


def test_wall_openings(spark):
    ring = lambda x0: [{"x": x0 + x / 2, "y": 0.0, "z": z / 2} for x, z in BOX]
    rooms = spark.createDataFrame([("r1", "e1", "1", ring(0.0)), ("r2", "e2", "1", ring(2.0)), ("r3", "e3", "1", ring(50.0))], "source_id string, external_id string, floor_name string, ring_local array<struct<x:double,y:double,z:double>>")
    found = spark.createDataFrame([("r1", None, 2.05, 1.0, "high", "route_boundary_intersection"), (None, "e3", 50.0, 1.1, "low", "nearest"), (None, "zz", 0.0, 0.0, "high", "route_boundary_intersection")], "source_id string, external_id string, x double, z double, confidence string, source string")
    got = sorted((r.floor_name, r.edge.a.x, r.edge.a.z, r.edge.b.x, r.edge.b.z) for r in doors.wall_openings(rooms, found).collect())
    assert got == [("1", 2000, 0, 2000, 2000), ("1", 50000, 0, 50000, 2000)]  # r1's edge is r2's too


def test_placement_and_audit(spark):
    cols = "building string, ord int, entry_id string, node_name string, display_name string, x double, z double, lon double, lat double, confidence string, supporting_routes int"
    rows = [("b", 0, "e0", "Door2", "Entry", 1.0, 2.0, 174.0, -36.0, "high", 3), ("b", 1, "e1", "MainDoor", "Main entrance", 3.0, 4.0, 174.001, -36.001, "high", 3), ("b", 2, "e2", "x", "y", 0.0, 0.0, 174.0, -36.0, "low", 99)]
    d = spark.createDataFrame(rows, cols)
    assert doors.placement_door(d).first().entry_id == "e1" and doors.placement_door(d, entry_id="e2").first().ord == 2
    with pytest.raises(ValueError):
        doors.placement_door(d, entry_id="nope").collect()
    ref = Reference(174.0, -36.0, (0.0, 0.0), (0.0, 0.0), 2.0)
    p = doors.placement(doors.placement_door(d, entry_id="e0"), ref).first()
    assert (p.origin_x, p.origin_z) == (-2.0, 4.0)
    side = "building string, cx double, cz double, width double, ex double, ez double"
    a = spark.createDataFrame([("b", 0.0, 0.0, 10.0, 0.0, 0.0), ("c", 0.0, 0.0, 10.0, 0.0, 0.0)], side)
    q = spark.createDataFrame([("b", 30.0, 0.0, 10.0, 0.5, 0.0), ("c", 0.0, 0.0, 30.0, 5.0, 0.0)], side)
    assert sorted((r.building, r.check) for r in doors.audit(a, q).collect()) == [("b", "centre offset"), ("c", "entrance error"), ("c", "size ratio")]
    assert doors.audit(a, q, exempt=("c",)).count() == 1


def test_attempts_and_documents(spark):
    t = spark.createDataFrame([("r", 0, "nearest", "medium"), ("r", 1, "route_boundary_intersection", "high"), ("r", 2, "route_boundary_intersection", "high"), ("s", 0, "nearest", "low"), ("s", 1, "nearest", "medium")], "room string, ord int, source string, confidence string")
    assert {r.room: r.ord for r in doors.best_attempt(t).collect()} == {"r": 1, "s": 1}
    b = spark.createDataFrame([("b-two", "Two", "failed", None), ("a-one", "One", "generated", 5)], "slug string, display_name string, status string, rooms int")
    assert sinks.campus_index(b).first().document.startswith('{"summary":{"failed":1,"generated":1},"buildings":[{"slug":"a-one"')
    assert "- [One](#a-one): generated, 5 rooms\n- [Two]" in sinks.catalog(b, "Buildings").first().document
    good = mesh.glb([{"name": "a", "material": "m", "vertices": [(0, 0, 0), (1, 0, 0), (0, 0, 1)], "triangles": [(0, 1, 2)]}])
    files = spark.createDataFrame([("good", bytearray(good)), ("cut", bytearray(good[:-4])), ("text", bytearray(b"hello world!"))], "path string, content binary")
    assert sorted(map(tuple, sinks.glb_issues(files).collect())) == [("cut", "length differs"), ("text", "no glTF header")]
