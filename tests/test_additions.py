"""Operators for sources that stop, lost rows, walls, navigation polygons, anchors and pairs of buildings."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from cairnflow.functions import geo
from cairnflow.operators import graph, mesh, spatial
from cairnflow.operators import relational as rel
from cairnflow.plans import campus, doors, surfaces
from cairnflow.sources.config import CampusConfig
from cairnflow.sources.locations import PagedSource

FEATURES = {"q1": 5, "q2": 4, "q3": 0}


def fetch(building, take, skip):
    n = max(0, min(take, FEATURES[building] - skip))
    return json.dumps({"features": [{"id": f"{building}-{skip + i}"} for i in range(n)]})


def test_paging_stops_on_a_short_page(spark):
    spark.dataSource.register(PagedSource)
    read = lambda **kw: spark.read.format("paged").options(fetch="test_additions:fetch", buildings="q1,q2,q3", **kw).load()
    spark.sparkContext.addPyFile(__file__)
    got = sorted((r.building, r.skip, len(json.loads(r.body)["features"])) for r in read(take="2").collect())
    assert got == [("q1", 0, 2), ("q1", 2, 2), ("q1", 4, 1), ("q2", 0, 2), ("q2", 2, 2), ("q2", 4, 0), ("q3", 0, 0)]
    assert read(take="1", pages="2").count() == 2 + 2 + 1


def test_nearest_one_has_no_limit_and_loses_no_row(spark):
    rng = random.Random(1)
    left = [(i, rng.uniform(-9000, 9000), rng.uniform(-9000, 9000)) for i in range(25)] + [(90, None, 1.0), (91, float("nan"), 1.0)]
    right = [(100 + i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(10)] + [(500, 8000.0, 8000.0)]
    l = spark.createDataFrame(left, "i long, x double, z double")
    r = spark.createDataFrame(right, "j long, u double, v double")
    got = {x.i: (x.j, x.distance) for x in spatial.nearest_one(l, r, "i", "j", "x", "z", "u", "v", 0.5).collect()}
    assert set(got) == {i for i, *_ in left} and got[90] == got[91] == (None, None)
    for i, x, z in left[:25]:
        d, j = min((math.hypot(u - x, v - z), j) for j, u, v in right)
        assert got[i][0] == j and abs(got[i][1] - d) < 1e-9
    none = spatial.nearest_one(l, r.limit(0), "i", "j", "x", "z", "u", "v", 1.0).collect()
    assert len(none) == len(left) and {x.j for x in none} == {None}
    assert spatial.nearest_one(l.limit(0), r, "i", "j", "x", "z", "u", "v", 1.0).count() == 0


def test_priority_join_keeps_one_row_per_left_row(spark):
    left = spark.createDataFrame([(1, "a", "p"), (2, "zz", "p"), (3, None, None)], "id long, k1 string, k2 string")
    right = spark.createDataFrame([("a", 5), ("a", 4), ("p", 9), ("p", 7), ("p", 8), (None, 1)], "k string, v long")
    out = rel.priority_join(left, right, [("k1", "k"), ("k2", "k")], ["v"])
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, 4), (2, 7), (3, None)]
    last = rel.priority_join(left, right, [("k1", "k"), ("k2", "k")], ["v"], [F.desc("v")])
    assert sorted((r.id, r.v) for r in last.collect()) == [(1, 5), (2, 9), (3, None)]


def test_percentiles_number_the_column_once(spark):
    df = spark.createDataFrame([(float(x),) for x in range(37)] + [(None,)], "v double")
    assert sorted(map(tuple, rel.index_percentiles(df, "v", [0.0, 0.5, 0.9]).collect())) == [(0.0, 0.0), (0.5, 18.0), (0.9, 33.0)]


BOX = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0)]
MESH = "f string, name string, material string, vertices array<struct<x:double,y:double,z:double>>, faces array<array<int>>"


def box_mesh(floor, name, material="wall"):
    low = [(x, 0.0, z) for x, z in BOX]
    high = [(x, 2.0, z) for x, z in BOX]
    sides = [[i, (i + 1) % 4, 4 + (i + 1) % 4, 4 + i] for i in range(4)]
    return (floor, name, material, low + high, [[0, 1, 2, 3], *sides])


def test_wall_lines(spark):
    got = mesh.wall_lines(spark.createDataFrame([box_mesh("1", "w"), box_mesh("1", "r", "room")], MESH), ["f"]).collect()
    assert {(r.x1, r.z1, r.x2, r.z2) for r in got} == {(0.0, 0.0, 4.0, 0.0), (4.0, 0.0, 4.0, 3.0), (0.0, 3.0, 4.0, 3.0), (0.0, 0.0, 0.0, 3.0)}
    assert {r.name for r in got} == {"w"} and len(got) == 4


def test_navigation_resources(spark):
    flat = [(x, 1.0, z) for x, z in BOX]
    rows = [("1", "a", "walk", flat, [[0, 1, 2, 3]]), ("1", "b", "walk", flat[::-1], [[0, 1, 2, 3], [0, 0, 1]]), ("2", "c", "walk", [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (1.0, 0.0, 1.0)], [[0, 1, 2]])]
    df = spark.createDataFrame(rows, MESH)
    vertices, polygons = mesh.navigation_resources(df, "f", ["1", "2"])
    at = {(r.f, r.vertex): (r.x, r.z) for r in vertices.collect()}
    assert len(at) == 7
    polys = {(r.f, r.polygon): list(r.indexes) for r in polygons.collect()}
    assert set(polys) == {("1", 0), ("2", 0)}
    for (f, _), ids in polys.items():
        ring = [at[f, i] for i in ids]
        assert sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) < 0
    with pytest.raises(ValueError, match="required floors"):
        mesh.navigation_resources(df, "f", ["1", "7"])


def test_doors_beyond_the_cap_are_reported(spark):
    nodes = spark.createDataFrame([("g", 0, 0.0, 0.0)], "graph string, id long, x double, z double")
    d = spark.createDataFrame([("g", 1, 3.0, 0.0), ("g", 2, 90.0, 0.0)], "graph string, door long, x double, z double")
    s = graph.entrance_spurs(nodes, d, "graph", ["door"], 5.0)
    assert [r.door for r in graph.unconnected(d, s).collect()] == [2]


def test_relocated_anchors(spark):
    d = spark.createDataFrame([("b", "1", "near", 0.0, 0.0), ("b", "1", "far", 200.0, 0.0), ("b", "9", "lone", 0.0, 0.0)], "building string, floor_name string, door string, x double, z double")
    surface = spark.createDataFrame([("b", "1", 1, 3.0, 4.0), ("b", "1", 2, 6.0, 8.0)], "building string, floor_name string, point long, x double, z double")
    moved, told = doors.relocate(d, surface)
    assert moved.columns == d.columns and [tuple(r) for r in moved.collect()] == [("b", "1", "near", 3.0, 4.0)]
    assert {(r.door, r.status) for r in told.collect()} == {("near", "ok"), ("far", "too_far"), ("lone", "no_surface")}
    with pytest.raises(ValueError, match="far too_far"):
        doors.relocate(d.where("door <> 'near'"), surface)


def test_short_routes_near_the_footprint_pass_whole(spark):
    rings = spark.createDataFrame([("1", BOX)], "floor_name string, ring array<struct<x:double,z:double>>")
    seg = [("1", 0, -2.0, 1.0, 6.0, 1.0), ("1", 1, 10.0, 1.0, 11.0, 1.0), ("1", 2, 13.0, 1.0, 14.0, 1.0), ("1", 3, -20.0, 1.0, 20.0, 1.0), ("1", 4, 1.0, 1.0, 1.01, 1.0)]
    df = spark.createDataFrame(seg, "floor_name string, seg long, x1 double, z1 double, x2 double, z2 double")
    got = sorted((r.seg, round(r.x1, 6), round(r.x2, 6)) for r in surfaces.clip_routes(df, rings).collect())
    assert got == [(0, -2.0, 6.0), (1, 10.0, 11.0), (3, 0.0, 4.0)]
    got = sorted((r.seg, round(r.x1, 6), round(r.x2, 6)) for r in surfaces.clip_segments(df, rings, "floor_name").collect())
    assert got == [(0, 0.0, 4.0), (3, 0.0, 4.0)]


def test_published_entrances_and_pairs(spark):
    kind = "building string, at long, x double, z double"
    placed = spark.createDataFrame([("k1", 0, 0.0, 0.0), ("k3", 0, 50.0, 50.0)], kind)
    entries = spark.createDataFrame([("k1", 0, 1.0, 0.0), ("k1", 1, 30.0, 0.0), ("k2", 0, 9.0, 9.0)], kind)
    extras = spark.createDataFrame([("k2", 0, 20.0, 20.0), ("k2", 1, None, 1.0)], kind)
    e = campus.published_entrances(placed, entries, extras)
    assert sorted((r.building, r.ordinal, r.source, r.x, r.is_primary) for r in e.collect()) == [("k1", 0, "placement", 0.0, True), ("k1", 1, "entry", 30.0, False), ("k2", 0, "entry", 9.0, True), ("k2", 1, "extra", 20.0, False), ("k3", 0, "placement", 50.0, True)]
    pairs = campus.door_pairs(e)
    assert sorted((r.a, r.b) for r in pairs.collect()) == [("k1", "k2"), ("k1", "k3"), ("k2", "k3")]
    cfg = CampusConfig("t", geo.Reference(174.0, -36.0, (0.0, 0.0), (0.0, 0.0), 1.0))
    cols = "route_id string, r int, l int, s int, p int, lon double, lat double, abutters string"
    points = spark.createDataFrame([("k1__k2", 0, 0, 0, i, 174.0 + i / 1000, -36.0, "") for i in range(3)], cols)
    assert [(r.a, r.b) for r in campus.pair_polylines(pairs, points, cfg).collect()] == [("k1", "k2")]
    with pytest.raises(ValueError, match="no pair"):
        campus.pair_polylines(pairs, points.limit(0), cfg)
