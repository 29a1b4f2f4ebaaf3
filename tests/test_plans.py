import json

import pytest
from pyspark.sql import functions as F

from cairnflow.functions.geo import Reference
from cairnflow.operators import graph, mesh
from cairnflow.operators import relational as rel
from cairnflow.plans import building, campus, group
from cairnflow.sources import config, locations, sinks

SQUARE = [[174.0, -36.0], [174.001, -36.0], [174.001, -36.001], [174.0, -36.001], [174.0, -36.0]]


def feature(i, external, name="", floor="1", kind="Room", ring=SQUARE, **props):
    p = {"externalId": external, "name": name, "floorName": floor, "type": kind, "anchor": {"coordinates": [174.0005, -36.0005]}} | props
    return {"id": i, "properties": p, "geometry": {"type": "Polygon", "coordinates": [ring]} if ring else None}


@pytest.fixture
def dataset(spark, tmp_path):
    pages = [
        {"features": [feature("a", "741-332", "Case Room Lecture", kind="Lecture Theatre"), feature("b", "741-510S4", "Stairs", kind="Stairwell"), feature("c", "741-620S4", "Stairs", floor="2", kind="Stairwell"), "noise", 3]},
        [feature("d", "", "No id"), feature("e", "741-47", "No ring", ring=None), feature("f", "741-730S4", "Stairs", floor="3", kind="Stairwell"), feature("g", "903-2", "Elsewhere", building="903"), feature("h", "741-88E6", "Lift", floor="G", kind="Elevator")],
        {"data": {"not": "a list"}, "results": [feature("i", "741-46", "", floor="2", building="741", ring=[[174.0, -36.0], "bad", [174.1, -36.1], [174.2, -36.0]])]},
    ]
    for k, p in enumerate(pages):
        (tmp_path / f"locations_{k:04d}.json").write_text(json.dumps(p))
    (tmp_path / "locations_0009.json").write_text("{broken")
    items = locations.read_items(spark, str(tmp_path))
    assert locations.corrupt_files(spark, str(tmp_path)).count() == 1
    return building.normalise(*locations.locations(items, "741"), "741", "quay")


def test_building(spark, dataset):
    rooms = {r.external_id: r for r in dataset.rooms.collect()}
    assert set(rooms) == {"741-332", "741-46"}
    assert rooms["741-332"].category == "lecture" and list(rooms["741-332"].aliases) == ["741-332", "332", "741 332", "QUAY 332"]
    assert len(rooms["741-46"].ring) == 3 and rooms["741-46"].display_name == "741-46"
    assert sorted((r.external_id, r.kind, r.group_id) for r in dataset.portals.collect()) == [("741-510S4", "stair", "S4"), ("741-620S4", "stair", "S4"), ("741-730S4", "stair", "S4"), ("741-88E6", "elevator", "E6")]
    assert [(r.floor_name, r.floor_index) for r in dataset.floors.orderBy("floor_index").collect()] == [("G", 0), ("1", 1), ("2", 2), ("3", 3)]
    assert sorted(r.code for r in dataset.issues.collect()) == ["missing externalId/roomId", "missing polygon geometry"]
    links = [(r.from_external_id, r.to_external_id) for r in building.vertical_links(dataset.portals).orderBy("from_floor_index").collect()]
    assert links == [("741-510S4", "741-620S4"), ("741-620S4", "741-730S4")]
    local = building.project(dataset, 174.0, -36.0)
    r = local.rooms.where("external_id = '741-332'").first()
    assert abs(r.z + 55.66) < 1e-6 and abs(r.y - 4.2) < 1e-9 and abs(r.ring_local[0].x) < 1e-9
    doc = building.manifest(local, "quay", "Quay House").first()
    body = json.loads(doc.document)
    assert [f["floor_name"] for f in body["floors"]] == ["G", "1", "2", "3"] and len(body["nav"]["links"]) == 2 and len(doc.hash) == 64
    assert building.issues(dataset).where("severity = 'error'").count() == 0


def test_result_does_not_depend_on_partitions(spark, dataset):
    shuffled = building.vertical_links(dataset.portals.repartition(7)).collect()
    assert sorted(map(tuple, shuffled)) == sorted(map(tuple, building.vertical_links(dataset.portals.coalesce(1)).collect()))


def test_inventory(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"venues": [{"id": "v1", "name": "Old"}, {"name": "no id"}, {"id": "v1", "venueInfo": {"name": "City"}}]}))
    b = {"administrativeId": "423", "id": "m1", "externalId": " X ", "venueId": "v1", "buildingInfo": {"name": "Conference Centre"}, "geometry": {"bbox": [1, 2, 3, 4]}, "floors": {"0": {"name": "G"}, "-10": {"name": "B1"}}}
    (tmp_path / "b.json").write_text(json.dumps([b, {"id": "no admin"}]))
    v = locations.venues(locations.read_items(spark, str(tmp_path / "v.json"), locations.INVENTORY_KEYS))
    r = locations.buildings(locations.read_items(spark, str(tmp_path / "b.json"), locations.INVENTORY_KEYS), v).collect()
    assert len(r) == 1 and (r[0].slug, r[0].external_id, r[0].venue_name, r[0].lon, r[0].lat, list(r[0].floor_keys)) == ("423-conference-centre", "X", "City", 2.0, 3.0, ["-10", "0"])


def pt(lon, lat, z=0.0):
    return {"lng": lon, "lat": lat, "zLevel": z, "floor_name": "0"}


def response(*legs):
    return json.dumps({"status": "OK", "routes": [{"legs": [{"steps": list(steps)} for steps in legs]}]})


def test_routes_and_cache(spark):
    rows = [("ok", response([{"geometry": [pt(0, 0), pt(1, 0)], "highway": "footway"}], [{"start_location": pt(2, 0), "end_location": pt(3, 0)}])), ("no", '{"status": "ZERO"}'), ("bad", "{x")]
    points, failures = locations.route_points(spark.createDataFrame(rows, "route_id string, body string"))
    assert [(r.l, r.lon, r.highway) for r in points.orderBy("l", "s", "p").collect()] == [(0, 0.0, "footway"), (0, 1.0, "footway"), (1, 2.0, "path"), (1, 3.0, "path")]
    assert sorted((r.route_id, r.status) for r in failures.collect()) == [("bad", "corrupt"), ("no", "ZERO")]
    cache = spark.createDataFrame([("k1", "old")], "key string, body string")
    asked = spark.createDataFrame([("k1", "a", "b"), ("k2", "c", "d"), ("k2", "c", "d"), ("k3", "e", "boom")], "key string, origin string, destination string")

    def client(o, d):
        if d == "boom":
            raise ConnectionError("down")
        return f"{o}->{d}"

    got = {r.key: r.body for r in locations.fill_cache(asked, cache, client).collect()}
    assert got["k1"] == "old" and got["k2"] == "c->d" and "request_failed" in got["k3"] and len(got) == 3


REF = Reference(lon=0.0, lat=0.0, anchor=(0.0, 0.0), origin=(0.0, 0.0), scale=1.0)
CFG = config.CampusConfig("campus", REF, snap_m=1.5, min_stub_m=6.0, spur_max_m=60.0)
M = 1 / 111_320.0


def test_campus_graph(spark):
    line = lambda *xs, cls="footway", ab="": {"geometry": [pt(x * M, y * M) for x, y in xs], "highway": cls, "abutters": ab}
    rows = [
        ("r1", response([line((0, 0), (50, 0))], [line((50, 0), (80, 0), ab="InsideBuilding")], [line((90, 0), (140, 0), cls="service")])),
        ("r2", response([line((50, 0), (50, 2))])),  # a spike of two metres
        ("r3", response([line((300, 0), (340, 0))])),  # an island
        ("r4", response([line((0, 0), (50, 0), cls="residential")])),
    ]
    points, _ = locations.route_points(spark.createDataFrame(rows, "route_id string, body string").repartition(3))
    segments = campus.outdoor_segments(points)
    assert sorted(r["class"] for r in segments.collect()) == ["connector", "footway", "footway", "footway", "residential", "service"]
    nodes, edges = campus.road_graph(segments, CFG)
    kinds = sorted((r["class"], round(r.length)) for r in edges.collect())
    assert kinds == [("connector", 40), ("footway", 40), ("residential", 50), ("service", 50), ("spur", 160)]
    comp = graph.components(nodes, edges)
    assert comp.select("component").distinct().count() == 1
    doors = spark.createDataFrame([("b1", 2.0, 10.0), ("b2", 2.0, 12.0), ("b3", 0.0, 900.0)], "door string, x double, z double")
    tied = {r.door: (r.node, r.door_node, round(r.length)) for r in campus.spurs(nodes, doors, CFG).collect()}
    assert set(tied) == {"b1", "b2"} and tied["b2"][0] == tied["b1"][1] and tied["b2"][2] == 2
    assert campus.strips(nodes, edges, CFG).count() == 5
    lines = {r.route_id: len(r.line) for r in campus.polylines(points, CFG).collect()}
    assert lines["r1"] == 2 and lines["r2"] == 2


def test_topology(spark):
    cols = "source_id string, external_id string, floor_index int, floor_name string, building string, kind string, group_id string, x double, y double, z double, node_name string"
    rows = [("a", "741-802", 10, "8", "741", "elevator", "MI_741_ELEV_001", 5.0, 33.6, 0.0, "n"), ("b", "741-920S4", 10, "8", "741", "stair", "S3", 0.0, 33.6, 0.0, "n"), ("c", "741-8U02", 11, "M8", "741", "elevator", "MI_741_ELEV_001", 5.0, 35.7, 0.0, "n"), ("d", "742-802", 10, "8", "742", "elevator", "MI_742_ELEV_001", 100.0, 33.6, 100.0, "n"), ("o", "741-D", 10, "8", "741", "door", "", 1.0, 33.6, 0.0, "n"), ("x", "741-D", 10, "8", "741", "door", "", 500.0, 33.6, 0.0, "n")]
    t = group.terminals(spark.createDataFrame(rows, cols), "harbour")
    ids = {r.source_id: r.id for r in t.collect()}
    assert ids["a"] == "harbour:F10:741:lift:741MI_741_ELEV_001:741_802" and ids["b"] == "harbour:F10:741:stair:741S3:741_920S4" and ids["x"] == ids["o"] + ":x"
    comp = spark.createDataFrame([(ids["a"], 0), (ids["b"], 0), (ids["o"], 0), (ids["d"], 1), (ids["c"], 0)], "id string, component int")
    transfer, vertical = group.transfer_edges(t, comp), group.vertical_edges(t)
    costs = {(r["from"], r["to"]): r.cost for r in transfer.collect()}
    assert costs[(ids["b"], ids["a"])] == 5.0 and (ids["d"], ids["a"]) not in costs and len(costs) == 6
    assert sorted((r["from"], r["to"], r.cost) for r in vertical.collect()) == sorted([(ids["a"], ids["c"], 20.0), (ids["c"], ids["a"], 20.0)])
    health = group.door_health(t, transfer, vertical, F.col("portal_type") == "door")
    assert {r.terminal_id: (r.reachable, r.vertical, r.routable) for r in health.collect()} == {ids["o"]: (4, 3, True), ids["x"]: (1, 0, False)}
    group.gate(health, vertical)
    with pytest.raises(ValueError):
        group.gate(health.where("not routable"), vertical)


def test_shafts_from_routes(spark):
    portals = spark.createDataFrame([("p", "741", "elevator", 1, "741-1"), ("q", "741", "elevator", 2, "741-2"), ("r", "741", "elevator", 3, "741-3"), ("s", "741", "elevator", 1, "741-9"), ("t", "741", "elevator", 2, "741-8")], "source_id string, building string, kind string, floor_index int, external_id string")
    edges = spark.createDataFrame([("p", "q"), ("q", "r"), ("s", "t")], "a string, b string")
    got = {r.source_id: r.group_id for r in group.shaft_groups(portals, edges).collect()}
    assert got == {"p": "MI_741_ELEV_001", "q": "MI_741_ELEV_001", "r": "MI_741_ELEV_001", "s": "MI_741_ELEV_002", "t": "MI_741_ELEV_002"}
    body = response([{"geometry": [pt(174.0, -36.0, 80), pt(174.0, -36.0, 85), pt(174.0, -36.0, 90)]}])
    points, _ = locations.route_points(spark.createDataFrame([("x", body)], "route_id string, body string"))
    pairs = spark.createDataFrame([("x", 85.0, 90.0, 174.00001, -36.0, 174.0, -36.0)], "route_id string, a_level double, b_level double, a_lon double, a_lat double, b_lon double, b_lat double")
    moves = group.vertical_transitions(points)
    assert moves.count() == 2 and group.proven_pairs(pairs, moves).first().zlevel == 90.0
    assert group.proven_pairs(pairs.withColumn("a_lon", F.lit(175.0)), moves).count() == 0


def test_groups_and_config(spark, dataset):
    groups = config.load_groups("groups:\n  - {id: harbour, members: ['740', '742', '740'], aliases: [Har, har]}\n  - {id: lakeside, members: ['655'], primary_member: '655'}\n")
    assert groups[0].members == ("740", "742") and len(groups[0].aliases) == 1
    assert config.filter_members(groups[0], ["742"]).primary_member == "742"
    with pytest.raises(ValueError):
        config.filter_members(groups[0], ["999"])
    with pytest.raises(ValueError):
        config.load_groups("groups: [{id: x}]")
    assert config.groups_table(spark, groups).count() == 3
    both = group.combine([dataset, dataset])
    assert both.rooms.count() == 4 and [r.floor_name for r in both.floors.orderBy("floor_index").collect()] == ["G", "1", "2", "3"]


def test_kernels():
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    concave = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    area = lambda p, t: sum(abs((p[b][0] - p[a][0]) * (p[c][1] - p[a][1]) - (p[b][1] - p[a][1]) * (p[c][0] - p[a][0])) / 2 for a, b, c in t)
    assert area(square, mesh.triangulate(square)) == 16 and area(concave, mesh.triangulate(concave)) == 10
    assert area(concave, mesh.triangulate(concave[::-1])) is not None
    assert mesh.hull([*square, (2.0, 2.0), (2.0, 0.0)]) == square
    assert mesh.simplify([(0, 0), (1, 0.1), (2, 0), (3, 5), (4, 0)], 0.5) == [(0, 0), (2, 0), (3, 5), (4, 0)]
    data = mesh.glb([{"name": "a", "material": "room", "vertices": [(0, 0, 0), (1, 0, 0), (0, 0, 1)], "triangles": [(0, 1, 2)]}, {"name": "empty", "material": "x", "vertices": [], "triangles": []}])
    doc = mesh.read_glb(data)
    assert len(doc["meshes"]) == 1 and doc["accessors"][0]["max"] == [1, 0, 1] and len(data) % 4 == 0
    with pytest.raises(ValueError):
        mesh.read_glb(data[:-4])


def test_sinks(spark, tmp_path):
    assert sinks.canonical_json({"b": 1, "a": [2]}) == '{\n  "a": [\n    2\n  ],\n  "b": 1\n}\n'
    assert sinks.content_hash({"x": 1, "generation_hash": "old"}) == sinks.content_hash({"x": 1})
    df = spark.createDataFrame([(1, ["a", "b"], {"k": 1})], "id int, tags array<string>, more map<string,int>")
    sinks.write_summary_csv(df.coalesce(1), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().tags == "a; b"
    sinks.write_documents(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first().id == 1
    with pytest.raises(ValueError):
        rel.nonempty(df.where("id > 5"), "ids")


def test_last_kept_and_sample(spark):
    df = spark.createDataFrame([(0, [(0.0, 0.0), (0.04, 0.0), (0.08, 0.0), (1.0, 0.0)])], "k int, p array<struct<x:double,z:double>>")
    kept = df.select(rel.last_kept(F.col("p"), "x", "z", 0.05).alias("p")).first().p
    assert [p.x for p in kept] == [0.0, 0.08, 1.0]
    few = spark.range(5).withColumn("g", F.lit(1))
    assert [r.id for r in rel.systematic_sample(few, ["g"], ["id"], 3).orderBy("id").collect()] == [0, 1, 3]
