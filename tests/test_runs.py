"""Stages are reused until a parameter or an input changes; building, group and campus from landed files to documents."""

import json
import time

import pytest

from cairnflow.functions.geo import Reference
from cairnflow.plans import runs
from cairnflow.sources.config import CampusConfig, Group

RING = [[174.0, -36.0], [174.0001, -36.0], [174.0001, -36.0001], [174.0, -36.0001]]


def feature(fid, external, kind="Office", floor="1", building="611", at=(174.00005, -36.00005)):
    return {"id": fid, "geometry": {"type": "Polygon", "coordinates": [RING]}, "properties": {"externalId": external, "name": external, "floorName": floor, "building": building, "type": kind, "anchor": {"coordinates": list(at)}}}


def land(folder, building, extra=()):
    folder.mkdir(exist_ok=True)
    rows = [feature("r1", f"{building}-12"), feature("s1", f"{building}-10S1", "Stairwell"), feature("s2", f"{building}-20S1", "Stairwell", "2"), feature("d", f"{building}-D1", "Door"), *extra]
    for r in rows:
        r["properties"]["building"] = building
    (folder / "page_0.json").write_text(json.dumps({"features": rows}))
    return str(folder)


def states(run):
    return {name: state for name, state in run.log}


def test_a_run_resumes_at_the_first_change(spark, tmp_path):
    pages = land(tmp_path / "pages", "611")
    go = lambda name="Mill", lon=174.0: (r := runs.Run(spark, str(tmp_path / "run")), runs.building_run(r, pages, "611", "mill", name, lon, -36.0))
    first, tables = go()
    assert set(states(first).values()) == {"computed"} and tables["rooms"].count() >= 1 and tables["links"].count() == 1
    document = json.loads(tables["manifest"].first().document)
    assert document["building"]["display_name"] == "Mill" and len(document["floors"]) == 2
    second, again = go()
    assert set(states(second).values()) == {"reused"} and again["manifest"].first().hash == tables["manifest"].first().hash
    renamed = states(go(name="Old Mill")[0])
    assert renamed.pop("mill_manifest") == "computed" and set(renamed.values()) == {"reused"}
    moved = states(go(lon=174.1)[0])
    assert [moved[f"mill_{s}"] for s in ("landed", "normal", "local", "links", "manifest")] == ["reused", "reused", "computed", "computed", "computed"]
    time.sleep(0.01)
    land(tmp_path / "pages", "611", [feature("r2", "611-13")])
    changed, tables = go()
    assert states(changed)["mill_landed"] == "computed" and "611-13" in [r.external_id for r in tables["rooms"].collect()]
    changed.prune()
    assert all(len([f for f in (tmp_path / "run" / n).iterdir() if not f.name.startswith(".")]) == 1 for n, _ in changed.log)
    assert set(states(go()[0]).values()) == {"reused"}


def test_a_failed_stage_is_run_again(spark, tmp_path):
    run = runs.Run(spark, str(tmp_path / "run"))

    def broken():
        raise OSError("no line")

    with pytest.raises(OSError):
        run.stage("s", broken)
    assert run.stage("s", lambda: {"a": spark.range(3), "b": spark.range(4)})["b"].count() == 4
    assert run.stage("s", broken)["a"].count() == 3 and run.log == [("s", "computed"), ("s", "reused")]
    assert run.stage("s", lambda: spark.range(5), version=2)["main"].count() == 5


def test_group_and_its_topology_document(spark, tmp_path):
    members = {m: land(tmp_path / m, m) for m in ("611", "612")}
    g = Group("quayside", "Quayside", "611", ("611", "612", "613"))
    go = lambda: (r := runs.Run(spark, str(tmp_path / "run")), runs.group_run(r, g, members, 174.0, -36.0))
    run, tables = go()
    doc = json.loads(tables["document"].first().document)
    v = doc["validation"]
    assert doc["building_id"] == "quayside" and v["terminal_count"] == len(doc["terminals"]) == tables["terminals"].count()
    assert v["edge_count"] == len(doc["transfer_edges"]) + len(doc["vertical_edges"]) and len(doc["vertical_edges"]) == 4
    assert v["transfer_edge_reason_counts"] == {"same_navmesh_component": len(doc["transfer_edges"])}
    assert v["external_door_terminal_count"] == v["routable_external_door_count"] + v["unreachable_external_door_count"]
    assert [t["id"] for t in doc["terminals"]] == [t["id"] for t in sorted(doc["terminals"], key=lambda t: (t["floor_index"], t["id"]))]
    assert set(states(go()[0]).values()) == {"reused"}


def test_campus_from_cached_responses(spark, tmp_path):
    step = lambda lons: {"geometry": [{"lng": 174.0 + x, "lat": -36.0, "zLevel": 0} for x in lons], "highway": "footway"}
    body = json.dumps({"status": "OK", "routes": [{"legs": [{"steps": [step((0.0, 0.0005, 0.001))]}]}]})
    spark.createDataFrame([("r1", body), ("r2", "{bad")], "key string, body string").write.parquet(str(tmp_path / "cache"))
    cfg = CampusConfig("campus", Reference(lon=174.0, lat=-36.0, anchor=(0.0, 0.0), origin=(0.0, 0.0), scale=1.0))
    go = lambda: (r := runs.Run(spark, str(tmp_path / "run")), runs.campus_run(r, str(tmp_path / "cache"), cfg))
    run, out = go()
    assert out["nodes"].count() == 3 and out["edges"].count() == 2 and [r.status for r in out["failures"].collect()] == ["corrupt"]
    assert set(states(go()[0]).values()) == {"reused"}
