"""Runs of a building, a group and a campus as stages that are written once and reused until something they rest on changes.

A stage is kept under the hash of its name, version, parameters and the hashes of its inputs; for a source that is the list
of its files with size and time. A run therefore resumes at the first stage that something has changed for, wherever an earlier one was
lost, and a second run reads everything back. Between stages there are tables only, so lineage ends at each.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scratch import Scratch
from ..sources import locations
from ..sources.config import CampusConfig, Group
from . import building, campus, group
from .building import Dataset

Result = DataFrame | Mapping[str, DataFrame]


class Run:
    """Stages under ``path``; ``log`` lists (stage, reused or computed) in the order of their use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log: list[tuple[str, str]] = []
        self._keys: dict[str, str] = {}
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def source(self, name: str, path: str) -> str:
        """The path (a folder, file or glob pattern), which is part of the hash of every stage that names the source."""
        fs, p = self._fs(path)
        found, todo = [], list(fs.globStatus(p) or [])
        while todo:
            s = todo.pop()
            if s.isDirectory():
                todo += list(fs.listStatus(s.getPath()))
            else:
                found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        self._keys[name] = _hash([path, sorted(found)])
        return path

    def stage(self, name: str, build: Callable[..., Result], /, inputs: Sequence[str] = (), version: int = 1, **params: object) -> dict[str, DataFrame]:
        """Tables of the stage, read back. ``build`` takes the parameters and returns a frame (table ``main``) or several by name.

        inputs: sources and stages that it rests on. Raise ``version`` when ``build`` changes. Parameters must be what JSON or str can tell apart.
        """
        key = _hash([name, version, {k: v if _plain(v) else str(v) for k, v in params.items()}, [(i, self._keys[i]) for i in inputs]])
        folder = f"{self.path}/{name}/{key}"
        fs, done = self._fs(f"{folder}/done.json")
        if fs.exists(done):
            self.log.append((name, "reused"))
        else:
            result = build(**params)
            tables = {"main": result} if isinstance(result, DataFrame) else dict(result)
            draft = f"{self.path}/{name}/_draft-{uuid.uuid4().hex}"
            for table, df in tables.items():
                df.write.parquet(f"{draft}/{table}")
            out = fs.create(self._fs(f"{draft}/done.json")[1], False)
            out.write(bytearray(json.dumps(sorted(tables)).encode()))
            out.close()
            if fs.exists(self._fs(folder)[1]):  # left half-made by hand: a finished stage was found above
                fs.delete(self._fs(folder)[1], True)
            if not fs.rename(self._fs(draft)[1], self._fs(folder)[1]):
                raise RuntimeError(f"cannot put {folder} in place")
            self.log.append((name, "computed"))
        self._keys[name] = key
        tables = json.loads(self.spark.read.text(f"{folder}/done.json", wholetext=True).first().value)
        return {t: self.spark.read.parquet(f"{folder}/{t}") for t in tables}

    def prune(self) -> None:
        """Removes what the stages of this run wrote under other hashes, and drafts of runs that failed."""
        for name in {n for n, _ in self.log}:
            fs, p = self._fs(f"{self.path}/{name}")
            for s in fs.listStatus(p):
                if s.getPath().getName() != self._keys[name]:
                    fs.delete(s.getPath(), True)


def _plain(v: object) -> bool:
    return v is None or isinstance(v, (str, int, float, bool)) or (isinstance(v, (list, tuple)) and all(map(_plain, v)))


def _hash(what: object) -> str:
    return hashlib.sha256(json.dumps(what, sort_keys=True).encode()).hexdigest()[:32]


def _dataset(t: Mapping[str, DataFrame]) -> Dataset:
    return Dataset(t["floors"], t["rooms"], t["portals"], t["issues"])


def _tables(ds: Dataset) -> dict[str, DataFrame]:
    return {n: getattr(ds, n) for n in ("floors", "rooms", "portals", "issues")}


def building_run(run: Run, pages: str, admin_id: str, building_id: str, name: str, lon: float, lat: float) -> dict[str, DataFrame]:
    """The tables of one building from its landed pages: floors, rooms, portals, issues, links and the manifest document, each a stage named after the building."""
    tag = f"{building_id}_"
    run.source(f"{tag}pages", pages)

    def land(path: str, admin_id: str) -> Result:
        found, rejects = locations.locations(locations.read_items(run.spark, path), admin_id)
        return {"found": found, "rejects": rejects}

    landed = run.stage(f"{tag}landed", land, [f"{tag}pages"], path=pages, admin_id=admin_id)
    normal = run.stage(f"{tag}normal", lambda admin_id, building_id: _tables(building.normalise(landed["found"], landed["rejects"], admin_id, building_id)), [f"{tag}landed"], admin_id=admin_id, building_id=building_id)
    local = run.stage(f"{tag}local", lambda lon, lat: _tables(building.project(_dataset(normal), lon, lat)), [f"{tag}normal"], lon=lon, lat=lat)
    ds = _dataset(local)
    links = run.stage(f"{tag}links", lambda: building.vertical_links(ds.portals), [f"{tag}local"])["main"]
    problems = run.stage(f"{tag}issues", lambda: building.issues(ds), [f"{tag}local"])["main"]
    document = run.stage(f"{tag}manifest", lambda building_id, title: building.manifest(ds, building_id, title), [f"{tag}local"], building_id=building_id, title=name)["main"]
    return {**local, "links": links, "issues": problems, "manifest": document}


def group_run(run: Run, g: Group, members: Mapping[str, str], lon: float, lat: float, component: Callable[[DataFrame], DataFrame] | None = None, is_door: Column | None = None) -> dict[str, DataFrame]:
    """The combined tables of a group and its topology document. members: admin id -> path of its pages.

    ``component`` gives the walkable component (id, component) of terminals; without it a floor is one component.
    """
    tag = f"{g.id}_"
    parts = {m: building_run(run, members[m], m, f"{g.id}_{m}", g.display_name, lon, lat) for m in g.members if m in members}
    both = run.stage(f"{tag}combined", lambda members: _tables(group.combine([_dataset(p) for p in parts.values()])), [f"{g.id}_{m}_local" for m in parts], members=list(parts))

    def topology(building_id: str) -> Result:
        scratch = Scratch(run.spark, "topology")
        t = scratch.save(group.terminals(both["portals"], building_id), "terminals")
        comp = component(t) if component else t.select("id", F.col("floor_index").alias("component"))
        transfer, vertical = scratch.save(group.transfer_edges(t, comp), "transfer"), scratch.save(group.vertical_edges(t), "vertical")
        health = scratch.save(group.door_health(t, transfer, vertical, F.col("portal_type") == "door" if is_door is None else is_door), "health")
        return {"terminals": t, "transfer": transfer, "vertical": vertical, "health": health, "document": group.topology_document(t, transfer, vertical, health, building_id)}

    graph = run.stage(f"{tag}topology", topology, [f"{tag}combined"], building_id=g.id)
    return {**both, **graph}


def campus_run(run: Run, responses: str, cfg: CampusConfig, doors: DataFrame | None = None) -> dict[str, DataFrame]:
    """The road graph of a campus from cached route responses (key, body as Parquet): points, failures, segments, nodes, edges, and spurs if doors (door, x, z) are given."""
    run.source("responses", responses)

    def points(path: str) -> Result:
        found, failures = locations.route_points(run.spark.read.parquet(path).withColumnRenamed("key", "route_id"))
        return {"points": found, "failures": failures}

    landed = run.stage("campus_points", points, ["responses"], path=responses)
    segments = run.stage("campus_segments", lambda: campus.outdoor_segments(landed["points"]), ["campus_points"])["main"]
    roads = run.stage("campus_roads", lambda cfg: dict(zip(("nodes", "edges"), campus.road_graph(segments, cfg), strict=True)), ["campus_segments"], cfg=cfg)
    out = {**landed, "segments": segments, **roads}
    if doors is not None:
        out["spurs"] = campus.spurs(roads["nodes"], doors, cfg)
    return out
