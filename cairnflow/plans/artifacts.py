"""What a group publishes: floor slabs, one binary file per floor and kind, packages and their rules."""

from __future__ import annotations

import fnmatch

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import mesh
from . import walkable
from .building import Dataset
from .surfaces import dataset_meshes, floor_glb, open_ring3

#: Slab thickness, padding of a derived slab, lift of a debug mesh over its floor (metres).
THICKNESS, PADDING, LIFT = 0.12, 0.25, 0.08


# --- slabs ---


def outlines(cells: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Outer outlines of the parts that cells (i, j) form side by side, the largest part first; corners in cell units, holes are filled.

    Cells that touch at a corner alone belong to different parts.
    """
    have = set(cells)
    turns: dict[tuple[int, int], dict[tuple[int, int], None]] = {}
    for i, j in sorted(have):
        for near, a, b in (((i, j - 1), (i, j), (i + 1, j)), ((i + 1, j), (i + 1, j), (i + 1, j + 1)), ((i, j + 1), (i + 1, j + 1), (i, j + 1)), ((i - 1, j), (i, j + 1), (i, j))):
            if near not in have:
                turns.setdefault(a, {})[b] = None
    out = []
    while turns:
        start = at = min(turns)
        ring, area, way = [], 0, (0, 0)
        while True:
            steps = turns[at]
            # the interior lies to the left of every edge, so the left turn stays at the same part
            nxt = max(steps, key=lambda b: way[0] * (b[1] - at[1]) - way[1] * (b[0] - at[0]))
            del steps[nxt]
            if not steps:
                del turns[at]
            step = (nxt[0] - at[0], nxt[1] - at[1])
            if step != way:
                ring.append(at)
            area += at[0] * nxt[1] - nxt[0] * at[1]
            way, at = step, nxt
            if at == start:
                break
        if area > 0:
            out.append((area, ring))
    return [ring for _, ring in sorted(out, key=lambda r: (-r[0], r[1]))]


def floor_slabs(ds: Dataset, padding: float = PADDING) -> DataFrame:
    """(building, floor_name, name, material, vertices, faces): the slab under every floor.

    A floor with a ``ring_local`` of its own gets that. Any other gets the exact union of its rooms and portals, ``padding`` wider with
    mitred corners: one slab per part, the largest first. Slabs have no holes.
    """
    key = ["building", "floor_name"]
    rings = ds.rooms.select(*key, "ring_local").unionByName(ds.portals.select(*key, "ring_local")).where(F.size("ring_local") >= 3)
    own = None
    if "ring_local" in ds.floors.columns:
        own = ds.floors.where(F.size("ring_local") >= 3)
        rings = rings.join(own.select(*key), key, "left_anti")
    xz = F.transform(open_ring3("ring_local"), lambda p: F.struct(p["x"].alias("x"), p["z"].alias("z")))
    low = rings.groupBy(*key).agg(F.min(F.element_at("ring_local", 1)["y"]).alias("y"))
    parts = walkable.union_slabs(rings.select(*key, xz.alias("ring")), key, padding).join(low, key)
    found = parts.select(*key, "part", F.transform("ring", lambda p: F.struct(p["x"].alias("x"), F.col("y").alias("y"), p["z"].alias("z"))).alias("ring"))
    if own is not None:
        found = found.unionByName(own.select(*key, F.lit(1).alias("part"), open_ring3("ring_local").alias("ring")))
    name = F.concat(F.lit("floor_"), F.col("floor_name"), F.when(F.col("part") > 1, F.concat(F.lit("_part_"), F.col("part").cast("string"))).otherwise(""))
    v, f = mesh.extrude(F.col("ring"), THICKNESS)
    return found.select(*key, name.alias("name"), F.lit("floor").alias("material"), v.alias("vertices"), f.alias("faces"))


def markers(ds: Dataset) -> DataFrame:
    """(building, floor_name, name, material, vertices, faces): a square at the anchor of every room and portal that has one."""
    cols = ["building", "floor_name", "external_id", "x", "y", "z"]
    both = ds.rooms.select(*cols, F.lit("anchor").alias("kind")).unionByName(ds.portals.select(*cols, "kind")).where("x is not null and z is not null")
    square = mesh.marker(F.col("x"), F.col("y"), F.col("z"))
    return both.select("building", "floor_name", F.concat_ws("_", F.lit("marker"), "kind", "external_id", "floor_name").alias("name"), F.col("kind").alias("material"), square.alias("vertices"), F.array(F.array(*map(F.lit, range(4)))).alias("faces"))


def all_meshes(ds: Dataset, openings: DataFrame | None = None, with_markers: bool = True) -> DataFrame:
    """Every mesh of a dataset: slabs, plates, walls (without those that ``openings`` take out) and, if wanted, markers."""
    out = floor_slabs(ds).unionByName(dataset_meshes(ds, openings))
    return out.unionByName(markers(ds)) if with_markers else out


# --- files per floor ---


def floor_artifacts(visual: DataFrame, routes: DataFrame, floor_table: DataFrame, group: str) -> DataFrame:
    """(floor_index, kind, filename, content): the binary files of every floor, heights relative to the floor's own.

    visual, routes: meshes (floor_name, name, material, vertices, faces); floor_table: floor_name, floor_index, height. ``visual`` holds
    the floor's visual meshes, ``walkable_paths`` its routes a little above the floor in one material, ``route_debug`` both. The last
    two exist only where the floor has routes. All meshes of one floor meet in a task.
    """
    cols = ["floor_index", "name", "material", "vertices", "faces"]
    placed = lambda df, lift: df.join(floor_table.select("floor_name", "floor_index", "height"), "floor_name").withColumn("vertices", lifted(F.col("vertices"), F.col("height"), lift)).select(*cols)
    seen, way = placed(visual, 0.0), placed(routes, LIFT)
    tag = lambda df, kind: df.withColumn("kind", F.lit(kind))
    both = seen.join(way.select("floor_index").distinct(), "floor_index", "left_semi").unionByName(way)
    every = tag(seen, "visual").unionByName(tag(way.withColumn("material", F.lit("walkable_path")), "walkable_paths")).unionByName(tag(both, "route_debug"))

    def build(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"floor_index": [k[0]], "kind": [k[1]], "content": [floor_glb(pdf, 0.0)]})

    files = every.groupBy("floor_index", "kind").applyInPandas(build, "floor_index int, kind string, content binary")
    number = F.concat(F.when(F.col("floor_index") < 0, "neg").otherwise(""), F.abs("floor_index").cast("string"))
    return files.select("floor_index", "kind", F.concat(F.lit(f"{group}_floor_"), number, F.lit("_"), "kind", F.lit(".glb")).alias("filename"), "content")


def write_artifacts(artifacts: DataFrame, path: str) -> None:
    """The files (filename, content) of ``floor_artifacts`` in a folder, in place of those of earlier runs; a run that fails leaves them as they were."""
    from ..sources.files import write_files

    write_files(artifacts, path)


def stage_files(stages: dict[str, DataFrame]) -> DataFrame:
    """(filename, content): a binary file for every stage and floor of its meshes (floor_name, name, material, vertices, faces), to look at a build step by step. The meshes of one floor and stage meet in a task."""
    every = None
    for k, (name, meshes) in enumerate(stages.items(), 1):
        one = meshes.select(F.lit(f"{k:02d}_{name}").alias("stage"), "floor_name", "name", "material", "vertices", "faces")
        every = one if every is None else every.unionByName(one)

    def build(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"filename": [f"{k[0]}/floor_{k[1]}.glb"], "content": [floor_glb(pdf, 0.0)]})

    return every.groupBy("stage", "floor_name").applyInPandas(build, "filename string, content binary")


def lifted(vertices: Column, height: Column, lift: float) -> Column:
    """Vertices with heights relative to ``height``, raised by ``lift``, in whole millionths."""
    return F.transform(vertices, lambda p: F.struct(p["x"].alias("x"), F.round(geo.zero_tiny(p["y"] - height) + lift, 6).alias("y"), p["z"].alias("z")))


# --- packages ---


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def single(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the one file in the folder whose name matches: none or several are errors."""
    fs, p = _fs(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
    found = [n for n in names if fnmatch.fnmatchcase(n, pattern)]
    if not found:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    if len(found) > 1:
        raise ValueError(f"{len(found)} files match {pattern} in {folder}, one is expected")
    return f"{folder}/{found[0]}"


def package(spark: SparkSession, source: str, target: str, files: list[tuple[str, str, bool]]) -> list[str]:
    """Copies files (name, new name, required) from one folder to another, in any file systems Spark writes; the new names that were copied.

    A required file that is missing is an error before anything is copied; an optional one is left out.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [(*_fs(spark, f"{source}/{name}"), name, new, required) for name, new, required in files]
    missing = [name for fs, p, name, _, required in there if required and not fs.exists(p)]
    if missing:
        raise FileNotFoundError(f"missing in {source}: {', '.join(missing)}")
    fs_to, folder = _fs(spark, target)
    fs_to.mkdirs(folder)
    done = []
    for fs, p, _, new, _ in there:
        if fs.exists(p):
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, fs_to, _fs(spark, f"{target}/{new}")[1], False, True, conf)
            done.append(new)
    return done


def package_names(slug: str) -> list[str]:
    """The files that every package holds."""
    return [f"{slug}_visual.glb", f"{slug}_nav.glb", f"{slug}_manifest.json", "README.md"]


def package_issues(files: DataFrame, slug: str) -> DataFrame:
    """(path, problem) of a package: its files (path, content) that are missing, and every rule its binary meshes break."""
    from ..sources.sinks import glb_problems

    want = files.sparkSession.createDataFrame([(n,) for n in package_names(slug)], "name string")
    have = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    missing = want.join(have.select("name").distinct(), "name", "left_anti").select(F.col("name").alias("path"), F.lit("missing").alias("problem"))
    meshes = have.where(F.col("name").isin(package_names(slug)[:2]))
    return missing.unionByName(glb_problems(meshes.select(F.col("name").alias("path"), "content")))
