"""Meshes of a dataset, clipped lines, shared room boundaries, and walkable surfaces on cells."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import bridges, graph, mesh, spatial
from ..operators import relational as rel
from .building import Dataset


def number_text(c: Column) -> Column:
    """Six decimals without trailing zeros; tiny values are 0."""
    six = F.format_string("%.6f", geo.zero_tiny(F.round(c, 6)) + F.lit(0.0))
    return F.regexp_replace(F.regexp_replace(six, r"0+$", ""), r"\.$", "")


def open_ring3(c: str) -> Column:
    """Open ring of struct<x, y, z>."""
    closed = (F.size(c) > 1) & (F.element_at(c, 1) == F.element_at(c, -1))
    return F.when(closed, F.slice(c, F.lit(1), F.size(c) - 1)).otherwise(F.col(c))


def dataset_meshes(ds: Dataset, openings: DataFrame | None = None, height: float = 1.5) -> DataFrame:
    """(building, floor_name, name, material, vertices, faces): a plate and a wall per room and portal.

    openings: (floor_name, edge) from ``doors.wall_openings``; those edges get no wall.
    """
    cols = ["building", "floor_name", "external_id"]
    both = ds.rooms.select(*cols, F.lit("room").alias("kind"), open_ring3("ring_local").alias("ring")).unionByName(ds.portals.select(*cols, "kind", open_ring3("ring_local").alias("ring")))
    both = both.where(F.size("ring") >= 3).withColumn("name", F.concat_ws("_", "external_id", "floor_name"))
    xz = F.transform("ring", lambda p: F.struct(p["x"].alias("x"), p["z"].alias("z")))
    open_edges = F.array().cast("array<int>")
    if openings is not None:
        e = both.select("name", "floor_name", F.explode(geo.ring_edges(xz)).alias("e"))
        e = e.withColumn("edge", geo.edge_key(*(F.col(f"e.{p}.{c}") for p in "ab" for c in "xz")))
        e = e.join(openings.select("floor_name", "edge").distinct(), ["floor_name", "edge"]).groupBy("name").agg(F.collect_set("e.at").alias("open"))
        both = both.join(e, "name", "left")
        open_edges = F.coalesce("open", open_edges)
    wv, wf = mesh.wall(F.col("ring"), height, open_edges)
    out = ["building", "floor_name"]
    plate = both.select(*out, F.concat(F.lit("plate_"), "name").alias("name"), F.col("kind").alias("material"), F.col("ring").alias("vertices"), F.array(F.sequence(F.lit(0), F.size("ring") - 1)).alias("faces"))
    walls = both.select(*out, F.concat(F.lit("wall_"), "name").alias("name"), F.lit("wall").alias("material"), wv.alias("vertices"), wf.alias("faces"))
    return plate.unionByName(walls)


def floor_glb(pdf: pd.DataFrame, low: float) -> bytes:
    """One binary file of the meshes (name, material, vertices, faces), heights minus ``low``; triangles are wound like their faces."""
    parts = []
    for r in pdf.sort_values("name").itertuples(index=False):
        v = [(p["x"], p["y"] - low, p["z"]) for p in r.vertices]
        tri = [t for f in r.faces for t in mesh.triangulate_face(f, v)]
        parts.append({"name": r.name, "material": r.material, "vertices": v, "triangles": tri})
    return mesh.glb(parts)


def floor_files(meshes: DataFrame) -> DataFrame:
    """(building, floor_name, content BINARY): one binary file per floor, heights relative to the floor's lowest point."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        low = min(p["y"] for vs in pdf["vertices"] for p in vs)
        return pd.DataFrame({"building": [pdf["building"].iloc[0]], "floor_name": [pdf["floor_name"].iloc[0]], "content": [floor_glb(pdf, low)]})

    return meshes.groupBy("building", "floor_name").applyInPandas(build, "building string, floor_name string, content binary")


def _outline_gap(e: Column, own: list[Column]) -> Column:
    """Distance of the segment ``own`` from an outline edge that it does not cross."""
    ends = [e["a"]["x"], e["a"]["z"], e["b"]["x"], e["b"]["z"]]
    return F.least(*(geo.point_segment(*own[k : k + 2], *ends) for k in (0, 2)), *(geo.point_segment(*ends[k : k + 2], *own) for k in (0, 2)))


def clip_segments(segments: DataFrame, rings: DataFrame, key: str, shortest: float = 0.05, bridge: float = 0.0, near: float = 8.0) -> DataFrame:
    """Parts of the segments (key, seg, x1, z1, x2, z2) inside the ring (key, ring array<struct<x, z>>) of their key.

    Every segment is cut at its crossings with the ring; the parts whose middle
    is inside stay, those shorter than ``shortest`` go. A segment of at most
    ``bridge`` whose nearest point is within ``near`` of the ring's area passes
    whole: it may bridge a gap of the footprint.
    """
    j = segments.join(rings, key)
    own = [F.col(c) for c in ("x1", "z1", "x2", "z2")]
    ring = geo.open_ring(F.col("ring"))
    dx, dz = F.col("x2") - F.col("x1"), F.col("z2") - F.col("z1")

    def crossing(e: Column) -> Column:
        ex, ez = e["b"]["x"] - e["a"]["x"], e["b"]["z"] - e["a"]["z"]
        px, pz = e["a"]["x"] - F.col("x1"), e["a"]["z"] - F.col("z1")
        det = F.nullif(dx * ez - dz * ex, F.lit(0.0))
        t, u = (px * ez - pz * ex) / det, (px * dz - pz * dx) / det
        return F.when(t.between(0, 1) & u.between(0, 1), t)

    cuts = F.array_compact(F.transform(geo.ring_edges(ring), crossing))
    j = j.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts))))
    length = geo.distance(*own)
    touches = (F.size(cuts) > 0) | geo.point_in_ring(*own[:2], ring)
    close = touches | (F.array_min(F.transform(geo.ring_edges(ring), lambda e: _outline_gap(e, own))) <= near)
    j = j.withColumn("whole", F.coalesce((length >= shortest) & (length <= bridge) & close, F.lit(False)) if bridge > 0 else F.lit(False))
    parts = F.zip_with(F.slice("cuts", F.lit(1), F.size("cuts") - 1), F.slice("cuts", F.lit(2), F.size("cuts") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    every = F.array(F.struct(F.lit(0.0).alias("a"), F.lit(1.0).alias("b")))
    j = j.withColumn("part", F.explode(F.when(F.col("whole"), every).otherwise(parts)))
    mid = (F.col("part.a") + F.col("part.b")) / 2
    j = j.where(F.col("whole") | geo.point_in_ring(F.col("x1") + mid * dx, F.col("z1") + mid * dz, ring))
    at = lambda t: (F.col("x1") + F.col(t) * dx, F.col("z1") + F.col(t) * dz)
    out = j.select(key, "seg", *(c.alias(n) for c, n in zip((*at("part.a"), *at("part.b")), ("cx1", "cz1", "cx2", "cz2"), strict=True)))
    out = out.where(geo.distance(*map(F.col, ("cx1", "cz1", "cx2", "cz2"))) >= shortest)
    return out.select(key, "seg", F.col("cx1").alias("x1"), F.col("cz1").alias("z1"), F.col("cx2").alias("x2"), F.col("cz2").alias("z2"))


def clip_routes(segments: DataFrame, footprints: DataFrame, key: str = "floor_name") -> DataFrame:
    """Route segments clipped by the footprint of their floor; those of at most 25 within 8 of it pass whole."""
    return clip_segments(segments, footprints, key, bridge=25.0, near=8.0)


def shared_boundaries(rooms: DataFrame, tolerance: float = 0.05, cell: float = 4.0) -> DataFrame:
    """(room, other, x, z, length): middle and length of the longest wall that two rooms of a floor share.

    rooms: room, floor_name, ring array<struct<x, z>>. Walls lie on each other
    if both ends of one are within ``tolerance`` of the other's line; they meet
    through the cells of their boxes.
    """
    e = rooms.select("room", "floor_name", F.explode(geo.ring_edges(geo.open_ring(F.col("ring")))).alias("e"))
    e = e.select("room", "floor_name", F.col("e.at").alias("at"), *(F.col(f"e.{p}.{c}").alias(f"{p}{c}") for p in "ab" for c in "xz"))
    grown = spatial._cells_of_box(F.least("ax", "bx") - tolerance, F.least("az", "bz") - tolerance, F.greatest("ax", "bx") + tolerance, F.greatest("az", "bz") + tolerance, cell)
    cells = e.withColumn("c", F.explode(grown))
    right = cells.select("c", "floor_name", F.col("room").alias("other"), F.col("at").alias("at2"), *(F.col(n).alias(f"o{n}") for n in ("ax", "az", "bx", "bz")))
    j = cells.join(right, ["c", "floor_name"]).where("room <> other").dropDuplicates(["room", "at", "other", "at2"])
    length = geo.distance(*map(F.col, ("ax", "az", "bx", "bz")))
    ux, uz = (F.col("bx") - F.col("ax")) / length, (F.col("bz") - F.col("az")) / length
    off = lambda p: F.abs((F.col(f"o{p}x") - F.col("ax")) * uz - (F.col(f"o{p}z") - F.col("az")) * ux)
    along = lambda p: (F.col(f"o{p}x") - F.col("ax")) * ux + (F.col(f"o{p}z") - F.col("az")) * uz
    lo = F.greatest(F.lit(0.0), F.least(along("a"), along("b")))
    hi = F.least(length, F.greatest(along("a"), along("b")))
    ok = (length > 0.001) & (off("a") <= tolerance) & (off("b") <= tolerance)
    j = j.where(ok).withColumns({"lo": lo, "hi": hi}).where(F.col("hi") - F.col("lo") > tolerance)
    j = j.withColumns({"x": F.col("ax") + ux * (F.col("lo") + F.col("hi")) / 2, "z": F.col("az") + uz * (F.col("lo") + F.col("hi")) / 2, "length": F.col("hi") - F.col("lo")})
    return rel.first_by(j, ["room", "other"], [F.desc("length"), "at", "at2"]).select("room", "other", "x", "z", "length")


def boundary_doors(rooms: DataFrame, origins: DataFrame, reach: float = 4.0, touch: float = 0.05) -> DataFrame:
    """(room, other, x, z, source, confidence, distance): a door for rooms that no route reaches, on the boundary towards routeable places of their floor.

    rooms: room, floor_name, ring array<struct<x, z>>; origins: other, floor_name, ring. The middle of the longest shared wall (confidence
    medium) comes first; else the boundary point nearest to an origin's boundary, medium within 0.75, else low. A ring of one point is
    an anchor. Ties go to the smaller ``other``. Rooms without an origin on their floor are left out.
    """
    both = rooms.select("room", "floor_name", "ring").unionByName(origins.select(F.col("other").alias("room"), "floor_name", "ring"))
    both = both.where(F.size("ring") >= 3).dropDuplicates(["room", "floor_name"])
    shared = shared_boundaries(both, touch).join(rooms.select("room").distinct(), "room", "left_semi").join(origins.select("other").distinct(), "other", "left_semi")
    first = rel.first_by(shared, ["room"], [F.desc("length"), "other"])
    first = first.select("room", "other", "x", "z", F.lit("geometry_shared_boundary_midpoint").alias("source"), F.lit("medium").alias("confidence"), F.lit(0.0).alias("distance"))
    edges = lambda df, name, p: df.select(name, "floor_name", F.explode(geo.ring_edges(geo.open_ring(F.col("ring")))).alias("e")).select(name, "floor_name", F.col("e.at").alias(f"{p}at"), *(F.col(f"e.{s}.{c}").alias(f"{p}{s}{c}") for s in "ab" for c in "xz"))
    left = edges(rooms.where(F.size("ring") >= 3).join(first.select("room"), "room", "left_anti"), "room", "r")
    near = spatial.nearest_segments(left, edges(origins, "other", "o"), "room", "other", ["rax", "raz", "rbx", "rbz"], ["oax", "oaz", "obx", "obz"], reach, ["floor_name"])
    level = F.when(F.col("distance") <= 0.75, "medium").otherwise("low")
    second = near.select("room", "other", "x", "z", F.lit("geometry_nearest_routeable_boundary").alias("source"), level.alias("confidence"), "distance")
    return first.unionByName(second)


def walkable_cells(segments: DataFrame, walls: DataFrame | None, radius: float, size: float) -> DataFrame:
    """(floor_name, cx, cz): cells along route segments (floor_name, x1, z1, x2, z2) without those that walls run through."""
    free = spatial.buffer_cells(segments, "x1", "z1", "x2", "z2", radius, size).select("floor_name", "cx", "cz").distinct()
    if walls is None:
        return free
    blocked = spatial.buffer_cells(walls, "x1", "z1", "x2", "z2", size / 2, size).select("floor_name", "cx", "cz").distinct()
    return free.join(blocked, ["floor_name", "cx", "cz"], "left_anti")


def cell_components(cells: DataFrame) -> DataFrame:
    """cells with ``component``: cells of a floor that touch side by side belong together."""
    c = cells.withColumn("id", F.concat_ws(":", "floor_name", "cx", "cz"))
    steps = [c.select(F.col("id").alias("a"), F.concat_ws(":", "floor_name", (F.col("cx") + i), (F.col("cz") + k)).alias("b")) for i, k in ((1, 0), (0, 1))]
    edges = steps[0].union(steps[1]).join(c.select(F.col("id").alias("b")), "b", "left_semi")
    return c.join(graph.components(c, edges).withColumnRenamed("node", "id"), "id").drop("id")


def bridge_surfaces(cells: DataFrame, size: float, longest: float = 125.0) -> DataFrame:
    """(floor_name, x1, z1, x2, z2): connectors that fuse the components of each floor, closest pair of cells first, none over ``longest``.

    A connector is ground like any other: what comes within ``longest`` of one is joined in a further pass.
    """
    c = rel.global_row_number(cell_components(cells), ["floor_name", "cx", "cz"], "id")
    at = lambda k: ((F.col(k) + 0.5) * size)
    elements = c.select("floor_name", F.col("component").alias("part"), "id", at("cx").alias("x1"), at("cz").alias("z1"), at("cx").alias("x2"), at("cz").alias("z2"))
    return bridge_elements(elements, ["floor_name"], longest, 4 * size).select("floor_name", "x1", "z1", "x2", "z2")


def bridge_elements(elements: DataFrame, keys: list[str], longest: float, radius: float) -> DataFrame:
    """``bridges.spanning_bridges`` over ground (keys, part, id, x1, z1, x2, z2) and over the bridges themselves, until none is added. Ids are longs from 0; those of bridges follow."""
    from ..operators.scratch import Scratch

    scratch = Scratch(elements.sparkSession, "ground")
    ground = scratch.save(elements, "ground-0")
    out, k = None, 0
    while True:
        new = scratch.save(bridges.spanning_bridges(ground, keys, longest, radius), f"new-{k}")
        out = new if out is None else out.unionByName(new)
        # two parts alone that are not joined stay so: a further pass needs a bridge and an island beside it
        if new.isEmpty():
            return out
        parts = ground.select(*keys, F.col("part").alias("id")).distinct()
        ends = lambda c: ground.select(*keys, F.col("id").alias(c), F.col("part").alias(f"part_{c}"))
        tied = new.join(ends("a"), [*keys, "a"]).join(ends("b"), [*keys, "b"])
        name = lambda c: F.struct(*keys, F.col(c))
        joined = graph.components(parts.select(name("id").alias("id")), tied.select(F.struct(*keys, F.col("part_a").alias("id")).alias("a"), F.struct(*keys, F.col("part_b").alias("id")).alias("b")))
        joined = joined.select(*(F.col(f"node.{c}").alias(c) for c in keys), F.col("node.id").alias("part"), F.col("component.id").alias("root"))
        if joined.select(*keys, "root").distinct().groupBy(*keys).count().where("count > 1").isEmpty():
            return out
        old = ground.join(joined, [*keys, "part"]).select(*keys, F.col("root").alias("part"), "id", "x1", "z1", "x2", "z2")
        first = (ground.agg(F.max("id")).first()[0] or 0) + 1
        added = rel.global_row_number(tied.select(*keys, F.col("part_a").alias("part"), "a", "b", "x1", "z1", "x2", "z2"), [*keys, "a", "b"], "n")
        added = added.join(joined, [*keys, "part"]).select(*keys, F.col("root").alias("part"), (F.col("n") + first).alias("id"), "x1", "z1", "x2", "z2")
        k += 1
        ground = scratch.save(old.unionByName(added), f"ground-{k}")


def first_existing(spark: SparkSession, paths: list[str], keys: tuple[str, ...] = ("rooms", "records", "data")) -> DataFrame:
    """Items of the first path that exists, in any file system Spark reads; a file that is no JSON gives no rows."""
    from ..sources.locations import read_items

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            return read_items(spark, path, keys)
    return spark.createDataFrame([], "file string, pos int, item variant")


def snapshot(stages: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Writes every named stage as a table and returns them read back: debugging without recomputation, and cut lineage."""
    out = {}
    for name, df in stages.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        out[name] = df.sparkSession.read.parquet(f"{path}/{name}")
    return out
