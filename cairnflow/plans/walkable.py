"""Walkable ground of floors on exact areas: corridors around routes, bridged, without walls, as cells and as a triangle mesh.

Every step is a join or an aggregate keyed by floor and cell; only the edges of one ring, and the rings of one part, meet in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..operators import mesh, overlay
from ..operators import relational as rel
from .surfaces import bridge_elements

#: Fixed values, in metres: corridor radius, clearance of walls, cell size, longest bridge. A bridge is 2.5 times as wide as a corridor, an authored connector 1.5 times with ends of twice the radius.
RADIUS, CLEARANCE, CELL, BRIDGE = 0.6, 0.15, 0.5, 125.0
BRIDGE_WIDTH, CONNECTOR_WIDTH, CONNECTOR_END = 2.5, 1.5, 2.0
#: A cell is ground if at least this share and this area of it is covered, and no wall runs in it for more than RUN unless BYPASS of it belongs to connectors.
LEAST_SHARE, LEAST_AREA, RUN, BYPASS = 0.02, 0.001, 0.05, 0.2
_ENDS = ("x1", "z1", "x2", "z2")
_SPOT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("z", T.DoubleType())])
_TRIANGLES = T.ArrayType(T.ArrayType(_SPOT))


def _around(lines: DataFrame, radius: float, key: str) -> DataFrame:
    return lines.select(key, overlay.capsule(*(F.col(c).cast("double") for c in _ENDS), radius).alias("ring"))


def _shapes(rings: list[DataFrame], key: str) -> DataFrame:
    out = rings[0]
    for r in rings[1:]:
        out = out.unionByName(r)
    return overlay.ring_edges(out, [key])


def _weighted(edges: DataFrame, key: str) -> DataFrame:
    return edges.select(key, "ax", "az", "bx", "bz", F.lit(1).cast("long").alias("wa"), F.lit(0).cast("long").alias("wb"))


def connector_shapes(connectors: DataFrame | None, targeted: DataFrame | None, key: str = "floor_name", radius: float = RADIUS) -> list[DataFrame]:
    """Rings of authored connectors (wide, with round pads at both ends) and of targeted ones (as wide as a corridor)."""
    out = []
    if connectors is not None:
        pad = lambda a, b: connectors.select(key, F.col(a).alias("x1"), F.col(b).alias("z1"), F.col(a).alias("x2"), F.col(b).alias("z2"))
        out += [_around(connectors, radius * CONNECTOR_WIDTH, key), _around(pad("x1", "z1"), radius * CONNECTOR_END, key), _around(pad("x2", "z2"), radius * CONNECTOR_END, key)]
    if targeted is not None:
        out.append(_around(targeted, radius, key))
    return out


def targeted_lines(points: DataFrame, pairs: DataFrame, key: str = "floor_name", shortest: float = 0.05, longest: float = BRIDGE) -> DataFrame:
    """(key, x1, z1, x2, z2) between the points (key, external_id, x, z) of one floor that a pair (a, b) names, in either order; those too close or too far are left out."""
    at = lambda k, n: points.select(key, F.col("external_id").alias(k), F.col("x").alias(f"x{n}"), F.col("z").alias(f"z{n}"))
    names = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    j = names.join(at("a", 1), "a").join(at("b", 2), [key, "b"])
    length = geo.distance(*(F.col(c) for c in _ENDS))
    return j.where((length > shortest) & (length <= longest)).select(key, *_ENDS)


def corridor_ground(routes: DataFrame, walls: DataFrame | None = None, connectors: DataFrame | None = None, targeted: DataFrame | None = None, key: str = "floor_name", radius: float = RADIUS, clearance: float = CLEARANCE, longest: float | None = BRIDGE) -> tuple[DataFrame, DataFrame | None]:
    """Boundaries (key, ax, az, bx, bz) of the ground and of the connectors, or None without any.

    routes, walls, connectors, targeted: segments (key, x1, z1, x2, z2). Corridors are joined; parts that lie apart are bridged, closest
    pair first, none over ``longest`` (None: no bridges); walls take ``clearance`` to both sides; connectors come last and cross walls.
    """
    ground = overlay.boundary(_shapes([_around(routes, radius, key)], key), [key])
    if longest is not None:
        parts = overlay.polygons(overlay.rings(ground, [key]), [key])
        sides = rel.global_row_number(overlay.polygon_edges(parts, [key, "part"]), [key, "part", "ax", "az", "bx", "bz"], "id")
        metres = (F.col(c) / overlay.SCALE for c in ("ax", "az", "bx", "bz"))
        sides = sides.select(key, "part", "id", *(c.alias(n) for c, n in zip(metres, _ENDS, strict=True)))
        found = bridge_elements(sides, [key], longest, 4.0)
        bridges = overlay.ring_edges(_around(found, radius * BRIDGE_WIDTH, key), [key])
        ground = overlay.boundary(_weighted(ground, key).unionByName(bridges), [key])
    if walls is not None:
        blocked = walls.select(key, overlay.strip(*(F.col(c).cast("double") for c in _ENDS), clearance).alias("ring")).where("ring is not null")
        ground = overlay.boundary(_weighted(ground, key).unionByName(overlay.ring_edges(blocked, [key], side=F.lit(False))), [key], "difference")
    shapes = connector_shapes(connectors, targeted, key, radius)
    if not shapes:
        return ground, None
    bypass = overlay.boundary(_shapes(shapes, key), [key])
    return overlay.boundary(_weighted(ground, key).unionByName(_weighted(bypass, key)), [key]), bypass


def occupancy(ground: DataFrame, walls: DataFrame | None = None, bypass: DataFrame | None = None, key: str = "floor_name", size: float = CELL) -> DataFrame:
    """(key, part, cx, cz, x1, z1, x2, z2): the cells of every part of the ground that can be walked on, trimmed to the part's box.

    A wall counts for a cell by the length of it inside, so one that only touches a corner blocks nothing and a door between two jambs
    stays open. Parts are numbered by area and have cells of their own.
    """
    parts = overlay.polygons(overlay.rings(ground, [key]), [key])
    edges = overlay.polygon_edges(parts, [key, "part"])
    cells = overlay.cell_areas(edges, [key, "part"], size).where(F.col("area") >= max(LEAST_AREA, LEAST_SHARE * size * size))
    if walls is not None:
        named = walls.select(key, F.struct(*_ENDS).alias("wall"), *_ENDS).distinct()
        runs = overlay.cell_runs(named, [key, "wall"], _ENDS, size).groupBy(key, "wall", "cx", "cz").agg(F.sum("run").alias("run"))
        blocked = runs.where(F.col("run") > RUN).select(key, "cx", "cz").distinct()
        if bypass is not None:
            free = overlay.cell_areas(bypass, [key], size).where(F.col("area") >= BYPASS * size * size).select(key, "cx", "cz")
            blocked = blocked.join(free, [key, "cx", "cz"], "left_anti")
        cells = cells.join(blocked, [key, "cx", "cz"], "left_anti")
    box = edges.groupBy(key, "part").agg(*(f(c).alias(n) for f, c, n in ((F.min, "ax", "west"), (F.min, "az", "south"), (F.max, "ax", "east"), (F.max, "az", "north"))))
    trimmed = {n: f(F.col(c) * size + more, F.col(b) / overlay.SCALE) for n, f, c, more, b in (("x1", F.greatest, "cx", 0.0, "west"), ("z1", F.greatest, "cz", 0.0, "south"), ("x2", F.least, "cx", size, "east"), ("z2", F.least, "cz", size, "north"))}
    out = cells.join(box, [key, "part"]).withColumns(trimmed).where("x2 - x1 > 0.001 and z2 - z1 > 0.001")
    return out.select(key, "part", "cx", "cz", *_ENDS)


def _triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces with their triangles; corners are whole units again while they are cut."""
    spot = pa.struct([("x", pa.float64()), ("z", pa.float64())])
    whole = lambda r: [(round(p["x"] * overlay.SCALE), round(p["z"] * overlay.SCALE)) for p in r]
    for batch in batches:
        found = []
        for ring, holes in zip(batch.column("ring").to_pylist(), batch.column("holes").to_pylist(), strict=True):
            cut = mesh.constrained_delaunay(whole(ring), [whole(h) for h in holes])
            found.append([[{"x": x / overlay.SCALE, "z": z / overlay.SCALE} for x, z in t] for t in cut])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.list_(spot)))], names=[*batch.schema.names, "triangles"])


def ground_mesh(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, piece, ring, holes, area, triangles): cells dissolved into polygons with holes and cut into triangles without a grid line inside, the largest piece first.

    Constrained Delaunay triangles: sides are those of the polygon, and no diagonal could be swapped for a better one. One piece is one row.
    """
    pieces = overlay.polygons(overlay.rings(overlay.dissolve(cells, keys), keys), keys, name="piece")
    return pieces.mapInArrow(_triangles, T.StructType([*pieces.schema.fields, T.StructField("triangles", _TRIANGLES)]))


def union_slabs(rings: DataFrame, keys: list[str], padding: float = 0.25) -> DataFrame:
    """(keys, part, ring, holes, area): the union of the rings (keys, ring) of a floor, ``padding`` wider with mitred corners, the largest part first."""
    whole = overlay.boundary(overlay.ring_edges(rings, keys), keys)
    wider = overlay.offset(whole, keys, padding) if padding else whole
    return overlay.polygons(overlay.rings(wider, keys), keys)
