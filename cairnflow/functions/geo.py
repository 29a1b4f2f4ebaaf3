"""Planar geometry as Columns: projections, distances, segments and rings (arrays of struct<x, z>)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES = 111_320.0
METRES_LAT = 110_540.0
TINY = 1e-6


def zero_tiny(c: Column) -> Column:
    return F.when(F.abs(c) < TINY, F.lit(0.0)).otherwise(c)


def to_local(lon: Column, lat: Column, origin_lon: float, origin_lat: float) -> tuple[Column, Column]:
    """Metres east and north of the origin."""
    return zero_tiny((lon - origin_lon) * (METRES * math.cos(origin_lat * math.pi / 180))), zero_tiny((lat - origin_lat) * METRES)


@dataclass(frozen=True)
class Reference:
    """A door known in both frames: lon/lat, local anchor (x, z) and placement origin (x, z). No defaults: two published origins differ."""

    lon: float
    lat: float
    anchor: tuple[float, float]
    origin: tuple[float, float]
    scale: float

    @property
    def x(self) -> float:
        return self.origin[0] + self.scale * self.anchor[0]

    @property
    def z(self) -> float:
        return self.origin[1] - self.scale * self.anchor[1]

    @property
    def per_lon(self) -> float:
        return METRES * math.cos(self.lat * math.pi / 180)


def to_campus(lon: Column, lat: Column, ref: Reference) -> tuple[Column, Column]:
    """Placement coordinates; z points south."""
    return F.lit(ref.x) + (lon - ref.lon) * ref.per_lon * ref.scale, F.lit(ref.z) - (lat - ref.lat) * METRES * ref.scale


def from_campus(x: Column, z: Column, ref: Reference) -> tuple[Column, Column]:
    return F.lit(ref.lon) + (x - ref.x) / ref.scale / ref.per_lon, F.lit(ref.lat) - (z - ref.z) / ref.scale / METRES


def affine_inverse(m: list[float], t: list[float], x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Point in the frame of a 3x3 basis (rows) and a translation: M^-1 (p - t) in closed form."""
    a, b, c, d, e, f, g, h, i = m
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    if abs(det) < 1e-12:
        raise ValueError("the basis has no inverse")
    inv = [[(e * i - f * h), (c * h - b * i), (b * f - c * e)], [(f * g - d * i), (a * i - c * g), (c * d - a * f)], [(d * h - e * g), (b * g - a * h), (a * e - b * d)]]
    p = (x - t[0], y - t[1], z - t[2])
    return tuple(sum((p[k] * (row[k] / det) for k in range(1, 3)), p[0] * (row[0] / det)) for row in inv)


def distance(x1: Column, z1: Column, x2: Column, z2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (z2 - z1) * (z2 - z1))


def degrees_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column, metres_lat: float = METRES_LAT) -> Column:
    """Metres between two close points; the metres of a degree of latitude are a parameter."""
    mean = F.radians((lat1 + lat2) / 2)
    return F.hypot((lon2 - lon1) * METRES * F.cos(mean), (lat2 - lat1) * metres_lat)


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def segment_t(px: Column, pz: Column, ax: Column, az: Column, bx: Column, bz: Column) -> Column:
    """Place of the nearest point along the segment, 0 to 1; 0 for a segment without length."""
    dx, dz = bx - ax, bz - az
    n = dx * dx + dz * dz
    return F.when(n <= TINY, F.lit(0.0)).otherwise(clamp01(((px - ax) * dx + (pz - az) * dz) / F.when(n <= TINY, F.lit(1.0)).otherwise(n)))


def point_segment(px: Column, pz: Column, ax: Column, az: Column, bx: Column, bz: Column) -> Column:
    t = segment_t(px, pz, ax, az, bx, bz)
    return distance(px, pz, ax + t * (bx - ax), az + t * (bz - az))


def cross(ax: Column, az: Column, bx: Column, bz: Column, cx: Column, cz: Column) -> Column:
    return (bx - ax) * (cz - az) - (bz - az) * (cx - ax)


def segments_cross(a: list[Column], b: list[Column]) -> Column:
    """Interiors of the segments (x1, z1, x2, z2) cross: each has its ends strictly on both sides of the other."""
    return (cross(*a, b[0], b[1]) * cross(*a, b[2], b[3]) < 0) & (cross(*b, a[0], a[1]) * cross(*b, a[2], a[3]) < 0)


# --- rings: arrays of struct<x: double, z: double> ---


def open_ring(ring: Column) -> Column:
    """Without a repeated last point."""
    closed = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def ring_edges(ring: Column) -> Column:
    """Array of struct<at, a, b> with wrap-around; ring must be open."""
    nxt = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    pairs = F.zip_with(ring, nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(pairs, lambda p, i: F.struct(i.alias("at"), p["a"].alias("a"), p["b"].alias("b")))


def signed_area(ring: Column) -> Column:
    """Shoelace over an open ring."""
    return F.aggregate(ring_edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["z"] - e["b"]["x"] * e["a"]["z"]) / 2


def point_in_ring(px: Column, pz: Column, ring: Column) -> Column:
    """Even-odd; the boundary counts as inside."""

    def crosses(e: Column) -> Column:
        ax, az, bx, bz = e["a"]["x"], e["a"]["z"], e["b"]["x"], e["b"]["z"]
        spans = (az > pz) != (bz > pz)
        return spans & (px < (bx - ax) * (pz - az) / F.when(spans, bz - az).otherwise(F.lit(1.0)) + ax)

    edges = ring_edges(ring)
    on = F.exists(edges, lambda e: point_segment(px, pz, e["a"]["x"], e["a"]["z"], e["b"]["x"], e["b"]["z"]) <= TINY)
    return on | (F.size(F.filter(edges, crosses)) % 2 == 1)


def newell(points: Column) -> Column:
    """Normal (not normalised) of a polygon in space: array of struct<x, y, z>."""
    nxt = F.concat(F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    pairs = F.zip_with(points, nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))

    def add(s: Column, p: Column) -> Column:
        a, b = p["a"], p["b"]
        return F.struct(
            (s["x"] + (a["y"] - b["y"]) * (a["z"] + b["z"])).alias("x"),
            (s["y"] + (a["z"] - b["z"]) * (a["x"] + b["x"])).alias("y"),
            (s["z"] + (a["x"] - b["x"]) * (a["y"] + b["y"])).alias("z"),
        )

    return F.aggregate(pairs, zero, add)


def edge_key(ax: Column, az: Column, bx: Column, bz: Column, scale: int = 1000) -> Column:
    """Undirected key of an edge: ends as whole thousandths, the smaller first."""
    end = lambda x, z: F.struct(F.rint(x * scale).cast("long").alias("x"), F.rint(z * scale).cast("long").alias("z"))
    a, b = end(ax, az), end(bx, bz)
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def bbox_distance(x: Column, z: Column, x0: Column, z0: Column, x1: Column, z1: Column) -> Column:
    """0 inside the box, else the distance to it."""
    return F.hypot(F.greatest(x0 - x, F.lit(0.0), x - x1), F.greatest(z0 - z, F.lit(0.0), z - z1))
