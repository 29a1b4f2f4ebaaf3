"""Meshes from rings, and per-row kernels over bounded arrays (one polygon, one line), as Arrow-batched pandas UDFs."""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo

_RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("z", T.DoubleType())]))
POINT = "struct<x:double,y:double,z:double>"


def _point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def extrude(ring: Column, depth: float) -> tuple[Column, Column]:
    """Slab below an open ring of struct<x, y, z>: (vertices, faces): top, bottom reversed, one quad per edge."""
    n = F.size(ring)
    vertices = F.concat(ring, F.transform(ring, lambda p: _point(p["x"], p["y"] - depth, p["z"])))
    sides = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array(i, (i + 1) % n, (i + 1) % n + n, i + n))
    return vertices, F.concat(F.array(F.sequence(F.lit(0), n - 1)), F.array(F.sequence(n * 2 - 1, n, F.lit(-1))), sides)


def wall(ring: Column, height: float, open_edges: Column | None = None) -> tuple[Column, Column]:
    """Wall quads on an open ring without the edges in open_edges (array of edge numbers)."""
    n = F.size(ring)
    vertices = F.concat(ring, F.transform(ring, lambda p: _point(p["x"], p["y"] + height, p["z"])))
    at = F.sequence(F.lit(0), n - 1)
    at = F.array_except(at, open_edges) if open_edges is not None else at
    return vertices, F.transform(at, lambda i: F.array(i, (i + 1) % n, (i + 1) % n + n, i + n))


def marker(x: Column, y: Column, z: Column, size: float = 0.35) -> Column:
    """Four corners of a square around a point."""
    return F.array(*(_point(x + i * size, y, z + j * size) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1))))


def strip_quad(x1: Column, z1: Column, x2: Column, z2: Column, half: float, y: float = 0.0) -> Column:
    """Corners of a road strip along a segment; null for a segment without length."""
    dx, dz = x2 - x1, z2 - z1
    n = F.sqrt(dx * dx + dz * dz)
    ok = n > geo.TINY
    safe = F.when(ok, n).otherwise(F.lit(1.0))
    ox, oz = -dz / safe * half, dx / safe * half
    return F.when(ok, F.array(_point(x1 + ox, F.lit(y), z1 + oz), _point(x2 + ox, F.lit(y), z2 + oz), _point(x2 - ox, F.lit(y), z2 - oz), _point(x1 - ox, F.lit(y), z1 - oz)))


def localise(points: Column, floor: Column) -> Column:
    """Floor-local heights: y minus the floor's, tiny values to 0."""
    return F.transform(points, lambda p: _point(p["x"], geo.zero_tiny(p["y"] - floor), p["z"]))


def grid_envelope(df: DataFrame, keys: Sequence[str], x: str, z: str, margin: float, cell: float, least: int = 4) -> DataFrame:
    """Cells (ix, iz) over each key's bounding box plus margin, at least ``least`` per side; two triangles each."""
    box = df.groupBy(*keys).agg((F.min(x) - margin).alias("x0"), (F.max(x) + margin).alias("x1"), (F.min(z) - margin).alias("z0"), (F.max(z) + margin).alias("z1"))
    side = lambda a, b: F.greatest(F.lit(least), F.ceil((F.col(b) - F.col(a)) / cell)).cast("int")
    box = box.withColumns({"nx": side("x0", "x1"), "nz": side("z0", "z1")})
    return box.withColumn("ix", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("iz", F.explode(F.sequence(F.lit(0), F.col("nz") - 1))).drop("x1", "z1")


def weld(df: DataFrame, keys: Sequence[str], x: str, z: str, scale: int = 1000) -> DataFrame:
    """Vertex number of each point: equal points (to a thousandth) share one, numbered by position."""
    return df.withColumn("vertex", F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.rint(F.col(x) * scale).cast("long"), F.rint(F.col(z) * scale).cast("long"))) - 1)


def face_lines(corners: DataFrame, face: Sequence[str], x: str, z: str) -> DataFrame:
    """(face, x1, z1, x2, z2): faces whose corners have exactly two distinct footprints are seen from above as lines, from the lesser point to the greater."""
    at = F.struct(F.col(x).alias("x"), F.col(z).alias("z"))
    lo, hi = F.col("lo"), F.col("hi")
    seen = corners.groupBy(*face).agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.collect_set(at).alias("all"))
    return seen.where(F.size("all") == 2).select(*face, lo["x"].alias("x1"), lo["z"].alias("z1"), hi["x"].alias("x2"), hi["z"].alias("z2"))


def wall_lines(meshes: DataFrame, keys: Sequence[str], material: str = "wall", scale: int = 1_000_000) -> DataFrame:
    """Lines on the floor plan of the wall faces of meshes (keys, name, material, vertices, faces): (keys, name, face, x1, z1, x2, z2)."""
    rounded = lambda c: F.rint(c * scale) / scale
    faces = meshes.where(F.col("material") == material).select(*keys, "name", "vertices", F.posexplode("faces").alias("face", "corner"))
    points = faces.select(*keys, "name", "face", F.explode(F.transform("corner", lambda i: F.element_at("vertices", i.cast("int") + 1))).alias("p"))
    points = points.select(*keys, "name", "face", rounded(F.col("p.x")).alias("x"), rounded(F.col("p.z")).alias("z"))
    return face_lines(points, [*keys, "name", "face"], "x", "z")


def navigation_resources(meshes: DataFrame, floor: str, required: Sequence = (), scale: int = 1000, include: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(vertices, polygons) of each floor from the faces of meshes (floor, name, vertices, faces).

    vertices: (floor, vertex, x, y, z), points equal to a thousandth are one, numbered by position. polygons: (floor, polygon, indexes),
    wound so that they face up; faces with under three distinct vertices go, and of polygons over the same vertices the first stays, in
    the order of mesh names and faces. Raises if a required floor has no polygon. ``include``, a condition over the columns of meshes, says
    which of them count: the filter reaches the scan.
    """
    meshes = meshes if include is None else meshes.where(include)
    faces = meshes.select(F.col(floor).alias(floor), "name", "vertices", F.posexplode("faces").alias("face", "corner"))
    points = faces.select(floor, "name", "face", F.posexplode(F.transform("corner", lambda i: F.element_at("vertices", i.cast("int") + 1))).alias("at", "p"))
    points = points.withColumns({f"k{c}": F.rint(F.col(f"p.{c}") * scale).cast("long") for c in "xyz"})
    vertices = points.select(floor, "kx", "ky", "kz").distinct()
    vertices = vertices.withColumn("vertex", F.row_number().over(Window.partitionBy(floor).orderBy("kx", "kz", "ky")) - 1)
    numbered = points.join(vertices, [floor, "kx", "ky", "kz"])
    ring = F.array_sort(F.collect_list(F.struct("at", "vertex", "p")))
    rings = numbered.groupBy(floor, "name", "face").agg(ring.alias("ring"))
    rings = rings.withColumn("up", F.transform("ring", lambda r: F.struct(r["p"]["x"].cast("double").alias("x"), r["p"]["z"].cast("double").alias("z"))))
    rings = rings.withColumns({"ids": F.transform("ring", lambda r: r["vertex"]), "key": F.array_sort(F.array_distinct(F.transform("ring", lambda r: r["vertex"])))}).where(F.size("key") >= 3)
    rings = rings.withColumn("indexes", F.when(geo.signed_area(F.col("up")) > 0, F.reverse("ids")).otherwise(F.col("ids")))
    first = rings.withColumn("rn", F.row_number().over(Window.partitionBy(floor, "key").orderBy("name", "face"))).where("rn = 1")
    polygons = first.select(floor, (F.row_number().over(Window.partitionBy(floor).orderBy("name", "face")) - 1).alias("polygon"), "indexes")
    if required:
        missing = sorted(set(required) - {r[0] for r in polygons.where(F.col(floor).isin(*required)).select(floor).distinct().collect()})
        if missing:
            raise ValueError(f"no walkable polygon on required floors: {missing}")
    return vertices.select(floor, "vertex", *((F.col(f"k{c}") / scale).alias(c) for c in "xyz")), polygons


def offset_concat(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str) -> DataFrame:
    """First vertex number of each part when the parts of a key are concatenated in order."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("first_vertex", F.coalesce(F.sum(size).over(w), F.lit(0)))


# --- kernels on one bounded array ---


def simplify(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Ramer-Douglas-Peucker with a stack; distances are to the infinite line through the ends."""
    if len(points) < 3:
        return list(points)
    keep = {0, len(points) - 1}
    stack = [(0, len(points) - 1)]
    while stack:
        lo, hi = stack.pop()
        (ax, az), (bx, bz) = points[lo], points[hi]
        n = math.hypot(bx - ax, bz - az)
        far, at = -1.0, None
        for i in range(lo + 1, hi):
            px, pz = points[i]
            d = abs((bx - ax) * (az - pz) - (ax - px) * (bz - az)) / n if n else math.hypot(px - ax, pz - az)
            if d > far:
                far, at = d, i
        if at is not None and far > tolerance:
            keep.add(at)
            stack += [(lo, at), (at, hi)]
    return [points[i] for i in sorted(keep)]


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Convex hull, counter-clockwise from the least point, without collinear points."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def half(seq):
        out: list[tuple[float, float]] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(pts) + half(reversed(pts))


def triangulate(ring: list[tuple[float, float]]) -> list[list[int]]:
    """Ears of a simple polygon as index triples; where no ear is found, a fan over the whole polygon."""

    def turn(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))
    left = list(range(len(ring))) if area >= 0 else list(range(len(ring) - 1, -1, -1))
    out = []
    while len(left) > 3:
        for k in range(len(left)):
            i, j, m = left[k - 1], left[k], left[(k + 1) % len(left)]
            a, b, c = ring[i], ring[j], ring[m]
            if turn(a, b, c) <= 1e-12:
                continue
            inside = any(p not in (i, j, m) and turn(a, b, ring[p]) >= 0 and turn(b, c, ring[p]) >= 0 and turn(c, a, ring[p]) >= 0 for p in left)
            if not inside:
                out.append([i, j, m])
                del left[k]
                break
        else:
            return [[0, k, k + 1] for k in range(1, len(ring) - 1)]
    return out + [left] if len(left) == 3 else out


def merged_ring(ring: list[tuple[int, int]], holes: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """One ring through the outer ring (counter-clockwise) and all holes (clockwise), each tied in by a bridge that is walked both ways."""

    def side(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def meets(p, q, a, b):
        """The open bridge p-q touches the edge a-b anywhere but at its own ends."""
        s = [side(p, q, a), side(p, q, b), side(a, b, p), side(a, b, q)]
        if s[0] * s[1] < 0 and s[2] * s[3] < 0:
            return True
        within = lambda v: v not in (p, q) and side(p, q, v) == 0 and min(p[0], q[0]) <= v[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= v[1] <= max(p[1], q[1])
        return within(a) or within(b)

    def opens(k, q):
        """The way from corner k of the ring to q leads into the inside."""
        a, v, b = ring[k - 1], ring[k], ring[(k + 1) % len(ring)]
        return side(a, v, q) > 0 and side(v, b, q) > 0 if side(a, v, b) > 0 else side(a, v, q) > 0 or side(v, b, q) > 0

    rest = sorted((list(h) for h in holes), key=lambda h: max(h), reverse=True)
    while rest:
        hole = rest.pop(0)
        at = max(range(len(hole)), key=lambda k: hole[k])
        p = hole[at]
        lines = [(r[k - 1], r[k]) for r in (ring, hole, *rest) for k in range(len(r))]
        near = sorted(range(len(ring)), key=lambda k: (ring[k][0] - p[0]) ** 2 + (ring[k][1] - p[1]) ** 2)
        k = next((k for k in near if ring[k] != p and opens(k, p) and not any(meets(p, ring[k], a, b) for a, b in lines)), None)
        if k is None:
            raise ValueError("a hole is not inside its ring")
        ring = ring[: k + 1] + hole[at:] + hole[: at + 1] + ring[k:]
    return ring


def constrained_delaunay(ring: list[tuple[int, int]], holes: Sequence[list[tuple[int, int]]] = ()) -> list[tuple[tuple[int, int], ...]]:
    """Triangles (counter-clockwise) of a polygon with holes, whole coordinates: ears are cut, then diagonals flipped until none can be better. Sides of the polygon stay."""

    def side(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    left = merged_ring(list(ring), [list(h) for h in holes])
    found = []
    while len(left) > 3:
        for k in range(len(left)):
            a, b, c = left[k - 1], left[k], left[(k + 1) % len(left)]
            turn = side(a, b, c)
            if turn == 0 and a == c:  # both ways of a bridge
                del left[k]
                break
            if turn > 0 and not any(p not in (a, b, c) and side(a, b, p) >= 0 and side(b, c, p) >= 0 and side(c, a, p) >= 0 for p in left):
                found.append((a, b, c))
                del left[k]
                break
        else:
            raise ValueError("no ear is left: the ring crosses itself")
    if side(*left) > 0:
        found.append(tuple(left))
    fixed = {frozenset((r[k - 1], r[k])) for r in (ring, *holes) for k in range(len(r))}
    by_edge: dict[tuple, tuple] = {}
    for t in found:
        by_edge |= {(t[k], t[(k + 1) % 3]): t for k in range(3)}
    todo = [e for e in by_edge if frozenset(e) not in fixed]
    while todo:
        a, b = todo.pop()
        t, o = by_edge.get((a, b)), by_edge.get((b, a))
        if t is None or o is None or frozenset((a, b)) in fixed:
            continue
        c, d = next(p for p in t if p not in (a, b)), next(p for p in o if p not in (a, b))
        if side(c, d, b) <= 0 or side(c, d, a) >= 0 or side(a, d, c) <= 0 or side(d, b, c) <= 0:
            continue
        m = [(p[0] - d[0], p[1] - d[1]) for p in (a, b, c)]
        n = [x * x + y * y for x, y in m]
        if sum(n[i] * (m[(i + 1) % 3][0] * m[(i + 2) % 3][1] - m[(i + 2) % 3][0] * m[(i + 1) % 3][1]) for i in range(3)) <= 0:
            continue  # d is not inside the circle through a, b, c
        for x in (t, o):
            for k in range(3):
                by_edge.pop((x[k], x[(k + 1) % 3]), None)
        for x in ((a, d, c), (d, b, c)):
            by_edge |= {(x[k], x[(k + 1) % 3]): x for k in range(3)}
        todo += [(a, d), (d, b), (b, c), (c, a)]
    return sorted({tuple(t) for t in by_edge.values()})


def triangulate_face(face: Sequence[int], vertices: Sequence[tuple[float, float, float]]) -> list[list[int]]:
    """Triangles of a flat polygon in space as vertex numbers, each wound like the face.

    Numbers out of range and corners on the spot of the one before go first; a face with under three left has no triangle. Ears are cut
    along the axis that the face's normal is nearest to; a face without area is a fan.
    """
    kept: list[int] = []
    for i in face:
        if 0 <= i < len(vertices) and not (kept and math.dist(vertices[kept[-1]], vertices[i]) < 1e-9):
            kept.append(int(i))
    while len(kept) > 1 and math.dist(vertices[kept[0]], vertices[kept[-1]]) < 1e-9:
        kept.pop()
    if len(kept) < 3:
        return []
    p = [vertices[i] for i in kept]
    flat = lambda axis: [(q[(axis + 1) % 3], q[(axis + 2) % 3]) for q in p]
    twice = [sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(s, s[1:] + s[:1], strict=True)) for s in map(flat, range(3))]
    axis = max(range(3), key=lambda k: abs(twice[k]))
    if abs(twice[axis]) < 2e-9:
        return [[kept[0], kept[k], kept[k + 1]] for k in range(1, len(kept) - 1)]
    seen, out = flat(axis), []
    for i, j, k in triangulate(seen):
        (ax, ay), (bx, by), (cx, cy) = seen[i], seen[j], seen[k]
        turn = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
        out.append([kept[i], kept[k], kept[j]] if turn * twice[axis] < 0 else [kept[i], kept[j], kept[k]])
    return out


def _xz(points) -> list[tuple[float, float]]:
    return [(float(p["x"]), float(p["z"])) for p in points]


def _rows(points) -> list[dict]:
    return [{"x": x, "z": z} for x, z in points]


def simplify_udf(tolerance: float):
    @F.pandas_udf(_RING)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda p: None if p is None else _rows(simplify(_xz(p), tolerance)))

    return run


@F.pandas_udf(_RING)
def hull_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda p: None if p is None else _rows(hull(_xz(p))))


@F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def triangulate_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda p: None if p is None else triangulate(_xz(p)))


# --- binary glTF 2.0 ---


def glb(meshes: list[dict]) -> bytes:
    """One file from meshes {name, material, color, vertices [(x, y, z)], triangles [(i, j, k)]}; empty meshes are skipped, materials shared by name."""
    blob = bytearray()
    views, accessors, nodes, gltf_meshes, materials = [], [], [], [], []
    material_at: dict[str, int] = {}

    def add(data: bytes, target: int) -> int:
        blob.extend(bytes(-len(blob) % 4))
        views.append({"buffer": 0, "byteOffset": len(blob), "byteLength": len(data), "target": target})
        blob.extend(data)
        return len(views) - 1

    for m in meshes:
        v, t = m["vertices"], m["triangles"]
        if not len(v) or not len(t):
            continue
        if m["material"] not in material_at:
            material_at[m["material"]] = len(materials)
            materials.append({"name": m["material"], "pbrMetallicRoughness": {"baseColorFactor": list(m.get("color") or (0.8, 0.8, 0.8, 1.0)), "metallicFactor": 0.0}})
        pos = struct.pack(f"<{3 * len(v)}f", *(c for p in v for c in p))
        packed = list(struct.iter_unpack("<3f", pos))
        accessors.append({"bufferView": add(pos, 34962), "componentType": 5126, "count": len(v), "type": "VEC3", "min": [min(p[k] for p in packed) for k in range(3)], "max": [max(p[k] for p in packed) for k in range(3)]})
        idx = struct.pack(f"<{3 * len(t)}I", *(i for tri in t for i in tri))
        accessors.append({"bufferView": add(idx, 34963), "componentType": 5125, "count": 3 * len(t), "type": "SCALAR"})
        gltf_meshes.append({"name": m["name"], "primitives": [{"attributes": {"POSITION": len(accessors) - 2}, "indices": len(accessors) - 1, "material": material_at[m["material"]]}]})
        nodes.append({"name": m["name"], "mesh": len(gltf_meshes) - 1})
    doc = {"asset": {"version": "2.0", "generator": "cairnflow"}, "scene": 0, "scenes": [{"nodes": list(range(len(nodes)))}]}
    for name, part in (("nodes", nodes), ("meshes", gltf_meshes), ("materials", materials), ("accessors", accessors), ("bufferViews", views)):
        if part:
            doc[name] = part
    if blob:
        doc["buffers"] = [{"byteLength": len(blob)}]
    text = json.dumps(doc, separators=(",", ":"), sort_keys=True).encode()
    text += b" " * (-len(text) % 4)
    blob.extend(bytes(-len(blob) % 4))
    chunks = struct.pack("<II", len(text), 0x4E4F534A) + text + (struct.pack("<II", len(blob), 0x004E4942) + bytes(blob) if blob else b"")
    return struct.pack("<III", 0x46546C67, 2, 12 + len(chunks)) + chunks


def glb_files(meshes: DataFrame, key: str) -> DataFrame:
    """(key, content BINARY): one file for each key from rows (key, name, material, ring array<struct<x, y, z>>); a key is one bounded artifact."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf.sort_values("name").itertuples(index=False):
            v = [(p["x"], p["y"], p["z"]) for p in r.ring]
            out.append({"name": r.name, "material": r.material, "vertices": v, "triangles": triangulate_face(range(len(v)), v)})
        return pd.DataFrame({key: [pdf[key].iloc[0]], "content": [glb(out)]})

    return meshes.groupBy(key).applyInPandas(build, f"{key} {dict(meshes.dtypes)[key]}, content binary")


def read_glb(content: bytes) -> dict:
    """JSON part of a file, after checking magic, version and lengths."""
    magic, version, size = struct.unpack_from("<III", content)
    if magic != 0x46546C67 or version != 2 or size != len(content):
        raise ValueError("not a binary glTF 2.0 file")
    n, kind = struct.unpack_from("<II", content, 12)
    if kind != 0x4E4F534A:
        raise ValueError("the first chunk is not JSON")
    return json.loads(content[20 : 20 + n])
