import math
import random
from fractions import Fraction
from itertools import combinations

from pyspark.sql import functions as F

from cairnflow.operators import mesh, overlay
from cairnflow.plans import walkable

XZ = "array<struct<x:double,z:double>>"
SEG = "floor_name string, x1 double, z1 double, x2 double, z2 double"


def ring(*points):
    return [{"x": float(x), "z": float(z)} for x, z in points]


def box(x, z, w, h):
    return ring((x, z), (x + w, z), (x + w, z + h), (x, z + h))


def shoelace(p):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, [*p[1:], *p[:1]], strict=True))


def clipped(p, q):
    """Convex p inside convex q (counter-clockwise), exact."""
    for a, b in zip(q, [*q[1:], *q[:1]], strict=True):
        side = lambda v: (b[0] - a[0]) * (v[1] - a[1]) - (b[1] - a[1]) * (v[0] - a[0])  # noqa: B023, E731
        out = []
        for u, v in zip(p, [*p[1:], *p[:1]], strict=True):
            if side(u) >= 0:
                out.append(u)
            if side(u) * side(v) < 0:
                t = Fraction(side(u)) / (side(u) - side(v))
                out.append((u[0] + t * (v[0] - u[0]), u[1] + t * (v[1] - u[1])))
        p = out
        if not p:
            return p
    return p


def union_twice(polygons):
    """Twice the area of the union of convex polygons by inclusion and exclusion."""
    total = Fraction(0)
    for n in range(1, len(polygons) + 1):
        for some in combinations(polygons, n):
            p = some[0]
            for q in some[1:]:
                p = clipped(p, q)
            if p:
                total += (-1) ** (n + 1) * abs(shoelace(p))
    return total


def test_unions_of_triangles_and_boxes_equal_inclusion_exclusion(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(12):
        shapes = []
        for _ in range(6):
            if rng.random() < 0.4:
                x, z, w, h = (rng.randrange(0, 12) * 500 for _ in range(4))
                p = [(x, z), (x + w + 500, z), (x + w + 500, z + h + 500), (x, z + h + 500)]
            else:
                p = [(rng.randrange(0, 9000), rng.randrange(0, 9000)) for _ in range(3)]
                p = p if shoelace(p) > 0 else p[::-1]
            if shoelace(p):
                shapes.append(p)
                rows.append((k, ring(*((x / 1000, z / 1000) for x, z in (p if rng.random() < 0.5 else p[::-1])))))  # either turn, and some closed
        want[k] = union_twice(shapes)
    got = overlay.union_area(spark.createDataFrame(rows, f"k int, ring {XZ}").repartition(5), ["k"]).collect()
    assert {r.k: r.twice for r in got}.keys() == want.keys()
    for r in got:
        assert abs(r.twice - float(want[r.k])) < 2e5  # crossings are snapped: less than a unit along less than 100 m of edges


def test_parts_holes_and_shared_walls(spark):
    frame = [box(0, 0, 10, 2), box(0, 8, 10, 2), box(0, 2, 2, 6), box(8, 2, 2, 6)]  # four rooms that share walls around a court
    rows = [("a", r) for r in (*frame, box(4, 4, 2, 2), box(20, 0, 3, 3), box(23, 3, 1, 1))]  # a pavilion in the court, two rooms that touch at a corner
    rows += [("a", None), ("a", ring((0, 0), (1, 1))), ("a", ring((0, 0), (1, 1), (2, 2))), (None, box(0, 0, 1, 1)), ("b", [*box(0, 0, 5, 5), *box(0, 0, 5, 5)[:1]])]
    df = spark.createDataFrame(rows, f"floor string, ring {XZ}").where("floor is not null")
    parts = overlay.polygons(overlay.rings(overlay.boundary(overlay.ring_edges(df, ["floor"]), ["floor"]), ["floor"]), ["floor"]).collect()
    got = sorted((r.floor, r.part, r.area, len(r.ring), [len(h) for h in r.holes]) for r in parts)
    assert got == [("a", 1, 64.0, 4, [4]), ("a", 2, 9.0, 4, []), ("a", 3, 4.0, 4, []), ("a", 4, 1.0, 4, []), ("b", 1, 25.0, 4, [])]
    assert overlay.union_area(df.limit(0), ["floor"]).count() == 0


def test_difference_intersection_and_holes(spark):
    rows = [("k", box(0, 0, 10, 10), True, False), ("k", box(2, 2, 3, 3), True, True), ("k", box(4, 4, 10, 10), False, False)]
    df = spark.createDataFrame(rows, f"k string, ring {XZ}, first boolean, hole boolean")
    edges = overlay.ring_edges(df, ["k"], side=F.col("first"), hole=F.col("hole"))
    area = lambda inside: overlay.areas(overlay.boundary(edges, ["k"], inside), ["k"]).first().twice / 2e6
    assert (area("union"), area("difference"), area("intersection")) == (91.0, 91.0 - 35.0, 35.0)


def test_mitred_offset(spark):
    rows = [("box", box(0, 0, 4, 3)), ("ell", ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4))), ("spike", ring((0, 0), (100, 0.5), (0, 1)))]
    df = spark.createDataFrame(rows, f"k string, ring {XZ}")
    wide = overlay.offset(overlay.boundary(overlay.ring_edges(df, ["k"]), ["k"]), ["k"], 0.25)
    got = {r.k: r.twice / 2e6 for r in overlay.areas(wide, ["k"]).collect()}
    assert got["box"] == 4.5 * 3.5 and got["ell"] == 4.5 * 4.5 - 2 * 2
    assert abs(max(r.bx for r in wide.where("k = 'spike'").collect()) / 1000 - 100) < 0.3  # a mitre of 200 m would be too long
    slabs = walkable.union_slabs(df.where("k <> 'spike'"), ["k"]).collect()
    assert {(r.k, r.area) for r in slabs} == {("box", 15.75), ("ell", 16.25)}


def capsule_area(length, r, quarter=8):
    return 2 * r * length + 4 * quarter * 0.5 * r * r * math.sin(math.pi / 2 / quarter)


def test_corridors_walls_and_connectors(spark):
    straight = [(f, 0.0, 0.0, 10.0, 0.0) for f in ("plain", "wall", "link", "aimed")]
    route = spark.createDataFrame([*straight, ("point", 0.0, 0.0, 0.0, 0.0), ("bend", 0.0, 0.0, 3.0, 0.0), ("bend", 3.0, 0.0, 3.0, 3.0)], SEG)
    walls = spark.createDataFrame([(f, 5.0, -3.0, 5.0, 3.0) for f in ("wall", "link", "aimed")], SEG)
    links = spark.createDataFrame([("link", 4.0, 0.0, 6.0, 0.0)], SEG)
    points = spark.createDataFrame([("aimed", "p", 4.0, 0.0), ("aimed", "q", 6.0, 0.0), ("point", "q", 0.0, 0.0), ("aimed", "far", 500.0, 0.0)], "floor_name string, external_id string, x double, z double")
    lines = walkable.targeted_lines(points, spark.createDataFrame([("q", "p"), ("p", "q"), ("p", "far")], "a string, b string"))
    assert [tuple(r) for r in lines.collect()] == [("aimed", 4.0, 0.0, 6.0, 0.0)]
    ground, bypass = walkable.corridor_ground(route, walls, links, lines, longest=None)
    area = {r.floor_name: r.twice / 2e6 for r in overlay.areas(ground, ["floor_name"]).collect()}
    rings = {r.floor_name: r["count"] for r in overlay.rings(ground, ["floor_name"]).groupBy("floor_name").count().collect()}
    assert abs(area["plain"] - capsule_area(10, 0.6)) < 0.02 and abs(area["point"] - capsule_area(0, 0.6)) < 0.01
    assert abs(area["wall"] - (capsule_area(10, 0.6) - 0.3 * 1.2)) < 0.02 and rings["wall"] == 2
    assert rings["link"] == rings["aimed"] == 1 and abs(area["aimed"] - capsule_area(10, 0.6)) < 0.02  # connectors cross walls
    by = {r.floor_name: r.twice / 2e6 for r in overlay.areas(bypass, ["floor_name"]).collect()}
    assert capsule_area(2, 0.9) < by["link"] < capsule_area(2, 0.9) + 2 * capsule_area(0, 1.2) and abs(by["aimed"] - capsule_area(2, 0.6)) < 0.02


def test_islands_of_a_floor_are_bridged(spark):
    route = spark.createDataFrame([("1", 0.0, 0.0, 2.0, 0.0), ("1", 6.0, 0.0, 8.0, 0.0), ("1", 300.0, 0.0, 301.0, 0.0)], SEG)
    ground, _ = walkable.corridor_ground(route)
    assert overlay.rings(ground, ["floor_name"]).where("twice > 0").count() == 2


def test_a_door_between_two_jambs_stays_open(spark):
    route = spark.createDataFrame([(f, 0.0, 0.25, 4.0, 0.25) for f in ("open", "shut")], SEG)
    jambs = [(f, 2.0, -5.0, 2.0, 0.25 - gap / 2) for f, gap in (("open", 1.0), ("shut", 0.0))] + [(f, 2.0, 0.25 + gap / 2, 2.0, 5.0) for f, gap in (("open", 1.0), ("shut", 0.0))]
    walls = spark.createDataFrame(jambs, SEG)
    ground, none = walkable.corridor_ground(route, walls, longest=None)
    cells = walkable.occupancy(ground, walls)
    pieces = walkable.ground_mesh(cells.withColumn("part", F.lit(1)), ["floor_name"]).groupBy("floor_name").count().collect()
    assert none is None and {r.floor_name: r["count"] for r in pieces} == {"open": 1, "shut": 2}


def test_cells_against_clipping_and_triangles_cover_them(spark):
    p = [(0.13, 0.2), (5.1, 1.7), (4.4, 6.3), (1.9, 4.2)]
    edges = overlay.boundary(overlay.ring_edges(spark.createDataFrame([(1, ring(*p))], f"k int, ring {XZ}"), ["k"]), ["k"])
    got = {(r.cx, r.cz): r.area for r in overlay.cell_areas(edges, ["k"], 0.5).collect()}
    units = [(round(x * 1000), round(z * 1000)) for x, z in p]
    inside = [units[0], units[1], units[2]], [units[0], units[2], units[3]]
    for i in range(-1, 12):
        for j in range(-1, 14):
            cell = [(i * 500, j * 500), (i * 500 + 500, j * 500), (i * 500 + 500, j * 500 + 500), (i * 500, j * 500 + 500)]
            want = sum(abs(shoelace(c)) for t in inside if (c := clipped(cell, t if shoelace(t) > 0 else t[::-1]))) / 2e6
            assert abs(got.get((i, j), 0.0) - float(want)) < 1e-8
    cells = walkable.occupancy(edges, key="k")
    mesh_ = walkable.ground_mesh(cells, ["k", "part"]).collect()
    covered = sum((r.x2 - r.x1) * (r.z2 - r.z1) for r in cells.collect())
    triangles = [[(q.x, q.z) for q in t] for r in mesh_ for t in r.triangles]
    assert all(shoelace(t) > 0 for t in triangles) and abs(sum(shoelace(t) for t in triangles) / 2 - covered) < 1e-6
    corners = {(q.x, q.z) for r in mesh_ for outline in (r.ring, *r.holes) for q in outline}
    assert {q for t in triangles for q in t} <= corners  # no grid line inside


def test_a_piece_with_holes_of_different_shapes(spark):
    gone = {(1, 1), (3, 1), (3, 2), (5, 5), (6, 5), (6, 6)}
    cells = [(1, float(i), float(j), i + 1.0, j + 1.0) for i in range(9) for j in range(9) if (i, j) not in gone]
    piece = walkable.ground_mesh(spark.createDataFrame(cells, "k int, x1 double, z1 double, x2 double, z2 double"), ["k"]).first()
    triangles = [[(q.x, q.z) for q in t] for t in piece.triangles]
    assert sorted(len(h) for h in piece.holes) == [4, 4, 6] and piece.area == 75.0
    assert sum(shoelace(t) for t in triangles) / 2 == 75.0 and len(triangles) == 4 + (4 + 2) + (4 + 2) + (6 + 2) - 2


def test_walls_on_grid_lines_run_on_both_sides(spark):
    walls = spark.createDataFrame([("1", 1.0, 0.1, 1.0, 0.4), ("1", 0.2, 0.2, 0.2, 0.2), ("1", 0.0, 0.0, 1.0, 1.0)], SEG).withColumn("id", F.monotonically_increasing_id())
    runs = overlay.cell_runs(walls, ["x1", "z1"], ["x1", "z1", "x2", "z2"], 0.5).collect()
    got = sorted((r.x1, r.cx, r.cz, round(r.run, 6)) for r in runs if r.run > 0)
    assert got == [(0.0, 0, 0, 0.707107), (0.0, 1, 1, 0.707107), (1.0, 1, 0, 0.3), (1.0, 2, 0, 0.3)]


def test_triangulation_is_exact_and_delaunay():
    rng = random.Random(5)
    for _ in range(60):
        cells = {(0, 0)}
        size = rng.randrange(3, 90)
        while len(cells) < size:
            i, j = rng.choice(sorted(cells))
            a, b = rng.choice([(1, 0), (0, 1), (-1, 0), (0, -1)])
            cells.add((i + a, j + b))
        rings = outlines(cells)
        outer, holes = [r for r in rings if shoelace(r) > 0], [r for r in rings if shoelace(r) < 0]
        assert len(outer) == 1
        found = mesh.constrained_delaunay(outer[0], holes)
        assert all(shoelace(t) > 0 for t in found) and sum(map(shoelace, found)) == 2 * len(cells)
        assert len(found) == len(outer[0]) + sum(len(h) + 2 for h in holes) - 2
        fixed = {frozenset((r[k - 1], r[k])) for r in rings for k in range(len(r))}
        by = {(t[k], t[(k + 1) % 3]): t for t in found for k in range(3)}
        for (a, b), t in by.items():
            if frozenset((a, b)) not in fixed:
                d = next(p for p in by[b, a] if p not in (a, b))
                m = [(p[0] - d[0], p[1] - d[1]) for p in t]
                det = sum((m[i][0] ** 2 + m[i][1] ** 2) * (m[(i + 1) % 3][0] * m[(i + 2) % 3][1] - m[(i + 2) % 3][0] * m[(i + 1) % 3][1]) for i in range(3))
                assert det <= 0


def outlines(cells):
    """Rings of the union of cells, inside on the left, leftmost turn at corners."""
    after = {}
    for i, j in sorted(cells):
        for near, a, b in (((i, j - 1), (i, j), (i + 1, j)), ((i + 1, j), (i + 1, j), (i + 1, j + 1)), ((i, j + 1), (i + 1, j + 1), (i, j + 1)), ((i - 1, j), (i, j + 1), (i, j))):
            if near not in cells:
                after.setdefault(a, []).append(b)
    rings = []
    while after:
        start = at = min(after)
        way, out = (0, 0), []
        while True:
            nxt = max(after[at], key=lambda b: way[0] * (b[1] - at[1]) - way[1] * (b[0] - at[0]))  # noqa: B023
            after[at].remove(nxt)
            if not after[at]:
                del after[at]
            step = (nxt[0] - at[0], nxt[1] - at[1])
            if step != way:
                out.append(at)
            way, at = step, nxt
            if at == start:
                break
        rings.append(out)
    return rings


def test_piles_of_rings_leave_only_their_shell(spark):
    """A slanted ring alone keeps its area in cells; the middle of a pile of boxes has hardly any edges left (sides of squares of two sizes)."""
    rng = random.Random(21)
    rows = [("slanted", ring((0, 0), (31.3, 2.7), (17.1, 23.9), (9.2, 11.4)))]
    rows += [("pile", box(round(rng.uniform(-3, 3), 3), round(rng.uniform(-2, 2), 3), 1 + n % 7, 1 + n % 5)) for n in range(3000)]
    shell = overlay.shell_edges(spark.createDataFrame(rows, f"k string, ring {XZ}"), ["k"]).cache()
    twice = overlay.areas(shell, ["k"]).where("k = 'slanted'").first().twice
    assert abs(twice - 1e6 * shoelace([(p["x"], p["z"]) for p in rows[0][1]])) < 1e5  # cuts are snapped to a unit
    core = lambda e: e.where("k = 'pile' and least(ax, bx) > -1000 and greatest(ax, bx) < 3000 and least(az, bz) > -500 and greatest(az, bz) < 2000").count()
    assert 20 * core(overlay._normal(shell, ["k"])) < core(overlay.ring_edges(spark.createDataFrame(rows, f"k string, ring {XZ}"), ["k"]))
