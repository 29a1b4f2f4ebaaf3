"""Work that must not grow with the pairs that lie close together: equal to plain Python, and done without those pairs."""

import math
import random

from pyspark.sql import functions as F

from cairnflow import queries as core
from cairnflow.operators import bridges, spatial
from cairnflow.plans import group


SF = "/root/testdata/sf0.001"


def scatter(n, seed, spread=12.0):
    rng = random.Random(seed)
    return [(k, rng.gauss(0, spread), rng.gauss(0, spread), k % 3) for k in range(n)]


def parts_of(rows, radius):
    root = {r[0]: r[0] for r in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[3] == b[3] and math.hypot(b[1] - a[1], b[2] - a[2]) <= radius:
                lo, hi = sorted((find(a[0]), find(b[0])))
                root[hi] = lo
    return {k: find(k) for k in root}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_without_pairs(spark):
    rows = [*scatter(240, 1), (900, 500.0, 0.0, 0), (901, 504.0, 0.0, 0), (902, 508.0, 0.0, 0), (903, 512.001, 0.0, 0), (904, None, 1.0, 0)]
    got = bridges.near_parts(spark.createDataFrame(rows, "id long, x double, z double, label long"), 4.0, ["label"]).collect()
    want = parts_of(rows[:-1], 4.0) | {904: 904}
    assert len(got) == len(rows) and {r.node: r.component for r in got} == want and want[902] == 900 and want[903] == 903


def test_pairs_of_a_component_in_blocks(spark):
    rows = [(k, float(k % 30), float(k // 30), 0, str(k % 2), "door") for k in range(600)]
    t = spark.createDataFrame(rows, "id long, x double, z double, floor_index long, section string, portal_type string")
    comp = spark.createDataFrame([(k, int(k >= 590)) for k in range(600)], "id long, component long")
    links = spark.createDataFrame([(3, 4, 0, 7.0), (3, 4, 0, 6.0), (5, 595, 0, 1.0)], "from long, to long, floor_index long, cost double")
    ground = t.join(comp, "id").selectExpr("floor_index", "component", "x x1", "z z1", "x x2", "z z2")
    out = group.transfer_edges(t, comp, links, ground, near=1.0, gap=1.0)
    got = {(r["from"], r["to"]): (r.cost, r.reason[0]) for r in out.collect()}
    far = lambda a, b: math.hypot(rows[a][1] - rows[b][1], rows[a][2] - rows[b][2])
    want = {(a, b): (round(far(a, b), 3), "s") for a in range(600) for b in range(600) if a != b and (a >= 590) == (b >= 590)}
    want |= {(a, b): (1.0, "a") for a in range(600) for b in range(600) if (a >= 590) != (b >= 590) and a % 2 == b % 2 and far(a, b) <= 1}
    want |= {(3, 4): (6.0, "m"), (4, 3): (6.0, "m"), (5, 595): (1.0, "m"), (595, 5): (1.0, "m")}
    assert out.count() == len(got) and got == want
    assert plan(out).index("Union") < plan(out).index("Window")  # the many pairs meet no window


def test_terminals_are_laid_out_once(spark, monkeypatch):
    saved, save = {}, group.Scratch.save
    monkeypatch.setattr(group.Scratch, "save", lambda self, df, name: saved.setdefault(name, save(self, df, name)))
    t = spark.createDataFrame([(k, float(k % 40), float(k // 40), k % 2) for k in range(1200)], "id long, x double, z double, floor_index long")
    out = group.transfer_edges(t, t.selectExpr("id", "0L component"))
    assert "sequence(" not in plan(out)  # once every terminal was shuffled for each block of its component
    chunks = saved["chunks"].collect()
    assert sorted(r.id for c in chunks for r in c.p) == list(range(1200)) and len(chunks) > 2
    assert {(r["from"], r["to"]) for r in out.collect()} == {(a, b) for a in range(1200) for b in range(1200) if a != b and a % 2 == b % 2}
    assert out.count() == 2 * 600 * 599


def test_thousandths_round_like_decimals(spark):
    values = [0.0, 0.0005, 1.0005, 2.0015, 1.4995, 0.1234999999, 7.3205, 1e-9, 123456.7895, 5e6 + 0.0005, 1e300, float("inf"), float("nan"), None, *(math.sqrt(k) for k in range(2000)), *(k / 2000 for k in range(2000))]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(group._thousandths(F.col("v")).alias("a"), F.round("v", 3).alias("b"))
    assert got.where("not (a <=> b)").isEmpty()


def test_knn_loses_no_partner(spark):
    rows = [(0, -1e-20, 0.0), (1, 20.0, 0.0), (2, 0.0, -3e-20), (3, 0.0, 20.0), *((k, 100.0 + 0.1 * k, 0.0) for k in range(10, 30))]
    left = spark.createDataFrame([(a, x, z, 1 + a % 7) for a, x, z in rows], "a long, x double, z double, k long")
    right = spark.createDataFrame(rows, "b long, tx double, tz double")
    near = {a: [b for _, b in sorted((math.hypot(x - u, z - v), b) for b, u, v in rows if b != a and math.hypot(x - u, z - v) <= 20)] for a, x, z in rows}
    for k, most, want in ((30, None, near), (F.col("k"), 2, {a: near[a][: 1 + a % 7] for a in near})):  # more than the hint says
        got = {}
        for r in spatial.knn_join(left, right, "a", "b", "x", "z", "tx", "tz", k, 20.0, most=most).orderBy("a", "rank").collect():
            got.setdefault(r.a, []).append(r.b)
        assert got == {a: b for a, b in want.items() if b}


def test_islands_are_told_by_their_parts(spark):
    assert "__cx" not in plan(core.queries()["q_bridge_islands"](spark, SF))  # no join of near pairs


def test_nearest_one_takes_cells_that_fit(spark, monkeypatch):
    left, right = scatter(150, 5, 1.0), scatter(300, 6, 1.0)
    rows = {}
    save = spatial.Scratch.save
    monkeypatch.setattr(spatial.Scratch, "save", lambda self, df, name: rows.setdefault(name, save(self, df, name)) if name != "pairs-0" else rows.setdefault(name, save(self, df.cache(), name)))
    l = spark.createDataFrame(left, "i long, x double, z double, k long")
    r = spark.createDataFrame([(a, x, z, k) for a, x, z, k in right], "j long, u double, v double, k long")
    got = {g.i: g.j for g in spatial.nearest_one(l, r, "i", "j", "x", "z", "u", "v", 1000.0, ["k"]).collect()}
    assert got == {a[0]: min((b for b in right if b[3] == a[3]), key=lambda b: (math.hypot(a[1] - b[1], a[2] - b[2]), b[0]))[0] for a in left}
    assert rows["pairs-0"].count() > 12  # with cells of 1000 it was the four around the origin, times three keys at most


def test_crossings_are_neither_shuffled_nor_doubled(spark):
    names, other = ["x1", "z1", "x2", "z2"], ["u1", "v1", "u2", "v2"]
    side = lambda ax, az, bx, bz, cx, cz: (bx - ax) * (cz - az) - (bz - az) * (cx - ax)
    for length in (2.0, 40.0):  # cells spare pairs, cells spare none
        rng = random.Random(7)
        rows = [(k, k % 2, x, z, x + rng.uniform(-length, length), z + rng.uniform(-length, length)) for k in range(300) for x, z in [(rng.uniform(0, 20), rng.uniform(0, 20))]]
        l = spark.createDataFrame(rows, "i long, g long, " + ", ".join(f"{c} double" for c in names))
        r = spark.createDataFrame(rows, "j long, g long, " + ", ".join(f"{c} double" for c in other))
        out = spatial.segment_intersect_join(l, r, "i", "j", names, other, 3.0, ["g"])
        want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and a[1] == b[1] and side(*a[2:], *b[2:4]) * side(*a[2:], *b[4:]) < 0 and side(*b[2:], *a[2:4]) * side(*b[2:], *a[4:]) < 0)
        assert sorted((q.i, q.j) for q in out.collect()) == want and len(want) > 100
        assert plan(out).index("SortMergeJoin") < plan(out).index("Aggregate")


def test_covered_points_leave_the_search(spark, monkeypatch):
    save, seen = spatial.Scratch.save, {}
    monkeypatch.setattr(spatial.Scratch, "save", lambda self, df, name: seen.setdefault(name, save(self, df, name)))
    rng = random.Random(3)
    corners = [(k, rng.uniform(0, 6), rng.uniform(0, 6)) for k in range(120)] + [(None, 0.0, 0.0)]
    ring = lambda x, z: [{"x": x + i, "z": z + j} for i, j in ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0))]
    rings = spark.createDataFrame([(k, ring(x, z)) for k, x, z in corners], "r long, ring array<struct<x:double,z:double>>")
    points = [(k, rng.uniform(0.5, 8), rng.uniform(0.5, 8)) for k in range(200)]
    p = spark.createDataFrame(points, "id long, x double, z double")
    got = {q.id: (q.r, round(q.distance, 9)) for q in spatial.nearest_ring(p, rings, "id", "r", "x", "z", "ring", 8.0).collect()}
    off = lambda x, z, a, b: math.hypot(max(a - x, 0, x - a - 2), max(b - z, 0, z - b - 2))
    want = {k: min((round(off(x, z, a, b), 9), r) for r, a, b in corners if r is not None) for k, x, z in points}
    assert got == {k: (r, d) for k, (d, r) in want.items()}
    assert 0 < seen["left-16"].count() < 200


def test_nearest_line_doubles_its_cells(spark):
    rng = random.Random(9)
    ends = [(k, *(rng.uniform(0, 12) for _ in range(4))) for k in range(700)] + [(900, 40.0, 0.0, 44.0, 0.0)]
    lines = spark.createDataFrame(ends, "line long, x1 double, z1 double, x2 double, z2 double")
    points = [(k, rng.uniform(0, 12), rng.uniform(0, 12)) for k in range(60)] + [(70, 41.0, 0.9), (71, 41.0, 1.1)]

    def away(x, z, ax, az, bx, bz):
        t = max(0, min(1, ((x - ax) * (bx - ax) + (z - az) * (bz - az)) / ((bx - ax) ** 2 + (bz - az) ** 2)))
        return math.hypot(x - ax - t * (bx - ax), z - az - t * (bz - az))

    got = spatial.nearest_line(spark.createDataFrame(points, "id long, x double, z double"), lines, "id", "line", "x", "z", ["x1", "z1", "x2", "z2"], 1.0)
    want = {k: min((away(x, z, *e[1:]), e[0]) for e in ends) for k, x, z in points}
    assert {r.id: r.line for r in got.collect()} == {k: e for k, (d, e) in want.items() if d <= 1}
