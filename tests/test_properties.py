"""Kernels and joins against brute force on random input, and independence of partitioning."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairnflow.operators import graph, mesh, spatial
from cairnflow.operators import relational as rel

coord = st.integers(-50, 50).map(float)
points = st.lists(st.tuples(coord, coord), min_size=3, max_size=25)


def area(p):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1], strict=True))) / 2


@settings(max_examples=150, deadline=None)
@given(points)
def test_hull_holds_all_points_and_triangles_fill_it(pts):
    h = mesh.hull(pts)
    assert mesh.hull(h) == h
    if len(h) >= 3:
        for x, z in pts:
            assert all((b[0] - a[0]) * (z - a[1]) - (b[1] - a[1]) * (x - a[0]) >= -1e-9 for a, b in zip(h, h[1:] + h[:1], strict=True))
        t = mesh.triangulate(h)
        assert len(t) == len(h) - 2
        assert math.isclose(sum(area([h[i] for i in tri]) for tri in t), area(h), abs_tol=1e-6)


@settings(max_examples=150, deadline=None)
@given(points, st.floats(0.1, 20))
def test_simplified_lines_keep_their_ends_and_points(pts, tolerance):
    s = mesh.simplify(pts, tolerance)
    assert s[0] == pts[0] and s[-1] == pts[-1] and set(s) <= set(pts)
    assert len(mesh.simplify(pts, 0.0)) >= len(s)


def cloud(n, seed):
    rng = random.Random(seed)
    return [(i, rng.uniform(-20, 20), rng.uniform(-20, 20), i % 3) for i in range(n)]


@pytest.mark.parametrize("radius", [0.7, 5.0, 60.0])
def test_grid_join_is_the_distance_join(spark, radius):
    a, b = cloud(60, 1), cloud(50, 2)
    left = spark.createDataFrame(a, "i long, x double, z double, k int").repartition(3)
    right = spark.createDataFrame(b, "j long, u double, v double, k int").repartition(4)
    got = sorted((r.i, r.j) for r in spatial.grid_distance_join(left, right, "x", "z", "u", "v", radius, ["k"]).collect())
    assert got == sorted((i, j) for i, x, z, k in a for j, u, v, m in b if k == m and math.hypot(u - x, v - z) <= radius)


def test_nearest_one_has_no_limit(spark):
    a, b = cloud(40, 3), [(100, 500.0, 500.0, 0), (101, -400.0, 10.0, 0)]
    left = spark.createDataFrame(a, "i long, x double, z double, k int").drop("k")
    right = spark.createDataFrame(b, "j long, u double, v double, k int").drop("k")
    got = {r.i: r.j for r in spatial.nearest_one(left, right, "i", "j", "x", "z", "u", "v", 1.0).collect()}
    assert got == {i: min((math.hypot(u - x, v - z), j) for j, u, v, _ in b)[1] for i, x, z, _ in a}


def test_segments_cross_like_brute_force(spark):
    rng = random.Random(4)
    segs = [(i, *(rng.uniform(-10, 10) for _ in range(4))) for i in range(60)]
    l = spark.createDataFrame(segs, "i long, x1 double, z1 double, x2 double, z2 double")
    r = l.toDF("j", "a1", "b1", "a2", "b2")
    got = {(x.i, x.j) for x in spatial.segment_intersect_join(l, r, "i", "j", ["x1", "z1", "x2", "z2"], ["a1", "b1", "a2", "b2"], 3.0).collect()}

    def side(p, q, s):
        return (q[0] - p[0]) * (s[1] - p[1]) - (q[1] - p[1]) * (s[0] - p[0])

    want = set()
    for i, *a in segs:
        for j, *b in segs:
            p, q, s, t = a[:2], a[2:], b[:2], b[2:]
            if i != j and side(p, q, s) * side(p, q, t) < 0 and side(s, t, p) * side(s, t, q) < 0:
                want.add((i, j))
    assert got == want


def test_graph_loops_like_brute_force(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(30)]
    nodes, edges = spark.range(40), spark.createDataFrame(pairs, "a long, b long")
    adj = {i: {i} for i in range(40)}
    for a, b in pairs:
        adj[a].add(b)

    def closure(start, back):
        seen, todo = {start}, [start]
        while todo:
            x = todo.pop()
            for y in (adj[x] | ({z for z in adj if x in adj[z]} if back else set())) - seen:
                seen.add(y)
                todo.append(y)
        return seen

    assert {r.node: r.component for r in graph.components(nodes, edges).collect()} == {i: min(closure(i, True)) for i in range(40)}
    got: dict = {}
    for r in graph.reach(nodes.where("id < 5"), edges).collect():
        got.setdefault(r.source, set()).add(r.node)
    assert got == {i: closure(i, False) for i in range(5)}


def test_results_do_not_depend_on_partitions(spark):
    rows = [(i, i % 4, (i * 7) % 11, float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, k int, v long, w double")
    forms = [df.coalesce(1), df.repartition(7), df.orderBy(F.desc("id")).repartition(3, "v")]
    ops = [
        lambda d: rel.first_by(d, ["k"], ["v", "id"]),
        lambda d: rel.chain_links(d, ["k"], "v", ["id"], ["id"]),
        lambda d: rel.islands(d, ["k"], ["id"], rel.changed("w", ["k"], ["id"])),
        lambda d: rel.global_row_number(d, ["v", "id"], "n"),
        lambda d: rel.index_percentile(d, "id", 0.9),
        lambda d: rel.systematic_sample(d, ["k"], ["id"], 9),
        lambda d: spatial.greedy_distinct(d.withColumn("x", F.col("v").cast("double")), ["k"], ["id"], "x", "w", 2.0),
        lambda d: spatial.leader_cluster(d.withColumn("x", F.col("v").cast("double")), ["k"], ["id"], "x", "w", 2.0),
    ]
    for op in ops:
        a, *rest = (sorted(map(tuple, op(f).collect())) for f in forms)
        assert a and all(a == b for b in rest)


def test_knn_of_a_dense_place_never_joins_the_whole_radius(spark, monkeypatch):
    """Where rows lie densely the join begins with small cells; far rows still find theirs, and the result is brute force's."""
    rng = np.random.default_rng(5)
    pts = [(i, float(x), float(z)) for i, (x, z) in enumerate(rng.uniform(0, 2, (500, 2)))] + [(500, 11.0, 1.0), (501, 300.0, 0.0)]
    used = []
    plain = spatial.grid_distance_join
    monkeypatch.setattr(spatial, "grid_distance_join", lambda l, r, *a, **k: used.append((l.count(), a[4])) or plain(l, r, *a, **k))
    left = spark.createDataFrame(pts, "a long, x double, z double")
    right = left.toDF("b", "tx", "tz")
    got = {(r.a, r["rank"]): r.b for r in spatial.knn_join(left, right, "a", "b", "x", "z", "tx", "tz", 3, 20.0).collect()}
    want = {}
    for i, x, z in pts:
        near = sorted((float(np.sqrt((x - u) ** 2 + (z - v) ** 2)), j) for j, u, v in pts if j != i)
        want |= {(i, n + 1): j for n, (d, j) in enumerate(near[:3]) if d <= 20}
    assert got == want
    assert all(n <= 2 for n, radius in used if radius > 2)
