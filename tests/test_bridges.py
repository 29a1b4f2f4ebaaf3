import math
import random

import pytest

from cairnflow.operators import bridges, graph
from cairnflow.operators.scratch import Scratch, free_names
from cairnflow.plans import surfaces

SCHEMA = "floor string, part long, id long, x1 double, z1 double, x2 double, z2 double"


def apart(p, q):
    """Distance of two segments."""

    def to(px, pz, ax, az, bx, bz):
        n = (bx - ax) ** 2 + (bz - az) ** 2
        t = 0 if n == 0 else max(0, min(1, ((px - ax) * (bx - ax) + (pz - az) * (bz - az)) / n))
        return math.hypot(px - ax - t * (bx - ax), pz - az - t * (bz - az))

    side = lambda ax, az, bx, bz, cx, cz: (bx - ax) * (cz - az) - (bz - az) * (cx - ax)
    if side(*p, *q[:2]) * side(*p, *q[2:]) < 0 and side(*q, *p[:2]) * side(*q, *p[2:]) < 0:
        return 0.0
    return min(to(*p[:2], *q), to(*p[2:], *q), to(*q[:2], *p), to(*q[2:], *p))


def closest_first(rows, limit):
    """Closest pair of parts first, one bridge at a time."""
    out = []
    for floor in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == floor]
        root = {r[1]: r[1] for r in own}
        while True:
            pairs = [(apart(a[3:], b[3:]), a[2], b[2], a[1], b[1]) for a in own for b in own if a[2] < b[2] and root[a[1]] != root[b[1]]]
            best = min((p for p in pairs if p[0] <= limit), default=None)
            if best is None:
                break
            out.append((floor, best[1], best[2], round(best[0], 6)))
            old, new = root[best[4]], root[best[3]]
            root = {k: new if v == old else v for k, v in root.items()}
    return sorted(out)


def make(seed, floors=2, parts=9, limit=60.0):
    rng = random.Random(seed)
    rows, n = [], 0
    for floor in range(floors):
        for part in range(parts):
            cx, cz = rng.uniform(0, 150), rng.uniform(0, 150)
            for _ in range(rng.randrange(1, 6)):
                x, z = cx + rng.uniform(-6, 6), cz + rng.uniform(-6, 6)
                rows.append((f"f{floor}", part, n, x, z, x + rng.choice([0, rng.uniform(-9, 9)]), z + rng.choice([0, rng.uniform(-9, 9)])))
                n += 1
    return rows


@pytest.mark.parametrize("seed, limit", [(1, 25.0), (2, 200.0)])
def test_equals_closest_pair_first(spark, seed, limit):
    rows = make(seed)
    got = bridges.spanning_bridges(spark.createDataFrame(rows, SCHEMA).repartition(3), ["floor"], limit, 12.0).collect()
    assert sorted((r.floor, r.a, r.b, round(r.length, 6)) for r in got) == closest_first(rows, limit)
    at = {r[2]: r[3:] for r in rows}
    for r in got:
        foot, other = (r.x1, r.z1, r.x1, r.z1), (r.x2, r.z2, r.x2, r.z2)
        assert apart(foot, at[r.a]) < 1e-9 and apart(other, at[r.b]) < 1e-9 and abs(apart(foot, other) - r.length) < 1e-9


def test_ties_nulls_and_nothing_to_join(spark):
    grid = [("f", 3 * i + j, 3 * i + j, 10.0 * i, 10.0 * j, 10.0 * i, 10.0 * j) for i in range(3) for j in range(3)]  # every distance is a tie
    rows = [*grid, ("f", 50, 50, 1e4, 0.0, 1e4, 0.0), ("f", None, 51, 1.0, 1.0, 1.0, 1.0), ("g", 1, 60, 0.0, 0.0, 0.0, 0.0)]
    got = sorted((r.floor, r.a, r.b, r.length) for r in bridges.spanning_bridges(spark.createDataFrame(rows, SCHEMA), ["floor"], 30.0, 10.0).collect())
    assert got == closest_first([r for r in rows if r[1] is not None], 30.0) and len(got) == 8
    assert bridges.spanning_bridges(spark.createDataFrame([], SCHEMA), ["floor"], 30.0, 10.0).count() == 0


def test_the_middle_island_gets_two_bridges(spark):
    cells = [("1", 0, 0), ("1", 1, 0), ("1", 2, 0), ("1", 400, 0), ("1", 401, 0), ("1", 200, 0), ("2", 0, 0)]
    got = sorted((r.x1, r.x2) for r in surfaces.bridge_surfaces(spark.createDataFrame(cells, "floor_name string, cx long, cz long"), 0.5).collect())
    assert [sorted(g) for g in got] == [[1.25, 100.25], [100.25, 200.25]]


def test_islands_within_reach_of_a_bridge_are_joined(spark):
    ground = [("1", 0, 0, 0.0, 0.0, 0.0, 0.0), ("1", 1, 1, 100.0, 0.0, 100.0, 0.0), ("1", 2, 2, 50.0, 99.0, 50.0, 99.0)]
    got = surfaces.bridge_elements(spark.createDataFrame(ground, SCHEMA.replace("floor ", "floor_name ")), ["floor_name"], 100.0, 10.0).collect()
    assert sorted(round(r.length, 6) for r in got) == [99.0, 100.0]  # 110.9 from both ends, 99 from the bridge


def test_components_of_a_long_chain_and_of_a_hub(spark):
    chain = spark.range(3000).selectExpr("id as a", "id + 1 as b")
    hub = spark.range(10_000, 14_000).selectExpr("9999 as a", "id as b")
    nodes = chain.selectExpr("a as id").union(chain.selectExpr("b")).union(hub.selectExpr("b")).union(spark.createDataFrame([(77_777,)], "id long"))
    got = graph.components(nodes, chain.union(hub)).groupBy("component").count().collect()
    assert sorted((r.component, r["count"]) for r in got) == [(0, 3001), (9999, 4000), (77_777, 1)]


def test_scratch_tables_can_be_dropped_and_names_are_free(spark):
    s = Scratch(spark, "t")
    kept = s.save(spark.range(3), "a")
    s.save(spark.range(4), "b")
    s.drop("b")
    assert kept.count() == 3 and free_names(["__c", "__C_"], "__c", "x") == ["__c__", "x"]
