"""Internal column names never cost a caller's column; chains of any length prune; artifacts as files."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from cairnflow.operators import graph, spatial
from cairnflow.operators import relational as rel
from cairnflow.plans import artifacts

XYZ = "array<struct<x:double,y:double,z:double>>"
MINE = ["__rn", "__c", "__i", "__n", "__p", "__s", "__k0", "__m0", "__lo", "__hi", "__cx", "__cz", "__start", "__id", "__short"]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, i % 3, float(i), float(i % 4), i % 2 == 0) for i in range(12)]
    return spark.createDataFrame(rows, "id long, k int, x double, z double, out boolean").selectExpr("*", *(f"'{c}' as {c}" for c in MINE))


def kept(df, n=None):
    rows = df.collect()
    assert rows and all(r[c] == c for r in rows for c in MINE) and (n is None or len(rows) == n)


def test_columns_of_the_caller_stay(spark, frame):
    kept(rel.first_by(frame, ["k"], ["id"]), 3)
    kept(rel.islands(frame, ["k"], ["id"], F.col("z") > 1), 12)
    kept(rel.systematic_sample(frame, ["k"], ["id"], 2), 6)
    kept(rel.global_row_number(frame, ["id"], "at"), 12)
    kept(rel.gap_stitch(frame, ["k"], ["id"], "out", "__rn", "x", "z", F.lit(False)))
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "key int, word string")
    kept(rel.priority_join(frame, names, [("k", "key")], ["word"]), 12)
    kept(rel.insert_undirected(frame.select("id", "k").limit(0), frame.withColumn("k", F.col("k").cast("long")), "id", "k", ["x"]))
    other = frame.select(F.col("id").alias("o"), F.col("x").alias("ox"), F.col("z").alias("oz"))
    kept(spatial.grid_distance_join(frame, other, "x", "z", "ox", "oz", 1.5))
    kept(graph.prune_fixpoint(frame.withColumn("b", F.col("id") + 100), F.lit(False), "id", "b"), 12)


def pruned(edges):
    edges = list(enumerate(edges))
    while True:
        degree = {}
        for _, (a, b, _) in edges:
            for n in (a, b):
                degree[n] = degree.get(n, 0) + 1
        left = [(i, (a, b, s)) for i, (a, b, s) in edges if not (s and 1 in (degree[a], degree[b]))]
        if len(left) == len(edges):
            return sorted(e for _, e in left)
        edges = left


def test_pruning_equals_one_round_at_a_time(spark):
    rng = random.Random(3)
    edges = []
    for part in range(6):
        n = rng.randrange(5, 40)
        edges += [(100 * part + i, 100 * part + rng.randrange(max(1, i)), rng.random() < 0.8) for i in range(1, n)]  # trees
        edges += [(100 * part + rng.randrange(n), 100 * part + rng.randrange(n), rng.random() < 0.8) for _ in range(part)]  # and cycles, loops, parallels
    df = spark.createDataFrame(edges, "a long, b long, s boolean").repartition(3)
    assert sorted(tuple(r) for r in graph.prune_fixpoint(df, F.col("s")).collect()) == pruned(edges)


def test_a_chain_of_a_thousand_short_edges_prunes(spark):
    chain = spark.range(1000).selectExpr("id as a", "id + 1 as b", "true as s")
    square = spark.createDataFrame([(0, -1, True), (-1, -2, True), (-2, -3, True), (-3, 0, True), (500, 5000, False), (None, 3, True)], "a long, b long, s boolean")
    left = graph.prune_fixpoint(chain.union(square), F.col("s"), max_rounds=4).collect()
    assert len(left) == 4 + 500 + 1  # the square, the chain up to the long edge at 500, and that edge


def test_artifacts_and_stages_become_files(spark, tmp_path):
    square = [{"x": x, "y": 0.0, "z": z} for x, z in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]
    meshes = spark.createDataFrame([("1", "a", "floor", square, [[0, 1, 2, 3]]), ("2", "b", "floor", square, [[0, 1, 2, 3]])], f"floor_name string, name string, material string, vertices {XYZ}, faces array<array<int>>")
    artifacts.write_artifacts(artifacts.stage_files({"rooms": meshes, "walls": meshes.where("floor_name = '2'")}), str(tmp_path / "out"))
    found = sorted(f"{os.path.basename(d)}/{f}" for d, _, fs in os.walk(tmp_path / "out") for f in fs if f.endswith(".glb"))
    assert found == ["01_rooms/floor_1.glb", "01_rooms/floor_2.glb", "02_walls/floor_2.glb"]
    assert (tmp_path / "out" / "01_rooms" / "floor_1.glb").read_bytes()[:4] == b"glTF"
    floors = spark.createDataFrame([("1", 0, 0.0), ("2", 1, 4.0)], "floor_name string, floor_index int, height double")
    artifacts.write_artifacts(artifacts.floor_artifacts(meshes, meshes, floors, "g"), str(tmp_path / "out"))
    names = sorted(f for _, _, fs in os.walk(tmp_path / "out") for f in fs if f.endswith(".glb"))
    assert names == [f"g_floor_{i}_{k}.glb" for i in (0, 1) for k in ("route_debug", "visual", "walkable_paths")]


def test_far_clusters_meet_through_the_cells_that_face_each_other(spark):
    rng = random.Random(8)
    left = [(i, rng.uniform(0, 40), rng.uniform(0, 40)) for i in range(3000)]
    right = [(i, 100_000 + rng.uniform(0, 40), rng.uniform(0, 40)) for i in range(3000)]
    l, r = spark.createDataFrame(left, "i long, x double, z double"), spark.createDataFrame(right, "j long, u double, v double")
    got = {row.i: row.j for row in spatial.nearest_one(l, r, "i", "j", "x", "z", "u", "v", 1.0).collect()}
    for i, x, z in left[::50]:
        assert got[i] == min((math.hypot(u - x, v - z), j) for j, u, v in right)[1]
    same = spatial.nearest_one(l, l.select(F.col("i").alias("j"), F.col("x").alias("u"), F.col("z").alias("v")), "i", "j", "x", "z", "u", "v", 1.0)
    assert same.where("i <> j or distance > 0").count() == 0


def test_reach_of_a_long_path_and_of_random_graphs(spark):
    path = spark.range(1000).selectExpr("id as a", "id + 1 as b")
    got = {r.source: (r.reachable, r.marked) for r in graph.reach_counts(path.selectExpr("a as id"), path, spark.createDataFrame([(1000,), (500,)], "id long")).collect()}
    assert all(got[i] == (1001 - i, 2 if i <= 500 else 1) for i in range(1000))
    rng = random.Random(6)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(50)} | {(u + 100, u + 101) for u in range(9)} | {(u + 101, u + 100) for u in range(9)}
    after = {}
    for u, v in edges:
        after.setdefault(u, set()).add(v)
    sources = [*range(0, 40, 3), 104, 999]
    want = set()
    for s in sources:
        seen, front = {s}, [s]
        while front:
            front = [v for u in front for v in after.get(u, ()) if v not in seen and not seen.add(v)]
        want |= {(s, v) for v in seen}
    df, own = spark.createDataFrame(sorted(edges), "a long, b long"), spark.createDataFrame([(s,) for s in sources], "id long")
    assert {(r.source, r.node) for r in graph.reach(own, df).collect()} == want
    counts = {r.source: (r.reachable, r.marked) for r in graph.reach_counts(own, df, spark.range(0, 200, 2).toDF("id")).collect()}
    assert counts == {s: (sum(1 for x, _ in want if x == s), sum(1 for x, v in want if x == s and v % 2 == 0)) for s in sources} | ({999: (1, 0)})
