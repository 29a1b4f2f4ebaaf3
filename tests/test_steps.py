"""Ways of few steps between near points: equal to a plain search, and done without the near pairs."""

import math
import random

import numpy as np
import pytest

from cairnflow import queries as core
from cairnflow.operators import spatial, steps

SF = "/root/testdata/sf0.001"


def searched(rows, sources, radius, most):
    """{(source, node): steps}; an id that is there twice is one node with two places."""
    rows = [r for r in rows if None not in r and all(math.isfinite(c) for c in r[1:3])]
    near = {}
    for a in rows:
        for b in rows:
            if a[3] == b[3] and math.sqrt((b[1] - a[1]) ** 2 + (b[2] - a[2]) ** 2) <= radius:
                near.setdefault(a[0], set()).add(b[0])
    out = {}
    for s in sources:
        out[s, s], front = 0, {s}
        for k in range(1, most + 1):
            front = {b for a in front for b in near.get(a, ()) if (s, b) not in out}
            out |= {(s, b): k for b in front}
    return out


def found(spark, rows, sources, radius, most):
    p = spark.createDataFrame(rows, "id long, x double, z double, label long")
    got = steps.near_steps(spark.createDataFrame([(s,) for s in sources], "id long"), p, radius, most, ["label"]).collect()
    assert len(got) == len({(r.source, r.node) for r in got})
    return {(r.source, r.node): r.steps for r in got}


def plane(seed):
    """Scattered points, a lattice whose steps are exactly the radius, a ring with a hole, copies of a place, and points without one."""
    rng = random.Random(seed)
    rows = [(k, rng.gauss(0, 9), rng.gauss(0, 9), k % 2) for k in range(300)]
    rows += [(1000 + k, 100.0 + 4 * (k % 9), 4.0 * (k // 9) - 16, 0) for k in range(81)]
    rows += [(2000 + k, 300 + 6 * math.cos(k / 5), 6 * math.sin(k / 5), 1) for k in range(24)]
    rows += [(3000 + k, 0.0, 0.0, 0) for k in range(30)] + [(3100 + k, 4.0, -0.0, 0) for k in range(30)] + [(3200, -12.0, 0.0, 0), (3201, -8.0, 0.0, 0)]
    return rows + [(4000, None, 1.0, 0), (4001, 1.0, 1.0, None), (4002, math.nan, 0.0, 0), (4003, math.inf, 0.0, 0)]


@pytest.mark.parametrize("block, rows", [(256, 1 << 17), (2, 5)])
def test_steps_equal_a_plain_search(spark, monkeypatch, block, rows):
    monkeypatch.setattr(steps, "BLOCK", block)
    monkeypatch.setattr(steps, "ROWS", rows)
    own = plane(4)
    sources = [r[0] for r in own if r[0] % 10 == 0] + [3001, 4001, 4002, 4003, 9999, 0]
    for most in (1, 3):
        assert found(spark, own, sources, 4.0, most) == searched(own, set(sources), 4.0, most)
    assert found(spark, own, sources, 4.0, 0) == {(s, s): 0 for s in sources}


def test_an_id_with_two_places_joins_them(spark):
    own = [(1, 0.0, 0.0, 0), (2, 3.0, 0.0, 0), (2, 50.0, 0.0, 1), (3, 53.0, 0.0, 1), (4, 57.5, 0.0, 1)]
    assert found(spark, own, [1], 4.0, 3) == searched(own, [1], 4.0, 3) == {(1, 1): 0, (1, 2): 1, (1, 3): 2}


@pytest.mark.parametrize("pairs", [3, 1 << 20])
def test_pairs_are_compared_in_pieces(monkeypatch, pairs):
    monkeypatch.setattr(steps, "PAIRS", pairs)
    rng = random.Random(8)
    spots = sorted({(rng.gauss(0, 5), rng.gauss(0, 5)) for _ in range(400)})
    x, z = (np.array(c) for c in zip(*spots))
    at, far = steps._least_steps(x, z, *spots[200], 1.0, 5)
    want = searched([(k, *s, 0) for k, s in enumerate(spots)], [200], 1.0, 5)
    assert {int(k): int(n) for k, n in zip(at, far)} == {n: k or 1 for (_, n), k in want.items()} and max(far) == 5


def test_hops_make_no_near_pairs(spark, monkeypatch):
    def never(*args, **kwargs):
        raise AssertionError("near pairs are made")

    monkeypatch.setattr(spatial, "grid_distance_join", never)
    assert core.queries()["q_shortest_hops"](spark, SF).where("hops = 0").count() > 0


def test_rows_that_are_there_twice_count_once(spark, monkeypatch):
    own = plane(6)[:120]
    monkeypatch.setattr(spatial, "grid_distance_join", None)  # no way over the near pairs
    assert found(spark, own + own[:50], [0, 10, 50, 100], 4.0, 3) == searched(own, [0, 10, 50, 100], 4.0, 3)
