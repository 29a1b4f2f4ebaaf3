"""Ways of few steps between near points: the plane tells which points a step can reach, so no table of near pairs is made or joined.

Over edges, every round multiplies what a source has reached by the points near
each; in the plane most points of a round are proved near by one point of the
last, the farthest in their direction, and only the rest are compared with all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, spatial

#: Sources of a cell that are walked in one piece of work, directions around a source, pairs compared at once, rows given back at once.
BLOCK, SECTORS, PAIRS, ROWS = 256, 128, 1 << 20, 1 << 17

#: More than rounding can add to a length.
SLACK = 1 + 1e-9


def near_steps(sources: DataFrame, points: DataFrame, radius: float, steps: int, keys: Sequence[str] = (), node: str = "id", x: str = "x", z: str = "z") -> DataFrame:
    """(source, node, steps): for every source the nodes that at most ``steps`` steps of at most ``radius`` between points of one key reach, and the least number.

    sources: one column of ids of points; each reaches itself in no step, without a place or key nothing else. Sources are dealt by key, cell of
    the whole reach and blocks of about BLOCK, and met by the points of the nine cells around; the rows, which are as many as sources times points
    within reach, are streamed and never shuffled. Where an id has two places it joins them, and the ways are searched over the near pairs.
    """
    starts = sources.toDF("source").where("source is not null").distinct()
    none = starts.select("source", F.col("source").alias("node"), F.lit(0).alias("steps"))
    if steps < 1:
        return none
    own = points.select(*keys, F.col(node).alias("id"), F.col(x).cast("double").alias("x"), F.col(z).cast("double").alias("z")).dropna()
    own = own.where((F.abs("x") < float("inf")) & (F.abs("z") < float("inf")))
    twice = lambda: not own.groupBy("id").count().where("count > 1").isEmpty()
    again = twice()
    if again:
        own = own.distinct()
    if again and twice():
        other = own.select(*keys, F.col("id").alias("b"), F.col("x").alias("ox"), F.col("z").alias("oz"))
        pairs = spatial.grid_distance_join(own.withColumnRenamed("id", "a"), other, "x", "z", "ox", "oz", radius, keys).where("a < b")
        ways = graph.distances(starts, pairs.select("a", "b", F.lit(1.0).alias("length")), "source", within=float(steps))
        return ways.select("source", "node", F.col("distance").cast("int").alias("steps"))
    size = max(radius * steps * (1 + 1e-6), 1e-3)
    deal = [*keys, "i", "j"]
    placed = own.withColumns({"i": spatial._cell(F.col("x"), size), "j": spatial._cell(F.col("z"), size)})
    first = placed.join(starts, F.col("id") == F.col("source"), "left_semi")
    blocks = first.groupBy(*deal).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    first = first.join(blocks, deal).select(*deal, F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "x", "z", F.lit(True).alias("start"))
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    met = placed.withColumn("s", around).select(*keys, (F.col("i") + F.col("s.i")).alias("i"), (F.col("j") + F.col("s.j")).alias("j"), "id", "x", "z")
    met = met.join(blocks, deal).select(*deal, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "x", "z", F.lit(False).alias("start"))
    kind = dict(own.dtypes)["id"]
    found = first.unionByName(met).groupBy(*deal, "block").applyInArrow(_walk(radius, steps), f"source {kind}, node {kind}, steps int")
    return found.unionByName(none)


def _walk(radius: float, steps: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        kind = t.schema.field("id").type
        start, ids, x, z = (t[c].to_numpy() for c in ("start", "id", "x", "z"))
        # points at one place are one spot, and spots lie by x
        spots, at, many = np.unique(x[~start] + 1j * z[~start], return_inverse=True, return_counts=True)
        nodes = ids[~start][np.argsort(at, kind="stable")]
        begin = np.cumsum(many) - many
        sx, sz = spots.real.copy(), spots.imag.copy()
        out, held = [], 0
        fields = ("source", "node", "steps")
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(zip(*out, strict=True), (kind, kind, pa.int32()), strict=True)], names=fields)
        last = None
        for k in np.lexsort((z, x)):
            if not start[k]:
                continue
            if last != (x[k], z[k]):
                last = x[k], z[k]
                spot, far = _least_steps(sx, sz, *last, radius, steps)
                n = many[spot]
                row = np.repeat(begin[spot] - np.cumsum(n) + n, n) + np.arange(n.sum())
                reached, far = nodes[row], np.repeat(far, n)
            keep = reached != ids[k]
            out.append((np.full(keep.sum(), ids[k], ids.dtype), reached[keep], far[keep]))
            held += len(reached)
            if held >= ROWS:
                yield batch()
                out, held = [], 0
        if out:
            yield batch()

    return walk


def _least_steps(x: np.ndarray, z: np.ndarray, ax: float, az: float, radius: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, steps): the places, sorted by x, that at most ``steps`` steps from (ax, az) reach, and the least number of them (from 1)."""
    whole = radius * steps * SLACK
    lo, hi = np.searchsorted(x, ax - whole, "left"), np.searchsorted(x, ax + whole, "right")
    r = np.sqrt((x[lo:hi] - ax) ** 2 + (z[lo:hi] - az) ** 2)
    near = np.flatnonzero(r <= whole)
    near = near[np.argsort(r[near])]
    r, near = r[near], near + lo
    x, z = x[near], z[near]
    far = (r <= radius).astype(np.int32)
    sector = ((np.arctan2(z - az, x - ax) / (2 * np.pi) + 0.5) * SECTORS).astype(np.int32) % SECTORS
    meets = lambda p, q: np.sqrt((x[q] - x[p]) ** 2 + (z[q] - z[p]) ** 2) <= radius
    for k in range(1, steps):
        front = np.flatnonzero(far == k)
        rest = np.flatnonzero(far[: np.searchsorted(r, radius * (k + 1) * SLACK, "right")] == 0)
        if not len(front) or not len(rest):
            break
        outer = np.full(SECTORS, front[0], np.intp)
        outer[sector[front]] = front  # by distance from the source: the farthest stays
        for turn in (0, 1, -1):
            hit = meets(outer[(sector[rest] + turn) % SECTORS], rest)
            far[rest[hit]] = k + 1
            rest = rest[~hit]
        # a step adds no more than its length to the distance from the source
        first = np.searchsorted(r[front], r[rest] - radius * SLACK)
        rest, first = rest[first < len(front)], first[first < len(front)]
        n = len(front) - first
        done = np.cumsum(n)
        a = 0
        while a < len(rest):
            b = max(a + 1, int(np.searchsorted(done, done[a] - n[a] + PAIRS, "right")))
            begin = done[a:b] - n[a:b] - (done[a] - n[a])
            p = front[np.repeat(first[a:b] - begin, n[a:b]) + np.arange(n[a:b].sum())]
            hit = np.logical_or.reduceat(meets(p, np.repeat(rest[a:b], n[a:b])), begin)
            far[rest[a:b][hit]] = k + 1
            a = b
    found = np.flatnonzero(far)
    return near[found], far[found]
