"""Exact overlay of polygons as joins: union, intersection, difference, offsets, and the rings of the result.

Coordinates are snapped to whole units (``SCALE`` of them in a metre), and from
there on all tests are exact in 64-bit integers. A set of polygons is a table of
directed edges with weights; edges that cancel, like the wall between two rooms,
are gone after one aggregate. Edges that cross are cut at their crossings until
none is left to cut (a crossing is snapped, so its edges move by less than a
unit). Of what remains, an edge is on the boundary of the result if the winding
numbers on its two sides differ in what they mean: the number is the sum of
weights east of the edge's middle, looked up in horizontal slabs. Area needs no
rings. Rings are put together by the leftmost turn at every corner, and only the
edges of one ring ever meet in a task.

Every join is on a key and a cell or a slab, so one large floor is many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from . import graph, spatial
from .scratch import Scratch

#: Units in a metre. Coordinates may go up to 10^9 units, beyond which 64 bits overflow and Spark raises.
SCALE = 1000
_EDGE = ("ax", "az", "bx", "bz")
RING = "array<struct<x:double,z:double>>"


def _units(c: Column) -> Column:
    return F.rint(c * SCALE).cast("long")


def _normal(df: DataFrame, keys: Sequence[str], weights: Sequence[str] = ("wa", "wb")) -> DataFrame:
    """Edges once each, upwards (or eastwards, if level), with the sums of their weights; what cancels is gone."""
    up = (F.col("az") < F.col("bz")) | ((F.col("az") == F.col("bz")) & (F.col("ax") < F.col("bx")))
    turned = dict(zip(_EDGE, ("bx", "bz", "ax", "az"), strict=True))
    df = df.where("ax <> bx or az <> bz").select(*keys, *(F.when(up, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in turned.items()), *(F.when(up, F.col(w)).otherwise(-F.col(w)).alias(w) for w in weights))
    return df.groupBy(*keys, *_EDGE).agg(*(F.sum(w).alias(w) for w in weights)).where(" or ".join(f"{w} <> 0" for w in weights))


def ring_edges(rings: DataFrame, keys: Sequence[str], ring: str = "ring", side: Column | None = None, hole: Column | None = None) -> DataFrame:
    """Edges (keys, ax, az, bx, bz, wa, wb) of rings array<struct<x, z>>: weight 1 for what they enclose, whichever way they turn, -1 for holes.

    ``side`` false puts a ring into the second operand. Rings of fewer than three corners or without area are left out.
    """
    own = _turned(rings, keys, ring, side, hole).withColumn("e", F.explode(geo.ring_edges(F.col("p"))))
    return own.select(*keys, *(F.col(f"e.{p}.{c}").alias(f"{p}{c}") for p in "ab" for c in "xz"), *_weights())


def _turned(rings: DataFrame, keys: Sequence[str], ring: str, side: Column | None, hole: Column | None) -> DataFrame:
    """(keys, first, hole, p, turn): corners in units, the operand, and the weight of the edges as they run; rings without area are left out."""
    points = F.transform(geo.open_ring(F.col(ring)), lambda p: F.struct(_units(p["x"]).alias("x"), _units(p["z"]).alias("z")))
    own = rings.select(*keys, (F.lit(True) if side is None else side).alias("first"), (F.lit(False) if hole is None else hole).alias("hole"), points.alias("p")).where(F.size("p") >= 3)
    twice = F.aggregate(geo.ring_edges(F.col("p")), F.lit(0).cast("long"), lambda s, e: s + e["a"]["x"] * e["b"]["z"] - e["b"]["x"] * e["a"]["z"])
    return own.withColumn("turn", F.signum(twice).cast("long") * F.when(F.col("hole"), -1).otherwise(1)).where("turn <> 0")


def _weights() -> list[Column]:
    weight = lambda mine: F.when(F.col("first") == mine, F.col("turn")).otherwise(F.lit(0)).cast("long")
    return [weight(F.lit(True)).alias("wa"), weight(F.lit(False)).alias("wb")]


def shell_edges(rings: DataFrame, keys: Sequence[str], ring: str = "ring", side: Column | None = None, hole: Column | None = None, cell: float = 4.0, least: float = 0.25, deep: int = 8) -> DataFrame:
    """Edges like those of ``ring_edges``, with the same union, difference and intersection, but without what is buried: where rings lie in piles, their number no longer counts.

    Every ring is pulled into the cells that it meets: cut at the cell's lines and what is outside moved to its border, which leaves the
    winding numbers inside as they are. A cell that one ring covers becomes one square for all its rings (if no hole is there), and a cell
    that none covers but more than ``deep`` rings meet is split in four, down to cells of ``least``. Sides of squares that touch cancel. A ring
    over more than 4,096 cells stays as it is.
    """
    scratch = Scratch(rings.sparkSession, "shell")
    own = _turned(rings, keys, ring, side, hole)
    size = int(cell * SCALE)
    corner = lambda f, c: F.floor(f(F.transform("p", lambda p: p[c])) / size)
    own = own.withColumns({f"{n}{c}": corner(f, c) for n, f in (("lo", F.array_min), ("hi", F.array_max)) for c in "xz"})
    wide = (F.expr("(hix - lox + 1) * (hiz - loz + 1) > 4096")) & ~F.col("hole")
    state = [*keys, "first", "hole", "turn", "p"]
    out = [own.where(wide).select(*state[:-1], F.explode(geo.ring_edges(F.col("p"))).alias("e"))]
    now = own.where(~wide).select(*state, F.explode(F.sequence("lox", "hix")).alias("i"), "loz", "hiz").select(*state, "i", F.explode(F.sequence("loz", "hiz")).alias("j"))
    spot = lambda x, z: F.struct(x.cast("long").alias("x"), z.cast("long").alias("z"))
    level = 0
    while True:
        lo, hi = {"x": F.col("i") * size, "z": F.col("j") * size}, {"x": F.col("i") * size + size, "z": F.col("j") * size + size}
        inner = lambda e: ~F.greatest(*((e["a"][c] == e["b"][c]) & ((e["a"][c] == lo[c]) | (e["a"][c] == hi[c])) for c in "xz"))  # noqa: B023, E731

        def path(e: Column) -> Column:
            """The edge pulled into the cell. Its cuts are told from the lesser end, so that the same line cuts it at the same point in every cell."""
            a, b = e["a"], e["b"]
            u, v = F.least(a, b), F.greatest(a, b)
            cuts = []
            for c, o in (("x", "z"), ("z", "x")):
                for line in (lo[c], hi[c]):  # noqa: B023
                    t = (line - u[c]) / F.nullif(v[c] - u[c], F.lit(0))
                    across = F.rint(u[o] + t * (v[o] - u[o])).cast("long")
                    at = spot(line, across) if c == "x" else spot(across, line)
                    cuts.append(F.when((t > 0) & (t < 1), F.struct(t.alias("t"), at.alias("q"))))
            cut = F.transform(F.array_sort(F.array_compact(F.array(*cuts))), lambda r: r["q"])
            cut = F.when(a == u, cut).otherwise(F.reverse(cut))
            straight = (a["x"] == b["x"]) | (a["z"] == b["z"])
            every = F.when(straight, F.array(a, b)).otherwise(F.concat(F.array(a), cut, F.array(b)))
            held = F.transform(every, lambda q: spot(*(F.greatest(lo[c], F.least(hi[c], q[c])) for c in "xz")))  # noqa: B023
            steps = F.transform(F.array(held), lambda h: F.zip_with(F.slice(h, F.lit(1), F.size(h) - 1), F.slice(h, F.lit(2), F.size(h) - 1), lambda p, q: F.struct(p.alias("a"), q.alias("b"))))[0]
            return F.filter(steps, lambda s: s["a"] != s["b"])

        # made by a generator, so that the optimizer does not write the term out again wherever it is used
        met = now.select(*state, "i", "j", F.explode(F.array(F.flatten(F.transform(geo.ring_edges(F.col("p")), path)))).alias("e"))
        twice = F.aggregate("e", F.lit(0).cast("long"), lambda s, e: s + (e["a"]["x"] - lo["x"]) * (e["b"]["z"] - lo["z"]) - (e["b"]["x"] - lo["x"]) * (e["a"]["z"] - lo["z"]))  # noqa: B023
        met = met.withColumns({"inner": F.exists("e", inner), "twice": twice}).where("inner or twice <> 0")
        place = Window.partitionBy(*keys, "first", "i", "j")
        full = F.max(~F.col("inner") & ~F.col("hole") & (F.col("turn") * F.col("twice") > 0)).over(place) & ~F.max("hole").over(place)
        last = size % 2 == 1 or size < 2 * least * SCALE
        met = met.withColumn("full", full).withColumn("split", ~F.col("full") & (F.count(F.lit(1)).over(place) > deep) & F.lit(not last))
        met = scratch.save(met.select(*state, "i", "j", "full", "split", F.when(~(F.col("full") | F.col("split")), F.col("e")).alias("e")), f"level-{level}")
        x, z = F.col("i") * size, F.col("j") * size
        square = geo.ring_edges(F.array(spot(x, z), spot(x + size, z), spot(x + size, z + size), spot(x, z + size)))
        out.append(met.where("full").select(*keys, "first", "i", "j").distinct().select(*keys, "first", F.lit(False).alias("hole"), F.lit(1).cast("long").alias("turn"), F.explode(square).alias("e")))
        out.append(met.where("not full and not split").select(*state[:-1], F.explode("e").alias("e")))
        now = met.where("split")
        if last or now.isEmpty():
            break
        half = F.explode(F.array(*(F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a in (0, 1) for b in (0, 1))))
        now = now.withColumn("h", half).select(*state, (F.col("i") * 2 + F.col("h.i")).alias("i"), (F.col("j") * 2 + F.col("h.j")).alias("j"))
        size //= 2
        level += 1
    out = [part.select(*keys, *(F.col(f"e.{p}.{c}").alias(f"{p}{c}") for p in "ab" for c in "xz"), *_weights()) for part in out]
    return reduce(DataFrame.unionByName, out)


def _cross(a: Sequence[Column], px: Column, pz: Column) -> Column:
    return (a[2] - a[0]) * (pz - a[1]) - (a[3] - a[1]) * (px - a[0])


def noded(edges: DataFrame, keys: Sequence[str], cell: float, scratch: Scratch, max_rounds: int = 30) -> DataFrame:
    """The same edges cut so that no two cross or overlap, each once with its summed weights. Raises if they do not settle."""
    now = scratch.save(_normal(edges, keys), "noded-0")
    c = {n: F.col(n) for n in (*_EDGE, *(f"o{n}" for n in _EDGE))}
    e, o = [c[n] for n in _EDGE], [c[f"o{n}"] for n in _EDGE]
    point = lambda x, z: F.struct(x.alias("x"), z.alias("z"))
    for k in range(1, max_rounds + 1):
        laid = now.select(*keys, *_EDGE, F.explode(spatial._cells_of_line(*(F.col(n).cast("double") for n in _EDGE), cell * SCALE)).alias("c"))
        met = laid.join(laid.select(*keys, "c", *(F.col(n).alias(f"o{n}") for n in _EDGE)), [*keys, "c"]).where(~((e[0] == o[0]) & (e[1] == o[1]) & (e[2] == o[2]) & (e[3] == o[3])))
        met = met.withColumns({"s1": _cross(e, o[0], o[1]), "s2": _cross(e, o[2], o[3]), "s3": _cross(o, e[0], e[1]), "s4": _cross(o, e[2], e[3])})

        def within(px: Column, pz: Column) -> Column:
            along = (px - e[0]) * (e[2] - e[0]) + (pz - e[1]) * (e[3] - e[1])
            return (along > 0) & (along < (e[2] - e[0]) * (e[2] - e[0]) + (e[3] - e[1]) * (e[3] - e[1]))

        on = [F.when((F.col(s) == 0) & within(x, z), point(x, z)) for s, x, z in (("s1", o[0], o[1]), ("s2", o[2], o[3]))]
        crosses = (F.signum("s1") * F.signum("s2") < 0) & (F.signum("s3") * F.signum("s4") < 0)
        # both edges of a crossing must name the same point, so it is told from the lesser edge
        mine = F.struct(*e) < F.struct(*o)
        t = F.when(mine, F.col("s3") / (F.col("s3") - F.col("s4"))).otherwise(F.col("s1") / (F.col("s1") - F.col("s2")))
        base = [F.when(mine, a).otherwise(b) for a, b in zip(e, o, strict=True)]
        at = point(*(F.rint(base[i] + t * (base[i + 2] - base[i])).cast("long") for i in (0, 1)))
        cuts = met.select(*keys, *_EDGE, F.explode(F.array_compact(F.array(*on, F.when(crosses, at)))).alias("p"))
        cuts = cuts.where(~((F.col("p.x") == e[0]) & (F.col("p.z") == e[1])) & ~((F.col("p.x") == e[2]) & (F.col("p.z") == e[3])))
        cuts = scratch.save(cuts.groupBy(*keys, *_EDGE).agg(F.collect_set("p").alias("p")), f"cuts-{k}")
        if cuts.isEmpty():
            return now
        along = lambda p: (p["x"] - F.col("ax")) * (F.col("bx") - F.col("ax")) + (p["z"] - F.col("az")) * (F.col("bz") - F.col("az"))
        order = F.array_sort(F.transform("p", lambda p: F.struct(along(p).alias("t"), p["x"].alias("x"), p["z"].alias("z"))))
        chain = F.concat(F.array(point(F.col("ax"), F.col("az"))), F.transform(order, lambda p: point(p["x"], p["z"])), F.array(point(F.col("bx"), F.col("bz"))))
        steps = F.zip_with(F.slice("q", F.lit(1), F.size("q") - 1), F.slice("q", F.lit(2), F.size("q") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        cut = now.join(cuts, [*keys, *_EDGE]).withColumn("q", chain).select(*keys, "wa", "wb", F.explode(steps).alias("s"))
        cut = cut.select(*keys, *(F.col(f"s.{p}.{d}").alias(f"{p}{d}") for p in "ab" for d in "xz"), "wa", "wb")
        whole = now.join(cuts, [*keys, *_EDGE], "left_anti").select(*cut.columns)
        now = scratch.save(_normal(whole.unionByName(cut), keys), f"noded-{k}")
        scratch.drop(f"noded-{k - 1}", f"cuts-{k}")
    raise RuntimeError(f"edges still cross after {max_rounds} rounds")


def boundary(edges: DataFrame, keys: Sequence[str], inside: str = "union", cell: float = 4.0) -> DataFrame:
    """Directed edges (keys, ax, az, bx, bz) around the result, its inside on their left, in units.

    ``inside`` says what belongs to the result: "union" of the first operand, its "difference" from or "intersection" with the second.
    """
    scratch = Scratch(edges.sparkSession, "overlay")
    lines = noded(edges, keys, cell, scratch)
    slab = int(cell * SCALE)
    rising = lines.where("az < bz").withColumn("slab", F.explode(F.sequence(F.floor(F.col("az") / slab), F.floor((F.col("bz") - 1) / slab))))
    rising = rising.select(*keys, "slab", *(F.col(n).alias(f"o{n}") for n in _EDGE), F.col("wa").alias("oa"), F.col("wb").alias("ob"))
    middles = lines.withColumns({"mx": F.col("ax") + F.col("bx"), "mz": F.col("az") + F.col("bz")}).withColumn("slab", F.floor(F.col("mz") / (2 * slab)))
    level = (F.col("mz") >= 2 * F.col("oaz")) & (F.col("mz") < 2 * F.col("obz"))
    east = (F.col("obx") - F.col("oax")) * (F.col("mz") - 2 * F.col("oaz")) - (F.col("obz") - F.col("oaz")) * (F.col("mx") - 2 * F.col("oax")) > 0
    own = (F.col("ax") == F.col("oax")) & (F.col("az") == F.col("oaz")) & (F.col("bx") == F.col("obx")) & (F.col("bz") == F.col("obz"))
    seen = middles.join(rising, [*keys, "slab"]).where(level & east & ~own).groupBy(*keys, *_EDGE).agg(F.sum("oa").alias("ea"), F.sum("ob").alias("eb"))
    # east of a rising edge (above a level one) the sums hold; on the other side the edge's own weight comes in
    both = lines.join(seen, [*keys, *_EDGE], "left").fillna(0, ["ea", "eb"])
    sign = F.when(F.col("az") < F.col("bz"), 1).otherwise(-1)
    near = _rule(inside, F.col("ea"), F.col("eb"))
    far = _rule(inside, F.col("ea") + sign * F.col("wa"), F.col("eb") + sign * F.col("wb"))
    left = F.when(F.col("az") < F.col("bz"), far).otherwise(near)
    right = F.when(F.col("az") < F.col("bz"), near).otherwise(far)
    kept = both.select(*keys, *_EDGE, left.alias("l"), right.alias("r")).where("l <> r")
    turned = dict(zip(_EDGE, ("bx", "bz", "ax", "az"), strict=True))
    return scratch.save(kept.select(*keys, *(F.when(F.col("l"), F.col(c)).otherwise(F.col(o)).alias(c) for c, o in turned.items())), "boundary")


def _rule(inside: str, a: Column, b: Column) -> Column:
    rules = {"union": a > 0, "intersection": (a > 0) & (b > 0), "difference": (a > 0) & (b <= 0)}
    return rules[inside]


def areas(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, twice): twice the area inside a boundary, in square units, exact."""
    return edges.groupBy(*keys).agg(F.sum(F.col("ax") * F.col("bz") - F.col("bx") * F.col("az")).alias("twice"))


def rings(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ring_id, ring, twice): the closed rings of a boundary in metres, without corners on a straight line; outer rings have positive, holes negative area.

    Parts that touch at a corner are rings of their own.
    """
    scratch = Scratch(edges.sparkSession, "rings")
    ends = {"ax": "bx", "az": "bz", "bx": "cx", "bz": "cz"}
    links = corners(edges, keys).select(F.struct(*keys, *_EDGE).alias("id"), F.struct(*keys, *(F.col(c).alias(n) for n, c in ends.items())).alias("next"), *keys)
    links = scratch.save(links, "links")
    labels = graph.components(links, links, "id", "id", "next")
    walked = links.withColumnRenamed("id", "node").join(labels, "node")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        after = {tuple(i)[-4:]: tuple(n)[-4:] for i, n in zip(map(dict.values, pdf["node"]), map(dict.values, pdf["next"]), strict=True)}
        at = start = min(after)
        ring, twice = [], 0
        while True:
            nxt = after[at]
            if (at[2] - at[0]) * (nxt[3] - nxt[1]) != (at[3] - at[1]) * (nxt[2] - nxt[0]):
                ring.append({"x": at[2] / SCALE, "z": at[3] / SCALE})
            twice += at[0] * at[3] - at[2] * at[1]
            at = nxt
            if at == start:
                break
        first = pdf.iloc[0]
        return pd.DataFrame({**{k: [first[k]] for k in keys}, "ring_id": ["_".join(map(str, start))], "ring": [ring], "twice": [twice]})

    kinds = dict(edges.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", ring_id string, ring {RING}, twice long"
    return walked.groupBy("component").applyInPandas(walk, schema)


def polygons(found: DataFrame, keys: Sequence[str], cell: float = 4.0, name: str = "part") -> DataFrame:
    """(keys, part or ``name``, ring, holes, area): outer rings with the holes inside them, numbered by area from the largest (ties by ring id); area in square metres without holes.

    A hole belongs to the smallest outer ring around it.
    """
    scratch = Scratch(found.sparkSession, "polygons")
    found = scratch.save(found, "rings")
    outer = found.where("twice > 0").select(*keys, F.col("ring_id").alias("outer_id"), F.col("ring").alias("outer"), F.col("twice").alias("outer_twice"))
    inner = found.where("twice < 0")
    first = F.element_at("ring", 1)
    at = inner.select(*keys, "ring_id", "ring", "twice", first["x"].alias("x"), first["z"].alias("z")).withColumn("c", F.struct(spatial._cell(F.col("x"), cell).alias("i"), spatial._cell(F.col("z"), cell).alias("j")))
    side = lambda f, k: f(F.transform("outer", lambda p: p[k]))
    laid = outer.withColumn("c", F.explode(spatial._cells_of_box(side(F.array_min, "x"), side(F.array_min, "z"), side(F.array_max, "x"), side(F.array_max, "z"), cell)))
    held = at.join(laid, [*keys, "c"]).where(geo.point_in_ring(F.col("x"), F.col("z"), F.col("outer")) & (F.col("outer_twice") > -F.col("twice")))
    owner = held.groupBy(*keys, "ring_id").agg(F.min_by(F.struct("outer_id", "ring", "twice"), F.struct("outer_twice", "outer_id")).alias("m"))
    holes = owner.groupBy(*keys, F.col("m.outer_id").alias("outer_id")).agg(F.array_sort(F.collect_list("m.ring")).alias("holes"), F.sum("m.twice").alias("less"))
    parts = outer.join(holes, [*keys, "outer_id"], "left")
    total = F.col("outer_twice") + F.coalesce("less", F.lit(0))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(total.desc(), "outer_id"))
    return parts.select(*keys, rank.alias(name), F.col("outer").alias("ring"), F.coalesce("holes", F.array().cast(f"array<{RING}>")).alias("holes"), (total / (2 * SCALE * SCALE)).alias("area"))


def union_area(rings_: DataFrame, keys: Sequence[str], ring: str = "ring", cell: float = 4.0) -> DataFrame:
    """(keys, twice) of the union of all rings of a key, in square units."""
    return areas(boundary(shell_edges(rings_, keys, ring, cell=cell), keys, "union", cell / 8), keys)  # pieces are short


# --- shapes around lines, and offsets ---


def capsule(x1: Column, z1: Column, x2: Column, z2: Column, radius: float, quarter: int = 8) -> Column:
    """Ring around all places within ``radius`` of a segment, ``quarter`` steps to a quarter of a round end; a circle around a point."""
    along = F.atan2(z2 - z1, x2 - x1)
    spot = lambda x, z, turn: lambda i: F.struct((x + radius * F.cos(along + turn + i * (1.5707963267948966 / quarter))).alias("x"), (z + radius * F.sin(along + turn + i * (1.5707963267948966 / quarter))).alias("z"))
    steps = F.sequence(F.lit(0), F.lit(2 * quarter))
    return F.concat(F.transform(steps, spot(x2, z2, -1.5707963267948966)), F.transform(steps, spot(x1, z1, 1.5707963267948966)))


def strip(x1: Column, z1: Column, x2: Column, z2: Column, half: float) -> Column:
    """Ring of the rectangle ``half`` to both sides of a segment, flat at its ends; null for a segment of no length."""
    n = F.nullif(geo.distance(x1, z1, x2, z2), F.lit(0.0))
    ox, oz = -(z2 - z1) / n * half, (x2 - x1) / n * half
    spot = lambda x, z: F.struct(x.alias("x"), z.alias("z"))
    return F.when(n.isNotNull(), F.array(spot(x1 - ox, z1 - oz), spot(x2 - ox, z2 - oz), spot(x2 + ox, z2 + oz), spot(x1 + ox, z1 + oz)))


def corners(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ax, az, bx, bz, cx, cz): every edge of a boundary and the end of the edge that follows it, the leftmost of several."""
    out = edges.select(*keys, F.col("ax").alias("bx"), F.col("az").alias("bz"), F.col("bx").alias("cx"), F.col("bz").alias("cz"))
    u, v = [F.col("bx") - F.col("ax"), F.col("bz") - F.col("az")], [F.col("cx") - F.col("bx"), F.col("cz") - F.col("bz")]
    turn = F.atan2((u[0] * v[1] - u[1] * v[0]).cast("double"), (u[0] * v[0] + u[1] * v[1]).cast("double"))
    met = edges.select(*keys, *_EDGE).join(out, [*keys, "bx", "bz"]).groupBy(*keys, *_EDGE)
    return met.agg(F.max_by(F.struct("cx", "cz"), F.struct(turn, "cx", "cz")).alias("c")).select(*keys, *_EDGE, "c.cx", "c.cz")


def offset(edges: DataFrame, keys: Sequence[str], by: float, mitre: float = 5.0, cell: float = 4.0) -> DataFrame:
    """The boundary grown outwards by ``by`` metres with mitred corners; a mitre of over ``mitre`` times ``by`` is cut off flat.

    Every edge carries a rectangle and every convex corner a kite; their union with the polygon is the result.
    """
    c = corners(edges, keys)
    a, b, d = ((F.col(f"{n}x") / SCALE, F.col(f"{n}z") / SCALE) for n in "abc")

    def normal(p: tuple, q: tuple) -> tuple[Column, Column]:
        n = geo.distance(*p, *q)
        return (q[1] - p[1]) / n, -(q[0] - p[0]) / n

    m, o = normal(a, b), normal(b, d)
    spot = lambda p, *ways: F.struct(*(sum((w[k] for w in ways), p[k]).alias(n) for k, n in enumerate("xz")))
    far = lambda n: (n[0] * by, n[1] * by)
    box = F.array(spot(a), spot(b), spot(b, far(m)), spot(a, far(m)))
    dot = m[0] * o[0] + m[1] * o[1]
    tip = F.struct(*((b[k] + by * (m[k] + o[k]) / (1 + dot)).alias(n) for k, n in enumerate("xz")))
    kite = F.when(2 / F.greatest(1 + dot, F.lit(1e-12)) <= mitre * mitre, F.array(spot(b), spot(b, far(m)), tip, spot(b, far(o)))).otherwise(F.array(spot(b), spot(b, far(m)), spot(b, far(o))))
    convex = (F.col("bx") - F.col("ax")) * (F.col("cz") - F.col("bz")) - (F.col("bz") - F.col("az")) * (F.col("cx") - F.col("bx")) > 0
    added = c.select(*keys, box.alias("ring")).unionByName(c.where(convex).select(*keys, kite.alias("ring")))
    whole = edges.select(*keys, *_EDGE, F.lit(1).cast("long").alias("wa"), F.lit(0).cast("long").alias("wb"))
    return boundary(whole.unionByName(ring_edges(added, keys)), keys, "union", cell)


def polygon_edges(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Directed edges (keys, ax, az, bx, bz) of polygons (keys, ring, holes): a boundary again, by key."""
    every = parts.select(*keys, F.explode(F.concat(F.array("ring"), F.col("holes"))).alias("ring"))
    return every.select(*keys, F.explode(geo.ring_edges(F.col("ring"))).alias("e")).select(*keys, *(_units(F.col(f"e.{p}.{c}")).alias(f"{p}{c}") for p in "ab" for c in "xz"))


# --- cells ---


def _cut_by_grid(df: DataFrame, x1: Column, z1: Column, x2: Column, z2: Column, size: float) -> DataFrame:
    """df once for every piece (px1, pz1, px2, pz2) that grid lines cut the segment into."""

    def at(p: Column, q: Column) -> Column:
        lines = F.sequence(F.floor(F.least(p, q) / size).cast("long") + 1, F.greatest(F.ceil(F.greatest(p, q) / size).cast("long") - 1, F.floor(F.least(p, q) / size).cast("long") + 1))
        return F.filter(F.transform(lines, lambda k: (k * size - p) / F.nullif(q - p, F.lit(0.0))), lambda t: (t > 0) & (t < 1))

    df = df.withColumn("__t", F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), at(x1, x2), at(z1, z2)))))
    pairs = F.zip_with(F.slice("__t", F.lit(1), F.size("__t") - 1), F.slice("__t", F.lit(2), F.size("__t") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    df = df.withColumn("__p", F.explode(pairs))
    place = lambda p, q, t: F.when(F.col(f"__p.{t}") == 1.0, q).otherwise(p + F.col(f"__p.{t}") * (q - p))
    return df.withColumns({"px1": place(x1, x2, "a"), "pz1": place(z1, z2, "a"), "px2": place(x1, x2, "b"), "pz2": place(z1, z2, "b")}).drop("__t", "__p")


def cell_areas(edges: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """(keys, cx, cz, area): the exact area of a boundary's inside in every grid cell that it meets, in square metres.

    A piece of boundary in a cell bounds the area east of it, in its own cell and in full in those beyond: a sum along the row of cells.
    """
    e = [F.col(n) / SCALE for n in _EDGE]
    p = _cut_by_grid(edges, *e, size).withColumns({"cx": spatial._cell((F.col("px1") + F.col("px2")) / 2, size), "cz": spatial._cell((F.col("pz1") + F.col("pz2")) / 2, size), "down": F.col("pz1") - F.col("pz2")})
    own = F.col("down") * ((F.col("cx") + 1) * size - (F.col("px1") + F.col("px2")) / 2)
    met = p.where("down <> 0").groupBy(*keys, "cz", "cx").agg(F.sum(own).alias("own"), F.sum("down").alias("down"))
    row = Window.partitionBy(*keys, "cz").orderBy("cx")
    met = met.withColumns({"through": F.sum("down").over(row.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "then": F.lead("cx").over(row)})
    here = F.struct("cx", (F.col("own") + size * (F.col("through") - F.col("down"))).alias("area"))
    full = (F.col("through") > size * 1e-6) & (F.col("then") > F.col("cx") + 1)
    between = F.when(full, F.transform(F.sequence(F.col("cx") + 1, F.greatest(F.col("then") - 1, F.col("cx") + 1)), lambda i: F.struct(i.alias("cx"), (F.col("through") * size).alias("area"))))
    return met.select(*keys, "cz", F.explode(F.concat(F.array(here), F.coalesce(between, F.array().cast("array<struct<cx:bigint,area:double>>")))).alias("c")).select(*keys, "c.cx", "cz", "c.area").where(F.col("area") > 1e-9)


def cell_runs(segments: DataFrame, keys: Sequence[str], names: Sequence[str], size: float) -> DataFrame:
    """(keys, cx, cz, run): length of each segment (x1, z1, x2, z2 by ``names``) inside every grid cell, borders included: one along a grid line runs in the cells on both sides."""
    x1, z1, x2, z2 = (F.col(n).cast("double") for n in names)
    p = _cut_by_grid(segments, x1, z1, x2, z2, size).withColumn("run", geo.distance(*(F.col(n) for n in ("px1", "pz1", "px2", "pz2"))))

    def cells(a: str, b: str) -> Column:
        mid = (F.col(a) + F.col(b)) / 2 / size
        return F.when((F.col(a) == F.col(b)) & (mid == F.floor(mid)), F.array(F.floor(mid) - 1, F.floor(mid))).otherwise(F.array(F.floor(mid)))

    p = p.withColumn("cx", F.explode(cells("px1", "px2"))).withColumn("cz", F.explode(cells("pz1", "pz2")))
    return p.select(*keys, F.col("cx").cast("long").alias("cx"), F.col("cz").cast("long").alias("cz"), "run")


def dissolve(boxes: DataFrame, keys: Sequence[str], names: Sequence[str] = ("x1", "z1", "x2", "z2")) -> DataFrame:
    """Boundary of boxes that do not overlap and share whole sides: shared sides cancel, no cutting is needed."""
    x1, z1, x2, z2 = (F.col(n) for n in names)
    spot = lambda x, z: F.struct(x.alias("x"), z.alias("z"))
    lines = _normal(ring_edges(boxes.select(*keys, F.array(spot(x1, z1), spot(x2, z1), spot(x2, z2), spot(x1, z2)).alias("ring")), keys), keys)
    turned = dict(zip(_EDGE, ("bx", "bz", "ax", "az"), strict=True))
    return lines.select(*keys, *(F.when(F.col("wa") > 0, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in turned.items()))
