"""Spatial joins by grid cells: every join is an equi-join on a cell, then an exact test. No nested loop over all pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from .relational import checkpointed, first_by, top_k
from .scratch import Scratch, free_names


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def grid_distance_join(left: DataFrame, right: DataFrame, lx: str, lz: str, rx: str, rz: str, radius: float, on: Sequence[str] = (), name: str = "distance", apart: tuple[str, str] | None = None) -> DataFrame:
    """Pairs within radius. The right side is laid into its 3x3 cells, so every pair meets exactly once; cells are a little wider than the
    radius, for the distance of points that are two cells of the radius apart can round to it. apart: columns of left and right that
    must differ; left rows whose cell holds right rows of their own value alone are then dropped before the join."""
    n, cx, cz, lo, hi = free_names([*left.columns, *right.columns, name], "__n", "__cx", "__cz", "__lo", "__hi")
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    size = radius * (1 + 1e-6)
    l = left.withColumns({cx: _cell(F.col(lx), size), cz: _cell(F.col(lz), size)})
    r = right.withColumn(n, around).withColumns({cx: _cell(F.col(rx), size) + F.col(f"{n}.i"), cz: _cell(F.col(rz), size) + F.col(f"{n}.j")}).drop(n)
    met = None
    if apart:
        held = r.groupBy(cx, cz, *on).agg(F.min(apart[1]).alias(lo), F.max(apart[1]).alias(hi))
        l = l.join(held, [cx, cz, *on]).where((F.col(lo) != F.col(apart[0])) | (F.col(hi) != F.col(apart[0]))).drop(lo, hi)
        met = F.col(apart[0]) != F.col(apart[1])
    pairs = l.join(r, [cx, cz, *on])
    pairs = pairs if met is None else pairs.where(met)
    return pairs.withColumn(name, geo.distance(F.col(lx), F.col(lz), F.col(rx), F.col(rz))).where(F.col(name) <= radius).drop(cx, cz)


def distance_semi_join(left: DataFrame, right: DataFrame, lx: str, lz: str, rx: str, rz: str, radius: float, left_id: str, on: Sequence[str] = ()) -> DataFrame:
    """Rows of left with a right row within radius; an empty right side passes everything."""
    if right.isEmpty():
        return left
    ids = grid_distance_join(left.select(left_id, lx, lz, *on), right.select(rx, rz, *on).distinct(), lx, lz, rx, rz, radius, on).select(left_id).distinct()
    return left.join(ids, left_id, "left_semi")


def _first_radius(right: DataFrame, rx: str, rz: str, radius: float, on: Sequence[str], want: int, halvings: int = 10) -> float:
    """The largest of radius, radius / 2, radius / 4 ... whose cells hold no more than ``want`` rows where the mean row lies."""
    cells = right.select(*on, F.col(rx).alias("x"), F.col(rz).alias("z"), F.explode(F.sequence(F.lit(0), F.lit(halvings))).alias("m"))
    size = F.lit(float(radius)) / F.pow(F.lit(2.0), F.col("m"))
    held = cells.groupBy(*on, "m", F.floor(F.col("x") / size).alias("i"), F.floor(F.col("z") / size).alias("j")).count()
    mean = held.groupBy("m").agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("n")).where(F.col("n") <= want).agg(F.min("m")).first()[0]
    return radius / 2 ** (halvings if mean is None else mean)


def knn_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, lx: str, lz: str, rx: str, rz: str, k: int | Column, radius: float, on: Sequence[str] = (), above: float = -1.0, most: int | None = None, keep: Column | None = None) -> DataFrame:
    """The k nearest right rows within radius (and farther than above, and of the pairs that ``keep`` takes), ties to the smaller id. k may be a column of left, with ``most`` as a hint how large it is; its greatest value lets the plan drop rows before the shuffle.

    It begins with a radius that fits how densely the right rows lie and doubles it for left rows that have not found k yet, so dense places
    never make pairs of all that lie within the whole radius.
    """
    scratch = Scratch(left.sparkSession, "knn")
    limit = k if isinstance(k, int) else left.agg(F.max(k)).first()[0] or 0
    ok = (F.col("distance") > above) & (F.col(left_id) != F.col(right_id)) & (F.lit(True) if keep is None else keep)
    within = _first_radius(right, rx, rz, radius, on, 2 * (most or (k if isinstance(k, int) else 8)))
    rest, hits, wanted = left, [], F.lit(k) if isinstance(k, int) else k
    while True:
        pairs = grid_distance_join(rest, right, lx, lz, rx, rz, within, on).where(ok)
        ranked = scratch.save(top_k(pairs, [left_id], ["distance", right_id], limit).withColumn("__k", wanted), f"found-{len(hits)}")
        if within >= radius:
            hits.append(ranked)
            break
        full = ranked.groupBy(left_id).agg(F.max("rank").alias("__n"), F.max("__k").alias("__m")).where("__n >= __m").select(left_id)
        hits.append(ranked.join(full, left_id, "left_semi"))
        rest = scratch.save(rest.join(full, left_id, "left_anti"), f"rest-{len(hits)}")
        if rest.isEmpty():
            break
        within = min(radius, 2 * within)
    return reduce(DataFrame.unionByName, hits).where("rank <= __k").select(*pairs.columns, "rank")


def nearest_one(left: DataFrame, right: DataFrame, left_id: str, right_id: str, lx: str, lz: str, rx: str, rz: str, radius: float, on: Sequence[str] = ()) -> DataFrame:
    """The nearest right row whatever its distance, found from coarse cells to fine ones; ``radius`` is the size of the finest, halved while
    the mean right row shares its cell with more than eight.

    Every cell is known by the box around its rows. Of a left cell's candidates those go whose box is farther than the farthest corner of
    another, then cells and candidates split in four each, and only at the finest level rows meet. So clusters that lie far apart meet through
    the cells that face each other, never in one cell that holds both. Every left row comes back: one without a place, or with no right row to
    find, has nulls. Ties go to the smaller right id.
    """
    every = grid_distance_join(left, right, lx, lz, rx, rz, radius, on).columns
    scratch = Scratch(left.sparkSession, "nearest")
    finite = lambda c: F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf"))
    xa, za, ia, ja = free_names(left.columns, "__x", "__z", "__i", "__j")
    xb, zb, ib, jb = free_names(right.columns, "__x", "__z", "__i", "__j")
    radius = _first_radius(right.where(finite(rx) & finite(rz)), rx, rz, radius, on, 8)
    placed = lambda df, x, z, n: df.where(finite(x) & finite(z)).withColumns({n[0]: F.col(x).cast("double"), n[1]: F.col(z).cast("double")}).withColumns({n[2]: _cell(F.col(n[0]), radius), n[3]: _cell(F.col(n[1]), radius)})
    l, r = placed(left, lx, lz, (xa, za, ia, ja)), placed(right, rx, rz, (xb, zb, ib, jb))

    def boxes(df: DataFrame, n: Sequence[str]) -> DataFrame:
        keys = [F.col(k).alias(f"k{m}") for m, k in enumerate(on)]
        return df.select(*keys, F.lit(0).alias("one"), *(F.col(c).alias(d) for c, d in zip(n, "xzij", strict=True))).groupBy(*same, "i", "j").agg(F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("z").alias("z1"), F.max("z").alias("z2"))

    same = ["one", *(f"k{m}" for m in range(len(on)))]
    fine = [scratch.save(boxes(l, (xa, za, ia, ja)), "left"), scratch.save(boxes(r, (xb, zb, ib, jb)), "right")]
    box = fine[0].unionByName(fine[1]).agg(F.min("i"), F.max("i"), F.min("j"), F.max("j")).first()
    levels = 0
    while box[0] is not None and max(box[1] - box[0], box[3] - box[2]) >> levels > 1:
        levels += 1

    def at(cells: DataFrame, level: int, p: str) -> DataFrame:
        """Boxes of the cells of a level, with the cells above them."""
        up = [F.shiftright(c, level).alias(c) for c in "ij"]
        g = cells.select(*same, *up, "x1", "x2", "z1", "z2").groupBy(*same, "i", "j").agg(*(f(c).alias(c) for f, c in ((F.min, "x1"), (F.max, "x2"), (F.min, "z1"), (F.max, "z2"))))
        return g.select(*same, *(F.col(c).alias(f"{p}{c}") for c in ("i", "j", "x1", "x2", "z1", "z2")), *(F.shiftright(c, 1).alias(f"{p}up{c}") for c in "ij"))

    pairs = None
    for level in range(levels, -1, -1):
        a, b = at(fine[0], level, "a"), at(fine[1], level, "b")
        if pairs is None:  # a few cells on either side hold everything
            met = a.join(b, same)
        else:
            above = pairs.select(*same, *(F.col(f"{p}{c}").alias(f"{p}up{c}") for p in "ab" for c in "ij"))
            met = above.join(a, [*same, "aupi", "aupj"]).join(b, [*same, "bupi", "bupj"])
        c = F.col
        gap = lambda d: F.greatest(F.lit(0.0), c(f"b{d}1") - c(f"a{d}2"), c(f"a{d}1") - c(f"b{d}2"))  # noqa: B023, E731
        span = lambda d: F.greatest(c(f"b{d}2") - c(f"a{d}1"), c(f"a{d}2") - c(f"b{d}1"))  # noqa: B023, E731
        met = met.withColumns({"near": gap("x") * gap("x") + gap("z") * gap("z"), "far": span("x") * span("x") + span("z") * span("z")})
        bound = F.min("far").over(Window.partitionBy(*same, "ai", "aj"))
        pairs = met.withColumn("bound", bound * (1 + 1e-9)).where("near <= bound").select(*same, "ai", "aj", "bi", "bj")
        pairs = scratch.save(pairs, f"pairs-{level}")
        scratch.drop(f"pairs-{level + 1}")
    links = pairs.select(*(F.col(f"k{m}").alias(k) for m, k in enumerate(on)), F.col("ai").alias(ia), F.col("aj").alias(ja), F.col("bi").alias(ib + "r"), F.col("bj").alias(jb + "r"))
    r = r.withColumnsRenamed({ib: ib + "r", jb: jb + "r"}).drop(xb, zb)
    away = geo.distance(F.col(lx), F.col(lz), F.col(rx), F.col(rz))
    (least,) = free_names(every, "__least")
    meet = lambda a, b: a.join(links, [*on, ia, ja]).join(b, [*on, ib + "r", jb + "r"]).withColumn("distance", away)
    best = meet(l.select(left_id, lx, lz, *on, ia, ja), r.select(rx, rz, *on, ib + "r", jb + "r")).groupBy(left_id).agg(F.min("distance").alias(least))
    met = meet(l.drop(xa, za).join(scratch.save(best, "least"), left_id), r).where(F.col("distance") == F.col(least))  # the least first: no sort of all that met
    own = [c for c in every if c not in left.columns]
    found = first_by(met, [left_id], ["distance", right_id]).select(left_id, *own)
    return left.join(scratch.save(found, "found"), left_id, "left").select(*every)


def _cells_of_box(x1, z1, x2, z2, size: float) -> Column:
    span = lambda a, b: F.sequence(_cell(F.least(a, b), size), _cell(F.greatest(a, b), size))
    return F.flatten(F.transform(span(x1, x2), lambda i: F.transform(span(z1, z2), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def _cells_of_line(x1, z1, x2, z2, size: float) -> Column:
    """Cells that the segment runs through, column by column: as many as it is long, not as many as its box has. Borders are taken a little wider."""
    lo, hi, low, high = F.least(x1, x2), F.greatest(x1, x2), F.least(z1, z2), F.greatest(z1, z2)
    slope = (z2 - z1) / F.when(x1 == x2, F.lit(1.0)).otherwise(x2 - x1)
    at = lambda x: F.greatest(low, F.least(high, z1 + (x - x1) * slope))
    margin = 1e-7 * size

    def column(i: Column) -> Column:
        a, b = at(F.greatest(lo, i * size)), at(F.least(hi, (i + 1) * size))
        bottom, top = F.when(x1 == x2, low).otherwise(F.least(a, b)) - margin, F.when(x1 == x2, high).otherwise(F.greatest(a, b)) + margin
        return F.transform(F.sequence(_cell(bottom, size), _cell(top, size)), lambda j: F.struct(i.alias("i"), j.alias("j")))

    return F.flatten(F.transform(F.sequence(_cell(lo - margin, size), _cell(hi + margin, size)), column))


#: Rows of a cell that meet the other side's rows of it in one piece of work.
BLOCK = 256


def _in_blocks(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str) -> DataFrame:
    """left and right joined by their keys, a key's pairs dealt out in blocks of about BLOCK left rows, so that a full cell is no long task."""
    block, blocks = free_names([*left.columns, *right.columns], "__block", "__blocks")
    held = left.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(blocks))
    l = left.join(held, [*keys]).withColumn(block, F.pmod(F.xxhash64(left_id), F.col(blocks)).cast("int")).drop(blocks)
    r = right.join(held, [*keys]).withColumn(block, F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))).drop(blocks)
    return r.hint("merge").join(l, [*keys, block]).drop(block).select(*left.columns, *(c for c in right.columns if c not in keys))


def segment_intersect_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, l: Sequence[str], r: Sequence[str], size: float, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of segments whose interiors cross. l, r: names of x1, z1, x2, z2. Ids are unique.

    Both are laid into the cells they run through, and a pair counts in the first cell they share, so no pair is shuffled. Where segments are
    so long that cells would spare less than three quarters of the pairs of a key, keys alone are joined. Either way a full cell is many
    pieces of work.
    """
    (cell,) = free_names([*left.columns, *right.columns], "__c")
    laid = lambda c: _cells_of_line(*map(F.col, c), size)
    cells = lambda d, c: d.withColumn(cell, F.explode(laid(c)))
    one = lambda d: d.withColumn(cell, F.lit(0))

    def pairs(a: DataFrame, b: DataFrame) -> int:
        held = lambda d, n: d.groupBy(cell, *on).agg(F.count(F.lit(1)).cast("double").alias(n))
        return held(a, "n").join(held(b, "m"), [cell, *on]).agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0

    coarse = 4 * pairs(cells(left, l), cells(right, r)) > pairs(one(left), one(right))
    met = _in_blocks(one(left) if coarse else cells(left, l), one(right) if coarse else cells(right, r), [cell, *on], left_id).where(F.col(left_id) != F.col(right_id))
    met = met.where(geo.segments_cross(list(map(F.col, l)), list(map(F.col, r))))
    return (met if coarse else met.where(F.element_at(F.array_intersect(laid(l), laid(r)), 1) == F.col(cell))).drop(cell)


def _box_far(parts: Sequence[tuple[DataFrame, Sequence[str]]]) -> float:
    """Diagonal of the box around all ends of the segments: no two of them are farther apart."""
    ends = [df.select(F.col(c[k]).cast("double").alias("x"), F.col(c[k + 1]).cast("double").alias("z")) for df, c in parts for k in range(0, len(c), 2)]
    every = ends[0]
    for e in ends[1:]:
        every = every.unionByName(e)
    box = every.agg(F.min("x"), F.max("x"), F.min("z"), F.max("z")).first()
    return 0.0 if box[0] is None else float(np.hypot(box[1] - box[0], box[3] - box[2]))


def _between(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """struct<d, x, z>: distance of two segments and the point of the first that has it; for segments that cross the crossing."""
    out = []
    for k in (0, 2):
        out.append(F.struct(geo.point_segment(a[k], a[k + 1], *b).alias("d"), a[k].alias("x"), a[k + 1].alias("z")))
        t = geo.segment_t(b[k], b[k + 1], *a)
        x, z = a[0] + t * (a[2] - a[0]), a[1] + t * (a[3] - a[1])
        out.append(F.struct(geo.distance(b[k], b[k + 1], x, z).alias("d"), x.alias("x"), z.alias("z")))
    p, q = geo.cross(*b, a[0], a[1]), geo.cross(*b, a[2], a[3])
    t = p / F.when(p == q, F.lit(1.0)).otherwise(p - q)
    met = F.struct(F.lit(0.0).alias("d"), (a[0] + t * (a[2] - a[0])).alias("x"), (a[1] + t * (a[3] - a[1])).alias("z"))
    return F.when(geo.segments_cross(list(a), list(b)), met).otherwise(F.least(*out))


def with_distance(df: DataFrame, p: Sequence[str], q: Sequence[str], name: str) -> DataFrame:
    """df with the distance of two segments (names of x1, z1, x2, z2): 0 where they cross, else the least of the four from an end to the other segment.

    Steps are columns of their own, so that no term is generated twice, and swapping p and q changes no bit of the result.
    """
    step = free_names([*df.columns, name], *(f"__{x}{k}" for x in ("dx", "dz", "n") for k in "pq"), *(f"__t{k}" for k in range(4)))
    dx, dz, n, t = step[0:2], step[2:4], step[4:6], step[6:]
    c = F.col
    for k, s in enumerate((p, q)):
        df = df.withColumns({dx[k]: c(s[2]) - c(s[0]), dz[k]: c(s[3]) - c(s[1])})
    df = df.withColumns({n[k]: F.nullif(c(dx[k]) * c(dx[k]) + c(dz[k]) * c(dz[k]), F.lit(0.0)) for k in (0, 1)})
    feet = [(s[e], s[e + 1], o[0], o[1], k) for k, s, o in ((1, p, q), (0, q, p)) for e in (0, 2)]  # an end, and the segment k that it is held against
    df = df.withColumns({t[i]: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(((c(x) - c(ax)) * c(dx[k]) + (c(z) - c(az)) * c(dz[k])) / c(n[k]), F.lit(0.0)))) for i, (x, z, ax, az, k) in enumerate(feet)})
    gaps = [geo.distance(c(x), c(z), c(ax) + c(t[i]) * c(dx[k]), c(az) + c(t[i]) * c(dz[k])) for i, (x, z, ax, az, k) in enumerate(feet)]
    side = lambda i: (c(feet[i][0]) - c(feet[i][2])) * c(dz[feet[i][4]]) - (c(feet[i][1]) - c(feet[i][3])) * c(dx[feet[i][4]])
    crossing = (side(0) * side(1) < 0) & (side(2) * side(3) < 0)
    return df.withColumn(name, F.when(crossing, F.lit(0.0)).otherwise(F.least(*gaps))).drop(*step)


def nearest_segments(left: DataFrame, right: DataFrame, left_id: str, right_id: str, l: Sequence[str], r: Sequence[str], radius: float, on: Sequence[str] = (), same: bool = False) -> DataFrame:
    """(left_id, on, right_id, distance, x, z): for every left id the right id whose segments come nearest to its own, and the point on its own where they do.

    An id may have many segments. Both are laid into cells of the radius, the left ones grown by it; it doubles for ids that have found
    none until it covers both tables. Ties go to the smaller right id; ids without a right segment under their key are left out. Unless
    ``same``, equal ids are one thing and never meet.
    """
    far = _box_far([(left, l), (right, r)])
    hits, rest = [], left
    while True:
        a, b = [F.col(c) for c in l], [F.col(c) for c in r]
        grown = _cells_of_box(F.least(a[0], a[2]) - radius, F.least(a[1], a[3]) - radius, F.greatest(a[0], a[2]) + radius, F.greatest(a[1], a[3]) + radius, radius)
        met = rest.withColumn("__c", F.explode(grown)).join(right.withColumn("__c", F.explode(_cells_of_line(*b, radius))), ["__c", *on])
        met = met if same else met.where(F.col(left_id) != F.col(right_id))
        met = met.withColumn("__m", _between(a, b)).where(F.col("__m.d") <= radius)
        best = met.groupBy(left_id, *on).agg(F.min(F.struct(F.col("__m.d").alias("d"), F.col(right_id).alias("o"), F.col("__m.x").alias("x"), F.col("__m.z").alias("z"))).alias("b"))
        hits.append(checkpointed(best.select(left_id, *on, F.col("b.o").alias(right_id), F.col("b.d").alias("distance"), "b.x", "b.z")))
        if radius > far:
            break
        rest = checkpointed(rest.join(hits[-1].select(left_id, *on), [left_id, *on], "left_anti"))
        if rest.isEmpty():
            break
        radius *= 2
    found = hits[0]
    for hit in hits[1:]:
        found = found.unionByName(hit)
    return found


def nearest_line(points: DataFrame, lines: DataFrame, point_id: str, line_id: str, x: str, z: str, l: Sequence[str], limit: float, on: Sequence[str] = (), keep: Column | None = None) -> DataFrame:
    """(point_id, line_id, dist): for every point the nearest segment within ``limit`` (of the pairs that ``keep`` takes), ties to the smaller line id.

    Lines are laid into the cells they run through. Cells begin at a part of the limit that fits how densely lines lie, and double for points that
    have found none. The least distance is found first, by a hash aggregate, and then the line that has it, so pairs are never sorted.
    """
    scratch = Scratch(points.sparkSession, "line")
    spread = max(points.sparkSession.sparkContext.defaultParallelism, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lines = scratch.save(lines.repartition(spread), "lines")  # laying them into cells is the work: over all tasks
    laid = lambda size: lines.withColumn("__c", F.explode(_cells_of_line(*map(F.col, l), size)))
    held = laid(limit).groupBy("__c", *on).count().agg(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0] or 1.0
    radius = limit / 2 ** max(0, int(np.ceil(np.log2(held / 256))))
    near = geo.point_segment(F.col(x), F.col(z), *map(F.col, l))
    around = F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    hits, rest = [], scratch.save(points, "points")
    while True:
        shift = F.transform(around, lambda c: F.struct((_cell(F.col(x), radius) + c["i"]).alias("i"), (_cell(F.col(z), radius) + c["j"]).alias("j")))  # noqa: B023
        own = laid(radius)
        meet = lambda p: p.withColumn("__c", F.explode(shift)).join(own.hint("merge"), ["__c", *on]).where(F.lit(True) if keep is None else keep).withColumn("dist", near).where(F.col("dist") <= radius)  # noqa: B023, E731
        best = scratch.save(meet(rest).groupBy(point_id).agg(F.min("dist").alias("__least")), f"least-{len(hits)}")
        hit = meet(rest.join(best, point_id)).where(F.col("dist") == F.col("__least")).groupBy(point_id, "dist").agg(F.min(line_id).alias(line_id))
        hits.append(scratch.save(hit.select(point_id, line_id, "dist"), f"hit-{len(hits)}"))
        if radius >= limit:
            return reduce(DataFrame.unionByName, hits)
        rest = scratch.save(rest.join(best, point_id, "left_anti"), f"rest-{len(hits)}")
        radius *= 2


def nearest_ring(points: DataFrame, rings: DataFrame, point_id: str, ring_id: str, x: str, z: str, ring: str, radius: float, on: Sequence[str] = ()) -> DataFrame:
    """points with ``ring_id`` and ``distance`` of the ring that covers them (the smallest id of several, distance 0), else of the nearest one (the smaller id on a tie).

    ring: array<struct<x, z>>. Points that no ring of their key is there for have nulls.
    """
    r = rings.select(ring_id, *on, geo.open_ring(F.col(ring)).alias("__r")).where(F.size("__r") >= 1)
    side = lambda f, c: f(F.transform("__r", lambda p: p[c]))
    r = r.withColumns({f"__{c}{k}": side(f, c) for k, f in ((1, F.array_min), (2, F.array_max)) for c in "xz"})
    laid = r.withColumn("__c", F.explode(_cells_of_box(F.col("__x1"), F.col("__z1"), F.col("__x2"), F.col("__z2"), radius)))
    scratch = Scratch(points.sparkSession, "rings")
    laid = scratch.save(laid.withColumn("__n", F.row_number().over(Window.partitionBy("__c", *on).orderBy(F.asc_nulls_last(ring_id)))), "laid")
    most = laid.agg(F.max("__n")).first()[0] or 0
    p = points.select(point_id, *on, F.col(x).alias("__x"), F.col(z).alias("__z")).where("__x is not null and __z is not null")
    left = p.withColumn("__c", F.struct(_cell(F.col("__x"), radius).alias("i"), _cell(F.col("__z"), radius).alias("j")))
    edge = lambda e: geo.point_segment(F.col("__x"), F.col("__z"), e["a"]["x"], e["a"]["z"], e["b"]["x"], e["b"]["z"])
    boxed = reduce(lambda q, c: q & F.col(f"__{c}").between(F.col(f"__{c}1") - 2 * geo.TINY, F.col(f"__{c}2") + 2 * geo.TINY), "xz", F.lit(True))
    covers = boxed & (geo.point_in_ring(F.col("__x"), F.col("__z"), F.col("__r")) | (F.array_min(F.transform(geo.ring_edges(F.col("__r")), edge)) <= geo.TINY))
    inside, low, high = None, 0, 16
    while True:  # a cell's rings in the order of their ids: a point that one of the first covers needs no other
        met = left.join(laid.where((F.col("__n") > low) & (F.col("__n") <= high)), ["__c", *on]).where(covers)
        hit = scratch.save(met.groupBy(point_id, *on).agg(F.min(ring_id).alias(ring_id)), f"hit-{high}")
        inside = hit if inside is None else inside.unionByName(hit)
        if high >= most:
            break
        left = scratch.save(left.join(hit, [point_id, *on], "left_anti"), f"left-{high}")
        low, high = high, 4 * high
    inside = inside.withColumn("distance", F.lit(0.0))
    lines = r.select(ring_id, *on, F.explode(geo.ring_edges(F.col("__r"))).alias("e")).select(ring_id, *on, *(F.col(f"e.{s}.{c}").alias(f"__{s}{c}") for s in "ab" for c in "xz"))
    lines = lines.withColumnRenamed(ring_id, "__ring")
    rest = p.join(inside.select(point_id, *on), [point_id, *on], "left_anti").withColumnRenamed(point_id, "__point")
    spots = rest.select("__point", *on, F.col("__x").alias("__x1"), F.col("__z").alias("__z1"), F.col("__x").alias("__x2"), F.col("__z").alias("__z2"))
    near = nearest_segments(spots, lines, "__point", "__ring", ["__x1", "__z1", "__x2", "__z2"], ["__ax", "__az", "__bx", "__bz"], radius, on, same=True)
    near = near.select(F.col("__point").alias(point_id), *on, F.col("__ring").alias(ring_id), "distance")
    return points.join(inside.unionByName(near), [point_id, *on], "left")


def raster_cells(df: DataFrame, x1: str, z1: str, x2: str, z2: str, size: float, least: float = 0.02) -> DataFrame:
    """Cells covered by at least the share ``least`` of their area, with the covered area. Boxes must have x1 <= x2 and z1 <= z2."""
    out = df.withColumn("__c", F.explode(_cells_of_box(F.col(x1), F.col(z1), F.col(x2), F.col(z2), size))).withColumns({"cx": F.col("__c.i"), "cz": F.col("__c.j")}).drop("__c")
    side = lambda a, b, c: F.greatest(F.lit(0.0), F.least(F.col(b), (F.col(c) + 1) * size) - F.greatest(F.col(a), F.col(c) * size))
    return out.withColumn("covered", side(x1, x2, "cx") * side(z1, z2, "cz")).where(F.col("covered") >= least * size * size)


def raster_union(df: DataFrame, keys: Sequence[str], x1: str, z1: str, x2: str, z2: str, size: float) -> DataFrame:
    """Cells of the union by key. Set algebra on cells replaces polygon overlay: exact up to one cell at borders."""
    return raster_cells(df, x1, z1, x2, z2, size).select(*keys, "cx", "cz").distinct()


def buffer_cells(df: DataFrame, x1: str, z1: str, x2: str, z2: str, radius: float, size: float) -> DataFrame:
    """Cells whose centre is within radius of the segment."""
    lo = [F.least(F.col(a), F.col(b)) - radius for a, b in ((x1, x2), (z1, z2))]
    hi = [F.greatest(F.col(a), F.col(b)) + radius for a, b in ((x1, x2), (z1, z2))]
    out = df.withColumn("__c", F.explode(_cells_of_box(lo[0], lo[1], hi[0], hi[1], size))).withColumns({"cx": F.col("__c.i"), "cz": F.col("__c.j")}).drop("__c")
    centre = [(F.col(c) + 0.5) * size for c in ("cx", "cz")]
    return out.where(geo.point_segment(*centre, F.col(x1), F.col(z1), F.col(x2), F.col(z2)) <= radius)


def _per_group(fn, keys: Sequence[str], df: DataFrame, schema: str) -> DataFrame:
    return df.groupBy(*keys).applyInPandas(fn, schema)


def greedy_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, z: str, gap: float) -> DataFrame:
    """In order, a row stays if no row that stayed is within gap. Sequential inside a key, so a key must be a bounded group (the rooms of one building)."""

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order))
        cells: dict[tuple[int, int], list[tuple[float, float]]] = {}
        stay = []
        for px, pz in zip(pdf[x].to_numpy(), pdf[z].to_numpy(), strict=True):
            i, j = int(np.floor(px / gap)), int(np.floor(pz / gap))
            near = any(np.hypot(px - qx, pz - qz) <= gap for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1) for qx, qz in cells.get((a, b), ()))
            stay.append(not near)
            if not near:
                cells.setdefault((i, j), []).append((px, pz))
        return pdf[stay]

    return _per_group(keep, keys, df, df.schema)


def leader_cluster(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, z: str, radius: float) -> DataFrame:
    """In order, a row joins the first cluster whose moving centroid is within radius, else it founds one. Adds ``cluster``."""

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order))
        sums: list[list[float]] = []
        out = []
        for px, pz in zip(pdf[x].to_numpy(), pdf[z].to_numpy(), strict=True):
            for k, (sx, sz, n) in enumerate(sums):
                if np.hypot(px - sx / n, pz - sz / n) <= radius:
                    sums[k] = [sx + px, sz + pz, n + 1]
                    break
            else:
                k = len(sums)
                sums.append([px, pz, 1])
            out.append(k)
        return pdf.assign(cluster=np.array(out, np.int64))

    return _per_group(assign, keys, df, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", cluster long")
