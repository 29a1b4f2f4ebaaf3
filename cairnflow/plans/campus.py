"""Sampled walking routes to one campus road graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import graph, mesh
from ..operators import relational as rel
from ..sources.config import CampusConfig

#: Which class an edge keeps where classes overlap.
PRIORITY = {"underpass": 5, "residential": 4, "service": 3, "footway": 2, "path": 1, "steps": 1, "connector": 0}


def outdoor_segments(points: DataFrame) -> DataFrame:
    """(ord, lon1, lat1, lon2, lat2, class): outdoor steps on the ground, indoor stretches inside a route bridged by one connector."""
    flat = points.where("zlevel = 0").withColumn("step", F.concat_ws(":", "l", "s"))
    g = rel.gap_stitch(flat, ["route_id", "r"], ["l", "s", "p"], "step", "highway", "lon", "lat", F.col("abutters").contains("Inside"))
    g = g.select("route_id", "r", "l", "s", "p", F.col("x1").alias("lon1"), F.col("z1").alias("lat1"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), "class")
    return rel.global_row_number(g, ["route_id", "r", "l", "s", "p"], "ord").drop("route_id", "r", "l", "s", "p")


def extra_segments(lines: DataFrame, first: int) -> DataFrame:
    """Hand-made polylines (line, at, lon, lat, class) as segments, numbered after the sampled ones."""
    from pyspark.sql import Window

    w = Window.partitionBy("line").orderBy("at")
    s = lines.select(F.col("lon").alias("lon1"), F.col("lat").alias("lat1"), F.lead("lon").over(w).alias("lon2"), F.lead("lat").over(w).alias("lat2"), "class", "line", "at").where("lon2 is not null")
    return rel.global_row_number(s, ["line", "at"], "o").select("lon1", "lat1", "lon2", "lat2", "class", (F.col("o") + first).alias("ord"))


def placed_lines(lines: DataFrame, cfg: CampusConfig) -> DataFrame:
    """Hand-made polylines in placement coordinates (line, at, x, z, class) as (line, at, lon, lat, class) for ``extra_segments``; a missing class is an underpass."""
    lon, lat = geo.from_campus(F.col("x").cast("double"), F.col("z").cast("double"), cfg.reference)
    klass = F.coalesce(F.nullif(F.trim("class"), F.lit("")), F.lit("underpass"))
    return lines.where("x is not null and z is not null").select("line", "at", lon.alias("lon"), lat.alias("lat"), klass.alias("class"))


def road_graph(segments: DataFrame, cfg: CampusConfig) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): snapped, short dead ends pruned, islands bridged into one component."""
    x1, z1 = geo.to_campus(F.col("lon1"), F.col("lat1"), cfg.reference)
    x2, z2 = geo.to_campus(F.col("lon2"), F.col("lat2"), cfg.reference)
    placed = segments.select("ord", x1.alias("x1"), z1.alias("z1"), x2.alias("x2"), z2.alias("z2"), "class")
    prio = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for kv in PRIORITY.items() for v in kv)), F.col("class")), F.lit(0))
    nodes, edges = graph.snap_network(placed, cfg.snap_m * cfg.reference.scale, "ord", prio)
    at = lambda k: nodes.select(F.col("id").alias(k), F.col("x").alias(f"x_{k}"), F.col("z").alias(f"z_{k}"))
    full = edges.join(at("a"), "a").join(at("b"), "b")
    full = full.withColumn("length", geo.distance(*map(F.col, ("x_a", "z_a", "x_b", "z_b"))))
    kept = graph.prune_fixpoint(full.select("a", "b", "class", "length"), F.col("length") < cfg.min_stub_m * cfg.reference.scale)
    used = kept.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    nodes = nodes.join(used, "id").withColumn("graph", F.lit(cfg.graph_id))
    bridges = graph.bridge_islands(nodes, kept.select(F.lit(cfg.graph_id).alias("graph"), "a", "b"), "graph")
    return nodes, kept.unionByName(bridges.select("a", "b", F.lit("spur").alias("class"), "length"))


def spurs(nodes: DataFrame, doors: DataFrame, cfg: CampusConfig) -> DataFrame:
    """Entrances (door, x, z) tied to the graph within the cap, in the order of their ids."""
    return graph.entrance_spurs(nodes.select("graph", "id", "x", "z"), doors.withColumn("graph", F.lit(cfg.graph_id)), "graph", ["door"], cfg.spur_max_m * cfg.reference.scale)


def published_entrances(placed: DataFrame, entries: DataFrame, extras: DataFrame, gap: float = 2.0) -> DataFrame:
    """Entrances of the campus (building, ordinal, source, x, z, is_primary) from placements, entry files and hand-made extras, each (building, at, x, z).

    They count in that order, inside a source by ``at``; one within ``gap`` of another of its building that came before goes. The first of a building is its primary.
    """
    from pyspark.sql import Window

    from ..operators import spatial

    parts = [df.select("building", F.lit(n).alias("rank"), F.lit(name).alias("source"), "at", F.col("x").cast("double").alias("x"), F.col("z").cast("double").alias("z")) for n, (name, df) in enumerate((("placement", placed), ("entry", entries), ("extra", extras)))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("x is not null and z is not null")
    kept = spatial.greedy_distinct(every, ["building"], ["rank", "at"], "x", "z", gap)
    ordinal = F.row_number().over(Window.partitionBy("building").orderBy("rank", "at")) - 1
    return kept.withColumn("ordinal", ordinal).select("building", "ordinal", "source", "x", "z", (F.col("ordinal") == 0).alias("is_primary"))


def door_pairs(entrances: DataFrame) -> DataFrame:
    """(a, b, route_id) of all pairs of buildings by their primary entrances, each once: one row per building meets, never all doors."""
    one = entrances.where("is_primary").select("building", "x", "z")
    left = one.select(F.col("building").alias("a"), F.col("x").alias("ax"), F.col("z").alias("az"))
    right = one.select(F.col("building").alias("b"), F.col("x").alias("bx"), F.col("z").alias("bz"))
    return left.join(right, F.col("a") < F.col("b")).withColumn("route_id", F.concat_ws("__", "a", "b"))


def pair_polylines(pairs: DataFrame, points: DataFrame, cfg: CampusConfig) -> DataFrame:
    """(a, b, line): one simplified polyline for each pair with a route. Pairs without one are left out; raises if there are pairs and none has one."""
    out = pairs.select("a", "b", "route_id").join(polylines(points, cfg), "route_id").select("a", "b", "line")
    if out.isEmpty() and not pairs.isEmpty():
        raise ValueError("no pair of buildings has a route")
    return out


def probe(nodes: DataFrame, edges: DataFrame, entrances: DataFrame, cap: float, most: float = 3.0, strict: dict[tuple[str, str], float] | None = None) -> DataFrame:
    """(a, b, check, value): what a navigation test of the road graph finds wrong, empty if nothing.

    nodes: id, x, z; edges: a, b, length; entrances: building, x, z, is_primary. ``snap`` (a and b the same building): no node within
    ``cap`` of its primary entrance, value the distance. ``path``: no way between the nodes of two buildings. ``detour``: the way, with
    both snaps, is over ``most`` times the straight line, or over the limit that ``strict`` sets for the pair (ids in order).
    """
    from ..operators import spatial

    one = entrances.where("is_primary").select("building", "x", "z")
    right = nodes.select(F.col("id").alias("node"), F.col("x").alias("nx"), F.col("z").alias("nz"))
    near = rel.checkpointed(spatial.nearest_one(one, right, "building", "node", "x", "z", "nx", "nz", cap))
    check = lambda df, b, name, value: df.select(F.col("a").cast("string").alias("a"), F.col(b).cast("string").alias("b"), F.lit(name).alias("check"), value.alias("value"))
    snap = check(near.where(F.col("distance").isNull() | (F.col("distance") > cap)).withColumnRenamed("building", "a"), "a", "snap", F.col("distance"))
    good = near.where(F.col("distance") <= cap)
    way = graph.distances(good.select(F.col("node").alias("id")).distinct(), edges)
    side = lambda s: good.select(F.col("building").alias(s), F.col("x").alias(f"x_{s}"), F.col("z").alias(f"z_{s}"), F.col("node").alias(f"n_{s}"), F.col("distance").alias(f"s_{s}"))
    pairs = side("a").join(side("b"), F.col("a") < F.col("b"))
    pairs = pairs.join(way.select(F.col("source").alias("n_a"), F.col("node").alias("n_b"), "distance"), ["n_a", "n_b"], "left")
    straight = geo.distance(*map(F.col, ("x_a", "z_a", "x_b", "z_b")))
    ratio = (F.col("distance") + F.col("s_a") + F.col("s_b")) / F.when(straight > geo.TINY, straight)
    limit = F.lit(most)
    for (p, q), value in (strict or {}).items():
        limit = F.when((F.col("a") == p) & (F.col("b") == q), F.lit(value)).otherwise(limit)
    lost = check(pairs.where("distance is null"), "b", "path", F.lit(None).cast("double"))
    return snap.unionByName(lost).unionByName(check(pairs.withColumns({"ratio": ratio, "limit": limit}).where("ratio > limit"), "b", "detour", F.col("ratio")))


def polylines(points: DataFrame, cfg: CampusConfig) -> DataFrame:
    """(route_id, line): one simplified polyline per route; indoor steps keep their ends only, repeated points go."""
    from pyspark.sql import Window

    step = Window.partitionBy("route_id", "r", "l", "s")
    ends = points.withColumns({"lo": F.min("p").over(step), "hi": F.max("p").over(step)})
    ends = ends.where(~F.col("abutters").contains("Inside") | (F.col("p") == F.col("lo")) | (F.col("p") == F.col("hi")))
    order = ["r", "l", "s", "p"]
    new = rel.changed("lon", ["route_id"], order) | rel.changed("lat", ["route_id"], order)
    x, z = geo.to_campus(F.col("lon"), F.col("lat"), cfg.reference)
    kept = ends.withColumn("new", new).where("new").withColumns({"x": x, "z": z})
    line = F.array_sort(F.collect_list(F.struct(*order, "x", "z")))
    g = kept.groupBy("route_id").agg(F.transform(line, lambda q: F.struct(q["x"].alias("x"), q["z"].alias("z"))).alias("line")).where(F.size("line") >= 2)
    return g.select("route_id", mesh.simplify_udf(cfg.simplify_m * cfg.reference.scale)("line").alias("line"))


def strips(nodes: DataFrame, edges: DataFrame, cfg: CampusConfig) -> DataFrame:
    """Road surface: one quad per edge, as wide as its class."""
    at = lambda k: nodes.select(F.col("id").alias(k), F.col("x").alias(f"x_{k}"), F.col("z").alias(f"z_{k}"))
    e = edges.join(at("a"), "a").join(at("b"), "b")
    out = None
    for klass in {*PRIORITY, "spur"}:
        q = mesh.strip_quad(*map(F.col, ("x_a", "z_a", "x_b", "z_b")), cfg.widths_m.get(klass, 2.0) * cfg.reference.scale / 2)
        part = e.where(F.col("class") == klass).select("a", "b", "class", q.alias("quad"))
        out = part if out is None else out.unionByName(part)
    return out.where("quad is not null")
