"""Doors: from routes to room doors, building entries, wall openings and the placement of a building on the campus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import floors, geo, text
from ..operators import relational as rel
from ..operators import spatial

INSIDE = "InsideBuilding"
ORDER = ("r", "l", "s", "p")


# --- evidence from routes ---


def last_floor_run(points: DataFrame, level: Column, key: str = "route_id") -> DataFrame:
    """Points of the last stretch on the wanted level that has two points or more; the trailing stretch wins."""
    w = [key]
    on = points.withColumn("on", F.abs(F.col("zlevel") - level) <= 0.001)
    runs = rel.islands(on, w, ORDER, rel.changed("on", w, ORDER)).where("on")
    run = [key, "island"]
    runs = runs.withColumn("new", rel.changed("lon", run, ORDER) | rel.changed("lat", run, ORDER)).where("new").drop("new", "on")
    size = runs.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").groupBy(key).agg(F.max("island").alias("island"))
    return runs.join(size, run).drop("island")


def room_doors(lines: DataFrame, rooms: DataFrame, key: str = "route_id") -> DataFrame:
    """(key, lon, lat, source, confidence) of the door that a route to a room shows.

    lines: key, at, lon, lat. rooms: key, ring (array of struct<lon, lat>). The
    crossing of the boundary farthest along the route, else the route's end on
    the boundary, else the nearest boundary point: medium if the end is inside.
    """
    w = Window.partitionBy(key).orderBy("at")
    seg = lines.select(key, "at", F.col("lon").alias("x1"), F.col("lat").alias("z1"), F.lead("lon").over(w).alias("x2"), F.lead("lat").over(w).alias("z2"))
    xz = F.transform("ring", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("z")))
    edges = rooms.select(key, F.explode(geo.ring_edges(geo.open_ring(xz))).alias("e"))
    j = seg.where("x2 is not null").join(edges, key)
    dx, dz = F.col("x2") - F.col("x1"), F.col("z2") - F.col("z1")
    ex, ez = F.col("e.b.x") - F.col("e.a.x"), F.col("e.b.z") - F.col("e.a.z")
    px, pz = F.col("e.a.x") - F.col("x1"), F.col("e.a.z") - F.col("z1")
    det = F.nullif(dx * ez - dz * ex, F.lit(0.0))
    hit = j.withColumns({"t": (px * ez - pz * ex) / det, "u": (px * dz - pz * dx) / det}).where(F.col("t").between(0, 1) & F.col("u").between(0, 1))
    far = hit.groupBy(key).agg(F.max_by(F.struct((F.col("x1") + F.col("t") * dx).alias("lon"), (F.col("z1") + F.col("t") * dz).alias("lat")), F.struct("at", "t")).alias("c"))
    end = lines.groupBy(key).agg(F.max_by(F.struct("lon", "lat"), "at").alias("end"))
    near = edges.join(end, key)
    t = geo.segment_t(F.col("end.lon"), F.col("end.lat"), F.col("e.a.x"), F.col("e.a.z"), F.col("e.b.x"), F.col("e.b.z"))
    at = F.struct((F.col("e.a.x") + t * ex).alias("lon"), (F.col("e.a.z") + t * ez).alias("lat"))
    near = near.withColumn("n", at).withColumn("d", geo.distance(F.col("n.lon"), F.col("n.lat"), F.col("end.lon"), F.col("end.lat")))
    near = near.groupBy(key).agg(F.min_by("n", F.struct("d", "e.at")).alias("n"), F.min("d").alias("d"))
    inside = rooms.join(end, key).select(key, geo.point_in_ring(F.col("end.lon"), F.col("end.lat"), geo.open_ring(xz)).alias("inside"))
    out = near.join(far, key, "left").join(inside, key)
    on = F.col("d") < 0.000003
    crossed = F.col("c").isNotNull()
    place = F.coalesce("c", "n")
    source = F.when(crossed, "route_boundary_intersection").when(on, "route_endpoint_on_boundary").otherwise("nearest_boundary_to_route_endpoint")
    return out.select(key, place["lon"].alias("lon"), place["lat"].alias("lat"), source.alias("source"), F.when(crossed | on, "high").when(F.col("inside"), "medium").otherwise("low").alias("confidence"))


def best_attempt(attempts: DataFrame, room: str = "room") -> DataFrame:
    """One row per room of its attempts (ord, source, confidence): the first exact crossing, else the best confidence, the earliest on a tie."""
    exact = F.col("source") == "route_boundary_intersection"
    return rel.first_by(attempts, [room], [exact.desc(), F.when(exact, F.lit(0)).otherwise(-text.rank_map(F.col("confidence"), text.CONFIDENCE)), "ord"])


def entries(points: DataFrame, key: str = "route_id") -> DataFrame:
    """Where each route goes inside for good: its last change from outside to inside, only if it ends inside.

    The step's first point is the place. Steps without abutters change the state before but not the end.
    """
    steps = rel.first_by(points, [key, "r", "l", "s"], ["p"])
    w = Window.partitionBy(key, "r").orderBy("l", "s")
    before = F.lag("abutters").over(w)
    steps = steps.withColumn("enters", (F.col("abutters") == INSIDE) & (F.coalesce(before, F.lit("")) != "") & (before != INSIDE))
    at = F.struct("l", "s")
    g = steps.groupBy(key, "r").agg(F.max_by("abutters", F.when(F.col("abutters") != "", at)).alias("ends"), F.max_by(F.struct("lon", "lat", "zlevel", "floor_name"), F.when(F.col("enters"), at)).alias("e"))
    return g.where((F.col("ends") == INSIDE) & F.col("e").isNotNull()).select(key, "r", "e.*")


def cluster_entries(observations: DataFrame, prefix: str, key: str = "building", radius: float = 1.2) -> DataFrame:
    """Entries per building from observations (key, ord, x, z, lon, lat, floor_name, target): leader clusters, best supported first."""
    c = spatial.leader_cluster(observations, [key], ["ord"], "x", "z", radius)
    g = c.groupBy(key, "cluster").agg(
        F.count(F.lit(1)).alias("supporting_routes"), *(F.avg(v).alias(v) for v in ("x", "z", "lon", "lat")),
        F.slice(F.array_sort(F.collect_set(F.nullif("target", F.lit("")))), 1, 25).alias("targets"),
    )
    g = g.join(rel.mode_by(c, [key, "cluster"], "floor_name").drop("n"), [key, "cluster"], "left")
    g = rel.dense_index(g, [key], [F.desc("supporting_routes"), "x", "cluster"], "n")
    entry = F.concat(F.lit(f"{prefix}_entry_"), F.lpad((F.col("n") + 1).cast("string"), 3, "0"))
    return g.select(key, entry.alias("entry_id"), "x", "z", "lon", "lat", floors.canonical_entry(F.col("floor_name")).alias("floor_name"), "supporting_routes", F.when(F.col("supporting_routes") >= 2, "high").otherwise("medium").alias("confidence"), "targets")


# --- merged doors of a building ---


def merge_doors(sources: list[DataFrame], rooms: DataFrame, key: str = "building", gap: float = 3.0, reach: float = 60.0) -> DataFrame:
    """Doors of several sources in priority order: near doubles go, then doors far from the box around the rooms."""
    all_ = None
    for n, s in enumerate(sources):
        s = s.withColumn("src", F.lit(n))
        all_ = s if all_ is None else all_.unionByName(s, allowMissingColumns=True)
    kept = spatial.greedy_distinct(all_.where("x is not null and z is not null"), [key], ["src", "ord"], "x", "z", gap)
    box = rooms.groupBy(key).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("z").alias("z0"), F.max("z").alias("z1"))
    near = geo.bbox_distance(*map(F.col, ("x", "z", "x0", "z0", "x1", "z1"))) <= reach
    return kept.join(box, key, "left").where(F.col("x0").isNull() | near).drop("x0", "x1", "z0", "z1")


def normalise_doors(doors: DataFrame, floor_table: DataFrame, group: str, order: list[str], key: str = "building") -> DataFrame:
    """Numbered doors on a floor of the building: their own by name, else the lowest above ground, else the lowest."""
    index = floor_table.select(key, F.upper("floor_name").alias("f"), "floor_index")
    low = floor_table.groupBy(key).agg(F.min(F.when(~floors.is_basement(F.col("floor_name")), F.struct("floor_index", "floor_name"))).alias("ground"), F.min(F.struct("floor_index", "floor_name")).alias("any"))
    d = doors.withColumn("f", floors.canonical(F.col("floor_name"))).join(index, [key, "f"], "left").join(low, key)
    other = F.coalesce("ground", "any")
    d = d.withColumns({"floor_name": F.when(F.col("floor_index").isNotNull(), F.col("f")).otherwise(floors.canonical(other["floor_name"])), "floor_index": F.coalesce("floor_index", other["floor_index"])})
    d = d.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    name = F.when(F.col("n") == 1, "MainDoor").otherwise(F.concat(F.lit("Door"), F.col("n").cast("string")))
    label = F.when(F.col("n") == 1, "Main entrance").otherwise(F.concat(F.lit("Entry "), F.col("n").cast("string")))
    return d.withColumns({"entry_id": F.concat(F.lit(f"{group}_entry_"), F.lpad(F.col("n").cast("string"), 3, "0")), "node_name": name, "display_name": label}).drop("f", "ground", "any", "n")


def wall_openings(rooms: DataFrame, doors: DataFrame, tolerance: float = 0.75, longest: float = 4.0) -> DataFrame:
    """(floor_name, edge key) of the wall edges that doors open.

    rooms: source_id, external_id, floor_name, ring_local. doors: source_id,
    external_id, x, z, confidence, source. A trusted door opens the nearest edge
    of at most ``longest``; a room left shut opens the nearest edge of any of
    its doors, trusted ones first.
    """
    ids = rooms.where(F.size("ring_local") >= 3).select(F.col("source_id").alias("rs"), F.col("external_id").alias("re"), F.struct(F.col("source_id").alias("room"), "floor_name", "ring_local").alias("m"))
    d = rel.priority_join(doors.withColumn("door", F.monotonically_increasing_id()), ids.select("rs", "re", "m"), [("source_id", "rs"), ("external_id", "re")], ["m"]).where("m is not null")
    xz = F.transform(F.col("m.ring_local"), lambda p: F.struct(p["x"].alias("x"), p["z"].alias("z")))
    e = d.select("door", "x", "z", "m.room", F.col("m.floor_name").alias("floor_name"), ((F.lower("confidence") == "high") & (F.col("source") == "route_boundary_intersection")).alias("sure"), F.explode(geo.ring_edges(geo.open_ring(xz))).alias("e"))
    ends = [F.col(f"e.{p}.{c}") for p in "ab" for c in "xz"]
    e = e.withColumns({"len": geo.distance(*ends), "dist": geo.point_segment(F.col("x"), F.col("z"), *ends), "edge": geo.edge_key(*ends)}).where((F.col("len") > 0.001) & (F.col("dist") <= tolerance))
    first = rel.first_by(e.where(F.col("sure") & (F.col("len") <= longest)), ["door"], ["dist", "e.at"]).select("room", "floor_name", "edge")
    every = rooms.where(F.size("ring_local") >= 3).select(F.col("source_id").alias("room"), "floor_name", F.explode(geo.ring_edges(geo.open_ring(F.transform("ring_local", lambda p: F.struct(p["x"].alias("x"), p["z"].alias("z")))))).alias("e"))
    every = every.select("room", "floor_name", geo.edge_key(*ends).alias("edge"))
    open_rooms = every.join(first.select("floor_name", "edge").distinct(), ["floor_name", "edge"], "left_semi").select("room").distinct()
    rest = e.join(open_rooms, "room", "left_anti")
    second = rel.first_by(rest, ["room"], [F.desc("sure"), "dist", "len", "e.at"]).select("room", "floor_name", "edge")
    return first.unionByName(second).select("floor_name", "edge").distinct()


# --- placement ---


def relocate(doors: DataFrame, surface: DataFrame, key: str = "building", longest: float = 30.0, start: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(doors with their anchor on the walkable surface, diagnostics) from doors (key, floor_name, door, x, z) and surface points (key, floor_name, point, x, z).

    An anchor moves to the nearest surface point of its floor. Diagnostics say for every door how far that is and ``ok``, ``too_far`` or
    ``no_surface``; doors that are not ok are dropped, and if there are doors and none is, that is an error.
    """
    right = surface.select(key, "floor_name", F.col("point").alias("point"), F.col("x").alias("sx"), F.col("z").alias("sz"))
    near = spatial.nearest_one(doors, right, "door", "point", "x", "z", "sx", "sz", start, [key, "floor_name"])
    status = F.when(F.col("distance").isNull(), "no_surface").when(F.col("distance") > longest, "too_far").otherwise("ok")
    judged = rel.checkpointed(near.withColumn("status", status))
    diagnostics = judged.select(key, "floor_name", "door", "point", "distance", "status")
    moved = judged.where("status = 'ok'").drop("x", "z").withColumnsRenamed({"sx": "x", "sz": "z"}).select(*doors.columns)
    if moved.isEmpty() and not doors.isEmpty():
        raise ValueError("no door anchor reaches the walkable surface: " + "; ".join(f"{r.door} {r.status}" for r in diagnostics.orderBy("door").limit(20).collect()))
    return moved, diagnostics


def placement_door(doors: DataFrame, key: str = "building", entry_id: str | None = None) -> DataFrame:
    """One door per building: the named one (an error if no door has that name), else by confidence, support, being the main one, and order."""
    valid = doors.where("x is not null and z is not null and lon is not null and lat is not null")
    if entry_id:
        return rel.nonempty(rel.first_by(valid.where((F.col("entry_id") == entry_id) | (F.col("node_name") == entry_id)), [key], ["ord"]), f"no external door matches {entry_id}")
    name = F.lower(F.concat_ws(" ", F.coalesce("node_name", F.lit("")), F.coalesce("display_name", F.lit(""))))
    main = F.regexp_replace(name, " ", "").contains("maindoor") | name.contains("main entrance")
    rank = text.rank_map(F.lower(F.trim("confidence")), text.CONFIDENCE)
    return rel.first_by(valid, [key], [rank.desc(), F.coalesce("supporting_routes", F.lit(0)).desc(), main.desc(), "ord"])


def placement(doors: DataFrame, ref: geo.Reference, key: str = "building") -> DataFrame:
    """(key, origin_x, origin_z, scale): where a building's local origin lies on the campus, from its placement door."""
    cx, cz = geo.to_campus(F.col("lon"), F.col("lat"), ref)
    return doors.select(key, "entry_id", (cx - F.col("x") * ref.scale).alias("origin_x"), (cz + F.col("z") * ref.scale).alias("origin_z"), F.lit(ref.scale).alias("scale"))


def transforms(doors: DataFrame, ref: geo.Reference, key: str = "building", height: float = 0.0, overrides: dict[str, tuple[float, float, float]] | None = None) -> DataFrame:
    """(key, entry_id, basis, origin): the transform of every building from its placement door (lon, lat, x, y, z).

    basis: three rows of the scale, z mirrored; origin: (x, y, z) to six decimals, so that the door lies on its place on the campus and
    at ``height``, that of the reference entrance. A building of ``overrides`` gets the origin given there.
    """
    s = round(float(ref.scale), 8)
    row = lambda *v: F.array(*map(F.lit, v))
    basis = F.array(row(s, 0.0, 0.0), row(0.0, s, 0.0), row(0.0, 0.0, -s))
    placed = placement(doors, ref, key).join(doors.select(key, F.coalesce("y", F.lit(0.0)).alias("y")), key)
    origin = F.array(F.col("origin_x"), F.lit(height) - F.col("y") * ref.scale, F.col("origin_z"))
    for name, fixed in (overrides or {}).items():
        origin = F.when(F.col(key) == name, row(*map(float, fixed))).otherwise(origin)
    return placed.select(key, "entry_id", basis.alias("basis"), F.transform(origin, lambda v: F.round(v, 6)).alias("origin"))


def audit(placed: DataFrame, reference: DataFrame, key: str = "building", centre: float = 25.0, size: tuple[float, float] = (0.55, 1.8), entrance: float = 1.0, exempt: tuple[str, ...] = ()) -> DataFrame:
    """(key, check, value) of every exceeded limit: centre offset, size ratio, entrance error. Both sides: key, cx, cz, width, ex, ez."""
    j = placed.alias("p").join(reference.alias("q"), key).where(~F.col(key).isin(*exempt) if exempt else F.lit(True))
    d = lambda a, b: geo.distance(F.col(f"p.{a}"), F.col(f"p.{b}"), F.col(f"q.{a}"), F.col(f"q.{b}"))
    ratio = F.col("p.width") / F.nullif("q.width", F.lit(0.0))
    checks = [("centre offset", d("cx", "cz"), d("cx", "cz") > centre), ("size ratio", ratio, ~ratio.between(*size)), ("entrance error", d("ex", "ez"), d("ex", "ez") > entrance)]
    rows = F.array(*(F.struct(F.lit(n).alias("check"), v.alias("value"), bad.alias("bad")) for n, v, bad in checks))
    return j.select(F.col(key), F.explode(rows).alias("c")).where("c.bad").select(key, "c.check", "c.value")
