"""Locations of a building to floors, rooms, portals, links and a manifest document. Lazy tables throughout; documents only at the sink."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import floors, geo, text
from ..operators import relational as rel

UNLINKABLE = ("", "DEFAULT", "MAIN")


@dataclass
class Dataset:
    """A bundle of tables keyed by building; never one nested row."""

    floors: DataFrame
    rooms: DataFrame
    portals: DataFrame
    issues: DataFrame


def normalise(found: DataFrame, rejects: DataFrame, building: str, building_id: str) -> Dataset:
    """Typed locations to a dataset: floors get a dense index, portals are told from rooms by type and id."""
    names = found.select("floor_name").distinct()
    index = rel.dense_index(names, [], [floors.base_sort_key(F.col("floor_name")), "floor_name"], "floor_index")
    rows = found.join(index, "floor_name").withColumn("kind", text.portal_kind(F.col("location_type"), F.col("external_id")))
    rows = rows.withColumn("building", F.lit(building))
    rooms = rows.where("kind = ''").drop("kind").withColumns({
        "category": text.keyword_category(F.concat_ws(" ", "display_name", "type")),
        "aliases": text.aliases(F.col("external_id"), F.lit(building_id)),
        "node_name": text.room_node_name(F.col("external_id"), F.col("display_name"), fold=True),
    })
    portals = rows.where("kind <> ''").withColumn("group_id", text.portal_group_id(F.col("external_id"), F.col("display_name"), F.col("kind")))
    portals = portals.withColumn("node_name", text.portal_node_name(F.col("external_id"), F.col("display_name"), F.col("kind"), F.col("group_id"), fold=True))
    issues = rejects.select(F.lit("warning").alias("severity"), F.col("reason").alias("code"), F.coalesce("id", F.lit("<unknown>")).alias("subject"))
    return Dataset(index.withColumn("building", F.lit(building)), rooms, portals, issues)


def project(ds: Dataset, lon: float, lat: float, heights: Column | None = None) -> Dataset:
    """Adds local metres (x, y, z) and rings; the height of a floor is ``heights`` over floor_name, else index * 4.2."""
    height = F.coalesce(heights, F.col("floor_index") * 4.2) if heights is not None else F.col("floor_index") * 4.2

    def local(df: DataFrame) -> DataFrame:
        x, z = geo.to_local(F.col("lon"), F.col("lat"), lon, lat)
        point = lambda p: dict(zip("xz", geo.to_local(p["lon"], p["lat"], lon, lat), strict=True))
        ring = F.transform("ring", lambda p: F.struct(point(p)["x"].alias("x"), height.alias("y"), point(p)["z"].alias("z")))
        return df.withColumns({"x": x, "y": height, "z": z, "ring_local": ring})

    return Dataset(ds.floors.withColumn("height", height), local(ds.rooms), local(ds.portals), ds.issues)


def vertical_links(portals: DataFrame) -> DataFrame:
    """Every shaft (kind, group, building prefix) linked floor to floor; placeholder groups are left out."""
    p = portals.where(F.col("kind").isin("stair", "elevator") & ~F.upper(F.trim("group_id")).isin(*UNLINKABLE))
    return rel.chain_links(p, ["kind", "group_id", "building"], "floor_index", ["external_id", "source_id"], ["external_id", "source_id", "node_name"])


def write_dataset(ds: Dataset, path: str) -> None:
    """Each table of the dataset as Parquet below path; rooms and portals by floor, so that one floor reads its own files alone."""
    for name in ("floors", "rooms", "portals", "issues"):
        w = getattr(ds, name).write.mode("overwrite")
        (w.partitionBy("floor_index") if name in ("rooms", "portals") else w).parquet(f"{path}/{name}")


def read_dataset(spark: SparkSession, path: str) -> Dataset:
    """The dataset that ``write_dataset`` wrote; an error if a table is missing."""
    return Dataset(*(spark.read.parquet(f"{path}/{name}") for name in ("floors", "rooms", "portals", "issues")))


def issues(ds: Dataset) -> DataFrame:
    """Rule violations: missing anchors are errors, a building without rooms and placeholder groups are warnings."""
    row = lambda df, severity, code, subject: df.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col(subject).alias("subject"))
    both = ds.rooms.select("external_id", "lon", "lat").unionByName(ds.portals.select("external_id", "lon", "lat"))
    out = ds.issues.unionByName(row(both.where("lon is null or lat is null"), "error", "missing anchor", "external_id"))
    shafts = ds.portals.where(F.col("kind").isin("stair", "elevator") & F.upper("group_id").isin(*UNLINKABLE))
    out = out.unionByName(row(shafts, "warning", "no shaft group", "external_id"))
    n = ds.rooms.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return out.unionByName(n.select(F.lit("warning").alias("severity"), F.lit("no rooms").alias("code"), F.lit("").alias("subject")))


def manifest(ds: Dataset, building_id: str, name: str) -> DataFrame:
    """One JSON document per building, from the tables."""
    listed = lambda df, alias, order, cols: df.groupBy("building").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*cols).alias("__doc")))), lambda r: r["__doc"]).alias(alias))
    anchor = F.when(F.col("lon").isNotNull(), F.array("x", "y", "z")).alias("anchor")
    rooms = listed(ds.rooms, "rooms", ["floor_index", "external_id", "source_id"], ["external_id", "display_name", "floor_index", "floor_name", "node_name", anchor, "aliases", "category", "source_id"])
    portals = listed(ds.portals, "portals", ["floor_index", "external_id", "source_id"], ["external_id", "display_name", "floor_index", "floor_name", "kind", "group_id", "node_name", anchor, "source_id"])
    flr = listed(ds.floors, "floors", ["floor_index"], ["floor_name", "floor_index", "height"])
    links = listed(vertical_links(ds.portals), "links", ["kind", "group_id", "from_floor_index"], ["kind", "group_id", "from_external_id", "to_external_id", "from_floor_index", "to_floor_index"])
    doc = flr.join(rooms, "building", "left").join(portals, "building", "left").join(links, "building", "left")
    head = F.struct(F.lit(building_id).alias("id"), F.col("building").alias("admin_id"), F.lit(name).alias("display_name"))
    body = F.struct(F.lit(1).alias("schema_version"), head.alias("building"), "floors", "rooms", "portals", F.struct("links").alias("nav"))
    out = doc.select("building", F.to_json(body).alias("document"))
    return out.withColumn("hash", F.sha2("document", 256))
