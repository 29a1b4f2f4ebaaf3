"""Landed JSON as tables: location features, inventory, route responses.

Input is open JSON: it stays VARIANT until typed, element by element, so one
malformed element never nulls its whole array. File name and position give the
order that first-wins and last-wins rules need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from ..functions import text
from ..operators.relational import first_by

FEATURE_KEYS = ("features", "locations", "data", "results")
INVENTORY_KEYS = ("buildings", "venues", "data", "results")


def get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def read_items(spark: SparkSession, path: str, keys: Sequence[str] = FEATURE_KEYS) -> DataFrame:
    """(file, pos, item VARIANT) of every object in the files' envelopes: a bare list, or the first key that holds a list.

    Files that are no JSON have no items (see ``corrupt_files``).
    """
    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("v"))
    items = F.coalesce(get(F.col("v"), "$", "array<variant>"), *(get(F.col("v"), f"$.{k}", "array<variant>") for k in keys))
    return pages.select("file", F.posexplode(items).alias("pos", "item")).where(F.schema_of_variant("item").startswith("OBJECT"))


def corrupt_files(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("v"))
    return pages.where("v is null").select("file")


def points(v: Column, path: str) -> Column:
    """Array of struct<lon, lat> from a list of coordinate lists; elements that are no points are dropped."""
    raw = F.coalesce(get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    return F.filter(F.transform(raw, lambda p: F.struct(get(p, "$[0]", "double").alias("lon"), get(p, "$[1]", "double").alias("lat"))), lambda p: p["lon"].isNotNull() & p["lat"].isNotNull())


def locations(items: DataFrame, building: str) -> tuple[DataFrame, DataFrame]:
    """(typed locations of one building, rejects with a reason). A feature without a building belongs to every building."""
    i = F.col("item")
    prop = lambda name: get(i, f"$.properties.{name}")
    kind = get(i, "$.geometry.type")
    ring = F.when(kind == "MultiPolygon", points(i, "$.geometry.coordinates[0][0]")).when(kind == "Polygon", points(i, "$.geometry.coordinates[0]")).otherwise(F.array().cast("array<struct<lon:double,lat:double>>"))
    external = F.trim(text.py_or(prop("externalId"), prop("roomId"), prop("external_id"), F.lit("")))
    base = items.select(
        "file", "pos", get(i, "$.id").alias("id"), external.alias("external_id"),
        F.trim(text.py_or(prop("building"), prop("buildingId"), F.lit(building))).alias("building"),
        text.py_or(prop("name"), external).alias("display_name"),
        F.trim(text.py_or(prop("floorName"), prop("floor"), F.lit("0"))).alias("floor_name"),
        prop("floor").alias("source_floor"), F.coalesce(prop("type"), F.lit("")).alias("type"),
        text.py_or(prop("type"), prop("locationType"), F.lit("")).alias("location_type"),
        get(i, "$.properties.anchor.coordinates[0]", "double").alias("lon"), get(i, "$.properties.anchor.coordinates[1]", "double").alias("lat"), ring.alias("ring"),
    ).where(F.col("building") == building)
    reason = F.when(F.size("ring") == 0, "missing polygon geometry").when(F.col("external_id") == "", "missing externalId/roomId")
    flagged = base.withColumns({"reason": reason, "source_id": text.py_or(F.col("id"), F.col("external_id"))})
    return flagged.where("reason is null").drop("reason", "id"), flagged.where("reason is not null").select("file", "pos", "id", "reason")


def venues(items: DataFrame) -> DataFrame:
    """(venue_id, venue_name): rows without id go, the last of equal ids wins."""
    i = F.col("item")
    v = items.select("file", "pos", F.trim(F.coalesce(get(i, "$.id"), F.lit(""))).alias("venue_id"), get(i, "$.venueInfo.name").alias("a"), get(i, "$.name").alias("b")).where("venue_id <> ''")
    v = v.withColumn("venue_name", F.trim(text.py_or(F.col("a"), F.col("b"), F.col("venue_id"))))
    return first_by(v, ["venue_id"], [F.desc("file"), F.desc("pos")]).select("venue_id", "venue_name")


def buildings(items: DataFrame, venue_table: DataFrame) -> DataFrame:
    """Inventory dimension: slug, ids, name, venue, origin (anchor, else centre of the box, else 0), box, floor keys in order."""
    i = F.col("item")
    own = lambda path: F.trim(F.coalesce(get(i, path), F.lit("")))
    box = get(i, "$.geometry.bbox", "array<double>")
    box = F.when(F.size(box) == 4, box)
    anchor = [get(i, f"$.properties.anchor.coordinates[{k}]", "double") for k in (0, 1)]
    anchor = [F.coalesce(get(i, f"$.anchor.coordinates[{k}]", "double"), anchor[k]) for k in (0, 1)]
    middle = [(F.get(box, 0) + F.get(box, 2)) / 2, (F.get(box, 1) + F.get(box, 3)) / 2]
    both = anchor[0].isNotNull() & anchor[1].isNotNull()
    floor_map = get(i, "$.floors", "map<string,variant>")
    keys = F.array_sort(F.transform(F.map_keys(floor_map), lambda k: F.struct(F.coalesce(k.try_cast("int"), F.when(F.upper(k) == "G", 0).otherwise(10_000)).alias("o"), k.alias("k"))))
    b = items.select(
        own("$.administrativeId").alias("admin_id"), own("$.id").alias("building_id"), own("$.externalId").alias("external_id"), own("$.venueId").alias("venue_id"),
        text.py_or(get(i, "$.buildingInfo.name"), get(i, "$.name"), get(i, "$.externalId"), own("$.administrativeId")).alias("display_name"),
        *(F.when(both, anchor[k]).otherwise(F.coalesce(middle[k], F.lit(0.0))).alias(n) for k, n in enumerate(("lon", "lat"))),
        box.alias("bbox"), text.py_or(get(i, "$.defaultFloor"), F.lit("0")).alias("default_floor"), F.coalesce(keys["k"], F.array().cast("array<string>")).alias("floor_keys"),
    ).where("admin_id <> '' and building_id <> ''").withColumn("display_name", F.trim("display_name"))
    b = b.withColumn("slug", text.slug(F.col("admin_id"), F.col("display_name")))
    return b.join(venue_table, "venue_id", "left").withColumn("venue_name", F.coalesce("venue_name", F.lit(""))).orderBy("slug")


def stamp_urls(inventory: DataFrame, sync: Sequence[str], locations_url: str, details_url: str, solution: str, take: int = 1000) -> DataFrame:
    """inventory with ``source_urls``: where its rows came from (the sync endpoints) and where the locations and details of each building are. ``{id}`` in details_url stands for the building's id."""
    both = [F.lit(f"{u}?solutionId={solution}&v=5") for u in sync]
    own = F.concat(F.lit(f"{locations_url}?building="), "admin_id", F.lit(f"&take={take}"))
    head, _, tail = details_url.partition("{id}")
    return inventory.withColumn("source_urls", F.array(*both, own, F.concat(F.lit(head), "building_id", F.lit(tail))))


def read_through(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path; where it is not there yet, ``make()`` is written to it first. A table counts as there once its write is complete."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def inventory(spark: SparkSession, path: str, building_items: Callable[[], DataFrame], venue_items: Callable[[], DataFrame], admin_ids: Sequence[str] = (), venue_ids: Sequence[str] = (), **urls) -> DataFrame:
    """Inventory dimension, read through ``path``: the two endpoints are asked only if it is not there. Building and venue ids restrict it where given; ``urls`` are the arguments of ``stamp_urls``."""

    def make() -> DataFrame:
        b = buildings(building_items(), venues(venue_items()))
        for col, allowed in (("admin_id", admin_ids), ("venue_id", venue_ids)):
            b = b.where(F.col(col).isin(*allowed)) if allowed else b
        return stamp_urls(b, **urls) if urls else b

    return read_through(spark, path, make).orderBy("slug")


def graph_details(responses: DataFrame, key: str = "graph_id", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(entry points, graphs) from route graph documents. Entry points: key, at, lon, lat, zlevel (0 if there is none); those without two coordinates go.

    Graphs: key, bbox (array of four, else null), and ``corrupt`` for a body that is no JSON, which has no entry points.
    """
    v = responses.select(key, F.try_parse_json(body).alias("v"))
    e = v.select(key, F.posexplode(get(F.col("v"), "$.entryPoints", "array<variant>")).alias("at", "e"))
    n = lambda k: get(F.col("e"), f"$.coordinates[{k}]", "double")
    entries = e.select(key, "at", n(0).alias("lon"), n(1).alias("lat"), F.coalesce(n(2), F.lit(0.0)).alias("zlevel")).where("lon is not null and lat is not null")
    box = get(F.col("v"), "$.bbox", "array<double>")
    return entries, v.select(key, F.when(F.size(box) == 4, box).alias("bbox"), F.col("v").isNull().alias("corrupt"))


# --- route responses ---

_POINT = "struct<lng:double,lat:double,zLevel:double,floor_name:string>"


def route_points(responses: DataFrame, key: str = "route_id", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(points, failures). points: key, r, l, s, p (route, leg, step, point), lon, lat, zlevel, floor_name, abutters, highway.

    Failures: no JSON, or a status other than OK, with the status. Steps
    without geometry give their start and end. Parsed once for all uses.
    """
    v = responses.select(key, F.try_parse_json(body).alias("v"))
    status = F.upper(F.coalesce(get(F.col("v"), "$.status"), F.lit("")))
    bad = v.where(F.col("v").isNull() | (status != "OK")).select(key, F.when(F.col("v").isNull(), "corrupt").otherwise(status).alias("status"))

    def explode(df: DataFrame, column: str, path: str, pos: str, out: str) -> DataFrame:
        return df.select(*(c for c in df.columns if c != column), F.posexplode(get(F.col(column), path, "array<variant>")).alias(pos, out))

    steps = explode(explode(explode(v.where(status == "OK"), "v", "$.routes", "r", "route"), "route", "$.legs", "l", "leg"), "leg", "$.steps", "s", "step")
    st = F.col("step")
    shape = get(st, "$.geometry", "array<variant>")
    ends = F.filter(F.array(get(st, "$.start_location", "variant"), get(st, "$.end_location", "variant")), lambda x: x.isNotNull())
    geometry = F.when(F.coalesce(F.size(shape), F.lit(0)) > 0, shape).otherwise(ends)
    cols = [key, "r", "l", "s", F.coalesce(get(st, "$.abutters"), F.lit("")).alias("abutters"), text.py_or(get(st, "$.highway"), F.lit("path")).alias("highway")]
    p = steps.select(*cols, F.posexplode(geometry).alias("p", "pt"))
    q = F.col("pt")
    out = p.select(key, "r", "l", "s", "p", "abutters", "highway", get(q, "$.lng", "double").alias("lon"), get(q, "$.lat", "double").alias("lat"), F.coalesce(get(q, "$.zLevel", "double"), F.lit(0.0)).alias("zlevel"), F.coalesce(get(q, "$.floor_name"), F.lit("")).alias("floor_name"))
    return out.where("lon is not null and lat is not null"), bad


def cache_key(origin: Column, destination: Column, graph: Column) -> Column:
    """SHA-1 of the three parts joined by bars."""
    return F.sha1(F.concat_ws("|", origin, destination, graph).cast("binary"))


def fill_cache(requests: DataFrame, cache: DataFrame, client: Callable[[str, str], str]) -> DataFrame:
    """cache plus answers for the requests (key, origin, destination) it lacks. The client is injected; its failures become bodies with a status."""
    import json

    missing = requests.join(cache.select("key"), "key", "left_anti").dropDuplicates(["key"])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for o, d in zip(pdf["origin"], pdf["destination"], strict=True):
                try:
                    out.append(client(o, d))
                except Exception as e:
                    out.append(json.dumps({"status": "request_failed", "message": str(e)}))
            yield pd.DataFrame({"key": pdf["key"], "body": pd.Series(out, dtype=object, index=pdf.index)})

    return cache.select("key", "body").unionByName(missing.mapInPandas(fetch, "key string, body string"))


# --- paged scan as a Python data source ---


class _Page(InputPartition):
    def __init__(self, building: str, skip: int):
        self.building, self.skip = building, skip


def _item_count(body: str) -> int:
    """Items of a page: of a bare list, or of the first list in its envelope; 0 if there is none."""
    import json

    doc = json.loads(body)
    if isinstance(doc, dict):
        doc = next((doc[k] for k in FEATURE_KEYS if isinstance(doc.get(k), list)), [])
    return len(doc) if isinstance(doc, list) else 0


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.take = int(options.get("take", 1000))
        self.pages = int(options.get("pages", 21))
        self.buildings = [b for b in options.get("buildings", "").split(",") if b]
        self.fetch = options["fetch"]

    def partitions(self):
        return [_Page(b, 0) for b in dict.fromkeys(self.buildings)] or [_Page(None, 0)]

    def read(self, partition):
        import importlib

        if partition.building is None:  # no building is left; Spark wants a partition all the same
            return
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        for k in range(self.pages):
            body = fetch(partition.building, self.take, k * self.take)
            yield (partition.building, k * self.take, body)
            if _item_count(body) < self.take:
                break


class _PushedReader(_PagedReader):
    """Spark refuses a reader with pushFilters unless push-down is enabled, so it is a class of its own."""

    def pushFilters(self, filters):  # noqa: N802, the name is Spark's
        """Equality and IN on ``building`` choose the partitions; every other filter goes back to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("building",):
                asked = {f.value}
            elif isinstance(f, In) and f.attribute == ("building",):
                asked = set(f.value)
            else:
                yield f
                continue
            self.buildings = [b for b in self.buildings if b in asked]


class PagedSource(DataSource):
    """spark.read.format("paged").option("fetch", "module:function").option("buildings", "741,903").load(): one partition per building.

    fetch(building, take, skip) returns a page's body. The pages of a building are asked for in turn until one is short or ``pages`` (21) are read.
    With the option ``pushdown`` "true", which needs ``spark.sql.python.filterPushdown.enabled``, a filter on ``building`` (equality or IN) reaches the reader, and other buildings are never asked for.
    """

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return "building string, skip int, body string"

    def reader(self, schema):
        return (_PushedReader if self.options.get("pushdown", "false").lower() == "true" else _PagedReader)(self.options)
