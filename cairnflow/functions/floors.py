"""Floor labels. The variants disagree on purpose: each source of labels has its own reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR = 10_000.0


def base_sort_key(c: Column) -> Column:
    """Whole number, else 0 for G, else last."""
    return F.coalesce(F.trim(c).try_cast("int"), F.when(F.upper(c) == "G", 0).otherwise(int(FAR)))


def canonical(c: Column) -> Column:
    """Ground in all its spellings is G, a bare B is B-1, the rest is upper case."""
    t = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t.isin("", "NONE", "0", "G", "GROUND", "LEVEL 0"), "G").when(t == "B", "B-1").otherwise(t)


def canonical_entry(c: Column) -> Column:
    """The reading of entry records: no B rule and no LEVEL 0."""
    t = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t.isin("", "0", "G", "GROUND"), "G").otherwise(t)


def is_basement(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return t.startswith("B") | F.coalesce(t.try_cast("double") < 0, F.lit(False))


def sort_value(c: Column) -> Column:
    """Height order of a label: B-n below, SB between B-1 and B-2, M8 and 1M half a level above their number."""
    t = canonical(c)
    return (
        F.when(t.startswith("B-"), F.coalesce(-F.substring(t, 3, 1 << 30).try_cast("double"), F.lit(-1.0)))
        .when(t == "G", 0.0)
        .when(t == "SB", -1.5)
        .when(t.rlike(r"^M\d+$"), F.substring(t, 2, 1 << 30).try_cast("double") + 0.5)
        .when(t.rlike(r"^\d+M$"), F.regexp_replace(t, "M$", "").try_cast("double") + 0.5)
        .otherwise(F.coalesce(t.try_cast("double"), F.lit(FAR)))
    )


def height(c: Column, spacing: float = 4.2, basement: float = 3.0) -> Column:
    """Metres above ground: tighter spacing below."""
    v = sort_value(c)
    return F.when(v < 0, v * basement).otherwise(v * spacing)


def number_scene(c: Column) -> Column:
    """Scene writer: a bare B is -1, M8 is 8, what is no number is 0."""
    t = F.upper(F.trim(c))
    cut = F.regexp_replace(t, "^M", "")
    return F.when(t.isin("G", "GROUND"), 0).when(t == "B", -1).when(t.startswith("B-"), F.coalesce(-F.substring(t, 3, 1 << 30).try_cast("int"), F.lit(0))).otherwise(F.coalesce(cut.try_cast("int"), F.lit(0)))


def number_topology(c: Column) -> Column:
    """Topology: a bare B is 0, decimals are cut."""
    t = F.upper(F.trim(c))
    return (
        F.when(t == "G", 0)
        .when(t.startswith("B-"), F.coalesce(-F.substring(t, 3, 1 << 30).try_cast("int"), F.lit(0)))
        .when(t.rlike(r"^M\d+$"), F.substring(t, 2, 1 << 30).try_cast("int"))
        .otherwise(F.coalesce(t.try_cast("double").cast("int"), F.lit(0)))
    )


def source_floor(value: Column, fallback: Column, mezzanine: bool = True) -> Column:
    """The API's level: a number, else 0 for ground, else 10 n + 5 for Mn, else the floor index."""
    t = F.upper(F.trim(value))
    out = F.when(t.isin("G", "GROUND"), 0.0)
    if mezzanine:
        out = out.when(t.rlike(r"^M\d+$"), F.substring(t, 2, 1 << 30).try_cast("double") * 10 + 5)
    return F.coalesce(value.try_cast("double"), out.otherwise(fallback.cast("double")))


def navigation_layer(index: Column) -> Column:
    """Bit n for 0 to 31, else bit 0."""
    n = F.when(index.between(0, 31), index).otherwise(F.lit(0))
    return F.pow(F.lit(2.0), n).cast("long")
