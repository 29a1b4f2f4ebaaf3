"""Text, identifier and lookup expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def py_or(*cols: Column) -> Column:
    """First truthy string: null and "" count as missing."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols[:-1]), cols[-1])


def slug(admin: Column, name: Column) -> Column:
    """"admin-name" in lower case; runs of other than a-z and 0-9 become one hyphen; an empty name leaves the admin part."""
    part = lambda c: F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.when(part(name) != "", F.concat(part(admin), F.lit("-"), part(name))).otherwise(part(admin))


def underscore_slug(c: Column, empty: str = "unknown") -> Column:
    """Case kept; runs of other characters become one underscore."""
    out = F.btrim(F.regexp_replace(F.trim(c), "[^A-Za-z0-9]+", "_"), F.lit("_"))
    return F.when(out == "", F.lit(empty)).otherwise(out)


def _parts(c: Column) -> Column:
    return F.filter(F.split(c, "[^a-zA-Z0-9]+"), lambda p: p != "")


def pascal(c: Column, empty: str = "Building") -> Column:
    """Parts joined with a capital first letter and the rest lower."""
    out = F.array_join(F.transform(_parts(c), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")
    return F.when(out == "", F.lit(empty)).otherwise(out)


def node_name(c: Column, empty: str = "Building") -> Column:
    """As ``pascal`` but the rest of each part keeps its case."""
    out = F.array_join(F.transform(_parts(c), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")
    return F.when(out == "", F.lit(empty)).otherwise(out)


def safe_floor_label(c: Column) -> Column:
    """b-2 -> b2, -2 -> b2, everything else with underscores; never empty."""
    t = F.lower(F.trim(c))
    other = F.btrim(F.regexp_replace(t, "[^a-z0-9]+", "_"), F.lit("_"))
    out = F.when(t.rlike(r"^b-\d+$"), F.regexp_replace(t, "-", "")).when(t.rlike(r"^-\d+$"), F.concat(F.lit("b"), F.substring(t, 2, 1 << 30))).otherwise(other)
    return F.when(out == "", F.lit("floor")).otherwise(out)


def group_token(c: Column) -> Column:
    """Upper case, every character that is no letter or digit becomes an underscore."""
    out = F.btrim(F.regexp_replace(F.upper(c), r"[^\p{L}\p{N}]", "_"), F.lit("_"))
    return F.when(out == "", F.lit("UNKNOWN")).otherwise(out)


@F.pandas_udf(T.StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """NFKD without what is not ASCII. No built-in does this, so it is the one text function in Python (Arrow batches)."""
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii"))


def clean_node_text(c: Column, fold: bool = True) -> Column:
    """Folded to ASCII; slashes to hyphens, double quotes to single, control characters and colons to spaces, spaces collapsed."""
    t = ascii_fold(c) if fold else c
    t = F.translate(t, "/\\\"", "--'")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[\\x00-\\x1f:]+", " "), r"\s+", " "))


def shaft_set_id(kind: Column, group: Column, external_id: Column, fold: bool = False) -> Column:
    """One id for each physical shaft: the member's prefix and the group, or the group alone."""
    clean = F.upper(clean_node_text(F.coalesce(group, F.lit("")), fold))
    member = F.when(external_id.contains("-"), F.upper(clean_node_text(F.split_part(external_id, F.lit("-"), F.lit(1)), fold))).otherwise("")
    alone = F.when((kind == "stair") & clean.startswith("S") & (F.length(clean) > 1), F.substring(clean, 2, 1 << 30)).otherwise(py_or(clean, F.lit("MAIN")))
    return F.when(member != "", F.concat(member, py_or(clean, F.lit("MAIN")))).otherwise(alone)


def portal_node_name(external_id: Column, display: Column, kind: Column, group: Column, fold: bool = False) -> Column:
    prefix = clean_node_text(F.regexp_replace(external_id, "-", " "), fold)
    label = F.when(kind == "elevator", "Elevator").when(kind == "stair", "Stairs").otherwise(py_or(clean_node_text(display, fold), F.lit("Door")))
    shaft = F.concat(prefix, F.lit("_"), label, F.lit("_Set"), shaft_set_id(kind, group, external_id, fold))
    return F.when(kind.isin("stair", "elevator"), shaft).when(prefix != "", F.concat(prefix, F.lit("_"), label)).otherwise(label)


def room_node_name(external_id: Column, display: Column, fold: bool = False) -> Column:
    prefix, suffix = clean_node_text(F.regexp_replace(external_id, "-", " "), fold), clean_node_text(F.coalesce(display, F.lit("")), fold)
    return F.when(suffix != "", F.concat(prefix, F.lit("_"), suffix)).otherwise(prefix)


def ordered_distinct_ci(values: Column) -> Column:
    """Trimmed, non-empty values, the first of each ignoring case, in their order."""
    clean = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))
    return F.aggregate(clean, F.array().cast("array<string>"), lambda acc, v: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(v)), acc).otherwise(F.array_append(acc, v)))


def aliases(external_id: Column, building: Column) -> Column:
    """Id, part after the first hyphen, id with spaces, and BUILDING suffix where the building is a word."""
    suffix = F.when(external_id.contains("-"), F.regexp_extract(external_id, "^[^-]*-(.*)$", 1))
    spaced = F.when(external_id.contains("-"), F.regexp_replace(external_id, "-", " "))
    named = F.when(external_id.contains("-") & (building != "") & ~building.contains("-") & ~building.rlike(r"^\d+$"), F.concat(F.upper(building), F.lit(" "), suffix))
    return ordered_distinct_ci(F.array(external_id, suffix, spaced, named))


#: Category rules in order: the first whose keyword is part of the text wins.
CATEGORY_RULES = (
    ("lecture", ("lecture", "auditorium")),
    ("lab", ("lab", "computer")),
    ("toilet", ("toilet", "bathroom", "wc")),
    ("study", ("study", "seminar", "case")),
    ("parking", ("parking", "carpark")),
    ("admin", ("office", "admin")),
)


def keyword_category(text: Column, rules=CATEGORY_RULES, other: str = "other") -> Column:
    """Substring match, not word match; rules in order."""
    t = F.lower(text)
    out = F.lit(other)
    for name, words in reversed(rules):
        hit = F.lit(False)
        for w in words:
            hit = hit | t.contains(w)
        out = F.when(hit, name).otherwise(out)
    return out


def portal_kind(source_type: Column, external_id: Column) -> Column:
    """elevator, stair or door by the type or the ending of the id (E1, S2); "" for rooms."""
    t = F.lower(F.coalesce(source_type, F.lit("")))
    return (
        F.when(t.contains("elevator") | t.contains("lift") | external_id.rlike(r"(?i)e\d+$"), "elevator")
        .when(t.contains("stair") | external_id.rlike(r"(?i)s\d+$"), "stair")
        .when(t.contains("entrance") | t.contains("door"), "door")
        .otherwise("")
    )


def portal_group_id(external_id: Column, name: Column, kind: Column) -> Column:
    """From the ending of the id, else from the name, else MAIN (doors) or DEFAULT."""

    def by(prefix: str) -> Column:
        own = F.nullif(F.upper(F.regexp_extract(external_id, rf"(?i)({prefix}\d+)$", 1)), F.lit(""))
        number = F.nullif(F.regexp_extract(name, rf"(?i){prefix}\s*(\d+)", 1), F.lit(""))
        return F.coalesce(own, F.concat(F.lit(prefix), number))

    found = F.when(kind == "elevator", by("E")).when(kind == "stair", by("S")).otherwise(by("D"))
    return F.coalesce(found, F.when(kind == "door", "MAIN").otherwise("DEFAULT"))


def prefix_key(external_id: Column) -> Column:
    """The part before the first hyphen, or all."""
    return F.trim(F.split_part(external_id, F.lit("-"), F.lit(1)))


def alias_key(c: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(c, r"\s+", " ")))


def error_text(body: Column, *keys: Column, most: int = 500) -> Column:
    """The first non-empty message, else the body cut at ``most`` characters."""
    return py_or(*keys, F.substring(body, 1, most))


def point_param(lat: Column, lon: Column, z: Column) -> Column:
    """lat,lon,z with 12 decimals for the degrees and a plain whole number for z."""
    return F.format_string("%.12f,%.12f,%d", lat, lon, z)


def rank_map(c: Column, ranks: dict[str, int], other: int = 0) -> Column:
    out = F.lit(other)
    for k, v in ranks.items():
        out = F.when(c == k, v).otherwise(out)
    return out


#: How much a door observation is trusted.
CONFIDENCE = {"none": 0, "low": 1, "medium": 2, "high": 3}
