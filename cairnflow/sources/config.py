"""Driver-side configuration: building groups and campus paths from YAML. Configuration is small and validated at once."""

from __future__ import annotations

from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, SparkSession

from ..functions.geo import Reference


@dataclass(frozen=True)
class Group:
    id: str
    display_name: str
    primary_member: str
    members: tuple[str, ...]
    aliases: tuple[str, ...] = ()


@dataclass(frozen=True)
class CampusConfig:
    graph_id: str
    reference: Reference
    snap_m: float = 1.5
    simplify_m: float = 0.75
    min_stub_m: float = 6.0
    spur_max_m: float = 60.0
    widths_m: dict[str, float] = field(default_factory=dict)


def load_groups(document: str) -> list[Group]:
    """Groups in file order; a group without id or members is an error. Members and aliases are distinct, ignoring case for aliases."""
    out = []
    for g in (yaml.safe_load(document) or {}).get("groups") or []:
        gid, members = str(g.get("id") or "").strip(), tuple(dict.fromkeys(str(m).strip() for m in g.get("members") or [] if str(m).strip()))
        if not gid or not members:
            raise ValueError(f"group without id or members: {g}")
        aliases = tuple({a.lower(): a for a in reversed([str(a).strip() for a in g.get("aliases") or [] if str(a).strip()])}.values())[::-1]
        out.append(Group(gid, str(g.get("display_name") or gid), str(g.get("primary_member") or members[0]), members, aliases))
    return out


def load_campus(document: str) -> CampusConfig:
    raw = yaml.safe_load(document) or {}
    r = raw["reference"]
    ref = Reference(float(r["lon"]), float(r["lat"]), (float(r["local_anchor"][0]), float(r["local_anchor"][2])), (float(r["origin"][0]), float(r["origin"][2])), float(r["scale"]))
    own = {k: float(raw[k]) for k in ("snap_m", "simplify_m", "min_stub_m") if k in raw}
    if "entrance_spur_max_m" in raw:
        own["spur_max_m"] = float(raw["entrance_spur_max_m"])
    return CampusConfig(str(raw["graph_id"]), ref, widths_m={k: float(v) for k, v in (raw.get("widths_m") or {}).items()}, **own)


def groups_table(spark: SparkSession, groups: list[Group]) -> DataFrame:
    """(group_id, ord, member, member_ord, is_primary)."""
    rows = [(g.id, i, m, k, m == g.primary_member) for i, g in enumerate(groups) for k, m in enumerate(g.members)]
    return spark.createDataFrame(rows, "group_id string, ord int, member string, member_ord int, is_primary boolean")


def filter_members(group: Group, only: list[str]) -> Group:
    """The group with the given members alone: unknown ids are an error, the primary moves to the first member that is left."""
    unknown = [m for m in only if m not in group.members]
    if unknown:
        raise ValueError(f"unknown members: {', '.join(unknown)}")
    members = tuple(m for m in group.members if m in only) if only else group.members
    primary = group.primary_member if group.primary_member in members else members[0]
    return Group(group.id, group.display_name, primary, members, tuple(a for a in group.aliases if a not in group.members or a in members))
