"""Sinks: canonical documents, summaries, catalogs, per-row callbacks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_json(doc) -> str:
    """Two spaces, sorted keys, a final newline."""
    return json.dumps(doc, indent=2, sort_keys=True, ensure_ascii=False) + "\n"


def content_hash(doc: dict, field: str = "generation_hash") -> str:
    """SHA-256 of the compact canonical form without the hash itself."""
    rest = {k: v for k, v in doc.items() if k != field}
    return hashlib.sha256(json.dumps(rest, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def write_documents(df: DataFrame, path: str, partition: str | None = None) -> None:
    """One JSON document per row; Spark's commit makes the write atomic and overwrites stale files."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).json(path)


def write_summary_csv(df: DataFrame, path: str) -> None:
    """Header, scalar columns, lists joined by "; ", structs and maps as JSON."""
    cols = []
    for f in df.schema:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        cols.append((F.array_join(c.cast("array<string>"), "; ") if kind == "array" else F.to_json(c) if kind in ("struct", "map") else c).alias(f.name))
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def markdown_lists(df: DataFrame, group: str, order: str, line: str) -> DataFrame:
    """(group, lines, n): each group's lines in order, joined by newlines."""
    rows = F.array_sort(F.collect_list(F.struct(order, line)))
    return df.groupBy(group).agg(F.array_join(rows[line], "\n").alias("lines"), F.count(F.lit(1)).alias("n"))


class Skip(Exception):
    """Raised by a runner: the row is skipped, which is no failure."""


def run_each(df: DataFrame, runner: Callable[[dict], None], fail_fast: bool = False) -> DataFrame:
    """df with status (generated, skipped, failed) and error. One row's failure never stops the others, unless fail_fast."""

    def run(batches):
        for pdf in batches:
            status, error = [], []
            for row in pdf.to_dict("records"):
                try:
                    runner(row)
                    s, e = "generated", ""
                except Skip:
                    s, e = "skipped", ""
                except Exception as x:
                    if fail_fast:
                        raise
                    s, e = "failed", f"{type(x).__name__}: {x}"
                status.append(s)
                error.append(e)
            yield pdf.assign(status=pd.Series(status, dtype=object, index=pdf.index), error=pd.Series(error, dtype=object, index=pdf.index))

    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{cols}, status string, error string")


def campus_index(df: DataFrame) -> DataFrame:
    """One JSON document: records by slug and the counts by status. df: slug, status and any other columns."""
    counts = df.groupBy("status").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("summary"))
    rows = df.agg(F.array_sort(F.collect_list(F.struct("slug", *(c for c in df.columns if c != "slug")))).alias("buildings"))
    return rows.join(F.broadcast(counts)).select(F.to_json(F.struct("summary", "buildings")).alias("document"))  # two rows of one


def catalog(df: DataFrame, title: str) -> DataFrame:
    """(document): Markdown list of buildings (slug, display_name, status, rooms), generated ones first."""
    line = F.format_string("- [%s](#%s): %s, %d rooms", "display_name", "slug", "status", F.coalesce("rooms", F.lit(0)))
    rows = df.agg(F.array_sort(F.collect_list(F.struct((F.col("status") != "generated").alias("o"), F.col("slug"), line.alias("line")))).alias("r"), F.count(F.lit(1)).alias("n"))
    return rows.select(F.concat(F.lit(f"# {title}\n\n"), F.col("n").cast("string"), F.lit(" buildings\n\n"), F.array_join(F.transform("r", lambda x: x["line"]), "\n"), F.lit("\n")).alias("document"))


def catalog_details(df: DataFrame) -> DataFrame:
    """(admin_id, entry, section): the line of every building in the index of a Markdown catalog, and its section.

    df: admin_id, display_name, slug, status, venue_name, rooms, floors, portals, artifacts (map of name to path), warnings, errors,
    source_urls (arrays). Entry and section share an anchor; names are made of letters, digits and hyphens. Sections link the files in
    the order of their names and the first four sources, and give the first error, else the first warning. ``catalog_pages`` joins them.
    """
    head = F.trim(F.concat_ws(" - ", F.coalesce("admin_id", F.lit("")), F.coalesce("display_name", F.lit(""))))
    anchor = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.lower(head), "[^a-z0-9 -]", "")), r"\s+", "-"), "-+", "-")
    counts = F.concat_ws(", ", *(F.concat(F.coalesce(F.col(c), F.lit(0)).cast("string"), F.lit(f" {c}")) for c in ("rooms", "floors", "portals")))
    status = F.coalesce("status", F.lit("unknown"))
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    files = F.array_join(F.transform(F.array_sort(F.map_entries("artifacts")), lambda e: F.concat(F.lit("["), e["key"], F.lit("]("), e["value"], F.lit(")"))), ", ")
    first = lambda c: F.concat(F.size(c).cast("string"), F.lit(f" {c}, the first: "), F.element_at(c, 1))
    notes = F.when(some("errors"), first("errors")).when(some("warnings"), first("warnings")).otherwise("none")
    links = F.array_join(F.transform(F.slice("source_urls", 1, 4), lambda u, i: F.concat(F.lit("[source "), (i + 1).cast("string"), F.lit("]("), u, F.lit(")"))), ", ")
    line = lambda label, value: F.concat(F.lit(f"- {label}: "), value)
    body = [
        F.concat(F.lit('<a id="'), anchor, F.lit('"></a>')), F.concat(F.lit("### "), head), F.lit(""), line("Status", status), line("Slug", F.coalesce("slug", F.lit(""))),
        line("Venue", F.coalesce(F.nullif("venue_name", F.lit("")), F.lit("unknown"))), line("Counts", counts), line("Files", F.when(some("artifacts"), files).otherwise("none")), line("Notes", notes), F.when(some("source_urls"), line("Sources", links)),
    ]
    entry = F.concat(F.lit("- ["), head, F.lit("](#"), anchor, F.lit("): "), status, F.lit(", "), counts)
    return df.select("admin_id", entry.alias("entry"), F.concat_ws("\n", *body).alias("section"))


def catalog_pages(df: DataFrame, title: str) -> DataFrame:
    """(document): one Markdown page with the counts by status, the index and the sections of ``catalog_details``, both by admin_id. One page is one row: a campus, not a corpus."""
    count = lambda s: F.count_if(F.col("status") == s).cast("string")
    sums = df.agg(F.concat_ws("\n", F.concat(F.lit("- total: "), F.count(F.lit(1)).cast("string")), *(F.concat(F.lit(f"- {s}: "), count(s)) for s in ("generated", "skipped", "failed"))).alias("sums"))
    rows = catalog_details(df).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("admin_id", F.lit("")), "entry", "section"))).alias("r"))
    joined = lambda name, sep: F.array_join(F.transform("r", lambda x: x[name]), sep)
    return rows.join(F.broadcast(sums)).select(F.concat(F.lit(f"# {title}\n\n"), "sums", F.lit("\n\n## Index\n\n"), joined("entry", "\n"), F.lit("\n\n## Buildings\n\n"), joined("section", "\n\n"), F.lit("\n")).alias("document"))  # two rows of one


def glb_problems(files: DataFrame) -> DataFrame:
    """(path, problem), every rule that binary meshes (path, content) break: header, version, declared length, a first chunk that is JSON and fits. Stays in the JVM."""
    byte = lambda at: F.conv(F.hex(F.substring("content", at, 1)), 16, 10).cast("long")
    number = lambda at: sum((byte(at + k) * 256**k for k in range(1, 4)), byte(at))
    rules = [(F.substring("content", 1, 4) != F.lit(b"glTF"), "no glTF header"), (number(5) != 2, "version is not 2"), (number(9) != F.length("content"), "length differs"), (F.substring("content", 17, 4) != F.lit(b"JSON"), "first chunk is not JSON"), (number(13) + 20 > F.length("content"), "JSON chunk exceeds the file")]
    found = F.array_compact(F.array(*(F.when(bad, name) for bad, name in rules)))
    short = F.coalesce(F.length("content"), F.lit(0)) < 20
    return files.select("path", F.explode(F.when(short, F.array(F.lit("too small"))).otherwise(found)).alias("problem"))


def glb_issues(files: DataFrame) -> DataFrame:
    """(path, problem) of binary meshes (path, content) whose header, version or length is wrong, without leaving the JVM."""
    swap = lambda at: sum((F.conv(F.hex(F.substring("content", at + k, 1)), 16, 10).cast("long") * (256**k) for k in range(1, 4)), F.conv(F.hex(F.substring("content", at, 1)), 16, 10).cast("long"))
    problem = F.when(F.substring("content", 1, 4) != F.lit(b"glTF"), "no glTF header").when(swap(5) != 2, "version is not 2").when(swap(9) != F.length("content"), "length differs")
    return files.select("path", problem.alias("problem")).where("problem is not null")
