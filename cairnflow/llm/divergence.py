"""Audit of how the sources of a language differ in vocabulary, exact in whole numbers.

Terms are counted map-side per (language, source). A language keeps the terms
that enough of its documents hold; smoothed shares p of a group and the triangular
divergence f(p, q) = floor((p - q)^2 / (p + q)) follow from counts alone, so the
sum over all kept terms of a pair of sources comes from inclusion-exclusion over
the two supports, without looking at the terms that neither has:

- a constant prices every kept term as if both sources lacked it;
- a histogram of counts per source corrects the terms it has, priced against a
  source without them: one product per distinct count, not per term;
- posting lists of (source, share) per term correct the terms that both have.

Posting lists are cut into blocks of sources. A task adds whole lists into tiles
of block by block and sends tiles, so no pair of postings is ever a row. Joins on
the language, a key with few values, are salted; the pairs of sources they make
are the result itself.

Edge cases: null text, language or source is ''; each row is a document, repeated
rows too; a document without terms still makes its group occur; a language
without kept terms has value 0 for its pairs and no term rows; a source alone in
its language has no pair rows; texts are read whole, in pieces of about 1 MB, a
term may be of any length; numbers of occurrences may go beyond 64 bits once
multiplied, which decimals hold; other columns may have any names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, batches, pieces

#: A-Z in lower case, a-z and all bytes beyond ASCII as they are, every other byte a space
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
SALTS = 32


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, in parts that still are to be summed. docs: lang, source, text as bytes."""
    held_terms, held_bytes = 200_000, 1 << 26

    def flush(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in groups.items():
            if n:
                cols = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()).view(pa.string()), pa.array(n.values(), pa.int64()), pa.array([d[t] for t in n], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "docs"])

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        terms = size = 0
        for part in batches(rows):
            for lang, source, text in zip(part["lang"], part["source"], part["text"], strict=True):
                n, d = groups.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(n), set()
                for piece in pieces(text.translate(_LETTERS)):
                    found = piece.split()
                    n.update(found)
                    seen.update(found)
                d.update(seen)
                terms += len(n) - before
                size += len(text)
                if terms >= held_terms or size >= held_bytes:
                    yield from flush(groups)
                    groups, terms, size = {}, 0, 0
        yield from flush(groups)

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def share(n: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(10^9 (n + 2) / (total + 2 kept)); null without kept terms."""
    ten = F.lit(1_000_000_000).cast("decimal(10,0)")
    below = F.nullif(total.cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)") * kept.cast("decimal(17,0)"), F.lit(0).cast("decimal(1,0)"))
    return F.call_function("div", ten * (n.cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)")), below) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def overlap_tiles(rows: DataFrame, block: int, held_tiles: int = 32) -> DataFrame:
    """(lang, i, j, value): corrections of the terms that sources i < j of a language both have. rows: lang, bi, bj, left and right as array<struct<at, p, none>>."""

    def flush(tiles: dict) -> Iterator[pa.RecordBatch]:
        for (lang, bi, bj), tile in tiles.items():
            i, j = np.nonzero(np.triu(tile, 1) if bi == bj else tile)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i)), pa.array(i + bi * block), pa.array(j + bj * block), pa.array(tile[i, j])], names=["lang", "i", "j", "value"])

    def lists(column: pa.ListArray) -> Iterator[tuple[np.ndarray, ...]]:
        flat = column.flatten()
        cols = [flat.field(name).to_numpy(zero_copy_only=False) for name in ("at", "p", "none")]
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            yield tuple(c[a:b] for c in cols)

    def add(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: dict = {}
        for batch in batches_:
            if not batch.num_rows:
                continue
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for key, (i, p, p0), (j, q, q0) in zip(keys, lists(batch.column(3)), lists(batch.column(4)), strict=True):
                if key not in tiles:
                    if len(tiles) >= held_tiles:
                        yield from flush(tiles)
                        tiles = {}
                    tiles[key] = np.zeros((block, block), np.int64)
                p, p0 = p[:, None], p0[:, None]
                tiles[key][np.ix_(i, j)] += _gaps(p, q) - _gaps(p, q0) - _gaps(p0, q) + _gaps(p0, q0)
        yield from flush(tiles)

    return rows.mapInArrow(add, "lang string, i long, j long, value long")


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 10, top: int = 10, block: int = 256) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language, part ``term`` the ``top`` kept terms that a source uses more than its language."""
    scratch = Scratch(docs.sparkSession, "divergence")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))
    counts = scratch.save(term_counts(own).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_term")).where(F.col("docs") >= min_docs)
    held = scratch.save(counts.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "held")
    scratch.drop("counts")

    # one row per group: its place, its total, the total and the number of kept terms of its language, and its share for a term that it lacks
    languages = held.groupBy("lang", "term").agg(F.max("of_term").alias("n")).groupBy("lang").agg(F.sum("n").alias("of_lang"), F.count(F.lit(1)).alias("kept"))
    groups = own.select("lang", "source").distinct().join(held.groupBy("lang", "source").agg(F.sum("n").alias("of_group")), ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.fillna(0, ["of_group", "of_lang", "kept"]).withColumns({"place": F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1, "none": share(F.lit(0), F.col("of_group"), F.col("kept"))})
    groups = scratch.save(groups, "groups")
    mine = share(F.col("n"), F.col("of_group"), F.col("kept"))
    priced = held.join(groups, ["lang", "source"]).withColumns({"p": mine, "q": share(F.col("of_term"), F.col("of_lang"), F.col("kept"))})

    top_terms = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))

    # constants and histograms; a pair is kept as (a, b) with a < b
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    others = groups.select("lang", F.col("source").alias("other"), F.col("none").alias("other_none"), salt)
    pair = F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b")
    dealt = lambda df, *key: df.withColumn("salt", F.pmod(F.xxhash64(*key), F.lit(SALTS))).join(others, ["lang", "salt"])
    absent = gap(F.col("none"), F.col("other_none"))
    constant = dealt(groups, "source").where("source < other").select("lang", *pair, F.coalesce(F.col("kept") * absent, F.lit(0)).alias("value"))
    histogram = held.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms")).join(groups, ["lang", "source"]).withColumn("p", mine)
    one_sided = dealt(histogram, "source", "n").where("source <> other").select("lang", *pair, (F.col("terms") * (gap(F.col("p"), F.col("other_none")) - absent)).alias("value"))

    # overlaps
    lists = priced.groupBy("lang", "term", (F.col("place") / block).cast("int").alias("block")).agg(F.collect_list(F.struct((F.col("place") % block).alias("at"), "p", "none")).alias("l"), F.max("kept").alias("kept"))
    lists = scratch.save(lists, "lists")
    several = lists.join(groups.groupBy("lang").agg(F.max("place").alias("last")).where(F.col("last") >= block).select("lang"), "lang", "left_semi")
    right = several.select("lang", "term", F.col("block").alias("bj"), F.col("l").alias("right"))
    across = several.join(right, ["lang", "term"]).where("block < bj").select("lang", F.col("block").alias("bi"), "bj", F.col("l").alias("left"), "right")
    rows = lists.where(F.size("l") > 1).select("lang", F.col("block").alias("bi"), F.col("block").alias("bj"), F.col("l").alias("left"), F.col("l").alias("right")).unionByName(across)
    shared = overlap_tiles(rows, block).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    named = lambda at, name: groups.select("lang", F.col("place").cast("long").alias(at), F.col("source").alias(name))
    shared = shared.join(named("i", "a"), ["lang", "i"]).join(named("j", "b"), ["lang", "j"]).select("lang", "a", "b", "value")

    sums = constant.unionByName(one_sided).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("e")
    pairs = sums.select("lang", ends, "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(top_terms.withColumn("rank", rank).where(F.col("rank") <= top))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w,
                  row_number() OVER () AS id FROM documents),
o AS (SELECT id, lang, source, unnest(w) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN v ON o.lang = v.lang AND o.term = v.term GROUP BY ALL),
l AS (SELECT lang, count(*) AS kept, sum(n) AS total FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS (SELECT t.lang, t.source, v.term, coalesce(c.n, 0) AS n,
             (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (t.total + 2 * l.kept))::BIGINT AS p,
             (1 + 1000000000::HUGEINT * (v.n + 2) // (l.total + 2 * l.kept))::BIGINT AS q
      FROM t JOIN l ON t.lang = l.lang JOIN v ON v.lang = t.lang
      LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = v.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10
"""
