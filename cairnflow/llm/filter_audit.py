"""Audit of how document filters interact: what each removes in every order of the filters, and its Shapley share.

One pass over the texts turns every document into a mask of the filters that it
fails; counts per (part, mask) are all that the orders need, at most 32 cells a
part for five filters. The orders are visited by adjacent transpositions
(plain changes): a swap of two neighbours changes only their two steps, which
are summed again from the cells, and a filter's removals are added to its
Shapley sum when they change, times the orders for which they held.

The exact-copy filter needs the smallest doc_id of each text. Only first copies
are looked for, by a rank that every task limits before the shuffle, and moved
from the cell of copies to the cell of firsts; so a text that a third of all
documents share costs a row a task, and no document is joined to its group.

Edge cases: null text is empty text, a null part is the part ''; a row with a
null doc_id is no copy of anything, makes no copy and has no labels; rows
repeating a doc_id are documents of their own, and a copy needs a strictly
smaller doc_id; of several label rows for one document any 1 counts, null
labels are 0; texts are read whole, in pieces of about 1 MB; equal texts are
told by SHA-256; other columns may have any names; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, batches, pieces

FILTERS = "ABCDE"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: UTF-8 bytes that start a code point
_NO_CONTINUATION = bytes(range(0x80)) + bytes(range(0xC0, 0x100))
_COPY = 1 << FILTERS.index("E")


def text_mask(text: bytes, min_words: int = 200, min_distinct: int = 50, max_upper: int = 3, symbols: bytes = b"#$%&*|") -> int:
    """Bits of the failed filters that one text decides: A too few words, B too few distinct words, C too many capitals (both per cent), D any of the symbols."""
    words, seen = 0, set()
    for piece in pieces(text):
        found = piece.split()
        words += len(found)
        seen.update(found)
    code_points = len(text) if text.isascii() else len(text) - len(text.translate(None, _NO_CONTINUATION))
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (
        words < min_words,
        100 * len(seen) < min_distinct * words,
        100 * upper > max_upper * code_points,
        len(text) != len(text.translate(None, symbols)),
    )
    return sum(1 << i for i, x in enumerate(fails) if x)


def document_masks(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang", **limits: object) -> DataFrame:
    """(doc_id, part, key, mask, good, toxic) per document: key is the SHA-256 of its text, mask without the copy filter."""

    def mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows):
            texts = part["text"]
            cols = [part["doc_id"], part["part"], [hashlib.sha256(t).digest() for t in texts], [text_mask(t, **limits) for t in texts]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.binary(), pa.int32()), strict=True)], names=["doc_id", "part", "key", "mask"])

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text(part_col).alias("part"), text(text_col).cast("binary").alias("text"))
    marks = own.mapInArrow(mark, "doc_id long, part string, key binary, mask int")
    one = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    return marks.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def mask_cells(masks: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) with the copy filter: documents, those of good quality and toxic ones that fail exactly the filters of the mask."""
    counted = ["key", "doc_id", "part", "mask", "good", "toxic"]
    rows = masks.where("doc_id is not null").groupBy(*counted).agg(F.count(F.lit(1)).alias("n"))
    first = rows.withColumn("place", F.rank().over(Window.partitionBy("key").orderBy("doc_id"))).where("place = 1")
    cell = lambda df, mask, n: df.select("part", mask.alias("mask"), "good", "toxic", n.alias("n"))
    copy = F.col("mask").bitwiseOR(F.lit(_COPY))
    one = F.when(F.col("doc_id").isNull(), F.col("mask")).otherwise(copy)
    moved = first.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("n").alias("n")), F.struct(copy.alias("mask"), (-F.col("n")).alias("n")))).alias("c"))
    moved = cell(moved.select("part", "good", "toxic", "c.mask", "c.n"), F.col("mask"), F.col("n"))
    every = cell(masks, one, F.lit(1).cast("long")).unionByName(moved)
    return every.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def plain_changes(n: int) -> Iterator[int]:
    """Places i whose swap with i + 1 leads from the identity through all permutations of n things, each once."""
    inner = plain_changes(n - 1) if n > 2 else iter(())
    while n > 1:
        yield from range(n - 2, -1, -1)
        if (i := next(inner, None)) is None:
            return
        yield i + 1
        yield from range(n - 1)
        if (i := next(inner, None)) is None:
            return
        yield i


def walk_orders(cells: np.ndarray, filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders; cells: [mask] -> (n, good, toxic)."""
    k = len(filters)
    masks = np.arange(1 << k)
    fails = [int(cells[masks >> f & 1 == 1, 0].sum()) for f in range(k)]
    only = [int(cells[1 << f, 0]) for f in range(k)]
    order = list(range(k))
    kept, lost = [0] * k, [(0, 0, 0)] * k
    share, held_since = [0] * k, [0] * k

    def sum_step(i: int) -> None:
        before = sum(1 << f for f in order[:i])
        there = masks & before == 0
        gone = there & (masks >> order[i] & 1 == 1)
        lost[i] = tuple(int(x) for x in cells[gone].sum(0))
        kept[i] = int(cells[there & ~gone, 0].sum())

    for i in range(k):
        sum_step(i)
    rows, visited = [], 0

    def visit() -> None:
        name = "".join(filters[f] for f in order)
        rows.extend((name, i, f, kept[i], lost[i][0], fails[f] - lost[i][0], only[f], lost[i][1], lost[i][2]) for i, f in enumerate(order))

    visit()
    for at in plain_changes(k):
        visited += 1
        for i in (at, at + 1):
            share[order[i]] += lost[i][0] * (visited - held_since[order[i]])
            held_since[order[i]] = visited
        order[at], order[at + 1] = order[at + 1], order[at]
        sum_step(at)
        sum_step(at + 1)
        visit()
    for i, f in enumerate(order):
        share[f] += lost[i][0] * (visited + 1 - held_since[f])
    return [(name, i + 1, *values, share[f]) for name, i, f, *values in rows]


_NAMES = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def filter_audit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang", **limits: object) -> DataFrame:
    """One row per part, order and step; ``shapley`` is the filter's removals summed over all orders. ``limits``: those of ``text_mask``."""
    scratch = Scratch(docs.sparkSession, "audit")
    masks = scratch.save(document_masks(docs, labels, text_col, id_col, part_col, **limits), "masks")

    def walk(cells: pd.DataFrame) -> pd.DataFrame:
        full = np.zeros((1 << len(FILTERS), 3), np.int64)
        full[cells["mask"].to_numpy()] = cells[["n", "good", "toxic"]].to_numpy()
        out = pd.DataFrame(walk_orders(full), columns=_NAMES)
        out.insert(0, "part", cells["part"].iloc[0])
        return out

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _NAMES[2:])
    return mask_cells(masks).groupBy("part").applyInPandas(walk, schema)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
              'C': 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text),
              'D': regexp_matches(d.text, '[#$%&*|]'), 'E': coalesce(d.doc_id > f.least, false)} AS x
      FROM d JOIN f ON d.text = f.text LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, (CASE WHEN x.A THEN 'A' ELSE '' END) || (CASE WHEN x.B THEN 'B' ELSE '' END) || (CASE WHEN x.C THEN 'C' ELSE '' END)
             || (CASE WHEN x.D THEN 'D' ELSE '' END) || (CASE WHEN x.E THEN 'E' ELSE '' END) AS failed,
             count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
k(k) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e
      WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, i::INT AS step, substr(filter_order, i, 1) AS letter, substr(filter_order, 1, i - 1) AS before FROM o, range(1, 6) r(i)),
t AS (SELECT part, filter_order, step, letter, n, good, toxic, contains(failed, letter) AS fails, failed = letter AS alone,
             length(translate(failed, before, '')) < length(failed) AS earlier FROM c, s),
r AS (SELECT part, filter_order, step, letter,
             coalesce(sum(n) FILTER (WHERE NOT earlier AND NOT fails), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (WHERE NOT earlier AND fails), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (WHERE earlier AND fails), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (WHERE alone), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (WHERE NOT earlier AND fails), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (WHERE NOT earlier AND fails), 0)::BIGINT AS toxic_lost
      FROM t GROUP BY part, filter_order, step, letter)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""
