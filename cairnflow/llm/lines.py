"""Line de-duplication with DataFrame functions only.

Line keys are hashed to 128 bits, range-partitioned by (hash, document) and
sorted within partitions by document and position, so a line that a third of
all documents hold spans many partitions. Each partition streams its rows in
that order and finds the first occurrence of every line in every document
without another exchange or sort. Counts and the kept document of a line
are map-side aggregates of the first occurrences. Marking is a join of a line's
occurrences with its one row of counts, which adaptive execution splits for a
line of very many documents (or needs no shuffle where few lines are common).
What comes back per document is a keep bitmap in run-length form (``keep_runs``: start and length of
every stretch of lines that stays), never text; documents that lose nothing
have no bitmap.

Edge cases: null or empty text is one empty line; short lines always stay; rows
with a null ``doc_id`` take no part and come back whole; rows repeating a
``doc_id`` count as one document in the counts, but each of its different texts
has its own lines and its own bitmap; texts are split whole, however long;
columns of docs may have any names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, free_names, release

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _LOWER)


def line_bitmaps(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, t, n_lines, n_dropped, keep_runs) of every document that loses lines; t is the xxhash64 of its text.

    A key of at least ``min_chars`` code points in at least ``min_docs``
    documents loses all its lines but those of the largest doc_id that holds it.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t"), split_lines(F.col(text_col)).alias("lines")).where("doc_id is not null")
    keys = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("at"), line_key(x).alias("key"))), lambda x: F.char_length(x["key"]) >= min_chars)
    rows = lines.select("doc_id", "t", F.size("lines").alias("n"), F.explode(F.transform(keys, lambda x: F.struct(F.xxhash64(x["key"]).alias("h1"), F.xxhash64(F.lit(7), x["key"]).alias("h2"), x["at"].alias("at")))).alias("k")).select("k.h1", "k.h2", "doc_id", "t", "n", "k.at")
    order = ("h1", "h2", "doc_id", "t", "at")
    in_document = Window.partitionBy("h1", "h2", "doc_id").orderBy("t", "at")
    held = rows.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions(*order).withColumn("first", F.row_number().over(in_document) == 1)
    held = scratch.save(held, "held")
    release(docs.sparkSession)
    common = held.where("first").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("kept")).where(F.col("docs") >= min_docs)
    drop = held.join(common, ["h1", "h2"]).where("doc_id <> kept").groupBy("doc_id", "t").agg(F.max("n").alias("n_lines"), F.array_sort(F.collect_set("at")).alias("at"))
    edges = F.concat(F.array(F.lit(-1)), F.col("at"), F.array(F.col("n_lines")))
    drop = drop.select("doc_id", "t", "n_lines", F.size("at").alias("n_dropped"), edges.alias("e"))
    gaps = F.zip_with(F.slice("e", F.lit(1), F.size("e") - 1), F.slice("e", F.lit(2), F.size("e") - 1), lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("len")))
    return drop.select("doc_id", "t", "n_lines", "n_dropped", F.filter(gaps, lambda x: x["len"] > 0).alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, list[str]]:
    """docs with three more columns, and their names: number of lines, number of dropped lines, the text that stays (null text counts as empty)."""
    doc, t, n, runs, split, *more = free_names(docs, "__doc", "__t", "__n", "__runs", "__split", "__lines", "__dropped", "__kept")
    marks = bitmaps.select(F.col("doc_id").alias(doc), F.col("t").alias(t), F.col("n_dropped").alias(n), F.col("keep_runs").alias(runs)).hint("shuffle_hash")
    kept = F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(F.col(split), r["start"] + 1, r["len"]))), "\n")
    joined = docs.join(marks, (F.col(id_col).cast("long") == F.col(doc)) & (F.xxhash64(text_col) == F.col(t)), "left").withColumn(split, split_lines(F.col(text_col)))
    values = F.size(split).cast("long"), F.coalesce(n, F.lit(0)).cast("long"), F.when(F.col(runs).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept)
    return joined.withColumns(dict(zip(more, values, strict=True))).drop(doc, t, n, runs, split), more


def drop_common_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 40, min_docs: int = 5, length_col: str | None = None) -> DataFrame:
    """docs with the same columns and the text that stays; texts that lose no line stay as they are, null included. ``length_col`` then holds the code points of a shortened text."""
    kept, (_, dropped, text) = apply_bitmaps(docs, line_bitmaps(docs, text_col, id_col, min_chars, min_docs), text_col, id_col)
    new = {text_col: F.when(F.col(dropped) > 0, F.col(text)).otherwise(F.col(text_col))}
    if length_col:
        new[length_col] = F.when(F.col(dropped) > 0, F.char_length(text).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return kept.withColumns(new).select(*docs.columns)


def line_digest(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out, (lines, dropped, text) = apply_bitmaps(own, line_bitmaps(own, min_chars=min_chars, min_docs=min_docs))
    return out.select("doc_id", F.col(lines).alias("n_lines"), F.col(dropped).alias("n_dropped"), F.sha2(F.col(text).cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, lines[i] AS line,
             translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS kept FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.i, k.line, coalesce(k.doc_id <> g.kept, false) AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
