"""Exact substring removal over words by level-wise doubling.

Windows are judged at a short length first. Only windows whose content-chosen
part repeats at one length are carried to twice that length, until the full
window length is reached or no candidate survives:

1. at length ``start`` every full window is represented by its minimizer (the
   least hash among its parts), so equal windows always choose equal parts and
   a fraction of the words yields a row instead of every word;
2. a part that occurs once cannot lie in a repeated window, so it drops out;
3. survivors are extended to twice the length, and so on;
4. at the full length, neighbouring windows that share a minimizer are one run.
   Equal runs are decided as a whole; only runs whose minimizer also has runs
   of other content are opened, and their windows decided one by one: every
   occurrence but the earliest ``(doc_id, start)`` marks its words.

Every level reads the documents again by a join on ``doc_id``; what travels
between levels are hashes and positions of survivors. Inside one Python batch
repeats are already decided, so a window that occurs in a third of all rows
sends one row per batch to its key, not one per occurrence.

Edge cases: null text is an empty text; documents shorter than a window lose
nothing; rows with a null ``doc_id`` take no part and come back unchanged;
rows repeating a ``doc_id`` with the same text count as one document and are
all returned, different texts under one ``doc_id`` are documents of their own in
the order of their hashes; texts are read whole, a document at a time, however
long; an empty table gives an empty result; other columns are ignored, whatever
they are called.

Words are hashed to 64 bits, and runs and windows are compared by hashes of
these: equality of two 64-bit values stands for equality of content.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, batches, combine, cover, identified, marks_by_doc, minimizers, release, runs_of, signed

#: g is null where a batch has already decided: the part repeats, or the run or window goes.
_PARTS = "g long, doc_id long, at int"
_RUNS = "g long, g2 long, doc_id long, at int, to int"


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every n consecutive words, built by doubling."""
    size = 1
    while size < n:
        step = min(size, n - size)
        h = combine(h[: max(0, len(h) - step)], h[step:], seed)
        size += step
    return h


def lengths(start: int, window: int) -> list[int]:
    """start, 2 start, 4 start, ..., window. Doubling ends where a full window need not hold either extension of its part."""
    out = [start] if start < window else []
    while out and 3 * out[-1] - 1 <= window and 2 * out[-1] < window:
        out.append(2 * out[-1])
    return [*out, window]


def _batch_rows(names: list[str], drop: str, id_col: list, at: list, to: list, keys: list[list]) -> pa.RecordBatch | None:
    """Rows of one batch, sorted by key and place. drop: which rows of an equal key the batch decides ("all" of several, or all but the "first")."""
    if not id_col:
        return None
    doc, at, to = np.concatenate(id_col), np.concatenate(at), np.concatenate(to)
    keys = [np.concatenate(k) for k in keys]
    order = np.lexsort((at, doc, *keys[::-1]))
    doc, at, to, keys = doc[order], at[order], to[order], [k[order] for k in keys]
    new = runs_of(np.arange(len(doc)), *keys)
    again = ~new & (np.diff(doc, prepend=-1) == 0) & (np.diff(at, prepend=-1) == 0)  # a repeated row
    new, doc, at, to, keys = new[~again], doc[~again], at[~again], to[~again], [k[~again] for k in keys]
    sent = new.copy()
    if drop == "all":  # one of several goes on for other batches to meet, beside its own decided row
        several = ~new | np.append(~new[1:], False)
        extra = new & several
        doc, at, to = (np.concatenate([x, x[extra]]) for x in (doc, at, to))
        keys = [np.concatenate([k, k[extra]]) for k in keys]
        sent = np.concatenate([new & ~several, np.ones(int(extra.sum()), bool)])
    cols = {"doc_id": pa.array(doc, pa.int64()), "at": pa.array(at.astype(np.int32)), "to": pa.array(to.astype(np.int32))}
    cols |= {n: pa.array(signed(k), mask=~sent) for n, k in zip(("g", "g2"), keys, strict=False)}
    return pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


def _rows(parts, names: list[str], drop: str, window: int):
    """parts(words, marks) -> (key columns, at, to) of one document."""

    def run(source):
        for cols in batches(source):
            ids, at, to, keys = [], [], [], [[], []]
            for k, (doc, text) in enumerate(zip(cols["doc_id"], cols["__text"], strict=True)):
                words = text.split() if text else []
                if doc is None or len(words) < window:
                    continue
                key, a, b = parts(words, cols["__marks"][k] if "__marks" in cols else None)
                if len(a):
                    ids.append(np.full(len(a), doc, np.int64))
                    at.append(a)
                    to.append(b)
                    for i, x in enumerate(key):
                        keys[i].append(x)
            out = _batch_rows(names, drop, ids, at, to, [k for k in keys if k])
            if out is not None:
                yield out

    return run


def _first_level(n: int, window: int):
    def parts(words, _marks):
        h = gram_hashes(word_hashes(words), n)
        at = np.unique(minimizers(h, window - n + 1))
        return [h[at]], at, at

    return parts


def _next_level(n: int, before: int):
    """Parts of length n that hold a surviving part of the length before: forward from it, and ending with it."""

    def parts(words, marks):
        alive = np.array([m["at"] for m in marks], np.int64)
        at = np.concatenate([alive, alive + before - n])
        at = np.unique(at[(at >= 0) & (at + n <= len(words))])
        return [gram_hashes(word_hashes(words), n)[at]], at, at

    return parts


def _last_level(before: int | None, start: int, window: int):
    """Runs of neighbouring windows that hold a surviving part and share a minimizer: (minimizer, content), first and last window."""

    def parts(words, marks):
        h = word_hashes(words)
        wide = len(words) - window + 1
        g = gram_hashes(h, start)
        anchor = minimizers(g, window - start + 1)
        if before is not None:
            alive = np.array([m["at"] for m in marks], np.int64)
            keep = cover(wide, np.maximum(alive + before - window, 0), np.minimum(alive + 1, wide))
            anchor = np.where(keep, anchor, -1)
        first = np.flatnonzero(np.diff(anchor, prepend=-2))
        last = np.append(first[1:], wide) - 1
        live = anchor[first] >= 0
        first, last = first[live], last[live]
        view = memoryview(np.ascontiguousarray(h)).cast("B")
        digest = xxhash.xxh3_64_intdigest
        content = [digest(view[8 * i : 8 * (j + window)]) for i, j in zip(first.tolist(), last.tolist(), strict=True)]
        return [g[anchor[first]], np.array(content, np.uint64)], first, last

    return parts


def _windows(window: int):
    """Every window of the open runs, under a 128-bit hash."""

    def parts(words, marks):
        h = word_hashes(words)
        wide = len(words) - window + 1
        at = np.flatnonzero(cover(wide, np.array([m["at"] for m in marks], np.int64), np.array([m["to"] + 1 for m in marks], np.int64)))
        return [gram_hashes(h, window)[at], gram_hashes(h, window, 0x5BD1E995)[at]], at, at

    return parts


def repeated_runs(base: DataFrame, window: int = 20, start: int = 5, survivors: list | None = None) -> DataFrame:
    """base: (doc_id, __text) with one text per id -> (doc_id, at, to): first and last start of runs of windows of ``window`` words that also start earlier. ``survivors`` gets (length, parts that go on) of each level."""
    spark = base.sparkSession
    scratch = Scratch(spark, "substring")
    base = base.select("doc_id", "__text")
    place = F.struct("doc_id", "at")

    def with_marks(marks: DataFrame, *cols: str) -> DataFrame:
        return base.join(marks_by_doc(marks, "doc_id", *cols).hint("shuffle_hash"), "doc_id")

    def decide(parts, names: list[str], drop: str, source: DataFrame, name: str) -> DataFrame:
        rows = scratch.save(source.mapInArrow(_rows(parts, names, drop, window), _RUNS if "to" in names else _PARTS), name)
        release(spark)
        return rows

    *shorter, _ = lengths(start, window)
    alive = None
    for k, n in enumerate(shorter):
        source = base if alive is None else with_marks(alive, "at")
        rows = decide(_first_level(n, window) if k == 0 else _next_level(n, shorter[k - 1]), ["g", "doc_id", "at"], "all", source, f"parts{n}")
        met = Window.partitionBy("g")
        seen = rows.where("g is not null").withColumn("lo", F.min(place).over(met)).withColumn("hi", F.max(place).over(met)).where("lo <> hi")
        alive = scratch.save(seen.select("doc_id", "at").unionByName(rows.where("g is null").select("doc_id", "at")), f"alive{n}")
        if survivors is not None:
            survivors.append((n, alive.count()))
        del rows, seen, source
        scratch.drop(f"parts{n}")
        release(spark)

    names = ["g", "g2", "doc_id", "at", "to"]
    source = base if alive is None else with_marks(alive, "at")
    rows = decide(_last_level(shorter[-1] if shorter else None, shorter[0] if shorter else window, window), names, "rest", source, "runs")
    del source, alive
    seen = rows.where("g is not null").withColumn("lo", F.min(place).over(Window.partitionBy("g", "g2")))
    seen = seen.withColumn("clo", F.min("g2").over(Window.partitionBy("g"))).withColumn("chi", F.max("g2").over(Window.partitionBy("g")))
    gone = F.col("lo") != place
    seen = seen.select("doc_id", "at", "to", gone.alias("gone"), (~gone & (F.col("clo") < F.col("chi"))).alias("open")).where("gone or open")
    decided = scratch.save(seen.unionByName(rows.where("g is null").select("doc_id", "at", "to", F.lit(True).alias("gone"), F.lit(False).alias("open"))), "decided")
    del rows, seen
    scratch.drop("runs", *(f"alive{n}" for n in shorter))
    release(spark)

    rows = decide(_windows(window), names, "rest", with_marks(decided.where("open"), "at", "to"), "windows")
    late = rows.where("g is not null").withColumn("lo", F.min(place).over(Window.partitionBy("g", "g2"))).where(F.col("lo") != place)
    late = scratch.save(late.select("doc_id", "at", "to").unionByName(rows.where("g is null").select("doc_id", "at", "to")), "late")
    del rows
    scratch.drop("windows")
    release(spark)
    return decided.where("gone").select("doc_id", "at", "to").unionByName(late)


def _digest(window: int):
    def run(source):
        for cols in batches(source):
            out = {"doc_id": cols["__id"], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for text, marks in zip(cols["__text"], cols["__marks"], strict=True):
                words = text.split() if text else []
                gone = np.zeros(len(words), bool)
                if marks:
                    gone = cover(len(words), np.array([m["at"] for m in marks], np.int64), np.array([m["to"] for m in marks], np.int64) + window)
                kept = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x) if marks else b" ".join(words)
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept)
            yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())], names=list(out))

    return run


def remove_repeated_substrings(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = 20, start: int = 5) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and the kept words as UTF-8 (``kept``).

    A word goes if a window of ``window`` words that covers it also starts
    earlier: in a smaller ``doc_id``, or before it in the same document.
    """
    base = identified(docs, text_col, id_col, Scratch(docs.sparkSession, "texts"))
    marks = repeated_runs(base, window, start)
    by_doc = marks_by_doc(marks, "doc_id", "at", "to").hint("shuffle_hash")
    return base.join(by_doc, "doc_id", "left").mapInArrow(_digest(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")


#: DuckDB SQL of the query for windows of 20 words.
ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT *, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM t
      WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (SELECT doc_id, i, word, CASE WHEN n = 20 AND row_number() OVER (PARTITION BY s, n ORDER BY doc_id, i) > 1 THEN i END AS late FROM g),
m AS (SELECT doc_id, i, word, coalesce(max(late) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) >= i - 19, false) AS gone FROM r),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
