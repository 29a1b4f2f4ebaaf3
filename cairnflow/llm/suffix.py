"""Exact byte-level de-duplication with an enhanced suffix array and its common-prefix interval tree.

A repeat of ``length`` bytes is found in four steps:

1. *Bring equal bytes together.* Every ``length``-byte window picks the least
   hash among its 16-byte grams (its anchor), so equal windows pick equal
   anchors at equal offsets. The windows of one anchor form one run of bytes,
   and about one byte in eighteen yields a row: anchor hash, hash of the whole
   run, document, extent.
2. *Decide whole runs.* If the same run occurs in a smaller document, all of it
   goes; only one run for each content stays open, and only where its anchor
   also has runs of other content in other documents.
3. *Suffix arrays.* The bytes of open runs are sorted as suffixes by anchor,
   with the length of the common prefix of neighbours; a stack scan turns these
   into the tree of common-prefix intervals, and intervals whose left byte
   differs are the maximal repeats, each with all its occurrences.
4. Occurrences outside the smallest document of their repeat mark their bytes.

An anchor with over ``cap`` open runs is not gathered: its windows are decided
one by one by a 128-bit hash and a minimum over Spark rows, which spill.
Repeats inside a Python batch are decided there, so a passage that a third of
all documents holds sends one row per batch to its anchor.

Edge cases: null text is empty; texts shorter than ``length`` keep all bytes;
rows with a null ``doc_id`` take no part and come back whole; rows repeating a
``doc_id`` with the same text count as one document and are all returned,
different texts under one ``doc_id`` are documents of their own in the order of
their hashes; matches inside one document never count; texts are read whole,
1 MiB at a time; an empty table gives an empty result; other columns are
ignored, whatever they are called.

Most repeats are copies of whole runs and decided in step 2 by two 64-bit hashes
(anchor and run). Suffix arrays see the open runs only, each of at most
2 * length - gram bytes, so a longer repeat appears as the repeats of its runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, batches, combine, cover, identified, marks_by_doc, minimizers, release, runs_of, signed

GRAM = 16
BLOCK = 1 << 20
_FACTOR = 0xD6E8FEB86659FD93
#: ab is length * first window + (last - first). A row with known holds all runs of a document that a batch has decided, under a key of its own.
_RUNS = "h long, ctx long, doc_id long, ab long, known binary"
_BYTES = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, 256, dtype=np.uint64)


# --- the enhanced suffix array -------------------------------------------------


def suffix_array(texts: list[bytes], group: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """Sorted suffixes of at least ``least`` bytes of all texts, group by group, and the common prefix of each with the one before.

    Returns ``text`` (index), ``start``, ``lcp`` (0 at the first and where the
    group changes) and ``left`` (the byte before, or a value of its own).
    """
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    width = int(sizes.max())
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    buf = np.frombuffer(b"".join(texts) + bytes(width), np.uint8)
    n = np.maximum(sizes - least + 1, 0)
    which = np.repeat(np.arange(len(texts)), n)
    start = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    rest = sizes[which] - start
    rows = np.lib.stride_tricks.sliding_window_view(buf, width)[base[which] + start].copy()
    rows[np.arange(width)[None, :] >= rest[:, None]] = 0
    key = np.empty((len(rows), width + 8), np.uint8)
    key[:, :8] = group[which].astype(">u8").view(np.uint8).reshape(-1, 8)
    key[:, 8:] = rows
    order = np.argsort(key.view(f"S{width + 8}").ravel(), kind="stable")
    which, start, rest, rows = which[order], start[order], rest[order], rows[order]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = rows[1:] != rows[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
        lcp[1:] = np.where(group[which[1:]] == group[which[:-1]], common, 0)
    at = base[which] + start
    left = np.where(start > 0, buf[np.maximum(at - 1, 0)].astype(np.int64), -1 - np.arange(len(order)))
    return {"text": which, "start": start, "lcp": lcp, "left": left}


def intervals(lcp: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of one stretch: (common prefix, first, last) of each common-prefix interval of ``least`` or more whose left bytes differ.

    ``lcp[i]`` is the common prefix of suffix i with suffix i-1; ``lcp[0]`` is not read.
    """
    diverse = None
    stack: list[list] = []  # [prefix length, first suffix, left byte shared so far, or None if they differ]

    def join(a, b):
        return a if a == b else diverse

    for i in range(1, len(lcp) + 1):
        height = lcp[i] if i < len(lcp) else 0
        first, lefts = i - 1, left[i - 1]
        while stack and stack[-1][0] > height:
            size, first, seen = stack.pop()
            lefts = join(seen, lefts)
            if size >= least and lefts is diverse:
                yield size, first, i - 1
        if height >= least:
            if stack and stack[-1][0] == height:
                stack[-1][2] = join(stack[-1][2], lefts)
            else:
                stack.append([height, first, lefts])


def maximal_repeats(texts: list[bytes], group: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, text indexes, starts) of every maximal repeat of at least ``least`` bytes, with all its occurrences."""
    sa = suffix_array(texts, group, least)
    lcp = sa["lcp"]
    high = lcp >= least
    edges = np.flatnonzero(np.diff(np.concatenate([[False], high, [False]]).astype(np.int8)))
    for lo, hi in zip(edges[::2] - 1, edges[1::2], strict=True):  # suffixes lo .. hi-1 hang together
        for size, first, last in intervals(lcp[lo:hi].tolist(), sa["left"][lo:hi].tolist(), least):
            yield size, sa["text"][lo + first : lo + last + 1], sa["start"][lo + first : lo + last + 1]


# --- step 1: anchors and runs --------------------------------------------------


def gram_hashes(piece: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of every ``gram`` consecutive bytes by doubling, mixed at the end."""
    h, size = _BYTES[piece], 1
    with np.errstate(over="ignore"):
        while size < gram:
            step = min(size, gram - size)
            g = h[: len(h) - step] * np.uint64(pow(_FACTOR, step, 1 << 64))
            g += h[step:]
            h, size = g, size + step
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def anchor_runs(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, run hash, first window, last window) for one text, block by block."""
    out = []
    digest = xxhash.xxh3_64_intdigest
    view = memoryview(text)
    for at in range(0, len(text) - length + 1, BLOCK):
        piece = np.frombuffer(text, np.uint8, min(BLOCK + length - 1, len(text) - at), at)
        h = gram_hashes(piece, gram)
        anchor = minimizers(h, length - gram + 1)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(anchor)) - 1
        ctx = [digest(view[i:j]) for i, j in zip((first + at).tolist(), (last + at + length).tolist(), strict=True)]
        out.append((h[anchor[first]], np.array(ctx, np.uint64), first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))


def _runs(length: int, gram: int):
    def run(source):
        for cols in batches(source):
            parts = [(d, anchor_runs(t, length, gram)) for d, t in zip(cols["doc_id"], cols["__text"], strict=True) if d is not None and t and len(t) >= length]
            if not parts:
                continue
            doc = np.concatenate([np.full(len(p[0]), d, np.int64) for d, p in parts])
            h, ctx, a, b = (np.concatenate([p[i] for _, p in parts]) for i in range(4))
            ab = a * length + (b - a)  # a run has fewer than length windows
            order = np.lexsort((ab, doc, ctx, h))
            h, ctx, doc, ab = h[order], ctx[order], doc[order], ab[order]
            new = runs_of(np.arange(len(h)), h, ctx)
            least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
            known = doc > least  # the same run is in a smaller document of this batch
            again = ~new & (np.diff(doc, prepend=-1) == 0) & (np.diff(ab, prepend=-1) == 0)  # a repeated row
            sent = ~known & ~again
            n = int(sent.sum())
            yield pa.RecordBatch.from_arrays([pa.array(signed(h[sent])), pa.array(signed(ctx[sent])), pa.array(doc[sent]), pa.array(ab[sent]), pa.nulls(n, pa.binary())], names=["h", "ctx", "doc_id", "ab", "known"])
            known &= ~again
            if known.any():
                order = np.argsort(doc[known], kind="stable")
                kd, kab = doc[known][order], ab[known][order]
                cuts = np.flatnonzero(np.diff(kd)) + 1
                ids = kd[np.concatenate([[0], cuts])]
                blobs = [x.tobytes() for x in np.split(kab, cuts)]
                own = combine(ids.view(np.uint64), kab[np.concatenate([[0], cuts])].view(np.uint64), 77)
                yield pa.RecordBatch.from_arrays([pa.array(signed(own)), pa.nulls(len(ids), pa.int64()), pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(blobs, pa.binary())], names=["h", "ctx", "doc_id", "ab", "known"])

    return run


# --- steps 2 to 4 --------------------------------------------------------------


def _open_bytes(length: int):
    def run(source):
        for cols in batches(source):
            h, doc, at, data = [], [], [], []
            for d, t, marks in zip(cols["doc_id"], cols["__text"], cols["__marks"], strict=True):
                for m in marks:
                    if m["b"] + length <= len(t or b""):
                        h.append(m["h"])
                        doc.append(d)
                        at.append(m["a"])
                        data.append(t[m["a"] : m["b"] + length])
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int32()), pa.array(data, pa.binary())], names=["h", "doc_id", "a", "data"])

    return run


_FOUND = "w1 long, w2 long, doc_id long, s int, e int"


def _found(w1, w2, doc, s, e) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(w1, pa.int64()), pa.array(w2, pa.int64()), pa.array(doc, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["w1", "w2", "doc_id", "s", "e"])


def _repeats(length: int, cap: int, room: int = 1 << 20):
    """Reads open runs sorted by anchor. Yields marks (w1 null), or the windows of an anchor with over cap runs (w1, w2 set)."""

    def solve(groups: list[tuple[list, list, list]]) -> pa.RecordBatch:
        texts = [t for g in groups for t in g[2]]
        doc = np.array([d for g in groups for d in g[0]], np.int64)
        at = np.array([a for g in groups for a in g[1]], np.int64)
        group = np.repeat(np.arange(len(groups)), [len(g[0]) for g in groups])
        docs, starts, ends = [], [], []
        for size, text, start in maximal_repeats(texts, group, length):
            d = doc[text]
            late = d > d.min()
            if late.any():
                docs.append(d[late])
                s = (at[text] + start)[late]
                starts.append(s)
                ends.append(s + size)
        docs, starts, ends = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (docs, starts, ends))
        return _found([None] * len(docs), [None] * len(docs), docs, starts, ends)

    def spill(doc: list, at: list, data: list) -> pa.RecordBatch:
        digest = xxhash.xxh3_128_intdigest
        w, docs, starts = [], [], []
        for d, a, t in zip(doc, at, data, strict=True):
            for i in range(len(t) - length + 1):
                w.append(digest(t[i : i + length]))
                docs.append(d)
                starts.append(a + i)
        half = 1 << 64
        w1 = np.array([x // half for x in w], np.uint64).view(np.int64)
        w2 = np.array([x % half for x in w], np.uint64).view(np.int64)
        return _found(w1, w2, docs, starts, np.asarray(starts, np.int64) + length)

    def run(source):
        key, doc, at, data, hot = None, [], [], [], False
        ready: list[tuple[list, list, list]] = []
        size = 0
        for cols in batches(source):
            h = np.array(cols["h"], np.int64)
            edges = [0, *(np.flatnonzero(np.diff(h)) + 1).tolist(), len(h)] if len(h) else [0]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if h[lo] != key:
                    if not hot and len(doc) > 1:
                        ready.append((doc, at, data))
                        size += sum(map(len, data))
                    key, doc, at, data, hot = h[lo], [], [], [], False
                doc += cols["doc_id"][lo:hi]
                at += cols["a"][lo:hi]
                data += cols["data"][lo:hi]
                if hot or len(doc) > cap:
                    hot = True
                    yield spill(doc, at, data)
                    doc, at, data = [], [], []
                if size > room:
                    yield solve(ready)
                    ready, size = [], 0
        if not hot and len(doc) > 1:
            ready.append((doc, at, data))
        if ready:
            yield solve(ready)

    return run


def repeated_spans(base: DataFrame, length: int = 50, gram: int = GRAM, cap: int = 20_000) -> DataFrame:
    """base: (doc_id, __text) with one text per id -> (doc_id, s, e): byte spans covered by ``length``-byte strings that also start in a smaller document."""
    spark = base.sparkSession
    scratch = Scratch(spark, "suffix")
    base = base.select("doc_id", "__text")
    by_run, by_anchor = Window.partitionBy("h", "ctx"), Window.partitionBy("h")
    runs = base.mapInArrow(_runs(length, min(gram, length)), _RUNS).withColumn("mn", F.min("doc_id").over(by_run))
    for name, f, c in (("dlo", F.min, "doc_id"), ("dhi", F.max, "doc_id"), ("clo", F.min, "ctx"), ("chi", F.max, "ctx")):
        runs = runs.withColumn(name, f(c).over(by_anchor))
    gone = F.col("known").isNotNull() | (F.col("doc_id") > F.col("mn"))
    runs = runs.select("h", "doc_id", "ab", "known", gone.alias("gone"), (~gone & (F.col("dlo") < F.col("dhi")) & (F.col("clo") < F.col("chi"))).alias("open")).where("gone or open")
    runs = scratch.save(runs.withColumn("h", F.when(F.col("open"), F.col("h"))), "runs")
    release(spark)
    start = F.expr(f"ab div {length}")
    by_doc = marks_by_doc(runs.where("open").select("h", "doc_id", start.alias("a"), (start + F.col("ab") % length).alias("b")), "doc_id", "h", "a", "b").hint("shuffle_hash")
    rows = base.join(by_doc, "doc_id").mapInArrow(_open_bytes(length), "h long, doc_id long, a int, data binary")
    found = scratch.save(rows.repartition("h").sortWithinPartitions("h", "doc_id", "a").mapInArrow(_repeats(length, cap), _FOUND), "found")
    del rows
    release(spark)
    hot = found.where("w1 is not null").withColumn("mn", F.min("doc_id").over(Window.partitionBy("w1", "w2"))).where("doc_id > mn")
    whole = runs.where("gone and known is null").select("doc_id", start.cast("int").alias("s"), (start + F.col("ab") % length + length).cast("int").alias("e"))
    known = runs.where("known is not null").mapInArrow(_unpack(length), "doc_id long, s int, e int")
    return whole.unionByName(known).unionByName(found.where("w1 is null").select("doc_id", "s", "e")).unionByName(hot.select("doc_id", "s", "e"))


def _unpack(length: int):
    def run(source):
        for batch in source:
            ids, blobs = batch.column("doc_id").to_pylist(), batch.column("known").to_pylist()
            for d, blob in zip(ids, blobs, strict=True):
                ab = np.frombuffer(blob, np.int64)
                s = ab // length
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ab), d, np.int64)), pa.array(s.astype(np.int32)), pa.array((s + ab % length + length).astype(np.int32))], names=["doc_id", "s", "e"])

    return run


def _digest(source):
    for cols in batches(source):
        out = {"doc_id": cols["__id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        for text, marks in zip(cols["__text"], cols["__marks"], strict=True):
            text = text or b""
            kept, gone, spans = text, 0, 0
            if marks:
                dead = cover(len(text), np.array([m["s"] for m in marks], np.int64), np.array([m["e"] for m in marks], np.int64))
                kept = np.frombuffer(text, np.uint8)[~dead].tobytes()
                gone, spans = int(dead.sum()), int((np.diff(dead.astype(np.int8), prepend=0) == 1).sum())
            for k, v in (("n_bytes", len(text)), ("n_removed", gone), ("n_spans", spans), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept)):
                out[k].append(v)
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))


def remove_repeated_bytes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = 50, gram: int = GRAM, cap: int = 20_000) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining bytes (``kept``)."""
    base = identified(docs, text_col, id_col, Scratch(docs.sparkSession, "texts"))
    spans = marks_by_doc(repeated_spans(base, length, gram, cap), "doc_id", "s", "e").hint("shuffle_hash")
    return base.join(spans, "doc_id", "left").mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


#: DuckDB SQL of the query for strings of 50 bytes, as hex digits: windows are cut from blocks, grouped by a 128-bit hash and compared as strings where a hash spans documents.
ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, o, substr(h, 2 * o + 1, 2 * (256 + 49)) AS part FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 256)) AS o FROM d)),
w AS (SELECT doc_id, o + i AS i, o, md5_number(substr(part, 2 * i - 1, 100)) AS k
      FROM (SELECT doc_id, o, part, unnest(range(1, least(257, length(part) // 2 - 48))) AS i FROM b)),
g AS (SELECT k FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
c AS (SELECT w.doc_id, w.i, substr(b.part, 2 * (w.i - w.o) - 1, 100) AS s FROM w SEMI JOIN g ON w.k = g.k JOIN b ON w.doc_id = b.doc_id AND w.o = b.o),
f AS (SELECT s, min(doc_id) AS least FROM c GROUP BY s),
r AS (SELECT c.doc_id, c.i FROM c JOIN f ON c.s = f.s WHERE f.least < c.doc_id),
o AS (SELECT doc_id, i, coalesce(i - lag(i) OVER p > 50, true) AS opens FROM r WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM o),
s AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, span),
e AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS before FROM s),
k AS (SELECT e.doc_id, count(*) AS n_spans, sum(e.b - e.a) AS n_removed, max(e.b) AS last,
             string_agg(substr(d.h, 2 * e.before - 1, 2 * (e.a - e.before)), '' ORDER BY e.a) AS kept FROM e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 1) - 1))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
