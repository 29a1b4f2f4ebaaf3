"""Near-duplicates by 64-bit SimHash and a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at
most ``d`` bits differ in at most ``d`` bytes, so they share at least
``8 - d`` positional bytes: the guaranteed minimum of matches.

A list of one byte at one position holds a 256th of all fingerprints, far too
many to walk for each of them, so the index is cut into cells: fingerprints
that agree on ``meet`` of the first ``d + meet`` positions. Any ``8 - d``
positions have at least ``meet`` there, so every pair to be found shares a
cell. Inside a cell every (position, byte) has its posting list, and walking the
lists of a fingerprint's bytes tallies what it shares with each of the others.
Pairs under the minimum are dropped, the rest is verified by the number of
differing bits. Of the verified pairs of a cell only a spanning forest leaves
the task, so a group of m near copies yields at most m rows per cell, never
m^2. Equal fingerprints are one posting, whatever the number of their documents.

A cell with over ``cap`` fingerprints is not tallied. Its
fingerprints are linked exactly by midpoints instead: two are within ``d`` bits
if and only if some 64-bit word is within d//2 bits of one and d - d//2 of the
other, so all fingerprints meeting at a word are linked to its least one.

Classes come from connected components over tables (no link or component is
ever collected). ``one_of_each`` keeps one document of each class; with a
``similarity`` it works on the wide fingerprints of ``simhash_wide`` instead.

Edge cases: null and empty texts and texts without words have fingerprint 0 and
are linked like any other; rows with a null ``doc_id`` keep their fingerprint
and join their class, but are never its representative; repeated rows are all
returned; an empty table gives an empty result. Texts are read whole, however
long, with counts kept for 65,536 shingles at a time. Columns of docs other
than the two named never matter, whatever they are called.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash_wide
from .common import Scratch, batches, free_names, signed
from .components import connected_components

SEED = 42
SALTS = 8


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """SimHash of one text: a bit is set if over half of the shingle hashes have it."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        h = np.array([digest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int("".join("1" if x else "0" for x in (ones * 2 > len(h)).tolist()), 2)


def _fingerprints(width: int):
    def run(source):
        for cols in batches(source):
            f = np.array([fingerprint(t, width) for t in cols["__text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(signed(f), pa.int64())], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("__text")).mapInArrow(_fingerprints(width), "doc_id long, fp long")


def cells(bits: int, meet: int) -> list[tuple[int, ...]]:
    """The choices of positions whose bytes name a cell: of 8 - bits shared positions at least ``meet`` are among the first bits + meet."""
    meet = min(meet, 8 - bits)
    return list(combinations(range(bits + meet), meet))


def _postings(bits: int, meet: int):
    masks = [sum(0xFF << (8 * p) for p in c) for c in cells(bits, meet)]

    def run(source):
        for batch in source:
            f = batch.column(0).to_numpy().view(np.uint64)
            for k, m in enumerate(masks):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), k, np.int32)), pa.array(signed(f & np.uint64(m))), pa.array(signed(f))], names=["slot", "bytes", "fp"])

    return run


class Postings:
    """The posting lists of one cell: for every position, the fingerprints in order of their byte there."""

    def __init__(self, f: np.ndarray):
        self.byte = np.ascontiguousarray(f).view(np.uint8).reshape(-1, 8)
        self.varied = [p for p in range(8) if (self.byte[:, p] != self.byte[0, p]).any()]
        self.shared = 8 - len(self.varied)  # positions where the whole cell is one list
        self.order = {p: np.argsort(self.byte[:, p], kind="stable") for p in self.varied}
        self.start = {p: np.searchsorted(self.byte[self.order[p], p], np.arange(257)) for p in self.varied}

    def tally(self, k: int) -> np.ndarray:
        """How many positional bytes fingerprint k shares with each of the cell."""
        count = np.full(len(self.byte), self.shared, np.int8)
        for p in self.varied:
            b = int(self.byte[k, p])
            count[self.order[p][self.start[p][b] : self.start[p][b + 1]]] += 1
        return count


def forest(f: np.ndarray, bits: int, least: int, seen: dict | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links among the distinct fingerprints of a cell. ``seen`` counts the pairs tallied and those under the minimum."""
    out: list[tuple[int, int]] = []
    if len(f) == 2:  # most cells: the two lists to walk are one pair
        differ = f[0] ^ f[1]
        shared = int((f[:1] ^ f[1:]).view(np.uint8).tolist().count(0))
        if seen is not None:
            seen["pairs"] = seen.get("pairs", 0) + 1
            seen["under"] = seen.get("under", 0) + (shared < least)
        return [(f[0], f[1])] if shared >= least and int(differ).bit_count() <= bits else []
    index = Postings(f)
    apart = np.ones(len(f), bool)  # not yet reached
    for root in range(len(f)):
        if not apart[root]:
            continue
        apart[root] = False
        front = [root]
        while front:
            k = front.pop()
            count = index.tally(k)
            if seen is not None:
                seen["pairs"] = seen.get("pairs", 0) + int(apart.sum())
                seen["under"] = seen.get("under", 0) + int((apart & (count < least)).sum())
            met = np.flatnonzero(apart & (count >= least))
            new = met[np.bitwise_count(f[met] ^ f[k]) <= bits]
            if len(new):
                out += [(f[k], y) for y in f[new]]
                apart[new] = False
                front += new.tolist()
            if not apart.any():
                return out
    return out


def _links(kind: int, u, v) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(signed(np.array(u, np.uint64))), pa.array(signed(np.array(v, np.uint64)))], names=["kind", "u", "v"])


def _compare(bits: int, least: int, cap: int):
    """Reads postings sorted by list. Yields the links of each list (kind 0), or the members of a list of over cap (kind 1)."""

    def run(source):
        slot, part, fp = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)
        hot = None  # the list that has passed cap and goes on

        def lists(last: bool):
            """Decides all complete lists; what is left may go on in the next batch."""
            nonlocal slot, part, fp
            new = np.flatnonzero((np.diff(slot) != 0) | (np.diff(part) != 0)) + 1
            edges = np.concatenate([[0], new, [len(fp)]]).astype(np.int64)
            lo, hi = (edges[:-1], edges[1:]) if last else (edges[:-2], edges[1:-1])
            links = [x for i, j in zip(lo[hi - lo > 1].tolist(), hi[hi - lo > 1].tolist(), strict=True) for x in forest(fp[i:j], bits, least)]
            at = len(fp) if last else int(edges[-2])
            slot, part, fp = slot[at:], part[at:], fp[at:]
            return _links(0, [a for a, _ in links], [b for _, b in links])

        for batch in source:
            s, b, f = (batch.column(i).to_numpy() for i in range(3))
            f = f.view(np.uint64)
            if hot is not None:
                same = (s == hot[0]) & (b == hot[1])
                yield _links(1, f[same], f[same])
                s, b, f = s[~same], b[~same], f[~same]
                if len(f):
                    hot = None
            if not len(f):
                continue
            slot, part, fp = np.concatenate([slot, s]), np.concatenate([part, b]), np.concatenate([fp, f])
            yield lists(False)
            if len(fp) > cap:
                hot = (slot[0], part[0])
                yield _links(1, fp, fp)
                slot, part, fp = slot[:0], part[:0], fp[:0]
        if len(fp):
            yield lists(True)

    return run


def ball(bits: int) -> np.ndarray:
    """All 64-bit words with at most ``bits`` ones."""
    return np.array([sum(1 << p for p in c) for n in range(bits + 1) for c in combinations(range(64), n)], np.uint64)


def _midpoints(bits: int):
    masks, inner = ball(bits - bits // 2), len(ball(bits // 2))

    def run(source):
        for batch in source:
            for x in batch.column(0).to_numpy().view(np.uint64):
                yield pa.RecordBatch.from_arrays([pa.array(signed(masks ^ x)), pa.array(np.full(len(masks), x, np.uint64).view(np.int64)), pa.array(np.arange(len(masks)) < inner)], names=["mid", "fp", "inner"])

    return run


def midpoint_links(fps: DataFrame, bits: int) -> DataFrame:
    """Links (u, v) that join exactly the fingerprints within ``bits`` of each other, by words within half of that from both."""
    mids = fps.mapInArrow(_midpoints(bits), "mid long, fp long, inner boolean")
    least = mids.groupBy("mid").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("v"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("v is not null and lo < hi")
    return mids.join(least.select("mid", "v"), "mid").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def linked_roots(nodes: DataFrame, scratch: Scratch, bits: int, cap: int = 8192, meet: int = 3) -> DataFrame:
    """(node, root) of every distinct fingerprint that has a link; root is the least fingerprint that links reach."""
    if not 0 <= bits < 8:
        raise ValueError("a byte-position index needs bits from 0 to 7")
    postings = nodes.mapInArrow(_postings(bits, meet), "slot int, bytes long, fp long")
    met = postings.repartition("slot", "bytes").sortWithinPartitions("slot", "bytes", "fp").mapInArrow(_compare(bits, 8 - bits, cap), "kind int, u long, v long")
    met = scratch.save(met, "met")
    hot = met.where("kind = 1").select(F.col("u").alias("fp")).distinct()
    edges = met.where("kind = 0").select("u", "v")
    if not hot.isEmpty():
        edges = edges.unionByName(midpoint_links(scratch.save(hot, "hot"), bits))
    return scratch.save(connected_components(edges), "roots")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bits: int = 4, width: int = 4, cap: int = 8192, meet: int = 3) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the least doc_id that links reach).

    ``meet`` positional bytes name a cell: 3 for up to about 10^10 fingerprints (a cell then holds some 600 unrelated ones), 4 beyond.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.save(fingerprints(docs, text_col, id_col, width), "fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    roots = linked_roots(nodes.select("fp"), scratch, bits, cap, meet)
    tied = nodes.join(roots, nodes.fp == roots.node)
    least = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    classes = nodes.join(linked, "fp", "left").select("fp", "n", "first", F.coalesce("component_id", "first").alias("component_id"))
    # a fingerprint of one document is its own row; the documents of a shared one are dealt out by document, not by fingerprint
    alone = classes.where("n = 1").select(F.col("first").alias("doc_id"), "fp", "component_id")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    shared = classes.where("n > 1").select("fp", "component_id", salts.alias("salt"))
    dealt = fps.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    out = alone.unionByName(dealt.join(shared, ["fp", "salt"]).select("doc_id", "fp", "component_id"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bits: int = 4, width: int = 4, similarity: float | None = None) -> DataFrame:
    """The documents that represent their class: of every class the row with the least doc_id stays, all columns as they are.

    Classes are those of ``near_duplicates``; with a ``similarity``, those of texts whose sets of ``width``-word shingles have it (``simhash_wide``).
    Rows that repeat both id and text stay together; other texts under the same id are texts of their own; a row with a null doc_id stays
    where its class has no row with one (of several, the one with the least text hash).
    """
    scratch = Scratch(docs.sparkSession, "one_of_each")
    if similarity is not None:
        rows = scratch.save(simhash_wide.classes(docs, text_col, id_col, similarity, width), "classes")
    else:
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).cast("binary").alias("__text"))
        fps = scratch.save(texts.mapInArrow(_text_fingerprints(width), "id long, t long, fp long"), "fps")
        roots = linked_roots(fps.select("fp").distinct(), scratch, bits)
        rows = scratch.save(fps.join(roots, fps.fp == roots.node, "left").select("id", "t", F.coalesce("root", "fp").alias("cls")), "classes")
    return keep_first(docs, rows, scratch, text_col, id_col)


def _text_fingerprints(width: int):
    def run(source):
        for cols in batches(source):
            f = np.array([fingerprint(t, width) for t in cols["__text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(cols["id"], pa.int64()), pa.array(cols["t"], pa.int64()), pa.array(signed(f), pa.int64())], names=["id", "t", "fp"])

    return run


def keep_first(docs: DataFrame, rows: DataFrame, scratch: Scratch, text_col: str, id_col: str) -> DataFrame:
    """docs without the rows that are not the first of their class. rows: (id, t, cls), t the xxhash64 of the text."""
    me = F.struct(F.col("id").isNull().alias("absent"), "id", "t")
    best = rows.groupBy("cls").agg(F.min(me).alias("best"), F.max(me).alias("last")).where(~F.col("best").eqNullSafe(F.col("last"))).drop("last")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("id", "t"), F.lit(SALTS)).cast("int"))
    gone = dealt.join(best.withColumn("salt", salts), ["cls", "salt"]).where(~me.eqNullSafe(F.col("best"))).select("id", "t").distinct()
    gone = scratch.save(gone, "gone")
    i, t = free_names(docs, "__i", "__t")
    out = docs.join(gone.select(F.col("id").alias(i), F.col("t").alias(t)), F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(t)), "left_anti")
    return out.select(*[docs[c] for c in docs.columns])
