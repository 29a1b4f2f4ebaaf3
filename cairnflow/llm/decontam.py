"""Benchmark decontamination with a generalised suffix automaton over words.

The items are cut into blocks of at most ``block_words`` words, and every block
is run against all documents. What is shipped to the executors is the words of
the blocks, compressed; a task builds one automaton at a time, streams a batch
of documents through it, and goes on to the next block. So one map does for all
blocks and a worker holds one automaton (about 100 MB for 100,000 words) however
many items there are. With a single block it is built once per task. Blocks of
more than ``ship_bytes`` compressed bytes together go in several maps, with a
written table between them. Documents stream through an automaton word by word with the length of the longest suffix
that occurs in some item. Where that length reaches ``window`` words (or a
whole shorter item has just been read) the words are hit, and the items of the
window are looked up in the automaton's state.

A document is contaminated if at least one word in ``one_in`` is hit.
``clean`` also gives the text without hit spans: ``clean_spans`` removes spans
of at least ``max_span`` words, or all where the document is contaminated.

Edge cases: null, empty and word-less texts have no words and are never
contaminated; items without words match nothing; repeated items are all
reported, those with a null id only by their hits; rows with a null ``doc_id`` are treated like any other; repeated rows
are all returned; an empty document table gives an empty result and an empty
item table hits nothing. Texts are read whole, however long; other columns of
documents and items never matter, whatever they are called.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batches, bound_batches, free_names

#: On lower-cased UTF-8 bytes: runs of digits, letters and non-ASCII bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BLOCK_WORDS = 100_000
SHIP_BYTES = 32_000_000


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each state's window-long strings."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.least = window
        numbers = [(key, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for key, words in items if words]
        ends: list[tuple[int, int, object]] = []  # (state, words read, item) of every prefix
        for key, seq in numbers:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        for key, seq in numbers:
            state = 0
            for n, c in enumerate(seq, 1):
                state = self.next[state][c]
                if len(seq) < window and n == len(seq) or n >= window:
                    ends.append((state, min(n, len(seq)) if len(seq) < window else window, key))
        self.least = min([window, *(n for _, n, _ in ends)])
        #: state -> (length of window or short item, item): looked up along suffix links, from the state that holds the string
        found: dict[int, set] = {}
        for state, n, key in ends:
            while state and self.length[self.link[state]] >= n:
                state = self.link[state]
            found.setdefault(state, set()).add((n, key))
        #: state -> all such pairs that are suffixes of its strings, longest first
        self.found: dict[int, list] = {}
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        for s in order:
            up = self.found.get(self.link[s], []) if s else []
            own = sorted(found.get(s, ()), key=lambda x: -x[0])
            if own or up:
                self.found[s] = own + up

    def _new(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(nxt)
        return len(self.link) - 1

    def _extend(self, last: int, c: int) -> int:
        there = self.next[last].get(c)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._split(last, there, c)
        new = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def _split(self, p: int, q: int, c: int) -> int:
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """([start, end) spans of hit words, items with occurring windows) of one document."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        get, nxt, link, length, found, least = self.vocab.get, self.next, self.link, self.length, self.found, self.least
        numbers = [get(w, -1) for w in words]
        at, n = 0, len(numbers)
        while at < n:
            if numbers[at] < 0:
                at += 1
                continue
            end = at
            while end < n and numbers[end] >= 0:
                end += 1
            if end - at >= least:  # a shorter run of known words holds no window
                state = size = 0
                for i in range(at, end):
                    c = numbers[i]
                    while state and c not in nxt[state]:
                        state = link[state]
                        size = length[state]
                    if c in nxt[state]:
                        state = nxt[state][c]
                        size += 1
                    if size >= least and state in found:
                        for m, key in found[state]:
                            if m <= size:
                                items.add(key)
                                if spans and spans[-1][1] >= i + 1 - m:
                                    spans[-1] = (min(spans[-1][0], i + 1 - m), i + 1)
                                else:
                                    spans.append((i + 1 - m, i + 1))
            at = end
        # a longer window can reach back over spans that came before it
        spans.sort()
        merged: list[tuple[int, int]] = []
        for s, e in spans:
            if merged and s <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
            else:
                merged.append((s, e))
        return merged, items


def item_blocks(items: DataFrame, text_col: str, id_col: str, block_words: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items streamed to the driver, at most block_words words at a time (a longer single item is a block of its own)."""
    block, size = [], 0
    for row in items.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).cast("binary").alias("t")).toLocalIterator():
        words = words_of(bytes(row.t) if row.t is not None else None)
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row.k, words))
        size += len(words)
    if block:
        yield block


class Blocks:
    """Item blocks on their way to a task: compressed words, one automaton at a time."""

    def __init__(self, window: int):
        self.window = window
        self.packed: list[bytes] = []
        self.size = 0

    def add(self, block: list[tuple[object, list[bytes]]]) -> None:
        self.packed.append(zlib.compress(pickle.dumps(block), 6))
        self.size += len(self.packed[-1])

    def matches(self, texts: list[bytes | None]) -> list[tuple[list[tuple[int, int]], set]]:
        """(hit spans, items) of each text over all blocks."""
        words = [words_of(t) for t in texts]
        out: list[tuple[list, set]] = [([], set()) for _ in texts]
        for k, packed in enumerate(self.packed):
            if getattr(self, "held", None) is None or self.held[0] != k:
                self.held = None  # the one before goes first
                self.held = (k, Automaton(pickle.loads(zlib.decompress(packed)), self.window))
            for (spans, items), w in zip(out, words, strict=True):
                s, i = self.held[1].matches(w)
                spans += s
                items |= i
        return out


def shipments(items: DataFrame, text_col: str, id_col: str, block_words: int, ship_bytes: int, window: int) -> Iterator[Blocks]:
    """The item blocks, as many together as have ``ship_bytes`` (one more may pass it)."""
    load = Blocks(window)
    for block in item_blocks(items, text_col, id_col, block_words):
        load.add(block)
        if load.size >= ship_bytes:
            yield load
            load = Blocks(window)
    if load.packed:
        yield load


def joined(source: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches, put together to about ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in source:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _scan(blocks: Blocks):
    def run(source):
        for cols in batches(source, 1 << 23 if len(blocks.packed) == 1 else 1 << 25):
            out: dict[str, list] = {"__k": cols["__k"], "__text": cols["__text"], "spans": [], "items": []}
            for (spans, items), before, seen in zip(blocks.matches(cols["__text"]), cols["spans"], cols["items"], strict=True):
                out["spans"].append(before + [{"s": s, "e": e} for s, e in spans])
                out["items"].append(sorted({x for x in items if x is not None} | set(seen)))
            types = [pa.int64(), pa.binary(), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return run


def _judge(one_in: int, max_span: int):
    def run(source):
        for cols in batches(source):
            out: dict[str, list] = {"doc_id": cols["__k"], "n_words": [], "n_hit": [], "n_items": [], "items_sha256": [], "contaminated": [], "items": [], "spans": [], "clean": []}
            for text, spans, items in zip(cols["__text"], cols["spans"], cols["items"], strict=True):
                hit, last = [], -1
                for s, e in sorted((x["s"], x["e"]) for x in spans):
                    if hit and s <= last:
                        hit[-1] = (hit[-1][0], max(last, e))
                    else:
                        hit.append((s, e))
                    last = hit[-1][1]
                n, n_hit = len(words_of(text)), sum(e - s for s, e in hit)
                bad = n_hit > 0 and n_hit * one_in >= n
                clean, pieces = text, []
                drop = [(s, e) for s, e in hit if bad or e - s >= max_span]
                if drop:
                    places = [m.span() for m in WORD.finditer(text.lower())]
                    at = 0
                    for s, e in drop:
                        pieces.append(text[at : places[s][0]])
                        at = places[e - 1][1]
                    clean = b"".join([*pieces, text[at:]])
                for k, v in (("n_words", n), ("n_hit", n_hit), ("n_items", len(items)), ("items_sha256", hashlib.sha256(",".join(items).encode()).hexdigest()), ("contaminated", bad), ("items", items), ("spans", [{"s": s, "e": e} for s, e in hit]), ("clean", clean)):
                    out[k].append(v)
            types = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id", window: int = 13, one_in: int = 20, max_span: int = 13, block_words: int = BLOCK_WORDS, ship_bytes: int = SHIP_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans (of words), clean (UTF-8 without the removed spans)."""
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "decontam")
    spans = "array<struct<s:int,e:int>>"
    out = docs.select(F.col(id_col).cast("long").alias("__k"), F.col(text_col).cast("binary").alias("__text"), F.array().cast(spans).alias("spans"), F.array().cast("array<string>").alias("items"))
    for n, load in enumerate(shipments(items, item_text, item_id, block_words, ship_bytes, window)):
        out = (scratch.save(out, f"part{n}") if n else out).mapInArrow(_scan(load), f"__k long, __text binary, spans {spans}, items array<string>")
    return out.mapInArrow(_judge(one_in, max_span), f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans {spans}, clean binary")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", item_id: str = "item_id", window: int = 13, one_in: int = 20, block_words: int = BLOCK_WORDS, ship_bytes: int = SHIP_BYTES) -> DataFrame:
    """The rows of docs, all columns as they are, that are not contaminated: maps only, no shuffle."""
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "decontam")
    (name,) = free_names(docs, "__spans")
    at = docs.columns.index(text_col)

    def scan(blocks: Blocks):
        def run(source):
            for batch in source if len(blocks.packed) == 1 else joined(source, 1 << 25):
                texts, before = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
                found = blocks.matches([t.encode() if t else None for t in texts])
                spans = pa.array([b + [list(s) for s in hit] for b, (hit, _) in zip(before, found, strict=True)], pa.list_(pa.list_(pa.int32())))
                yield batch.set_column(batch.num_columns - 1, name, spans)

        return run

    def judge(source):
        for batch in source:
            texts, found = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            clean = []
            for t, hit in zip(texts, found, strict=True):
                n = len({i for s, e in hit for i in range(s, e)})
                clean.append(not hit or n * one_in < len(words_of(t.encode())))
            yield batch.select(batch.schema.names[:-1]).filter(pa.array(clean, pa.bool_()))

    out = docs.withColumn(name, F.array().cast("array<array<int>>"))
    for n, load in enumerate(shipments(items, item_text, item_id, block_words, ship_bytes, window)):
        out = (scratch.save(out, f"part{n}") if n else out).mapInArrow(scan(load), out.schema)
    return out.mapInArrow(judge, docs.schema)


def oracle() -> str:
    """DuckDB SQL of the query for windows of 13 words, shorter items as wholes."""
    words = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    def grams(table: str, key: str, k: int, where: str) -> str:
        return f"SELECT {key}, i, {k} AS k, s FROM (SELECT {key}, i, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM {table} {where} WINDOW f AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)) WHERE n = {k}"

    doc_grams = " UNION ALL ".join(grams("t", "doc_id", k, f"WHERE EXISTS (SELECT 1 FROM iw WHERE k = {k})") for k in range(1, 14))
    item_grams = " UNION ALL ".join(grams("it", "item_id", k, f"WHERE least(len, 13) = {k}") for k in range(1, 14))
    return f"""
WITH d AS (SELECT doc_id, {words("text")} AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
ii AS (SELECT item_id, {words("text")} AS w FROM benchmark),
it AS (SELECT item_id, len(w) AS len, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM ii),
iw AS (SELECT DISTINCT item_id, k, s FROM ({item_grams})),
h AS (SELECT g.doc_id, g.i, g.k, iw.item_id FROM ({doc_grams}) g JOIN iw ON g.k = iw.k AND g.s = iw.s),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS at FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""
