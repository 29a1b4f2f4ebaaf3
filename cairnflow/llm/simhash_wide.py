"""SimHash classes of a word-shingle similarity: wide fingerprints for the near-duplicate operator.

Texts whose shingle sets have a Jaccard similarity of 0.8 differ in about 15 of
every 100 SimHash bits, far more than a 64-bit index can allow for. Here the
fingerprint of the set of ``width``-word shingles has ``BYTES`` positional
bytes, and the steps are those of the narrow one:

1. *Index.* Cells are named by three positional bytes. ``KEYS`` triples, each
   position in equally many, give every fingerprint its postings. A posting
   carries 48 bits of the fingerprint and 16 of its text's hash, which tell it
   from equal ones; one with no other within reach of the 48 bits in its cell
   drops out, so only what has a likely partner goes on. The triples are taken in
   ``PASSES``, which bounds the disk that postings take. The fingerprint then
   comes to all its remaining postings at once.
2. *Count filter.* In a cell the positional bytes that two fingerprints share
   are tallied. ``bounds`` gives the least tally and the largest number of
   differing bits that a pair of the wanted similarity has, three standard
   deviations below and above its mean.
3. *Verify.* The Jaccard similarity of the full shingle sets is computed for
   every pair that passes; only verified pairs are links. The sets come from a
   second pass over the texts, which picks by a bitmap of fixed size those that
   have a posting left; no text is shuffled.

A cell is decided in two steps: first its members against one hub each, which
is verified and makes classes, then pairs of different classes only. A group of
m copies so costs m verified pairs a cell, not m^2. Unlike the 4-bit links of
the narrow index these links are found with high probability, not certainly:
a pair of exactly the wanted 0.8 shares a cell in about 97 of 100 cases, one of
0.85 in over 99 (README). What is linked is always verified.

Sets are compared by 64-bit shingle hashes. Texts with equal sets are one node;
texts without words have the empty set and are one node too. A text of fewer
than ``width`` words is one shingle. Null texts are empty.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batches, combine, release, runs_of, signed
from .components import connected_components

BYTES = 128
KEYS = 210
PASSES = 3
PLACES = 24
LEAD = np.uint64((1 << 48) - 1)
SEED = 42


def shingles(text: bytes | None, width: int = 5) -> np.ndarray:
    """The distinct shingle hashes of one text, A-Z in lower case, ascending."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - width + 1
    return np.unique(np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, n))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """BYTES positional bytes: a bit is set if over half of the hashes, mixed anew for every 64 bits, have it."""
    out = np.empty(BYTES, np.uint8)
    for k in range(BYTES // 8):
        mixed = combine(h, np.broadcast_to(np.uint64(k + 1), h.shape), SEED + k)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 14):
            bits = np.unpackbits(mixed[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int32)
        out[8 * k : 8 * k + 8] = np.packbits(ones * 2 > len(h))
    return out


def triples(keys: int = KEYS) -> np.ndarray:
    """``keys`` triples of positions: shuffles of all positions, cut in threes."""
    rng = np.random.Generator(np.random.PCG64(5))
    rounds = -(-keys // (BYTES // 3))
    return np.concatenate([rng.permutation(BYTES)[: BYTES // 3 * 3].reshape(-1, 3) for _ in range(rounds)])[:keys]


def bounds(similarity: float, spread: float = 3.0) -> tuple[int, int, int]:
    """(least tally, most differing bits, most differing bits of the first 48) of a pair of that Jaccard similarity."""
    turn = math.acos(2 * similarity / (1 + similarity)) / math.pi if similarity < 1 else 0.0
    same = (1 - turn) ** 8

    def above(n, p, by):
        return math.ceil(n * p + by * math.sqrt(n * p * (1 - p)))

    tally = math.floor(BYTES * same - spread * math.sqrt(BYTES * same * (1 - same)))
    return max(3, tally), above(8 * BYTES, turn, spread), min(48, above(48, turn, 4.3))


def _leads(prints: list[bytes], nodes: np.ndarray) -> np.ndarray:
    first = np.array([int.from_bytes(f[:6], "little") for f in prints], np.uint64)
    return first | (nodes & ~LEAD)


def _sets(width: int):
    def run(source):
        for cols in batches(source):
            sets = [shingles(t, width) for t in cols["__text"]]
            nodes = np.array([xxhash.xxh64_intdigest(h.tobytes()) for h in sets], np.uint64)
            prints = [wide_fingerprint(h).tobytes() for h in sets]
            yield pa.RecordBatch.from_arrays([pa.array(cols["id"], pa.int64()), pa.array(cols["t"], pa.int64()), pa.array(signed(nodes)), pa.array(prints, pa.binary()), pa.array(signed(_leads(prints, nodes)))], names=["id", "t", "node", "fp", "lead"])

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BYTES)


def _postings(keys: range):
    def run(source):
        places = triples()[keys.start : keys.stop]
        for batch in source:
            byte = _matrix(batch.column(batch.schema.get_field_index("fp")))
            lead = batch.column(batch.schema.get_field_index("lead")).to_numpy()
            cell = byte[:, places].astype(np.int64) @ np.array([1, 1 << 8, 1 << 16]) + (np.array(keys, np.int64) << 24)[None, :]
            for at in range(0, len(byte), 256):
                part = cell[at : at + 256]
                yield pa.RecordBatch.from_arrays([pa.array(part.ravel()), pa.array(np.repeat(lead[at : at + 256], part.shape[1]))], names=["cell", "lead"])

    return run


def whole_lists(source, key: str, columns: list[str]):
    """Column arrays of a sorted stream, cut so that a list of equal keys is never split."""
    held: list[list] = []
    for batch in source:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        cols = [_matrix(c) if pa.types.is_binary(c.type) else c.to_numpy() for c in cols]
        k = cols[columns.index(key)]
        if held and held[-1][columns.index(key)][-1] == k[-1]:
            held.append(cols)
            continue
        cut = int(np.searchsorted(k, k[-1]))
        if cut:
            held.append([c[:cut] for c in cols])
        if held:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
        held = [[c[cut:] for c in cols]]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _met(reach: int, wide: int = 64):
    """Reads (cell, lead) sorted. Yields the postings that have another within ``reach`` bits of the lead; of lists of over ``wide``, all."""

    def run(source):
        for cell, lead in whole_lists(source, "cell", ["cell", "lead"]):
            f = lead.view(np.uint64)
            fresh = np.ones(len(f), bool)  # equal leads are one posting
            fresh[1:] = (cell[1:] != cell[:-1]) | (f[1:] != f[:-1])
            twice = np.zeros(len(f), bool)
            twice[:-1] = ~fresh[1:]
            keep = twice[fresh]
            cell, f = cell[fresh], f[fresh]
            new = runs_of(np.arange(len(f)), cell)
            size = np.diff(np.append(np.flatnonzero(new), len(f)))[np.cumsum(new) - 1]
            keep |= size > wide
            step = 1
            at = np.flatnonzero((size > 1) & (size <= wide))
            while len(at):
                at = at[at + step < len(f)]
                at = at[cell[at + step] == cell[at]]
                near = at[np.bitwise_count((f[at] ^ f[at + step]) & LEAD) <= reach]
                keep[near] = keep[near + step] = True
                step += 1
            yield pa.RecordBatch.from_arrays([pa.array(cell[keep]), pa.array(signed(f[keep]))], names=["cell", "lead"])

    return run


def tally(byte: np.ndarray, k: int, rest: np.ndarray) -> np.ndarray:
    """How many positional bytes member k of a cell shares with each of ``rest``."""
    return (byte[rest] == byte[k]).sum(axis=1)


def _near(byte: np.ndarray, k: int, rest: np.ndarray, least: int, most: int) -> np.ndarray:
    rest = rest[tally(byte, k, rest) >= least]
    differ = np.bitwise_count(byte[rest].view(np.uint64) ^ byte[k : k + 1].view(np.uint64)).sum(axis=1, dtype=np.int64)
    return rest[differ <= most]


def hub_pairs(byte: np.ndarray, least: int, most: int, look: int = 128) -> list[tuple[int, int]]:
    """Every member of a cell that is near a hub, with it; whoever is near a hub is none.

    As long as hubs have over a twentieth of the cell near them, the next is the one of ``look`` members spread over the cell that most of these are near; then they come in order.
    """
    out: list[tuple[int, int]] = []
    rest, probe = np.arange(len(byte)), len(byte) > 2
    while len(rest) > 1:
        hub = int(rest[0])
        if probe:
            some = rest[:: -(-len(rest) // look)]
            fame = [len(_near(byte, k, some, least, most)) for k in some.tolist()]
            hub = int(some[int(np.argmax(fame))])
        rest = rest[rest != hub]
        near = _near(byte, hub, rest, least, most)
        out += [(hub, j) for j in near.tolist()]
        probe = probe and 20 * len(near) > len(rest) + 1
        rest = np.setdiff1d(rest, near, assume_unique=True)
    return out


def class_pairs(byte: np.ndarray, cls: np.ndarray, least: int, most: int) -> list[tuple[int, int]]:
    """All near pairs of a cell that are of different classes."""
    out: list[tuple[int, int]] = []
    if (cls == cls[0]).all():
        return out
    for k in range(len(byte) - 1):
        rest = np.flatnonzero(cls[k + 1 :] != cls[k]) + k + 1
        if len(rest):
            out += [(k, j) for j in _near(byte, k, rest, least, most).tolist()]
    return out


def _pairs(least: int, most: int, hubs: bool):
    def run(source):
        for cell, node, cls, byte in whole_lists(source, "cell", ["cell", "node", "cls", "fp"]):
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
            found: set[tuple[int, int]] = set()
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if hi - lo < 2:
                    continue
                part = byte[lo:hi]
                pairs = hub_pairs(part, least, most) if hubs else class_pairs(part, cls[lo:hi], least, most)
                names = node[lo:hi].tolist()
                found.update((min(names[i], names[j]), max(names[i], names[j])) for i, j in pairs)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return run


def bitmap(t: DataFrame) -> np.ndarray:
    """The first 24 bits of every hash in column t, as a bitmap of 2 MB whatever the number of rows: at most 2^18 words reach the driver."""
    place = F.shiftrightunsigned("t", 64 - PLACES)
    word, bit = F.shiftrightunsigned(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    rows = t.select(word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).selectExpr("word", "shiftleft(one, bit) AS mask").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(1 << (PLACES - 6), np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def _full(width: int, bits: np.ndarray):
    """(node, set) of the texts whose hash may be one of those in the bitmap."""

    def run(source):
        for cols in batches(source):
            place = np.array(cols["t"], np.int64).view(np.uint64) >> np.uint64(64 - PLACES)
            hit = np.flatnonzero((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
            sets = [shingles(cols["__text"][k], width).tobytes() for k in hit.tolist()]
            nodes = np.array([xxhash.xxh64_intdigest(h) for h in sets], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(nodes)), pa.array(sets, pa.binary())], names=["node", "set"])

    return run


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / (len(x) + len(y) - shared) if len(x) + len(y) else 1.0


def _verify(similarity: float):
    def run(source):
        for cols in batches(source):
            ok = np.array([jaccard(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= similarity for a, b in zip(cols["a"], cols["b"], strict=True)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(cols[c], np.int64)[ok]) for c in ("u", "v")], names=["u", "v"])

    return run


def classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", similarity: float = 0.8, width: int = 5) -> DataFrame:
    """(id, t, cls) of every row: t is the xxhash64 of the text, cls the least node (shingle set) that verified links reach."""
    if not 0 < similarity <= 1:
        raise ValueError("a similarity is above 0 and at most 1")
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash_wide")
    least, most, reach = bounds(similarity)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).cast("binary").alias("__text"))
    sets = scratch.save(texts.mapInArrow(_sets(width), "id long, t long, node long, fp binary, lead long"), "sets")
    me = F.struct(F.col("id").isNull().alias("absent"), "id", "t")
    named = sets.groupBy("node").agg(F.min(me).alias("who"), F.max("fp").alias("fp"), F.max("lead").alias("lead"))
    uniq = scratch.save(named.select("node", F.col("who.t").alias("t"), "fp", "lead"), "uniq")
    release(spark)
    met = None
    for n in range(PASSES):  # the shuffle files of one pass are gone before the next
        keys = range(n * KEYS // PASSES, (n + 1) * KEYS // PASSES)
        postings = uniq.select("fp", "lead").mapInArrow(_postings(keys), "cell long, lead long")
        part = scratch.save(postings.repartition("cell").sortWithinPartitions("cell", "lead").mapInArrow(_met(reach), "cell long, lead long"), f"met{n}")
        met = part if met is None else met.unionByName(part)
        del postings
        release(spark)
    by_text = met.groupBy("lead").agg(F.collect_list("cell").alias("cells"))  # at most KEYS, but for the rare texts with equal leads
    alive = scratch.save(by_text.join(uniq, "lead").select("cells", "node", "t", "fp"), "alive")
    scratch.drop(*(f"met{n}" for n in range(PASSES)))
    release(spark)
    # the texts that have a posting left are picked by a bitmap, so that no text is shuffled
    full = texts.select("t", "__text").mapInArrow(_full(width, bitmap(alive.select("t"))), "node long, set binary")
    full = scratch.save(full.join(alive.select("node"), "node", "left_semi").dropDuplicates(["node"]), "full")
    listed = alive.select(F.explode("cells").alias("cell"), "node", "fp")
    release(spark)

    def links(cls: DataFrame, hubs: bool, done: DataFrame | None, name: str) -> tuple[DataFrame, DataFrame]:
        """(pairs looked at, those that are similar)"""
        rows = cls.repartition("cell").sortWithinPartitions("cell", "node")
        pairs = rows.mapInArrow(_pairs(least, most, hubs), "u long, v long").distinct()
        pairs = scratch.save(pairs.join(done, ["u", "v"], "left_anti") if done is not None else pairs, f"pairs_{name}")
        both = pairs.join(full.select(F.col("node").alias("u"), F.col("set").alias("a")), "u").join(full.select(F.col("node").alias("v"), F.col("set").alias("b")), "v")
        found = scratch.save(both.select("u", "v", "a", "b").mapInArrow(_verify(similarity), "u long, v long"), f"links_{name}")
        release(spark)
        return pairs, found

    done, first = links(listed.select("cell", "node", F.col("node").alias("cls"), "fp"), True, None, "hubs")
    roots = scratch.save(connected_components(first), "roots_hubs")
    classed = alive.join(roots, "node", "left").select(F.explode("cells").alias("cell"), "node", F.coalesce("root", "node").alias("cls"), "fp")
    _, rest = links(classed, False, done, "classes")
    roots = scratch.save(connected_components(first.unionByName(rest)), "roots")
    scratch.drop("alive", "full")
    return sets.join(roots, "node", "left").select("id", "t", F.coalesce("root", "node").alias("cls"))
