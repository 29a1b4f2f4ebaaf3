import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cairnflow.llm.components import connected_components
from cairnflow.llm import simhash_wide
from cairnflow.llm.simhash import cells, fingerprint, forest, midpoint_links, near_duplicates, one_of_each

SCHEMA = "doc_id long, text string, component_id int"


def brute_fp(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, bits):
    """fps: list of (id, fingerprint)"""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, (d, _) in enumerate(fps)}


def rows_for_test():
    rng = random.Random(1)
    vocab = [f"wörd{i}" for i in range(200)] + ["The", "A"]
    rows = []
    for d in range(0, 120, 4):
        w = [rng.choice(vocab) for _ in range(rng.randrange(1, 150))]
        rows.append((d, " ".join(w), 1))
        for e in range(1, 4):
            v = list(w)
            for _ in range(rng.randrange(0, 3)):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            rows.append((d + e, " \n".join(v), 1))
    return rows + [(500, None, 1), (501, "", 1), (502, "\t ", 1), (503, "one two", 1), (504, "ONE two", 1), (505, rows[0][1], 1)]


def test_against_brute_force(spark):
    rows = rows_for_test()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fps = [(d, brute_fp(t)) for d, t, _ in rows]
    want = brute_classes(fps, 4)
    for cap, meet in ((8192, 3), (1, 3), (8192, 1), (8192, 4)):
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(df, cap=cap, meet=meet).collect()}
        assert got == {d: (f"{f:016x}", want[d]) for d, f in fps}
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_index_finds_every_link(spark):
    rng = random.Random(2)
    fps = []
    for k in range(60):
        f = rng.getrandbits(64)
        fps.append((k * 2, f))
        for b in rng.sample(range(64), rng.randrange(2, 7)):
            f ^= 1 << b
        fps.append((k * 2 + 1, f))
    signed = [(int(np.array([f], np.uint64).view(np.int64)[0]),) for _, f in fps]
    for bits in (3, 4):
        links = midpoint_links(spark.createDataFrame(signed, "fp long"), bits)
        comp = {r.node: r.root for r in connected_components(links).collect()}
        want = brute_classes([(s[0], f) for s, (_, f) in zip(signed, fps, strict=True)], bits)
        groups = {}
        for node, least in want.items():
            groups.setdefault(least, set()).add(node)
        for g in groups.values():
            assert len({comp.get(x, x) for x in g}) == 1
        assert len({comp.get(x, x) for x in want}) == len(groups)


def test_components_of_a_chain_and_of_nothing(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "u long, v long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert roots == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert connected_components(edges.where("u > 1000")).count() == 0


def test_edge_cases(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d e", 1), (3, "a b c d e", 1), (3, "a b c d e", 1), (9, "x y z q r s t u v", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or 0, r.component_id) for r in near_duplicates(df).collect())
    assert got == [(0, 3), (3, 3), (3, 3), (9, 9)]
    assert sorted(r.doc_id for r in one_of_each(df).collect()) == [3, 3, 9]
    assert sorted(r.doc_id for r in one_of_each(df, width=5, similarity=0.8).collect()) == [3, 3, 9]
    odd = spark.createDataFrame([(None, "p q r s t u"), (None, "own words here are five"), (4, "v w x y z"), (4, "other text under four is kept"), (5, None), (6, "")], "doc_id long, text string").selectExpr("*", "1 as __t", "2 as __i", "3 as id", "4 as t", "5 as component_id")
    for how in ({}, {"width": 5, "similarity": 0.8}):
        out = one_of_each(odd, **how)
        assert out.columns == odd.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "own words here are five"), (0, "p q r s t u"), (4, "other text under four is kept"), (4, "v w x y z"), (5, "")]
        assert one_of_each(odd.limit(0), **how).count() == 0
    assert fingerprint(b"one") == xxhash.xxh64(b"one", seed=42).intdigest()


def test_count_filter_drops_pairs_and_keeps_every_link():
    rng = random.Random(5)
    base = rng.getrandbits(64)
    f = {base}
    while len(f) < 300:  # a cell of fingerprints that share bytes without being near
        x = base
        for p in rng.sample(range(3, 8), rng.randrange(0, 6)):
            x ^= rng.getrandbits(8) << (8 * p)
        for b in rng.sample(range(64), rng.randrange(0, 4)):
            x ^= 1 << b
        f.add(x)
    f = np.array(sorted(f), np.uint64)
    seen = {}
    links = forest(f, 4, 4, seen)
    assert seen["under"] > 0 and seen["pairs"] > seen["under"]
    parts = brute_classes([(i, int(x)) for i, x in enumerate(f)], 4)
    at = {int(x): i for i, x in enumerate(f)}
    parent = list(range(len(f)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert (int(a) ^ int(b)).bit_count() <= 4
        parent[find(at[int(a)])] = find(at[int(b)])
    assert len(links) == len(f) - len(set(parts.values()))
    assert all((find(i) == find(j)) == (parts[i] == parts[j]) for i in range(0, len(f), 7) for j in range(len(f)))
    assert forest(f[:2], 64, 0) == [(f[0], f[1])]


def test_cells_cover_every_choice_of_shared_positions():
    from itertools import combinations

    for bits in range(8):
        for meet in (1, 2, 3, 4):
            named = cells(bits, meet)
            assert all(any(set(c) <= set(shared) for c in named) for shared in combinations(range(8), 8 - bits))


def shingle_sets(texts, width=5):
    out = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def test_wide_classes_against_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(30, 300))]
        texts.append(" ".join(w))
        for _ in range(4):
            v = list(w)
            for _ in range(max(1, int(len(v) * rng.choice([0.004, 0.01, 0.018, 0.03])))):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            texts.append(" ".join(v))
    hub = [rng.choice(vocab) for _ in range(200)]
    for _ in range(150):  # a large group around one text
        v = list(hub)
        v[rng.randrange(200)] = "x"
        texts.append("  ".join(v).upper())
    texts += [None, "", "one two", "One  two", "z " * 50_000]
    sets = shingle_sets(texts)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in links:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = simhash_wide.classes(docs, similarity=0.8, width=5).collect()
    assert len(got) == len(texts)
    of = {r.id: r.cls for r in got}
    for i in range(len(texts)):  # nothing is linked that is not
        for j in range(i):
            assert of[i] != of[j] or find(i) == find(j)
    edge = [(i, j) for i, j in links if len(sets[i] & sets[j]) < 0.85 * len(sets[i] | sets[j])]
    assert len(edge) > 20 and sum(of[i] == of[j] for i, j in edge) >= 0.95 * len(edge)
    assert all(of[i] == of[j] for i, j in links if (i, j) not in set(edge))
    kept = {r.doc_id for r in one_of_each(docs, width=5, similarity=0.8).collect()}
    first = {}
    for i, c in sorted(of.items()):
        first.setdefault(c, i)
    assert kept == set(first.values())


def test_wide_bounds_and_cells():
    least, most, reach = simhash_wide.bounds(0.8)
    assert 10 < least < 34 and 155 < most < 256 and reach < 32
    assert simhash_wide.triples().shape == (simhash_wide.KEYS, 3)
    same = np.tile(np.arange(simhash_wide.BYTES, dtype=np.uint8), (9, 1))
    assert len(simhash_wide.hub_pairs(same, least, most)) == 8
    assert simhash_wide.class_pairs(same, np.zeros(9), least, most) == []
    assert len(simhash_wide.class_pairs(same, np.array([1] * 8 + [2]), least, most)) == 8


def test_bitmap_holds_every_hash(spark):
    rng = np.random.default_rng(3)
    t = rng.integers(-(1 << 63), (1 << 63) - 1, 500, dtype=np.int64)
    bits = simhash_wide.bitmap(spark.createDataFrame([(int(x),) for x in t], "t long"))
    place = t.view(np.uint64) >> np.uint64(40)
    assert ((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).all()
    assert np.bitwise_count(bits).sum() == len(set(place.tolist()))
