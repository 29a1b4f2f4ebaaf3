import random
import re
from collections import Counter

import pytest

from cairnflow.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs=10, top=10):
    docs = []
    for _, t, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        docs.append((lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)))
    out = set()
    for lang in {x for x, _, _ in docs}:
        own = [(s, w) for x, s, w in docs if x == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = {t for t, n in df.items() if n >= min_docs}
        groups = {s: Counter() for s, _ in own}
        for s, w in own:
            groups[s].update(t for t in w if t in kept)
        whole = sum(groups.values(), Counter())
        p = lambda c, n: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in groups.items():
            pairs = [(sum(f(p(c, c[t]), p(o, o[t])) for t in kept), other) for other, o in groups.items() if other != s]
            terms = [(f(p(c, c[t]), p(whole, whole[t])), t) for t in kept if c[t] and p(c, c[t]) > p(whole, whole[t])]
            for part, found in (("pair", pairs), ("term", terms)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k) for k, (v, item) in enumerate(order, 1) if part == "pair" or k <= top}
    return out


def make_rows(sources=9):
    rng = random.Random(13)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Ünder", "ÜNDER", "漢字", "it's", "naïve", "x1y", "A", "a"]
    rows = []
    for d in range(400):
        source = rng.choice([f"s{k}" for k in range(sources)] + ["s0"] * 4)
        pool = words[: 20 + 5 * (int(source[1:]) % 9)]
        rows.append((d, rng.choice([" ", "\n", "-", "\x00"]).join(rng.choice(pool) for _ in range(rng.randrange(0, 30))), rng.choice(["en", "en", "de", None, ""]), source))
    few = [(500 + k, "rare words only", "fr", f"f{k}") for k in range(3)]
    edge = [(600, None, "en", "silent"), (601, "", "en", "silent"), (602, "1 2 3 !", "alone", None), (603, "wa " * 400_000 + "wb", "en", "long"), (604, "y" * 2_500_000, "en", None)]
    return rows + few + edge + rows[:20]


@pytest.mark.parametrize("block", [256, 3, 1])
def test_against_brute_force(spark, block):
    rows = make_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6).selectExpr("*", "1 as n", "2 as term", "3 as p", "4 as place", "5 as salt", "6 as other", "7 as kept")
    got = source_divergence(docs, block=block)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    found = [tuple(r) for r in got.collect()]
    want = brute(rows)
    assert set(found) == want and len(found) == len(want)
    assert {(x[1], x[3], x[4]) for x in found if x[0] == "fr"} == {(f"f{a}", f"f{b}", 0) for a in range(3) for b in range(3) if a != b}


def test_very_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    from cairnflow.llm.divergence import share

    n, total, kept = 8 * 10**17, 9 * 10**18, 10**9
    got = spark.range(1).select(share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_empty_tables_and_no_terms(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    got = source_divergence(spark.createDataFrame([(1, None, None, None), (2, "a", None, "b")], SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
