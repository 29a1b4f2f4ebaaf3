import hashlib
import random

from cairnflow.llm.substring import lengths, remove_repeated_substrings

SCHEMA = "doc_id long, text string, n_removed int"


def brute(rows, window):
    docs = {d: (t or "").encode().split() for d, t, _ in rows}
    first = {}
    for d in sorted(docs):
        w = docs[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    out = {}
    for d, w in docs.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_lengths():
    assert lengths(5, 20) == [5, 10, 20]
    assert lengths(3, 10) == [3, 6, 10]
    assert lengths(3, 7) == [3, 7]
    assert lengths(20, 20) == [20]


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)] + ["é", "ß"]
    passage = [rng.choice(vocab) for _ in range(45)]
    rows = []
    for d in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 120))]
        if d % 3 == 0:
            at = rng.randrange(0, len(w) + 1)
            cut = rng.randrange(0, 20)
            w[at:at] = passage[cut : cut + rng.randrange(10, 30)]
        if d % 7 == 0:
            w = w + w[-30:]
        rows.append((d, " ".join(w), 1))
    rows += [(100, None, 1), (101, "", 1), (102, " \t ", 1), (103, "a " * 500, 1), (104, "a " * 90, 1), (105, rows[3][1], 1), (106, rows[3][1], 1)]
    for window, start in ((20, 10), (20, 5), (20, 20), (7, 3)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeated_substrings(spark.createDataFrame(rows, SCHEMA).repartition(5), window=window, start=start).collect()}
        assert got == brute(rows, window)


def test_empty_null_ids_and_repeated_rows(spark):
    assert remove_repeated_substrings(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"x{i}" for i in range(30))
    rows = [(1, text, 1), (1, text, 1), (None, text, 1), (2, text, 1)]
    got = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeated_substrings(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 30)]


def test_levels_lose_candidates(spark):
    from cairnflow.llm.common import Scratch, identified
    from cairnflow.llm.substring import repeated_runs

    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(9)]
    shared = [rng.choice("abcdefgh") * 3 + str(i) for i in range(60)]
    rows = [(d, " ".join([rng.choice(vocab) for _ in range(150)] + (shared[:30] if d < 3 else shared[30 : 30 + d % 20])), 1) for d in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    levels = []
    runs = repeated_runs(identified(df, "text", "doc_id", Scratch(spark, "t")), 20, 5, levels)
    assert [n for n, _ in levels] == [5, 10] and levels[0][1] > levels[1][1] > 0
    assert {r.doc_id for r in runs.collect()} == {1, 2}


def test_other_texts_under_an_id_and_very_long_texts(spark):
    own = " ".join(f"own{i}" for i in range(25))
    text = " ".join(f"x{i}" for i in range(30))
    long = " ".join(f"l{i % 1000}" for i in range(60_000))
    rows = [(1, text, 1), (1, own, 1), (2, text, 1), (3, long, 1), (None, own, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as __text", "2 as __id", "3 as t", "4 as uid")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in remove_repeated_substrings(df).collect())
    assert got == [(0, 25, 0), (1, 25, 0), (1, 30, 0), (2, 30, 30), (3, 60_000, 60_000 - 1000)]
