import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnflow.llm.suffix import maximal_repeats, remove_repeated_bytes

SCHEMA = "doc_id long, text string, n_bytes int"


def brute(rows, length):
    docs = {d: (t or "").encode() for d, t, _ in rows}
    first = {}
    for d in sorted(docs):
        for i in range(len(docs[d]) - length + 1):
            first.setdefault(docs[d][i : i + length], d)
    out = {}
    for d, t in docs.items():
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest())
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=14).map(str.encode), min_size=1, max_size=5), st.integers(2, 4))
def test_maximal_repeats(texts, least):
    got = {}
    for size, which, start in maximal_repeats(texts + [b"xxxx"], np.zeros(len(texts) + 1, int), least):
        word = (texts + [b"xxxx"])[which[0]][start[0] : start[0] + size]
        got[word] = sorted(zip(which.tolist(), start.tolist(), strict=True))
    want = {}
    all_texts = texts + [b"xxxx"]
    words = {t[i:j] for t in all_texts for i in range(len(t)) for j in range(i + least, len(t) + 1)}
    for w in words:
        occ = [(k, i) for k, t in enumerate(all_texts) for i in range(len(t)) if t[i : i + len(w)] == w]
        lefts = {all_texts[k][i - 1] if i else ("edge", k, i) for k, i in occ}
        rights = {all_texts[k][i + len(w)] if i + len(w) < len(all_texts[k]) else ("edge", k, i) for k, i in occ}
        if len(occ) > 1 and len(lefts) > 1 and len(rights) > 1:
            want[w] = sorted(occ)
    assert got == want


def test_against_brute_force(spark):
    rng = random.Random(5)
    abc = "abcdefghijklmnopqrstuvwxyzé \n"
    passage = "".join(rng.choice(abc) for _ in range(200))
    rows = []
    for d in range(50):
        t = "".join(rng.choice(abc) for _ in range(rng.randrange(0, 400)))
        if d % 3 == 0:
            at, cut = rng.randrange(0, len(t) + 1), rng.randrange(0, 120)
            t = t[:at] + passage[cut : cut + rng.randrange(40, 80)] + t[at:]
        rows.append((d, t, 1))
    rows += [(60, None, 1), (61, "", 1), (62, "z" * 500, 1), (63, "z" * 90, 1), (64, "z" * 49, 1), (65, rows[3][1], 1), (66, rows[3][1][:-7] + "changed", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, 50)
    for cap in (20_000, 1):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeated_bytes(df, cap=cap).collect()}
        assert got == want
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeated_bytes(df, length=24, gram=7).collect()}
    assert got == brute(rows, 24)


def test_empty_null_ids_and_repeated_rows(spark):
    assert remove_repeated_bytes(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    rows = [(1, text, 1), (1, text, 1), (None, text, 1), (2, text, 1)]
    got = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, len(text))]


def test_other_texts_under_an_id_and_block_borders(spark):
    from cairnflow.llm.suffix import BLOCK

    rng = random.Random(9)
    abc = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(rng.choice(abc) for _ in range(3000))
    fill = "".join(rng.choice(abc) for _ in range(BLOCK - 1500))
    own = "".join(rng.choice(abc) for _ in range(100))
    rows = [(1, passage, 1), (1, own, 1), (2, fill + passage + own, 1), (None, passage, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as __text", "2 as __id", "3 as t")
    got = sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in remove_repeated_bytes(df).collect())
    assert got == [(0, 0, 0), (1, 0, 0), (1, 0, 0), (2, 3100, 1)]


def test_sql_gives_the_same(spark):
    import duckdb

    from cairnflow.llm.suffix import ORACLE

    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {tuple(r) for r in remove_repeated_bytes(docs).select(cols).collect()} == set(con.sql(f"select {', '.join(cols)} from ({ORACLE})").fetchall())


def test_open_runs_are_sorted_in_batches_of_bounded_size():
    """2.5 MB of open runs go through more than one suffix array, and every repeat is found in its anchor."""
    import pyarrow as pa

    from cairnflow.llm import suffix

    n = 18_000
    data = [bytes(f"{i:08d}" * 8, "ascii")[:60] + b"x" * 10 for i in range(n) for _ in (0, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array([i // 2 for i in range(2 * n)], pa.int64()), pa.array([i % 2 for i in range(2 * n)], pa.int64()), pa.array([0] * 2 * n, pa.int32()), pa.array(data, pa.binary())], names=["h", "doc_id", "a", "data"])
    cuts = [batch.slice(k, 1000) for k in range(0, 2 * n, 1000)]
    out = list(suffix._repeats(50, 20_000)(iter(cuts)))
    assert len(out) > 1 and sum(b.num_rows for b in out) >= n
