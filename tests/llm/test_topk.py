import random

import numpy as np
from pyspark.sql import functions as F

from cairnflow.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, is_query, k):
    ok = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in ok:
        if is_query(i):
            best = sorted((-int(q @ c), j) for j, c in ok if j != i and len(c) == len(q))[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) * (1 if rng.random() < 0.9 else 8) for _ in range(16)], 0) for i in range(400)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(30)]  # ties
    rows += [(2000, None, 0), (2001, [], 0), (2002, [float("nan")] * 16, 0), (2003, [None] + [1.0] * 15, 0), (2010, [float("inf")] * 16, 0), (None, [1.0] * 16, 0), (2020, [0.0] * 16, 0), (2030, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, lambda i: i % 10 == 0, 10)
    for block, step, qb in ((4096, 32, 4096), (64, 7, 5), (50, 300, 1000)):
        got = {tuple(r) for r in exact_top_k(df, F.col("vec_id") % 10 == 0, block=block, step=step, query_block=qb).collect()}
        assert got == want


def test_few_and_none(spark):
    df = spark.createDataFrame([(100, [1.0, 0.5], 0), (1, [0.25, -1.0], 0), (200, [0.0, 1.0], 0)], SCHEMA)
    got = {tuple(r) for r in exact_top_k(df, F.col("vec_id") % 100 == 0).collect()}
    assert got == {(100, 1, 200, 512 * 1024), (100, 2, 1, 256 * 1024 - 512 * 1024), (200, 1, 100, 512 * 1024), (200, 2, 1, -1024 * 1024)}
    assert exact_top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert exact_top_k(df, F.lit(False)).count() == 0


def blocks_of(path, step):
    import pyarrow.parquet as pq

    from cairnflow.llm.topk import _build

    t = pq.read_table(path).to_pydict()
    rows = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64)).astype(np.int64).tolist()) for i, v in zip(t["vec_id"], t["embedding"], strict=True) if v]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([v for _, v in rows])], names=["vec_id", "v"])
    for packed in _build(4096, step)([batch]):
        r = packed.to_pylist()[0]
        yield {"ids": np.frombuffer(r["ids"], np.int64), "component": np.frombuffer(r["segment_component"], np.int32), "impact": np.frombuffer(r["segment_impact"], np.int64), "end": np.frombuffer(r["segment_end"], np.int64), "postings": np.frombuffer(r["postings"], np.int32)}, np.frombuffer(r["vectors"], np.int64).reshape(-1, r["width"])


def test_the_stop_fires_and_keeps_every_possible_member():
    from cairnflow.llm.topk import search_block

    share = []
    for index, vectors in blocks_of("/root/testdata/sf0.1/embeddings.parquet", 4):
        for at in np.flatnonzero(index["ids"] % 100 == 0).tolist():
            own = int(index["ids"][at])
            possible = search_block(vectors[at], index, 10, 4, own, share=share)
            exact = np.where(index["ids"] == own, -(1 << 62), vectors @ vectors[at])
            best = np.lexsort((index["ids"], -exact))[:10]
            assert set(best.tolist()) <= set(possible.tolist())
            assert len(possible) <= len(vectors) // 16
    segments, postings = np.mean(share, axis=0)
    assert max(s for s, _ in share) < 1 and segments < 0.92 and postings < 0.85


def test_scores_that_do_not_fit_are_refused():
    import pytest

    from cairnflow.llm.topk import exact_scores

    big = np.array([[3 * 10**12, 3 * 10**12], [1, -1]], np.int64)
    assert exact_scores(big, np.array([10**6, -(10**6)])).tolist() == [0, 2 * 10**6]
    with pytest.raises(OverflowError):
        exact_scores(big, big[0])
