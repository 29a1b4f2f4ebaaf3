"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

The index is built once: blocks of ``block`` vectors, each with one posting
segment per (component, quantised impact). Segments list the vectors whose
component has that impact, so a segment and a query value give one
contribution for all its postings.

A search takes the query vectors in blocks too (``query_block`` of them at a
time are in memory, whatever their number) and runs every block of queries
against every block of the index. For each query the segments are processed by
descending absolute contribution. Beside its partial score every vector keeps
the energy of query and vector in the components it has not met yet, which bounds
what those can add (Cauchy-Schwarz); to it comes the quantisation error. The
search stops only on proof: once no more than ``rescore`` times k vectors of a
block (or a sixteenth of it) can still reach the k-th best lower bound. These
possible members are then rescored exactly with integers. Components near zero
are long segments and come last, so a stop saves a larger share of postings than
of segments (README).

Values are floor(scale * x) with x as double. Ties go to the smaller vec_id.

Edge cases: vectors that are null, empty, or hold null or non-finite components
take no part, neither as query nor as candidate; a query's candidates are the
vectors of its own length; the rows of a query's own vec_id are never its
candidates; repeated candidate rows count each; fewer candidates than k are all
returned; rows with a null vec_id take no part; an empty table gives an empty
result; other columns are ignored. Scores are 64-bit: a pair whose score does not
fit raises OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

_INDEX = "ids binary, vectors binary, width int, segment_component binary, segment_impact binary, segment_end binary, postings binary"
_FOUND = "query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, vector_col: str, id_col: str, scale: int) -> DataFrame:
    """(vec_id, v): usable vectors as floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    ok = F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def _build(block: int, step: int):
    def pack(ids: list[int], rows: list[np.ndarray]) -> pa.RecordBatch:
        m = np.stack(rows)
        level = m // step
        component, vector = np.divmod(np.arange(m.size), len(m))
        impact = level.T.ravel()
        order = np.lexsort((vector, impact, component))
        component, impact, vector = component[order], impact[order], vector[order]
        last = np.flatnonzero(np.append((np.diff(component) != 0) | (np.diff(impact) != 0), True))
        cols = [np.array(ids, np.int64), m.astype(np.int64), None, component[last].astype(np.int32), impact[last].astype(np.int64), (last + 1).astype(np.int64), vector.astype(np.int32)]
        values = [pa.array([m.shape[1]], pa.int32()) if c is None else pa.array([c.tobytes()], pa.binary()) for c in cols]
        return pa.RecordBatch.from_arrays(values, names=["ids", "vectors", "width", "segment_component", "segment_impact", "segment_end", "postings"])

    def run(source):
        held: dict[int, tuple[list, list]] = {}
        for batch in source:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, rows = held.setdefault(len(v), ([], []))
                ids.append(i)
                rows.append(np.array(v, np.int64))
                if len(ids) == block:
                    yield pack(ids, rows)
                    del held[len(v)]
        for ids, rows in held.values():
            yield pack(ids, rows)

    return run


#: Shares of the segments after which the bounds are looked at.
CUTS = (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0)


def search_block(q: np.ndarray, index: dict[str, np.ndarray], k: int, step: int, own: int | None, rescore: int = 4, share: list | None = None) -> np.ndarray:
    """Positions in one index block of every vector that can be among the k best of query q (own: a vec_id to leave out). ``share`` gets (segments, postings) processed, as shares."""
    ids, component, impact, end, postings = (index[c] for c in ("ids", "component", "impact", "end", "postings"))
    allowed = ids != own if own is not None else np.ones(len(ids), bool)
    if int(allowed.sum()) <= k:
        return np.flatnonzero(allowed)
    enough = max(rescore * k, len(ids) // 16)
    w = q.astype(np.float64)
    middle = impact * float(step) + (step - 1) / 2  # a value is the middle of its impact, give or take (step - 1) / 2
    gain, asked, held = w[component] * middle, w[component] ** 2, middle**2
    order = np.argsort(-np.abs(gain), kind="stable")
    begin = np.concatenate([[0], end[:-1]])
    sizes = end - begin
    n, dims = len(ids), len(q)
    score = np.zeros(n)
    left_q = np.full(n, float(w @ w))
    left_v = np.bincount(postings, np.repeat(held, sizes), n)
    error = min(np.abs(w).sum(), np.sqrt(w @ w * dims)) * (step - 1) / 2
    slack = 1e-9 * (error + np.sqrt(float(w @ w) * float(left_v.max())))  # rounding of the sums
    done = 0
    for cut in CUTS:
        upto = len(order) if cut == 1.0 else int(len(order) * cut)
        now = order[done:upto]
        m = sizes[now]
        at = postings[np.repeat(begin[now] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
        score += np.bincount(at, np.repeat(gain[now], m), n)
        left_q -= np.bincount(at, np.repeat(asked[now], m), n)
        left_v -= np.bincount(at, np.repeat(held[now], m), n)
        done = upto
        room = np.sqrt(np.maximum(left_q, 0) * np.maximum(left_v, 0)) + error + slack
        least = np.where(allowed, score - room, -np.inf)
        kth = np.partition(least, n - k)[n - k]
        possible = np.flatnonzero(allowed & (score + room >= kth))
        if len(possible) <= enough:
            break
    if share is not None:
        share.append((done / len(order), float(sizes[order[:done]].sum() / sizes.sum())))
    return possible


def exact_scores(vectors: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; those that do not fit 64 bits raise."""
    if float(np.abs(vectors.astype(np.float64)).max(initial=0.0)) * float(np.abs(q.astype(np.float64)).sum()) < 2.0**62:
        return vectors @ q
    exact = [sum(int(a) * int(b) for a, b in zip(v, q, strict=True)) for v in vectors]
    if any(not -(1 << 63) <= x < 1 << 63 for x in exact):
        raise OverflowError("an inner product does not fit a 64-bit score")
    return np.array(exact, np.int64)


def _search(queries: list[tuple[int, np.ndarray]], k: int, step: int):
    lengths = sorted({len(q) for _, q in queries})

    def run(source):
        for batch in source:
            for row in batch.to_pylist():
                width = row["width"]
                if width not in lengths:
                    continue
                index = {"ids": np.frombuffer(row["ids"], np.int64), "component": np.frombuffer(row["segment_component"], np.int32), "impact": np.frombuffer(row["segment_impact"], np.int64), "end": np.frombuffer(row["segment_end"], np.int64), "postings": np.frombuffer(row["postings"], np.int32)}
                vectors = np.frombuffer(row["vectors"], np.int64).reshape(-1, width)
                out: list[tuple[np.ndarray, ...]] = []
                for name, q in queries:
                    if len(q) != width:
                        continue
                    at = search_block(q, index, k, step, name)
                    exact = exact_scores(vectors[at], q)
                    best = np.lexsort((index["ids"][at], -exact))[:k]
                    out.append((np.full(len(best), name, np.int64), index["ids"][at[best]], exact[best]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in out])) for i in range(3)], names=["query_id", "vec_id", "score"])

    return run


def query_blocks(vectors: DataFrame, size: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Query vectors streamed to the driver, ``size`` at a time."""
    block = []
    for row in vectors.toLocalIterator():
        block.append((row.vec_id, np.array(row.v, np.int64)))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, vector_col: str = "embedding", id_col: str = "vec_id", scale: int = 1024, step: int = 4, block: int = 4096, query_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query among all other vectors, rank from 1.

    ``step`` is the width of one quantised impact. A query vec_id that occurs
    in several rows is searched once for each distinct vector of it.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    usable = integer_vectors(vectors, vector_col, id_col, scale)
    index = scratch.save(usable.mapInArrow(_build(block, step), _INDEX), "index")
    asked = integer_vectors(vectors.where(is_query), vector_col, id_col, scale).distinct()
    found = None
    for n, queries in enumerate(query_blocks(asked, query_block)):
        # one small row per index block: deal them out, a few to a task
        part = index.repartition(max(spark.sparkContext.defaultParallelism, 8)).mapInArrow(_search(queries, k, step), _FOUND)
        part = scratch.save(part, f"found{n}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
