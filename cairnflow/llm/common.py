"""Shared pieces of the training-data operators.

Scratch tables live under ``spark.checkpoint.dir`` (the folder every executor
and the driver share), so lost executors never lose an intermediate result.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``bytes.split()`` cuts at exactly these bytes: space, \t, \n, \v, \f, \r.
SPACES = r"[\x20\x09-\x0D]+"

_U = np.uint64
_K1, _K2, _K3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xBF58476D1CE4E5B9)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a temporary folder on a local master and an error on any other."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="cairnflow-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of frames that nothing refers to any more."""
    for _ in range(2):  # the gateway lets go of Python's references first, then the JVM's cleaner sees them
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)


class Scratch:
    """Written tables in the shared folder: cut lineage, survive lost executors, can be dropped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        bound_batches(spark)
        atexit.register(self._delete, self.base)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        schema = df.schema
        del df
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.base}/{name}")

    def _delete(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone: nothing left to tidy with
            pass


def combine(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """An order-sensitive 64-bit mix of two hash columns."""
    with np.errstate(over="ignore"):
        x = a * _K1 + (b ^ (b >> _U(31))) * _K2 + _U(seed)
        x ^= x >> _U(29)
        x *= _K3
        x ^= x >> _U(32)
    return x


def runs_of(order: np.ndarray, *cols: np.ndarray) -> np.ndarray:
    """True where a row of the sorted order starts a new run of equal columns."""
    new = np.ones(len(order), bool)
    if len(order) > 1:
        same = np.ones(len(order) - 1, bool)
        for c in cols:
            s = c[order]
            same &= s[1:] == s[:-1]
        new[1:] = ~same
    return new


def minimizers(h: np.ndarray, w: int) -> np.ndarray:
    """For each of the len(h)-w+1 windows of w hashes, the leftmost position of the least one."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    v = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    if span < w:
        v = np.minimum(v[: len(v) - (w - span)], v[w - span :])
    return (v & _U(0xFFFFFFFF)).astype(np.int64)


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches count rows, not bytes; with long texts the default of 10,000 rows is too much memory for a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def batches(rows: Iterator[pa.RecordBatch], size: int = 1 << 23) -> Iterator[dict[str, list]]:
    """Arrow batches as Python columns, about ``size`` bytes at a time: small batches are joined, large ones cut."""
    held: dict[str, list] = {}
    n = 0
    for batch in rows:
        step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            for i, name in enumerate(part.schema.names):
                held.setdefault(name, []).extend(part.column(i).to_pylist())
            n += part.nbytes
            if n >= size:
                yield held
                held, n = {}, 0
        del batch
        pa.default_memory_pool().release_unused()
    if held and any(held.values()):
        yield held


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, cut behind spaces or line ends, so that no word is cut; a text without them is one piece."""
    at = 0
    while len(text) - at > size:
        ends = [e for e in (text.rfind(b" ", at, at + size), text.rfind(b"\n", at, at + size)) if e >= 0]
        ends = ends or [e for e in (text.find(b" ", at + size), text.find(b"\n", at + size)) if e >= 0]
        if not ends:
            break
        end = (max(ends) if max(ends) < at + size else min(ends)) + 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def hot_join(left: DataFrame, right: DataFrame, key: str, share: int = 1024) -> DataFrame:
    """Left join with a table that has one row per key. Keys that hold more than one in ``share`` of the left rows, fewer than ``share`` by that count, meet a broadcast of their rows; the others meet in an ordinary join."""
    (flag,) = free_names(left, "__hot")
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias(flag))
    least = (counts.agg(F.sum(flag)).first()[0] or 0) / share
    hot = counts.where(F.col(flag) > max(1.0, least))
    marked = left.join(F.broadcast(hot), key, "left")
    few = F.broadcast(right.join(F.broadcast(hot.select(key)), key, "left_semi"))
    return marked.where(F.col(flag).isNotNull()).drop(flag).join(few, key, "left").unionByName(marked.where(F.col(flag).isNull()).drop(flag).join(right, key, "left"))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def identified(docs: DataFrame, text_col: str, id_col: str, scratch: Scratch) -> DataFrame:
    """(doc_id, __text, __id): __id is the id of the row and doc_id one that no two different texts share, in the order of ids and then of text hashes.

    Where no id has different texts (one cheap aggregate tells) doc_id is the id itself. Rows repeating id and text share it; null ids stay null.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("__text"))
    t = F.xxhash64("__text")
    several = own.where("doc_id is not null").groupBy("doc_id").agg(F.min(t).alias("a"), F.max(t).alias("b")).where("a <> b")
    if several.isEmpty():
        return own.withColumn("__id", F.col("doc_id"))
    pairs = own.where("doc_id is not null").select("doc_id", t.alias("t")).distinct().orderBy("doc_id", "t")
    pairs = scratch.save(pairs.select("doc_id", "t", F.monotonically_increasing_id().alias("uid")), "ids")
    met = own.withColumn("t", t).join(pairs, ["doc_id", "t"], "left")
    return scratch.save(met.select(F.col("uid").alias("doc_id"), "__text", F.col("doc_id").alias("__id")), "texts")


def marks_by_doc(marks: DataFrame, id_col: str = "doc_id", *cols: str) -> DataFrame:
    """One row per document: its marks as an array of structs, no larger than the document."""
    return marks.groupBy(id_col).agg(F.collect_list(F.struct(*cols)).alias("__marks"))


def cover(n: int, starts, ends) -> np.ndarray:
    """Boolean cover of [start, end) intervals over n places."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, np.minimum(starts, n), 1)
    np.add.at(d, np.minimum(ends, n), -1)
    return np.cumsum(d[:-1]) > 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
