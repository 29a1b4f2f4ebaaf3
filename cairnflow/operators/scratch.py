"""Written tables between the rounds of a loop, and column names that clash with none of a caller's."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a temporary folder on a local master and an error on any other."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cairnflow-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


class Scratch:
    """Tables in the shared folder that cut lineage like a checkpoint, and can be dropped as soon as a round no longer needs them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._delete, self.base)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

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


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to be none of the taken ones."""
    have = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out
