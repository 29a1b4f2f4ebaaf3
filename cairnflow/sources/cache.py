"""A cache of responses as an append-only table of versions, with a pointer that says which of them count.

``versions/<n>`` holds the rows that one fill added (or a compaction wrote), ``pointers/<n>`` one small JSON file with the
versions that are live. A fill writes its version first and then renames a new pointer into place, which fails if another
writer was there before it; readers see either the old state or the new one, and a lost executor or a failed job leaves
an unreferenced folder at most, which ``vacuum`` removes. All files go through Spark and Hadoop file systems.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import first_by

_ROW = "key string, body string"


def usable(body: str = "body"):
    """A body that is JSON; anything else counts as not cached."""
    return F.try_parse_json(body).isNotNull()


def succeeded(body: str = "body"):
    return F.upper(F.coalesce(F.try_variant_get(F.try_parse_json(body), "$.status", "string"), F.lit(""))) == "OK"


class ResponseCache:
    """Responses (key, body) under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[int]:
        p = self._at(folder)
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(p) if s.getPath().getName().isdigit()) if self._fs.exists(p) else []

    def _live(self, pointer: int) -> list[int]:
        text = self.spark.read.text(f"{self.path}/pointers/{pointer}", wholetext=True).first()
        return json.loads(text.value)["versions"]

    def _current(self) -> tuple[int, list[int]]:
        pointers = self._names("pointers")
        return (pointers[-1], self._live(pointers[-1])) if pointers else (0, [])

    def _swap(self, before: int, versions: list[int]) -> None:
        """The next pointer, renamed into place as a whole; an error if another writer has made it."""
        draft = self._at(f"drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"versions": versions}).encode()))
        out.close()
        self._fs.mkdirs(self._at("pointers"))
        target = self._at(f"pointers/{before + 1}")
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise RuntimeError(f"another writer has changed {self.path}")

    def _write(self, rows: DataFrame) -> int:
        """The rows as a new version that no pointer names yet."""
        folder = f"drafts/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        self._fs.mkdirs(self._at("versions"))
        n = (self._names("versions") or [0])[-1] + 1
        while self._fs.exists(self._at(f"versions/{n}")) or not self._fs.rename(self._at(folder), self._at(f"versions/{n}")):
            n += 1
        return n

    def read(self) -> DataFrame:
        """(key, body) of the newest row of every key."""
        _, live = self._current()
        if not live:
            return self.spark.createDataFrame([], _ROW)
        parts = [self.spark.read.schema(_ROW).parquet(f"{self.path}/versions/{n}").withColumn("version", F.lit(n)) for n in live]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        return first_by(every, ["key"], [F.desc("version"), "body"]).select("key", "body")

    def fill(self, requests: DataFrame, client: Callable[[str, str], str], keep: str = "all", per_second: float | None = None, workers: int = 4) -> DataFrame:
        """(key, body) of every request (key, origin, destination), asked for where the cache has no usable body.

        A corrupt body is asked for again. A client that raises gives a body with the status ``request_failed``. ``keep`` "all" stores
        failures too, so that they are not asked for again; "ok" stores only bodies whose status is OK. ``per_second`` calls at most
        start in a second: each of ``workers`` partitions gets an equal share. Null keys are never asked for.
        """
        if keep not in ("all", "ok"):
            raise ValueError(f"keep is {keep!r}, all or ok is expected")
        before, live = self._current()
        wanted = requests.where(F.col("key").isNotNull()).dropDuplicates(["key"])
        have = self.read().where(usable())
        missing = wanted.join(have.select("key"), "key", "left_anti").select("key", "origin", "destination")
        pause = workers / per_second if per_second else 0.0

        def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            free = 0.0
            for pdf in batches:
                out = []
                for o, d in zip(pdf["origin"], pdf["destination"], strict=True):
                    time.sleep(max(0.0, free - time.monotonic()))
                    free = time.monotonic() + pause
                    try:
                        out.append(client(o, d))
                    except Exception as e:
                        out.append(json.dumps({"status": "request_failed", "message": str(e)}))
                yield pd.DataFrame({"key": pdf["key"], "body": pd.Series(out, dtype=object, index=pdf.index)})

        version = self._write(missing.repartition(workers, "key").mapInPandas(fetch, _ROW))
        fresh = self.spark.read.schema(_ROW).parquet(f"{self.path}/versions/{version}")
        answers = wanted.select("key").join(have.unionByName(fresh), "key")
        stored = fresh if keep == "all" else fresh.where(succeeded())
        if keep == "ok" and not fresh.where(~F.coalesce(succeeded(), F.lit(False))).isEmpty():
            version = self._write(stored)
        if not stored.isEmpty():
            self._swap(before, [*live, version])
        return answers

    def compact(self) -> None:
        """One version with the newest usable body of every key takes the place of all live ones."""
        before, live = self._current()
        if live:
            self._swap(before, [self._write(self.read().where(usable()))])

    def vacuum(self) -> None:
        """Removes versions, pointers and drafts that the current pointer does not need. Readers that began before a compaction lose their files: run it when there are none."""
        current, live = self._current()
        for n in self._names("versions"):
            if n not in live:
                self._fs.delete(self._at(f"versions/{n}"), True)
        for n in self._names("pointers"):
            if n < current:
                self._fs.delete(self._at(f"pointers/{n}"), True)
        self._fs.delete(self._at("drafts"), True)
