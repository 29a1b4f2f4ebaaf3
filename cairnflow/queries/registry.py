from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; without SQL only its rows can be checked."""

    def add(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points (vec_id, x, z, label): the first two components of every embedding, times 100."""
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", (F.col("embedding")[0].cast("double") * 100).alias("x"), (F.col("embedding")[1].cast("double") * 100).alias("z"), F.col("label").cast("long").alias("label"))


PLANE = "p AS (SELECT vec_id, embedding[1]::DOUBLE * 100 AS x, embedding[2]::DOUBLE * 100 AS z, label::BIGINT AS label FROM embeddings)"


def milli(c, scale: int = 1000):
    """A double as whole thousandths: comparable between engines."""
    return F.round(c * scale).cast("long")
