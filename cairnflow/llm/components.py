"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two joins on a node with a map-side minimum, so a node with a
very large neighbourhood is one aggregated row and its edges are split by
adaptive skew joins. Labels stay in tables: nothing but one counter per round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, release


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u long, v long) -> (node, root): root is the least node of the component. Nodes without an edge are absent.

    Rows with a null end or u = v add nothing. Raises if ``max_rounds`` rounds do not settle, rather than returning partial labels.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    lo, hi = F.least("u", "v"), F.greatest("u", "v")
    mark = (F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h"))
    now = scratch.save(edges.where("u is not null and v is not null and u <> v").select(hi.alias("u"), lo.alias("v")).distinct(), "r0")
    before = now.agg(*mark).first()
    for k in range(1, max_rounds + 1):
        # large-star: the larger neighbours of every node move to the least of its neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: the smaller neighbours and the node itself move to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.save(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"r{k}")
        state = after.agg(*mark).first()  # a round that changes nothing leaves every node under its root
        scratch.drop(f"r{k - 1}")
        now = after
        release(spark)
        settled, before = state == before, state
        if settled:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
