"""Relational operators with explicit order and tie-breaks.

Nothing here collects. Keys that may be hot are aggregated map-side; windows are
used only where the rows of a key must be seen in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import free_names, shared_dir

Keys = Sequence[str]


def _w(keys: Keys, order: Sequence[Column | str]):
    return Window.partitionBy(*keys).orderBy(*order)


def first_by(df: DataFrame, keys: Keys, order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key. row_number = 1 is planned with a map-side group limit, so a hot key sends one row per task."""
    (rn,) = free_names(df.columns, "__rn")
    return df.withColumn(rn, F.row_number().over(_w(keys, order))).where(F.col(rn) == 1).drop(rn)


def top_k(df: DataFrame, keys: Keys, order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(_w(keys, order))).where(F.col(rank) <= k)


def dense_index(df: DataFrame, keys: Keys, order: Sequence[Column | str], name: str) -> DataFrame:
    """0, 1, 2 ... for distinct values in order."""
    return df.withColumn(name, F.dense_rank().over(_w(keys, order)) - 1)


def chain_links(df: DataFrame, keys: Keys, level: str, order: Sequence[Column | str], carry: Sequence[str]) -> DataFrame:
    """Link every key level by level: the first row of each (key, level), each joined to the next level's."""
    one = first_by(df, [*keys, level], order)
    w = _w(keys, [level])
    cols = [F.col(k) for k in keys] + [F.col(level).alias(f"from_{level}"), F.lead(level).over(w).alias(f"to_{level}")]
    for c in carry:
        cols += [F.col(c).alias(f"from_{c}"), F.lead(c).over(w).alias(f"to_{c}")]
    return one.select(*cols).where(F.col(f"to_{level}").isNotNull())


def priority_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], carry: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """Left join on the first key pair that matches: one equi-join per key and a coalesce, never an OR, which would be a nested loop.

    Every left row comes back once. Of right rows that share a key the first in ``order`` counts, by default in the order of the carried columns.
    """
    out = left
    own = free_names([*left.columns, *carry], *(f"__{x}{n}" for x in "km" for n in range(len(keys))))
    found, rows = own[: len(keys)], own[len(keys) :]
    for k, m, (lk, rk) in zip(found, rows, keys, strict=True):
        one = first_by(right.where(F.col(rk).isNotNull()), [rk], list(order) or list(carry))
        out = out.join(one.select(F.col(rk).alias(k), F.struct(*carry).alias(m)), F.col(lk) == F.col(k), "left")
    hit = F.coalesce(*map(F.col, rows))
    return out.withColumns({c: hit[c] for c in carry}).drop(*own)


def multi_key_lookup(left: DataFrame, right: DataFrame, left_id: str, keys: Sequence[tuple[str, str]], scope: Keys, value: str, right_order: str) -> DataFrame:
    """Lookup by several keys in turn inside a scope; of right rows that share a key the one with the largest right_order wins."""

    def unpivot(df: DataFrame, side: int, extra: Sequence[str]) -> DataFrame:
        pairs = F.array(*(F.struct(F.lit(n).alias("n"), F.col(k[side]).cast("string").alias("v")) for n, k in enumerate(keys)))
        return df.select(*extra, *scope, F.explode(pairs).alias("__k")).select(*extra, *scope, "__k.n", "__k.v").where("v is not null and v <> ''")

    index = first_by(unpivot(right, 1, [value, right_order]), [*scope, "n", "v"], [F.desc(right_order)]).drop(right_order)
    hits = unpivot(left, 0, [left_id]).join(index, [*scope, "n", "v"])
    return left.join(first_by(hits, [left_id], ["n"]).select(left_id, value), left_id, "left")


def fallback_union(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """All of left, and of right the rows whose key left lacks."""
    return left.unionByName(right.join(left.select(*keys).distinct(), list(keys), "left_anti"))


def upsert_if_absent(left: DataFrame, new: DataFrame, keys: Keys) -> DataFrame:
    """Rows of new are added only under keys that left lacks, once each."""
    return fallback_union(left, new.dropDuplicates(list(keys)), keys)


def first_writer_distinct(sources: Sequence[DataFrame], keys: Keys, order: Sequence[Column | str]) -> DataFrame:
    """Union in which the earliest source, then the earliest row, owns a key."""
    all_ = None
    for n, s in enumerate(sources):
        s = s.withColumn("source_rank", F.lit(n))
        all_ = s if all_ is None else all_.unionByName(s)
    return first_by(all_, keys, ["source_rank", *order])


def undirected(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def insert_undirected(edges: DataFrame, new: DataFrame, a: str, b: str, order: Sequence[Column | str]) -> DataFrame:
    """New edges that no edge has in either direction, each once (the first in order)."""
    own = free_names([*edges.columns, *new.columns], "__lo", "__hi")
    key = lambda d: d.withColumns(dict(zip(own, undirected(F.col(a), F.col(b)), strict=True)))
    fresh = key(new).join(key(edges).select(*own).distinct(), own, "left_anti")
    return first_by(fresh, own, order).drop(*own)


def mode_by(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    """Most frequent value, null and "" apart; the smallest on a tie."""
    counts = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).count()
    best = counts.groupBy(*keys).agg(F.max("count").alias("count"))
    return counts.join(best, [*keys, "count"]).groupBy(*keys).agg(F.min(value).alias(value), F.first("count").alias("n"))


def status_summary(df: DataFrame, status: str, known: Sequence[str]) -> DataFrame:
    """Counts by status; known statuses are there even with 0, unknown ones are added."""
    base = df.sparkSession.createDataFrame([(k,) for k in known], f"{status} string")
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n")).join(base, status, "full").select(status, F.coalesce("n", F.lit(0)).alias("n"))


def dedupe_with_suffix(df: DataFrame, keys: Keys, order: Sequence[Column | str], name: str, suffix: Column) -> DataFrame:
    """The first of equal names keeps it; the others get the suffix."""
    rn = F.row_number().over(_w([*keys, name], order))
    return df.withColumn(name, F.when(rn == 1, F.col(name)).otherwise(F.concat(F.col(name), suffix)))


def islands(df: DataFrame, keys: Keys, order: Sequence[Column | str], change: Column, name: str = "island") -> DataFrame:
    """Number of the run of rows without a change; change may use lag over the same order."""
    w = _w(keys, order)
    (c,) = free_names([*df.columns, name], "__c")
    return df.withColumn(c, F.when(change, 1).otherwise(0)).withColumn(name, F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop(c)


def changed(col: str, keys: Keys, order: Sequence[Column | str]) -> Column:
    """This row differs from the one before it (the first row counts as changed)."""
    before = F.lag(col).over(_w(keys, order))
    return before.isNull() | (before != F.col(col))


def last_kept(points: Column, x: str, z: str, gap: float) -> Column:
    """Ordered array of structs without those closer than gap to the last one kept. Sequential by nature: what is dropped changes the next comparison."""
    far = lambda acc, p: (F.size(acc) == 0) | (F.hypot(F.try_element_at(acc, F.lit(-1))[x] - p[x], F.try_element_at(acc, F.lit(-1))[z] - p[z]) >= gap)
    return F.aggregate(F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1), lambda acc, p: F.when(far(acc, p), F.array_append(acc, p)).otherwise(acc))


def gap_stitch(df: DataFrame, keys: Keys, order: Sequence[Column | str], step: str, klass: str, x: str, z: str, inside: Column, connector: str = "connector") -> DataFrame:
    """Segments between consecutive outdoor points; where a step changes and the points differ the segment is a connector over what lay between."""
    w = _w(keys, order)
    prev = lambda c: F.lag(c).over(w)
    (s,) = free_names(df.columns, "__s")
    out = df.where(~inside).select("*", prev(x).alias("x1"), prev(z).alias("z1"), prev(step).alias(s))
    same = F.col(s) == F.col(step)
    moved = (F.col("x1") != F.col(x)) | (F.col("z1") != F.col(z))
    return out.where(F.col(s).isNotNull() & (same | moved)).withColumn("class", F.when(same, F.col(klass)).otherwise(connector)).drop(s)


def checkpointed(df: DataFrame) -> DataFrame:
    """checkpoint() into spark.checkpoint.dir; where that is unset, a temporary folder on a local master and an error on any other."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """0, 1, 2 ... over the whole table: a range sort, then an offset per partition. Only one count per partition meets in one task."""
    p, i, n, start = free_names([*df.columns, name], "__p", "__i", "__n", "__start")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(placed.withColumns({p: F.spark_partition_id(), i: F.monotonically_increasing_id() % (1 << 33)}))
    counts = placed.groupBy(p).agg(F.count(F.lit(1)).alias(n))
    before = Window.orderBy(p).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(p, (F.sum(n).over(before) - F.col(n)).alias(start))
    return placed.join(F.broadcast(starts), p).withColumn(name, F.col(i) + F.col(start)).drop(p, i, start)


def index_percentiles(df: DataFrame, value: str, qs: Sequence[float]) -> DataFrame:
    """(q, value): for every q the value at place floor(n*q) of the sorted column, without interpolation. The column is numbered once."""
    numbered = global_row_number(df.where(F.col(value).isNotNull()).select(value), [value], "__at")
    total = numbered.agg(F.count(F.lit(1)).alias("__total"))
    places = total.select(F.explode(F.array(*(F.struct(F.lit(float(q)).alias("q"), F.floor(F.col("__total") * q).alias("__at")) for q in qs)))).select("col.*")
    return numbered.join(F.broadcast(places), "__at").select("q", value)


def index_percentile(df: DataFrame, value: str, q: float) -> DataFrame:
    """Value at place floor(n*q) of the sorted column, without interpolation."""
    return index_percentiles(df, value, [q]).select(value)


def systematic_sample(df: DataFrame, keys: Keys, order: Sequence[Column | str], k: int) -> DataFrame:
    """k rows of each key, evenly spread: those at places floor(i n / k)."""
    w = _w(keys, order)
    i, n = free_names(df.columns, "__i", "__n")
    out = df.withColumn(i, F.row_number().over(w) - 1).withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    j = F.ceil(F.col(i) * k / F.col(n))
    return out.where((F.floor(j * F.col(n) / k) == F.col(i)) & (j < k)).drop(i, n)


def split_with_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with the reason): the first broken rule is the reason."""
    reason = F.coalesce(*(F.when(c, F.lit(name)) for name, c in rules))
    flagged = df.withColumn("reason", reason)
    return flagged.where("reason is null").drop("reason"), flagged.where("reason is not null")


def optional_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """IN-list filter; an empty list is no filter."""
    return df.where(F.col(col).isin(*values)) if values else df


def nonempty(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error if it has no rows (asked with a one-row job)."""
    if df.isEmpty():
        raise ValueError(f"no rows left: {what}")
    return df
