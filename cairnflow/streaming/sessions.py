"""Runs of equal events per key over an unbounded stream. An extension beyond the batch operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def session_counts(events: DataFrame, key: str, ts: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Events per session: a session ends after ``gap`` without events; rows later than ``late`` are dropped by the watermark."""
    s = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key)
    return s.agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def window_counts(events: DataFrame, ts: str, kind: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per tumbling window and kind."""
    g = events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), kind, "n")


def running_islands(events: DataFrame, key: str, ts: str, kind: str, idle_ms: int = 3_600_000, late: str = "10 minutes") -> DataFrame:
    """(key, island, kind, n): finished runs of equal kinds, emitted when the kind changes or the watermark has left the key idle. State per key is one run."""

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        island, now, n = state.get if state.exists else (0, None, 0)
        out = []
        last = 0
        if state.hasTimedOut:
            out.append((k[0], island, now, n))
            state.remove()
        else:
            for pdf in pdfs:
                for v in pdf.sort_values(ts)[kind]:
                    if v == now:
                        n += 1
                        continue
                    if now is not None:
                        out.append((k[0], island, now, n))
                    island, now, n = island + 1, v, 1
                last = max(last, int(pdf[ts].max().timestamp() * 1000))
            state.update((island, now, n))
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + idle_ms)
        yield pd.DataFrame(out, columns=[key, "island", kind, "n"])

    types = dict(events.dtypes)
    return events.withWatermark(ts, late).groupBy(key).applyInPandasWithState(step, f"{key} {types[key]}, island long, {kind} {types[kind]}, n long", f"island long, kind {types[kind]}, n long", "append", GroupStateTimeout.EventTimeTimeout)
