"""Stateful operators for Structured Streaming: deduplication by time, running stock, windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import TimestampType


def fresh_stream(events: DataFrame, key: str, ts: str, ttl_ms: int | None = None, late: str = "10 minutes", arrival: str = "arrival") -> DataFrame:
    """Rows whose ts is above every earlier one of their key; rows with a null key all stay.

    State: the largest ts of a key. With ttl_ms (ts must then be a timestamp) it is purged once the watermark, `late` behind the
    newest time, has passed that time by so much; rows behind the watermark are late and left out. A micro-batch's rows of one key are
    sorted by arrival in memory; the files or offsets of a trigger bound them.
    """
    timed = isinstance(events.schema[ts].dataType, TimestampType)
    if ttl_ms is not None:
        if not timed:
            raise ValueError(f"a ttl needs {ts} to be a timestamp")
        events = events.withWatermark(ts, late)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        top = state.get[0] if state.exists else None
        frame = pd.concat(frames).sort_values(arrival, kind="stable")
        times = frame[ts].astype("datetime64[us]") if timed else frame[ts]
        keep = []
        for t in times.astype("int64"):
            keep.append(top is None or t > top)
            top = t if top is None else max(top, t)
        state.update((int(top),))
        if ttl_ms is not None:
            state.setTimeoutTimestamp(max(int(top) // 1000 + ttl_ms, state.getCurrentWatermarkMs() + 1))
        yield frame[keep]

    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.EventTimeTimeout
    keyed = events.where(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(step, events.schema, "top long", "append", timeout)
    return keyed.union(events.where(F.col(key).isNull()))


def stock_stream(changes: DataFrame, key: str, change: str, snapshot: str | None = None, order: str | None = None) -> DataFrame:
    """key, stock, transactions after each micro-batch that touched the key. snapshot: a column that, where not null, replaces the
    stock; a micro-batch's rows of a key are then taken in the order of a column."""
    if snapshot is not None and order is None:
        raise ValueError("snapshots need an order")

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stock, n = state.get if state.exists else (0, 0)
        if snapshot is None:
            for f in frames:
                stock, n = stock + int(f[change].sum()), n + len(f)
        else:
            rows = pd.concat(frames).sort_values(order, kind="stable")
            n += len(rows)
            for c, s in zip(rows[change].fillna(0), rows[snapshot], strict=True):
                stock = int(s) if pd.notna(s) else stock + int(c)
        state.update((stock, n))
        yield pd.DataFrame({key: [k[0]], "stock": [stock], "transactions": [n]})

    return changes.groupBy(key).applyInPandasWithState(step, f"`{key}` string, stock long, transactions long", "stock long, n long", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, ts: str, key: str, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts by window and key that close when the watermark passes; works on batches too."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def sessions(events: DataFrame, ts: str, key: str, late: str = "10 minutes", gap: str = "30 minutes") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
