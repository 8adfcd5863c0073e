"""Stateful operators with typed state on RocksDB: deduplication, images before and after, thresholds as of an event, all restartable from a checkpoint.

The session's spark.sql.streaming.stateStore.providerClass must be ROCKSDB. A key's rows of one micro-batch are sorted in memory; the files or
offsets of a trigger bound them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidewire.functions.serialization import JSON_OPTIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def on_rocksdb(df: DataFrame) -> DataFrame:
    """df, with its session's state kept in RocksDB from now on."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return df


def _filled(rows: Iterator[pd.DataFrame]) -> list[pd.DataFrame]:
    """The frames that have rows: a key that has only a timer or an initial state comes with an empty one, which has no columns."""
    return [frame for frame in rows if len(frame)]


def _micros(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64")


class Freshest(StatefulProcessor):
    """Lets rows pass whose time is above every earlier one of their key and operation."""

    def __init__(self, idle_ms: int | None, operation: str, ts: str, arrival: str):
        self.idle_ms, self.operation, self.ts, self.arrival = idle_ms, operation, ts, arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tops = handle.getMapState("tops", "operation string", "top long")
        self.until = handle.getValueState("until", "ms long")

    def _passes(self, operation: str | None, now: int) -> bool:
        own = (operation if operation is not None else "",)
        if self.tops.containsKey(own) and now <= self.tops.getValue(own)[0]:
            return False
        self.tops.updateValue(own, (now,))
        return True

    def _rest(self, timers: Any) -> None:
        """The key goes when it has been idle for so long; a timer of before that does nothing."""
        if self.idle_ms is not None:
            at = timers.getCurrentProcessingTimeInMs() + self.idle_ms
            if self.until.exists():
                self.handle.deleteTimer(self.until.get()[0])
            self.until.update((at,))
            self.handle.registerTimer(at)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:  # noqa: N802, N803
        for operation, now in zip(initialState[self.operation], _micros(initialState[self.ts]), strict=True):
            self._passes(operation, int(now))
        self._rest(timerValues)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not (frames := _filled(rows)):
            return
        frame = pd.concat(frames).sort_values(self.arrival, kind="stable")
        passes = [self._passes(o, int(t)) for o, t in zip(frame[self.operation], _micros(frame[self.ts]), strict=True)]
        self._rest(timerValues)
        yield frame[passes]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.tops.clear()
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def freshest(changes: DataFrame, idle_ms: int | None = None, known: DataFrame | None = None, ts: str = "cluster_time", arrival: str = "resume_token") -> DataFrame:
    """The changes that cdc.deduplicated would keep, as a stream: state of collection and document_key, a map of operations to their newest times.

    idle_ms: a key is forgotten when it has had no change for so long, by a processing-time timer, whether or not others have any. known: changes that
    are there before the stream starts, from a batch. Changes without a key all pass.
    """
    changes = on_rocksdb(changes)
    keyed = changes.where("document_key is not null and document_key <> ''")
    start = None if known is None else known.where("document_key is not null and document_key <> ''").select("collection", "document_key", "operation_type", ts).groupBy("collection", "document_key")
    mode = "none" if idle_ms is None else "processingTime"
    processor = Freshest(idle_ms, "operation_type", ts, arrival)
    passed = keyed.groupBy("collection", "document_key").transformWithStateInPandas(processor, _nullable(changes.schema), "append", mode, start)
    return passed.unionByName(changes.where("document_key is null or document_key = ''"))


def _nullable(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class Images(StatefulProcessor):
    """Adds the document before and after each change."""

    def __init__(self, arrival: str):
        self.arrival = arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "document string")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:  # noqa: N802, N803
        for document in initialState["document"]:
            self._set(document)

    def _set(self, document: str | None) -> None:
        if document is None:
            self.now.clear()
        else:
            self.now.update((document,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not (frames := _filled(rows)):
            return
        frame = pd.concat(frames).sort_values(self.arrival, kind="stable")
        now = self.now.get()[0] if self.now.exists() else None
        before, after = [], []
        for operation, document in zip(frame["operation_type"], frame["full_document"], strict=True):
            before.append(now)
            now = None if operation == "delete" else now if document is None else document
            after.append(now)
        self._set(now)
        yield frame.assign(before=before, after=after)

    def close(self) -> None:
        pass


def images_stream(changes: DataFrame, known: DataFrame | None = None, arrival: str = "resume_token") -> DataFrame:
    """history.images as a stream: the state is each document as it is. known: collection, document_key, document before the stream starts.
    history.retracted and history.deltas take the result, so totals are kept up batch by batch. Changes without a key have no document and are left out."""
    changes = on_rocksdb(changes)
    start = None if known is None else known.select("collection", "document_key", "document").groupBy("collection", "document_key")
    keyed = changes.where("document_key is not null").groupBy("collection", "document_key")
    return keyed.transformWithStateInPandas(Images(arrival), _nullable(changes.schema) + ", before string, after string", "append", "none", start)


class AsOf(StatefulProcessor):
    """Holds events until the watermark has passed them, and gives each the value that was set last before it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sets = handle.getMapState("sets", "at long", "value long")
        self.waiting = handle.getMapState("waiting", "at long, n long", "event string")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in _filled(rows):
            n = self.count.get()[0] if self.count.exists() else 0
            for t, event, value in zip(_micros(frame["at"]).tolist(), frame["event"], frame["value"], strict=True):
                if event is None:
                    held = self.sets.getValue((t,))[0] if self.sets.containsKey((t,)) else None
                    # Of two that were set at one time the larger counts, whatever came first.
                    self.sets.updateValue((t,), (int(value) if held is None else max(int(value), held),))
                else:
                    n += 1
                    self.waiting.updateValue((t, n), (event,))
                # What was set is cut down, and what waits is given out, when its time is over.
                self.handle.registerTimer(t // 1000 + 1)
            self.count.update((n,))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = expiredTimerInfo.getExpiryTimeInMs() * 1000
        sets = sorted((k[0], v[0]) for k, v in self.sets.iterator())
        out = []
        for k in sorted(k for k in self.waiting.keys() if k[0] < until):
            found = [value for t, value in sets if t <= k[0]]
            out.append((self.waiting.getValue(k)[0], str(found[-1]) if found else None))
            self.waiting.removeKey(k)
        # What was set before the last one that is over counts no more.
        for t, _ in [s for s in sets if s[0] < until][:-1]:
            self.sets.removeKey((t,))
        if out:
            yield pd.DataFrame(out, columns=["event", "value"])

    def close(self) -> None:
        pass


def thresholds_stream(events: DataFrame, updates: DataFrame, key: str, ts: str, column: str = "threshold", late: str = "10 minutes") -> DataFrame:
    """inventory.current_thresholds as a stream, of both sides: events with the threshold that was last set for their key at or before their time (updates: key, ts,
    column of whole numbers), null before the first.

    An event waits until the watermark, `late` behind the newest time of either side, has passed it, so an update that comes late counts as long
    as it isn't behind the watermark. State: the thresholds that may still count, and the events that wait.
    """
    rows = events.select(F.col(key).alias("of"), F.col(ts).alias("at"), F.to_json(F.struct("*"), JSON_OPTIONS).alias("event"), F.lit(None).cast("string").alias("value"))
    sets = updates.select(F.col(key).alias("of"), F.col(ts).alias("at"), F.lit(None).cast("string").alias("event"), F.col(column).cast("string").alias("value"))
    both = on_rocksdb(rows).unionByName(sets).where("of is not null and (event is not null or value is not null)").withWatermark("at", late)
    found = both.groupBy("of").transformWithStateInPandas(AsOf(), "event string, value string", "append", "eventTime")
    return found.select(F.from_json("event", events.schema, JSON_OPTIONS).alias("e"), F.col("value").cast("long").alias(column)).select("e.*", column)
