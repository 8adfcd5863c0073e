"""Running streams: callbacks on their progress, heartbeats, a graceful end."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

Callback = Callable[[dict[str, Any]], None]
EVENTS = ("started", "progress", "idle", "terminated")


class Callbacks(StreamingQueryListener):
    """Functions called with what happens to streams; one that fails is noted in `failures` and hinders neither the others nor a stream."""

    def __init__(self) -> None:
        self._by: dict[str, list[Callback]] = {e: [] for e in EVENTS}
        self.failures: list[Exception] = []

    def register(self, event: str, fn: Callback) -> None:
        if event not in EVENTS:
            raise ValueError(f"unknown event {event!r}")
        self._by[event].append(fn)

    def unregister(self, event: str, fn: Callback) -> None:
        if fn in self._by.get(event, []):
            self._by[event].remove(fn)

    def _tell(self, event: str, what: dict[str, Any]) -> None:
        for fn in list(self._by[event]):
            try:
                fn(what)
            except Exception as e:
                self.failures.append(e)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._tell("started", {"name": event.name, "id": str(event.id)})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self._tell("progress", json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._tell("idle", {"id": str(event.id), "timestamp": event.timestamp})

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._tell("terminated", {"id": str(event.id), "exception": event.exception})


def heartbeat_of(progress: dict[str, Any]) -> dict[str, Any]:
    """What a stream's progress says of its health: rows, and how far it has read."""
    sources = progress.get("sources") or []
    return {"type": "heartbeat", "collection": progress.get("name"), "timestamp": progress["timestamp"], "status": {"is_running": True, "batch": progress["batchId"], "rows": progress["numInputRows"], "rows_per_second": progress.get("processedRowsPerSecond"), "has_resume_token": any(s.get("endOffset") is not None for s in sources)}}


def send_heartbeats(callbacks: Callbacks, send: Callback) -> None:
    """Every progress of a stream, and every time it idles, is sent as a heartbeat."""
    callbacks.register("progress", lambda p: send(heartbeat_of(p)))
    callbacks.register("idle", lambda p: send({"type": "heartbeat", "timestamp": p["timestamp"], "status": {"is_running": True, "rows": 0}}))


#: What an error's text says of itself: these don't go away by trying again.
LASTING = ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN", "TransformError", "PERMISSION", "AnalysisException", "ValueError", "STATE_STORE_KEY_SCHEMA", "INCOMPATIBLE")


def lasting(error: Exception) -> bool:
    return any(word in str(error) for word in LASTING)


def kept_running(start: Callable[[], StreamingQuery], tries: int = 5, first: float = 1.0, factor: float = 2.0, most: float = 60.0, fatal: Callable[[Exception], bool] = lasting, told: Callback | None = None, sleep: Callable[[float], None] = time.sleep) -> StreamingQuery:
    """Wait for a stream, and start it anew from its checkpoint each time that it fails: after a delay that grows, and is the first again once it made
    progress. An error that won't go away, or the last of `tries` without progress, is raised. The query that ended without one.

    start: makes and starts the stream, the same each time. told: is told of every failure.
    """
    failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception as e:
            advanced = any(p["numInputRows"] > 0 for p in query.recentProgress)
            failures = 1 if advanced else failures + 1
            if told is not None:
                told({"type": "failure", "collection": query.name, "attempt": failures, "error": str(e)})
            if fatal(e) or failures >= tries:
                raise
            sleep(min(most, first * factor ** (failures - 1)))


def stop_all(spark: SparkSession, drain: bool = True, seconds: float = 60.0) -> list[str]:
    """Stop every stream of a session; with drain, first let each finish what it can read now. Names or ids of those that failed before."""
    failed = []
    for q in spark.streams.active:
        if not stopped(q, drain, seconds):
            failed.append(q.name or str(q.id))
    return failed


def stopped(query: StreamingQuery, drain: bool = True, seconds: float = 60.0) -> bool:
    """Stop a stream; whether it did without an error. What a batch has begun is done again from the checkpoint at the next start."""
    if drain and query.isActive:
        try:
            query.processAllAvailable()
        except Exception:
            query.stop()
            return False
    query.stop()
    query.awaitTermination(seconds)
    return query.exception() is None
