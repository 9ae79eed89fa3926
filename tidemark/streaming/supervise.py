"""Supervision and progress reporting for groups of streaming queries."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class StreamFailed(RuntimeError):
    pass


def supervise(queries: Sequence[StreamingQuery], poll_seconds: float = 30.0,
              on_progress: Callable[[dict[str, int]], None] | None = None,
              until_done: bool = True) -> None:
    """Watch a linked group of queries.

    A query that ends with an error takes its siblings down and its error is raised, so
    the caller's process exits non-zero and a restart policy can act. ``until_done``
    tells what an end without error means: normal for queries that finish (an
    ``availableNow`` run; returns when all have), else a failure like any other, as
    queries of a service are not meant to end.
    """
    queries = list(queries)
    while queries:
        ended = [q for q in queries if not q.isActive]
        failed = next((q for q in ended if q.exception() is not None), None)
        if failed is not None or (ended and not until_done):
            for q in queries:
                if q.isActive:
                    q.stop()
            bad = failed or ended[0]
            cause = bad.exception()
            raise StreamFailed(f"stream {bad.name or bad.id} ended: {cause or 'stopped'}") from cause
        if len(ended) == len(queries):
            return
        if on_progress is not None:
            on_progress({(q.name or str(q.id)): (q.lastProgress or {}).get("numInputRows", 0)
                         for q in queries})
        _wait_for_end([q for q in queries if q.isActive], poll_seconds)


def drain(queries: Sequence[StreamingQuery]) -> None:
    """Let running queries finish what their sources hold now, then stop them.

    For queries on a processing-time trigger; the error of one that fails is raised.
    """
    try:
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()


def _wait_for_end(active: Sequence[StreamingQuery], seconds: float) -> None:
    """Return after ``seconds``, or as soon as one of ``active`` has ended."""
    until = time.monotonic() + seconds
    while active and all(q.isActive for q in active) and (left := until - time.monotonic()) > 0:
        time.sleep(min(left, 0.2))


class ProgressLog(StreamingQueryListener):
    """The last ``keep`` finished micro-batches: query name, batch id, input
    rows, rows dropped by watermark and state rows (W7)."""

    def __init__(self, keep: int = 1000):
        self._rows: deque[dict] = deque(maxlen=keep)
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        ops = p.stateOperators or []
        row = {
            "name": p.name, "batch_id": p.batchId, "num_input_rows": p.numInputRows,
            "rows_dropped_by_watermark": sum(o.numRowsDroppedByWatermark for o in ops),
            "state_rows": sum(o.numRowsTotal for o in ops),
            "watermark": (p.eventTime or {}).get("watermark"),
        }
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def rows(self, name: str | None = None) -> list[dict]:
        with self._lock:
            return [r for r in self._rows if name is None or r["name"] == name]

    def attach(self, spark: SparkSession) -> "ProgressLog":
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)
