"""What running jobs did, as a table: progress, rule counts, late rows, dropped keys.

``MetricsTable`` listens to the queries of a session and writes one JSON line per finished
micro-batch below ``path``: input rows, rows dropped behind the watermark, state rows,
the watermark, and every observed count of the plan (``observe_rules`` puts the rows and
rejects per rule into a plan). Lines wait on the driver until ``LINES`` of them or a
``flush``; each write is one small file, complete when it appears. A batch that
ran twice has two lines, ``read_metrics`` shows the last one.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.validate import default_rules, first_failed_rule
from .sinks import write_lines

SCHEMA = ("query string, query_id string, batch_id long, at timestamp, input_rows long, late_rows long, "
          "state_rows long, watermark timestamp, counts map<string,long>")
#: lines held on the driver (most)
LINES = 200
RULES = "rules"


def observe_rules(events: DataFrame) -> DataFrame:
    """``events`` with its rows, and its rejects by first failing rule, observed as ``rules``."""
    failed = first_failed_rule()
    return events.observe(RULES, F.count(F.lit(1)).alias("rows"),
                          *(F.count(F.when(failed == name, 1)).alias(name) for name, _ in default_rules()))


class MetricsTable(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._lines: list[dict] = []
        self._last: dict[str, int] = {}
        self._lock = threading.Lock()
        self._writing = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        ops = p.stateOperators or []
        counts = {key: value for row in (p.observedMetrics or {}).values() for key, value in row.asDict().items()}
        self._add({"query": p.name, "query_id": str(p.id), "batch_id": p.batchId, "at": p.timestamp,
                   "input_rows": p.numInputRows, "late_rows": sum(o.numRowsDroppedByWatermark for o in ops),
                   "state_rows": sum(o.numRowsTotal for o in ops),
                   "watermark": (p.eventTime or {}).get("watermark"), "counts": counts})

    def append(self, report: dict) -> None:
        """A line of an export: its ``name`` and its numbers (the form ``merge_sink`` reports in)."""
        counts = {k: int(v) for k, v in report.items() if isinstance(v, int)}
        self._add({"query": report.get("name", "export"), "query_id": report.get("name", "export"),
                   "batch_id": report.get("version"), "at": dt.datetime.now(dt.timezone.utc).isoformat(),
                   "input_rows": counts.get("rows"), "counts": counts})

    def _add(self, line: dict) -> None:
        with self._lock:
            self._lines.append(line)
            if line["batch_id"] is not None:
                self._last[line["query_id"]] = max(self._last.get(line["query_id"], -1), line["batch_id"])
            full = len(self._lines) >= LINES
        if full:
            self.flush()

    def flush(self) -> None:
        with self._writing:  # a flush ends after the one that is under way on another thread
            with self._lock:
                lines, self._lines = self._lines, []
            if lines:
                write_lines(self.spark, self.path, f"{uuid.uuid4().hex}.json", lines)

    def attach(self) -> "MetricsTable":
        self.spark.streams.addListener(self)
        return self

    def detach(self, queries: Sequence[StreamingQuery] = (), seconds: float = 20.0) -> None:
        """Stop listening once the last batch of ``queries`` has come (events are sent later), and flush."""
        until = time.monotonic() + seconds
        for q in queries:
            last = q.lastProgress
            while last and self._last.get(str(q.id), -1) < last["batchId"] and time.monotonic() < until:
                time.sleep(0.1)
        self.spark.streams.removeListener(self)
        self.flush()


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch."""
    lines = spark.read.schema(SCHEMA).option("pathGlobFilter", "*.json").json(path)
    rest = [c for c in lines.columns if c not in ("query_id", "batch_id")]
    last = lines.groupBy("query_id", "batch_id").agg(F.max_by(F.struct(*rest), "at").alias("l"))
    return last.select("query_id", "batch_id", "l.*")
