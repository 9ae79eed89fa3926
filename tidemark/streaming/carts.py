"""Abandoned carts on a stream (R2 with arbitrary state).

A cart entry, i.e. an add of a product by a user, is abandoned when the pair shows no
purchase from the add on and no further add after it within ``abandon_after``. The
stream says so once, as soon as its watermark passes that time.

Per (user, product) the event times that can still matter are kept: adds not yet decided,
and the times that close an earlier or a late add. A time between two others that are at
most ``abandon_after`` apart closes nothing that the later of the two does not close as
well, so it is dropped: a pair holds at most two times per ``abandon_after`` of watermark
delay, whatever a bot sends. The same rule thins each task's rows before the shuffle, so a
hot pair sends a few rows a task.

The pairs are dealt to ``BUCKETS`` by hash, and a bucket is the key of the state: one list
with the times of its pairs, and one timer at the earliest time to be decided, which wakes
the bucket when no event comes. So a batch costs some state calls a bucket, not a pair;
with the last time the state of the bucket is gone. The number of buckets is part of a
checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ADD, PURCHASE = "add_to_cart", "purchase"
PAIR = ("user_id", "product_id")
SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("product_id", T.StringType()),
                       T.StructField("added_at", T.TimestampType()),
                       T.StructField("abandoned_at", T.TimestampType())])
#: pairs a task remembers while it thins its rows
REMEMBERED = 100_000
#: keys of the state that the pairs are dealt to
BUCKETS = 512


def thinned(times: Iterable[tuple[int, bool]], after: int) -> list[tuple[int, bool]]:
    """(time, bought) ascending, one per time, without those that close nothing of their own."""
    merged: dict[int, bool] = {}
    for at, bought in times:
        merged[at] = merged.get(at, False) or bought
    kept: list[tuple[int, bool]] = []
    for at, bought in sorted(merged.items()):
        while len(kept) > 1 and at - kept[-2][0] <= after:
            kept.pop()
        kept.append((at, bought))
    return kept


def _alone(times: list[tuple[int, bool]], k: int, after: int) -> bool:
    """Whether time ``k`` is an add that nothing known closes."""
    at, bought = times[k]
    return not bought and (k + 1 == len(times) or times[k + 1][0] - at > after)


def decided(times: list[tuple[int, bool]], after: int, now: int) -> tuple[list[int], list[tuple[int, bool]]]:
    """Abandoned adds as of watermark ``now``, and the times that still matter after it."""
    gone, left = [], []
    for k, (at, bought) in enumerate(times):
        alone = _alone(times, k, after)
        if alone and at + after <= now:
            gone.append(at)
        elif at > now or alone:
            left.append((at, bought))
    return gone, left


class _Carts(StatefulProcessor):
    def __init__(self, after: int):
        self.after = after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "user_id string, product_id string, at long, bought boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(u, p, int(at), bool(bought)) for part in rows
               for u, p, at, bought in zip(part["user_id"], part["product_id"], part["at"], part["bought"], strict=True)]
        yield from self._step(new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step([], timerValues)

    def _step(self, new, timerValues) -> Iterator[pd.DataFrame]:
        now = max(0, timerValues.getCurrentWatermarkInMs()) * 1000
        old = list(self.times.get()) if self.times.exists() else []
        pairs: dict[tuple, list] = {}
        for u, p, at, bought in (*old, *new):
            pairs.setdefault((u, p), []).append((at, bought))
        out, kept, first = [], [], None
        for (u, p), times in pairs.items():
            gone, left = decided(thinned(times, self.after), self.after, now)
            out += [(u, p, at) for at in gone]
            kept += [(u, p, at, bought) for at, bought in left]
            for k, (at, _) in enumerate(left):
                # the next time that is decided, or can no longer close a late add
                due = at + self.after if _alone(left, k, self.after) else at
                first = due if first is None else min(first, due)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if kept:
            self.times.put(kept)
            self.handle.registerTimer(-(-first // 1000))
        elif old:
            self.times.clear()
        if out:
            users, products, added = zip(*out, strict=True)
            yield pd.DataFrame({"user_id": users, "product_id": products,
                                "added_at": pd.to_datetime(added, unit="us", utc=True),
                                "abandoned_at": pd.to_datetime([at + self.after for at in added], unit="us", utc=True)})

    def close(self) -> None:
        pass


def _thin(after: int):
    """Drop what ``thinned`` drops among the rows of a task seen so far, batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[tuple, list] = {}
        schema = None

        def flush() -> pa.RecordBatch:
            rows = [(u, p, at, bought) for (u, p), times in pairs.items() for at, bought in thinned(times, after)]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            schema = batch.schema
            for u, p, at, bought in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs.setdefault((u, p), []).append((at, bought))
            if len(pairs) > REMEMBERED:
                yield flush()
                pairs.clear()
            else:
                pairs.update({k: thinned(v, after) for k, v in pairs.items() if len(v) > 64})
        if pairs:
            yield flush()
    return run


def abandoned_carts(events: Sequence[DataFrame], delay: str, abandon_after: str = "1 hour") -> DataFrame:
    """Stream of (user_id, product_id, added_at, abandoned_at) from streams of silver events.

    Each stream gets a watermark of ``delay`` behind its own adds and purchases, and the
    slowest one decides. A null user or product makes a pair of its own. Events behind the
    watermark are ignored, as by every stateful operator.
    """
    session = events[0].sparkSession
    after = session.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {abandon_after})")).first()[0]
    moves = [e.where(F.col("event_type").isin(ADD, PURCHASE))
             .select(*PAIR, F.unix_micros("event_time").alias("at"), (F.col("event_type") == PURCHASE).alias("bought"))
             .mapInArrow(_thin(after), "user_id string, product_id string, at long, bought boolean")
             .withColumn("event_time", F.timestamp_micros("at")).withWatermark("event_time", delay) for e in events]
    joined = moves[0]
    for more in moves[1:]:
        joined = joined.unionByName(more)
    bucket = F.pmod(F.xxhash64(*PAIR), F.lit(BUCKETS)).alias("bucket")
    return joined.select("*", bucket).groupBy("bucket").transformWithStateInPandas(
        _Carts(after), outputStructType=SCHEMA, outputMode="Append", timeMode="EventTime")
