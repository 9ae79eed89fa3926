"""Deduplication by key.

Streaming: state bounded by the watermark (``dropDuplicatesWithinWatermark``);
``unbounded=True`` keeps every key forever, as the reference job does.
Batch: with ``order_by`` the first row in that order wins, deterministically.
It is written as ``row_number() = 1``, which the optimizer turns into a
partial top-1 per key *before* the shuffle (``WindowGroupLimit ... Partial``)
and a final one after it: a key repeated across a third of the input still
sends at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: keys a task of ``precombine`` remembers
REMEMBERED = 500_000


def dedup(df: DataFrame, keys: Sequence[str] = ("event_id",),
          order_by: Sequence[str] | None = None, unbounded: bool = False) -> DataFrame:
    keys = list(keys)
    if df.isStreaming:
        if unbounded:
            return df.dropDuplicates(keys)
        return df.dropDuplicatesWithinWatermark(keys)
    if not order_by:
        return df.dropDuplicates(keys)
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_arrival", F.row_number().over(first))
              .where(F.col("_arrival") == 1).drop("_arrival"))


def precombine(df: DataFrame, keys: Sequence[str] = ("event_id",),
               time_col: str = "event_time") -> DataFrame:
    """Drop repeats of (keys, time) inside each input partition, before the shuffle.

    Spark's streaming dedup has no partial step: every copy of a replayed
    message travels to the task owning its key. This stateless pass (allowed
    on streams) drops copies that an input partition has just seen. Only exact
    repeats of (keys, event time) are removed - copies the stateful dedup would
    drop anyway - so results are unchanged. The key is built by built-in
    functions; the pass remembers at most ``REMEMBERED`` keys and starts anew
    beyond that, as a copy it lets through costs only its shuffle. Opt-in: it
    costs an Arrow round trip for every row.
    """
    marked = df.withColumn("_copy_key", F.to_json(F.struct(*keys, time_col)))

    def first_copies(batches: Iterator) -> Iterator:
        seen: set[str] = set()
        for batch in batches:
            keep = []
            for key in batch.column(batch.num_columns - 1).to_pylist():
                keep.append(key not in seen)
                seen.add(key)
            if len(seen) > REMEMBERED:
                seen.clear()
            yield batch.drop_columns(["_copy_key"]).filter(pa.array(keep, pa.bool_()))

    return marked.mapInArrow(first_copies, df.schema)
