"""Messages addressed by (partition, offset): start position, lost ranges, rate limit.

Staged messages lie in segments, ``path/partition=<p>/segment=<s>/part-*.parquet``, where
segment s of a partition holds the offsets from s * ``SEGMENT`` on. Retention removes
whole segments, later writes add files. ``offset_stream`` reads them as a Kafka topic is
read: a batch is a range of offsets per partition, the checkpoint remembers where the
last one ended, and options of the usual names say

- where the first start begins (``startingOffsets``: ``earliest``, ``latest``, or JSON with an
  offset, -2 for earliest or -1 for latest per partition; unnamed partitions begin at the
  earliest). A restart goes on from its checkpoint whatever the option says; partitions
  that appear later are read from their start;
- what happens to offsets that are gone (``failOnDataLoss``): the query fails naming the range,
  or goes on behind it;
- how many offsets a batch may hold (``maxOffsetsPerTrigger``), dealt to the partitions in
  proportion to what each has waiting.

Only names and Parquet footers are read to plan a batch; the messages of each segment are
read in the tasks, filtered by offset in the scan. Gaps inside a segment (deleted
messages) are no loss. Run it with a processing-time trigger: Spark gives a Python source no
admission control, so an ``availableNow`` run with a limit would end after one batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schemas import MESSAGE_SCHEMA

#: offsets of a segment
SEGMENT = 1000
EARLIEST, LATEST = -2, -1
#: MESSAGE_SCHEMA in Arrow's types
ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                   ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32())])
FIELDS = [f for f in MESSAGE_SCHEMA.fieldNames() if f not in ("partition", "topic")]


def stage_segments(messages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Add the messages of one topic to the segments at ``path``."""
    (messages.withColumn("segment", F.floor(F.col("offset") / segment)).drop("topic")
     .repartition("partition", "segment").sortWithinPartitions("partition", "segment", "offset")
     .write.mode("append").partitionBy("partition", "segment").parquet(path))


def _listed(path: str) -> dict[int, dict[int, list[str]]]:
    """partition -> segment -> files, of the finished files under ``path``."""
    fs, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    found: dict[int, dict[int, list[str]]] = {}
    for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        parts = info.path.rsplit("/", 3)
        if info.is_file and parts[-1].startswith("part-") and "/_temporary/" not in info.path:
            partition, segment = (int(p.split("=")[1]) for p in parts[1:3])
            found.setdefault(partition, {}).setdefault(segment, []).append(info.path)
    return found


def _opened(path: str) -> pafs.FileSystem:
    return pafs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else pafs.LocalFileSystem()


class LostOffsets(RuntimeError):
    """Offsets that a batch should hold are gone."""


class SegmentRange(InputPartition):
    def __init__(self, partition: int, files: Sequence[str], first: int, last: int):
        self.partition, self.files, self.first, self.last = partition, list(files), first, last


def dealt(waiting: dict[str, int], limit: int) -> dict[str, int]:
    """At most ``limit`` offsets over the partitions, in proportion to what waits in each."""
    total = sum(waiting.values())
    if total <= limit:
        return dict(waiting)
    share = {p: n * limit // total for p, n in waiting.items()}
    rest = limit - sum(share.values())
    for p in sorted(waiting, key=lambda p: (waiting[p] * limit % total, p), reverse=True)[:rest]:
        share[p] += 1
    return share


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.topic = options["path"], options["topic"]
        self.segment = int(options.get("segment", SEGMENT))
        self.starting = options.get("startingoffsets", "earliest")
        self.strict = options.get("failondataloss", "true").lower() == "true"
        self.limit = int(options["maxoffsetspertrigger"]) if options.get("maxoffsetspertrigger") else None
        self.position: dict[str, int] | None = None  # where the next batch starts

    def _bounds(self) -> dict[str, tuple[int, int]]:
        """Earliest and next offset of each partition."""
        fs, out = _opened(self.path), {}
        for partition, segments in _listed(self.path).items():
            top = 0
            for file in segments[max(segments)]:
                meta = pq.read_metadata(fs.open_input_file(file))
                at = meta.schema.names.index("offset")
                for g in range(meta.num_row_groups):
                    top = max(top, meta.row_group(g).column(at).statistics.max + 1)
            out[str(partition)] = min(segments) * self.segment, top
        return out

    def initialOffset(self) -> dict:
        bounds = self._bounds()
        if self.starting in ("earliest", "latest"):
            wanted = dict.fromkeys(bounds, EARLIEST if self.starting == "earliest" else LATEST)
        else:
            wanted = json.loads(self.starting)
        start = {}
        for partition, (low, top) in bounds.items():
            at = wanted.get(partition, EARLIEST)
            start[partition] = low if at == EARLIEST else top if at == LATEST else at
        self.position = dict(start)
        return start

    def latestOffset(self) -> dict:
        bounds, begun = self._bounds(), self.position or {}
        start = {p: begun.get(p, low) for p, (low, _) in bounds.items()}
        if not self.strict:  # what is gone takes no room in the batch
            start = {p: max(at, bounds[p][0]) for p, at in start.items()}
        waiting = {p: max(0, bounds[p][1] - at) for p, at in start.items()}
        taken = waiting if self.limit is None else dealt(waiting, self.limit)
        return {**begun, **{p: begun[p] if p in begun and not taken[p] else start[p] + taken[p] for p in bounds}}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.position = dict(end)  # a restart plans an empty batch at its checkpoint first
        out, lost = [], []
        listed = _listed(self.path) if start != end else {}
        for name, last in sorted(end.items()):
            segments = listed.get(int(name), {})
            first = start.get(name, min(segments) * self.segment if segments else last)
            at = first
            while at < last:
                number = at // self.segment
                stop = min(last, (number + 1) * self.segment)
                if number in segments:
                    out.append(SegmentRange(int(name), segments[number], at, stop))
                else:
                    lost.append((name, at, stop))
                at = stop
        if lost and self.strict:
            raise LostOffsets("; ".join(f"partition {p}: offsets {a} to {b - 1} are gone" for p, a, b in lost))
        return out

    def read(self, partition: SegmentRange) -> Iterator[pa.RecordBatch]:
        fs = _opened(self.path)
        inside = (pc.field("offset") >= partition.first) & (pc.field("offset") < partition.last)
        for file in partition.files:
            table = pq.read_table(file, columns=FIELDS, filters=inside, filesystem=fs, partitioning=None)
            n = table.num_rows
            table = table.append_column("topic", pa.array([self.topic] * n, pa.string()))
            table = table.append_column("partition", pa.array([partition.partition] * n, pa.int32()))
            yield from table.select(ARROW.names).cast(ARROW).to_batches()


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_segments"

    def schema(self):
        return MESSAGE_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def offset_stream(spark: SparkSession, path: str, topic: str, starting_offsets: str = "earliest",
                  fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None,
                  segment: int = SEGMENT) -> DataFrame:
    """Stream of the messages of ``topic`` staged at ``path``, by offsets."""
    spark.dataSource.register(SegmentSource)
    reader = (spark.readStream.format(SegmentSource.name()).option("topic", topic).option("segment", segment)
              .option("startingOffsets", starting_offsets).option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load(path)
