"""Offset-addressed message stream (S2-S4) and the processing-time trigger (K3)."""

import glob
import os
import time

import pytest

from fixtures import messages_df
from tidemark.operators.decode import decode
from tidemark.schemas import MESSAGE_SCHEMA, USER_TOPIC
from tidemark.sources.offsets import dealt, offset_stream, stage_segments


def stage(spark, path, offsets, partitions=(0, 1)):
    from pyspark.sql import functions as F
    one = messages_df(spark, [(USER_TOPIC, "{}")]).drop("partition", "offset")
    rows = spark.createDataFrame([(p, o) for p in partitions for o in offsets], "partition int, offset long")
    stage_segments(one.crossJoin(F.broadcast(rows)).select(*[c for c in MESSAGE_SCHEMA.names if c in one.columns or
                                                             c in ("partition", "offset")]), path, segment=10)


class Reader:
    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options = spark, root, options
        self.batches = []

    def run(self, **options):
        df = offset_stream(self.spark, f"{self.root}/in", USER_TOPIC, segment=10, **(self.options | options))
        found = []

        def keep(batch, n):
            found.append((n, sorted((r.partition, r.offset) for r in batch.select("partition", "offset").collect())))
        q = (df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{self.root}/ckpt")
             .trigger(processingTime="0 seconds").start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        self.batches += found
        return [rows for _, rows in found]


def both(*offsets):
    return sorted((p, o) for p in (0, 1) for o in offsets)


def test_limit_cuts_batches_and_a_restart_goes_on(spark, workdir):
    stage(spark, f"{workdir}/in", range(25))
    reader = Reader(spark, workdir, max_offsets_per_trigger=20)
    got = reader.run()
    assert [len(rows) for rows in got] == [20, 20, 10]
    assert sum(got, []) and sorted(sum(got, [])) == both(*range(25))
    stage(spark, f"{workdir}/in", range(25, 47))
    got = reader.run(starting_offsets="latest")              # the checkpoint wins
    assert [len(rows) for rows in got] == [20, 20, 4]        # the first batch after a restart is bounded too
    assert sorted(sum(got, [])) == both(*range(25, 47))
    assert [n for n, _ in reader.batches] == list(range(6))


@pytest.mark.parametrize("start,want", [
    ("earliest", both(*range(30))), ("latest", []),
    ('{"0": 12, "1": -1}', [(0, o) for o in range(12, 30)]),
    ('{"0": -1}', [(1, o) for o in range(30)])])
def test_first_start(spark, workdir, start, want):
    stage(spark, f"{workdir}/in", range(30))
    reader = Reader(spark, workdir, starting_offsets=start)
    assert sorted(sum(reader.run(), [])) == want
    stage(spark, f"{workdir}/in", range(30, 34))
    assert sorted(sum(reader.run(), [])) == both(*range(30, 34))


def expire(root, *segments):
    for s in segments:
        for f in glob.glob(f"{root}/in/partition=0/segment={s}/part-*"):
            os.rename(f, f"{os.path.dirname(f)}/_gone-{os.path.basename(f)}")


def test_lost_offsets_fail_or_are_passed_over(spark, workdir):
    stage(spark, f"{workdir}/in", range(15))
    reader = Reader(spark, workdir, fail_on_data_loss=True)
    assert sorted(sum(reader.run(), [])) == both(*range(15))
    stage(spark, f"{workdir}/in", range(15, 55))
    expire(workdir, 1, 2)                                    # offsets 15 to 29 of partition 0 were not read yet
    with pytest.raises(Exception, match="partition 0: offsets 15 to 19 are gone; partition 0: offsets 20 to 29"):
        reader.run()
    assert reader.batches[1:] == []
    got = sorted(sum(reader.run(fail_on_data_loss=False), []))
    assert got == [(0, o) for o in range(30, 55)] + [(1, o) for o in range(15, 55)]


def test_a_lost_start_takes_no_room_in_the_batch(spark, workdir):
    stage(spark, f"{workdir}/in", range(5), partitions=(0,))
    reader = Reader(spark, workdir, max_offsets_per_trigger=8)
    assert [len(r) for r in reader.run()] == [5]
    stage(spark, f"{workdir}/in", range(5, 40), partitions=(0,))
    expire(workdir, 0, 1)
    assert [len(r) for r in reader.run()] == [8, 8, 4]


def test_partitions_that_appear_later_and_gaps_inside_a_segment(spark, workdir):
    stage(spark, f"{workdir}/in", [1, 4, 7], partitions=(0,))
    reader = Reader(spark, workdir, fail_on_data_loss=True)
    assert sorted(sum(reader.run(), [])) == [(0, 1), (0, 4), (0, 7)]
    stage(spark, f"{workdir}/in", [9], partitions=(0,))
    stage(spark, f"{workdir}/in", [11, 12], partitions=(5,))
    assert sorted(sum(reader.run(), [])) == [(0, 9), (5, 11), (5, 12)]


def test_shares_follow_what_waits():
    assert dealt({"0": 5, "1": 3}, 10) == {"0": 5, "1": 3}
    assert dealt({"0": 300, "1": 100, "2": 0}, 40) == {"0": 30, "1": 10, "2": 0}
    got = dealt({"0": 10, "1": 10, "2": 10}, 10)
    assert sum(got.values()) == 10 and max(got.values()) == 4
    assert sum(dealt({"0": 1, "1": 99999}, 3).values()) == 3


def test_processing_time_trigger_runs_on_its_clock(spark, workdir):
    """K3: batches start on the trigger's ticks, and what comes between two ticks waits for the next."""
    from tidemark.sources.tables import read_sink_table
    from tidemark.streaming.jobs import start_bronze
    stage(spark, f"{workdir}/in", range(4), partitions=(0,))
    q = start_bronze(spark, offset_stream(spark, f"{workdir}/in", USER_TOPIC, segment=10), f"{workdir}/bronze",
                     "ticking", {"processingTime": "4 seconds"})
    try:
        q.processAllAvailable()
        stage(spark, f"{workdir}/in", range(4, 6), partitions=(0,))
        until = time.monotonic() + 30
        while time.monotonic() < until and sum(p["numInputRows"] for p in q.recentProgress) < 6:
            time.sleep(0.2)
        ticks = [p for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    assert [p["numInputRows"] for p in ticks] == [4, 2]
    starts = [time.mktime(time.strptime(p["timestamp"][:19], "%Y-%m-%dT%H:%M:%S")) for p in ticks]
    assert starts[1] - starts[0] >= 3 and starts[1] % 4 == 0       # on a multiple of the interval
    assert read_sink_table(spark, f"{workdir}/bronze", decode(messages_df(spark, [])).schema).count() == 6
