"""Linked supervision and progress reporting."""

import pytest

from fixtures import event, messages_df, wait_for_listener
from tidemark.operators.decode import decode
from tidemark.streaming.jobs import start_silver
from tidemark.streaming.supervise import ProgressLog, StreamFailed, supervise


def test_failing_stream_stops_sibling_and_raises(spark, workdir):
    decode(messages_df(spark, [event("a", 0)])).write.parquet(f"{workdir}/in")
    ok = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
          .writeStream.format("noop").queryName("sibling").start())
    bad = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
           .selectExpr("assert_true(value < 0) AS boom")
           .writeStream.format("noop").queryName("boom").start())
    with pytest.raises(StreamFailed):
        supervise([ok, bad], poll_seconds=0.5)
    assert not ok.isActive and not bad.isActive


def test_progress_log_records_batches(spark, workdir):
    decode(messages_df(spark, [event("a", 0), event("b", 1)])).write.parquet(f"{workdir}/in")
    log = ProgressLog().attach(spark)
    try:
        q = start_silver(spark, f"{workdir}/in", f"{workdir}/out", "silver_progress",
                         {"availableNow": True})
        supervise([q], poll_seconds=0.5)
        wait_for_listener(log, "silver_progress", 1)
        rows = log.rows("silver_progress")
        assert rows and sum(r["num_input_rows"] for r in rows) == 2
        assert rows[-1]["state_rows"] == 2
    finally:
        log.detach(spark)


def _rate(spark, name):
    return (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            .writeStream.format("noop").queryName(name).start())


def test_a_clean_stop_ends_the_siblings_of_a_service(spark):
    one, two = _rate(spark, "one"), _rate(spark, "two")
    one.stop()
    with pytest.raises(StreamFailed):
        supervise([one, two], poll_seconds=0.5, until_done=False)
    assert not two.isActive


def test_finished_queries_return(spark, workdir):
    decode(messages_df(spark, [event("a", 0)])).write.parquet(f"{workdir}/in")
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    q = start_silver(spark, f"{workdir}/in", f"{workdir}/out", None, {"availableNow": True},
                     empty_batches=False, state_partitions=3)
    supervise([q], poll_seconds=0.5)
    supervise([])
    assert (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")) == before


def test_progress_log_is_bounded():
    log = ProgressLog(keep=3)
    log._rows.extend({"name": "x", "batch_id": k} for k in range(10))
    assert [r["batch_id"] for r in log.rows("x")] == [7, 8, 9]
