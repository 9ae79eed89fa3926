"""Mergeable metrics: roll-ups equal the direct aggregation, streams equal batches, checks can fail."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.metrics import order_metrics, user_metrics
from tidemark.operators.sketches import (HLL_ERROR, estimated, lag_partials, lag_quantiles, lag_rolled_up,
                                         metric_partials, rank_checked, rolled_up, within_error)
from tidemark.plans.batch import Layers
from tidemark.schemas import BRONZE_SCHEMA
from tidemark.streaming.jobs import start_lag_partials, start_metric_partials

EVENTS = ("user_id string, event_type string, product_id string, product_name string, category string, "
          "price float, event_time timestamp")


@pytest.fixture(scope="module")
def crowd(spark):
    """One product with 30,000 users, some null, most seen in several minutes."""
    return (spark.range(90_000).select(
        F.when(F.col("id") % 1001 == 0, None).otherwise((F.col("id") % 30_000).cast("string")).alias("user_id"),
        F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("add_to_cart")), (F.col("id") % 3 + 1).cast("int"))
        .alias("event_type"), F.lit("p").alias("product_id"), F.lit("n").alias("product_name"), F.lit("c").alias("category"),
        F.lit(1.5).cast("float").alias("price"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 7200).alias("event_time")))


def test_days_from_minutes_are_the_sketch_of_the_day(crowd):
    minutes = metric_partials(crowd, "user")
    assert minutes.count() == 120
    via_hours = estimated(rolled_up(rolled_up(minutes, "user", "1 hour"), "user", "1 day"), "user").first()
    direct = estimated(metric_partials(crowd, "user", "1 day"), "user").first()
    exact = user_metrics(crowd, "1 day", "exact").first()
    assert via_hours == direct and via_hours.unique_users != 0
    assert abs(via_hours.unique_users - exact.unique_users) <= 4 * HLL_ERROR * exact.unique_users
    assert {c: via_hours[c] for c in exact.asDict() if c != "unique_users"} == \
        {c: exact[c] for c in exact.asDict() if c != "unique_users"}


def test_the_flag_of_the_estimate_can_fail(spark):
    rows = spark.createDataFrame([(10, 11), (10, 12), (1000, 1060), (1000, 1070), (0, 0)], "exact long, guess long")
    got = [r[0] for r in rows.select(within_error(F.col("guess"), F.col("exact"))).collect()]
    assert got == [True, False, True, False, True]


@pytest.mark.parametrize("kind", ["user", "order"])
def test_streamed_minutes_roll_up_like_batch(spark, workdir, kind):
    lay = Layers(spark, SF_SMALL)
    silver = (lay.silver_user() if kind == "user" else lay.silver_order()).select(*BRONZE_SCHEMA.names)
    # time slices, one file and one micro-batch each
    silver.repartitionByRange(3, "event_time").write.parquet(f"{workdir}/in")
    q = start_metric_partials(spark, f"{workdir}/in", f"{workdir}/out", None, kind, {"availableNow": True},
                              delay="20 days", max_files_per_trigger=1, state_partitions=2)
    q.awaitTermination()
    assert q.exception() is None and q.lastProgress["batchId"] >= 2
    silver = spark.read.schema(BRONZE_SCHEMA).parquet(f"{workdir}/in")
    newest = silver.agg(F.max("event_time")).first()[0]
    closed = metric_partials(silver, kind).where(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 20 DAYS"))
    got = spark.read.parquet(f"{workdir}/out")
    assert sorted(map(tuple, estimated(rolled_up(got, kind, "1 day"), kind).collect())) == \
        sorted(map(tuple, estimated(rolled_up(closed, kind, "1 day"), kind).collect()))
    gold = user_metrics if kind == "user" else order_metrics
    assert closed.count() > 3 and estimated(closed, kind).columns == gold(silver, "1 minute").columns


def _lag_events(spark, n=60_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "t2").otherwise("t1").alias("topic"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400).alias("producer_time"),
        F.timestamp_micros((F.lit(1704067200) + F.col("id") % 86400) * 1000000 + (F.col("id") * 7919 % 9973) * 1000)
        .alias("kafka_timestamp"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400 - F.when(F.col("id") % 10 == 0, 90).otherwise(0))
        .alias("event_time"))


def test_lag_quantiles_of_merged_sketches_hold_their_rank(spark):
    events = _lag_events(spark)
    hours = lag_partials(events)
    assert hours.count() == 2 * 17
    days = lag_quantiles(lag_rolled_up(hours, "1 day"))
    rows = rank_checked(days, events, "1 day").collect()
    assert len(rows) == 2 and sum(r.events for r in rows) == 60_000
    assert all(r[c] for r in rows for c in r.asDict() if c.endswith("_in_bound"))
    moved = days.withColumn("broker_lag_p95", F.col("broker_lag_p95") - 0.4)
    rows = rank_checked(moved, events, "1 day").collect()
    assert not any(r.broker_lag_p95_in_bound for r in rows) and all(r.broker_lag_p50_in_bound for r in rows)


def test_streamed_lag_equals_batch_hours(spark, workdir):
    events = Layers(spark, SF_SMALL).silver_user().select(*BRONZE_SCHEMA.names)
    events.repartitionByRange(4, "producer_time").write.parquet(f"{workdir}/in")
    q = start_lag_partials(spark, f"{workdir}/in", f"{workdir}/out", None, {"availableNow": True}, delay="20 days",
                           max_files_per_trigger=1, state_partitions=2)
    q.awaitTermination()
    assert q.exception() is None
    events = spark.read.schema(BRONZE_SCHEMA).parquet(f"{workdir}/in")
    newest = events.agg(F.max("producer_time")).first()[0]
    want = lag_partials(events).where(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 20 DAYS"))
    pick = ("topic", "window_start", "events", "broker_lag_max", "lateness_max")
    got = spark.read.parquet(f"{workdir}/out")
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(map(tuple, want.select(*pick).collect()))
    assert want.count() > 3
