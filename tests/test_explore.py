"""Re-aimed operators R1-R4 (FIXTURES §6)."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import golden_payloads, messages_df
from tidemark.operators.decode import decode
from tidemark.operators.encode import encode_and_route
from tidemark.operators.explore import ingest_lag, open_carts, session_funnel
from tidemark.plans.batch import to_silver
from tidemark.schemas import ORDER_TOPIC, PAYLOAD_COLS, USER_TOPIC

EV = ("session_id string, category string, user_id string, product_id string, "
      "event_type string, event_time timestamp")


def _ts(h, m, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


def test_session_funnel(spark):
    rows = [("s1", "c", "u", "p", t, _ts(10, i)) for i, t in
            enumerate(["view", "click", "add_to_cart", "purchase"])]
    rows += [("s2", "c", "u", "p", "view", _ts(11, 0)), ("s2", "c", "u", "p", "click", _ts(11, 1)),
             ("s3", "c", "u", "p", "view", _ts(12, 0)), ("s4", "c", "u", "p", "click", _ts(13, 0))]
    r = session_funnel(spark.createDataFrame(rows, EV)).collect()[0]
    assert (r.sessions, r.viewed, r.clicked, r.carted, r.purchased) == (4, 3, 2, 1, 1)
    assert (r.view_to_click, r.click_to_cart, r.cart_to_purchase) == (0.6667, 0.5, 1.0)


def test_open_carts(spark):
    rows = [("s", "c", "u1", "P1", "add_to_cart", _ts(10, 0)), ("s", "c", "u1", "P1", "purchase", _ts(10, 5)),
            ("s", "c", "u1", "P2", "add_to_cart", _ts(10, 6)),
            ("s", "c", "u2", "P1", "add_to_cart", _ts(10, 0)), ("s", "c", "u2", "P1", "purchase", _ts(10, 1)),
            ("s", "c", "u2", "P1", "add_to_cart", _ts(10, 10))]
    out = open_carts(spark.createDataFrame(rows, EV), "1 hour").collect()
    assert sorted((r.user_id, r.product_id, r.cart_size, r.abandoned) for r in out) == \
        [("u1", "P2", 1, False), ("u2", "P1", 1, False)]
    later = rows + [("s", "c", "u3", "P9", "view", _ts(12, 0))]
    out = open_carts(spark.createDataFrame(later, EV), "1 hour").collect()
    assert all(r.abandoned for r in out)


def test_ingest_lag(spark):
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = []
    for late, broker in [(0, 1), (0, 1), (30, 2), (90, 4)]:
        prod = base
        rows.append((USER_TOPIC, prod - dt.timedelta(seconds=late), prod, prod + dt.timedelta(seconds=broker)))
    df = spark.createDataFrame(rows, "topic string, event_time timestamp, producer_time timestamp, "
                                     "kafka_timestamp timestamp")
    r = ingest_lag(df, "1 day", late_after_seconds=60.0).collect()[0]
    assert (r.lateness_p50, r.lateness_max, r.broker_lag_p50, r.broker_lag_max) == (15.0, 90.0, 1.5, 4.0)
    assert r.events == 4 and r.late_share == 0.25
    a = ingest_lag(df, "1 day", exact=False).collect()[0]
    assert a.lateness_max == 90.0 and a.broker_lag_p50 in (1.0, 2.0)


def test_encode_route_roundtrip(spark):
    silver = to_silver(decode(messages_df(spark, golden_payloads())))
    enc = encode_and_route(silver.select(*PAYLOAD_COLS))
    topics = {r.topic: r["count"] for r in enc.groupBy("topic").count().collect()}
    assert topics == {ORDER_TOPIC: 3, USER_TOPIC: 7}
    back = decode(enc.select("key", "value", "topic", F.lit(0).alias("partition"),
                             F.lit(0).cast("bigint").alias("offset"),
                             F.current_timestamp().alias("timestamp")))
    a = sorted(tuple(r) for r in back.select(*PAYLOAD_COLS).collect())
    b = sorted(tuple(r) for r in silver.select(*PAYLOAD_COLS).collect())
    assert a == b
