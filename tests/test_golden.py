"""Golden batch fixture: 19 raw messages through bronze, silver and gold."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import golden_payloads, messages_df
from tidemark.operators.decode import decode
from tidemark.operators.metrics import order_metrics, user_metrics
from tidemark.operators.validate import reject_counts
from tidemark.plans.batch import only_topic, to_silver
from tidemark.schemas import BRONZE_COLS, ORDER_METRICS_COLS, ORDER_TOPIC, USER_METRICS_COLS, USER_TOPIC


def _layers(spark, parse_once=False):
    bronze = decode(messages_df(spark, golden_payloads()), parse_once=parse_once)
    silver = to_silver(bronze)
    return bronze, silver


def test_bronze_keeps_every_message(spark):
    bronze, _ = _layers(spark)
    assert bronze.count() == 19
    assert tuple(bronze.columns) == BRONZE_COLS
    bad = bronze.where(F.col("event_id").isNull() & F.col("session_id").isNull()).collect()
    assert len(bad) == 1 and bad[0]["topic"] == USER_TOPIC     # 'not json' keeps metadata


def test_string_price_and_bad_time_become_null(spark):
    bronze, _ = _layers(spark)
    e12 = bronze.where("event_id = 'e12'").first()
    assert e12["price"] is None and e12["user_id"] == "u3"     # other fields survive
    e8 = bronze.where("event_id = 'e8'").first()
    assert e8["event_time"] is None
    e13 = bronze.where("event_id = 'e13'").first()
    assert e13["event_time"] == dt.datetime(2024, 1, 1, 10, 0, 20)   # 12:00:20+02:00


def test_silver_ids(spark):
    for parse_once in (False, True):
        _, silver = _layers(spark, parse_once)
        ids = sorted(r[0] for r in silver.select("event_id").collect())
        assert ids == sorted(["e1", "e2", "e3", "e4", "e5", "e6", "e13", "o1", "o2", "o3"])


def test_rejects_name_first_failing_rule(spark):
    bronze, _ = _layers(spark)
    got = {(r["rejected_rule"]): r["rejected_rows"] for r in reject_counts(bronze).collect()}
    assert got == {"event_id_not_null": 2, "event_time_not_null": 1, "product_id_not_null": 1,
                   "price_positive": 3, "event_type_known": 1}


def test_user_metrics(spark):
    _, silver = _layers(spark)
    for distinct in ("approx", "exact"):
        g = user_metrics(only_topic(silver, USER_TOPIC), "1 minute", distinct)
        assert tuple(g.columns) == USER_METRICS_COLS
        rows = {r["window_start"].strftime("%H:%M"): r for r in g.collect()}
        assert set(rows) == {"10:00", "10:01"}
        a, b = rows["10:00"], rows["10:01"]
        assert (a.view_count, a.click_count, a.add_to_cart_count, a.unique_users) == (4, 1, 1, 3)
        assert (a.click_through_rate, a.add_to_cart_rate) == (0.25, 0.25)
        assert (b.view_count, b.click_count, b.add_to_cart_count, b.unique_users) == (0, 1, 0, 1)
        assert (b.click_through_rate, b.add_to_cart_rate) == (0.0, 0.0)
        assert a.window_end == dt.datetime(2024, 1, 1, 10, 1)


def test_order_metrics(spark):
    _, silver = _layers(spark)
    g = order_metrics(only_topic(silver, ORDER_TOPIC), "1 minute", "exact")
    assert tuple(g.columns) == ORDER_METRICS_COLS
    rows = g.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.product_id, r.purchase_count, r.total_revenue_usd, r.avg_order_value, r.unique_buyers) \
        == ("P009", 3, 170.25, 56.75, 2)
    assert r.window_start == dt.datetime(2024, 1, 1, 10, 1)
