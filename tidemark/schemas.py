"""Schemas, column lists and rule constants.

The values in the FIXED VALUES block must equal the reference job's values
for results to agree (topic names, event types, payload layout, export
column lists and update sets).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference pipeline)
# ---------------------------------------------------------------------------
USER_TOPIC = "user_activity_events"
ORDER_TOPIC = "order_events"
TOPICS = (USER_TOPIC, ORDER_TOPIC)

VALID_EVENT_TYPES = ("view", "click", "add_to_cart", "purchase")

# JSON payload of one event, as produced upstream (price is 32-bit float,
# times are ISO-8601 strings with a UTC offset).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.FloatType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("producer_time", T.StringType()),
])

# Export whitelists and the columns overwritten on a key conflict.
USER_METRICS_COLS = (
    "product_id", "product_name", "category", "window_start", "window_end",
    "view_count", "click_count", "add_to_cart_count", "unique_users",
    "click_through_rate", "add_to_cart_rate",
)
ORDER_METRICS_COLS = (
    "product_id", "product_name", "category", "window_start", "window_end",
    "purchase_count", "total_revenue_usd", "avg_order_value", "unique_buyers",
)
MERGE_KEYS = ("product_id", "window_start")
USER_METRICS_UPDATE = (
    "product_name", "view_count", "click_count", "add_to_cart_count",
    "unique_users", "click_through_rate", "add_to_cart_rate",
)
ORDER_METRICS_UPDATE = (
    "product_name", "purchase_count", "total_revenue_usd", "avg_order_value",
    "unique_buyers",
)

SILVER_WATERMARK = "10 minutes"
GOLD_WATERMARK = "5 minutes"
GOLD_WINDOW = "1 minute"
# ---------------------------------------------------------------------------

# Kafka source contract (what `readStream.format("kafka")` yields).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

PAYLOAD_COLS = tuple(f.name for f in EVENT_SCHEMA.fields)
META_COLS = ("topic", "partition", "offset", "kafka_timestamp")
BRONZE_COLS = PAYLOAD_COLS + META_COLS

BRONZE_SCHEMA = T.StructType(
    [T.StructField(f.name, T.TimestampType() if f.name in ("event_time", "producer_time")
                   else f.dataType) for f in EVENT_SCHEMA.fields]
    + [T.StructField("topic", T.StringType()),
       T.StructField("partition", T.IntegerType()),
       T.StructField("offset", T.LongType()),
       T.StructField("kafka_timestamp", T.TimestampType())]
)

_GOLD_TYPES = {
    "product_id": T.StringType(), "product_name": T.StringType(), "category": T.StringType(),
    "window_start": T.TimestampType(), "window_end": T.TimestampType(),
    "view_count": T.LongType(), "click_count": T.LongType(), "add_to_cart_count": T.LongType(),
    "unique_users": T.LongType(), "click_through_rate": T.DoubleType(),
    "add_to_cart_rate": T.DoubleType(), "purchase_count": T.LongType(),
    "total_revenue_usd": T.DoubleType(), "avg_order_value": T.DoubleType(),
    "unique_buyers": T.LongType(),
}

USER_METRICS_SCHEMA = T.StructType([T.StructField(c, _GOLD_TYPES[c]) for c in USER_METRICS_COLS])
ORDER_METRICS_SCHEMA = T.StructType([T.StructField(c, _GOLD_TYPES[c]) for c in ORDER_METRICS_COLS])
