"""Encode event rows as Kafka messages and route them by type.

The inverse of ``decode``: key = user_id bytes, value = JSON payload bytes,
topic chosen from event_type. Feeds ``write.format("kafka")`` or a file table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iso_text
from ..schemas import ORDER_TOPIC, PAYLOAD_COLS, USER_TOPIC


def route(event_type_col: str = "event_type"):
    return (F.when(F.col(event_type_col) == "purchase", F.lit(ORDER_TOPIC))
             .otherwise(F.lit(USER_TOPIC)))


def encode_and_route(events: DataFrame) -> DataFrame:
    fields = []
    for c in PAYLOAD_COLS:
        if c in ("event_time", "producer_time"):
            fields.append(iso_text(c).alias(c))
        else:
            fields.append(F.col(c))
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        route().alias("topic"),
    )
