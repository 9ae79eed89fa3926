"""Hand-written inputs from FIXTURES.md (golden batch, streaming, merge)."""

from __future__ import annotations

import time
import datetime as dt
import json

from tidemark.schemas import MESSAGE_SCHEMA, ORDER_TOPIC, USER_TOPIC

UTC = dt.timezone.utc


def payload(event_id, user, etype, time_text, product=("P001", "Laptop", "Electronics"),
            price=1200.0, session="s1", producer_time=None):
    pid, name, cat = product
    return {
        "event_id": event_id, "session_id": session, "user_id": user, "event_type": etype,
        "product_id": pid, "product_name": name, "category": cat, "price": price,
        "event_time": time_text, "producer_time": producer_time or time_text,
    }


def t(hms: str, offset: str = "+00:00", date: str = "2024-01-01") -> str:
    return f"{date}T{hms}{offset}"


SHOES = ("P009", "Shoes", "Fashion")


def golden_payloads():
    """The 19 messages of the golden batch fixture, as (topic, value text)."""
    p = []
    add = lambda d, topic=USER_TOPIC: p.append((topic, json.dumps(d) if isinstance(d, dict) else d))
    add(payload("e1", "u1", "view", t("10:00:00")))
    add(payload("e2", "u2", "view", t("10:00:30.500000")))
    add(payload("e3", "u1", "view", t("10:00:59.999999")))
    add(payload("e4", "u1", "click", t("10:00:40")))
    add(payload("e5", "u1", "add_to_cart", t("10:00:50")))
    add(payload("e1", "u1", "view", t("10:00:00")))                       # duplicate of #1
    add(payload("e6", "u3", "click", t("10:01:00")))
    add(payload("e7", "u3", "signup", t("10:00:10")))                     # V5
    add(payload("e8", "u3", "view", "not-a-time"))                        # V2
    add(payload("e9", "u3", "view", t("10:00:10"), price=0.0))            # V4
    add(payload("e10", "u3", "view", t("10:00:10"), price=-5.0))          # V4
    d = payload("e11", "u3", "view", t("10:00:10")); d["product_id"] = None
    add(d)                                                                 # V3
    add(payload(None, "u3", "view", t("10:00:10")))                       # V1
    add("not json")                                                        # unparseable
    d = payload("e12", "u3", "view", t("10:00:10")); d["price"] = "12.5"
    add(d)                                                                 # price as string
    add(payload("e13", "u4", "view", t("12:00:20", "+02:00")))            # other offset
    add(payload("o1", "u1", "purchase", t("10:01:10"), SHOES, 80.1), ORDER_TOPIC)
    add(payload("o2", "u2", "purchase", t("10:01:20"), SHOES, 80.1), ORDER_TOPIC)
    add(payload("o3", "u1", "purchase", t("10:01:59"), SHOES, 10.05), ORDER_TOPIC)
    return p


def messages_df(spark, items, start_offset=0, broker_time=None):
    """Kafka-contract rows from (topic, value text) pairs."""
    broker_time = broker_time or dt.datetime(2024, 1, 1, 10, 5, tzinfo=UTC)
    rows = []
    for i, (topic, value) in enumerate(items):
        rows.append((b"k", value.encode("utf-8") if value is not None else None, topic, 0,
                     start_offset + i, broker_time + dt.timedelta(milliseconds=i), 0))
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def T(minutes: float) -> str:
    """FIXTURES streaming clock: 2024-01-01 00:00 plus ``minutes``."""
    ts = dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(minutes=minutes)
    return ts.isoformat()


def event(event_id, minutes, etype="view", topic=USER_TOPIC):
    return (topic, json.dumps(payload(event_id, "u1", etype, T(minutes))))


def wait_for_listener(log, name: str, batches: int, timeout: float = 30.0) -> None:
    """Listener events are asynchronous; wait until ``batches`` progress rows arrived."""
    end = time.time() + timeout
    while time.time() < end and len(log.rows(name)) < batches:
        time.sleep(0.1)
