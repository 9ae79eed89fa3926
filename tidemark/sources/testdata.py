"""Adapter from the driver's parquet tables to the raw-message contract.

``events`` (event_id, ts, user_id, event_type, value, props) and ``part``
(p_partkey, p_name, p_type) are turned into Kafka-shaped messages
(key, value, topic, partition, offset, timestamp, timestampType) whose JSON
payload follows ``EVENT_SCHEMA``. The test data has no duplicates, late rows,
nulls or cart events, so they are added deterministically from the event id
(rules below, mirrored by the oracle SQL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookup import lookup_join
from ..schemas import ORDER_TOPIC, USER_TOPIC

# ---------------------------------------------------------------------------
# FIXED VALUES (adapter rules; the oracle SQL applies the same ones)
# ---------------------------------------------------------------------------
NULL_PRODUCT_MOD, NULL_PRODUCT_REM = 101, 3       # product_id null
NEG_PRICE_MOD, NEG_PRICE_REM = 103, 4             # price negated
BAD_TIME_MOD, BAD_TIME_REM = 107, 5               # event_time text "not-a-time"
BAD_JSON_MOD, BAD_JSON_REM = 109, 6               # value text "not json"
DUP_MOD, DUP_REM = 50, 7                          # message sent twice
LATE_MOD = 20                                     # rem 0,1: 30 s late; rem 2: 90 s late
KAFKA_PARTITIONS = 4
# ---------------------------------------------------------------------------


# Declared schemas of the input tables: no footer reads to infer them, and a
# changed file layout fails at the scan instead of deep inside a query.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name in TABLE_SCHEMAS:
        r = r.schema(TABLE_SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-contract messages for both topics, derived from ``events`` and ``part``.

    The product catalog is broadcast only after its size was measured under a
    bound; beyond it the lookup is a shuffle join whose hot-product partitions
    AQE splits. The per-message rules are SQL
    expressions (one parse per column instead of one JVM call per function).
    """
    ev = read_table(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "ts", "user_id", "value",
        "CASE WHEN event_type = 'signup' THEN 'add_to_cart' ELSE event_type END AS etype",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = lookup_join(ev, part, ev.k == part.p_partkey, "left")

    # ts is zone-less UTC wall clock; times are rendered as ISO-8601 with +00:00
    iso = "concat(date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
    lateness = (f"CASE WHEN id % {LATE_MOD} IN (0, 1) THEN INTERVAL 30 SECONDS "
                f"WHEN id % {LATE_MOD} = 2 THEN INTERVAL 90 SECONDS ELSE INTERVAL 0 SECONDS END")
    payload = f"""named_struct(
        'event_id', concat('E', CAST(id AS STRING)),
        'session_id', concat(CAST(user_id AS STRING), '-', date_format(ts, 'yyyyMMdd')),
        'user_id', CAST(user_id AS STRING),
        'event_type', etype,
        'product_id', CASE WHEN id % {NULL_PRODUCT_MOD} = {NULL_PRODUCT_REM} THEN CAST(NULL AS STRING)
                           ELSE concat('P', lpad(CAST(k AS STRING), 3, '0')) END,
        'product_name', p_name,
        'category', p_type,
        'price', CASE WHEN id % {NEG_PRICE_MOD} = {NEG_PRICE_REM} THEN -CAST(value AS FLOAT)
                      ELSE CAST(value AS FLOAT) END,
        'event_time', CASE WHEN id % {BAD_TIME_MOD} = {BAD_TIME_REM} THEN 'not-a-time'
                           ELSE {iso.format(f"ts - ({lateness})")} END,
        'producer_time', {iso.format("ts")})"""
    copies = f"CASE WHEN id % {DUP_MOD} = {DUP_REM} THEN array(0, 1) ELSE array(0) END"
    return j.selectExpr("*", f"explode({copies}) AS copy").selectExpr(
        "CAST(CAST(user_id AS STRING) AS BINARY) AS key",
        f"CAST(CASE WHEN id % {BAD_JSON_MOD} = {BAD_JSON_REM} THEN 'not json' "
        f"ELSE to_json({payload}) END AS BINARY) AS value",
        f"CASE WHEN etype = 'purchase' THEN '{ORDER_TOPIC}' ELSE '{USER_TOPIC}' END AS topic",
        f"CAST(pmod(user_id, {KAFKA_PARTITIONS}) AS INT) AS partition",
        "id * 2 + copy AS offset",
        # broker time: a few seconds after production; the re-delivery one second later
        "CAST(ts + make_interval(0, 0, 0, 0, 0, 0, CAST(id % 5 + copy AS DECIMAL(18, 6))) AS TIMESTAMP)"
        " AS timestamp",
        "0 AS timestampType",
    )
