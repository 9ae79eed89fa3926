"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the given tables (``events``, ``part``) through the message
adapter and runs whole tables; outputs carry the same column names as the
oracle SQL in ``tidemark.plans.oracle``. Timestamps are presented as
TIMESTAMP_NTZ (UTC wall clock) at the very end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import iso_text, to_ntz
from ..operators.decode import decode
from ..operators.encode import encode_and_route
from ..operators.explore import cart_states, ingest_lag, session_funnel, sized_carts, still_open
from ..operators.merge import conform, merge_upsert
from ..operators.metrics import APPROX_RSD, order_metrics, user_metrics
from ..operators.sketches import estimated, metric_partials, rolled_up, within_error
from ..operators.validate import reject_counts
from ..schemas import (BRONZE_COLS, MERGE_KEYS, ORDER_METRICS_UPDATE, ORDER_TOPIC, PAYLOAD_COLS,
                       USER_METRICS_SCHEMA, USER_METRICS_UPDATE, USER_TOPIC)
from ..session import ensure_utc, new_run_dir, remove_at_exit
from ..sources.tables import read_folder, table_shape
from .batch import Layers, only_topic

Query = Callable[[SparkSession, str], DataFrame]
WINDOWS = {"1m": "1 minute", "1h": "1 hour", "1d": "1 day"}


def _bronze_decode(spark, sf):
    return Layers(spark, sf).bronze().select(*BRONZE_COLS)


def _silver_valid(spark, sf):
    return Layers(spark, sf).valid().select(*BRONZE_COLS)


def _silver_rejects(spark, sf):
    return reject_counts(Layers(spark, sf).bronze(parse_once=True))


def _silver_dedup(spark, sf):
    return Layers(spark, sf).silver().select(*BRONZE_COLS)


def _user_metrics(window, distinct="exact"):
    return lambda spark, sf: Layers(spark, sf).user_gold(window, distinct)


def _order_metrics(window, distinct="exact"):
    return lambda spark, sf: Layers(spark, sf).order_gold(window, distinct)


def _export_parts(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Hourly gold of three parts of the broker time, with their ``rev`` and ``batch_id``.

    Each hour's first 20 minutes are the target (rev 0), the next 20 the first export
    (rev 1), the rest the second. The second export holds a product renamed halfway
    (rev 2 and 3), so its keys repeat. From rev 1 on, names, categories and window ends
    differ from the target's. One aggregation, stored once.
    """
    lay = Layers(spark, sf)
    gold = user_metrics if kind == "user" else order_metrics
    minute = F.minute("kafka_timestamp")
    rev = F.when(minute < 20, 0).when(minute < 40, 1).when(minute < 50, 2).otherwise(3)
    silver = only_topic(lay.silver(), USER_TOPIC if kind == "user" else ORDER_TOPIC)
    parts = gold(silver.withColumn("rev", rev), "1 hour", "exact", by=("rev",))
    renamed = parts.withColumns({
        "product_name": F.when(F.col("rev") == 0, F.col("product_name"))
        .otherwise(F.concat("product_name", F.lit(" r"), "rev")),
        "category": F.when(F.col("rev") == 0, F.col("category")).otherwise(F.concat("category", F.lit("/r"), "rev")),
        "window_end": F.col("window_end") + F.make_dt_interval(mins=F.col("rev")),
        "batch_id": F.least("rev", F.lit(2))})
    return lay.stored(renamed, f"export-parts-{kind}")


def _merge(kind: str):
    """Export replay: two later exports merged into the target with ON CONFLICT semantics."""
    update_cols = USER_METRICS_UPDATE if kind == "user" else ORDER_METRICS_UPDATE

    def q(spark, sf):
        parts = _export_parts(spark, sf, kind).drop("rev")
        return merge_upsert(parts.where("batch_id = 0").drop("batch_id"), parts.where("batch_id > 0"),
                            MERGE_KEYS, update_cols, order_by=["batch_id"])
    return q


def _export_versioned(spark, sf):
    """The same exports through the versioned sink, the first one replayed at the end."""
    from ..streaming.sinks import merge_into_versioned, read_versioned
    parts = _export_parts(spark, sf, "user").drop("rev")
    path = new_run_dir(spark, "versioned")
    remove_at_exit(spark, path)
    for batch in (0, 1, 2, 1):
        merge_into_versioned(spark, path, parts.where(F.col("batch_id") == batch), USER_METRICS_SCHEMA,
                             MERGE_KEYS, USER_METRICS_UPDATE, batch, writer="replay")
    return read_versioned(spark, path, USER_METRICS_SCHEMA)


def _approx_checked(kind: str):
    """The approximate metrics with the exact number of users in place of the estimate,
    and whether the estimate was within four standard deviations (or one user) of it."""
    users = "unique_users" if kind == "user" else "unique_buyers"
    key = ["product_id", "window_start"]

    def q(spark, sf):
        lay = Layers(spark, sf)
        silver = lay.stored(only_topic(lay.silver(), USER_TOPIC if kind == "user" else ORDER_TOPIC)
                            .select("user_id", "event_type", "product_id", "product_name", "category",
                                    "price", "event_time"), "silver-narrow")
        gold = user_metrics if kind == "user" else order_metrics
        approx = gold(silver, "1 minute", "approx")
        exact = gold(silver, "1 minute", "exact").select(*key, F.col(users).alias("_exact"))
        miss = F.abs(F.col(users) - F.col("_exact"))
        bound = F.greatest(F.lit(1.0), 4 * APPROX_RSD * F.col("_exact"))
        return approx.join(exact, key).select(
            *[F.col("_exact").alias(c) if c == users else F.col(c) for c in approx.columns],
            (miss <= bound).alias("within_bound"))
    return q


def _conform_columns(spark, sf):
    """A gold frame as an export sees it after a text round trip: times as ISO
    text, some of them malformed (windows of the hours 3 and 13: the key is
    lost; 5 and 15: the end is lost) or null (hour 7), an extra column, one
    whitelisted column absent."""
    g = Layers(spark, sf).user_gold("1 hour", "exact")
    hour = F.hour("window_start")
    start = F.when(hour.isin(3, 13), F.lit("2024-13-45T99:00")).when(hour != 7, iso_text("window_start"))
    end = F.when(hour.isin(5, 15), F.lit("not-a-time")).otherwise(iso_text("window_end"))
    exported = g.select(
        *[start.alias(c) if c == "window_start" else end.alias(c) if c == "window_end" else F.col(c)
          for c in g.columns if c != "add_to_cart_rate"],
        F.lit("part-00000.parquet").alias("source_file"))
    return conform(exported, USER_METRICS_SCHEMA)


def _encode_and_route(spark, sf):
    silver = Layers(spark, sf).silver()
    enc = encode_and_route(silver.select(*PAYLOAD_COLS))
    back = decode(enc.select("key", "value", "topic", F.lit(0).alias("partition"),
                             F.lit(0).cast("bigint").alias("offset"),
                             F.current_timestamp().alias("timestamp")))
    return back.select("topic", F.col("user_id").alias("key"), *PAYLOAD_COLS)


# R1-R3 read the events of both topics, i.e. all of silver


def _session_funnel(spark, sf):
    return session_funnel(Layers(spark, sf).silver())


def _open_carts(spark, sf):
    # the open carts are read twice (sizes, carts) and stored once, the as-of time is
    # observed while they are written
    lay, newest = Layers(spark, sf), Observation()
    states = cart_states(lay.silver()).observe(newest, F.max(F.unix_micros("seen_at")).alias("seen_at"))
    carts = lay.stored(still_open(states).select("user_id", "product_id", "added_at"), "open-carts")
    return sized_carts(carts, F.timestamp_micros(F.lit(newest.get["seen_at"]).cast("long")), "1 hour")


def _ingest_lag(spark, sf):
    # read by the aggregates and the quantiles: the four columns needed, stored once
    lay = Layers(spark, sf)
    times = lay.silver().select("topic", "kafka_timestamp", "producer_time", "event_time")
    return ingest_lag(lay.stored(times, "lag-times"), "1 day", late_after_seconds=60.0)


def _table_shape(spark, sf):
    """Gold tables written to the shared folder and read back as folder tables."""
    lay = Layers(spark, sf)
    base = new_run_dir(spark, "gold-export")
    remove_at_exit(spark, base)
    silver = lay.stored(lay.silver().select("topic", "user_id", "event_type", "product_id", "product_name",
                                            "category", "price", "event_time"), "silver-narrow")
    tables = {"user_metrics": user_metrics(only_topic(silver, USER_TOPIC)),
              "order_metrics": order_metrics(only_topic(silver, ORDER_TOPIC))}
    read = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        read[name] = read_folder(spark, f"{base}/{name}", df.schema)
    return table_shape(read)


def _stream_silver(spark, sf):
    from ..streaming.jobs import run_silver
    return run_silver(spark, sf)


def _stream_gold(topic: str):
    def q(spark, sf):
        from ..streaming.jobs import run_gold
        return run_gold(spark, sf, topic)
    return q


def _stream_multi_batch(spark, sf):
    """Silver of a stream that stops and resumes, with rows that arrive too late."""
    from ..streaming.jobs import run_restarts
    return run_restarts(spark, sf)


def _stream_abandoned_carts(spark, sf):
    """Abandoned carts by arbitrary state and event-time timers, over three starts (R2)."""
    from ..streaming.jobs import run_carts
    return run_carts(spark, sf)


def _stream_offsets(spark, sf):
    """Bronze read by offsets: a start position, a lost range, bounded batches."""
    from ..streaming.jobs import run_offsets
    return run_offsets(spark, sf)


def _rollup(kind: str):
    """Hours and days merged from stored minute sketches; the distinct users beside them are
    exact, with a flag for the estimate."""
    users = "unique_users" if kind == "user" else "unique_buyers"
    key = ["product_id", "window_start"]

    def q(spark, sf):
        lay = Layers(spark, sf)
        silver = lay.stored(only_topic(lay.silver(), USER_TOPIC if kind == "user" else ORDER_TOPIC)
                            .select("user_id", "event_type", "product_id", "product_name", "category",
                                    "price", "event_time"), "silver-narrow")
        minutes = lay.stored(metric_partials(silver, kind), "minute-sketches")
        hours = lay.stored(rolled_up(minutes, kind, WINDOWS["1h"]), "hour-sketches")
        out = None
        for unit, partials in (("1h", hours), ("1d", rolled_up(hours, kind, WINDOWS["1d"]))):
            gold = user_metrics if kind == "user" else order_metrics
            exact = gold(silver, WINDOWS[unit], "exact").select(*key, F.col(users).alias("_exact"))
            found = estimated(partials, kind).join(exact, key)
            found = found.select(F.lit(unit).alias("unit"), *[
                F.col("_exact").alias(c) if c == users else F.col(c) for c in found.columns if c != "_exact"],
                within_error(F.col(users), F.col("_exact")).alias("within_bound"))
            out = found if out is None else out.unionByName(found)
        return out
    return q


def _stream_ingest_lag(spark, sf):
    """Daily lag from hourly quantile sketches made by a stream."""
    from ..streaming.jobs import run_lag
    return run_lag(spark, sf)


def _stream_reject_metrics(spark, sf):
    """Rejects per rule from the metrics table of the silver jobs."""
    from ..streaming.jobs import run_reject_metrics
    return run_reject_metrics(spark, sf)


def _stream_validated(spark, sf):
    """Valid rows and rejects of a stream in one pass, a batch delivered twice (V1-V5)."""
    from ..streaming.jobs import run_validated
    return run_validated(spark, sf)


def _stream_session_funnel(spark, sf):
    """Funnel of sessions with a gap, merged in state and closed by the watermark."""
    from ..streaming.jobs import run_sessions
    return run_sessions(spark, sf)


def _stream_late_corrected(spark, sf):
    """Keyed export of streamed gold with the windows of late rows computed again."""
    from ..streaming.jobs import run_late
    return run_late(spark, sf)


def _present(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)            # the NTZ presentation below reads the session zone
        return to_ntz(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "bronze_decode": _bronze_decode,
        "silver_valid": _silver_valid,
        "silver_rejects": _silver_rejects,
        "silver_dedup": _silver_dedup,
    }
    for unit, w in WINDOWS.items():
        q[f"user_metrics_{unit}"] = _user_metrics(w)
        q[f"order_metrics_{unit}"] = _order_metrics(w)
    q["user_metrics_approx"] = _approx_checked("user")
    q["order_metrics_approx"] = _approx_checked("order")
    q["merge_user_metrics"] = _merge("user")
    q["merge_order_metrics"] = _merge("order")
    q["export_versioned"] = _export_versioned
    q["conform_columns"] = _conform_columns
    q["encode_and_route"] = _encode_and_route
    q["session_funnel"] = _session_funnel
    q["open_carts"] = _open_carts
    q["ingest_lag"] = _ingest_lag
    q["table_shape"] = _table_shape
    q["stream_silver"] = _stream_silver
    q["stream_user_metrics"] = _stream_gold(USER_TOPIC)
    q["stream_order_metrics"] = _stream_gold(ORDER_TOPIC)
    q["stream_multi_batch"] = _stream_multi_batch
    q["user_metrics_rollup"] = _rollup("user")
    q["order_metrics_rollup"] = _rollup("order")
    q["stream_ingest_lag"] = _stream_ingest_lag
    q["stream_validated"] = _stream_validated
    q["stream_reject_metrics"] = _stream_reject_metrics
    q["stream_offsets"] = _stream_offsets
    q["stream_session_funnel"] = _stream_session_funnel
    q["stream_late_corrected"] = _stream_late_corrected
    q["stream_abandoned_carts"] = _stream_abandoned_carts
    return {k: _present(v) for k, v in q.items()}
