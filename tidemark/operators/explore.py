"""Analyses over silver events that the reference's simulator describes.

Aggregations are partial-then-final, the cart sizes are joined back rather
than windowed, and the lag quantiles are computed by range pieces, so a hot
session, user, category or topic never has its raw rows gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_rate, seconds_between
from .quantiles import exact_quantiles


def _flag(event_type: str):
    return F.max(F.when(F.col("event_type") == event_type, 1).otherwise(0))


def session_funnel(events: DataFrame, by: str = "category") -> DataFrame:
    """Funnel view -> click -> add_to_cart -> purchase per (session, ``by``).

    Stage n is reached only if all earlier stages occurred in the unit; totals
    and step conversion rates per ``by`` value.
    """
    units = events.groupBy("session_id", by).agg(
        _flag("view").alias("v"), _flag("click").alias("c"),
        _flag("add_to_cart").alias("a"), _flag("purchase").alias("p"))
    return funnel_of(units, by)


def funnel_of(units: DataFrame, by: str = "category") -> DataFrame:
    """Funnel totals per ``by`` of units with the flags v, c, a, p of the four stages."""
    staged = units.select(
        by,
        F.col("v").alias("s1"),
        (F.col("v") * F.col("c")).alias("s2"),
        (F.col("v") * F.col("c") * F.col("a")).alias("s3"),
        (F.col("v") * F.col("c") * F.col("a") * F.col("p")).alias("s4"))
    totals = staged.groupBy(by).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("s1").cast("bigint").alias("viewed"),
        F.sum("s2").cast("bigint").alias("clicked"),
        F.sum("s3").cast("bigint").alias("carted"),
        F.sum("s4").cast("bigint").alias("purchased"))
    return totals.select(
        "*",
        safe_rate("clicked", "viewed", 4).alias("view_to_click"),
        safe_rate("carted", "clicked", 4).alias("click_to_cart"),
        safe_rate("purchased", "carted", 4).alias("cart_to_purchase"))


def session_units(events: DataFrame, by: str = "category", gap: str = "30 minutes") -> DataFrame:
    """Stage flags per (user, ``by``, session), a session ending ``gap`` after its last event.

    On a stream (watermark set by the caller) sessions grow and merge in state and are
    emitted once, when the watermark has passed their end.
    """
    grouped = events.groupBy("user_id", by, F.session_window("event_time", gap).alias("session")).agg(
        _flag("view").alias("v"), _flag("click").alias("c"),
        _flag("add_to_cart").alias("a"), _flag("purchase").alias("p"), F.count(F.lit(1)).alias("events"))
    return grouped.select("user_id", by, F.col("session.start").alias("session_start"),
                          F.col("session.end").alias("session_end"), "v", "c", "a", "p", "events")


def open_carts(events: DataFrame, abandon_after: str = "1 hour") -> DataFrame:
    """Products added to a cart and not purchased since, as of the latest event.

    Per (user_id, product_id): open when the last add_to_cart is later than the
    last purchase (or there is none). ``cart_size`` counts a user's open
    products; ``abandoned`` marks adds older than ``abandon_after`` at the
    as-of time (the maximum event_time, evaluated once as a scalar subquery).
    """
    states = cart_states(events)
    return sized_carts(still_open(states), states.select(F.max("seen_at")).scalar(), abandon_after)


def cart_states(events: DataFrame) -> DataFrame:
    """Per (user_id, product_id): last add, last purchase and last event of any kind."""
    return events.groupBy("user_id", "product_id").agg(
        F.max(F.when(F.col("event_type") == "add_to_cart", F.col("event_time"))).alias("added_at"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("event_time"))).alias("bought_at"),
        F.max("event_time").alias("seen_at"))


def still_open(states: DataFrame) -> DataFrame:
    """The ``cart_states`` whose last add was not bought since."""
    return states.where(F.col("added_at").isNotNull()
                        & (F.col("bought_at").isNull() | (F.col("added_at") > F.col("bought_at"))))


def sized_carts(carts: DataFrame, as_of: Column, abandon_after: str = "1 hour") -> DataFrame:
    """Open carts with the size of their user's cart and whether they are abandoned at ``as_of``."""
    # cart size by a partial aggregate joined back on user_id (not a window):
    # a bot user with millions of open carts is counted map-side, and its rows
    # on the join's large side can be split by AQE's skew handling
    sizes = carts.groupBy("user_id").agg(F.count(F.lit(1)).alias("cart_size"))
    return carts.join(sizes, "user_id").select(
        "user_id", "product_id", "added_at", "cart_size",
        (F.col("added_at") < as_of - F.expr(f"INTERVAL {abandon_after}")).alias("abandoned"))


def ingest_lag(events: DataFrame, window: str = "1 day", late_after_seconds: float = 300.0,
               exact: bool = True) -> DataFrame:
    """Producer -> broker lag and event-time lateness per topic and producer-time window.

    ``exact``: p50 / p95 by ``exact_quantiles`` (distributed; no group is
    gathered into one task, so a topic-day holding most rows is fine);
    otherwise ``percentile_approx`` with a fixed-size mergeable sketch.
    """
    w = F.window("producer_time", window)
    lagged = events.select(
        "topic", w.start.alias("window_start"), w.end.alias("window_end"),
        seconds_between("kafka_timestamp", "producer_time").alias("broker_lag"),
        seconds_between("producer_time", "event_time").alias("lateness"))
    keys = ["topic", "window_start", "window_end"]
    aggs = [
        F.count(F.lit(1)).alias("events"),
        F.round(F.max("broker_lag"), 3).alias("broker_lag_max"),
        F.round(F.max("lateness"), 3).alias("lateness_max"),
        F.round(F.avg(F.when(F.col("lateness") > late_after_seconds, 1.0).otherwise(0.0)), 4)
         .alias("late_share"),
    ]
    probs = {"p50": 0.5, "p95": 0.95}
    if not exact:
        aggs += [F.round(F.percentile_approx(c, p, 10000), 3).alias(f"{c}_{n}")
                 for c in ("broker_lag", "lateness") for n, p in probs.items()]
        out = lagged.groupBy(*keys).agg(*aggs)
    else:
        # both measures in one quantile pass: stack them with the measure name as
        # an extra group key, then fold back to columns
        stacked = lagged.select(*keys, F.expr(
            "stack(2, 'broker_lag', broker_lag, 'lateness', lateness) AS (measure, seconds)"))
        q = exact_quantiles(stacked, [*keys, "measure"], "seconds", probs)
        folded = q.groupBy(*keys).agg(*[
            F.round(F.max(F.when(F.col("measure") == c, F.col(n))), 3).alias(f"{c}_{n}")
            for c in ("broker_lag", "lateness") for n in probs])
        out = lagged.groupBy(*keys).agg(*aggs).join(folded, keys, "left")
    return out.select(*keys, "events", "broker_lag_p50", "broker_lag_p95", "broker_lag_max",
                      "lateness_p50", "lateness_p95", "lateness_max", "late_share")
