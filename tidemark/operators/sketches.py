"""Metrics kept as mergeable partials: hours and days from minutes, without silver.

``metric_partials`` is gold one step earlier: sums, and the distinct users as a
HyperLogLog sketch instead of a number. Partials of any windows merge into those of
longer ones (``rolled_up``), so an hour or a day is an aggregation over minutes, and
late minutes can be added without reading events again. ``lag_partials`` does the same for
the quantiles of ingest lag with KLL sketches. Every function is an ordinary aggregation:
partial before the shuffle, a few kB a group whatever it holds, usable on streams
(append mode; the watermark is set by the caller).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_rate, seconds_between
from .lookup import lookup_join
from .metrics import GROUP_COLS

#: 2^LG_K registers: relative standard error about 1.04 / sqrt(2^LG_K) = 1.6 %
LG_K = 12
HLL_ERROR = 1.04 / 2 ** (LG_K / 2)
#: KLL's size parameter and its bound of the rank error (99 % confidence) for it
KLL_K, RANK_ERROR = 200, 0.0165
LAGS = ("broker_lag", "lateness")
PROBABILITIES = {"p50": 0.5, "p95": 0.95}

_SUMS = {"user": ("view_count", "click_count", "add_to_cart_count"), "order": ("purchase_count", "revenue")}


def _bounds(time: str | Column, length: str) -> Column:
    return F.window(time, length).alias("window")


def _flat(grouped: DataFrame, *keys: str) -> DataFrame:
    rest = [c for c in grouped.columns if c not in (*keys, "window")]
    return grouped.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          *rest)


def metric_partials(events: DataFrame, kind: str, window: str = "1 minute") -> DataFrame:
    """Per product and window: the sums of ``kind`` (``user`` or ``order``) and the sketch ``users``."""
    flag = lambda t: F.sum(F.when(F.col("event_type") == t, 1).otherwise(0))
    sums = {"view_count": flag("view"), "click_count": flag("click"), "add_to_cart_count": flag("add_to_cart"),
            "purchase_count": F.count(F.lit(1)), "revenue": F.sum(F.col("price").cast("double"))}
    grouped = events.groupBy(*GROUP_COLS, _bounds("event_time", window)).agg(
        *(sums[c].alias(c) for c in _SUMS[kind]), F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("users"))
    return _flat(grouped, *GROUP_COLS)


def rolled_up(partials: DataFrame, kind: str, window: str) -> DataFrame:
    """Partials of windows that divide ``window`` merged into it."""
    grouped = partials.groupBy(*GROUP_COLS, _bounds("window_start", window)).agg(
        *(F.sum(c).alias(c) for c in _SUMS[kind]), F.hll_union_agg("users").alias("users"))
    return _flat(grouped, *GROUP_COLS)


def estimated(partials: DataFrame, kind: str) -> DataFrame:
    """Gold columns of partials; the distinct users are estimates."""
    users = F.hll_sketch_estimate("users")
    keys = [*GROUP_COLS, "window_start", "window_end"]
    if kind == "user":
        return partials.select(*keys, "view_count", "click_count", "add_to_cart_count", users.alias("unique_users"),
                               safe_rate("click_count", "view_count", 4).alias("click_through_rate"),
                               safe_rate("add_to_cart_count", "view_count", 4).alias("add_to_cart_rate"))
    rounded = partials.withColumn("total_revenue_usd", F.round("revenue", 2))
    return rounded.select(*keys, "purchase_count", "total_revenue_usd",
                          safe_rate("total_revenue_usd", "purchase_count", 2).alias("avg_order_value"),
                          users.alias("unique_buyers"))


def within_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimate of distinct users is within four standard errors (or one user)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), 4 * HLL_ERROR * exact)


def lag_partials(events: DataFrame, window: str = "1 hour") -> DataFrame:
    """Per topic and producer-time window: events and a KLL sketch of each lag in seconds."""
    grouped = events.select("topic", "producer_time",
                            seconds_between("kafka_timestamp", "producer_time").alias("broker_lag"),
                            seconds_between("producer_time", "event_time").alias("lateness")) \
        .groupBy("topic", _bounds("producer_time", window)).agg(
            F.count(F.lit(1)).alias("events"),
            *(F.max(c).alias(f"{c}_max") for c in LAGS),
            *(F.kll_sketch_agg_double(c, F.lit(KLL_K)).alias(c) for c in LAGS))
    return _flat(grouped, "topic")


def lag_rolled_up(partials: DataFrame, window: str) -> DataFrame:
    grouped = partials.groupBy("topic", _bounds("window_start", window)).agg(
        F.sum("events").alias("events"), *(F.max(f"{c}_max").alias(f"{c}_max") for c in LAGS),
        *(F.kll_merge_agg_double(c, F.lit(KLL_K)).alias(c) for c in LAGS))
    return _flat(grouped, "topic")


def lag_quantiles(partials: DataFrame) -> DataFrame:
    """Counts, maxima and estimated quantiles of partials."""
    return partials.select(
        "topic", "window_start", "window_end", "events", *(f"{c}_max" for c in LAGS),
        *(F.kll_sketch_get_quantile_double(c, F.lit(p)).alias(f"{c}_{n}") for c in LAGS for n, p in PROBABILITIES.items()))


def rank_checked(quantiles: DataFrame, events: DataFrame, window: str) -> DataFrame:
    """Whether each estimated quantile lies within ``RANK_ERROR`` of its rank among ``events``.

    A value's ranks run from the share below it to the share not above it. One pass over
    the events, which meet the few windows in a lookup join.
    """
    names = [(c, n, p) for c in LAGS for n, p in PROBABILITIES.items()]
    dim = quantiles.select(F.col("topic").alias("_topic"), F.col("window_start").alias("_start"),
                           *(F.col(f"{c}_{n}").alias(f"_{c}_{n}") for c, n, _ in names))
    facts = events.select("topic", F.window("producer_time", window).start.alias("start"),
                          seconds_between("kafka_timestamp", "producer_time").alias("broker_lag"),
                          seconds_between("producer_time", "event_time").alias("lateness"))
    met = lookup_join(facts, dim, (F.col("topic") == F.col("_topic")) & (F.col("start") == F.col("_start")), "inner")
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    ranks = met.groupBy("_topic", "_start").agg(
        *(share(F.col(c) < F.col(f"_{c}_{n}")).alias(f"{c}_{n}_below") for c, n, _ in names),
        *(share(F.col(c) <= F.col(f"_{c}_{n}")).alias(f"{c}_{n}_upto") for c, n, _ in names))
    return quantiles.join(ranks, (F.col("topic") == F.col("_topic")) & (F.col("window_start") == F.col("_start"))).select(
        "topic", "window_start", "window_end", "events", *(F.round(f"{c}_max", 3).alias(f"{c}_max") for c in LAGS),
        *(((F.col(f"{c}_{n}_below") <= p + RANK_ERROR) & (F.col(f"{c}_{n}_upto") >= p - RANK_ERROR))
          .alias(f"{c}_{n}_in_bound") for c, n, p in names))
