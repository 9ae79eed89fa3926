"""Independent DuckDB SQL for every SQL-expressible query.

Tables ``events`` and ``part`` are views over the same parquet files. The
oracle does not go through JSON: it applies the adapter rules directly to the
source columns, so a decode bug cannot hide behind a matching encode bug.
Rounded columns use the decimal rounding rule (both engines then round the
shortest decimal text half-up), integer sums are cast to BIGINT.
"""

from __future__ import annotations

from ..schemas import ORDER_METRICS_COLS, USER_METRICS_COLS

_TS_SHIFT = ("CASE WHEN id % 20 IN (0, 1) THEN INTERVAL 30 SECOND "
             "WHEN id % 20 = 2 THEN INTERVAL 90 SECOND ELSE INTERVAL 0 SECOND END")


def rnd(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def safe_rate(num: str, den: str, n: int) -> str:
    return f"CASE WHEN {den} > 0 THEN {rnd(f'CAST({num} AS DOUBLE) / {den}', n)} ELSE 0.0 END"


BASE = f"""
src AS (
  SELECT e.event_id AS id, e.ts, e.user_id AS uid, e.event_type AS raw_type, e.value,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k
  FROM events e),
msg AS (
  SELECT s.*, p.p_name, p.p_type, c.copy,
         CASE WHEN s.raw_type = 'signup' THEN 'add_to_cart' ELSE s.raw_type END AS etype,
         s.id % 109 = 6 AS bad_json
  FROM src s
  LEFT JOIN part p ON p.p_partkey = s.k
  JOIN (VALUES (0), (1)) AS c(copy) ON c.copy = 0 OR s.id % 50 = 7),
bronze AS (
  SELECT
    CASE WHEN bad_json THEN NULL ELSE 'E' || CAST(id AS VARCHAR) END AS event_id,
    CASE WHEN bad_json THEN NULL ELSE CAST(uid AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') END AS session_id,
    CASE WHEN bad_json THEN NULL ELSE CAST(uid AS VARCHAR) END AS user_id,
    CASE WHEN bad_json THEN NULL ELSE etype END AS event_type,
    CASE WHEN bad_json OR id % 101 = 3 THEN NULL ELSE 'P' || lpad(CAST(k AS VARCHAR), 3, '0') END AS product_id,
    CASE WHEN bad_json THEN NULL ELSE p_name END AS product_name,
    CASE WHEN bad_json THEN NULL ELSE p_type END AS category,
    CASE WHEN bad_json THEN NULL WHEN id % 103 = 4 THEN -CAST(value AS FLOAT) ELSE CAST(value AS FLOAT) END AS price,
    CASE WHEN bad_json OR id % 107 = 5 THEN NULL ELSE ts - {_TS_SHIFT} END AS event_time,
    CASE WHEN bad_json THEN NULL ELSE ts END AS producer_time,
    CASE WHEN etype = 'purchase' THEN 'order_events' ELSE 'user_activity_events' END AS topic,
    CAST(uid % 4 AS INTEGER) AS "partition",
    2 * id + copy AS "offset",
    ts + to_seconds(CAST(id % 5 + copy AS BIGINT)) AS kafka_timestamp
  FROM msg),
valid AS (
  SELECT * FROM bronze
  WHERE event_id IS NOT NULL AND event_time IS NOT NULL AND product_id IS NOT NULL
    AND price IS NOT NULL AND price > 0
    AND event_type IN ('view', 'click', 'add_to_cart', 'purchase')),
silver AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY topic, event_id
                             ORDER BY kafka_timestamp, "partition", "offset") = 1),
silver_user AS (SELECT * FROM silver WHERE topic = 'user_activity_events'),
silver_order AS (SELECT * FROM silver WHERE topic = 'order_events')"""

BRONZE_COLS = ("event_id, session_id, user_id, event_type, product_id, product_name, category, "
               "price, event_time, producer_time, topic, \"partition\", \"offset\", kafka_timestamp")
PAYLOAD = ("event_id, session_id, user_id, event_type, product_id, product_name, category, "
           "price, event_time, producer_time")

FIRST_FAILED = """CASE
    WHEN event_id IS NULL THEN 'event_id_not_null'
    WHEN event_time IS NULL THEN 'event_time_not_null'
    WHEN product_id IS NULL THEN 'product_id_not_null'
    WHEN NOT (price IS NOT NULL AND price > 0) THEN 'price_positive'
    WHEN event_type IS NULL OR event_type NOT IN ('view', 'click', 'add_to_cart', 'purchase') THEN 'event_type_known'
  END"""

UNITS = {"1m": ("minute", "1 MINUTE"), "1h": ("hour", "1 HOUR"), "1d": ("day", "1 DAY")}


def with_base(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {BASE}{extra}\n"


def user_gold(src: str, unit: str, by: str = "") -> str:
    trunc, iv = UNITS[unit]
    return f"""
  SELECT product_id, product_name, category, window_start, window_start + INTERVAL {iv} AS window_end,
         view_count, click_count, add_to_cart_count, unique_users,
         {safe_rate('click_count', 'view_count', 4)} AS click_through_rate,
         {safe_rate('add_to_cart_count', 'view_count', 4)} AS add_to_cart_rate{by}
  FROM (
    SELECT product_id, product_name, category, date_trunc('{trunc}', event_time) AS window_start,
           CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view_count,
           CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click_count,
           CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS add_to_cart_count,
           count(DISTINCT user_id) AS unique_users{by}
    FROM {src}
    GROUP BY product_id, product_name, category, date_trunc('{trunc}', event_time){by})"""


def order_gold(src: str, unit: str, by: str = "") -> str:
    trunc, iv = UNITS[unit]
    return f"""
  SELECT product_id, product_name, category, window_start, window_start + INTERVAL {iv} AS window_end,
         purchase_count, total_revenue_usd,
         {safe_rate('total_revenue_usd', 'purchase_count', 2)} AS avg_order_value,
         unique_buyers{by}
  FROM (
    SELECT product_id, product_name, category, date_trunc('{trunc}', event_time) AS window_start,
           count(*) AS purchase_count,
           {rnd('sum(price)', 2)} AS total_revenue_usd,
           count(DISTINCT user_id) AS unique_buyers{by}
    FROM {src}
    GROUP BY product_id, product_name, category, date_trunc('{trunc}', event_time){by})"""


# columns that an update overwrites: all but the keys and these
INSERT_ONLY = ("category", "window_end")
KEYS = ("product_id", "window_start")

# the three parts of the broker time and their changed names (see plans.catalog)
_REV = """CASE WHEN minute(kafka_timestamp) < 20 THEN 0 WHEN minute(kafka_timestamp) < 40 THEN 1
              WHEN minute(kafka_timestamp) < 50 THEN 2 ELSE 3 END"""
_CHANGED = {
    "product_name": "CASE WHEN rev = 0 THEN product_name ELSE product_name || ' r' || rev END",
    "category": "CASE WHEN rev = 0 THEN category ELSE category || '/r' || rev END",
    "window_end": "window_end + to_minutes(rev)",
}


def merge_sql(kind: str) -> str:
    gold = user_gold if kind == "user" else order_gold
    silver = "silver_user" if kind == "user" else "silver_order"
    cols = USER_METRICS_COLS if kind == "user" else ORDER_METRICS_COLS
    ins = INSERT_ONLY
    upd = [c for c in cols if c not in KEYS + INSERT_ONLY]
    tie = ", ".join(c for c in cols if c not in KEYS)
    tie_desc = ", ".join(f"{c} DESC" for c in cols if c not in KEYS)
    shown = ", ".join(f"{_CHANGED[c]} AS {c}" if c in _CHANGED else c for c in cols)
    ctes = [
        f"tagged AS (SELECT *, {_REV} AS rev FROM {silver})",
        f"parts AS (SELECT {shown}, least(rev, 2) AS batch_id FROM ({gold('tagged', '1h', ', rev')}))",
        "target AS (SELECT * FROM parts WHERE batch_id = 0)",
        "upd AS (SELECT * FROM parts WHERE batch_id > 0)",
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id, window_start ORDER BY batch_id, {tie}) AS rn_first, "
        f"row_number() OVER (PARTITION BY product_id, window_start ORDER BY batch_id DESC, {tie_desc}) AS rn_last "
        f"FROM upd WHERE product_id IS NOT NULL AND window_start IS NOT NULL)",
        "u AS (SELECT l.product_id, l.window_start, "
        + ", ".join(f"l.{c}" for c in upd) + ", " + ", ".join(f"f.{c}" for c in ins)
        + " FROM (SELECT * FROM ranked WHERE rn_last = 1) l JOIN (SELECT * FROM ranked WHERE rn_first = 1) f "
          "ON l.product_id = f.product_id AND l.window_start = f.window_start)",
    ]
    sel = []
    for c in cols:
        if c in ("product_id", "window_start"):
            sel.append(f"COALESCE(t.{c}, u.{c}) AS {c}")
        elif c in upd:
            sel.append(f"CASE WHEN u.product_id IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.product_id IS NOT NULL THEN t.{c} ELSE u.{c} END AS {c}")
    return (with_base(*ctes) + "SELECT " + ", ".join(sel)
            + " FROM target t FULL OUTER JOIN u ON t.product_id = u.product_id AND t.window_start = u.window_start")


def _union_events() -> str:
    return "ev AS (SELECT * FROM silver_user UNION ALL SELECT * FROM silver_order)"


def funnel(src: str, unit: str, having: str = "") -> str:
    return f"""
SELECT category, count(*) AS sessions,
       CAST(sum(s1) AS BIGINT) AS viewed, CAST(sum(s2) AS BIGINT) AS clicked,
       CAST(sum(s3) AS BIGINT) AS carted, CAST(sum(s4) AS BIGINT) AS purchased,
       {safe_rate('sum(s2)', 'sum(s1)', 4)} AS view_to_click,
       {safe_rate('sum(s3)', 'sum(s2)', 4)} AS click_to_cart,
       {safe_rate('sum(s4)', 'sum(s3)', 4)} AS cart_to_purchase
FROM (
  SELECT category, v AS s1, v * c AS s2, v * c * a AS s3, v * c * a * p AS s4 FROM (
    SELECT {unit},
           max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v,
           max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS c,
           max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS a,
           max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p
    FROM {src} GROUP BY {unit} {having}))
GROUP BY category"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_decode"] = with_base() + f"SELECT {BRONZE_COLS} FROM bronze"
    q["silver_valid"] = with_base() + f"SELECT {BRONZE_COLS} FROM valid"
    q["silver_rejects"] = with_base() + """
SELECT topic, rejected_rule, count(*) AS rejected_rows FROM (
  SELECT topic, """ + FIRST_FAILED + """ AS rejected_rule FROM bronze)
WHERE rejected_rule IS NOT NULL GROUP BY topic, rejected_rule"""
    q["silver_dedup"] = with_base() + f"SELECT {BRONZE_COLS} FROM silver"
    for unit in ("1m", "1h", "1d"):
        q[f"user_metrics_{unit}"] = with_base() + user_gold("silver_user", unit)
        q[f"order_metrics_{unit}"] = with_base() + order_gold("silver_order", unit)
    q["user_metrics_approx"] = with_base() + f"SELECT *, TRUE AS within_bound FROM ({user_gold('silver_user', '1m')})"
    q["order_metrics_approx"] = with_base() + f"SELECT *, TRUE AS within_bound FROM ({order_gold('silver_order', '1m')})"
    q["export_versioned"] = merge_sql("user")
    q["merge_user_metrics"] = merge_sql("user")
    q["merge_order_metrics"] = merge_sql("order")
    q["conform_columns"] = with_base(f"g AS ({user_gold('silver_user', '1h')})") + \
        "SELECT product_id, product_name, category, window_start, " \
        "CASE WHEN hour(window_start) NOT IN (5, 15) THEN window_end END AS window_end, " \
        "view_count, click_count, add_to_cart_count, unique_users, click_through_rate, " \
        "CAST(NULL AS DOUBLE) AS add_to_cart_rate FROM g WHERE hour(window_start) NOT IN (3, 7, 13)"
    q["encode_and_route"] = with_base() + f"""
SELECT CASE WHEN event_type = 'purchase' THEN 'order_events' ELSE 'user_activity_events' END AS topic,
       user_id AS key, {PAYLOAD} FROM silver"""
    q["session_funnel"] = with_base(_union_events()) + funnel("ev", "session_id, category")
    q["open_carts"] = with_base(_union_events()) + """
SELECT user_id, product_id, added_at, count(*) OVER (PARTITION BY user_id) AS cart_size,
       added_at < (SELECT max(event_time) FROM ev) - INTERVAL 1 HOUR AS abandoned
FROM (
  SELECT user_id, product_id,
         max(CASE WHEN event_type = 'add_to_cart' THEN event_time END) AS added_at,
         max(CASE WHEN event_type = 'purchase' THEN event_time END) AS bought_at
  FROM ev GROUP BY user_id, product_id)
WHERE added_at IS NOT NULL AND (bought_at IS NULL OR added_at > bought_at)"""
    lag = "(epoch_us(kafka_timestamp) - epoch_us(producer_time)) / 1000000.0"
    late = "(epoch_us(producer_time) - epoch_us(event_time)) / 1000000.0"
    q["ingest_lag"] = with_base(_union_events()) + f"""
SELECT topic, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS events,
       {rnd('quantile_cont(broker_lag, 0.5)', 3)} AS broker_lag_p50,
       {rnd('quantile_cont(broker_lag, 0.95)', 3)} AS broker_lag_p95,
       {rnd('max(broker_lag)', 3)} AS broker_lag_max,
       {rnd('quantile_cont(lateness, 0.5)', 3)} AS lateness_p50,
       {rnd('quantile_cont(lateness, 0.95)', 3)} AS lateness_p95,
       {rnd('max(lateness)', 3)} AS lateness_max,
       {rnd('avg(CASE WHEN lateness > 60.0 THEN 1.0 ELSE 0.0 END)', 4)} AS late_share
FROM (SELECT topic, date_trunc('day', producer_time) AS window_start,
             {lag} AS broker_lag, {late} AS lateness FROM ev)
GROUP BY topic, window_start"""
    q["table_shape"] = with_base(
        f"ug AS ({user_gold('silver_user', '1m')})", f"og AS ({order_gold('silver_order', '1m')})") + """
SELECT 'user_metrics' AS table_name, count(*) AS row_count, 11 AS col_count FROM ug
UNION ALL SELECT 'order_metrics' AS table_name, count(*) AS row_count, 9 AS col_count FROM og"""
    q["stream_silver"] = with_base() + f"SELECT topic, {PAYLOAD} FROM silver"
    # rows held back until the rest of the stream is through are late by hours
    in_time = """in_time AS (
  SELECT * FROM silver
  WHERE NOT (CAST(substr(event_id, 2) AS BIGINT) % 97 = 1 AND producer_time <
    (SELECT make_timestamp(lo + (hi - lo) // 2) FROM (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events)) - INTERVAL 1 HOUR))"""
    q["stream_multi_batch"] = with_base(in_time) + f"SELECT topic, {PAYLOAD} FROM in_time"
    for kind, gold in (("user", user_gold), ("order", order_gold)):
        q[f"{kind}_metrics_rollup"] = with_base() + " UNION ALL ".join(
            f"SELECT '{unit}' AS unit, *, TRUE AS within_bound FROM ({gold(f'silver_{kind}', unit)})" for unit in ("1h", "1d"))
    # days of the hours that the topic's watermark has passed
    q["stream_ingest_lag"] = with_base("""closed AS (
  SELECT * FROM (SELECT *, max(producer_time) OVER (PARTITION BY topic) AS newest FROM silver)
  WHERE date_trunc('hour', producer_time) + INTERVAL 1 HOUR <= date_trunc('millisecond', newest) - INTERVAL 5 MINUTE)""") + f"""
SELECT topic, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS events,
       {rnd('max(broker_lag)', 3)} AS broker_lag_max, {rnd('max(lateness)', 3)} AS lateness_max,
       TRUE AS broker_lag_p50_in_bound, TRUE AS broker_lag_p95_in_bound,
       TRUE AS lateness_p50_in_bound, TRUE AS lateness_p95_in_bound
FROM (SELECT topic, date_trunc('day', producer_time) AS window_start, {lag} AS broker_lag, {late} AS lateness FROM closed)
GROUP BY topic, window_start"""
    q["stream_reject_metrics"] = q["silver_rejects"]
    q["stream_validated"] = with_base() + f"SELECT topic, {PAYLOAD}, {FIRST_FAILED} AS rejected_rule FROM bronze"
    # the first segment of partition 0 lies before the start, two of 20 segments have expired
    q["stream_offsets"] = with_base("""cut AS (
  SELECT 2 * greatest(1, (max("offset") + 1) // 40) AS segment FROM bronze)""") + f"""
SELECT {BRONZE_COLS} FROM bronze, cut
WHERE NOT ("partition" = 0 AND "offset" < segment) AND "offset" // segment NOT IN (13, 14)"""
    # sessions end 30 minutes after their last event; the slower topic's watermark closes them
    q["stream_session_funnel"] = with_base(in_time, """spaced AS (
  SELECT *, lag(event_time) OVER (PARTITION BY user_id, category ORDER BY event_time) AS prev FROM in_time)""", """island AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR event_time - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id, category ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS session FROM spaced)""", """mark AS (
  SELECT date_trunc('millisecond', min(t)) - INTERVAL 5 MINUTE AS now
  FROM (SELECT max(event_time) AS t FROM in_time GROUP BY topic))""") + funnel(
        "island", "user_id, category, session", "HAVING max(event_time) + INTERVAL 30 MINUTE <= (SELECT now FROM mark)")
    # the watermark follows the slower of adds and purchases
    q["stream_abandoned_carts"] = with_base(in_time, """move AS (
  SELECT DISTINCT user_id, product_id, event_type = 'purchase' AS bought, event_time AS t FROM in_time
  WHERE event_type IN ('add_to_cart', 'purchase'))""", """mark AS (
  SELECT date_trunc('millisecond', min(t)) - INTERVAL 5 MINUTE AS now FROM (SELECT max(t) AS t FROM move GROUP BY bought))""") + """
SELECT user_id, product_id, t AS added_at, t + INTERVAL 1 HOUR AS abandoned_at
FROM move a WHERE NOT bought AND t + INTERVAL 1 HOUR <= (SELECT now FROM mark)
  AND NOT EXISTS (SELECT 1 FROM move m WHERE m.user_id = a.user_id AND m.product_id = a.product_id
                  AND (m.t > a.t OR (m.bought AND m.t = a.t)) AND m.t <= a.t + INTERVAL 1 HOUR)"""
    q["stream_user_metrics"] = with_base(f"g AS ({user_gold('silver_user', '1m')})") + \
        "SELECT * FROM g WHERE window_end <= (SELECT max(event_time) FROM silver_user) - INTERVAL 5 MINUTE"
    # every closed window, whatever came late; one row a key, as the export keeps it
    tie = ", ".join(c for c in USER_METRICS_COLS if c not in KEYS and c != "window_end")
    q["stream_late_corrected"] = with_base(
        f"g AS ({user_gold('silver_user', '1m')})",
        "closed AS (SELECT * FROM g WHERE window_end <= (SELECT max(event_time) FROM silver_user) - INTERVAL 5 MINUTE)") + \
        f"SELECT * FROM closed QUALIFY row_number() OVER (PARTITION BY product_id, window_start ORDER BY ({tie}) DESC) = 1"
    q["stream_order_metrics"] = with_base(f"g AS ({order_gold('silver_order', '1m')})") + \
        "SELECT * FROM g WHERE window_end <= (SELECT max(event_time) FROM silver_order) - INTERVAL 5 MINUTE"
    return q
