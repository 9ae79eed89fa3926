"""Driver contract: the query set of SURVEY §7.3 is registered."""

import __spark_entry__ as E

# query names of the build plan's query table
PLANNED = {
    "bronze_decode", "silver_valid", "silver_rejects", "silver_dedup",
    "user_metrics_1m", "user_metrics_1h", "user_metrics_1d",
    "order_metrics_1m", "order_metrics_1h", "order_metrics_1d",
    "user_metrics_approx", "order_metrics_approx",
    "merge_user_metrics", "merge_order_metrics", "conform_columns", "encode_and_route",
    "session_funnel", "open_carts", "ingest_lag", "table_shape",
    "stream_silver", "stream_user_metrics", "stream_order_metrics",
    # beyond the plan: the export sink over batches, a stream with restarts
    "export_versioned", "stream_multi_batch",
    "stream_abandoned_carts", "stream_offsets", "user_metrics_rollup", "order_metrics_rollup", "stream_ingest_lag",
    "stream_validated", "stream_reject_metrics", "stream_late_corrected", "stream_session_funnel",
}


def test_planned_queries_registered():
    assert set(E.queries()) >= PLANNED


def test_oracle_keys_are_registered_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert all(isinstance(v, str) and v.strip() for v in E.oracle_sql().values())
