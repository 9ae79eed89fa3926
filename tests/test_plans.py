"""Physical-plan properties of the registered batch queries."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from tidemark.plans.catalog import registry

QUERIES = registry()
BATCH = sorted(k for k in QUERIES if not k.startswith("stream_") and k != "table_shape")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (name, bad)


def test_dedup_keeps_first_arrival_map_side(spark):
    p = plan_of(QUERIES["silver_dedup"](spark, SF_SMALL))
    # plan text is printed top-down: the partial top-1 sits below (before) the shuffle
    shuffle = p.index("Exchange hashpartitioning(topic")
    assert "row_number(), 1, Partial" in p[shuffle:]
    assert "row_number(), 1, Final" in p[:shuffle]


def test_metrics_combine_map_side(spark):
    p = plan_of(QUERIES["user_metrics_1h"](spark, SF_SMALL))
    assert "partial_sum" in p
    p = plan_of(QUERIES["user_metrics_approx"](spark, SF_SMALL))
    assert "partial_approx_count_distinct" in p


def test_catalog_scan_is_pruned_and_topic_filter_reaches_events_scan(spark):
    p = plan_of(QUERIES["order_metrics_1h"](spark, SF_SMALL))
    part_scan = [ln for ln in p.splitlines() if "part.parquet" in ln][0]
    assert "p_brand" not in part_scan and "p_retailprice" not in part_scan
    events_scan = [ln for ln in p.splitlines() if "events.parquet" in ln][0]
    assert "DataFilters: [" in events_scan and "purchase" in events_scan


def test_open_carts_has_no_window(spark):
    p = plan_of(QUERIES["open_carts"](spark, SF_SMALL))
    assert "Window" not in p
