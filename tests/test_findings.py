"""Behaviours the survey calls out, kept for parity and pinned here."""

import datetime as dt
import json
import shutil

from fixtures import messages_df, payload, t
from tidemark.operators.decode import decode
from tidemark.operators.merge import merge_upsert
from tidemark.operators.metrics import user_metrics
from tidemark.plans.batch import to_silver
from tidemark.schemas import BRONZE_SCHEMA, MERGE_KEYS, USER_METRICS_UPDATE, USER_TOPIC
from tidemark.sources.tables import read_sink_table
from tidemark.streaming.jobs import start_silver


def test_f8_uncommitted_files_are_not_read(spark, workdir):
    """A sink table is read through its commit log: a data file that no batch
    committed (e.g. left by a failed attempt) is ignored."""
    decode(messages_df(spark, [(USER_TOPIC, json.dumps(payload("a", "u1", "view", t("10:00:00"))))])) \
        .write.parquet(f"{workdir}/in")
    q = start_silver(spark, f"{workdir}/in", f"{workdir}/out", None, {"availableNow": True})
    q.awaitTermination()
    committed = read_sink_table(spark, f"{workdir}/out", BRONZE_SCHEMA)
    stray = [p for p in __import__("glob").glob(f"{workdir}/out/part-*.parquet")][0]
    shutil.copy(stray, f"{workdir}/out/part-99999-stray.parquet")
    assert committed.count() == 1
    assert read_sink_table(spark, f"{workdir}/out", BRONZE_SCHEMA).count() == 1


def test_f10_renamed_product_collapses_on_export(spark):
    """Gold groups by name too, the export key does not: the two gold rows of a
    renamed product in one window become one exported row (last one wins)."""
    rows = [payload("e1", "u1", "view", t("10:00:00"), ("P1", "Old", "C")),
            payload("e2", "u2", "view", t("10:00:10"), ("P1", "New", "C")),
            payload("e3", "u3", "click", t("10:00:20"), ("P1", "New", "C"))]
    silver = to_silver(decode(messages_df(spark, [(USER_TOPIC, json.dumps(r)) for r in rows])))
    gold = user_metrics(silver, "1 minute", "exact")
    assert gold.count() == 2
    empty = spark.createDataFrame([], gold.schema)
    out = merge_upsert(empty, gold, MERGE_KEYS, USER_METRICS_UPDATE,
                       order_by=["window_end", "product_name"]).collect()
    assert len(out) == 1
    assert (out[0].product_name, out[0].view_count, out[0].click_count) == ("Old", 1, 0)


def test_f11_gold_does_not_filter_event_type(spark):
    """A purchase routed to the user table adds a zero-count row and a user."""
    rows = [payload("e1", "u1", "purchase", t("10:00:00"))]
    silver = to_silver(decode(messages_df(spark, [(USER_TOPIC, json.dumps(r)) for r in rows])))
    r = user_metrics(silver, "1 minute", "exact").collect()[0]
    assert (r.view_count, r.click_count, r.add_to_cart_count, r.unique_users) == (0, 0, 0, 1)
    assert r.window_start == dt.datetime(2024, 1, 1, 10, 0)
