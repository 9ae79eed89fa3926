"""Entry points: silver -> gold -> export over a bronze folder, availableNow."""

import json

import json as _json

from fixtures import SHOES, golden_payloads, messages_df, payload
from fixtures import t as at
from tidemark.__main__ import main
from tidemark.operators.decode import decode
from tidemark.schemas import ORDER_TOPIC, USER_METRICS_SCHEMA, USER_TOPIC
from tidemark.streaming.sinks import read_versioned


def test_silver_gold_export(spark, workdir, capsys):
    root = f"{workdir}/lake"
    # one later event per topic moves each watermark past the golden windows
    later = [(USER_TOPIC, _json.dumps(payload("z1", "u9", "view", at("10:30:00")))),
             (ORDER_TOPIC, _json.dumps(payload("z2", "u9", "purchase", at("10:30:00"), SHOES, 1.0)))]
    bronze = decode(messages_df(spark, golden_payloads() + later))
    for t in (USER_TOPIC, ORDER_TOPIC):
        bronze.where(f"topic = '{t}'").write.parquet(f"{root}/bronze/{t}")
    for job in ("silver", "gold"):
        assert main([job, "--root", root, "--available-now", "--poll-seconds", "1"]) == 0
    assert main(["export", "--root", root]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # closed windows only: user 10:00 and 10:01 (P001), order 10:01 (P009)
    assert report["user_metrics"]["rows"] == 2 and report["order_metrics"]["rows"] == 1
    exported = read_versioned(spark, f"{root}/export/user_metrics", USER_METRICS_SCHEMA)
    got = sorted((r.window_start.strftime("%H:%M"), r.view_count, r.unique_users) for r in exported.collect())
    assert got == [("10:00", 4, 3), ("10:01", 0, 1)]
    assert main(["export", "--root", root]) == 0          # re-export: same rows, next version
    assert read_versioned(spark, f"{root}/export/user_metrics", USER_METRICS_SCHEMA).count() == 2


def test_all_jobs_from_staged_messages(spark, workdir):
    """bronze (from message files) -> silver -> gold (exact) -> export, over sf0.001."""
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from tidemark.plans.batch import Layers
    from tidemark.schemas import ORDER_METRICS_SCHEMA
    from tidemark.streaming.jobs import stage_messages
    root, msgs = f"{workdir}/lake", f"{workdir}/archive"
    stage_messages(spark, SF_SMALL, msgs)
    for job in ("bronze", "silver", "gold"):
        extra = ["--messages", msgs] if job == "bronze" else []
        if job == "gold":
            extra = ["--distinct", "exact", "--window", "1 hour"]
        assert main([job, "--root", root, "--available-now", "--poll-seconds", "1", *extra]) == 0
    assert main(["export", "--root", root]) == 0
    exported = read_versioned(spark, f"{root}/export/order_metrics", ORDER_METRICS_SCHEMA)
    lay = Layers(spark, SF_SMALL)
    silver = lay.silver_order()
    horizon = silver.agg(F.max("event_time")).first()[0] - __import__("datetime").timedelta(minutes=5)
    batch = lay.order_gold("1 hour", "exact").where(F.col("window_end") <= F.lit(horizon))
    cols = list(ORDER_METRICS_SCHEMA.fieldNames())
    assert sorted(tuple(r) for r in exported.select(*cols).collect()) == \
        sorted(tuple(r) for r in batch.select(*cols).collect())
