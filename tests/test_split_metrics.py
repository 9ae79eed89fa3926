"""Valid rows and rejects under one batch id; what jobs did as a table."""

import os

from pyspark.sql import functions as F

from fixtures import event, golden_payloads, messages_df
from tidemark.__main__ import main
from tidemark.operators.decode import decode
from tidemark.operators.validate import reject_counts, validate
from tidemark.schemas import BRONZE_SCHEMA, ORDER_TOPIC, USER_TOPIC
from tidemark.streaming import metrics_table
from tidemark.streaming.jobs import start_silver, start_validated
from tidemark.streaming.metrics_table import MetricsTable, read_metrics
from tidemark.streaming.split import REJECTED, VALID, read_split

ONCE = {"availableNow": True}


def _run(spark, root, **kw):
    q = start_validated(spark, f"{root}/in", f"{root}/out", None, ONCE, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def _rows(df):
    return sorted(map(str, df.select(*BRONZE_SCHEMA.names).collect()))


def test_both_outputs_make_up_the_input_after_a_replay(spark, workdir):
    bronze = decode(messages_df(spark, golden_payloads()))
    for k in range(2):
        bronze.where(F.col("offset") % 2 == k).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
    _run(spark, workdir, max_files_per_trigger=1)
    before = {b: os.stat(f"{workdir}/out/{r}/{b}").st_mtime_ns for r in os.listdir(f"{workdir}/out")
              if r.startswith("run=") for b in os.listdir(f"{workdir}/out/{r}")}
    assert set(before) == {"batch_id=0", "batch_id=1"}
    for name in ("1", ".1.crc"):
        os.rename(f"{workdir}/out/_checkpoint/commits/{name}", f"{workdir}/{name}-gone")
    q = _run(spark, workdir, max_files_per_trigger=1)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]           # it came again
    valid = read_split(spark, f"{workdir}/out", BRONZE_SCHEMA, VALID)
    bad = read_split(spark, f"{workdir}/out", BRONZE_SCHEMA, REJECTED)
    assert _rows(valid) == _rows(validate(bronze))
    assert _rows(valid.unionByName(bad)) == _rows(bronze)
    assert {(r.topic, r.rejected_rule): r.n for r in bad.groupBy("topic", "rejected_rule").agg(F.count("*").alias("n")).collect()} \
        == {(r.topic, r.rejected_rule): r.rejected_rows for r in reject_counts(bronze).collect()}


def test_an_unfinished_batch_is_not_shown_and_a_reset_keeps_the_old_rows(spark, workdir):
    decode(messages_df(spark, [event("a", 0), event("b", 1, "error")])).write.parquet(f"{workdir}/in")
    _run(spark, workdir)
    run = next(r for r in os.listdir(f"{workdir}/out") if r.startswith("run="))
    os.rename(f"{workdir}/out/{run}/batch_id=0/_SUCCESS", f"{workdir}/mark")
    assert read_split(spark, f"{workdir}/out", BRONZE_SCHEMA).count() == 0
    os.rename(f"{workdir}/mark", f"{workdir}/out/{run}/batch_id=0/_SUCCESS")
    os.rename(f"{workdir}/out/_checkpoint", f"{workdir}/old-checkpoint")
    os.rename(f"{workdir}/in", f"{workdir}/old-in")
    decode(messages_df(spark, [event("c", 5)])).write.parquet(f"{workdir}/in")
    _run(spark, workdir)                                                                # batch 0 of another query
    got = read_split(spark, f"{workdir}/out", BRONZE_SCHEMA)
    assert sorted((r.event_id, r.rejected_rule) for r in got.collect()) == [
        ("a", None), ("b", "event_type_known"), ("c", None)]


def test_metrics_count_rules_and_late_rows_per_batch(spark, workdir, monkeypatch):
    monkeypatch.setattr(metrics_table, "LINES", 2)            # written on the way, not at the end
    parts = [[event("a", 0), event("x", 0, "error")], [event("b", 60)], [event("c", 61)],
             [event("late", 30), event("d", 62)]]
    table = MetricsTable(spark, f"{workdir}/metrics").attach()
    queries = []
    for k, part in enumerate(parts):
        decode(messages_df(spark, part, start_offset=10 * k)).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
        q = start_silver(spark, f"{workdir}/in", f"{workdir}/out", "silver_test", ONCE, state_partitions=2)
        q.awaitTermination()
        queries.append(q)
        assert len(table._lines) < 2
    table.detach(queries[-1:])
    rows = read_metrics(spark, f"{workdir}/metrics").where("query = 'silver_test'").orderBy("batch_id").collect()
    data = [r for r in rows if r.input_rows]
    assert [r.input_rows for r in data] == [2, 1, 1, 2]
    assert [r.counts["event_type_known"] for r in data] == [1, 0, 0, 0]
    assert [r.counts["rows"] for r in data] == [2, 1, 1, 2]
    assert sum(r.late_rows for r in rows) == 1 and data[-1].late_rows == 1
    assert len({(r.query_id, r.batch_id) for r in rows}) == len(rows)


def test_jobs_of_the_command_line_write_metrics(spark, workdir):
    root = f"{workdir}/lake"
    bronze = decode(messages_df(spark, golden_payloads()))
    for t in (USER_TOPIC, ORDER_TOPIC):
        bronze.where(f"topic = '{t}'").write.parquet(f"{root}/bronze/{t}")
    for job in ("silver", "gold"):
        assert main([job, "--root", root, "--available-now", "--poll-seconds", "1"]) == 0
    assert main(["export", "--root", root]) == 0
    rows = read_metrics(spark, f"{root}/metrics")
    rules = (rows.select("query", F.explode("counts").alias("rule", "n")).where("n > 0 AND rule <> 'rows'")
             .groupBy("query", "rule").agg(F.sum("n").alias("n")))
    want = reject_counts(bronze).collect()
    assert {(r.query, r.rule): r.n for r in rules.where("query LIKE 'silver%'").collect()} == \
        {(f"silver_{r.topic}", r.rejected_rule): r.rejected_rows for r in want}
    assert {r.query for r in rows.collect()} >= {"gold_user_metrics", "gold_order_metrics"}
