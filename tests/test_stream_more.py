"""Sessions in state, late rows corrected, state read from checkpoints, sliced runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fixtures import event, messages_df, payload
from tidemark.operators.decode import decode
from tidemark.operators.explore import funnel_of, session_units
from tidemark.operators.metrics import user_metrics
from tidemark.plans.batch import to_silver
from tidemark.schemas import (BRONZE_SCHEMA, MERGE_KEYS, ORDER_TOPIC, USER_METRICS_SCHEMA, USER_METRICS_UPDATE,
                              USER_TOPIC)
from tidemark.sources.tables import read_sink_table
from tidemark.streaming.jobs import start_gold, start_sessions, start_silver
from tidemark.streaming.late import export_corrected, start_late
from tidemark.streaming.sinks import read_versioned
from tidemark.streaming.state import state_operators, state_rows
from tidemark.streaming.supervise import supervise

ONCE = {"availableNow": True}


def add(spark, path, items, n):
    decode(messages_df(spark, items, start_offset=1000 * n)).coalesce(1).write.mode("append").parquet(path)


def done(q):
    supervise([q], poll_seconds=0.2)


# --- sessions -------------------------------------------------------------------------

def act(n, user, minute, etype, category="c"):
    import json
    at = (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)).isoformat() + "+00:00"
    topic = ORDER_TOPIC if etype == "purchase" else USER_TOPIC
    return topic, json.dumps(payload(f"e{n}", user, etype, at, ("P1", "n", category)))


def test_sessions_merge_over_starts_and_equal_the_batch_funnel(spark, workdir):
    rng = random.Random(7)
    items = [act(k, f"u{rng.randrange(5)}", k * 4, rng.choice(["view", "click", "add_to_cart", "purchase"]),
                 rng.choice("ab")) for k in range(150)]
    items += [act(900, "end", 700, "view"), act(901, "end", 700, "purchase")]
    paths = [f"{workdir}/user", f"{workdir}/order"]
    for n, part in enumerate((items[:60], items[60:61], items[61:])):
        for path, topic in zip(paths, (USER_TOPIC, ORDER_TOPIC)):
            add(spark, path, [i for i in part if i[0] == topic], n)
        q = start_sessions(spark, paths, f"{workdir}/sessions", None, ONCE, delay="5 minutes", state_partitions=2)
        done(q)
    got = spark.read.parquet(f"{workdir}/sessions")
    events = spark.read.schema(BRONZE_SCHEMA).parquet(*paths)
    want = session_units(events, "category", "30 minutes").where(
        F.col("session_end") <= F.lit("2024-01-01 11:35:00").cast("timestamp"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 30
    assert sorted(map(tuple, funnel_of(got).collect())) == sorted(map(tuple, funnel_of(want).collect()))
    spans = [r for r in want.collect() if r.events > 3]
    assert spans and (got.agg(F.max("events")).first()[0] > 3)


def test_a_late_event_that_joins_two_open_sessions_merges_them(spark, workdir):
    path = f"{workdir}/user"
    for n, part in enumerate(([act(1, "u", 0, "view"), act(2, "u", 50, "click")], [act(3, "u", 25, "add_to_cart")],
                              [act(4, "x", 300, "view")])):
        add(spark, path, part, n)
        done(start_sessions(spark, [path], f"{workdir}/sessions", None, ONCE, delay="2 hours", state_partitions=2))
    rows = spark.read.parquet(f"{workdir}/sessions").collect()
    assert [(r.user_id, r.v, r.c, r.a, r.p, r.events) for r in rows] == [("u", 1, 1, 1, 0, 3)]
    assert (rows[0].session_end - rows[0].session_start) == dt.timedelta(minutes=80)


# --- late rows --------------------------------------------------------------------------

def _lake(spark, root, parts, replay_at=None):
    """Bronze part by part through silver, gold, late and export; returns the export."""
    import os
    for n, part in enumerate(parts):
        add(spark, f"{root}/bronze", part, n)
        done(start_silver(spark, f"{root}/bronze", f"{root}/silver", None, ONCE, state_partitions=2))
        done(start_gold(spark, f"{root}/silver", f"{root}/gold", None, "user", ONCE, distinct="exact",
                        state_partitions=2))
        done(start_late(spark, f"{root}/bronze", f"{root}/late", None, "user", ONCE, distinct="exact"))
        if n == replay_at:
            for name in (str(n), f".{n}.crc"):
                os.rename(f"{root}/late/_checkpoint/commits/{name}", f"{root}/{name}-gone")
            done(start_late(spark, f"{root}/bronze", f"{root}/late", None, "user", ONCE, distinct="exact"))
        export_corrected(spark, f"{root}/gold", f"{root}/late", f"{root}/export", USER_METRICS_SCHEMA, MERGE_KEYS,
                         USER_METRICS_UPDATE)
    return read_versioned(spark, f"{root}/export", USER_METRICS_SCHEMA)


@pytest.mark.parametrize("replay_at", [None, 2])
def test_export_equals_the_batch_result_after_late_rows(spark, workdir, replay_at):
    parts = [[event("a", 0), event("b", 0.5), event("c", 30)],
             [event("d", 90), event("e", 91)],
             [event("late1", 0.2), event("late2", 17), event("a", 0), event("bad", 18, "error"), event("f", 120)],
             [event("late3", 0.7), event("g", 121)]]
    got = _lake(spark, workdir, parts, replay_at)
    silver = to_silver(spark.read.schema(BRONZE_SCHEMA).parquet(f"{workdir}/bronze"))
    closed = user_metrics(silver, "1 minute", "exact").where("window_end <= '2024-01-01 01:56:00'")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.collect()))
    first = got.where("window_start = '2024-01-01 00:00:00'").first()
    assert first.view_count == 4                              # a, b, late1, late3; a again is a copy
    gold = read_sink_table(spark, f"{workdir}/gold", USER_METRICS_SCHEMA)
    assert gold.where("window_start = '2024-01-01 00:00:00'").first().view_count == 2    # the stream itself lost them


def test_without_late_rows_nothing_is_computed_again(spark, workdir):
    import glob
    _lake(spark, workdir, [[event("a", 0), event("b", 1)], [event("c", 60)], [event("d", 58), event("e", 61)]])
    assert glob.glob(f"{workdir}/late/run=*") == []


# --- state ------------------------------------------------------------------------------

GROWTH = [[event("a", 0), event("b", 1)], [event("c", 60)], [event("d", 61), event("a", 55)], [event("e", 120)]]


@pytest.mark.parametrize("unbounded,keys", [(True, {"a", "b", "c", "d", "e"}), (False, {"d", "e"})])
def test_state_holds_the_keys_of_the_bound(spark, workdir, unbounded, keys):
    for n, part in enumerate(GROWTH):
        add(spark, f"{workdir}/in", part, n)
        done(start_silver(spark, f"{workdir}/in", f"{workdir}/out", None, ONCE, unbounded=unbounded, empty_batches=False,
                          state_partitions=3))
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    rows = state_rows(spark, f"{workdir}/out/_checkpoint")
    held = {r.id for r in rows.select(F.col("key.event_id").alias("id")).collect()}
    if unbounded:
        assert held == keys
    else:
        assert held < {"a", "b", "c", "d", "e"} and "e" in held and "b" not in held
    ops = state_operators(spark, f"{workdir}/out/_checkpoint").collect()
    assert [o.width for o in ops] == [3] and ops[0].last_batch >= 3
    assert "edup" in ops[0].operatorName


def test_the_width_of_a_checkpoint_stays_pinned(spark, workdir):
    for n, width in enumerate((3, 5)):
        add(spark, f"{workdir}/in", GROWTH[n], n)
        done(start_silver(spark, f"{workdir}/in", f"{workdir}/out", None, ONCE, state_partitions=width))
    assert [o.width for o in state_operators(spark, f"{workdir}/out/_checkpoint").collect()] == [3]
    assert state_rows(spark, f"{workdir}/out/_checkpoint").where("partition_id > 2").count() == 0


# --- sliced runs --------------------------------------------------------------------------

def test_every_layer_of_a_sliced_run_works_in_bounded_batches(spark, workdir):
    import json
    import os

    from conftest import SF_SMALL
    from tidemark.streaming.jobs import SLICES, run_chain
    paths = run_chain(spark, SF_SMALL, workdir, topics=[USER_TOPIC], slices=SLICES)
    for layer in ("bronze", "silver", "gold"):
        log = f"{paths[f'{layer}_user']}/_checkpoint/sources/0"
        files = {}
        for name in os.listdir(log):
            if not name.startswith("."):
                for line in open(f"{log}/{name}").read().splitlines()[1:]:
                    files.setdefault(json.loads(line)["batchId"], []).append(line)
        assert len(files) >= SLICES and all(len(f) == 1 for f in files.values()), layer


def test_files_of_a_sliced_run_grow_in_number_not_in_size(spark, workdir, monkeypatch):
    """More messages than a file holds: every layer's slice is several files and still one micro-batch."""
    import json
    import os

    from conftest import SF_SMALL
    from tidemark.plans.batch import Layers
    from tidemark.streaming import jobs
    monkeypatch.setattr(jobs, "FILE_ROWS", 100)
    # read back by several tasks, as larger tables are
    monkeypatch.setattr(jobs, "stored", lambda session, df, label: df.repartition(8))
    paths = jobs.run_chain(spark, SF_SMALL, workdir, topics=[USER_TOPIC], slices=jobs.SLICES, distinct="exact")
    for layer in ("bronze", "silver", "gold"):
        log = f"{paths[f'{layer}_user']}/_checkpoint/sources/0"
        files = {}
        for name in os.listdir(log):
            if not name.startswith("."):
                for line in open(f"{log}/{name}").read().splitlines()[1:]:
                    files.setdefault(json.loads(line)["batchId"], []).append(line)
        # the empty file of a batch that only moves the state on comes after, alone
        assert sum(len(f) > 1 for f in files.values()) == jobs.SLICES, layer
    silver = spark.read.parquet(paths["silver_user"])
    expected = Layers(spark, SF_SMALL).silver_user()
    assert sorted(r.event_id for r in silver.collect()) == sorted(r.event_id for r in expected.collect())


def test_session_state_is_compacted_and_the_conf_comes_back(spark, workdir, monkeypatch):
    """Sessions are looked up by key prefix: what the watermark removed must not be passed over again."""
    from tidemark.streaming import jobs
    seen, sink = [], jobs._sink

    def started(*args, **kw):
        seen.append(spark.conf.get(jobs.COMPACT, None))
        return sink(*args, **kw)
    monkeypatch.setattr(jobs, "_sink", started)
    add(spark, f"{workdir}/in", GROWTH[0], 0)
    done(jobs.start_sessions(spark, [f"{workdir}/in"], f"{workdir}/sessions", None, ONCE, state_partitions=2))
    assert seen == ["true"]
    assert spark.conf.get(jobs.COMPACT, None) is None


def test_a_few_large_message_files_are_read_by_many_tasks(spark, workdir, monkeypatch):
    """The files of the restarted runs have small row groups, so that a bounded batch uses all cores."""
    import os

    import pyarrow.parquet as pq
    from conftest import SF_ORACLE
    from tidemark.streaming import jobs
    monkeypatch.setattr(jobs, "ROW_GROUP", 1 << 17)
    monkeypatch.setattr(jobs, "new_run_dir", lambda session, label: f"{workdir}/{label}")
    jobs.run_restarts(spark, SF_ORACLE)
    raw = f"{workdir}/restarts/raw/topic={USER_TOPIC}"
    groups = [pq.read_metadata(f"{raw}/{f}").num_row_groups for f in os.listdir(raw) if f.startswith("part-")]
    assert max(groups) > 1
