"""Stateful streaming semantics (FIXTURES §3).

One input file and one ``availableNow`` run per batch, restarting from the
same checkpoint; shuffle partitions 2, session time zone UTC.
"""

import contextlib

import pytest

from fixtures import event, messages_df
from tidemark.operators.decode import decode
from tidemark.schemas import BRONZE_SCHEMA, USER_METRICS_SCHEMA
from tidemark.sources.tables import read_sink_table
from tidemark.streaming.jobs import start_gold, start_silver

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextlib.contextmanager
def confs(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Feeder:
    """Writes one bronze file per batch and runs the job once over it."""

    def __init__(self, spark, root, layer, **job_kw):
        self.spark, self.layer, self.kw = spark, layer, job_kw
        self.inp, self.out = f"{root}/in", f"{root}/out"
        self.n = 0

    def feed(self, items):
        spark = self.spark
        self.n += 1
        decode(messages_df(spark, items, start_offset=100 * self.n)) \
            .coalesce(1).write.mode("append").parquet(self.inp)
        trig = {"availableNow": True}
        if self.layer == "silver":
            q = start_silver(spark, self.inp, self.out, None, trig, **self.kw)
            schema = BRONZE_SCHEMA
        else:
            q = start_gold(spark, self.inp, self.out, None, "user", trig, **self.kw)
            schema = USER_METRICS_SCHEMA
        q.awaitTermination()
        assert q.exception() is None
        progress = q.lastProgress or {}
        ops = progress.get("stateOperators") or [{}]
        return read_sink_table(spark, self.out, schema).count(), ops[0].get("numRowsTotal")

    def run(self, batches):
        return [self.feed(b) for b in batches]


def ev(i, m, etype="view"):
    return event(i, m, etype)


LATE = [[ev("a", 0)], [ev("b", 60)], [ev("late1", 30)], [ev("late2", 30)], [ev("c", 61)]]


def test_dedup_late_rows_without_empty_batches(spark, workdir):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "silver", empty_batches=False)
        counts = [c for c, _ in f.run(LATE)]
    spark.conf.set(NO_DATA, "true")
    # late1 passes (late filter uses the previous batch's watermark), late2 is dropped
    assert counts == [1, 2, 3, 3, 4]


@pytest.mark.parametrize("empty_batches,expected", [(False, [0, 0, 2, 2, 2]), (True, [0, 1, 1, 1, 1])])
def test_window_emission_and_late_drop(spark, workdir, empty_batches, expected):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "gold", window="1 minute", delay="5 minutes",
                   empty_batches=empty_batches)
        counts = [c for c, _ in f.run(LATE)]
    spark.conf.set(NO_DATA, "true")
    assert counts == expected


GROWTH = [[ev("a", 0), ev("a", 0), ev("b", 1)], [ev("c", 60)],
          [ev("d", 61), ev("late", 40), ev("a", 55)], [ev("e", 120)], [ev("f", 121)]]


@pytest.mark.parametrize("unbounded,state", [(True, [2, 3, 5, 6, 7]), (False, [2, 3, 2, 3, 2])])
def test_dedup_state_is_bounded_by_watermark(spark, workdir, unbounded, state):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "silver", unbounded=unbounded, empty_batches=False)
        res = f.run(GROWTH)
    spark.conf.set(NO_DATA, "true")
    assert [s for _, s in res] == state
    assert res[-1][0] == 7


def test_invalid_far_future_row_does_not_move_watermark(spark, workdir):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "silver")
        counts = [c for c, _ in f.run([[ev("a", 0)], [ev("x", 9999, "error")], [ev("b", 1)], [ev("c", 2)]])]
    assert counts == [1, 1, 2, 3]


def test_valid_far_future_row_moves_watermark(spark, workdir):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "silver")
        counts = [c for c, _ in f.run([[ev("a", 0)], [ev("v", 9999)], [ev("b", 1)], [ev("c", 2)]])]
    assert counts == [1, 2, 2, 2]


def test_redelivery_after_expiry_is_late_reuse_passes(spark, workdir):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "silver")
        counts = [c for c, _ in f.run([[ev("a", 0)], [ev("z", 60)], [ev("y", 61)],
                                       [ev("a", 0)], [ev("a", 61)]])]
    assert counts == [1, 2, 3, 3, 4]


def test_restart_does_not_duplicate(spark, workdir):
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        f = Feeder(spark, workdir, "silver")
        counts = [c for c, _ in f.run([[ev("a", 0)], [ev("a", 0), ev("b", 1)], [ev("a", 0), ev("b", 1)]])]
    assert counts == [1, 2, 2]


def test_single_query_silver_to_gold(spark, workdir):
    """Dedup within watermark then a 1-minute count in one query, delay 5 min."""
    from tidemark.streaming.jobs import start_silver_gold
    counts = []
    with confs(spark, **{"spark.sql.shuffle.partitions": "2"}):
        inp, out = f"{workdir}/in", f"{workdir}/out"
        for i, batch in enumerate(LATE):
            decode(messages_df(spark, batch, start_offset=100 * i)).coalesce(1) \
                .write.mode("append").parquet(inp)
            q = start_silver_gold(spark, inp, out, None, "user", {"availableNow": True},
                                  window="1 minute", delay="5 minutes")
            q.awaitTermination()
            counts.append(read_sink_table(spark, out, USER_METRICS_SCHEMA).count())
    assert counts == [0, 1, 1, 1, 1]


def test_gold_output_partitions_bound_files(spark, workdir):
    import glob
    with confs(spark, **{"spark.sql.shuffle.partitions": "8"}):
        inp, out = f"{workdir}/in", f"{workdir}/out"
        items = [ev(f"k{i}", i) for i in range(30)] + [ev("late_mover", 120)]
        decode(messages_df(spark, items)).write.parquet(inp)
        q = start_gold(spark, inp, out, None, "user", {"availableNow": True}, output_partitions=1)
        q.awaitTermination()
    files = [f for f in glob.glob(f"{out}/part-*.parquet")]
    assert read_sink_table(spark, out, USER_METRICS_SCHEMA).count() == 30
    assert 1 <= len(files) <= 2          # one per micro-batch that emitted rows


def test_state_partitions_pinned_at_start(spark, workdir):
    decode(messages_df(spark, [ev("a", 0), ev("b", 1)])).write.parquet(f"{workdir}/in")
    q = start_silver(spark, f"{workdir}/in", f"{workdir}/out", None, {"availableNow": True},
                     state_partitions=3)
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_dedup_late_rows_with_earlier_late_rule(spark, workdir):
    """With the pre-multi-operator late-row rule, late1 is dropped one batch earlier."""
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    with confs(spark, **{"spark.sql.shuffle.partitions": "2", key: "false"}):
        f = Feeder(spark, workdir, "silver", empty_batches=False)
        counts = [c for c, _ in f.run(LATE)]
    spark.conf.set(NO_DATA, "true")
    assert counts == [1, 2, 2, 2, 3]


def test_rate_limit_splits_into_batches(spark, workdir):
    """S4 on the file source: at most one file per micro-batch."""
    from fixtures import wait_for_listener
    from tidemark.streaming.supervise import ProgressLog
    for i in range(3):
        decode(messages_df(spark, [ev(f"r{i}", i)], start_offset=10 * i)).coalesce(1) \
            .write.mode("append").parquet(f"{workdir}/in")
    log = ProgressLog().attach(spark)
    try:
        q = start_silver(spark, f"{workdir}/in", f"{workdir}/out", "rate_limited",
                         {"availableNow": True}, max_files_per_trigger=1)
        q.awaitTermination()
        wait_for_listener(log, "rate_limited", 3)
        data_batches = [r for r in log.rows("rate_limited") if r["num_input_rows"] > 0]
        assert [r["num_input_rows"] for r in data_batches] == [1, 1, 1]
    finally:
        log.detach(spark)
    assert read_sink_table(spark, f"{workdir}/out", BRONZE_SCHEMA).count() == 3


def test_precombine_copies_keeps_results(spark, workdir):
    """A replay storm of one id (a third of the rows): same silver with and
    without pre-combining copies before the dedup shuffle."""
    import json as _json

    from fixtures import payload as _payload
    from tidemark.schemas import PAYLOAD_COLS, USER_TOPIC as _UT
    storm = [ev("hot", 5)] * 150
    others = [ev(f"k{i}", i % 30) for i in range(280)]
    # re-used id at another time, and an invalid first copy followed by a valid one
    reused = [ev("re", 1), ev("re", 3)]
    bad = _payload("mixed", "u1", "view", "2024-01-01T00:04:00+00:00", price=-1.0)
    good = _payload("mixed", "u1", "view", "2024-01-01T00:04:00+00:00")
    items = storm[:75] + others[:140] + reused + [(_UT, _json.dumps(bad)), (_UT, _json.dumps(good))] \
        + storm[75:] + others[140:]
    half = len(items) // 2
    for i, part in enumerate((items[:half], items[half:])):
        decode(messages_df(spark, part, start_offset=1000 * i)).coalesce(1) \
            .write.mode("append").parquet(f"{workdir}/in")
    results = []
    for flag in (False, True):
        out = f"{workdir}/out_{flag}"
        q = start_silver(spark, f"{workdir}/in", out, None, {"availableNow": True},
                         precombine_copies=flag)
        q.awaitTermination()
        assert q.exception() is None
        rows = read_sink_table(spark, out, BRONZE_SCHEMA).select(*PAYLOAD_COLS).collect()
        results.append(sorted(tuple(r) for r in rows))
    assert results[0] == results[1]
    ids = [r[0] for r in results[1]]
    assert ids.count("hot") == 1 and ids.count("re") == 1 and ids.count("mixed") == 1
    assert len(ids) == 1 + 280 + 1 + 1


def test_precombine_drops_only_exact_repeats(spark):
    from tidemark.operators.dedup import precombine
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 1, "w")],
        "event_id string, event_time int, payload string").coalesce(1)
    got = sorted(tuple(r) for r in precombine(df).collect())
    assert got == [("a", 1, "x"), ("a", 2, "z"), ("b", 1, "w")]
