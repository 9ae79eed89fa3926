"""Streaming jobs of the three layers.

Each job is one append-mode query writing a file table, with its checkpoint
nested in the table folder as ``_checkpoint`` (K2). Triggers are a parameter:
``{"processingTime": "5 minutes"}`` in production, ``{"availableNow": True}``
in tests and backfills. All layer logic comes from the batch operators.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.decode import decode
from ..operators.explore import funnel_of, session_units
from ..operators.metrics import order_metrics, user_metrics
from ..operators.sketches import lag_partials, lag_quantiles, lag_rolled_up, metric_partials, rank_checked
from ..plans.batch import to_silver
from ..schemas import (BRONZE_COLS, BRONZE_SCHEMA, GOLD_WATERMARK, GOLD_WINDOW, MERGE_KEYS, ORDER_METRICS_SCHEMA,
                       ORDER_TOPIC, PAYLOAD_COLS, SILVER_WATERMARK, TOPICS,
                       USER_METRICS_SCHEMA, USER_METRICS_UPDATE, USER_TOPIC)
from ..session import SESSION_CONF, ensure_utc, new_run_dir, remove_at_exit, stored
from ..sources.kafka import message_file_stream
from ..sources.offsets import offset_stream, stage_segments
from ..sources.tables import read_sink_table, read_table_stream
from ..sources.testdata import raw_messages
from .carts import SCHEMA as CART_SCHEMA
from .carts import abandoned_carts
from .late import export_corrected, start_late
from .metrics_table import MetricsTable, observe_rules, read_metrics
from .sinks import read_versioned, remove_folder
from .split import read_split, start_split
from .supervise import drain, supervise

PRODUCTION_TRIGGER = {"processingTime": "5 minutes"}


def _prepare(spark: SparkSession) -> None:
    ensure_utc(spark)
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, None) or "HDFSBacked" in spark.conf.get(key):
        spark.conf.set(key, SESSION_CONF[key])


COMPACT = "spark.sql.streaming.stateStore.rocksdb.compactOnCommit"
DATE_COL = {"event_time": "event_date", "window_start": "window_date"}


def with_date(df: DataFrame, ts_col: str) -> DataFrame:
    """Add the date partition column derived from ``ts_col`` (UTC)."""
    return df.withColumn(DATE_COL[ts_col], F.to_date(ts_col))


@contextlib.contextmanager
def _start_conf(spark: SparkSession, partitions: int | None = None, empty_batches: bool | None = None,
                compacted: bool = False):
    """Settings of the one query started inside; the session's own come back afterwards.

    A query copies the session conf when it starts. ``partitions``: shuffle width, pinned
    by the checkpoint of a stateful query. ``empty_batches`` (K4): without them there are
    fewer empty files, but closable windows wait for the next input. ``compacted``: the state
    is compacted with each commit, for queries that scan it by key prefix: a scan otherwise
    passes over every key removed since, to the next one that is left.
    """
    wanted = {}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    if empty_batches is not None:
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = str(empty_batches).lower()
    if compacted:
        wanted[COMPACT] = "true"
    old = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _sink(df: DataFrame, path: str, name: str | None, trigger: dict, fmt: str,
          partition_col: str | None = None, output_partitions: int | None = None) -> StreamingQuery:
    if output_partitions:
        # K5 without pinning state width: a shuffle of the (small) output rows
        # bounds files per micro-batch; coalesce would instead collapse the
        # stateful stage itself onto fewer tasks
        df = df.repartition(output_partitions)
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", f"{path}/_checkpoint").trigger(**trigger))
    if partition_col:
        # date folders let batch readers prune by day instead of scanning the table
        w = w.partitionBy(partition_col)
    if name:
        w = w.queryName(name)
    return w.start(path)


def start_bronze(spark: SparkSession, messages: DataFrame, out_path: str, name: str,
                 trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet",
                 empty_batches: bool | None = None,
                 partition_by_date: bool = False) -> StreamingQuery:
    """Messages -> bronze table (stateless, no shuffle)."""
    _prepare(spark)
    bronze = decode(messages)
    with _start_conf(spark, None, empty_batches):
        if partition_by_date:
            return _sink(with_date(bronze, "event_time"), out_path, name, trigger, fmt, "event_date")
        return _sink(bronze, out_path, name, trigger, fmt)


def _bronze_schema(dated: bool) -> T.StructType:
    if not dated:
        return BRONZE_SCHEMA
    return T.StructType(BRONZE_SCHEMA.fields + [T.StructField("event_date", T.DateType())])


def start_silver(spark: SparkSession, in_path: str, out_path: str, name: str,
                 trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet",
                 delay: str = SILVER_WATERMARK, unbounded: bool = False,
                 empty_batches: bool | None = None,
                 max_files_per_trigger: int | None = None,
                 partition_by_date: bool = False,
                 state_partitions: int | None = None,
                 precombine_copies: bool = False,
                 output_partitions: int | None = None) -> StreamingQuery:
    """Bronze table -> silver table: watermark, validation, dedup on event_id.

    Rows and rejects per rule are observed (``rules``) and come with each batch's progress.
    ``partition_by_date``: input and output are partitioned by ``event_date``.
    ``state_partitions``: dedup state width of a new checkpoint (default: the
    session's shuffle partitions)."""
    _prepare(spark)
    src = read_table_stream(spark, in_path, _bronze_schema(partition_by_date), fmt,
                            max_files_per_trigger)
    with _start_conf(spark, state_partitions, empty_batches):
        return _sink(to_silver(observe_rules(src), delay, unbounded, precombine_copies=precombine_copies),
                     out_path, name, trigger, fmt, "event_date" if partition_by_date else None, output_partitions)


def start_gold(spark: SparkSession, in_path: str, out_path: str, name: str, kind: str,
               trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet",
               window: str = GOLD_WINDOW, delay: str = GOLD_WATERMARK,
               empty_batches: bool | None = None,
               max_files_per_trigger: int | None = None,
               partition_by_date: bool = False,
               output_partitions: int | None = None,
               state_partitions: int | None = None,
               distinct: str = "approx") -> StreamingQuery:
    """Silver table -> gold table; a window is emitted once the watermark passes its end.

    ``distinct``: ``approx`` (HyperLogLog++, as the reference) or ``exact``
    (two chained windowed aggregations: per user, then per product).

    ``partition_by_date``: silver is read with its ``event_date`` partitions and
    gold is written partitioned by ``window_date``."""
    _prepare(spark)
    src = read_table_stream(spark, in_path, _bronze_schema(partition_by_date), fmt,
                            max_files_per_trigger).withWatermark("event_time", delay)
    gold = (user_metrics(src, window, distinct) if kind == "user"
            else order_metrics(src, window, distinct))
    with _start_conf(spark, state_partitions, empty_batches):
        if partition_by_date:
            return _sink(with_date(gold, "window_start"), out_path, name, trigger, fmt,
                         "window_date", output_partitions)
        return _sink(gold, out_path, name, trigger, fmt, output_partitions=output_partitions)


def start_silver_gold(spark: SparkSession, in_path: str, out_path: str, name: str, kind: str,
                      trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet",
                      window: str = GOLD_WINDOW, delay: str = GOLD_WATERMARK,
                      empty_batches: bool | None = None,
                      max_files_per_trigger: int | None = None,
                      state_partitions: int | None = None,
                      distinct: str = "approx") -> StreamingQuery:
    """Bronze table -> gold table in one query: validation, bounded dedup and the
    windowed aggregate share one watermark (``delay``), so no silver table and
    no second checkpoint are needed."""
    _prepare(spark)
    src = read_table_stream(spark, in_path, BRONZE_SCHEMA, fmt, max_files_per_trigger)
    silver = to_silver(src, delay)
    gold = (user_metrics(silver, window, distinct) if kind == "user"
            else order_metrics(silver, window, distinct))
    with _start_conf(spark, state_partitions, empty_batches):
        return _sink(gold, out_path, name, trigger, fmt)


def start_metric_partials(spark: SparkSession, in_path: str, out_path: str, name: str | None, kind: str,
                          trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet", window: str = GOLD_WINDOW,
                          delay: str = GOLD_WATERMARK, max_files_per_trigger: int | None = None,
                          state_partitions: int | None = None) -> StreamingQuery:
    """Silver table -> table of mergeable metrics, from which longer windows are rolled up."""
    _prepare(spark)
    src = read_table_stream(spark, in_path, BRONZE_SCHEMA, fmt, max_files_per_trigger)
    with _start_conf(spark, state_partitions):
        return _sink(metric_partials(src.withWatermark("event_time", delay), kind, window), out_path, name, trigger, fmt)


def start_lag_partials(spark: SparkSession, in_path: str, out_path: str, name: str | None,
                       trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet", window: str = "1 hour",
                       delay: str = GOLD_WATERMARK, max_files_per_trigger: int | None = None,
                       state_partitions: int | None = None) -> StreamingQuery:
    """Silver table -> table of ingest lag per topic and window as quantile sketches (R3 as a stream)."""
    _prepare(spark)
    src = read_table_stream(spark, in_path, BRONZE_SCHEMA, fmt, max_files_per_trigger)
    with _start_conf(spark, state_partitions):
        return _sink(lag_partials(src.withWatermark("producer_time", delay), window), out_path, name, trigger, fmt)


def start_validated(spark: SparkSession, in_path: str, out_path: str, name: str | None,
                    trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Bronze table -> its valid rows and its rejects, side by side under one batch id."""
    _prepare(spark)
    return start_split(read_table_stream(spark, in_path, BRONZE_SCHEMA, fmt, max_files_per_trigger), out_path, name,
                       trigger)


def start_sessions(spark: SparkSession, in_paths: Sequence[str], out_path: str, name: str | None,
                   trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet", by: str = "category",
                   gap: str = "30 minutes", delay: str = GOLD_WATERMARK, max_files_per_trigger: int | None = None,
                   state_partitions: int | None = None) -> StreamingQuery:
    """Silver tables -> table of closed sessions with their stages (R1 as a stream).

    Each table has its own watermark, the slowest decides."""
    _prepare(spark)
    events = [read_table_stream(spark, path, BRONZE_SCHEMA, fmt, max_files_per_trigger).withWatermark("event_time", delay)
              for path in in_paths]
    joined = events[0]
    for more in events[1:]:
        joined = joined.unionByName(more)
    with _start_conf(spark, state_partitions, compacted=True):
        return _sink(session_units(joined, by, gap), out_path, name, trigger, fmt)


def start_carts(spark: SparkSession, in_paths: Sequence[str], out_path: str, name: str | None,
                trigger: dict = PRODUCTION_TRIGGER, fmt: str = "parquet",
                delay: str = GOLD_WATERMARK, abandon_after: str = "1 hour",
                max_files_per_trigger: int | None = None,
                state_partitions: int | None = None) -> StreamingQuery:
    """Silver tables -> table of abandoned carts (R2 as a stream)."""
    _prepare(spark)
    events = [read_table_stream(spark, path, BRONZE_SCHEMA, fmt, max_files_per_trigger) for path in in_paths]
    with _start_conf(spark, state_partitions):
        return _sink(abandoned_carts(events, delay, abandon_after), out_path, name, trigger, fmt)


def start_many(starters: Sequence) -> list[StreamingQuery]:
    """Start one query per (source, target) spec; stop the started ones if a later start fails."""
    started: list[StreamingQuery] = []
    try:
        for s in starters:
            started.append(s())
    except Exception:
        for q in started:
            q.stop()
        raise
    return started


# ---------------------------------------------------------------------------
# availableNow run of the whole chain over the test data (registered queries)
# ---------------------------------------------------------------------------


#: messages a file of a slice holds, about
FILE_ROWS = 250_000


def stage_messages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the adapter's messages as one folder per topic (topic=<name>)."""
    raw_messages(spark, sf_dir).write.mode("overwrite").partitionBy("topic").parquet(path)


def stage_slices(spark: SparkSession, sf_dir: str, path: str, slices: int) -> Iterator[int]:
    """Add the messages of one stretch of broker time after the other to the folders of their topics.

    Yields after each slice, with the number of files that a topic gained at most: they
    grow in number with the messages, not in size, so that tasks read and write alike.
    """
    messages = stored(spark, raw_messages(spark, sf_dir), "sliced-messages")
    at = F.unix_micros("timestamp")
    low, high, rows = messages.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    width = 0 if low is None else (high - low) // slices + 1
    files = 1 + rows // (slices * FILE_ROWS)
    since = at - F.lit(low or 0)
    for k in range(slices):
        (messages.where((since >= k * width) & (since < (k + 1) * width)).coalesce(files)
         .write.mode("append").partitionBy("topic").parquet(path))
        yield files


#: micro-batches of each layer in the registered runs
SLICES = 4
SHORT = {USER_TOPIC: "user", ORDER_TOPIC: "order"}


def run_chain(spark: SparkSession, sf_dir: str, base: str,
              trigger: dict | None = None, partition_by_date: bool = False,
              distinct: str = "approx", topics: Sequence[str] = TOPICS, gold: bool = True,
              metrics: MetricsTable | None = None, slices: int | None = None) -> dict[str, str]:
    """Stage the messages, then run bronze, silver and (unless ``gold`` is off) gold of ``topics``.

    ``metrics`` gets what the silver jobs did. ``slices``: the messages arrive in that many
    stretches of broker time, and every layer is started for each and works through it in a
    micro-batch; without, the backlog is one."""
    trigger = trigger or {"availableNow": True}
    dated = partition_by_date
    # state width for these new checkpoints: one partition per core
    width = spark.sparkContext.defaultParallelism
    paths = {"raw": f"{base}/raw"}
    for s in SHORT.values():
        paths |= {f"{layer}_{s}": f"{base}/{layer}/{s}" for layer in ("bronze", "silver", "gold")}

    def start(files: int | None) -> None:
        supervise(start_many([
            (lambda t=t: start_bronze(spark, message_file_stream(spark, f"{paths['raw']}/topic={t}", t, files),
                                      paths[f"bronze_{SHORT[t]}"], f"bronze_{SHORT[t]}", trigger,
                                      partition_by_date=dated))
            for t in topics]), poll_seconds=1.0)
        if metrics:
            metrics.attach()
        # no bound on the files of bronze: its tasks may have split those of the slice
        silver = start_many([
            (lambda s=s: start_silver(spark, paths[f"bronze_{s}"], paths[f"silver_{s}"], f"silver_{s}",
                                      trigger, partition_by_date=dated, state_partitions=width,
                                      output_partitions=files))
            for s in map(SHORT.get, topics)])
        supervise(silver, poll_seconds=1.0)
        if metrics:
            metrics.detach(silver)
        if gold:
            supervise(start_many([
                (lambda s=s: start_gold(spark, paths[f"silver_{s}"], paths[f"gold_{s}"], f"gold_{s}", s,
                                        trigger, partition_by_date=dated, state_partitions=width,
                                        max_files_per_trigger=files, distinct=distinct))
                for s in map(SHORT.get, topics)]), poll_seconds=1.0)

    if slices:
        for files in stage_slices(spark, sf_dir, paths["raw"], slices):
            start(files)
    else:
        stage_messages(spark, sf_dir, paths["raw"])
        start(None)
    return paths


def _run_dir(spark: SparkSession, label: str) -> str:
    path = new_run_dir(spark, label)
    remove_at_exit(spark, path)
    return path


def _payloads(spark: SparkSession, *silver: str) -> DataFrame:
    first, *rest = [read_sink_table(spark, path, BRONZE_SCHEMA) for path in silver]
    for more in rest:
        first = first.unionByName(more)
    return first.select("topic", *PAYLOAD_COLS)


def run_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of both topics, streamed by an ``availableNow`` run."""
    paths = run_chain(spark, sf_dir, _run_dir(spark, "stream"), gold=False, slices=SLICES)
    return _payloads(spark, paths["silver_user"], paths["silver_order"])


def run_gold(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Gold of one topic, streamed by an ``availableNow`` run.

    With exact distinct users, so that it compares row for row with the batch
    definition (the approximate form is the job default)."""
    paths = run_chain(spark, sf_dir, _run_dir(spark, "stream"), distinct="exact", topics=[topic], slices=SLICES)
    return read_sink_table(spark, paths[f"gold_{SHORT[topic]}"],
                           USER_METRICS_SCHEMA if topic == USER_TOPIC else ORDER_METRICS_SCHEMA)


#: messages of one id in so many are held back, if sent an hour or more before half time
HELD_MOD, HELD_REM = 97, 1
#: bytes of a row group of their files: a batch of few files is read by as many tasks as there are cores
ROW_GROUP = 8 << 20


def _restarted(spark: SparkSession, sf_dir: str, files_per_trigger: int = 4,
               then: Callable[[str], None] | None = None) -> str:
    """Bronze and silver of streams that are stopped and resumed from their checkpoints.

    The messages come in three parts, in order of sending, and each part is one start of
    the bronze and silver jobs: the first half, the second half, and what was held back
    of the first, which is then behind the watermark and dropped (W6). ``then`` is called
    with the folder after each part.
    """
    base = _run_dir(spark, "restarts")
    raw = f"{base}/raw"
    sent = F.unix_micros("timestamp") - 1_000_000 * (F.expr("offset div 2") % 5 + F.col("offset") % 2)
    messages = stored(spark, raw_messages(spark, sf_dir).withColumn("sent", sent), "restart-messages")
    low, high = messages.agg(F.min("sent"), F.max("sent")).first()
    half = 0 if low is None else low + (high - low) // 2
    held = (F.expr("offset div 2") % HELD_MOD == HELD_REM) & (F.col("sent") < half - 3_600_000_000)
    width = spark.sparkContext.defaultParallelism
    once = {"availableNow": True}
    for part in (~held & (F.col("sent") < half), F.col("sent") >= half, held):
        (messages.where(part).drop("sent").write.mode("append").option("parquet.block.size", ROW_GROUP)
         .partitionBy("topic").parquet(raw))
        supervise(start_many([
            (lambda t=t, s=s: start_bronze(
                spark, message_file_stream(spark, f"{raw}/topic={t}", t, files_per_trigger),
                f"{base}/bronze/{s}", f"bronze_{s}", once)) for t, s in SHORT.items()]), poll_seconds=1.0)
        supervise(start_many([
            (lambda s=s: start_silver(spark, f"{base}/bronze/{s}", f"{base}/silver/{s}", f"silver_{s}", once,
                                      state_partitions=width)) for s in SHORT.values()]), poll_seconds=1.0)
        if then:
            then(base)
    return base


def run_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of both topics after three starts."""
    base = _restarted(spark, sf_dir)
    return _payloads(spark, *[f"{base}/silver/{s}" for s in SHORT.values()])


def run_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carts abandoned in the silver of both topics, streamed in as many starts as silver."""
    width = spark.sparkContext.defaultParallelism

    def carts(base: str) -> None:
        supervise([start_carts(spark, [f"{base}/silver/{s}" for s in SHORT.values()], f"{base}/carts", "carts",
                               {"availableNow": True}, state_partitions=width)], poll_seconds=1.0)
    return read_sink_table(spark, f"{_restarted(spark, sf_dir, then=carts)}/carts", CART_SCHEMA)


def run_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel per category of the closed sessions, streamed in as many starts as silver."""
    width = spark.sparkContext.defaultParallelism

    def sessions(base: str) -> None:
        supervise([start_sessions(spark, [f"{base}/silver/{s}" for s in SHORT.values()], f"{base}/sessions", "sessions",
                                  {"availableNow": True}, state_partitions=width)], poll_seconds=1.0)
    base = _restarted(spark, sf_dir, then=sessions)
    return funnel_of(spark.read.parquet(f"{base}/sessions"))


def run_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export of the user metrics of a stream, some of whose rows come hours late."""
    width, once = spark.sparkContext.defaultParallelism, {"availableNow": True}
    s = SHORT[USER_TOPIC]

    def export(base: str) -> None:
        supervise(start_many([
            lambda: start_gold(spark, f"{base}/silver/{s}", f"{base}/gold/{s}", f"gold_{s}", s, once,
                               state_partitions=width, distinct="exact"),
            lambda: start_late(spark, f"{base}/bronze/{s}", f"{base}/late/{s}", f"late_{s}", s, once,
                               distinct="exact")]), poll_seconds=1.0)
        export_corrected(spark, f"{base}/gold/{s}", f"{base}/late/{s}", f"{base}/export/{s}", USER_METRICS_SCHEMA,
                         MERGE_KEYS, USER_METRICS_UPDATE)
    base = _restarted(spark, sf_dir, then=export)
    return read_versioned(spark, f"{base}/export/{s}", USER_METRICS_SCHEMA)


def run_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of both topics, read by offsets over two starts.

    The first start begins partition 0 one segment later than the others and ends where the
    topics end then, at segment 13 of 20. Before the second, the rest arrives and the
    segments 13 and 14 expire unread; it goes on behind them from its checkpoint, though
    its options ask for the latest offsets. Batches hold a fifth of the offsets at most.
    """
    base = _run_dir(spark, "offsets")
    messages = stored(spark, raw_messages(spark, sf_dir), "offset-messages")
    top = (messages.agg(F.max("offset")).first()[0] or 0) + 1
    # a message may come twice, at an even offset and the next: segments hold whole pairs
    segment = 2 * max(1, top // 40)
    end = 13 * segment
    partitions = [r[0] for r in messages.select("partition").distinct().collect()]
    limit = max(1, top * max(1, len(partitions)) // 5)

    def read(starting: str) -> None:
        drain(start_many([
            (lambda t=t, s=s: start_bronze(
                spark, offset_stream(spark, f"{base}/raw/{s}", t, starting, max_offsets_per_trigger=limit,
                                     segment=segment),
                f"{base}/bronze/{s}", f"offsets_{s}", {"processingTime": "0 seconds"})) for t, s in SHORT.items()]))

    for arrived, starting in ((F.col("offset") < end, json.dumps({"0": segment})), (F.col("offset") >= end, "latest")):
        for t, s in SHORT.items():
            stage_segments(messages.where(arrived & (F.col("topic") == t)), f"{base}/raw/{s}", segment)
        for gone in (13, 14):
            for s in SHORT.values():
                for p in partitions:
                    remove_folder(spark, f"{base}/raw/{s}/partition={p}/segment={gone}")
        read(starting)
    first, second = [read_sink_table(spark, f"{base}/bronze/{s}", BRONZE_SCHEMA) for s in SHORT.values()]
    return first.unionByName(second).select(*BRONZE_COLS)


def run_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest lag per topic and day from streamed hourly sketches, its quantiles checked by rank."""
    paths = run_chain(spark, sf_dir, _run_dir(spark, "lag"), gold=False)
    width = spark.sparkContext.defaultParallelism
    out = {s: f"{paths['raw']}-lag/{s}" for s in SHORT.values()}
    supervise(start_many([
        (lambda s=s: start_lag_partials(spark, paths[f"silver_{s}"], out[s], f"lag_{s}", {"availableNow": True},
                                        state_partitions=width)) for s in SHORT.values()]), poll_seconds=1.0)
    hours, silver = [], []
    for s in SHORT.values():
        events = read_sink_table(spark, paths[f"silver_{s}"], BRONZE_SCHEMA)
        hours.append(read_sink_table(spark, out[s], lag_partials(events).schema))
        # the events of closed hours: those before the end of the last one written
        closed = hours[-1].select(F.max("window_end")).scalar()
        silver.append(events.where(F.col("producer_time") < closed))
    quantiles = stored(spark, lag_quantiles(lag_rolled_up(hours[0].unionByName(hours[1]), "1 day")), "lag-days")
    return rank_checked(quantiles, silver[0].unionByName(silver[1]), "1 day")


def run_reject_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows per topic and rule as the silver jobs reported them, batch by batch."""
    base = _run_dir(spark, "metrics")
    run_chain(spark, sf_dir, base, gold=False, metrics=MetricsTable(spark, f"{base}/metrics"), slices=SLICES)
    topic = F.when(F.col("query") == "silver_user", USER_TOPIC).otherwise(ORDER_TOPIC)
    rules = (read_metrics(spark, f"{base}/metrics").select(topic.alias("topic"), F.explode("counts").alias("rejected_rule", "n"))
             .where((F.col("rejected_rule") != "rows") & (F.col("n") > 0)))
    return rules.groupBy("topic", "rejected_rule").agg(F.sum("n").alias("rejected_rows"))


def run_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages as valid rows or rejects, from two starts, the last batch delivered twice."""
    base = _run_dir(spark, "validated")
    stage_messages(spark, sf_dir, f"{base}/raw")
    once = {"availableNow": True}
    supervise(start_many([
        (lambda t=t, s=s: start_bronze(spark, message_file_stream(spark, f"{base}/raw/topic={t}", t),
                                       f"{base}/bronze/{s}", f"bronze_{s}", once)) for t, s in SHORT.items()]), poll_seconds=1.0)
    out = {s: f"{base}/validated/{s}" for s in SHORT.values()}
    for _ in range(2):
        supervise(start_many([
            (lambda s=s: start_validated(spark, f"{base}/bronze/{s}", out[s], f"validated_{s}", once,
                                         max_files_per_trigger=4)) for s in SHORT.values()]), poll_seconds=1.0)
        for s in SHORT.values():  # as if the job had died before it noted its last batch as done
            last = read_split(spark, out[s], BRONZE_SCHEMA).agg(F.max("batch_id")).first()[0]
            remove_folder(spark, f"{out[s]}/_checkpoint/commits/{last}")
    first, second = [read_split(spark, out[s], BRONZE_SCHEMA) for s in SHORT.values()]
    return first.unionByName(second).select("topic", *PAYLOAD_COLS, "rejected_rule")
