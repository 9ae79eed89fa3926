"""Command-line entry points, one per job:

    python -m tidemark bronze --root /shared/lake --bootstrap kafka:9092
    python -m tidemark bronze --root /shared/lake --messages /shared/archive   # replay files
    python -m tidemark silver --root /shared/lake
    python -m tidemark gold   --root /shared/lake
    python -m tidemark export --root /shared/lake            # merge gold into keyed tables
    python -m tidemark explain --query user_metrics_1h --sf-dir /root/testdata/sf0.1

Table folders under ``--root``: ``bronze/<topic>``, ``silver/<topic>``,
``gold/user_metrics``, ``gold/order_metrics``, ``export/<table>``; every command adds what its
batches did to ``metrics``. Each streaming command runs its two queries under ``supervise``: if one fails, the
other is stopped and the process exits non-zero, so a restart policy applies.
"""

from __future__ import annotations

import argparse
import json
import sys

from .schemas import (MERGE_KEYS, ORDER_METRICS_SCHEMA, ORDER_METRICS_UPDATE, ORDER_TOPIC, TOPICS,
                      USER_METRICS_SCHEMA, USER_METRICS_UPDATE, USER_TOPIC)

GOLD_OF = {USER_TOPIC: ("user", "user_metrics"), ORDER_TOPIC: ("order", "order_metrics")}


def _trigger(args) -> dict:
    return {"availableNow": True} if args.available_now else {"processingTime": args.trigger}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("job", choices=["bronze", "silver", "gold", "export", "explain"])
    p.add_argument("--root", help="shared folder holding all tables")
    p.add_argument("--query", help="explain: a registered query name")
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01", help="explain: test-data folder")
    p.add_argument("--mode", default="formatted", help="explain: simple, extended, formatted, cost")
    p.add_argument("--bootstrap", default="kafka:9092")
    p.add_argument("--messages", default=None,
                   help="bronze from staged message files (<dir>/topic=<name>/) instead of Kafka")
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    p.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="bound of a micro-batch read from files (message files, bronze, silver)")
    p.add_argument("--trigger", default="5 minutes")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--format", default="parquet", help="table format: parquet or delta")
    p.add_argument("--unbounded-dedup", action="store_true")
    p.add_argument("--precombine-copies", action="store_true",
                   help="silver: drop repeated copies per input partition before the dedup shuffle")
    p.add_argument("--no-empty-batches", action="store_true")
    p.add_argument("--window", default="1 minute")
    p.add_argument("--distinct", choices=["approx", "exact"], default="approx",
                   help="unique users/buyers: HyperLogLog++ or exact (two chained aggregations)")
    p.add_argument("--gold-files", type=int, default=None,
                   help="files per gold micro-batch (independent of the state partitions)")
    p.add_argument("--partition-by-date", action="store_true",
                   help="write bronze/silver by event_date and gold by window_date")
    p.add_argument("--poll-seconds", type=float, default=30.0)
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="state partitions of a new stateful job; pinned by its checkpoint")
    p.add_argument("--segments", default=None,
                   help="bronze from offset segments (<dir>/<topic>/) instead of Kafka")
    p.add_argument("--jdbc-url", default=None, help="export: also upsert into a database (its driver on the classpath)")
    p.add_argument("--jdbc-schema", default="public", help="export: schema of the database tables")
    p.add_argument("--jdbc-properties", default="{}", help="export: connection properties as JSON")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from .session import SESSION_CONF
    b = SparkSession.builder.appName(f"tidemark-{args.job}")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if args.shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    spark = b.getOrCreate()
    if args.job == "explain":
        from .plans.catalog import registry
        registry()[args.query](spark, args.sf_dir).explain(args.mode)
        return 0
    if not args.root:
        p.error("--root is required")
    if args.segments and args.available_now:
        p.error("--segments needs a processing-time trigger")
    root = args.root.rstrip("/")
    empty = False if args.no_empty_batches else None

    if args.job == "export":
        from .streaming.sinks import export_table
        from .streaming.metrics_table import MetricsTable
        from .streaming.sinks import jdbc_upsert
        out, metrics = {}, MetricsTable(spark, f"{root}/metrics")
        for name, schema, upd in (("user_metrics", USER_METRICS_SCHEMA, USER_METRICS_UPDATE),
                                  ("order_metrics", ORDER_METRICS_SCHEMA, ORDER_METRICS_UPDATE)):
            out[name] = export_table(spark, f"{root}/gold/{name}", f"{root}/export/{name}",
                                     schema, MERGE_KEYS, upd, fmt=args.format)
            metrics.append({"name": f"export_{name}", **out[name]})
            if args.jdbc_url:
                from .streaming.sinks import read_versioned
                jdbc_upsert(read_versioned(spark, f"{root}/export/{name}", schema), args.jdbc_url,
                            f"{args.jdbc_schema}.{name}", MERGE_KEYS, upd, json.loads(args.jdbc_properties))
        metrics.flush()
        print(json.dumps(out, default=str))
        return 0

    from .sources.kafka import kafka_stream, message_file_stream
    from .sources.offsets import offset_stream
    from .streaming.jobs import start_bronze, start_gold, start_many, start_silver
    from .streaming.metrics_table import MetricsTable
    from .streaming.supervise import supervise
    trig = _trigger(args)
    if args.job == "bronze":
        def source(t):
            if args.messages:
                return message_file_stream(spark, f"{args.messages.rstrip('/')}/topic={t}", t,
                                           args.max_files_per_trigger)
            if args.segments:
                return offset_stream(spark, f"{args.segments.rstrip('/')}/{t}", t, args.starting_offsets,
                                     max_offsets_per_trigger=args.max_offsets_per_trigger)
            return kafka_stream(spark, t, args.bootstrap, args.starting_offsets,
                                max_offsets_per_trigger=args.max_offsets_per_trigger)
        starters = [lambda t=t: start_bronze(
            spark, source(t), f"{root}/bronze/{t}", f"bronze_{t}", trig, args.format, empty,
            partition_by_date=args.partition_by_date) for t in TOPICS]
    elif args.job == "silver":
        starters = [lambda t=t: start_silver(
            spark, f"{root}/bronze/{t}", f"{root}/silver/{t}", f"silver_{t}", trig, args.format,
            unbounded=args.unbounded_dedup, empty_batches=empty,
            partition_by_date=args.partition_by_date,
            precombine_copies=args.precombine_copies,
            max_files_per_trigger=args.max_files_per_trigger) for t in TOPICS]
    else:
        starters = [lambda t=t: start_gold(
            spark, f"{root}/silver/{t}", f"{root}/gold/{GOLD_OF[t][1]}", f"gold_{GOLD_OF[t][1]}",
            GOLD_OF[t][0], trig, args.format, window=args.window, empty_batches=empty,
            partition_by_date=args.partition_by_date, output_partitions=args.gold_files,
            distinct=args.distinct, max_files_per_trigger=args.max_files_per_trigger) for t in TOPICS]

    def report(rows):
        print("[progress] " + " | ".join(f"{k}: {v} rows in last batch" for k, v in rows.items()),
              flush=True)
    metrics = MetricsTable(spark, f"{root}/metrics").attach()
    queries = []
    try:
        queries = start_many(starters)

        def polled(rows):
            report(rows)
            metrics.flush()
        supervise(queries, poll_seconds=args.poll_seconds, on_progress=polled, until_done=args.available_now)
    finally:
        metrics.detach(queries)
    return 0


if __name__ == "__main__":
    sys.exit(main())
