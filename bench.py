"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1). Each
query is fully materialised through the ``noop`` sink (no collect): one
warm-up, then the median of ``$BENCH_REPEATS`` (default 3) runs. The whole
streaming chain (bronze -> silver -> gold, availableNow, file tables) is timed
once per repeat on a fresh folder. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = (
    "bronze_decode", "silver_valid", "silver_dedup", "silver_rejects",
    "user_metrics_1m", "user_metrics_1h", "user_metrics_1d",
    "order_metrics_1m", "order_metrics_1h", "order_metrics_1d",
    "user_metrics_approx", "order_metrics_approx",
    "merge_user_metrics", "merge_order_metrics", "export_versioned",
    "session_funnel", "open_carts", "ingest_lag", "encode_and_route", "conform_columns",
    "table_shape",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from tidemark.session import build_session, new_run_dir
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tidemark-bench",
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "8g")})
    from tidemark.plans.catalog import registry
    from tidemark.streaming.jobs import run_chain
    q = registry()

    def run(name):
        # the clock covers building the plan too: some queries do eager work
        # there (silver written once to the shared folder, scalar cut-offs)
        t = time.perf_counter()
        q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    def chain():
        t = time.perf_counter()
        run_chain(spark, sf_dir, new_run_dir(spark, "bench-stream"))
        return time.perf_counter() - t

    timings, errors = {}, {}
    for name, fn in [*((n, lambda n=n: run(n)) for n in HEADLINE), ("stream_chain", chain)]:
        try:
            fn()  # warm-up
            timings[name] = round(statistics.median(fn() for _ in range(repeats)), 3)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_query_medians",
        "value": round(sum(v for v in timings.values() if v is not None), 3), "unit": "sec",
        "queries": timings, "sf": float(m.group(1)) if m else None, "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
