"""Distributed exact quantiles equal Spark's single-task ``percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_matches_percentile_including_hot_group(spark, partitions):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500)) / 8) for _ in range(3000)]          # a third+ of rows
    rows += [(f"g{i % 40}", rnd.gauss(10, 3)) for i in range(2000)]
    rows += [("single", 4.0), ("pair", 1.0), ("pair", 2.0), ("nulls", None), ("nulls", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0, "p33": 1 / 3}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, partitions).collect()}
    ref = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()]).collect()
    assert len(got) == len(ref)
    for r in ref:
        for n in probs:
            assert got[r.g][n] == pytest.approx(r[n], rel=1e-12, abs=1e-12), (r.g, n)


def test_plan_has_no_single_group_gather(spark):
    import contextlib
    import io
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        exact_quantiles(df, ["g"], "v", {"p50": 0.5}).explain()
    plan = buf.getvalue()
    assert "percentile" not in plan and "_pid" in plan and "_run" in plan


def test_right_without_exchange_reuse_on_many_distinct_values(spark):
    """The pieces are numbered once, whether or not Spark shares their exchange."""
    df = spark.range(300_000).selectExpr("id % 3 AS g", "cast((id * 7919) % 1000003 AS double) AS v")
    want = {r.g: r.p for r in df.groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("p")).collect()}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r.g: r.p for r in exact_quantiles(df, ["g"], "v", {"p": 0.5}, partitions=8).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert got == want
