"""Measured broadcast decision of the dimension lookup."""

import contextlib
import io

from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join, payload_bytes


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_payload_bytes_is_exact(spark):
    dim = spark.createDataFrame([(1, "ab"), (2, None), (3, "xyz")], "k bigint, s string")
    assert payload_bytes(dim) == 3 * 8 + 2 + 0 + 3


def test_small_dimension_is_broadcast_large_is_shuffled(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).select(F.col("id").alias("dk"), F.lit("name").alias("name"))
    small = lookup_join(facts, dim, facts.k == dim.dk)
    assert "BroadcastHashJoin" in _plan(small)
    big = lookup_join(facts, dim, facts.k == dim.dk, max_broadcast_bytes=10)
    p = _plan(big)
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    assert sorted(tuple(r) for r in small.collect()) == sorted(tuple(r) for r in big.collect())


def test_hot_key_is_split_on_the_shuffle_path(spark):
    """Beyond the broadcast bound, a key holding a third of the facts is split by AQE."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        facts = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
            F.col("id"))
        dim = spark.range(97).select(F.col("id").alias("dk"), F.concat(F.lit("name"), F.col("id")).alias("name"))
        out = lookup_join(facts, dim, facts.k == dim.dk, max_broadcast_bytes=0)
        assert len(out.collect()) == n          # runs this plan, so its adaptive plan is final
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
