"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"_{name}"
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """SQL settings for the jobs run inside the block (dots written as ``__``)."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables made by ``stored`` that no later job reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for each in tables:
        for folder in {f.rsplit("/", 1)[0] for f in each.inputFiles()}:
            target = hadoop(folder)
            target.getFileSystem(conf).delete(target, True)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(spark: SparkSession, edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected ``edges`` (two long columns).

    Alternating large-star and small-star rounds: every node hands its larger
    neighbours to the smallest label it knows, until each node hangs on the
    smallest node of its component. A round is a few partial aggregations and
    equi-joins over the remaining edges, written to the shared folder in place of the
    round before; nothing but a row count and a checksum comes to the driver.

    Returns (node, root) for each node on an edge; ``root`` is the smallest node
    of the component. No edges give no rows; self-loops and repeats are ignored.
    """
    a, b = edges.columns
    now = stored(spark, edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where("u != v").distinct(), label)
    seen = _fingerprint(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(spark, large, label)
        forget(spark, now)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = stored(spark, small, label)
        forget(spark, large)
        after = _fingerprint(now)
        if after == seen:
            break
        seen = after
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
