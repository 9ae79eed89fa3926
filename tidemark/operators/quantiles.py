"""Exact quantiles per group without gathering a group into one task.

Same definition as Spark's ``percentile`` (and DuckDB's ``quantile_cont``):
with n values sorted ascending and h = (n - 1) * p, the result is
v[floor(h)] + (h - floor(h)) * (v[ceil(h)] - v[floor(h)]).

Plan (every step is bounded by a partition, never by a group):
  1. count rows per (group, value)            - partial aggregation
  2. range-partition those counts by (group, value): a hot group's values are
     spread over many partitions, each holding a contiguous value range
  3. running count inside each (partition, group) piece
  4. per piece total; offset = totals of the same group's earlier partitions
     (a window over at most #partitions rows per group)
  5. a value covers ranks [offset + running - count, offset + running); keep
     the values covering the two ranks around each h and interpolate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Mapping[str, float], partitions: int | None = None) -> DataFrame:
    """One row per group: ``group_cols`` + one column per entry of ``probs``
    (name -> probability in [0, 1]). Null values are ignored."""
    g = list(group_cols)
    v = value_col
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.where(F.col(v).isNotNull()).groupBy(*g, v)
              .agg(F.count(F.lit(1)).alias("_n")))
    # written once: both uses below must see the same range bounds and piece numbers
    pieces = stored(df.sparkSession, (counts.repartitionByRange(n_parts, *g, v)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_run", F.sum("_n").over(
                  Window.partitionBy("_pid", *g).orderBy(v)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)))), "quantile-pieces")
    totals = pieces.groupBy("_pid", *g).agg(F.max("_run").alias("_t"))
    per_group = Window.partitionBy(*g)
    offsets = totals.select(
        "_pid", *g,
        F.coalesce(F.sum("_t").over(per_group.orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_t").over(per_group).alias("_total"))
    # offsets hold at most (#partitions x #groups) rows; joined back by piece
    # (AQE broadcasts it from its measured shuffle size when small)
    located = pieces.join(offsets, [*g, "_pid"], "inner").select(
        *g, v, "_total",
        (F.col("_off") + F.col("_run") - F.col("_n")).alias("_first"),
        (F.col("_off") + F.col("_run")).alias("_end"))

    def covers(rank):
        return (F.col("_first") <= rank) & (rank < F.col("_end"))

    picks, outs = [], []
    for name, p in probs.items():
        h = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        picks += [F.max(F.when(covers(lo), F.col(v))).alias(f"{name}__lo"),
                  F.max(F.when(covers(hi), F.col(v))).alias(f"{name}__hi"),
                  F.max(h - lo).alias(f"{name}__frac")]
        outs.append(name)
    needed = F.lit(False)
    for p in probs.values():
        h = (F.col("_total") - 1) * F.lit(float(p))
        needed = needed | covers(F.floor(h)) | covers(F.ceil(h))
    chosen = located.where(needed).groupBy(*g).agg(*picks)
    return chosen.select(*g, *[
        (F.col(f"{n}__lo") + F.col(f"{n}__frac") * (F.col(f"{n}__hi") - F.col(f"{n}__lo"))).alias(n)
        for n in outs])
