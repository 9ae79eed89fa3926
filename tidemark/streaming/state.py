"""What the state of a streaming query holds, read from its checkpoint (K2, K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None,
               **options: str) -> DataFrame:
    """Key, value and partition of each state row after ``batch_id`` (default: the last one)."""
    reader = spark.read.format("statestore").option("operatorId", operator).options(**options)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator: its name, the width that the checkpoint pins, the batches kept."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.groupBy("operatorId", "operatorName").agg(
        F.max("numPartitions").alias("width"), F.min("minBatchId").alias("first_batch"),
        F.max("maxBatchId").alias("last_batch"))
