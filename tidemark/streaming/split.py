"""Valid rows and rejects of a stream from one pass (V1-V5).

Each micro-batch is written once, as ``path/run=<query id>/batch_id=<n>/outcome=<valid|
rejected>/``: both outputs belong to one batch id and appear together. A batch that Spark
delivers again overwrites its own folder, so a replay adds nothing; a stream that starts
over with a new checkpoint has a new query id and overwrites nothing of the old one. A
folder counts once its write has finished (``_SUCCESS``). Rejects carry the first rule
they break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import first_failed_rule
from .sinks import filesystem, query_id

VALID, REJECTED = "valid", "rejected"
RULE = "rejected_rule"


def split_sink(path: str, checkpoint: str, rules: Sequence[tuple[str, Column]] | None = None):
    """``foreachBatch`` function that writes both outputs of a batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = query_id(batch.sparkSession, checkpoint)
        (batch.withColumn(RULE, first_failed_rule(list(rules) if rules else None))
         .withColumn("outcome", F.when(F.col(RULE).isNull(), VALID).otherwise(REJECTED))
         .write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/run={run_id}/batch_id={batch_id}"))
    return run


def start_split(events: DataFrame, path: str, name: str | None, trigger: dict,
                rules: Sequence[tuple[str, Column]] | None = None) -> StreamingQuery:
    """Stream ``events`` into its valid and rejected rows; the checkpoint lies in the table (K2)."""
    checkpoint = f"{path}/_checkpoint"
    writer = (events.writeStream.foreachBatch(split_sink(path, checkpoint, rules))
              .option("checkpointLocation", checkpoint).trigger(**trigger))
    return (writer.queryName(name) if name else writer).start()


def read_split(spark: SparkSession, path: str, schema: T.StructType, outcome: str | None = None) -> DataFrame:
    """Rows of finished batches: those of ``outcome`` or all, with ``rejected_rule``, ``run`` and ``batch_id``."""
    fs, root = filesystem(spark, path)
    whole = T.StructType([*schema.fields, T.StructField(RULE, T.StringType()), T.StructField("run", T.StringType()),
                          T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())])
    found = fs.globStatus(filesystem(spark, f"{path}/run=*/batch_id=*/_SUCCESS")[1]) if fs.exists(root) else []
    done = [st.getPath().getParent().toString() for st in found or []]
    rows = (spark.read.schema(whole).option("basePath", path).parquet(*done) if done
            else spark.createDataFrame([], whole))
    if outcome:
        rows = rows.where(F.col("outcome") == outcome)
    return rows.drop("outcome")
