"""Late rows corrected instead of lost.

Silver and gold drop rows behind their watermark. ``start_late`` reads bronze beside them:
a valid row whose window had ended before the watermark of the batches so far is late, and
the windows that late rows touch are computed again, whole, from bronze: the batch
definition of silver and gold, for these products and windows only, read from the days
they lie on. The corrected rows of a batch are kept as ``path/run=<query id>/batch_id=<n>``.
``export_corrected`` merges gold and, after it, the corrections (the last one of a key
wins), so an export that comes later does not bring the old numbers back.

The watermark is the newest event time of the earlier batches, noted with each batch,
less ``delay``. It must not be behind that of silver and gold: run it with batches no
larger than theirs and a delay no longer than theirs. Rows called late too early cost an
extra computation and nothing else. A replayed batch overwrites its own folder and note.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import order_metrics, user_metrics
from ..operators.validate import validate
from ..plans.batch import to_silver
from ..schemas import BRONZE_SCHEMA, GOLD_WATERMARK, GOLD_WINDOW
from ..session import stored
from ..sources.tables import read_sink_table, read_table_stream
from .sinks import filesystem, merge_into_versioned, query_id, with_retry, write_lines

NOTE = "run string, batch_id long, newest long, at long"


def _micros(spark: SparkSession, length: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {length})")).first()[0]


def _newest_before(spark: SparkSession, path: str, run: str, batch_id: int) -> int | None:
    """Newest event time (microseconds) of the run's earlier batches."""
    fs, folder = filesystem(spark, f"{path}/_notes")
    if not fs.exists(folder):
        return None
    notes = spark.read.schema(NOTE).json(f"{path}/_notes")
    return notes.where((F.col("run") == run) & (F.col("batch_id") < batch_id)).agg(F.max("newest")).first()[0]


def corrected_windows(events: DataFrame, touched: DataFrame, kind: str, window: str, distinct: str) -> DataFrame:
    """Gold rows of the (product_id, window_start) in ``touched``, from all of bronze ``events``."""
    start = F.window("event_time", window).start
    days = touched.agg(F.min("window_start").alias("low"), F.max("window_start").alias("high")).first()
    near = events.where((F.col("event_time") >= F.lit(days.low))
                        & (F.col("event_time") < F.lit(days.high) + F.expr(f"INTERVAL {window}")))
    mine = near.withColumn("_start", start).join(
        touched.select("product_id", F.col("window_start").alias("_start")).distinct(), ["product_id", "_start"], "left_semi")
    silver = to_silver(mine.select(*events.columns))
    return (user_metrics if kind == "user" else order_metrics)(silver, window, distinct)


def late_sink(in_path: str, path: str, checkpoint: str, kind: str, window: str, delay: str, distinct: str):
    """``foreachBatch`` function: the corrected windows of a batch's late rows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = query_id(spark, checkpoint)
        valid = stored(spark, validate(batch).select("product_id", "event_time"), "late-batch")
        newest = valid.agg(F.max(F.unix_micros("event_time"))).first()[0]
        before = _newest_before(spark, path, name, batch_id)
        if before is not None:
            bounds = F.window("event_time", window)
            late = (valid.select("product_id", bounds.start.alias("window_start"), bounds.end.alias("window_end"))
                    .where(F.unix_micros("window_end") <= before - _micros(spark, delay))
                    .select("product_id", "window_start").distinct())
            late = stored(spark, late, "late-windows")
            if not late.isEmpty():
                (corrected_windows(read_sink_table(spark, in_path, BRONZE_SCHEMA), late, kind, window, distinct)
                 .write.mode("overwrite").parquet(f"{path}/run={name}/batch_id={batch_id}"))
        if newest is not None:
            write_lines(spark, f"{path}/_notes", f"{uuid.uuid4().hex}.json",
                        [{"run": name, "batch_id": batch_id, "newest": newest, "at": time.time_ns() // 1_000_000}])
    return run


def start_late(spark: SparkSession, in_path: str, path: str, name: str | None, kind: str, trigger: dict,
               window: str = GOLD_WINDOW, delay: str = GOLD_WATERMARK, distinct: str = "approx",
               max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Bronze table -> corrections of the closed windows that late rows touch."""
    checkpoint = f"{path}/_checkpoint"
    bronze = read_table_stream(spark, in_path, BRONZE_SCHEMA, max_files_per_trigger=max_files_per_trigger)
    writer = (bronze.writeStream.foreachBatch(late_sink(in_path, path, checkpoint, kind, window, delay, distinct))
              .option("checkpointLocation", checkpoint).trigger(**trigger))
    return (writer.queryName(name) if name else writer).start()


def read_corrections(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last correction of each key, from finished batches."""
    pattern = f"{path}/run=*/batch_id=*/_SUCCESS"
    fs, where = filesystem(spark, pattern)
    done = [st.getPath().getParent().toString() for st in fs.globStatus(where) or []]
    if not done:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    begun = spark.read.schema(NOTE).json(f"{path}/_notes").groupBy("run").agg(F.min("at").alias("begun"))
    rows = (spark.read.schema(whole).option("basePath", path).parquet(*done).join(begun, "run")
            .withColumn("turn", F.struct("begun", "batch_id")))
    last = rows.groupBy(*keys).agg(F.max("turn").alias("last"))
    return rows.join(last, list(keys)).where("turn = last").select(*schema.names)


def export_corrected(spark: SparkSession, gold_path: str, late_path: str, target_path: str, schema: T.StructType,
                     keys: Sequence[str], update_cols: Sequence[str]) -> dict:
    """Merge gold, with the corrections in place of the windows they correct, into the keyed target."""
    corrections = stored(spark, read_corrections(spark, late_path, schema, keys), "corrections")
    gold = read_sink_table(spark, gold_path, schema).join(corrections.select(*keys).distinct(), list(keys), "left_anti")
    rows = gold.select(*schema.names).unionByName(corrections)
    return with_retry(lambda: merge_into_versioned(spark, target_path, rows, schema, keys, update_cols, 0, writer=None))
