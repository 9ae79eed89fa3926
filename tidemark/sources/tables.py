"""Table scans: streaming table reads, folder scans, empty tolerance, shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of an append-only table written by a streaming sink."""
    r = spark.readStream.format(fmt)
    if fmt != "delta":
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_folder(spark: SparkSession, path: str, schema: T.StructType | None = None,
                fmt: str = "parquet") -> DataFrame:
    """S6 + S7 + U1: every data file under ``path`` as one DataFrame.

    Recursive, data files only (``part-*``); folders starting with ``_`` or
    ``.`` (``_checkpoint``, ``_spark_metadata``, ``_delta_log``) are hidden by
    Spark. A missing or empty folder yields an empty frame of ``schema``.
    """
    try:
        r = (spark.read.format(fmt).option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "part-*"))
        if schema is not None:
            r = r.schema(schema)
        return r.load(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_sink_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a streaming file-sink table through its commit log (``_spark_metadata``),
    so files of uncommitted micro-batches are never loaded (F8)."""
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, col_count) for named DataFrames, one job each,
    combined by union (counts are map-side partial aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count",
                       F.lit(len(df.columns)).alias("col_count"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
