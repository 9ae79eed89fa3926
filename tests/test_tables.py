"""Folder scans and table shapes."""

import os

from pyspark.sql import types as T

from tidemark.sources.tables import read_folder, read_sink_table, table_shape

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_recursive_part_files_only(spark, workdir):
    root = f"{workdir}/gold"
    spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA).write.parquet(f"{root}/v1")
    spark.createDataFrame([(3, "z")], SCHEMA).write.parquet(f"{root}/nested/v2")
    # metadata folders and stray files are not data
    spark.createDataFrame([(99, "ckpt")], SCHEMA).write.parquet(f"{root}/_checkpoint/state")
    with open(f"{root}/notes.parquet", "w") as f:
        f.write("not a data file")
    df = read_folder(spark, root, SCHEMA)
    assert sorted(r.a for r in df.collect()) == [1, 2, 3]


def test_missing_or_empty_folder_is_empty_frame(spark, workdir):
    assert read_folder(spark, f"{workdir}/nope", SCHEMA).count() == 0
    os.makedirs(f"{workdir}/empty")
    assert read_folder(spark, f"{workdir}/empty", SCHEMA).count() == 0
    assert read_sink_table(spark, f"{workdir}/nope", SCHEMA).count() == 0


def test_table_shape(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA)
    b = spark.range(5)
    got = {r.table_name: (r.row_count, r.col_count) for r in table_shape({"a": a, "b": b}).collect()}
    assert got == {"a": (2, 2), "b": (5, 1)}
