"""Message sources with the Kafka contract.

``kafka_stream`` is the production reader (needs the spark-sql-kafka package
on the classpath; not exercised offline). ``message_file_stream`` reads staged
messages from a file table with the same columns, which is how tests drive
the jobs without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MESSAGE_SCHEMA


def kafka_stream(spark: SparkSession, topic: str, bootstrap_servers: str,
                 starting_offsets: str = "earliest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None, **options: str) -> DataFrame:
    """S1 subscribe one topic; S2 start position (first start only, then the
    checkpoint wins); S3 tolerate expired offsets; S4 optional rate limit."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def message_file_stream(spark: SparkSession, path: str, topic: str | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages staged as parquet. With ``topic`` the folder holds one topic whose
    name is not stored in the files (``partitionBy("topic")`` layout)."""
    schema = MESSAGE_SCHEMA if topic is None else \
        type(MESSAGE_SCHEMA)([f for f in MESSAGE_SCHEMA.fields if f.name != "topic"])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    if topic is not None:
        df = df.withColumn("topic", F.lit(topic))
    return df.select(*[f.name for f in MESSAGE_SCHEMA.fields])


def write_kafka(df: DataFrame, bootstrap_servers: str, checkpoint: str | None = None):
    """Publish encoded rows (key, value, topic) to Kafka: batch write, or a
    streaming query when ``df`` is streaming (then ``checkpoint`` is required)."""
    if df.isStreaming:
        return (df.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers)
                .option("checkpointLocation", checkpoint).start())
    df.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()
    return None
