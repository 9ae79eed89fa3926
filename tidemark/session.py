"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC event time, adaptive execution with skew
# splitting and partition coalescing, RocksDB state for streaming operators.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only from measured sizes: no static broadcast from file-size
    # estimates (compressed bytes are not a bound); AQE converts a join once the
    # actual shuffle size of a side is known to be small
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # upload only the changed state per micro-batch instead of full snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event-time semantics of every job assume a UTC session time zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (HDFS/S3/...). Only when it
    is unset (local tests) a local folder is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(HDFS, S3, ...); a driver-local folder is not reachable by executors")
        d = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one job run."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{label}-{uuid.uuid4().hex[:12]}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the application delete ``path`` (a written run folder) when it ends.

    Intermediate tables are only of use to the application that wrote them; the
    file system they live on removes them when the driver's JVM shuts down.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).deleteOnExit(target)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage without ``localCheckpoint``: a lost executor makes Spark read
    the table again instead of recomputing what led to it. The folder goes when
    the application ends.
    """
    path = new_run_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
