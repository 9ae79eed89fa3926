"""Keyed export sink (K6-K9): merge each micro-batch into a versioned table.

Layout of a table at ``path``::

    path/v=<n>.<try>/window_date=<d>/part-*.parquet   the rows of date d as of version n
    path/_log/<n>.json                    commit of version n, one line per date
    path/_staging/<id>                    the batch being merged, removed afterwards

A commit rewrites only the dates (UTC) that its batch holds, so its cost follows the
batch and those dates, not the table. A version becomes visible only after its data is
written, by one log file that is renamed to its number (K7, all-or-nothing per table).
Readers take, for each date, the folder of the highest logged version.

Several writers may export into a table at once. The log file of a number can be made only
once; who comes second looks at the log again. If nobody has rewritten one of its dates
since, it commits its data under the next number, else it merges its staged batch anew.

Replaying a batch that the same writer has logged is a no-op. The writer of a stream is
the query id that its checkpoint holds: a stream that starts over with a new checkpoint, at
whatever path, is a new writer, and its batches are merged again instead of being skipped.
Batch exports are no writers: they merge whenever they run. A batch is evaluated once a
try: what it holds is staged and everything else reads that. Versions and staging are plain
Spark writes on the shared file system; no driver-local state is involved, and the
driver sees one log row per date.

With Delta Lake on the classpath ``delta_merge`` runs the same upsert as a
MERGE statement instead (untested offline: no Delta jar in this environment).
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import collapse_updates, conform, merge_upsert

DATE = "window_date"
LOG_SCHEMA = T.StructType([T.StructField("version", T.LongType()),
                           T.StructField(DATE, T.DateType()),
                           T.StructField("folder", T.StringType()),
                           T.StructField("row_count", T.LongType()),
                           T.StructField("writer", T.StringType()),
                           T.StructField("batch_id", T.LongType())])


#: K8: pauses in seconds before the second and the third try
RETRY_WAITS = (5.0, 10.0)


def with_retry(action: Callable[[], object], waits: Sequence[float] = RETRY_WAITS,
               sleep: Callable[[float], None] = time.sleep):
    """K8: the result of ``action``, tried once more after each pause of ``waits``.

    Meant for the external system (JDBC, object store); task failures are retried
    by Spark itself. A plan that cannot be analysed will not get better by waiting,
    so AnalysisException is raised at once, any other error when no pause is left.
    """
    pauses = iter(waits)
    while True:
        try:
            return action()
        except AnalysisException:
            raise
        except Exception:
            pause = next(pauses, None)
            if pause is None:
                raise
        sleep(pause)


def _log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LOG_SCHEMA).option("pathGlobFilter", "*.json").json(f"{path}/_log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


class _State(NamedTuple):
    """What the log says: the last version, the version that holds a writer's batch, and
    the folder of each date."""

    last: int | None
    done: int | None
    current: dict[dt.date, str]


def _state(spark: SparkSession, path: str, writer: str | None = None, batch_id: int | None = None) -> _State:
    mine = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    rows = (_log(spark, path).groupBy(DATE)
            .agg(F.max("version").alias("last"), F.max_by("folder", "version").alias("folder"),
                 F.max(F.when(mine, F.col("version"))).alias("done")).collect())
    return _State(max((r.last for r in rows), default=None),
                  max((r.done for r in rows if r.done is not None), default=None),
                  {r[DATE]: r.folder for r in rows if r[DATE] is not None})


def current_version(spark: SparkSession, path: str) -> int | None:
    return _state(spark, path).last


def _read_dates(spark: SparkSession, path: str, schema: T.StructType,
                current: dict[dt.date, str]) -> DataFrame:
    """The rows of the folders that ``current`` (date -> folder) names."""
    if not current:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(
        *(f"{path}/{folder}/{DATE}={day.isoformat()}" for day, folder in sorted(current.items())))


def read_versioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest committed rows, or an empty frame of ``schema``."""
    return _read_dates(spark, path, schema, _state(spark, path).current)


def _utc_date(col: str) -> F.Column:
    """The UTC date of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(col) / 86400).cast("int"))


def write_lines(spark: SparkSession, folder: str, name: str, rows: Sequence[dict]) -> bool:
    """Make the JSON lines file ``name`` at once, complete; False if there is one by that name.

    A hidden file is written and renamed, as Spark commits the batches of a checkpoint.
    """
    jvm = spark.sparkContext._jvm
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    fs, at = filesystem(spark, hidden)
    out = fs.create(at, True)
    out.write("".join(json.dumps(row, default=str) + "\n" for row in rows).encode())
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(at, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), options)
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise
        return False
    finally:
        fs.delete(at, False)
    return True


def _commit(spark: SparkSession, path: str, version: int, rows: Sequence[dict]) -> bool:
    """Log ``rows`` as ``version`` unless that number is taken or compacted away."""
    fs, log = filesystem(spark, f"{path}/_log")
    if fs.exists(log):
        names = [st.getPath().getName() for st in fs.listStatus(log)]
        if any(int(name.split(".")[0]) >= version for name in names if name.endswith(".json") and name[0] != "."):
            return False
    return write_lines(spark, f"{path}/_log", f"{version:020d}.json", rows)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete ``folder`` with all it holds, if there is one."""
    fs, at = filesystem(spark, folder)
    fs.delete(at, True)


def merge_into_versioned(spark: SparkSession, path: str, updates: DataFrame, schema: T.StructType,
                         keys: Sequence[str], update_cols: Sequence[str], batch_id: int,
                         order_by: Sequence[str] = ("window_end",), *, writer: str | None,
                         date_col: str = "window_start") -> dict:
    """Merge batch ``batch_id`` of ``writer`` into the table at ``path``; returns a report.

    ``writer`` None: not a stream's batch, merged whatever the log holds. ``date_col`` (a
    timestamp of the keys, so that a row never changes its date) places a row. A batch
    without rows leaves the table as it is (K9).
    """
    if date_col not in keys:
        raise ValueError("date_col must be one of the keys")
    seen = _state(spark, path, writer, batch_id)
    if seen.done is not None:
        return {"version": seen.done, "skipped": True}
    staging = f"{path}/_staging/{uuid.uuid4().hex}"
    written = None
    try:
        lost, held = Observation(), Observation()
        (conform(updates, schema, key_cols=keys, observation=lost)
         .observe(held, F.collect_set(_utc_date(date_col)).alias("days"))
         .write.parquet(staging))
        report = {"skipped": False, "dropped_null_key": (lost.get or {}).get("dropped_null_key") or 0}
        days = sorted((held.get or {}).get("days") or [])
        if not days:
            return report | {"version": seen.last, "rows": 0, "dates": []}
        batch = spark.read.schema(schema).parquet(staging)
        while True:
            if written is None:
                base = {day: seen.current[day] for day in days if day in seen.current}
                name = f"v={0 if seen.last is None else seen.last + 1}.{uuid.uuid4().hex[:12]}"
                merged = merge_upsert(_read_dates(spark, path, schema, base), batch, keys, update_cols, order_by)
                counted = Observation()
                written = f"{path}/{name}"
                (merged.observe(counted, F.count(F.lit(1)).alias("rows"))
                 .withColumn(DATE, _utc_date(date_col)).hint("rebalance", DATE)
                 .write.partitionBy(DATE).parquet(written))
                rows = counted.get["rows"]
            version = 0 if seen.last is None else seen.last + 1
            entries = [{"version": version, DATE: day.isoformat(), "folder": name, "row_count": rows,
                        "writer": writer, "batch_id": batch_id} for day in days]
            if _commit(spark, path, version, entries):
                written = None
                return report | {"version": version, "rows": rows, "dates": days}
            seen = _state(spark, path, writer, batch_id)
            if seen.done is not None:
                return {"version": seen.done, "skipped": True}
            if any(seen.current.get(day) != base.get(day) for day in days):  # another's rows came in between
                remove_folder(spark, written)
                written = None
    finally:
        remove_folder(spark, staging)
        if written is not None:
            remove_folder(spark, written)


def merge_sink(path: str, schema: T.StructType, keys: Sequence[str], update_cols: Sequence[str],
               waits: Sequence[float] = RETRY_WAITS, reports: list | None = None, *,
               writer: str | Callable[[SparkSession], str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: conform, then merge each micro-batch (K6-K9).

    ``writer`` names the stream whose batch ids count, or finds the name at a batch.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = writer if isinstance(writer, str) else writer(spark)
        rep = with_retry(lambda: merge_into_versioned(spark, path, batch, schema, keys,
                                                      update_cols, batch_id, writer=name),
                         waits)
        if reports is not None:
            reports.append(rep)
    return run


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started query has written into its checkpoint; a new checkpoint, a new id."""
    return json.loads("".join(r.value for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]


def start_merge_stream(gold: DataFrame, path: str, schema: T.StructType, keys: Sequence[str],
                       update_cols: Sequence[str], checkpoint: str, trigger: dict | None = None,
                       reports: list | None = None):
    """Stream a gold table into the keyed export table."""
    return (gold.writeStream.foreachBatch(merge_sink(path, schema, keys, update_cols, reports=reports,
                                                     writer=lambda spark: query_id(spark, checkpoint)))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 minutes"})).start())


def collapsed(updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
              order_by: Sequence[str]) -> DataFrame:
    """``updates`` with one row per key, as applying them row by row would insert it."""
    insert_only = [c for c in updates.columns if c not in keys and c not in update_cols]
    return collapse_updates(updates, keys, update_cols, insert_only, order_by).select(
        *keys, *[F.col(f"_last.{c}").alias(c) for c in update_cols],
        *[F.col(f"_first.{c}").alias(c) for c in insert_only])


def delta_merge(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                update_cols: Sequence[str], order_by: Sequence[str]) -> None:
    """Same semantics through Delta's MERGE (requires delta-spark)."""
    from delta.tables import DeltaTable  # noqa: PLC0415 - optional dependency
    rows = collapsed(updates, keys, update_cols, order_by)
    cond = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    (DeltaTable.forPath(spark, path).alias("t").merge(rows.alias("u"), cond)
     .whenMatchedUpdate(set={c: f"u.{c}" for c in update_cols})
     .whenNotMatchedInsertAll().execute())


def quoted(name: str) -> str:
    """A possibly dotted name as quoted SQL identifiers."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str],
                     update_cols: Sequence[str]) -> str:
    cols = ", ".join(map(quoted, columns))
    sets = ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in update_cols)
    return (f"INSERT INTO {quoted(table)} ({cols}) SELECT {cols} FROM {quoted(staging)} "
            f"ON CONFLICT ({', '.join(map(quoted, keys))}) DO UPDATE SET {sets}")


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], update_cols: Sequence[str],
                properties: dict[str, str], order_by: Sequence[str] = ("window_end",)) -> None:
    """Upsert into a relational table.

    The rows, one per key, are bulk-loaded into a staging table of their own with Spark's
    JDBC writer (partition-parallel, batched); one set-based statement moves them over in a
    transaction and the staging table is dropped. Needs the database's JDBC driver; the
    statement and the collapsed rows are tested, the database step is not exercised here.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    rows = collapsed(df, keys, update_cols, order_by)
    rows.write.jdbc(url, quoted(staging), mode="errorifexists", properties=properties)
    jvm = df.sparkSession.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        try:
            stmt.executeUpdate(upsert_statement(table, staging, rows.columns, keys, update_cols))
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            stmt.executeUpdate(f"DROP TABLE {quoted(staging)}")
            conn.commit()
    finally:
        conn.close()


def export_table(spark: SparkSession, gold_path: str, target_path: str, schema: T.StructType,
                 keys: Sequence[str], update_cols: Sequence[str],
                 waits: Sequence[float] = RETRY_WAITS, fmt: str = "parquet") -> dict:
    """Batch export of a gold table into the keyed target (the by-hand export job).

    Reads the gold table through its commit log (only committed files, F8),
    conforms it and merges it as the next version. Re-running with unchanged
    gold rewrites identical rows (idempotent by the upsert)."""
    from ..sources.tables import read_sink_table
    gold = (read_sink_table(spark, gold_path, schema) if fmt == "parquet"
            else spark.read.format(fmt).load(gold_path))  # through the format's own log
    if gold.isEmpty():
        return {"skipped": True, "reason": "no rows"}
    return with_retry(lambda: merge_into_versioned(spark, target_path, gold, schema, keys,
                                                   update_cols, 0, writer=None), waits)


def filesystem(spark: SparkSession, path: str):
    """Hadoop FileSystem of ``path`` (works for HDFS, object stores, local)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def retain(spark: SparkSession, path: str, keep: int = 2) -> dict:
    """Housekeeping of a versioned table: drop what the newest ``keep`` versions do not show.

    A date's folder goes once a later one had replaced it by the oldest version kept; a
    reader still scanning such a folder fails, so ``keep`` must cover the longest read.
    The log is then rewritten as one file, named by the last version, without the entries of
    those folders (its old files are removed after that, so entries are only ever
    duplicated, never missing); the last batch of each stream stays known, so that its
    replay is still a no-op. Writers may commit meanwhile: later numbers are left alone, and
    numbers up to the last one stay taken. The driver sees the entries dropped since the last
    call, the entries kept, and one per stream.
    """
    if keep < 1:
        raise ValueError("keep must be >= 1")
    fs, log_dir = filesystem(spark, f"{path}/_log")
    if not fs.exists(log_dir):
        return {"versions_removed": [], "log_files_removed": 0}
    files = [st.getPath() for st in fs.listStatus(log_dir)
             if st.getPath().getName().endswith(".json") and not st.getPath().getName().startswith(".")]
    log = spark.read.schema(LOG_SCHEMA).json([f.toString() for f in files]).distinct()
    placed = log.where(F.col(DATE).isNotNull())
    newest = placed.select("version").distinct().orderBy(F.desc("version")).limit(keep)
    oldest = newest.agg(F.min("version")).first()[0]
    shown = F.max(F.when(F.col("version") <= oldest, F.col("version"))).over(Window.partitionBy(DATE))
    marked = placed.withColumn("live", F.col("version") >= F.coalesce(shown, F.col("version"))).collect()
    live = [r for r in marked if r.live]
    dead = [r for r in marked if not r.live]
    used = {r.folder for r in live}
    whole = {r.folder for r in dead} - used
    for folder in whole | {f"{r.folder}/{DATE}={r[DATE].isoformat()}" for r in dead if r.folder in used}:
        remove_folder(spark, f"{path}/{folder}")
    if len(files) > 1 or dead:
        streams = (log.where(F.col("writer").isNotNull()).groupBy("writer")
                   .agg(F.max("version").alias("version"), F.max_by("batch_id", "version").alias("batch_id")).collect())
        rows = [{c: r[c] for c in LOG_SCHEMA.names} for r in live]
        rows += [{"version": r.version, "row_count": 0, "writer": r.writer, "batch_id": r.batch_id} for r in streams]
        last = max(f.getName().split(".")[0] for f in files)
        write_lines(spark, f"{path}/_log", f"{last}.{uuid.uuid4().hex[:12]}.json", rows)
        for f in files:
            fs.delete(f, False)
    return {"versions_removed": sorted({r.version for r in dead if r.folder in whole}),
            "log_files_removed": len(files) if len(files) > 1 or dead else 0}
