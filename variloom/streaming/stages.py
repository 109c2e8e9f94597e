"""Stage events as streams: current stage, live counts, node view.

Results go to a folder per micro-batch through ``foreachBatch``. A batch that is run again
after a failure overwrites its own folder, so results are exactly once, and nothing passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from variloom.operators.runstate import node_status, progress
from variloom.session import work_path

#: State kept on disk, so the number of keys is not bound by executor memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_events(spark: SparkSession, folder: str, schema: StructType | str, glob: str = "*", max_files: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files).parquet(folder))


def read_json_events(spark: SparkSession, folder: str, schema: str, max_files: int = 1000) -> DataFrame:
    """JSON files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


def with_event_time(events: DataFrame, delay: str, column: str = "ts") -> DataFrame:
    """Events with a watermark; a time without zone is taken as session time."""
    return events.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def stage_counts(events: DataFrame) -> DataFrame:
    """Events per stage."""
    return events.groupBy("stage").agg(F.count("*").alias("n"))


def stage_windows(events: DataFrame, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Events per stage and tumbling window. An extension for bounded state."""
    timed = with_event_time(events, delay)
    return timed.groupBy(F.window("ts", width).alias("w"), "stage").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "stage", "n")


def stage_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Event sessions per sample pair, open ones included; in complete mode all of them stay in the state."""
    timed = with_event_time(events, delay)
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "normal", "tumor").agg(
        F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), "normal", "tumor", "n")


def closed_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Sessions per sample pair that the watermark has passed, for append mode.

    A session is given once, when no event can join it any more, and its state is dropped: state holds the
    sessions of the last ``delay`` only.
    """
    timed = with_event_time(events, delay)
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "normal", "tumor").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "normal", "tumor", "n")


def run_batches(stream: DataFrame, mode: str, path: str, each: Callable[[DataFrame], DataFrame] | None = None,
                trigger: dict | None = None):
    """Start a query that writes each micro-batch, after ``each``, to its own folder."""
    def write(batch: DataFrame, number: int) -> None:
        out = each(batch) if each else batch
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return (stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", f"{path}/checkpoint").trigger(**(trigger or {"availableNow": True})).start())


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows written so far, with their ``batch``."""
    return spark.read.option("mergeSchema", False).parquet(f"{path}/rows")


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last micro-batch: the result of a complete-mode query."""
    rows = read_batches(spark, path)
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Last row per key over all micro-batches: the result of an update-mode query."""
    rows = read_batches(spark, path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v")).select(*keys, "_v.*")


def run_to_end(stream: DataFrame, mode: str, label: str, keys: list[str] | None = None,
               each: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Work off all input of a stream and give its result."""
    spark = stream.sparkSession
    path = work_path(spark, label)
    query = run_batches(stream, mode, path, each)
    query.awaitTermination()
    return latest_batch(spark, path) if keys is None else latest_per_key(spark, path, keys)


def newest_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Each job as last written, over all micro-batches, however the input was split."""
    return latest_per_key(spark, path, ["job_id"])


def live_node_view(spark: SparkSession, path: str, nodes: DataFrame) -> DataFrame:
    """Nodes with the jobs asking for them, from the jobs a stream has written to ``path`` so far."""
    return node_status(nodes, newest_jobs(spark, path))


def live_progress(spark: SparkSession, path: str, processing: DataFrame) -> DataFrame:
    """Samples in progress with the summary of the jobs a stream has written to ``path`` so far."""
    return progress(processing, newest_jobs(spark, path))


def write_to_end(stream: DataFrame, label: str) -> str:
    """Work off all input of a stream of rows; gives the folder written to."""
    path = work_path(stream.sparkSession, label)
    run_batches(stream, "append", path).awaitTermination()
    return path
