"""Keyed state that a stream keeps in files: micro-batches as deltas, and snapshots that fold them.

A delta holds the newest row of each key of its micro-batch. Once the deltas since the last snapshot have
grown to a share of its size, a new snapshot folds both, so a row is rewritten a bounded number of times and a
reader folds one snapshot and the deltas after it, however long the stream has run. Files
below the newest snapshot may be removed at any time.

Only folders with Spark's success marker count. A batch that runs again overwrites its own folder; a
snapshot that was cut off is written anew. So a stop between any two writes changes no row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from variloom.operators.ordering import first_per_key
from variloom.streaming.stages import STATE_STORE

BATCH = "_batch"


@dataclass(frozen=True)
class StateLog:
    """State of ``keys`` below ``path``; of two rows the one with the larger ``order`` is newer, else the one of the later batch.

    A snapshot is due when the newer deltas reach ``share`` of its bytes, or ``most`` in number.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    order: str | None = None
    share: float = 0.5
    most: int = 256

    def _folders(self, spark: SparkSession, kind: str) -> dict[int, tuple[str, int]]:
        """Complete folders of one kind by number, with their paths and bytes."""
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return {}
        found = {}
        for entry in files.listStatus(root):
            folder = entry.getPath()
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
                found[int(folder.getName())] = (folder.toString(), files.getContentSummary(folder).getLength())
        return dict(sorted(found.items()))

    def _parts(self, spark: SparkSession) -> tuple[tuple[int, str, int] | None, dict[int, tuple[str, int]]]:
        """The newest snapshot (number, path, bytes) and the deltas after it."""
        snapshots = self._folders(spark, "snapshots")
        last = max(snapshots, default=None)
        newer = {n: f for n, f in self._folders(spark, "deltas").items() if last is None or n > last}
        return (None if last is None else (last, *snapshots[last])), newer

    def _newest(self, rows: DataFrame) -> DataFrame:
        version = F.struct(*([self.order] if self.order else []), BATCH)
        values = [c for c in rows.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), version).alias("_v")).select(*self.keys, "_v.*")

    def write(self, batch: DataFrame, number: int) -> None:
        """Write a micro-batch as a delta; an older one of the same number is overwritten."""
        rows = batch.select(*self.schema.names).withColumn(BATCH, F.lit(number).cast("long"))
        self._newest(rows).write.mode("overwrite").parquet(f"{self.path}/deltas/{number}")

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The newest row of each key, with the number of its batch; ``before`` leaves out later batches' rows."""
        snapshot, newer = self._parts(spark)
        paths = [*([snapshot[1]] if snapshot else []), *(p for p, _ in newer.values())]
        stored = StructType([*self.schema.fields, StructField(BATCH, LongType())])
        rows = spark.read.schema(stored).parquet(*paths) if paths else spark.createDataFrame([], stored)
        if before is not None:
            rows = rows.where(F.col(BATCH) < before)
        return self._newest(rows) if newer or before is not None else rows

    def state(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).select(*self.schema.names)

    def compact(self, spark: SparkSession, force: bool = False) -> bool:
        """Write a snapshot of all complete deltas if one is due; whether it was."""
        snapshot, newer = self._parts(spark)
        grown = sum(size for _, size in newer.values()) >= self.share * (snapshot[2] if snapshot else 0)
        if not newer or not (force or grown or len(newer) >= self.most):
            return False
        self.read(spark).write.mode("overwrite").parquet(f"{self.path}/snapshots/{max(newer)}")
        return True

    def expire(self, spark: SparkSession) -> None:
        """Remove the deltas and snapshots that the newest snapshot stands for."""
        snapshot, _ = self._parts(spark)
        if snapshot is None:
            return
        old = [p for n, (p, _) in self._folders(spark, "deltas").items() if n <= snapshot[0]]
        old += [p for n, (p, _) in self._folders(spark, "snapshots").items() if n < snapshot[0]]
        for p in old:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _start(stream: DataFrame, path: str, write: Callable[[DataFrame, int], None], trigger: dict | None):
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return (stream.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", f"{path}/checkpoint").trigger(**(trigger or {"availableNow": True})).start())


def keep_state(stream: DataFrame, log: StateLog, trigger: dict | None = None):
    """Start a query that keeps the newest row of each key."""
    def write(batch: DataFrame, number: int) -> None:
        log.write(batch, number)
        log.compact(batch.sparkSession)

    return _start(stream, log.path, write, trigger)


def append_first(stream: DataFrame, log: StateLog, arrival: str, trigger: dict | None = None):
    """Start a query that appends the first record of each key by ``arrival`` and ignores later ones.

    What a batch adds depends on the batches before it alone, so a batch that runs again adds the same rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        known = log.read(batch.sparkSession, before=number).select(*log.keys)
        fresh = first_per_key(batch, list(log.keys), arrival).join(known, list(log.keys), "left_anti")
        log.write(fresh, number)
        log.compact(batch.sparkSession)

    return _start(stream, log.path, write, trigger)
