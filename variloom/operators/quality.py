"""Output checks and resource metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from variloom.functions.barcode import sample_from_path
from variloom.functions.labels import size_unit
from variloom.operators.ordering import ROWS_PER_RANGE, running_totals

# Size units an output may have, loose and strict.
LOOSE_UNITS = ("MiB", "GiB")
STRICT_UNITS = ("MiB",)


def output_status(objects: DataFrame, units: tuple[str, ...] = LOOSE_UNITS, mode: str = "single") -> DataFrame:
    """PASSED or FAILED per sample folder.

    ``single`` passes a folder with exactly one object of an accepted unit. ``sum`` passes
    a folder of any number of objects that hold at least 1 MiB together.
    """
    grouped = objects.groupBy(sample_from_path(F.col("path")).alias("sample")).agg(
        F.count("*").alias("objects"), F.sum("size_bytes").alias("total_bytes"))
    unit = size_unit(F.col("total_bytes"))
    if mode == "single":
        ok = (F.col("objects") == 1) & unit.isin(list(units))
    elif mode == "sum":
        ok = F.col("total_bytes") >= 1 << 20
    else:
        raise ValueError("mode must be 'single' or 'sum'")
    return grouped.withColumns({"unit": unit, "status": F.when(ok, "PASSED").otherwise("FAILED")})


def with_skipped(status: DataFrame, done: DataFrame) -> DataFrame:
    """Samples that have local results become SKIPPED."""
    flags = done.select("sample").distinct().withColumn("_done", F.lit(True))
    joined = status.join(flags, "sample", "left")
    return joined.withColumn("status", F.when(F.col("_done"), "SKIPPED").otherwise(F.col("status"))).drop("_done")


def _counters() -> dict:
    return {name.lower(): F.col("status") == name for name in ("PASSED", "FAILED", "SKIPPED")}


def qa_totals(status: DataFrame) -> DataFrame:
    """Passed, failed and skipped samples."""
    return status.agg(*(F.count_if(cond).alias(name) for name, cond in _counters().items()))


def qa_running(status: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each sample with the passed, failed and skipped counts up to it."""
    return running_totals(status, order, {n: F.coalesce(c, F.lit(False)).cast("int") for n, c in _counters().items()},
                          rows_per_range)


def purge_candidates(status: DataFrame) -> DataFrame:
    """Samples listed as failed, whose outputs may be removed; nothing is removed here."""
    return status.where(F.trim("status") == "FAILED")


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Per step: runs, failures, highest memory, total and longest time. An extension."""
    return metrics.groupBy("step").agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("ExitStatus") != 0).alias("failures"),
        F.max("MaxResidentSetSize_KBs").alias("max_memory_kb"),
        F.sum("elapsed").alias("total_elapsed"),
        F.max("elapsed").alias("max_elapsed"))


def exit_status(metrics: DataFrame, step: str) -> DataFrame:
    """Sample and exit status of one step's runs."""
    ids = [c for c in ("ID", "NormalID", "TumorID", "Reference") if c in metrics.columns]
    return metrics.where(F.col("step") == step).select(*ids, "ExitStatus")
