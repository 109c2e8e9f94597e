"""Resource metrics posted as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from variloom.functions.labels import elapsed_seconds, percent

# Fields of a metric record, by type; ids first.
ID_FIELDS = ["ID", "NormalID", "TumorID", "Reference"]
TEXT_FIELDS = ["CommandLineArguments", "ElapsedTime_s", "CPU_Percent"]
LONG_FIELDS = ["AvgSizeUnsharedDataArea_KBs", "NumPageFaults", "NumFileSystemInputs", "AvgMemUse_KBs",
               "MaxResidentSetSize_KBs", "NumFileSystemOutputs", "NumRecoverablePageFaults",
               "TimesProcessSwappedOutOfMainMemory", "AverageAmountSharedText", "SystemPageSize_KBs",
               "TimesProcessContextSwitched", "NumSignalsDelivered", "AverageUnsharedStackSize_KBs",
               "NumSocketMessagesReceived", "NumSocketMessagesSent", "ResidentSetSize_KBs",
               "NumTimesContextSwitchedVoluntarily", "ExitStatus"]
DOUBLE_FIELDS = ["CPUUsedInKernelMode_s", "CPUUsedInUserMode_s", "ElapsedRealTimeUsed_s"]

BAD = "_bad_record"


def parse_metrics(df: DataFrame, body: str = "body") -> DataFrame:
    """Typed metric columns beside the input columns.

    Records that are no JSON keep their text in ``_bad_record``; use :func:`good_metrics`
    and :func:`bad_metrics` to separate them. Values come as text and are cast one by one,
    so a bad value becomes NULL without losing its record.
    """
    names = ID_FIELDS + TEXT_FIELDS + LONG_FIELDS + DOUBLE_FIELDS
    schema = ", ".join(f"{n} string" for n in [*names, BAD])
    parsed = df.withColumn("_m", F.from_json(body, schema, {"columnNameOfCorruptRecord": BAD}))
    typed = {n: F.col(f"_m.{n}") for n in [*ID_FIELDS, *TEXT_FIELDS, BAD]}
    typed |= {n: F.col(f"_m.{n}").try_cast("bigint") for n in LONG_FIELDS}
    typed |= {n: F.col(f"_m.{n}").try_cast("double") for n in DOUBLE_FIELDS}
    typed |= {"elapsed": elapsed_seconds(F.col("_m.ElapsedTime_s")), "cpu": percent(F.col("_m.CPU_Percent"))}
    return parsed.withColumns(typed).drop("_m")


def good_metrics(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD).isNull()).drop(BAD)


def bad_metrics(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD).isNotNull())
