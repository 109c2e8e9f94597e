"""Shared building blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def computed(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so each is evaluated once per row.

    Plain projections would be merged into later filters, projections and lambda bodies,
    which repeats their expressions there. With ``keep`` only those columns stay.
    """
    fields = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(*(keep or ["*"]), F.inline(F.array(fields)))


#: Bytes of input files for each partition, where a number of partitions is asked for.
PARTITION_BYTES = 16 << 20


def partitions_for(df: DataFrame) -> int:
    """Number of partitions that follows the size of the files ``df`` reads, by the planner, without a job.

    At least that of shuffles. The planner multiplies the sizes of joined tables, so those of the files are added up.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    # a leaf of unknown size counts as the largest number there is
    read = sum(n for n in sizes if n < 1 << 60)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(read / PARTITION_BYTES))
