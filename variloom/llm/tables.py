"""Shared steps: reading a table, cutting lineage in the shared folder, Arrow output."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from variloom.session import work_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start from the files."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(StructType(df.schema.fields)).parquet(path)


def spare(df: DataFrame, stem: str) -> str:
    """A column name like ``stem`` that ``df`` does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names."""
    return df.select(*[F.col(f"`{source.replace('`', '``')}`").alias(own) for own, source in columns.items()])


def held_out(doc_id, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id counts as remainder of the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def arrow_schema(ddl: str) -> pa.Schema:
    """A small DDL string as an Arrow schema."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    return pa.schema([(n, kinds[t]) for n, t in re.findall(r"(\w+) ([\w<>]+)", ddl)])
