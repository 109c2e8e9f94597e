"""Readers of cohort lists, status lists and object listings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Column order of the manifest and of matched-pair files.
MANIFEST_SCHEMA = ("file_gdc_id string, program_name string, project_short_name string, barcode string, "
                   "file_name string, file_size bigint, platform string, file_gcs_url string")
PAIR_SCHEMA = ("index bigint, case_id string, tumor_barcode string, tumor_file string, tumor_gdc_id string, "
               "tumor_file_url string, tumor_file_size double, tumor_platform string, normal_barcode string, "
               "normal_file string, normal_gdc_id string, normal_file_url string, normal_file_size double, "
               "normal_platform string, cancer_type string, total_size double")
TODO_SCHEMA = PAIR_SCHEMA + ", new_tumor_url string, new_normal_url string"

TODO_COLUMNS = [field.split()[0] for field in TODO_SCHEMA.split(", ")]

# To-do file names carry cohort and cancer code.
TODO_NAME = "([^_/=]+)_TODO_([^_/]+)_"


def source_name() -> Column:
    """Name of the file a row comes from; of its folder when a Spark job wrote the file."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    name = F.element_at(parts, -1)
    return F.when(name.startswith("part-"), F.element_at(parts, -2)).otherwise(name)


def _sizes(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if c.endswith("_size")]
    return df.withColumns({c: F.col(c).cast("bigint") for c in names})


def _or_empty(read, spark: SparkSession, schema: str) -> DataFrame:
    """What ``read`` gives, or no rows when the file is missing."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per-file manifest with a header line."""
    return spark.read.schema(MANIFEST_SCHEMA).option("header", True).csv(path)


def read_pairs(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Matched pairs, 16 columns; ``header`` skips the first line."""
    return _sizes(spark.read.schema(PAIR_SCHEMA).option("header", header).csv(path))


def read_todo(spark: SparkSession, path: str) -> DataFrame:
    """To-do pairs, 18 columns; ``cohort`` and ``cancer`` come from the file name."""
    name = source_name()
    rows = spark.read.schema(TODO_SCHEMA).csv(path).select(*TODO_COLUMNS, "_metadata")
    return _sizes(rows.withColumns({"cohort": F.regexp_extract(name, TODO_NAME, 1),
                                    "cancer": F.regexp_extract(name, TODO_NAME, 2)}).drop("_metadata"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Case ids, the first field of each line; blank lines and a missing file give nothing."""
    def read() -> DataFrame:
        first = F.trim(F.split_part("value", F.lit(","), F.lit(1)))
        return spark.read.text(path).select(first.alias("case_id")).where("case_id <> ''")

    return _or_empty(read, spark, "case_id string")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """``id, STATUS`` lines, trimmed; a missing file gives nothing."""
    def read() -> DataFrame:
        rows = spark.read.schema("case_id string, status string").csv(path)
        return rows.select(F.trim("case_id").alias("case_id"), F.trim("status").alias("status"))

    return _or_empty(read, spark, "case_id string, status string")


def read_json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object, or an array of them, per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_count_dict(spark: SparkSession, path: str, drop: tuple[str, ...] = ("disease_code",)) -> DataFrame:
    """Single-quoted dictionary as (code, n) rows; counted header words are dropped."""
    parsed = spark.read.text(path).select(F.from_json("value", "map<string,bigint>").alias("m"))
    rows = parsed.select(F.explode("m").alias("code", "n"))
    return rows.where(~F.col("code").isin(list(drop))) if drop else rows


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Cancer codes, one per line."""
    return spark.read.text(path).select(F.trim("value").alias("cancer_type")).where("cancer_type <> ''")


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file under ``root``; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("length").alias("size_bytes"))


def scan_table(spark: SparkSession, name: str, allowed: list[str]) -> DataFrame:
    """A whole named table; names outside ``allowed`` are refused."""
    if name not in allowed:
        raise ValueError(f"unknown table {name!r}")
    return spark.table(name)
