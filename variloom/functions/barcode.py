"""Column functions on sample barcodes, file locations and job paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sample type codes below this number are tumor, the rest normal.
FIRST_NORMAL_CODE = 10


def case_id(barcode: Column) -> Column:
    """First three dash-separated parts."""
    return F.substring_index(barcode, "-", 3)


def sample_key(barcode: Column) -> Column:
    """First four dash-separated parts."""
    return F.substring_index(barcode, "-", 4)


def type_code(barcode: Column) -> Column:
    """Two-character sample type, the start of the fourth part; NULL when there is none."""
    code = F.substring(F.split_part(barcode, F.lit("-"), F.lit(4)), 1, 2)
    return F.when(code != "", code)


def sample_role(code: Column) -> Column:
    """``tumor`` for type codes below 10, else ``normal``; NULL when the code is no number."""
    number = code.try_cast("int")
    return F.when(number < FIRST_NORMAL_CODE, "tumor").when(number.isNotNull(), "normal")


def cancer_type(project: Column) -> Column:
    """Second part of the project name."""
    return F.split_part(project, F.lit("-"), F.lit(2))


def parse_barcode(df: DataFrame, col: str = "barcode") -> DataFrame:
    """Add ``case_id``, ``sample_key``, ``type_code`` and ``role``."""
    barcode = F.col(col)
    return df.withColumns(
        {
            "case_id": case_id(barcode),
            "sample_key": sample_key(barcode),
            "type_code": type_code(barcode),
            "role": sample_role(type_code(barcode)),
        }
    )


def case_from_file(file_name: Column) -> Column:
    """Case id from a file name that starts with the barcode."""
    return F.substring_index(file_name, "-", 3)


def bucket_of(url: Column) -> Column:
    """Bucket root of an object URL."""
    return F.concat(F.lit("gs://"), F.split_part(url, F.lit("/"), F.lit(3)))


def case_from_command(command: Column) -> Column:
    """Case folder in a job's script path; NULL when the path is too short."""
    return F.get(F.split(command, "/"), 4)


def sample_from_path(path: Column) -> Column:
    """Sample folder in an object path."""
    return F.split_part(path, F.lit("/"), F.lit(5))
