"""Writers of pair files, state logs, reports and variant bundles.

Partitioned writers ask for a rebalance on their partition columns first: small groups are
gathered into few files and a group that holds much of the data is split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from variloom.operators.cohort import write_ready
from variloom.operators.runstate import reset_plan
from variloom.session import work_path


#: JSON objects for each file.
JSON_RECORDS = 1000


def _balanced(df: DataFrame, *keys: str) -> DataFrame:
    return df.hint("rebalance", *keys)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Matched pairs without a header, total size recomputed."""
    write_ready(pairs).write.mode("overwrite").csv(path, header=False)


def write_todo(rows: DataFrame, path: str) -> None:
    """To-do pairs without a header, a folder per ``cohort`` and cancer code named like the files' scheme, in one write."""
    named = rows.withColumn("todo", F.concat("cohort", F.lit("_TODO_"), F.coalesce("cancer_type", F.lit("NONE")), F.lit("_MATCHED.csv")))
    _balanced(named.drop("cohort"), "todo").write.mode("overwrite").partitionBy("todo").csv(path, header=False)


def append_records(records: DataFrame, path: str, by: str = "step") -> None:
    """Append records to their tables, one folder per value of ``by``."""
    _balanced(records, by).write.mode("append").partitionBy(by).parquet(path)


def write_by_status(status: DataFrame, path: str, key: str = "sample") -> None:
    """Ids in one text folder per status."""
    _balanced(status.select(F.col(key).alias("value"), "status"), "status").write.mode("overwrite").partitionBy(
        "status").text(path)


# Header of variant text with a normal and a tumor column.
VCF_HEADER = "\n".join([
    "##fileformat=VCFv4.1", "##source=variloom",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth of both samples">',
    '##INFO=<ID=SOMATIC,Number=0,Type=Flag,Description="Somatic">', '##INFO=<ID=SS,Number=1,Type=String,Description="Status code">',
    '##INFO=<ID=GPV,Number=1,Type=Float,Description="Variant p value">', '##INFO=<ID=SPV,Number=1,Type=Float,Description="Somatic p value">',
    "#" + "\t".join(["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "NORMAL", "TUMOR"])])


def publish_vcf(lines: DataFrame, path: str) -> None:
    """Variant lines as compressed text, one folder per sample and kind.

    The part files of a folder are in order by name and inside; the first begins with the header. The lines are put
    down once, so headers, their sample of the sort and the sort itself do not make the calls again.
    """
    order = ["sample", "kind", "_body", "chrom", "pos", "ref", "alt"]
    made = work_path(lines.sparkSession, "vcf-lines")
    lines.write.parquet(made)
    lines = lines.sparkSession.read.schema(lines.schema).parquet(made)
    rows = lines.select("sample", "kind", F.lit(1).alias("_body"), "chrom", "pos", "ref", "alt", "line")
    none = F.lit(None)
    heads = lines.select("sample", "kind").distinct().select(
        "sample", "kind", F.lit(0).alias("_body"), *(none.cast(rows.schema[c].dataType).alias(c) for c in order[3:]), F.lit(VCF_HEADER).alias("line"))
    ordered = rows.unionByName(heads).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("sample", "kind", "line").write.mode("overwrite").partitionBy("sample", "kind").option(
        "compression", "gzip").text(path)


def write_fasta(lines: DataFrame, path: str) -> None:
    """Reference lines (chrom, start, bases) as text with a folder per chromosome, part files in order of start."""
    order = ["chrom", "start"]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("chrom", "bases").write.mode("overwrite").partitionBy("chrom").text(path)


def write_counts(counts: DataFrame, path: str) -> None:
    """Count report with a header."""
    counts.write.mode("overwrite").option("header", True).csv(path)


def split_by_reference(reads: DataFrame, path: str, by: str = "chrom") -> None:
    """Reads in one folder per reference."""
    _balanced(reads, by).write.mode("overwrite").partitionBy(by).parquet(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as the text of a JSON object."""
    return df.select(F.to_json(F.struct("*")).alias("json"))


def write_json_records(df: DataFrame, path: str, per_file: int = JSON_RECORDS) -> None:
    """Rows as files of an array of at most ``per_file`` JSON objects each."""
    # consecutive rows of a partition; the numbers of another one are far away
    numbered = df.select(F.struct("*").alias("_r")).withColumn("_file", F.floor(F.monotonically_increasing_id() / per_file))
    packed = numbered.groupBy("_file").agg(F.collect_list("_r").alias("_r"))
    packed.select(F.to_json("_r").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def reset_tables(spark: SparkSession, root: str, schemas: dict[str, str], **flags: bool) -> list[str]:
    """Empty the state tables a reset covers; gives their names."""
    names = [n for n in reset_plan(**flags) if n in schemas]
    for name in names:
        spark.createDataFrame([], schemas[name]).write.mode("overwrite").parquet(f"{root}/{name}")
    return names
