"""Readers of alignment, variant and reference text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from variloom.operators.ordering import split_running
from variloom.sources.files import source_name

# Leading columns of alignment and variant records.
SAM_COLUMNS = {"qname": "string", "flag": "int", "raw_chrom": "string", "pos": "bigint", "mapq": "int",
               "cigar": "string", "rnext": "string", "pnext": "bigint", "tlen": "bigint", "seq": "string",
               "qual": "string"}
VCF_COLUMNS = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "normal", "tumor"]

# Variant file names are <sample>_<chrom>.<kind>.vcf, possibly compressed.
VCF_NAME = r"^(.*)_([^_.]+)\.(snp|indel)\.vcf"


def _fields(text: Column, count: int) -> Column:
    return F.split(text, "\t", count + 1)


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header lines and alignment records of SAM text."""
    lines = spark.read.text(path)
    is_header = F.col("value").startswith("@")
    header = lines.where(is_header).select(
        F.expr("substring(split_part(value, '\t', 1), 2)").alias("tag"),
        F.regexp_extract("value", "\tSN:([^\t]*)", 1).alias("raw_chrom"),
        F.regexp_extract("value", "\tLN:([0-9]+)", 1).try_cast("bigint").alias("length"),
        F.col("value").alias("line"),
        F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                 F.monotonically_increasing_id().alias("n")).alias("line_no"))
    parts = lines.where(~is_header & (F.col("value") != "")).select(_fields(F.col("value"), len(SAM_COLUMNS)).alias("f"))
    reads = parts.select(*(F.get("f", F.lit(i)).try_cast(kind).alias(name)
                           for i, (name, kind) in enumerate(SAM_COLUMNS.items())))
    return header, reads


def read_vcf(spark: SparkSession, path: str, samples: tuple[str, str] = ("normal", "tumor")) -> DataFrame:
    """Variant records with INFO as a map and a map per sample column.

    Sample and kind come from partition folders when there are any, else from the file name.
    """
    raw = spark.read.text(path)
    name = source_name()
    placed = {"sample": F.regexp_extract(name, VCF_NAME, 1), "kind": F.regexp_extract(name, VCF_NAME, 3)}
    origin = [F.col(c) if c in raw.columns else text.alias(c) for c, text in placed.items()]
    lines = raw.where(~F.col("value").startswith("#")).select(_fields(F.col("value"), len(VCF_COLUMNS)).alias("f"), *origin)
    return parse_vcf_fields(lines, samples)


def parse_vcf_fields(lines: DataFrame, samples: tuple[str, str] = ("normal", "tumor")) -> DataFrame:
    """Typed variant columns from the split fields ``f``; other columns stay."""
    at = {name: F.get("f", F.lit(i)) for i, name in enumerate(VCF_COLUMNS)}
    keys = F.split(at["format"], ":")

    def sample(name: str) -> Column:
        values = F.split(at[name], ":")
        # values may stop early; the missing ones are NULL
        return F.map_from_entries(F.transform(keys, lambda k, i: F.struct(k, F.get(values, i))))

    rest = [c for c in lines.columns if c != "f"]
    return lines.select(
        *rest, at["chrom"].alias("chrom"), at["pos"].try_cast("bigint").alias("pos"), at["id"].alias("id"),
        at["ref"].alias("ref"), at["alt"].alias("alt"), at["qual"].alias("qual"), at["filter"].alias("filter"),
        F.str_to_map(at["info"], F.lit(";"), F.lit("=")).alias("info"),
        *(sample(name).alias(f"{name}_fields") for name in samples))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reference lines as (chrom, start, bases), start being 0-based.

    With a ``chrom`` partition folder its lines may be spread over several files in name order.
    Otherwise each ``>`` line of a file begins the record it names, and lines before the first
    one belong to the file's name. Offsets are running sums inside file splits plus the totals
    of earlier splits; a compressed file is one split, so large references should be plain text.
    """
    raw = spark.read.text(path)
    head = F.col("bases").startswith(">")
    marked = raw.select(
        *([F.col("chrom")] if "chrom" in raw.columns else [F.regexp_replace(source_name(), r"\..*$", "").alias("chrom")]),
        F.trim("value").alias("bases"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_seq")).where("bases <> ''")
    if "chrom" in raw.columns:
        placed = split_running(marked.where(~head), {"_end": F.length("bases")}, ["chrom"])
        return placed.select("chrom", (F.col("_end") - F.length("bases")).alias("start"), F.upper("bases").alias("bases"))
    placed = split_running(marked, {"_end": F.when(head, 0).otherwise(F.length("bases")), "_record": head.cast("int")}, ["_path"])
    records = placed.where(head).select(
        "_path", "_record", F.regexp_extract("bases", r"^>\s*(\S*)", 1).alias("_name"), F.col("_end").alias("_base"))
    named = placed.where(~head).join(records, ["_path", "_record"], "left")
    return named.select(F.coalesce("_name", "chrom").alias("chrom"),
                        (F.col("_end") - F.length("bases") - F.coalesce("_base", F.lit(0))).alias("start"), F.upper("bases").alias("bases"))


def reference_blocks(lines: DataFrame, width: int = 1000, overlap: int = 200) -> DataFrame:
    """Reference in blocks of ``width`` bases plus ``overlap`` bases of the next block.

    A block gathers the lines that touch it, a number bounded by its width.
    """
    start, size = F.col("start"), F.length("bases")
    first = F.greatest(F.floor((start - overlap) / width), F.lit(0))
    last = F.floor((start + size - 1) / width)
    touched = lines.withColumn("block", F.explode(F.sequence(first, last)))
    low = F.col("block") * width
    begin = F.greatest(start, low)
    end = F.least(start + size, low + width + overlap)
    piece = F.substring("bases", (begin - start + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int"))
    pieces = touched.select("chrom", "block", begin.alias("begin"), piece.alias("piece")).where("piece <> ''")
    ordered = F.array_sort(F.collect_list(F.struct("begin", "piece")))
    return pieces.groupBy("chrom", "block").agg(ordered.alias("p")).select(
        "chrom", "block", F.array_join("p.piece", "").alias("bases"))
