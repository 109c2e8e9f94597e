"""Variant tables: counts, completeness, concatenation, plot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from variloom.functions.chrom import chrom_rank

# Size above which a per-chromosome file is valid, and how many valid files
# a sample must exceed, by kind.
VALID_BYTES = 100_000
VALID_FILES = {"snp": 22, "indel": 20}

# Status codes in VCF records.
STATUS_CODES = {"Germline": "1", "Somatic": "2", "LOH": "3", "Unknown": "5"}


def variant_counts(calls: DataFrame, header_lines: int = 0) -> DataFrame:
    """Records per sample, chromosome (without prefix) and kind.

    ``header_lines`` is added per file for counts that include a header.
    """
    chrom = F.regexp_replace("chrom", "^chr", "").alias("chrom")
    return calls.groupBy("sample", chrom, "kind").agg((F.count("*") + F.lit(header_lines)).alias("n"))


def total_counts(calls: DataFrame) -> DataFrame:
    """Records per file and a last row ``total``."""
    rolled = calls.rollup("file").agg(F.count("*").alias("n"), F.grouping("file").alias("is_total"))
    return rolled.withColumn("file", F.when(F.col("is_total") == 1, "total").otherwise(F.col("file")))


def valid_chrom_files(files: DataFrame) -> DataFrame:
    """Files large enough to hold a chromosome's calls."""
    return files.where(F.col("size_bytes") > VALID_BYTES)


def valid_file_counts(files: DataFrame) -> DataFrame:
    """Valid files per sample and kind, and whether they exceed the limit of the kind."""
    limit = F.when(F.col("kind") == "snp", VALID_FILES["snp"]).otherwise(VALID_FILES["indel"])
    counted = files.groupBy("sample", "kind").agg(F.count_if(F.col("size_bytes") > VALID_BYTES).alias("valid_files"))
    return counted.withColumn("complete", F.col("valid_files") > limit)


def chrom_completeness(files: DataFrame) -> DataFrame:
    """Samples per kind, and how many of them are complete."""
    return valid_file_counts(files).groupBy("kind").agg(
        F.count("*").alias("samples"), F.count_if("complete").alias("complete_samples"))


def chrom_bars(counts: DataFrame) -> DataFrame:
    """Chart table: SNV and indel counts per sample and chromosome, in file name order."""
    bars = counts.groupBy("sample", "chrom").agg(
        F.sum(F.when(F.col("kind") == "snp", F.col("n")).otherwise(0)).alias("snv"),
        F.sum(F.when(F.col("kind") == "indel", F.col("n")).otherwise(0)).alias("indel"))
    return bars.orderBy("sample", "chrom")


def lexicographic(df: DataFrame, *more: str) -> DataFrame:
    """Rows in file name order: chr1, chr10, ..., chr2."""
    return df.orderBy("chrom", *more)


def concat_vcf(*parts: DataFrame) -> DataFrame:
    """Per-chromosome records as one table per sample and kind, in file name order, then position."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.orderBy("sample", "kind", "chrom", "pos", "ref", "alt")


def manhattan(calls: DataFrame) -> DataFrame:
    """Plot matrix: SNP, CHR (X 23, Y 24, M 25), BP, P."""
    name = F.concat_ws(":", "chrom", F.col("pos").cast("string"))
    return calls.select(name.alias("SNP"), chrom_rank(F.col("chrom")).alias("CHR"),
                        F.col("pos").alias("BP"), F.col("somatic_p").alias("P"))


def vcf_lines(calls: DataFrame) -> DataFrame:
    """Calls as VCF text lines, with the columns that place them in files."""
    genotypes = {"ref": "0/0", "het": "0/1", "hom": "1/1"}

    def sample(side: str):
        gt = F.lit(".")
        for name, text in genotypes.items():
            gt = F.when(F.col(f"{side}_gt") == name, text).otherwise(gt)
        share = F.format_string("%.2f%%", F.col(f"{side}_alt") * 100.0 / F.col(f"{side}_depth"))
        return F.concat_ws(":", gt, F.col(f"{side}_depth").cast("string"), F.col(f"{side}_ref").cast("string"),
                           F.col(f"{side}_alt").cast("string"), share)

    code = F.lit("0")
    for name, text in STATUS_CODES.items():
        code = F.when(F.col("status") == name, text).otherwise(code)
    info = F.concat(
        F.lit("DP="), (F.col("n_depth") + F.col("t_depth")).cast("string"),
        F.when(F.col("status") == "Somatic", ";SOMATIC").otherwise(""),
        F.lit(";SS="), code,
        F.lit(";GPV="), F.format_string("%.9f", "variant_p"), F.lit(";SPV="), F.format_string("%.9f", "somatic_p"))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."),
                       F.lit("PASS"), info, F.lit("GT:DP:RD:AD:FREQ"), sample("n"), sample("t"))
    return calls.select("sample", "chrom", "kind", "pos", "ref", "alt", line.alias("line"))


def calls_from_vcf(vcf: DataFrame) -> DataFrame:
    """Call columns back from parsed VCF records, ready for ``process_somatic``."""
    def number(side: str, key: str):
        return F.try_element_at(f"{side}_fields", F.lit(key)).try_cast("bigint")

    status = F.lit(None).cast("string")
    for name, text in STATUS_CODES.items():
        status = F.when(F.try_element_at("info", F.lit("SS")) == text, name).otherwise(status)
    sides = {"n": "normal", "t": "tumor"}
    return vcf.select(
        "sample", "chrom", "kind", "pos", "ref", "alt",
        *(number(name, key).alias(f"{side}_{col}") for side, name in sides.items()
          for key, col in (("DP", "depth"), ("RD", "ref"), ("AD", "alt"))),
        F.try_element_at("info", F.lit("GPV")).try_cast("double").alias("variant_p"),
        F.try_element_at("info", F.lit("SPV")).try_cast("double").alias("somatic_p"),
        status.alias("status"))
