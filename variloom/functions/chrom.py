"""Chromosome names and per-chromosome file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The reference sequences work is split by, in genome order.
CHROMOSOMES = [f"chr{n}" for n in range(1, 23)] + ["chrX", "chrY", "chrM"]

# Bare names that get the prefix, besides the numbers 1 to 22.
BARE_NAMES = {"X": "chrX", "Y": "chrY", "x": "chrX", "y": "chrY",
              "M": "chrM", "MT": "chrM", "m": "chrM", "mt": "chrM"}

# File name endings.
REFERENCE_SUFFIX = ".fa"
SPLIT_TAG = ".REF_"
ALIGNMENT_SUFFIX = ".bam"


def normalize_chrom(name: Column) -> Column:
    """Bare chromosome name to its prefixed form; any other name stays."""
    renamed = F.when(name.isin([str(n) for n in range(1, 23)]), F.concat(F.lit("chr"), name))
    for target in ("chrX", "chrY", "chrM"):
        sources = [bare for bare, full in BARE_NAMES.items() if full == target]
        renamed = renamed.when(name.isin(sources), target)
    return renamed.otherwise(name)


def chrom_rank(chrom: Column) -> Column:
    """Genome order: 1 to 22, X, Y, M, then everything else."""
    bare = F.when(chrom.startswith("chr"), F.substring(chrom, 4, 2**31 - 1)).otherwise(chrom)
    rank = F.when(bare == "X", 23).when(bare == "Y", 24).when(bare == "M", 25)
    return rank.otherwise(F.coalesce(bare.try_cast("int"), F.lit(26)))


def drop_extension(name: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def ref_file(name: Column, reference: Column) -> Column:
    """Per-reference alignment file cut out of ``name``."""
    return F.concat(drop_extension(name), F.lit(SPLIT_TAG), drop_extension(reference),
                    F.lit(ALIGNMENT_SUFFIX))
