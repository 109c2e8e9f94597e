"""Two-sample pileups, somatic calls and their high-confidence subsets."""

from __future__ import annotations

import re
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from variloom.functions.stats import fisher_one_tailed, hypergeometric_tail
from variloom.operators.base import computed, partitions_for
from variloom.operators.reads import REVERSE

BASES = ["A", "C", "G", "T"]
ROLES = {"n": "normal", "t": "tumor"}
LOCUS = ["sample", "chrom", "pos"]
#: Matched bases of a CIGAR text.
MATCHED = ("M", "=", "X")
#: Bases of a genome bin that reads are dealt by.
BIN_BASES = 1 << 14


@dataclass(frozen=True)
class SomaticParams:
    """Calling thresholds; frequencies are exact to a thousandth."""

    # Coverage, frequency and p thresholds of the calling step.
    min_coverage: int = 8
    min_coverage_normal: int = 8
    min_coverage_tumor: int = 6
    min_var_freq: float = 0.10
    min_freq_for_hom: float = 0.75
    normal_purity: float = 1.0
    tumor_purity: float = 1.0
    p_value: float = 0.99
    somatic_p_value: float = 0.05


@dataclass(frozen=True)
class ProcessParams:
    """High-confidence thresholds."""

    # Tumor and normal frequency limits and p limit of the filter step.
    min_tumor_freq: float = 0.10
    max_normal_freq: float = 0.05
    p_value: float = 0.07


def _ratio(share: float) -> tuple[int, int]:
    """A decimal share as it is written, as a fraction; one with more than nine decimals is refused."""
    exact = Fraction(repr(round(share, 12)))
    if exact.denominator > 10 ** 9:
        raise ValueError(f"a share of {share!r} has more than nine decimals")
    return exact.numerator, exact.denominator


def at_least(part: Column, whole: Column, share: float) -> Column:
    """part / whole >= share on integers, free of rounding; false for an empty whole."""
    up, down = _ratio(share)
    return (whole > 0) & (part.cast("bigint") * down >= whole.cast("bigint") * up)


def at_most(part: Column, whole: Column, share: float) -> Column:
    up, down = _ratio(share)
    return (whole > 0) & (part.cast("bigint") * down <= whole.cast("bigint") * up)


# ---- from alignments to bases ------------------------------------------------------------


def _placed_runs(ops: tuple[str, ...]) -> Column:
    """Runs of column ``cigar``, of the ``ops`` asked for, with where each begins: ``at`` bases after the read's place, ``from`` in the read.

    Each different text of a batch is taken apart once.
    """
    kind = pa.list_(pa.struct([("op", pa.string()), ("size", pa.int32()), ("at", pa.int64()), ("from", pa.int32())]))
    pattern = re.compile("([0-9]+)([MIDNSHP=X])")

    @F.arrow_udf("array<struct<op string, size int, at bigint, from int>>")
    def place(cigars: pa.Array) -> pa.Array:
        coded = cigars.dictionary_encode()
        placed = []
        for text in coded.dictionary.to_pylist():
            runs, at, begin = [], 0, 0
            for size, op in ((int(n), op) for n, op in pattern.findall(text)):
                if size and op in ops:
                    runs.append({"op": op, "size": size, "at": at, "from": begin})
                at += size if op in "MDN=X" else 0
                begin += size if op in "MIS=X" else 0
            placed.append(runs)
        return pa.array(placed, kind).take(coded.indices)

    return place("cigar")


def aligned_runs(reads: DataFrame) -> DataFrame:
    """Reference runs that SAM reads cover: ``chrom``, ``start``, ``size``, one row per run of matched bases."""
    keep = [c for c in ("sample", "role", "chrom") if c in reads.columns]
    opened = reads.select(*keep, "pos", F.inline(_placed_runs(MATCHED)))
    return opened.select(*keep, (F.col("pos").cast("bigint") + F.col("at")).alias("start"), "size")


def near_reads(reads: DataFrame) -> DataFrame:
    """The same reads, dealt by genome bin, so that the bases of a task fall on few loci.

    Counting by locus then shrinks them before its shuffle, and a task holds the loci of some bins instead of most of
    the genome's. The number of partitions follows the size of the input; a bin with very many reads is split.
    """
    keyed = reads.withColumn("_bin", F.floor(F.col("pos") / BIN_BASES))
    return keyed.hint("rebalance", partitions_for(reads), "chrom", "_bin").drop("_bin")


def expand_alignment(reads: DataFrame, ops: tuple[str, ...] = (*MATCHED, "I", "D")) -> DataFrame:
    """Aligned bases of SAM reads: one row per matched base, insertion and deletion, of the ``ops`` asked for.

    ``base`` is the read's base at a matched position. ``indel`` is ``+<bases>`` or
    ``-<length>`` and sits at the position before the change.
    """
    keep = [c for c in ("sample", "role", "chrom", "flag", "mapq") if c in reads.columns]
    # bytes, where a base is found without reading those before it
    text = [F.col(c).cast("binary").alias(c) for c in ("seq", "qual")]
    runs = reads.select(*keep, F.col("pos").cast("bigint").alias("pos"), *text, F.inline(_placed_runs(ops)))
    matched = F.col("op").isin(*MATCHED)
    opened = runs.select("*", F.explode(F.when(matched, F.sequence(F.lit(0), F.col("size") - 1)).otherwise(F.array(F.lit(0)))).alias("_j"))
    at = F.col("from") + F.col("_j") + 1
    inserted = F.concat(F.lit("+"), F.substring("seq", F.col("from") + 1, F.col("size")).cast("string"))
    return opened.select(
        *keep, (F.col("pos") + F.col("at") + F.when(matched, F.col("_j")).otherwise(-1)).alias("pos"),
        F.when(matched, F.substring("seq", at, F.lit(1)).cast("string")).alias("base"),
        F.when(matched, F.ascii(F.substring("qual", at, F.lit(1)).cast("string")) - 33).alias("baseq"),
        F.when(F.col("op") == "I", inserted).when(F.col("op") == "D", F.concat(F.lit("-"), F.col("size").cast("string"))).alias("indel"))


def expand_changes(reads: DataFrame) -> DataFrame:
    """The insertions and deletions of :func:`expand_alignment` only; reads without one are not opened."""
    return expand_alignment(reads.where(F.col("cigar").rlike("[ID]")), ("I", "D"))


def _count(side: str, base: str, strand: str) -> str:
    return f"{side}_{base.lower()}_{strand}"


def pileup(bases: DataFrame, keys: list[str] = LOCUS, min_baseq: int = 0) -> DataFrame:
    """Per locus: normal and tumor counts by base and strand.

    One hash aggregation over conditional counts, pre-aggregated before its only shuffle;
    a locus with very many reads shrinks to a row per input partition first. ``ref`` is
    kept when the bases carry it.
    """
    good = bases.where(F.col("base").isin(BASES))
    if min_baseq:
        good = good.where(F.col("baseq") >= min_baseq)
    counts = [
        F.expr(f"count_if(role = '{role}' and base = '{base}' and (flag & {REVERSE}) {sign} 0)").alias(_count(side, base, strand))
        for side, role in ROLES.items() for base in BASES for strand, sign in (("f", "="), ("r", "<>"))
    ]
    if "ref" in bases.columns:
        # one reference base per locus: held as its code point, which a hash aggregate can update
        code = F.max(F.ascii("ref")).alias("_ref")
        return good.groupBy(*keys).agg(code, *counts).withColumn("ref", F.chr("_ref")).drop("_ref")
    return good.groupBy(*keys).agg(*counts)


def with_reference(pile: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """Add ``ref`` to loci from reference blocks of ``width`` bases."""
    at = F.col("pos") - 1
    keyed = pile.withColumn("block", F.floor(at / width))
    joined = keyed.join(blocks.select("chrom", "block", "bases"), ["chrom", "block"])
    return joined.withColumn("ref", F.substring("bases", (at % width + 1).cast("int"), F.lit(1))).drop("bases", "block")


def allele_counts(pile: DataFrame, keys: list[str] = LOCUS) -> DataFrame:
    """Reference and most frequent other base per locus with their normal and tumor counts."""
    sums = {f"{side}_{b}": F.expr(f"{_count(side, b, 'f')} + {_count(side, b, 'r')}") for side in ROLES for b in BASES}
    summed = computed(pile, **sums)
    # the other base with most reads, the first in order on ties
    others = ", ".join(
        f"struct(if(ref = '{b}', -1, n_{b} + t_{b}) as reads, {-i} as tie, '{b}' as base, n_{b} as n, t_{b} as t)"
        for i, b in enumerate(BASES))
    topped = computed(summed, top=F.expr(f"array_max(array({others}))"))

    def of_ref(side: str) -> str:
        return "case ref " + " ".join(f"when '{b}' then {side}_{b}" for b in BASES) + " else 0 end"

    return topped.select(
        *keys, "ref", F.expr("case when top.reads > 0 then top.base end").alias("alt"),
        *(F.expr(e).cast("bigint").alias(n) for n, e in {
            "n_ref": of_ref("n"), "n_alt": "if(top.reads > 0, top.n, 0)",
            "t_ref": of_ref("t"), "t_alt": "if(top.reads > 0, top.t, 0)",
            "n_depth": " + ".join(f"n_{b}" for b in BASES), "t_depth": " + ".join(f"t_{b}" for b in BASES)}.items()),
    )


def indel_counts(bases: DataFrame, pile: DataFrame, blocks: DataFrame, width: int,
                 keys: list[str] = LOCUS) -> DataFrame:
    """Most frequent insertion or deletion per locus with its counts, VCF style.

    Reads at the locus without that change count as reference. ``pile`` gives the depths and needs no ``ref``.
    """
    seen = bases.where("indel is not null").groupBy(*keys, "indel").agg(
        *(F.count_if(F.col("role") == role).alias(f"{side}_alt") for side, role in ROLES.items()))
    # ties go to the change whose text sorts first
    best = seen.groupBy(*keys).agg(
        F.min(F.struct((-(F.col("n_alt") + F.col("t_alt"))).alias("_by"), "indel", "n_alt", "t_alt")).alias("_b"))
    sites = best.select(*keys, "_b.indel", "_b.n_alt", "_b.t_alt")
    depth = {side: " + ".join(_count(side, b, s) for b in BASES for s in "fr") for side in ROLES}
    depths = pile.select(*keys, *(F.expr(e).cast("bigint").alias(f"{side}_depth") for side, e in depth.items()))
    at = F.col("pos") - 1
    joined = sites.join(depths, keys).withColumn("block", F.floor(at / width)).join(
        blocks.select("chrom", "block", "bases"), ["chrom", "block"])
    offset = (at % width + 1).cast("int")
    first = F.substring("bases", offset, F.lit(1))
    gone = F.col("indel").startswith("-")
    lost = F.substring("bases", offset, F.when(gone, F.substring("indel", 2, 10)).otherwise("0").cast("int") + 1)
    return joined.select(
        *keys,
        F.when(gone, lost).otherwise(first).alias("ref"),
        F.when(gone, first).otherwise(F.concat(first, F.expr("substring(indel, 2)"))).alias("alt"),
        F.greatest(F.col("n_depth") - F.col("n_alt"), F.lit(0)).alias("n_ref"), "n_alt",
        F.greatest(F.col("t_depth") - F.col("t_alt"), F.lit(0)).alias("t_ref"), "t_alt",
        "n_depth", "t_depth",
    )


# ---- calls -------------------------------------------------------------------------------


def genotype(alt: Column, depth: Column, params: SomaticParams, purity: float) -> Column:
    """``hom``, ``het`` or ``ref`` by alternate frequency."""
    return (F.when(at_least(alt, depth, params.min_freq_for_hom * purity), "hom")
            .when(at_least(alt, depth, params.min_var_freq * purity), "het").otherwise("ref"))


def variant_p(ref: str, alt: str) -> Column:
    """Upper Fisher tail of the pooled counts against one expected error per 1000 reads."""
    depth = f"({ref} + {alt})"
    return hypergeometric_tail(alt, depth, f"{depth} div 1000 + {alt}", f"2 * {depth}")


def call_somatic(counts: DataFrame, params: SomaticParams = SomaticParams()) -> DataFrame:
    """Status and p values per locus.

    Works on narrow columns in the partitions of the allele counts: no shuffle, no join.
    Tests are computed for loci that pass coverage and have a variant on some side.
    p is rounded to 9 digits before it meets a threshold.
    """
    n_alt, t_alt, n_depth, t_depth = (F.col(c) for c in ("n_alt", "t_alt", "n_depth", "t_depth"))
    covered = counts.where(
        (n_depth >= params.min_coverage_normal) & (t_depth >= params.min_coverage_tumor)
        & (n_depth + t_depth >= params.min_coverage) & F.col("alt").isNotNull())
    typed = computed(covered, n_gt=genotype(n_alt, n_depth, params, params.normal_purity),
                     t_gt=genotype(t_alt, t_depth, params, params.tumor_purity))
    tested = computed(
        typed.where("n_gt <> 'ref' or t_gt <> 'ref'"),
        somatic_p=F.round(fisher_one_tailed("n_ref", "n_alt", "t_ref", "t_alt"), 9),
        variant_p=F.round(variant_p("(n_ref + t_ref)", "(n_alt + t_alt)"), 9))
    shifted = F.col("n_gt") != F.col("t_gt")
    somatic = shifted & (F.col("somatic_p") <= params.somatic_p_value)
    status = (
        F.when(~shifted, "Germline")
        .when(somatic & (F.col("n_gt") == "ref"), "Somatic")
        .when(somatic & (F.col("n_gt") == "het"), "LOH")
        .when(somatic, "Unknown")
        .when(F.col("variant_p") <= params.p_value, "Germline")
    )
    return tested.withColumn("status", status).where("status is not null")


def process_somatic(calls: DataFrame, params: ProcessParams = ProcessParams()) -> DataFrame:
    """Add ``hc``, whether a call is in the high-confidence subset of its class."""
    n_alt, t_alt, n_depth, t_depth = (F.col(c) for c in ("n_alt", "t_alt", "n_depth", "t_depth"))
    tumor_seen = at_least(t_alt, t_depth, params.min_tumor_freq)
    normal_seen = at_least(n_alt, n_depth, params.min_tumor_freq)
    sure = F.col("somatic_p") <= params.p_value
    hc = (
        F.when(F.col("status") == "Somatic",
               tumor_seen & at_most(n_alt, n_depth, params.max_normal_freq) & sure)
        .when(F.col("status") == "LOH", normal_seen & sure)
        .when(F.col("status") == "Germline",
              normal_seen & tumor_seen & (F.col("variant_p") <= params.p_value))
        .otherwise(False)
    )
    return calls.withColumn("hc", hc)


def route_variant_kind(calls: DataFrame) -> DataFrame:
    """Add ``kind`` (snp or indel) and the per-sample, per-chromosome output name."""
    kind = F.when(F.length("ref") == F.length("alt"), "snp").otherwise("indel")
    return calls.withColumn("kind", kind).withColumn(
        "file", F.concat(F.col("sample"), F.lit("_"), F.col("chrom"), F.lit("."), F.col("kind"), F.lit(".vcf")))
