"""Operators on aligned reads: names, filters, statistics, order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from variloom.functions.chrom import chrom_rank, normalize_chrom
from variloom.operators.ordering import ROWS_PER_RANGE, range_cuts, range_of

# SAM flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED = 1, 2, 4, 8
REVERSE, READ1, READ2, SECONDARY = 16, 64, 128, 256
QC_FAIL, DUPLICATE, SUPPLEMENTARY = 512, 1024, 2048

#: Reads left out of a pileup.
EXCLUDED = UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE


#: Bases of a genome bin in the sweep for depth.
BIN = 1 << 20

#: What a read's place in genome order is made of.
_PLACE = [("rank", pa.int64()), ("chrom", pa.string()), ("pos", pa.int64())]


def has(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def reheader(reads: DataFrame, col: str = "raw_chrom") -> DataFrame:
    """Add ``chrom``, the prefixed reference name."""
    return reads.withColumn("chrom", normalize_chrom(F.col(col)))


def any_renamed(df: DataFrame, col: str = "raw_chrom") -> DataFrame:
    """Whether any reference name changes, and how many rows do."""
    changed = normalize_chrom(F.col(col)) != F.col(col)
    return df.agg(F.bool_or(changed).alias("renamed"), F.count_if(changed).alias("renamed_rows"))


def flagstat(reads: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Flag statistics in one pass, with a row for passed and one for failed QC."""
    flag = F.col("flag")
    primary = ~has(flag, SECONDARY) & ~has(flag, SUPPLEMENTARY)
    mapped = ~has(flag, UNMAPPED)
    paired = primary & has(flag, PAIRED)
    return reads.groupBy(*(by or []), has(flag, QC_FAIL).alias("qc_fail")).agg(
        F.count("*").alias("total"),
        F.count_if(has(flag, SECONDARY)).alias("secondary"),
        F.count_if(~has(flag, SECONDARY) & has(flag, SUPPLEMENTARY)).alias("supplementary"),
        F.count_if(has(flag, DUPLICATE)).alias("duplicates"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(paired).alias("paired"),
        F.count_if(paired & has(flag, READ1)).alias("read1"),
        F.count_if(paired & has(flag, READ2)).alias("read2"),
        F.count_if(paired & has(flag, PROPER) & mapped).alias("proper"),
        F.count_if(paired & mapped & ~has(flag, MATE_UNMAPPED)).alias("both_mapped"),
        F.count_if(paired & mapped & has(flag, MATE_UNMAPPED)).alias("singletons"),
    )


def coverage_stats(reads: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Depth mean, median and maximum per reference over covered positions.

    ``reads`` has one row per aligned base: one-base reads, or the rows with a base that
    :func:`variloom.operators.somatic.expand_alignment` gives.
    Positions are counted first and then folded to a depth histogram, so the exact median
    needs one row per distinct depth and not one per position.
    """
    group = [*(by or []), "chrom"]
    depth = reads.groupBy(*group, "pos").agg(F.count("*").alias("depth"))
    return _depth_stats(depth.groupBy(*group, "depth").agg(F.count("*").alias("positions")), group)


def _depth_stats(histogram: DataFrame, group: list[str]) -> DataFrame:
    """Statistics from the number of ``positions`` of each ``depth``."""
    return histogram.groupBy(*group).agg(
        F.sum("positions").alias("positions"),
        (F.sum(F.col("depth") * F.col("positions")) / F.sum("positions")).alias("mean_depth"),
        F.percentile("depth", F.lit(0.5), F.col("positions")).alias("median_depth"),
        F.max("depth").alias("max_depth"),
    )


def depth_segments(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stretches of equal depth, ``start`` up to before ``end``, from covered runs (``chrom``, ``start``, ``size``).

    A sweep over events, +1 where runs start and -1 where they end, added up by place before the shuffle. Genome
    bins of ``BIN`` bases are swept on their own; each takes up the depth that the sums of the bins before it leave, and
    its last stretch reaches to the first event of the next bin that has one. Rows follow the runs, not their bases.
    """
    group = [*(by or []), "chrom"]
    ends = F.array(F.struct(F.col("start").cast("bigint").alias("at"), F.lit(1).alias("d")),
                   F.struct((F.col("start") + F.col("size")).cast("bigint").alias("at"), F.lit(-1).alias("d")))
    events = runs.where("size > 0").select(*group, F.inline(ends)).groupBy(*group, "at").agg(F.sum("d").alias("d"))
    # the join below takes nulls out of each side in its own way; taken out here, both sides read one exchange
    placed = reduce(and_, (F.col(c).isNotNull() for c in [*group, "at"]))
    events = events.where(placed).withColumn("bin", F.coalesce(F.floor(F.col("at") / BIN), F.lit(0))).repartition(*group, "bin")
    bins = events.groupBy(*group, "bin").agg(F.sum("d").alias("sum"), F.min("at").alias("first"))
    along = Window.partitionBy(*group).orderBy("bin")
    # one row per bin that has an event
    bins = bins.select(*group, "bin", F.coalesce(F.sum("sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carried"),
                       F.lead("first").over(along).alias("next"))
    inside = Window.partitionBy(*group, "bin").orderBy("at")
    swept = events.withColumns({"depth": F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "to": F.lead("at").over(inside)})
    return swept.join(bins, [*group, "bin"]).select(
        *group, F.col("at").alias("start"), F.coalesce("to", "next").alias("end"), (F.col("depth") + F.col("carried")).alias("depth")).where("depth > 0")


def coverage_runs(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """:func:`coverage_stats` of reads of any length, from the runs they cover."""
    group = [*(by or []), "chrom"]
    segments = depth_segments(runs, by)
    return _depth_stats(segments.groupBy(*group, "depth").agg(F.sum(F.col("end") - F.col("start")).alias("positions")), group)


def usable_reads(reads: DataFrame, min_mapq: int = 1) -> DataFrame:
    """Reads that count in a pileup."""
    return reads.where((F.col("mapq") >= min_mapq) & ~has(F.col("flag"), EXCLUDED))


def header_order(header: DataFrame) -> DataFrame:
    """``chrom`` and ``rank`` of the references of SAM header lines, in the order of the file's ``@SQ`` lines.

    Of a reference named twice, or in several files, the first line counts. One row per reference of the genome.
    """
    named = header.where("tag = 'SQ'").select(normalize_chrom(F.col("raw_chrom")).alias("chrom"), "line_no")
    first = named.groupBy("chrom").agg(F.min("line_no").alias("line_no"))
    return first.select("chrom", F.row_number().over(Window.partitionBy().orderBy("line_no")).alias("rank"))


def coordinate_sort(reads: DataFrame, tie: list[str], order: DataFrame | None = None) -> DataFrame:
    """Reads in genome order, or in that of ``order`` (see :func:`header_order`): references it lacks come after, by name, reads without one last.

    ``tie`` columns make the sort key unique, so the range partitioning can also split a
    position that holds very many reads. The rank is a column of its own, so it is
    computed once per read and not in every comparison.
    """
    if order is None:
        ranked = reads.withColumn("_rank", chrom_rank(F.col("chrom")))
    else:
        given = order.select(F.col("chrom").alias("_name"), F.col("rank").alias("_given"))
        placed = F.coalesce(F.col("chrom"), F.lit("*")) != "*"
        ranked = reads.join(given, F.col("chrom") == F.col("_name"), "left").withColumn(
            "_rank", F.coalesce("_given", F.when(placed, 2**30).otherwise(2**30 + 1))).drop("_name", "_given")
    return ranked.orderBy("_rank", "chrom", "pos", *tie).drop("_rank")


def is_sorted(reads: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row: whether reads, taken in ``order``, are coordinate sorted, and the inversions.

    Neighbours are compared inside ranges of ``order``; the ranges' first and last rows
    cover the steps between ranges.
    """
    # the key of coordinate_sort: references of one rank are told apart by name
    place = F.struct(chrom_rank(F.col("chrom")).alias("rank"), F.col("chrom").alias("chrom"), F.col("pos").alias("pos"))
    slim = reads.select(F.col(order).alias("_o"), place.alias("_p"))
    cuts = range_cuts(slim, "_o", rows_per_range)
    ranged = slim.withColumn("_range", range_of(F.col("_o"), cuts))
    previous = F.lag("_p").over(Window.partitionBy("_range").orderBy("_o"))
    inside = ranged.withColumn("_bad", (previous > F.col("_p")).cast("int")).groupBy("_range").agg(
        F.sum("_bad").alias("bad"), F.min_by("_p", "_o").alias("first"), F.max_by("_p", "_o").alias("last"))
    edge = (F.lag("last").over(Window.partitionBy().orderBy("_range")) > F.col("first")).cast("int")
    counted = inside.withColumn("edge", edge).agg(
        F.sum(F.coalesce("bad", F.lit(0)) + F.coalesce("edge", F.lit(0))).alias("inversions"))
    return counted.select((F.col("inversions") == 0).alias("is_sorted"), "inversions")


def split_edges(reads: DataFrame) -> DataFrame:
    """One row per file split of reads just read from files: inversions inside, first and last place.

    Rows are compared in the order in which a task reads them, so nothing is shuffled. ``path`` and ``at`` name the split.
    """
    slim = reads.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                        chrom_rank(F.col("chrom")).cast("bigint").alias("rank"), F.col("chrom"), F.col("pos").cast("bigint").alias("pos"))
    out = pa.schema([("path", pa.string()), ("at", pa.int64()), ("bad", pa.int64()), *((f"{e}_{c}", t) for e in ("first", "last") for c, t in _PLACE)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits: dict[tuple, list] = {}
        for batch in batches:
            path, at, rank, pos = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
            chrom = batch.column(3).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((path[1:] != path[:-1]) | (at[1:] != at[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(path)]):
                if low == high:
                    continue
                r, c, p = rank[low:high], chrom[low:high], pos[low:high]
                same = r[1:] == r[:-1]
                # names are compared only where two references have one rank
                after = np.zeros(len(same), bool)
                after[same] = [a > b for a, b in zip(c[:-1][same], c[1:][same])]
                level = same & (c[1:] == c[:-1])
                bad = int(((r[1:] < r[:-1]) | after | level & (p[1:] < p[:-1])).sum())
                first, last = (int(r[0]), c[0], int(p[0])), (int(r[-1]), c[-1], int(p[-1]))
                held = splits.get((path[low], at[low]))
                if held is None:
                    splits[path[low], at[low]] = [bad, first, last]
                else:
                    held[0] += bad + (held[2] > first)
                    held[2] = last
        rows = [(path, int(at), bad, *first, *last) for (path, at), (bad, first, last) in splits.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)] if rows else [pa.array([], f.type) for f in out], schema=out)

    kinds = ", ".join(f"{e}_{c} {'string' if c == 'chrom' else 'bigint'}" for e in ("first", "last") for c, _ in _PLACE)
    return slim.where("chrom is not null and pos is not null").mapInArrow(walk, f"path string, at bigint, bad bigint, {kinds}")


def is_sorted_files(reads: DataFrame) -> DataFrame:
    """:func:`is_sorted` of reads just read from files, in the order of paths and lines, without a shuffle of reads.

    Reads without a reference or position are passed over.
    """
    def place(end: str) -> Column:
        return F.struct(*(F.col(f"{end}_{c}") for c, _ in _PLACE))

    # one row per file split
    before = F.lag(place("last")).over(Window.partitionBy().orderBy("path", "at"))
    edges = split_edges(reads).withColumn("edge", F.coalesce(before > place("first"), F.lit(False)).cast("int"))
    counted = edges.agg(F.coalesce(F.sum(F.col("bad") + F.col("edge")), F.lit(0)).alias("inversions"))
    return counted.select((F.col("inversions") == 0).alias("is_sorted"), "inversions")


def sort_if_needed(reads: DataFrame, order: str, tie: list[str]) -> DataFrame:
    """Reads in genome order; the sort is skipped when ``order`` already gives it."""
    if is_sorted(reads, order).first()["is_sorted"]:
        return reads
    return coordinate_sort(reads, tie)
