"""Tumor/normal pairing, routing, lookups and cohort counts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from variloom.functions.barcode import bucket_of, cancer_type, parse_barcode, sample_key
from variloom.functions.chrom import CHROMOSOMES, REFERENCE_SUFFIX, ref_file
from variloom.operators.ordering import with_next

# Cancer codes reported even when nothing was counted for them.
CANCER_CODES = ["BLCA", "BRCA", "CESC", "COAD", "DLBC", "ESCA", "GBM", "HNSC", "KICH", "KIRC",
                "KIRP", "LAML", "LGG", "LIHC", "LUAD", "LUSC", "OV", "PRAD", "READ", "SARC",
                "SKCM", "STAD", "THCA", "UCEC", "UVM"]

#: Manifest columns that go to one side of a pair, by the name they get there.
SIDE_FIELDS = {
    "barcode": "barcode", "file": "file_name", "gdc_id": "file_gdc_id", "file_url": "file_gcs_url",
    "file_size": "file_size", "platform": "platform",
}
SIDES = ("tumor", "normal")
#: Characters of the grams by which ids are found in lines.
GRAM = 8
PAIR_COLUMNS = (["index", "case_id"] + [f"{side}_{field}" for side in SIDES for field in SIDE_FIELDS]
                + ["cancer_type", "total_size"])


def _side(df_role: Column, side: str) -> Column:
    fields = F.struct(*(F.col(src).alias(f"{side}_{dst}") for dst, src in SIDE_FIELDS.items()))
    return F.when(df_role == side, fields)


def _total_size() -> Column:
    return F.coalesce(F.col("tumor_file_size"), F.lit(0)) + F.coalesce(F.col("normal_file_size"), F.lit(0))


def pair_adjacent(manifest: DataFrame, order: str) -> DataFrame:
    """Pair rows 1-2, 3-4, ... of the manifest in ``order``.

    The first row sets case and cancer type; each row fills the side of its role, a second
    row of the same role replacing the first. A side without a row is NULL.
    """
    # a pair's second row is the next one: rows are exchanged once, by ranges of the order
    numbered = with_next(parse_barcode(manifest), order, "_place", "_following")
    second = F.col("_following")
    own, other = F.struct(*(F.col(c) for c in ("role", *SIDE_FIELDS.values()))), F.struct(*(second[c].alias(c) for c in ("role", *SIDE_FIELDS.values())))
    firsts = numbered.where("_place % 2 = 1")
    return firsts.select(
        F.floor((F.col("_place") - 1) / 2).alias("index"), "case_id", cancer_type(F.col("project_short_name")).alias("cancer_type"),
        *(F.when(second["role"] == side, other).when(F.col("role") == side, own)[src].alias(f"{side}_{dst}") for side in SIDES for dst, src in SIDE_FIELDS.items()),
        F.when(second.isNull(), F.col("barcode")).otherwise(second["barcode"]).alias("last_barcode")).withColumn("total_size", _total_size())


def pair_by_case(manifest: DataFrame, order: str, pick: str = "first") -> DataFrame:
    """Pair a case's tumor files with its normal file.

    ``first`` gives one row per case: its first tumor and first normal in ``order``;
    ``each`` pairs every tumor file with the case's first normal. One normal per case keeps
    a case with very many files linear.
    """
    parsed = parse_barcode(manifest).withColumn("cancer_type", cancer_type(F.col("project_short_name")))
    role = F.col("role")

    def first_side(side: str) -> Column:
        return F.min_by(_side(role, side), F.when(role == side, F.col(order)))

    if pick == "first":
        grouped = parsed.groupBy("case_id").agg(
            F.min_by("cancer_type", order).alias("cancer_type"),
            *(first_side(side).alias(f"_{side}") for side in SIDES))
        both = grouped.where("_tumor is not null and _normal is not null")
    elif pick == "each":
        normals = parsed.where(role == "normal").groupBy("case_id").agg(first_side("normal").alias("_normal"))
        tumors = parsed.where(role == "tumor").select("case_id", "cancer_type", _side(role, "tumor").alias("_tumor"))
        both = tumors.join(normals, "case_id")
    else:
        raise ValueError("pick must be 'first' or 'each'")
    return both.select("case_id", "cancer_type", "_tumor.*", "_normal.*").withColumn(
        "total_size", _total_size())


def pair_mismatches(pairs: DataFrame, mode: str = "intended") -> DataFrame:
    """Pairs whose two samples are of different cases or lack a side.

    ``parity`` compares the second row with the normal side, so a pair whose second row is
    the normal always matches.
    """
    normal_case = F.substring_index("normal_barcode", "-", 3)
    other = "tumor_barcode" if mode == "intended" else "last_barcode"
    same = F.substring_index(other, "-", 3) == normal_case
    return pairs.where(~F.coalesce(same, F.lit(False)))


def _keys(ids: DataFrame, key: str = "case_id") -> DataFrame:
    """Distinct keys: an id listed very often is folded before it meets the join."""
    return ids.select(key).distinct()


class Routed(NamedTuple):
    finished: DataFrame
    failed: DataFrame
    to_run: DataFrame


def route(pairs: DataFrame, finished_ids: DataFrame, failed_ids: DataFrame,
          exclude_failed: bool = False) -> Routed:
    """Split pairs by finished and failed case ids.

    Failed pairs are recorded and tried again, unless ``exclude_failed``.
    """
    done, tried = _keys(finished_ids), _keys(failed_ids)
    finished = pairs.join(done, "case_id", "left_semi")
    to_run = pairs.join(done, "case_id", "left_anti")
    failed = to_run.join(tried, "case_id", "left_semi")
    if exclude_failed:
        to_run = to_run.join(tried, "case_id", "left_anti")
    return Routed(finished, failed, to_run)


def rebuild_queue(to_run: DataFrame, processing_ids: DataFrame) -> DataFrame:
    """Pairs to queue: those to run that are not in progress."""
    return to_run.join(_keys(processing_ids), "case_id", "left_anti")


def seed_state(pairs: DataFrame, finished_ids: DataFrame, failed_ids: DataFrame,
               processing_ids: DataFrame, add_finished: bool = True) -> DataFrame:
    """Finished, failed and queued pairs in one table with a ``state`` column.

    One pass over the pairs: each is flagged against the three id lists and yields a row
    per state it belongs to. Failed pairs are queued as well.
    """
    flagged = pairs
    for name, ids in (("finished", finished_ids), ("failed", failed_ids), ("processing", processing_ids)):
        flags = _keys(ids).withColumn(f"_{name}", F.lit(True))
        flagged = flagged.join(flags, "case_id", "left")
    done = F.col("_finished").isNotNull()
    states = F.array_compact(F.array(
        F.when(done & F.lit(add_finished), "finished"),
        F.when(~done & F.col("_failed").isNotNull(), "failed"),
        F.when(~done & F.col("_processing").isNull(), "queued"),
    ))
    return flagged.withColumn("state", F.explode(states)).drop("_finished", "_failed", "_processing")


def lookup_strict(df: DataFrame, dim: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Add ``value`` by ``key``; the last duplicate wins and a missing key is an error."""
    last = dim.groupBy(key).agg(F.max_by(value, order).alias(value))
    found = df.join(last, key, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {value} for "), F.col(key)))
    return found.withColumn(value, F.when(F.col(value).isNull(), missing.cast("string")).otherwise(F.col(value)))


def lookup_first(pairs: DataFrame, dim: DataFrame, order: str) -> DataFrame:
    """Add ``new_tumor_url`` and ``new_normal_url`` by sample key; first match or empty."""
    first = dim.groupBy("sample_key").agg(F.min_by("url", order).alias("url"))
    out = pairs
    for side in SIDES:
        named = first.select(F.col("sample_key").alias(f"_{side}"), F.col("url").alias(f"new_{side}_url"))
        keyed = out.withColumn(f"_{side}", sample_key(F.col(f"{side}_barcode")))
        out = keyed.join(named, f"_{side}", "left").drop(f"_{side}")
    return out.fillna("", [f"new_{side}_url" for side in SIDES])


def repair_urls(pairs: DataFrame, new: DataFrame, order: str, mode: str = "intended") -> DataFrame:
    """Replace file URLs by those of a new list, by full barcode.

    ``intended`` repairs both sides. ``parity`` repairs only the side whose barcode comes
    first in the list. ``repaired_tumor`` and ``repaired_normal`` hold the URLs used.
    """
    first = new.groupBy("barcode").agg(F.min_by("url", order).alias("url"), F.min(order).alias("at"))
    out = pairs
    for side in SIDES:
        named = first.select(F.col("barcode").alias(f"{side}_barcode"),
                             F.col("url").alias(f"repaired_{side}"), F.col("at").alias(f"_at_{side}"))
        out = out.join(named, f"{side}_barcode", "left")
    if mode == "parity":
        tumor_at, normal_at = F.col("_at_tumor"), F.col("_at_normal")
        tumor_wins = normal_at.isNull() | (tumor_at <= normal_at)
        normal_wins = tumor_at.isNull() | (normal_at < tumor_at)
        out = out.withColumns({
            "repaired_tumor": F.when(tumor_wins, F.col("repaired_tumor")),
            "repaired_normal": F.when(normal_wins, F.col("repaired_normal")),
        })
    return out.withColumns({
        f"{side}_file_url": F.coalesce(f"repaired_{side}", f"{side}_file_url") for side in SIDES
    }).drop("_at_tumor", "_at_normal")


def count_by_bucket(repaired: DataFrame) -> DataFrame:
    """Repaired URLs per bucket."""
    urls = repaired.select(F.explode(F.array_compact(F.array("repaired_tumor", "repaired_normal"))).alias("url"))
    return urls.groupBy(bucket_of(F.col("url")).alias("bucket")).agg(F.count("*").alias("n"))


def count_by_cancer(df: DataFrame, codes: list[str] | None = CANCER_CODES) -> DataFrame:
    """Rows per ``cancer_type``; ``codes`` are listed too if they have none."""
    counts = df.groupBy("cancer_type").agg(F.count("*").alias("n"))
    if codes is None:
        return counts
    listed = df.sparkSession.range(1).select(F.explode(F.array(*(F.lit(c) for c in codes))).alias("cancer_type"))
    return listed.join(counts, "cancer_type", "full").fillna(0, ["n"])


def _grams(text: Column, width: Column) -> Column:
    """All substrings of ``width`` characters, in order."""
    starts = F.when(F.length(text) >= width, F.sequence(F.lit(1), F.length(text) - width + 1))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda at: F.substring(text, at, width))


def _anchors(ids: DataFrame, key: str) -> DataFrame:
    """One ``gram`` for each distinct id: of its substrings of ``GRAM`` characters the one that fewest ids hold.

    A shorter id is its own gram. An id without characters has none.
    """
    own = ids.select(F.col(key).alias("_id")).where(F.length("_id") > 0).distinct()
    grams = own.select("_id", F.explode(F.array_distinct(_grams(F.col("_id"), F.least(F.length("_id"), F.lit(GRAM))))).alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("_n"))
    return grams.join(shared, "gram").groupBy("_id").agg(F.min_by("gram", F.struct("_n", "gram")).alias("gram"))


def contains_join(lines: DataFrame, ids: DataFrame, line: str = "line", key: str = "case_id") -> DataFrame:
    """Lines that hold an id anywhere, one row per line and id row; an empty id is in no line.

    Each id waits at an anchor, its rarest gram. A line's distinct grams meet the anchors as a hash of the line only;
    the few pairs found are then joined with the lines, and only those whose line does contain the id
    stay, so neither equal hashes nor common grams can add a row.
    """
    text = F.col(line)
    # at most GRAM different widths, fetched by the same query
    widths = ids.where(F.length(key) > 0).agg(F.collect_set(F.least(F.length(key), F.lit(GRAM)))).scalar()
    marked = lines.select(F.xxhash64(line).alias("_line"), widths.alias("_widths"), text.alias("_text"))
    grams = marked.select("_line", F.explode(F.array_distinct(F.flatten(F.transform("_widths", lambda w: _grams(F.col("_text"), w))))).alias("gram"))
    met = grams.join(_anchors(ids, key), "gram").select("_line", "_id").distinct()
    held = lines.drop(key).withColumn("_line", F.xxhash64(line)).join(met, "_line").where(F.contains(text, F.col("_id")))
    return held.drop("_line").withColumnRenamed("_id", key).join(ids, key)


def expand_units(pairs: DataFrame, references: list[str] | None = None) -> DataFrame:
    """One row per pair and reference with the derived per-reference file names."""
    names = references or [c + REFERENCE_SUFFIX for c in CHROMOSOMES]
    units = pairs.withColumn("reference", F.explode(F.array(*(F.lit(n) for n in names))))
    return units.withColumns({
        f"{side}_ref_file": ref_file(F.col(f"{side}_file"), F.col("reference")) for side in SIDES
    })


def pending_samples(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Samples that have no local result yet."""
    return ids.join(_keys(done, key), key, "left_anti")


def find_case(df: DataFrame, case: str) -> DataFrame:
    """Rows of one case."""
    return df.where(F.col("case_id") == case)


def write_ready(pairs: DataFrame, *extra: str) -> DataFrame:
    """The 16 pair columns in file order, ``total_size`` recomputed, and ``extra`` columns after them."""
    return pairs.withColumn("total_size", _total_size()).select(*PAIR_COLUMNS, *extra)
