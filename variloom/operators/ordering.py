"""Order-dependent logic without a one-task global window.

A running number or sum over a whole table is split in two: rows are put into ranges of
the order key, each range is numbered on its own, and the ranges' totals (at most
``MAX_RANGES`` rows) are added up to give every range its start. The cut points come from a sample of the
keys and become literals; rows are exchanged once, on their range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 4096
#: Keys of the sample that cut points are taken from, and its seed.
SAMPLE_KEYS, SEED = 4 * MAX_RANGES, 17


def _sample(df: DataFrame, order: str) -> list[tuple]:
    """Keys with the smallest hashes, at most ``SAMPLE_KEYS``, with their hash as a number from 0 to 1.

    Rows are thinned out by the planner's size of the input first, far less than the sample allows; if that
    was too much the pass is run again without.
    """
    planned = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), order), 11) / float(1 << 53)
    hashed = df.where(F.col(order).isNotNull()).select(F.col(order).alias("k"), chance.alias("h"))
    # a key of an order takes 8 bytes, so there are no more rows than this unless files are packed very tightly
    least = min(1.0, 256 * SAMPLE_KEYS / max(planned / 8, 1)) if planned < 1 << 60 else 1.0
    drawn = hashed.where(F.col("h") < least).orderBy("h").limit(SAMPLE_KEYS).collect()
    if len(drawn) < SAMPLE_KEYS and least < 1:
        drawn = hashed.orderBy("h").limit(SAMPLE_KEYS).collect()
    return [tuple(r) for r in drawn]


def range_cuts(df: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> list:
    """Cut points that split ``df`` into ranges of at most about ``rows_per_range`` rows by ``order``.

    There are at least as many ranges as shuffle partitions. ``order`` is a numeric column without many ties.
    The sample that reaches the driver has at most ``SAMPLE_KEYS`` keys; how densely it covers the hashes tells the number of rows.
    """
    drawn = _sample(df, order)
    if not drawn:
        return []
    rows = len(drawn) if len(drawn) < SAMPLE_KEYS else SAMPLE_KEYS / max(h for _, h in drawn)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(partitions, math.ceil(rows / rows_per_range)))
    keys = sorted(k for k, _ in drawn)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)})


def range_of(key: Column, cuts: list) -> Column:
    """Number of cut points at or below ``key``, found by halving."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*(F.lit(c) for c in cuts))
    steps = F.array(*(F.lit(1 << s) for s in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(
        steps, F.lit(0),
        lambda low, step: F.when(F.get(bounds, low + step - 1) <= key, low + step).otherwise(low))


def _with_range(df: DataFrame, order: str, rows_per_range: int) -> tuple[DataFrame, int]:
    """``df`` with its ``_range`` by ``order``, never null, and the number of partitions to deal ranges to."""
    cuts = range_cuts(df, order, rows_per_range)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("_range", F.coalesce(range_of(F.col(order), cuts), F.lit(0))), max(len(cuts) + 1, partitions)


def running_totals(df: DataFrame, order: str, sums: dict[str, Column],
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add running sums in ``order`` (a numeric column without ties) over the whole table.

    Rows are exchanged once; the ranges' totals read the summed columns only and add up before their exchange.
    """
    values = {f"_v_{name}": value.cast("bigint") for name, value in sums.items()}
    ranged, partitions = _with_range(df.withColumns(values), order, rows_per_range)
    before = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*(F.sum(v).alias(v) for v in values))
    # numbers only, one row per range, at most MAX_RANGES
    starts = totals.select("_range", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_s{v}") for v in values))
    upto = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.repartition(partitions, "_range").withColumns({f"_u{v}": F.sum(v).over(upto) for v in values})
    joined = local.join(F.broadcast(starts), "_range")
    return joined.select(*(c for c in df.columns if c not in sums), *((F.col(f"_u_v_{n}") + F.col(f"_s_v_{n}")).alias(n) for n in sums))


def row_index(df: DataFrame, order: str, name: str = "row_no",
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add the 1-based position of each row in ``order`` (a numeric column without ties)."""
    return running_totals(df, order, {name: F.lit(1)}, rows_per_range)


def with_next(df: DataFrame, order: str, name: str = "row_no", following: str = "following", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add each row's position ``name`` and the row after it as a struct, NULL at the end; ``order`` as in :func:`row_index`.

    The next row lies in the same range, or is the first one of the next range: an edge table of one row per range.
    Rows and edges both need the rows whole, as structs, and share one exchange.
    """
    ranged, partitions = _with_range(df, order, rows_per_range)
    ranged = ranged.select("_range", F.struct(*df.columns).alias("_row")).repartition(partitions, "_range")
    inside = Window.partitionBy("_range").orderBy(f"_row.{order}")
    local = ranged.withColumns({"_at": F.row_number().over(inside), "_next": F.lead("_row").over(inside)})
    edges = ranged.groupBy("_range").agg(F.count("*").alias("_n"), F.min_by("_row", f"_row.{order}").alias("_first"))
    along = Window.partitionBy().orderBy("_range")
    edges = edges.select("_range", F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                         F.lead("_first").over(along).alias("_edge"))
    return local.join(edges, "_range").select("_row.*", (F.col("_at") + F.col("_before")).alias(name), F.coalesce("_next", "_edge").alias(following))


def file_row_index(df: DataFrame, name: str = "row_no", per_file: bool = False) -> DataFrame:
    """Add the 1-based line position of rows just read from text files.

    File splits serve as ranges: a split's rows come in file order, and splits are ordered
    by path and start offset. ``per_file`` starts over in every file. Rows of a split have consecutive ids, so a split's
    first id and the rows before it place its rows: rows are neither sorted nor exchanged.
    """
    marked = _marked(df)
    before = Window.partitionBy(*(["_path"] if per_file else [])).orderBy("_path", "_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = marked.groupBy("_path", "_at").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    # one row per file split, fewer than the driver's list of files and splits takes
    starts = splits.select("_path", "_at", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    placed = marked.join(F.broadcast(starts), ["_path", "_at"])
    return placed.select(*df.columns, (F.col("_seq") + F.col("_shift")).alias(name))


def _marked(df: DataFrame) -> DataFrame:
    """Rows just read from files with their split, ``_path`` and ``_at``, and ``_seq``, rising inside it."""
    return df.withColumns({"_path": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start"), "_seq": F.monotonically_increasing_id()})


def split_running(marked: DataFrame, sums: dict[str, Column], scope: list[str]) -> DataFrame:
    """Running sums in file order over rows marked with ``_path``, ``_at`` and ``_seq``.

    Sums start over for each value of ``scope``, columns that are constant within a file.
    """
    flagged = marked.withColumns({f"_v_{n}": v.cast("bigint") for n, v in sums.items()})
    before = Window.partitionBy(*scope).orderBy("_path", "_at").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file split
    keys = [c for c in scope if c != "_path"]
    starts = (
        flagged.groupBy(*keys, "_path", "_at").agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums))
        .select("_path", "_at", *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}")
                                  for n in sums)))
    upto = Window.partitionBy("_path", "_at").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    local = flagged.withColumns({n: F.sum(f"_v_{n}").over(upto) for n in sums})
    joined = local.join(starts, ["_path", "_at"])
    return joined.withColumns({n: F.col(n) + F.col(f"_s_{n}") for n in sums}).drop(
        *(f"_v_{n}" for n in sums), *(f"_s_{n}" for n in sums))


def numbered(df: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """Report rows with their number ``row_no``; ``limit`` keeps the first rows only."""
    return row_index(df if limit is None else df.orderBy(order).limit(limit), order)


def first_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """First row per key in ``order``. Spark drops later rows before the shuffle."""
    return _one_per_key(df, key, F.col(order).asc())


def last_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Last row per key in ``order``. Spark drops earlier rows before the shuffle."""
    return _one_per_key(df, key, F.col(order).desc())


def _one_per_key(df: DataFrame, key: str | list[str], order: Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.where("_rank = 1").drop("_rank")


def first_and_last(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``first_file`` and ``last_file`` per key, the values of its first and last row, in one aggregation."""
    return df.groupBy(key).agg(F.min_by(value, order).alias("first_file"), F.max_by(value, order).alias("last_file"))


def insert_ignore(target: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``new`` to append: keys not in ``target``, the first row of each key."""
    return first_per_key(new, key, order).join(target.select(key).distinct(), key, "left_anti")
