"""Shards of nearly equal bytes by sampled splitters.

Rows are ordered by a hash of the text, then of the id: equal texts stand together and shards are
random mixtures. A sample of the keys, drawn with chances that grow with a row's weight, gives
splitters at quantiles of the weight; rows go to the ranges between splitters, and ranges that turn
out overfull are sampled again by themselves and subdivided, so that a hot text, or a hot row, is
cut as often as it takes (a row number breaks ties between equal rows). Measured range totals
turn into positions on a line of all bytes, and a shard is an equal part of that line.

A group of equal texts of at most 1 / ``WHOLE_PART`` of a shard stays in one shard and goes where its
middle lies; the rows of a larger one are dealt by their own middles. Positions are exact, so
shards do not depend on the sample: it only says which rows a task sorts. Only splitters and
range totals, of which there are at most a few times ``MAX_RANGES``, reach the driver or are broadcast.

Cases: a null text has no bytes, like an empty one, and the same hash; a null id is ordered as the
empty text; repeated rows are separate rows of one group, interchangeable; a text longer than a shard
overfills it alone; an empty table gives an empty result; further columns are carried by
``write_shards`` in a struct, so no name of theirs can clash.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variloom.llm.tables import pick, settle, spare

#: Ranges asked for: one for each ROWS_PER_RANGE rows within these bounds; samples for each of them.
MIN_RANGES, MAX_RANGES, ROWS_PER_RANGE, SAMPLES = 2048, 16_384, 1 << 20, 8
#: A range is overfull beyond so many times its share.
OVERFULL = 2
#: Groups of equal texts stay whole up to this part of a shard.
WHOLE_PART = 64

_FIRST = -(1 << 63)
_KEY = ("h", "g", "salt")


def _hash(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _chance(seed: int) -> Column:
    """A uniform number from 0 to 1 that a row keeps in every run of its task."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *_KEY), 11) / float(1 << 53)


def _drawn(rows: DataFrame, weight: Column, step: float, seed: int) -> list[tuple]:
    """Keys at each ``step`` of the weight, by a weighted sample of about SAMPLES keys a step."""
    each = step / SAMPLES
    sample = (rows.select(*_KEY, weight.alias("w")).where(_chance(seed) * each < F.col("w"))
              .select(*_KEY, F.greatest("w", F.lit(each)).alias("w")))
    # the sample is bounded: SAMPLES keys for each range
    upto = F.sum("w").over(Window.partitionBy().orderBy(*_KEY))
    stood = sample.select(*_KEY, "w", upto.alias("upto"))
    return [tuple(r) for r in stood.where(F.floor(F.col("upto") / step) > F.floor((F.col("upto") - F.col("w")) / step)).select(*_KEY).collect()]


def _tidy(cuts: set[tuple]) -> list[tuple]:
    """Splitters in order; a text with one splitter is cut before its first row, one with several there as well."""
    by_text: dict[int, list[tuple]] = {}
    for cut in cuts:
        by_text.setdefault(cut[0], []).append(cut)
    whole = {(h, _FIRST, _FIRST) for h in by_text}
    return sorted(whole | {cut for own in by_text.values() if len(own) > 1 for cut in own})


def _range(cuts: list[tuple]) -> Column:
    """How many splitters lie at or below a row's key, by halving."""
    if not cuts:
        return F.lit(0)
    kind = "array<struct<h: bigint, g: bigint, salt: bigint>>"
    bounds = F.from_json(F.lit(json.dumps([dict(zip(_KEY, cut)) for cut in cuts])), kind)
    steps = F.array(*(F.lit(1 << s) for s in reversed(range(len(cuts).bit_length()))))
    key = F.struct(*_KEY)
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(bounds, low + step - 1) <= key, low + step).otherwise(low))


def _ranges(rows: DataFrame, total: int, count: int) -> tuple[list[tuple], DataFrame]:
    """Splitters under which no range that can be cut is overfull, and the ranges' totals."""
    # half of a row's weight is its share of the bytes, half its share of the rows: a task sorts rows
    weight = F.col("size") / float(max(total, 1)) + F.lit(1.0 / max(count, 1))
    step = 2.0 / min(MAX_RANGES, max(MIN_RANGES, count // ROWS_PER_RANGE))
    found, seed = set(_drawn(rows, weight, step, 0)), 0
    while True:
        cuts = _tidy(found)
        ranged = rows.withColumn("range", _range(cuts))
        totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.sum(weight).alias("w"))
        totals = settle(totals, "ranges")
        over = [r["range"] for r in totals.where((F.col("n") > 1) & (F.col("w") > OVERFULL * step)).select("range").collect()]
        seed += 1
        more = set(_drawn(ranged.where(F.col("range").isin(over)), weight, step / 2, seed)) - found if over else set()
        if not more:
            return cuts, totals
        found |= more


def place(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id``, ``size`` (bytes and one), ``text_crc32``, ``shard`` and ``slot`` of every row.

    ``carry`` adds the whole input row as struct ``row``.
    """
    row = ["row"] if carry else []
    bare = pick(docs.select("*", F.struct("*").alias(spare(docs, "row"))), doc_id=doc_id, text=text, row=spare(docs, "row")) if carry else pick(docs, doc_id=doc_id, text=text)
    body = F.coalesce("text", F.lit(""))
    keyed = bare.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
                        _hash(body).alias("h"), _hash(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("g"),
                        F.monotonically_increasing_id().alias("salt"), *row)
    rows = settle(keyed, "keys")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    cuts, totals = _ranges(rows, total, count)
    before = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranged = rows.withColumn("range", _range(cuts)).join(F.broadcast(starts), "range")
    upto = Window.partitionBy("range").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumns({"at": F.sum("size").over(upto) - F.col("size") + F.col("start"), "rank": F.row_number().over(upto) - 1 + F.col("first")})
    group = Window.partitionBy("range", "h")
    placed = placed.withColumns({"group_at": F.min("at").over(group), "group_size": F.sum("size").over(group)})
    # texts with several splitters lie in several ranges; the first of those starts with them
    several = sorted({a[0] for a, b in zip(cuts, cuts[1:]) if a[0] == b[0]})
    if several:
        large = (ranged.where(F.col("h").isin(several)).groupBy("h")
                 .agg(F.sum("size").alias("large_size"), F.min("start").alias("large_at")))
        placed = placed.join(F.broadcast(large), "h", "left").withColumns(
            {"group_at": F.coalesce("large_at", "group_at"), "group_size": F.coalesce("large_size", "group_size")})
    whole = F.col("group_size") * (WHOLE_PART * shards) <= total
    twice = F.when(whole, 2 * F.col("group_at") + F.col("group_size")).otherwise(2 * F.col("at") + F.col("size"))
    shard = F.expr(f"int((twice * {shards}) div {max(2 * total, 1)})")
    done = settle(placed.withColumn("twice", twice).select("doc_id", "size", "text_crc32", shard.alias("shard"), "rank", *row), "placed")
    first = done.groupBy("shard").agg(F.min("rank").alias("first"))
    return (done.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).cast("long").alias("slot"), *row))


def write_shards(docs: DataFrame, path: str, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> None:
    """Whole rows as Parquet, a folder ``shard=k`` for each shard, in the order of slots within a file."""
    placed = place(docs, shards, doc_id, text, carry=True)
    placed.select("shard", "slot", "row").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
