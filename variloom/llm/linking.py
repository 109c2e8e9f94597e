"""From candidate buckets to connected groups, without listing the pairs of a bucket.

1. Every member of a bucket is compared with the bucket's smallest member; buckets of the same
   members count once, equal pairs of several buckets are compared once. Links give first components.
2. Where a bucket still has several components, its members of different components are compared
   in blocks of bounded size, inside tasks that return only the links of a spanning forest. Buckets
   that share members are not thrown together.

So any two members of one bucket end up in one component if their payloads are similar, and a
large group of near copies costs one comparison for each member that is like its smallest one;
only the rest is compared with the other components of its bucket.

An empty table of keys gives no components; a key with a null id is no harm, an id that repeats
under a key counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variloom.llm.components import components
from variloom.llm.tables import settle

#: Members of a block at most, apart from what hashing adds.
BLOCK_ROWS = 1024
#: Comparisons that one task of the second step should get.
TASK_PAIRS = 2_000_000


def link(keys: DataFrame, payloads: Callable[[DataFrame], DataFrame], similar: Callable[[Column, Column], Column],
         within: Callable[..., list[tuple[int, int]]], block_weight: int, several: bool = False) -> DataFrame:
    """Components (``node``, ``component``) of the ids in ``keys`` (``key`` long, ``id`` long) that have a link.

    ``payloads(ids)`` gives ``id``, ``payload`` and ``weight`` for a table of ids, ``similar`` says on two
    payload columns whether they link, ``within(sides, ids, comps, payloads)`` gives the links of a block
    between different components (of different sides if there are two); ``block_weight`` bounds a block.
    With ``several``, ``within`` takes a list of such blocks.
    """
    # a bucket is known by its members' hashes, so that of buckets with the same members one is left
    bucket = keys.where("id is not null").groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("same"))
    bucket = bucket.where("pivot < last").groupBy("pivot", "last", "n", "same").agg(F.min("key").alias("key"))
    member = settle(keys.join(bucket.select("key", "pivot", "n"), "key"), "members")
    star = settle(member.where("id != pivot").select("id", "pivot").distinct(), "star")
    ids = star.select("id").union(star.select(F.col("pivot").alias("id"))).distinct()
    body = settle(payloads(ids), "payload")
    left = star.join(body.select("id", F.col("payload").alias("mine")), "id")
    pairs = left.join(body.select(F.col("id").alias("pivot"), F.col("payload").alias("theirs")), "pivot")
    links = settle(pairs.where(similar(F.col("mine"), F.col("theirs"))).select("id", "pivot"), "links")
    first = settle(components(links), "first")
    more = _rest(member.where("n > 2").select("key", "id"), body, first, within if several else lambda blocks: [x for b in blocks for x in within(*b)], block_weight)
    if more.isEmpty():
        return first
    # second round on the first components' roots
    lifted = more
    for c in ("id", "pivot"):
        lifted = lifted.join(first.select(F.col("node").alias(c), F.col("component").alias(f"{c}_root")), c, "left")
    lifted = lifted.select(F.coalesce("id_root", "id").alias("id"), F.coalesce("pivot_root", "pivot").alias("pivot"))
    upper = settle(components(lifted), "upper")
    joined = first.join(upper.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    joined = joined.select("node", F.coalesce("top", "component").alias("component"))
    alone = upper.join(first.select("node"), "node", "left_anti")
    return joined.union(alone.select("node", "component"))


def _rest(member: DataFrame, body: DataFrame, first: DataFrame, within, block_weight: int) -> DataFrame:
    """Links between different first components inside one bucket."""
    rows = (member.join(first.select(F.col("node").alias("id"), F.col("component").alias("comp")), "id", "left")
            .select("key", "id", F.coalesce("comp", "id").alias("comp")))
    # a bucket of one component is done
    open_ = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("top")).where("low < top").select("key")
    rows = settle(rows.join(open_, "key").join(body.select("id", "weight"), "id")
                  .select("key", "comp", "id", (F.col("weight") / block_weight + 1.0 / BLOCK_ROWS).alias("load")), "open")
    unit = rows.groupBy("key", "comp").agg(F.sum("load").alias("load"))
    unit = unit.select("key", "comp", "load", F.when(F.col("load") >= 1, F.col("comp")).otherwise(-1).alias("unit"))
    parts = unit.groupBy("key", "unit").agg(F.ceil(F.sum("load")).cast("int").alias("parts"))
    placed = (rows.join(unit.select("key", "comp", "unit"), ["key", "comp"]).join(parts, ["key", "unit"])
              .select("key", "unit", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "comp"))
    placed = settle(placed, "placed")
    chunk = placed.groupBy("key", "unit", "part").agg(F.count("*").alias("n"))
    other = chunk.select("key", F.col("unit").alias("unit2"), F.col("part").alias("part2"), F.col("n").alias("n2"))
    later = F.struct("unit", "part") <= F.struct("unit2", "part2")
    block = chunk.join(other, "key").where(later & ((F.col("unit") != F.col("unit2")) | (F.col("unit") == -1)))
    alone = (F.col("unit") == F.col("unit2")) & (F.col("part") == F.col("part2"))
    block = settle(block.select("key", F.xxhash64("key", "unit", "part", "unit2", "part2").alias("tag"), (F.col("n") * F.col("n2")).alias("pairs"),
                                F.struct("unit", "part", F.lit(0).alias("side")).alias("a"),
                                F.when(~alone, F.struct(F.col("unit2").alias("unit"), F.col("part2").alias("part"), F.lit(1).alias("side"))).alias("b")), "blocks")
    pairs = block.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    sides = block.select("key", "tag", F.explode(F.filter(F.array("a", "b"), lambda x: x.isNotNull())).alias("s")).select("key", "tag", "s.*")
    found = sides.join(placed, ["key", "unit", "part"]).select("tag", "side", "id", "comp").join(body.select("id", "payload"), "id")
    # the number of tasks follows the comparisons, not the bytes
    tasks = max(1, min(1 << 15, pairs // TASK_PAIRS + 1), int(member.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = found.select("tag", "side", "id", "comp", "payload").repartition(tasks, "tag").sortWithinPartitions("tag")
    return settle(found.mapInArrow(_blockwise(within), "id long, pivot long"), "rest")


def _blockwise(within):
    def links(columns: list[list]) -> list[tuple[int, int]]:
        tags, *rest = columns
        cuts = [0, *[i for i in range(1, len(tags)) if tags[i] != tags[i - 1]], len(tags)]
        return within([[c[a:b] for c in rest] for a, b in zip(cuts, cuts[1:]) if a < b])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        for batch in batches:
            for old, new in zip(held, batch.columns):
                old.extend(new.to_pylist())
            # the last block may go on in the next batch
            cut = len(held[0])
            while cut and held[0][cut - 1] == held[0][-1]:
                cut -= 1
            if cut:
                yield _table(links([c[:cut] for c in held]))
                held = [c[cut:] for c in held]
        if held[0]:
            yield _table(links(held))

    return compare


def _table(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["id", "pivot"])
