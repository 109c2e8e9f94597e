"""A prefix trie of conversations by collapsing whole sequences.

Turns are numbered in their conversation and stand for themselves as hashes: texts take part in one
range sort and go no further. The hash of a sequence is the sum of hashes of (position, turn), 128 bits,
so the hashes of all prefixes are running sums. Equal conversations collapse into one weighted sequence
with its list of ends; sequences that are proper prefixes of others fall to an anti join, which
leaves the leaves; the prefixes of the weighted sequences are then added up by their hash.

A node's ``conv_id`` is its smallest member, so the nodes that one conversation names form an unbroken
stretch of its path, down to its end. What a subtree saves is the total of every such stretch that starts in
it, plus the part of the node's own stretch that lies below: sums by sequence, no walk over the tree.

A conversation, a first turn or a group of equal conversations of any size is spread over tasks: range sort
by bounded keys, running sums in blocks of ``BLOCK`` positions, sums before shuffles. The list of
a node's ends is put together from runs of ids and hashed as a stream, because SHA-256 reads in order.

Cases: a null id takes no part; null role and text are empty; null turns come first; equal turns are
ordered by role and text, and repeated rows are repeated turns; an empty table has no node; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variloom.llm.tables import arrow_schema, pick, settle

#: Positions of a block of running sums; bits of a conversation id that one run of ends covers.
BLOCK, RUN_BITS = 1024, 8
#: Characters of role and text by which rows of one turn number are dealt to tasks.
DEALT = 32


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``pos`` from 1, ``u`` and ``v`` (hashes of role and text) and ``len`` (code points of the text)."""
    rows = pick(conversations, conv=conv_id, turn=turn, role=role, text=text).where("conv is not null")
    rows = rows.select(F.col("conv").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # the sampled keys are short whatever the texts are, and in the order of role and text
    dealt = rows.repartitionByRange("conv", "turn", F.substring("role", 1, DEALT), F.when(F.length("role") <= DEALT, F.substring("text", 1, DEALT)))
    stood = dealt.sortWithinPartitions("conv", "turn", "role", "text").select(
        "conv", F.monotonically_increasing_id().alias("id"), F.xxhash64(F.lit(1), "role", "text").alias("u"),
        F.xxhash64(F.lit(2), "role", "text").alias("v"), F.length("text").cast("long").alias("len"))
    stood = settle(stood.withColumn("part", F.shiftright("id", 33)), "turns")
    # a conversation's rows are consecutive in a partition, and its partitions are in order
    piece = stood.groupBy("conv", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    piece = piece.select("conv", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return stood.join(piece, ["conv", "part"]).select("conv", (F.col("id") - F.col("first") + F.col("before") + 1).alias("pos"), "u", "v", "len")


def swap_openings(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the opening of their group's first one: (``conv``) and their turns.

    Conversation c takes the first h turns of conversation c - c % ``group`` and its own after its first h,
    where h is the CRC-32 of c's decimal digits, modulo ``most``.
    """
    conv = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    conv = conv.select("conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"), F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most)).alias("h"))
    base = conv.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    conv = conv.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    own = turns.join(conv.where("n > h").select("conv", "h", "taken"), "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "u", "v", "len")
    opening = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    other = conv.where("taken > 0").select("base", "conv", "taken").join(opening, "base").where("pos <= taken").select("conv", "pos", "u", "v", "len")
    return conv.select("conv"), own.unionByName(other)


def _word(high: str, low: str) -> Column:
    """64 bits out of two sums, each modulo 2^32."""
    return F.shiftleft(F.col(high).bitwiseAND(0xFFFFFFFF), 32).bitwiseOR(F.col(low).bitwiseAND(0xFFFFFFFF))


def _running(rows: DataFrame, by: str, position: str, sums: list[str], own: bool) -> DataFrame:
    """Adds ``<name>_upto``: running sums of long columns along ``position``, in blocks; ``own`` counts the row itself."""
    block = rows.withColumn("block", F.shiftright(position, BLOCK.bit_length() - 1))
    local = Window.partitionBy(by, "block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    block = block.withColumns({f"{s}_upto": F.sum(s).over(local) - (0 if own else F.col(s)) for s in sums})
    whole = rows.where(F.col(position) >= BLOCK).select(by).distinct()
    long = rows.join(whole, by, "left_semi").groupBy(by, F.shiftright(position, BLOCK.bit_length() - 1).alias("block")).agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy(by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = long.select(by, "block", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in sums])
    joined = block.join(starts, [by, "block"], "left")
    return joined.withColumns({f"{s}_upto": F.col(f"{s}_upto") + F.coalesce(f"{s}_before", F.lit(0)) for s in sums}).drop("block", *[f"{s}_before" for s in sums])


def prefix_trie(conv: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of conversations ``conv`` (``conv``) with ``turns`` (``conv``, ``pos`` from 1, ``u``, ``v``, ``len``).

    ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``
    and ``ends_sha256`` of every node, the root included.
    """
    key = ["depth", "a", "b"]
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("string")
    parts = {f"{c}{k}": F.shiftrightunsigned(F.xxhash64("pos", c), 32 * k).bitwiseAND(0xFFFFFFFF) for c in "uv" for k in (1, 0)}
    salted = turns.select("conv", F.col("pos").alias("depth"), "len", *[e.alias(n) for n, e in parts.items()])
    walked = _running(salted, "conv", "depth", list(parts), own=True)
    for n in parts:
        walked = walked.withColumn(f"{n}_back", F.col(f"{n}_upto") - F.col(n))
    # every prefix of every conversation: its hash (a, b) and that of the prefix before (pa, pb)
    path = settle(walked.select("conv", "depth", _word("u1_upto", "u0_upto").alias("a"), _word("v1_upto", "v0_upto").alias("b"),
                                _word("u1_back", "u0_back").alias("pa"), _word("v1_back", "v0_back").alias("pb"), "len"), "paths")
    deepest = path.groupBy("conv").agg(F.max(F.struct(*key)).alias("end")).select("conv", "end.*")
    ends = settle(conv.join(deepest, "conv", "left").select("conv", F.coalesce("depth", zero).alias("depth"), F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b")), "ends")
    whole = ends.groupBy(*key).agg(F.min("conv").alias("seq"), F.count("*").alias("weight"))
    own_path = path.withColumnRenamed("conv", "seq").join(whole.select("seq"), "seq", "left_semi")
    # proper prefixes are exactly the parents of some prefix
    inner = own_path.select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
    leaf = whole.join(inner, key, "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))
    whole = settle(whole.join(leaf, "seq", "left").select("seq", "weight", F.coalesce("leaf", F.lit(0)).alias("leaf")), "sequences")
    root = whole.select("seq", *[zero.alias(c) for c in ("depth", "a", "b", "pa", "pb", "len")], "weight", "leaf")
    step = settle(own_path.join(whole, "seq").unionByName(root), "steps")
    node = step.groupBy(*key).agg(F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
                                  F.max("len").alias("len"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    node = settle(node.withColumn("own", (F.col("n_convs") - 1) * F.col("len")), "nodes")
    total = node.groupBy(F.col("conv_id").alias("seq")).agg(F.sum("own").alias("total")).where("total != 0")
    facts = (step.join(total, "seq").select(*key, F.col("total").alias("below"), zero.alias("child"), none.alias("sha"))
             .unionByName(node.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"), zero.alias("below"), F.lit(1).cast("long").alias("child"), none.alias("sha")))
             .unionByName(_hashed_ends(ends).select(*key, zero.alias("below"), zero.alias("child"), "sha")))
    fact = facts.groupBy(*key).agg(F.sum("below").alias("below"), F.sum("child").alias("n_children"), F.max("sha").alias("sha"))
    # the stretch of a node's own conversation above it lies outside its subtree
    above = _running(node.select(*key, "conv_id", "n_convs", "n_leaves", "own", "pa", "pb"), "conv_id", "depth", ["own"], own=False)
    parent = node.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return (above.join(fact, key, "left").join(parent, ["depth", "pa", "pb"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
                    (F.coalesce("below", zero) - F.col("own_upto")).alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """``sha`` of the ascending ids of the conversations that end at each key, joined by commas."""
    key = ["depth", "a", "b"]
    # at most 2^RUN_BITS ids fall into a run
    run = (ends.groupBy(*key, F.shiftright("conv", RUN_BITS).alias("run")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
           .select(*key, "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))
    schema = arrow_schema("depth long, a long, b long, sha string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for depth, a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3))):
                if (depth, a, b) != now:
                    if now:
                        done.append((*now, state.hexdigest()))
                    now, state = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), schema)], schema=schema)
                done = []
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in zip((*now, state.hexdigest()), schema)], schema=schema)

    return run.repartition(*key).sortWithinPartitions(*key, "run").select(*key, "ids").mapInArrow(digest, "depth long, a long, b long, sha string")
