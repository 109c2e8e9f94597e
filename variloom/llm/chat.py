"""Preference formatting: one prompt, two masked completions.

Of a chosen and a rejected conversation the longest common prefix of turns (same role and text) is
rendered once as the prompt; the turns after it are the completions. A turn is rendered as
``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed; ``<|`` inside a role or
text becomes ``< |``, so that nothing but the template makes a marker. A completion's mask lists the
character ranges to train on: text and end marker of its assistant turns.

Everything is DataFrame functions. Turns stay single rows until a pair's three strings are put together.

Cases: turns are numbered in the order of turn, role and text, nulls first, so gaps, ties and
repeated rows are turns like others; a null role or text is rendered as empty and equals only a null;
a pair with a null or unknown conversation on a side has no turns there; pairs without any turn still
give a row of empty strings; of rows that share a pair id the least by chosen and rejected counts; empty tables
give an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variloom.llm.tables import pick

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def preference_pairs(turns: DataFrame, pairs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                     trained: str = "assistant") -> DataFrame:
    """One row for each row of ``pairs`` (``pair_id``, ``chosen``, ``rejected`` conversation ids).

    Columns: ``pair_id``, ``prompt_turns``, ``prompt``, ``chosen``, ``rejected``, ``chosen_mask`` and
    ``rejected_mask`` (arrays of ``begin``, ``end``).
    """
    rows = pick(turns, conv=conv_id, turn=turn, role=role, text=text)
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = rows.where("conv is not null").withColumn("k", F.row_number().over(order))
    asked = pick(pairs, pair_id="pair_id", chosen="chosen", rejected="rejected").groupBy("pair_id").agg(F.min(F.struct("chosen", "rejected")).alias("p")).select("pair_id", "p.*")
    sides = asked.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen").alias("conv")),
                                                      F.struct(F.lit(1).alias("side"), F.col("rejected").alias("conv")))).alias("s")).select("pair_id", "s.*")
    placed = sides.join(rows, "conv").select("pair_id", "side", "k", "role", "text")
    # a place differs if it has one turn or two unequal ones
    at = placed.groupBy("pair_id", "k").agg(F.count("*").alias("n"), *[F.max(F.when(F.col("side") == s, F.struct(F.lit(1).alias("there"), "role", "text"))).alias(f"t{s}") for s in (0, 1)])
    common = at.groupBy("pair_id").agg(F.min(F.when((F.col("n") != 2) | ~F.col("t0").eqNullSafe(F.col("t1")), F.col("k"))).alias("fork"), F.max("k").alias("last"))
    common = common.select("pair_id", (F.coalesce("fork", F.col("last") + 1) - 1).alias("shared"))
    head = F.concat(F.lit(OPEN), _safe(F.col("role")), F.lit("\n"))
    parts = (placed.join(common, "pair_id").withColumn("after", F.col("k") > F.col("shared")).where("side = 0 or after")
             .withColumn("head", F.length(head)).withColumn("piece", F.concat(head, _safe(F.col("text")), F.lit(CLOSE + "\n"))))
    upto = F.sum(F.length("piece")).over(Window.partitionBy("pair_id", "side", "after").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("end", upto - 1).withColumn("begin", upto - F.length("piece") + F.col("head"))

    def joined(side: int, after: bool) -> Column:
        own = F.collect_list(F.when((F.col("side") == side) & (F.col("after") == after), F.struct("k", "piece")))
        return F.array_join(F.transform(F.array_sort(own), lambda x: x["piece"]), "")

    def mask(side: int) -> Column:
        own = (F.col("side") == side) & F.col("after") & (F.col("role") == trained)
        return F.array_sort(F.collect_list(F.when(own, F.struct("begin", "end"))))

    done = parts.groupBy("pair_id").agg(F.first("shared").alias("prompt_turns"), joined(0, False).alias("prompt"), joined(0, True).alias("chosen"),
                                        joined(1, True).alias("rejected"), mask(0).alias("chosen_mask"), mask(1).alias("rejected_mask"))
    empty = F.lit("")
    return asked.select("pair_id").join(done, "pair_id", "left").select(
        "pair_id", F.coalesce("prompt_turns", F.lit(0)).alias("prompt_turns"), *[F.coalesce(c, empty).alias(c) for c in ("prompt", "chosen", "rejected")],
        *[F.coalesce(c, F.expr("cast(array() as array<struct<begin:bigint,end:bigint>>)")).alias(c) for c in ("chosen_mask", "rejected_mask")])


def swapped_endings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and pairs from plain conversations: the rejected one ends like the neighbouring conversation.

    A conversation c with an assistant turn is chosen; its rejected copy has c's turns before
    c's last assistant turn and from there on the turns of conversation c xor 1. Ids are (``copy``, ``id``), so a
    copy's never meets a conversation's own, negative ones included.
    """
    rows = turns.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    last = rows.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("cut"))
    front = rows.join(last, "conv_id").where("turn < cut")
    back = last.select(F.col("conv_id").alias("own"), F.expr("conv_id ^ 1L").alias("conv_id"), "cut").join(rows, "conv_id").where("turn >= cut")

    def named(copy: int, conv: str = "conv_id") -> Column:
        return F.struct(F.lit(copy).alias("copy"), F.col(conv).cast("long").alias("id"))

    parts = [part.select(named(copy, conv).alias("conv_id"), "turn", "role", "text") for part, copy, conv in ((rows, 0, "conv_id"), (front, 1, "conv_id"), (back, 1, "own"))]
    pairs = last.select(F.col("conv_id").alias("pair_id"), named(0).alias("chosen"), named(1).alias("rejected"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]), pairs
