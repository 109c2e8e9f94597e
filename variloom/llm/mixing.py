"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source wants a number of words (``targets``). The mix is dealt in blocks of equally many
words: blocks go to sources by the highest quotients target / (2 k + 1), and each source's blocks
go to its shards in the same way by the shards' sizes, which gives every shard an integer quota.
Inside a shard the documents stand in a seeded order on a circle of words, and the quota is read
off from a seeded block onwards, as often around as it takes.

Cases: a null or wordless text has size 0 and gives nothing; a null source is a source of its own
and comes last; a source without words gets nothing; repeated rows are separate documents, alike
ones interchangeable; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from variloom.llm.tables import pick, settle
from variloom.llm.textbytes import NOT_SPACE, spans, text_runs

#: Sources whose totals the driver will hold, and shards over all sources.
MAX_SOURCES, MAX_SHARDS = 65_536, 16_384
#: Words of a source for each of its shards, while there are fewer than MAX_SHARDS.
SHARD_WORDS = 1 << 20
#: Longest block; a block is also at most this part of the smallest target.
BLOCK_WORDS, BLOCK_PART = 1024, 1 / 400


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id``, ``source`` and ``size``, the number of ``[^\\x20\\x09-\\x0D]+`` in the text."""
    rows = pick(docs, doc_id=doc_id, source=source, text=text)
    rows = rows.withColumn("source", F.col("source").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.diff(spans(run, NOT_SPACE)[2]) for run in text_runs(batch.column(2))]
            size = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size], ["doc_id", "source", "size"])

    return rows.mapInArrow(count, f"doc_id {kind}, source string, size long")


def targets(sizes: list[int], weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> list[float]:
    """Target words by source: ``share`` of all words by cycled weights, no source above ``most`` times its size."""
    want = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = share * sum(sizes)
    while open_ and left > 0:
        total = sum(weights[i % len(weights)] for i in open_)
        full = [i for i in open_ if left * weights[i % len(weights)] / total > most * sizes[i]]
        for i in full or open_:
            want[i] = most * sizes[i] if full else left * weights[i % len(weights)] / total
        if not full:
            break
        left -= sum(want[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return want


def apportion(seats: int, votes: list[float], limits: list[int]) -> list[int]:
    """Sainte-Laguë seats by highest quotients votes / (2 k + 1), nobody above its limit; ties go to the first.

    Seats below a divisor are given at once, the last few one by one.
    """
    v, cap = np.asarray(votes, float), np.asarray(limits, np.int64)
    seats = int(min(seats, cap[v > 0].sum())) if len(v) else 0
    if seats <= 0:
        return [0] * len(v)

    def at(price: float) -> np.ndarray:
        return np.minimum(cap, np.floor(v / price + 0.5)).astype(np.int64)

    low, high = v[v > 0].min() / (2.0 * seats + 2.0), 2.0 * v.max() + 1.0
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if at(middle).sum() > seats else (low, middle)
    got = at(high)
    while got.sum() < seats:
        quotient = np.where(got < cap, v / (2 * got + 1), -1.0)
        got[int(quotient.argmax())] += 1
    return got.tolist()


def mix_sources(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """``word_counts`` rows with ``source_size``, ``target`` (both of the source) and ``taken``, the words the mix takes."""
    spark = sizes.sparkSession
    sizes = settle(sizes, "sizes")
    names = sizes.groupBy("source").agg(F.sum("size").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(names) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: map them to fewer groups first")
    names = sorted(names, key=lambda r: (r.source is None, (r.source or "").encode()))
    words = [r.words for r in names]
    want = targets(words, weights, share, most)
    wanted = [w for w in want if w > 0]
    block = max(1, min(BLOCK_WORDS, int(min(wanted) * BLOCK_PART))) if wanted else 1
    quota = apportion(round(sum(want) / block), want, [most * w // block for w in words])
    per_shard = max(SHARD_WORDS, -(-sum(words) // MAX_SHARDS))
    shards = [max(1, -(-w // per_shard)) for w in words]
    plan = spark.createDataFrame(
        [(r.source, w, float(t), s) for r, w, t, s in zip(names, words, want, shards)],
        "source string, source_size long, target double, shards long")
    joined = (sizes.alias("d").join(F.broadcast(plan.alias("p")), F.col("d.source").eqNullSafe(F.col("p.source")))
              .select("doc_id", "d.source", "size", "source_size", "target", "shards"))
    where = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    joined = joined.withColumn("place", where).withColumn("shard", F.pmod(F.shiftrightunsigned("place", 20), F.col("shards")))
    parts: dict = {}
    for r in joined.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect():
        parts.setdefault(r.source, []).append((r.shard, r.words))
    rows = []
    for r, seats in zip(names, quota):
        own = sorted(parts[r.source])
        got = apportion(seats, [w for _, w in own], [most * w // block for _, w in own])
        short = seats - sum(got)  # whole blocks that no shard can hold: word by word from the first shards
        for (shard, size), n in zip(own, got):
            extra = min(short * block, most * size - n * block)
            short -= extra / block
            rows.append((r.source, shard, int(n * block + extra), size))
    quotas = spark.createDataFrame(rows, "q_source string, q_shard long, quota long, shard_size long")
    dealt = (joined.join(F.broadcast(quotas), F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
             .withColumn("rank", F.xxhash64("place", F.lit(seed + 1))))
    circle = Window.partitionBy("source", "shard").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    # where the seeded block begins, and the document's place on the circle seen from there
    begin = F.expr(f"if(shard_size = 0, 0L, pmod(xxhash64({seed + 2}, source, shard), greatest(1L, shard_size div {block})) * {block}L)")
    size, quota_, total = F.col("size"), F.col("quota"), F.col("shard_size")
    low = F.when(total == 0, F.lit(0).cast("long")).otherwise(F.pmod(F.col("upto") - size - F.col("begin"), total))
    rest = F.expr("if(shard_size = 0, 0L, quota % shard_size)")
    full = F.expr("if(shard_size = 0, 0L, quota div shard_size)")
    first = F.greatest(F.lit(0), F.least(F.col("low") + size, F.col("rest")) - F.col("low"))
    wrapped = F.greatest(F.lit(0), F.least(F.col("low") + size - total, F.col("rest")))
    return (dealt.withColumn("upto", F.sum("size").over(circle)).withColumn("begin", begin)
            .withColumn("low", low).withColumn("rest", rest)
            .withColumn("taken", (full * size + first + wrapped).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))
