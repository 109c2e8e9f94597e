"""Connected components of a table of edges, by alternating large and small stars.

Edges are dealt by their larger node and shrink to a spanning forest inside each partition of about
``PART`` edges, so a node that is never the smaller one leaves one partition, once; then every
round hangs neighbours on the smallest one they know, until each node hangs directly on its root.
Each round is written to the shared folder. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variloom.llm.tables import settle

PART = 200_000


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (nxt := up.get(top, top)) != top:
            top = nxt
        while (nxt := up.get(x, x)) != top:
            up[x] = top
            x = nxt
        return top

    def join(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` were apart until now."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
    nodes = [x for x in forest.up if forest.root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([forest.root(x) for x in nodes], pa.int64())], ["a", "b"])


def _shrunk(edges: DataFrame) -> tuple[DataFrame, bool]:
    """The edges' forests, and whether there is only one: a part's worth of edges needs no exchange."""
    parts = -(-edges.count() // PART)
    dealt = edges.coalesce(1) if parts < 2 else edges.repartition(parts, "a")
    return settle(dealt.mapInArrow(_forest, "a long, b long"), "forest"), parts < 2


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``edges`` (two long columns).

    Loops, nulls and repeated edges are no harm; an empty table gives an empty one.
    """
    x, y = edges.columns[:2]
    own = edges.where(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    own, one = _shrunk(settle(own, "edges"))
    while not (one or _stars(own)):
        both = own.select(F.col("a").alias("u"), F.col("b").alias("v")).union(own.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(root, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a != b").distinct())
        own, one = _shrunk(settle(small, "stars"))
    roots = own.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return own.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _stars(own: DataFrame) -> bool:
    """Whether every ``a`` has one ``b`` and no ``b`` is an ``a``."""
    roles = own.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("top")),
                                         F.struct(F.col("b").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("top")))).alias("r")).select("r.*")
    per = roles.groupBy("n").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    return per.where("low > 1 or (low = 1 and top = 1)").limit(1).count() == 0
