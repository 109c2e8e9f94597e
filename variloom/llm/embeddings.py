"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Unit vectors within one label and dimension are projected on ``PROJECTIONS`` random directions.
Around a query's value on each direction lies a window; a pair collides where the other value is in
it. Two vectors at the threshold's distance r differ on a direction by a normal variable with
deviation r, so a window of ``WINDOW`` r on either side gives each collision a known chance, and
the count asked for is the largest that a linked pair reaches with probability 1 - ``MISS``. Pairs
that reach it are verified by their cosine in double precision.

Cells of the first projection, as wide as a window of six deviations, say which blocks can hold
linked pairs: those of the same or the next cell. A block holds at most about ``BLOCK`` distinct
vectors, so a label or cell of any size is split; links are counted inside blocks, and only counts
and a spanning forest leave them. Vectors of equal components are one node.

Cases: a vector that is null, empty or zero, or has null or non-finite components, and a vector with
null label, links with nothing; null ids are ignored in the smallest id of a component (one without
ids has a null id); repeated rows are equal vectors and link; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variloom.llm.components import Forest, components
from variloom.llm.tables import pick, settle

PROJECTIONS, WINDOW, MISS = 32, 2.5, 1e-9
BLOCK = 2048
SEED = 11


def _directions(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((PROJECTIONS, size)).T


def least_count(p: float) -> int:
    """The largest count that a binomial of ``PROJECTIONS`` trials with chance ``p`` misses with probability at most MISS."""
    below = 0.0
    for k in range(PROJECTIONS + 1):
        below += comb(PROJECTIONS, k) * p ** k * (1 - p) ** (PROJECTIONS - k)
        if below > MISS:
            return k
    return PROJECTIONS


def _nodes(rows: DataFrame, cell_width: float) -> DataFrame:
    """``vec_id``, ``node`` (null if it can't link), ``size``, ``cell``, ``label`` and ``v`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, cells, vectors = [], [], [], []
            for label, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x = np.array(v, np.float64) if v and label is not None and None not in v else None
                norm = 0.0
                if x is not None and np.isfinite(x).all():
                    x = x + 0.0
                    biggest = np.abs(x).max()
                    norm = biggest * np.linalg.norm(x / biggest) if biggest else 0.0
                if not norm:
                    nodes.append(None), sizes.append(None), cells.append(None), vectors.append(None)
                    continue
                key = hashlib.md5(f"{label}|{len(x)}|".encode() + x.tobytes(), usedforsecurity=False).digest()
                unit = x / biggest
                unit /= np.linalg.norm(unit)
                nodes.append(int.from_bytes(key[:8], "little", signed=True))
                sizes.append(len(x))
                cells.append(int(np.floor(unit @ _first(len(x)) / cell_width)))
                vectors.append(unit)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(cells, pa.int32()),
                                              pa.array(vectors, pa.list_(pa.float64()))], ["vec_id", "label", "node", "size", "cell", "v"])

    return rows.mapInArrow(run, "vec_id long, label string, node long, size int, cell int, v array<double>")


_firsts: dict[int, np.ndarray] = {}


def _first(size: int) -> np.ndarray:
    if size not in _firsts:
        _firsts[size] = np.ascontiguousarray(_directions(size)[:, 0])
    return _firsts[size]


def collide(left: np.ndarray, right: np.ndarray, window: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) whose projections collide at least ``least`` times."""
    counts = np.zeros((len(left), len(right)), np.int8)
    dense = PROJECTIONS // 2
    rows = np.arange(len(left))
    for k in range(dense):
        order = np.argsort(right[:, k])
        values = right[order, k]
        edge = np.zeros((len(left), len(right) + 1), np.int8)
        edge[rows, np.searchsorted(values, left[:, k] - window)] += 1
        edge[rows, np.searchsorted(values, left[:, k] + window, "right")] -= 1
        counts[:, order] += np.cumsum(edge[:, :-1], axis=1, dtype=np.int8)
    i, j = np.nonzero(counts >= least - (PROJECTIONS - dense))
    total = counts[i, j].astype(np.int64)
    for k in range(dense, PROJECTIONS):
        total += np.abs(left[i, k] - right[j, k]) <= window
        alive = total >= least - (PROJECTIONS - 1 - k)
        i, j, total = i[alive], j[alive], total[alive]
    return i, j


def link_vectors(vectors: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    reach = sqrt(2 - 2 * cosine) + 1e-9
    window, cell_width = WINDOW * reach, 6 * reach
    least = least_count(erf(WINDOW / sqrt(2)))
    rows = pick(vectors, vec_id=vec_id, label=label, v=embedding)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "v")
    all_ = settle(_nodes(rows, cell_width), "vectors")
    node = all_.where("node is not null").groupBy("label", "size", "cell", "node").agg(F.count("*").alias("n"), F.first("v").alias("v"))
    parts = node.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    chunk = parts.select("label", "size", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # each chunk meets itself, later chunks of its cell, and all of the next cell
    near = chunk.withColumn("to", F.explode(F.array(F.col("cell"), F.col("cell") + 1)))
    other = chunk.select("label", "size", F.col("cell").alias("to"), F.col("part").alias("part2"))
    met = near.join(other, ["label", "size", "to"]).where("to > cell or part <= part2").withColumn("tag", F.xxhash64("label", "size", "cell", "part", "to", "part2"))
    mine = met.select("tag", "label", "size", "cell", "part", F.lit(0).alias("side"))
    theirs = met.where("to > cell or part < part2").select("tag", "label", "size", F.col("to").alias("cell"), F.col("part2").alias("part"), F.lit(1).alias("side"))
    placed = (node.join(parts, ["label", "size", "cell"])
              .withColumn("part", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("parts")).cast("int")))
    blocks = mine.union(theirs).join(placed, ["label", "size", "cell", "part"]).select("tag", "side", "node", "n", "v")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        # units differ from the stored components by rounding far below the window
        v, n, ids, side = np.stack(pdf["v"].to_numpy()), pdf["n"].to_numpy(), pdf["node"].to_numpy(), pdf["side"].to_numpy()
        values = v @ _directions(v.shape[1])
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(b)
        b = a if alone else b
        i, j = collide(values[a], values[b], window, least)
        i, j = a[i], b[j]
        if alone:
            i, j = i[i < j], j[i < j]
        good = np.concatenate([np.einsum("ij,ij->i", v[i[k:k + 65536]], v[j[k:k + 65536]]) >= cosine for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
        i, j = i[good], j[good]
        links = np.bincount(i, n[j], minlength=len(ids)) + np.bincount(j, n[i], minlength=len(ids))
        forest = Forest()
        tree = np.array([(x, y) for x, y in zip(ids[i].tolist(), ids[j].tolist()) if forest.join(x, y)], np.int64).reshape(-1, 2)
        some = np.flatnonzero(links)
        return pd.DataFrame({"a": np.concatenate((ids[some], tree[:, 0])), "b": np.concatenate((np.zeros(len(some), np.int64), tree[:, 1])),
                             "links": np.concatenate((links[some].astype(np.int64), np.zeros(len(tree), np.int64)))})

    found = settle(blocks.groupBy("tag").applyInPandas(compare, "a long, b long, links long"), "links")
    group = components(found.where("links = 0").select("a", "b"))
    links = found.where("links > 0").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    size = all_.where("node is not null").groupBy("node").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    top = size.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least_id = top.groupBy("component").agg(F.min("low").alias("component_id"))
    per = (top.join(least_id, "component").join(links, "node", "left")
           .select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    return (all_.select("vec_id", "node").join(per, "node", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
