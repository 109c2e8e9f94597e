"""Near-duplicate documents by fast similarity sketching.

A document is the set of its word shingles. Sketching goes in rounds: in round i < t every element
is hashed to one of t coordinates and offers the value i + u, in round t + i every element offers
to coordinate i, and a sketch is finished after the round that fills its last coordinate, so every
coordinate fills and a large set needs two or three rounds. Coordinates are grouped into bands;
documents that agree on a band become candidates, and candidates link when the intersection of
their full sets reaches the threshold times the union.

Documents of equal sets (by a 64-bit signature) are one node from the start. 168 coordinates in 28 bands of 6 miss a pair
at similarity 0.85 with probability (1 - 0.85^6)^28, 2e-6, and less above. Elements are 64-bit
hashes of the shingles: sets of a thousand shingles are confused with a chance below 1e-13.

Cases: a null, empty or wordless text has the empty set and links with nothing; a text of fewer
words than a shingle is one element; null ids are ignored when the smallest id of a group is sought
(a group without ids has a null id, and all of it is kept); rows that repeat an id are each linked
by their own text; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variloom.llm.components import Forest
from variloom.llm.linking import link
from variloom.llm.tables import pick, settle, spare
from variloom.llm.textbytes import NOT_SPACE, gram_hashes, lower, mix, signed, spans, text_runs, word_hashes

BANDS, ROWS = 28, 6

_U = np.uint64


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for run in text_runs(column):
        run.data = lower(run.data)
        starts, ends, bounds = spans(run, NOT_SPACE)
        words = word_hashes(run.data, starts, ends)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield np.unique(gram_hashes(words[a:b], size) if b - a >= size else gram_hashes(words[a:b], b - a) if b > a else words[:0])


def sketch(elements: np.ndarray, t: int = BANDS * ROWS) -> np.ndarray:
    """t coordinates: the round in the upper bits, the element's value of that round below."""
    out = np.full(t, ~_U(0), _U)
    for i in range(2 * t):
        h = mix(elements + _U(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1))
        value = (h >> _U(10)) | (_U(i) << _U(54))
        if i < t:
            np.minimum.at(out, ((h & _U(0x3FF)) * _U(t) >> _U(10)).astype(np.intp), value)
        else:
            out[i - t] = min(out[i - t], value.min())
        if out.max() != ~_U(0):
            break
    return out


def _bands(elements: np.ndarray) -> np.ndarray:
    rows = sketch(elements).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=_U)
    for k in range(ROWS):
        key = mix(key + rows[:, k])
    return signed(key)


def sketches(docs: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (64 bits that stand for the set; null for the empty set) and ``bands``."""
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, same, nodes, bands = [], [], [], []
            for s in shingle_sets(batch.column(1), size):
                counts.append(len(s))
                same.append(_signature(s) if len(s) else None)
                nodes.append(_node(same[-1]) if len(s) else None)
                bands.append(_bands(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                                             ["doc_id", "n_shingles", "node", "bands"])

    return rows.mapInArrow(run, "doc_id long, n_shingles long, node long, bands array<long>")


def _signature(elements: np.ndarray) -> bytes:
    return np.array([mix(mix(elements).sum(dtype=_U, keepdims=True) + _U(len(elements)))[0]], _U).tobytes()


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """``node``, ``payload`` (the shingle set) and ``weight`` (its size) of texts in the second column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(1), size) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(_signature(s)) for s in sets], pa.int64()), pa.array([signed(s) for s in sets], pa.list_(pa.int64())),
                 pa.array([len(s) for s in sets], pa.int64())], ["id", "payload", "weight"])

    return rows.mapInArrow(run, "id long, payload array<long>, weight long")


def _node(signature: bytes) -> int:
    return int.from_bytes(signature[:8], "little", signed=True)


def _within(threshold: Fraction):
    p, q = threshold.numerator, threshold.denominator

    def within(sides: list, ids: list, comps: list, sets: list) -> list[tuple[int, int]]:
        n = len(ids)
        sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(n), sizes)
        values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # an element of one set alone meets nothing
        column = np.cumsum(count > 1) - 1
        shared = count[place] > 1
        owner, place = owner[shared], column[place[shared]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        common = np.zeros((n, n), np.float32)
        width = 4096
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(place, (low, low + width))
            part = np.zeros((n, width), np.float32)
            part[owner[a:b], place[a:b] - low] = 1
            common += part @ part.T
        both = common.astype(np.int64)
        side, comp = np.array(sides), np.array(comps)
        good = np.triu(q * both >= p * (sizes[:, None] + sizes[None, :] - both), 1) & (comp[:, None] != comp[None, :])
        if side.any():
            good &= side[:, None] != side[None, :]
        forest, out = Forest(), []
        for i, j in zip(*np.nonzero(good)):
            if forest.join(comps[i], comps[j]):
                out.append((ids[i], ids[j]))
        return out

    return within


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest reachable id) and ``kept`` for every row."""
    share = Fraction(threshold).limit_denominator(10_000)
    p, q = share.numerator, share.denominator
    all_ = settle(sketches(docs, size, doc_id, text), "sketch")
    node = settle(all_.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")), "sets")
    keys = node.select(F.col("node").alias("id"), F.explode("bands").alias("key"))
    source = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def payloads(ids: DataFrame) -> DataFrame:
        """Sets from the texts of the smallest ids; other texts under the same id fall out by their set."""
        wanted = node.select(F.col("node").alias("id"), F.col("doc_id").alias("wanted")).join(ids, "id", "left_semi")
        rows = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
        sets = _sets(rows, size).join(ids, "id", "left_semi")
        return sets.groupBy("id").agg(F.first("payload").alias("payload"), F.first("weight").alias("weight"))

    def similar(a: Column, b: Column) -> Column:
        n, m = F.size(a), F.size(b)
        common = F.size(F.array_intersect(a, b))
        return (q * F.least(n, m) >= p * F.greatest(n, m)) & (q * common >= p * (n + m - common))

    groups = link(keys, payloads, similar, _within(share), 1 << 20)
    top = node.select("node", "doc_id").join(groups, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = top.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    group = top.join(least, "component").select("node", "component_id")
    return (all_.join(group, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def distinct_documents(docs: DataFrame, size: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies, with all its columns: the row of the smallest id, null ids last.

    Rows are told apart by a number of their own, so a text stays whatever else its id stands for, and of equal rows,
    of null ids too, one stays. Texts without words link with nothing: all of them stay.
    """
    row = spare(docs, "row")
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, size, threshold, doc_id=row, text=text).select(F.col("doc_id").alias("row"), "component_id")
    own = pick(rows, row=row, doc_id=doc_id).join(groups, "row")
    first = own.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    return rows.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
