"""Hard negatives by search in an inverted multi-index.

Vectors are whole numbers and scores their exact inner products. Each half of a vector belongs to the nearest word of
a codebook for that half, and a cell is a pair of words. Within a cell a half-score is at most the
anchor's product with the word plus the anchor's length times the word's radius (the largest distance of a vector
that has it), so the sum of two half-bounds bounds every score in the cell. A heap visits an anchor's
cells by falling bounds; visits of a round go to tasks as blocks of anchors and rows, and an anchor's search stops
when the bound of the next cell is below all it still looks for: its last positive, or for each of its
positives the last negative found or the lower end of the window. So results are exact.

The codebooks are fitted on a bounded sample (``SAMPLE`` rows by a hash of the id); every row is indexed and the radii
are measured over all of them. An anchor sees about ``FIRST_ROWS`` rows in its first round, ``GROWTH`` times
as many in each further one. A block holds about ``BLOCK_ROWS`` rows and ``BLOCK_ANCHORS`` anchors, whatever the size of
a cell, and gives each of its anchors its few best rows. Broadcast are codebooks, radii and the rows of the cells,
at most MAX_WORDS^2 numbers.

Cases: rows with null id, label or vector, or with a null or non-finite component take no part; of rows that share an
id the least by label and vector does; vectors of different lengths do not meet, empty ones score 0; ties go to the smaller id; a zero or
negative positive score has an empty window but for 0; an empty table gives an empty result; further
columns are not read. A score must be a 64-bit number.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variloom.llm.tables import pick, settle

SAMPLE, LLOYD, MAX_WORDS, ROWS_PER_CELL = 16_384, 8, 512, 256
FIRST_ROWS, GROWTH = 8192, 16
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 512
SEED = 5
_EXACT = float(1 << 53)


def scaled(embedding: Column, scale: int = 256) -> Column:
    """floor(scale x) of each component as a long array; null if the vector, or a component, is null or not finite."""
    x = embedding.cast("array<double>")
    good = F.forall(x, lambda c: F.coalesce((c == c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.when(good, F.transform(x, lambda c: F.floor(c * scale).cast("long")))


def _matrix(column: pa.Array | pd.Series, size: int) -> np.ndarray:
    """Vectors of one length as rows of whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else (np.concatenate(column.to_numpy()) if size and len(column) else np.zeros(0))
    return flat.astype(np.int64).reshape(len(column), size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exactly: in doubles where no sum can leave their whole numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def codebook(x: np.ndarray, words: int) -> np.ndarray:
    """Lloyd's means of the rows of ``x``, from distinct rows drawn by a fixed seed."""
    some = np.unique(x, axis=0)
    centres = some[np.random.default_rng(SEED).permutation(len(some))[:words]].astype(np.float64)
    for _ in range(LLOYD if len(centres) > 1 and x.shape[1] else 0):
        near = nearest(x, centres)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for k in range(0, len(x), 4096):
        part = x[k:k + 4096].astype(np.float64)
        out[k:k + 4096] = ((centres ** 2).sum(1) - 2 * part @ centres.T).argmin(1)
    return out


def visits(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Cells (bound, i, j) by falling sum of the two half-bounds, from a heap over the two sorted sequences."""
    left, right = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[left[0]] + second[right[0]]), 0, 0)] if len(left) and len(right) else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(left[i]), int(right[j])
        if j + 1 < len(right):
            heapq.heappush(heap, (-(first[left[i]] + second[right[j + 1]]), i, j + 1))
        if not j and i + 1 < len(left):
            heapq.heappush(heap, (-(first[left[i + 1]] + second[right[0]]), i + 1, 0))


class Index:
    """Codebooks, radii and rows of each cell of the vectors of one length."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray], filled: dict[tuple[int, int], int]):
        self.words, self.radii, self.filled = words, radii, filled

    def half_bounds(self, q: np.ndarray) -> list[np.ndarray]:
        cut, out = len(q) // 2, []
        for part, words, radii in zip((q[:cut], q[cut:]), self.words, self.radii):
            part = part.astype(np.float64)
            length = np.sqrt(part @ part)
            # a little more than rounding can take away
            out.append((words @ part + length * radii) + 1e-9 * (np.abs(words) @ np.abs(part) + length * radii) + 1e-6)
        return out

    def next_cells(self, q: np.ndarray, after: int, rows: int) -> tuple[list[tuple[int, int]], float | None]:
        """Filled cells from place ``after`` of the anchor's order until they hold ``rows`` rows, and the bound of the next one."""
        got, cells, seen = 0, [], 0
        for bound, i, j in visits(*self.half_bounds(q)):
            n = self.filled.get((i, j))
            if n is None:
                continue
            seen += 1
            if seen <= after:
                continue
            if got >= rows:
                return cells, bound
            cells.append((i, j))
            got += n
        return cells, None


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, :x.shape[1] // 2], x[:, x.shape[1] // 2:]


def build_index(rows: DataFrame, size: int, count: int) -> tuple[DataFrame, Index]:
    """``rows`` (``id``, ``label``, ``v`` of length ``size``) with ``i`` and ``j``, their cell, and the index."""
    spark = rows.sparkSession
    share = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(count, 1)) * (1 << 30))
    drawn = rows.where(share).select("v").collect() or rows.select("v").limit(1).collect()
    sample = np.array([r["v"] for r in drawn], np.int64).reshape(len(drawn), size)
    words = max(1, min(MAX_WORDS, int(np.sqrt(count / ROWS_PER_CELL))))
    books = tuple(codebook(h, words) for h in _halves(sample))
    sent = spark.sparkContext.broadcast(books)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), size)
            near, far = [], []
            for half, centres in zip(_halves(x), sent.value):
                near.append(nearest(half, centres))
                far.append(np.sqrt(((half - centres[near[-1]]) ** 2).sum(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(n, pa.int32()) for n in near], *[pa.array(f) for f in far]], ["id", "label", "v", "i", "j", "di", "dj"])

    kind = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("id", "label", "v"))
    placed = settle(rows.select("id", "label", "v").mapInArrow(place, f"{kind}, i int, j int, di double, dj double"), "index")
    cells = placed.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("di").alias("di"), F.max("dj").alias("dj")).collect()
    radii = tuple(np.zeros(len(b)) for b in books)
    for c in cells:
        radii[0][c["i"]], radii[1][c["j"]] = max(radii[0][c["i"]], c["di"]), max(radii[1][c["j"]], c["dj"])
    return placed.select("id", "label", "v", "i", "j"), Index(books, tuple(r * (1 + 1e-9) for r in radii), {(c["i"], c["j"]): c["n"] for c in cells})


def _best_positives(ids, labels, scores, a_id, a_label, keep: int):
    good = np.flatnonzero((labels == a_label) & (ids != a_id))
    order = good[np.lexsort((ids[good], -scores[good]))[:keep]]
    return [(0, ids[k], scores[k]) for k in order]


def _best_negatives(ids, labels, scores, a_label, windows, keep: int):
    good = np.flatnonzero(labels != a_label)
    if len(windows):
        good = good[(scores[good] >= min(w[0] for w in windows)) & (scores[good] <= max(w[1] for w in windows))]
    order = good[np.lexsort((ids[good], -scores[good]))]
    falling = -scores[order]
    out = []
    for k, (low, high, least) in enumerate(windows):
        begin, end = np.searchsorted(falling, -high), np.searchsorted(falling, -max(low, least), "right")
        out += [(k, ids[x], scores[x]) for x in order[begin:min(end, begin + keep)]]
    return out


def _search(index: Index, placed: DataFrame, anchors: DataFrame, size: int, keep: int, negatives: bool) -> DataFrame:
    """``anchor``, ``slot``, ``id`` and ``score`` of the best rows: of slot 0 (positives), or of each window.

    ``anchors`` has ``anchor``, ``label``, ``v`` and ``windows``, an array of (``low``, ``high``).
    """
    spark = placed.sparkSession
    sent = spark.sparkContext.broadcast(index)
    none = "array(named_struct('slot', 0, 'low', -9223372036854775807, 'high', 9223372036854775807))"
    # what is looked for: the windows, each with its last score so far (least) once it is full
    goals = anchors.select("anchor", "label", "v", F.explode("windows" if negatives else F.expr(none)).alias("w")).select("anchor", "label", "v", "w.slot", "w.low", "w.high")
    goals = settle(goals.where("low <= high").select("*", F.lit(0).alias("after"), F.lit(None).cast("long").alias("least")), "goals")
    chunks = placed.groupBy("i", "j").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("chunks"))
    stored = placed.join(F.broadcast(chunks), ["i", "j"]).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("chunks")).cast("int"))
    found, rows = None, FIRST_ROWS
    while not goals.isEmpty():
        wanted = rows

        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q, after = _matrix(batch.column(1), size), batch.column(2).to_pylist()
                out = []
                for k, anchor in enumerate(batch.column(0).to_pylist()):
                    cells, bound = sent.value.next_cells(q[k], after[k], wanted)
                    out += [(anchor, i, j, after[k] + len(cells), None if bound is None else float(bound)) for i, j in cells]
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()))], ["anchor", "i", "j", "seen", "bound"])

        # an anchor's goals share one walk
        walker = goals.groupBy("anchor").agg(F.first("v").alias("v"), F.first("after").alias("after"))
        walk = settle(walker.repartition("anchor").mapInArrow(plan, "anchor long, i int, j int, seen int, bound double"), "visits")
        seek = goals.groupBy("anchor").agg(F.first("label").alias("label"), F.first("v").alias("v"),
                                           F.sort_array(F.collect_list(F.struct("slot", "low", "high", F.coalesce("least", F.col("low")).alias("least")))).alias("goals"))
        seek = walk.select("anchor", "i", "j").join(seek.hint("merge"), "anchor").withColumn("group", F.pmod(F.xxhash64("anchor", F.lit(SEED)), F.lit(1 << 20)))
        load = walk.groupBy("i", "j").agg(F.ceil(F.count("*") / BLOCK_ANCHORS).cast("int").alias("groups"))
        # blocks: every group of a cell's anchors meets every chunk of its rows
        seek = seek.join(F.broadcast(load), ["i", "j"]).withColumn("group", F.pmod("group", F.col("groups")).cast("int"))
        many = chunks.join(F.broadcast(load), ["i", "j"])
        left = seek.join(F.broadcast(chunks), ["i", "j"]).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
        right = stored.drop("chunks").join(F.broadcast(many.select("i", "j", "groups")), ["i", "j"]).withColumn("group", F.explode(F.expr("sequence(0, groups - 1)")))
        block = F.xxhash64("i", "j", "group", "chunk").alias("block")
        left = left.select(block, "anchor", "label", "v", "goals")
        right = right.select(block, "id", "label", "v")

        def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(mine) and len(theirs):
                score = products(_matrix(mine["v"], size), _matrix(theirs["v"], size))
                ids, labels = theirs["id"].to_numpy(), theirs["label"].to_numpy()
                for k, (anchor, label, goal) in enumerate(zip(mine["anchor"], mine["label"], mine["goals"])):
                    if negatives:
                        best = _best_negatives(ids, labels, score[k], label, [(g["low"], g["high"], g["least"]) for g in goal], keep)
                        out += [(anchor, goal[s]["slot"], x, y) for s, x, y in best]
                    else:
                        out += [(anchor, *b) for b in _best_positives(ids, labels, score[k], anchor, label, keep)]
            cols = list(zip(*out)) or [[]] * 4
            return pd.DataFrame({n: np.array(c, t) for n, c, t in zip(("anchor", "slot", "id", "score"), cols, ("int64", "int32", "int64", "int64"))})

        fresh = left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(compare, "anchor long, slot int, id long, score long")
        rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
        best = fresh if found is None else fresh.unionByName(found)
        found = settle(best.withColumn("place", rank).where(F.col("place") <= keep).drop("place"), "found")
        last = found.groupBy("anchor", "slot").agg(F.count("*").alias("n"), F.min("score").alias("last"))
        ahead = walk.groupBy("anchor").agg(F.first("seen").alias("seen"), F.first("bound").alias("bound"))
        state = goals.drop("least", "after").join(ahead, "anchor").join(last, ["anchor", "slot"], "left")
        full = F.col("n") >= keep
        # open while the next cell may hold a row as good as the last one, or, until enough are found, any in the window
        reach = F.col("bound") >= F.when(full, F.greatest("last", "low")).otherwise(F.col("low")).cast("double")
        goals = settle(state.where(F.col("bound").isNotNull() & reach)
                       .select("anchor", "label", "v", "slot", "low", "high", F.col("seen").alias("after"), F.when(full, F.col("last")).alias("least")), "goals")
        rows *= GROWTH
    return found if found is not None else spark.createDataFrame([], "anchor long, slot int, id long, score long")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         vec_id: str = "vec_id", label: str = "label", vector: str = "v") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vector`` is an array of long (see ``scaled``), ``is_anchor`` a condition on column ``id``. A negative's score lies between
    ``low`` and ``high`` hundredths of the positive's.
    """
    rows = pick(vectors, id=vec_id, label=label, v=vector).select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("v").cast("array<long>").alias("v"))
    rows = rows.where("id is not null and label is not null and v is not null and not exists(v, c -> c is null)")
    rows = settle(rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*", F.size("r.v").alias("size")), "vectors")
    results = [_mine(rows.where(F.col("size") == r["size"]), r["size"], r["n"], is_anchor, positives, negatives, low, high)
               for r in rows.groupBy("size").agg(F.count("*").alias("n")).collect()]
    if not results:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _mine(rows: DataFrame, size: int, count: int, is_anchor: Column, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    placed, index = build_index(rows, size, count)
    anchors = rows.where(is_anchor).select(F.col("id").alias("anchor"), "label", "v")
    top = _search(index, placed, anchors, size, positives, False)
    # windows in whole numbers: low * score <= 100 * x <= high * score
    slot = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id")).cast("int")
    window = top.select("anchor", slot.alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    window = settle(window.withColumns({"low": F.expr(f"ceil(cast(positive_score as decimal(20, 0)) * {low} * 0.01BD)").cast("long"), "high": F.expr(f"floor(cast(positive_score as decimal(20, 0)) * {high} * 0.01BD)").cast("long")}), "windows")
    sought = window.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("windows"))
    found = _search(index, placed, anchors.join(sought, "anchor"), size, negatives, True)
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")).cast("int")
    return (found.join(window, ["anchor", "slot"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", rank.alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
