"""Language-model scores from a probabilistic suffix tree over the bytes of the token stream.

A text is its words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, a space after each and a line
feed after the last; a text without word is the line feed alone. Bytes before the first are line
feeds. Counts of ``DEPTH + 1`` consecutive bytes over all training texts give the next-byte
distributions of all contexts up to ``DEPTH`` bytes. As in the original construction a context is
a candidate if its share of the training bytes is at least ``MIN_SHARE``, so there are at most
``1 / MIN_SHARE`` of each length whatever the corpus; it stays if its distribution diverges from
its parent's by more than a description-length test (n KL > support ln(n) / 2), or if a longer
one that stays needs it. Distributions are smoothed with the parent's by the number of distinct
followers. A byte's state is the longest suffix kept, found by an automaton over prefixes.

A word's path is its bytes and the byte after it. Its probability is the even mixture of the
tree's path and the word's add-one share of the training tokens (times that of the end token for a
last word), which smooths the tree with whole words; the tree alone forgets rare ones. Like the
base, the add-one share counts all unseen words as one.

The unigram base looks words up by 64-bit hash: the at most ``HEAVY`` most frequent in a broadcast
table, all others through a join, with the same result.

Cases: null and empty texts are one end token; a null id counts as the empty text in the fold;
without training rows every byte has probability 1/256 and N = V = 0; repeated rows are scored
each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variloom.llm.tables import pick, settle
from variloom.llm.textbytes import NOT_SPACE, Run, content_key, lower, signed, spans, text_runs, word_hashes

DEPTH = 5
MIN_SHARE = 5e-5
HEAVY = 1 << 20
#: Symbols that one cursor scores.
STRETCH = 512
#: Distinct keys that a task gathers before it hands them on.
FLUSH = 3 << 20

_U = np.uint64
_END, _SPACE = 0x0A, 0x20


def stream(run: Run) -> tuple[np.ndarray, ...]:
    """Symbols of all documents, each after DEPTH line feeds; document bases; word hashes and word bounds; where words begin."""
    run.data = lower(run.data)
    starts, ends, bounds = spans(run, NOT_SPACE)
    lengths, words = ends - starts, np.diff(bounds)
    before = np.concatenate(([0], np.cumsum(lengths)))
    sizes = DEPTH + np.diff(before[bounds]) + np.maximum(words, 1)
    bases = np.concatenate(([0], np.cumsum(sizes)))
    out = np.full(bases[-1], _END, np.uint8)
    owner = np.repeat(np.arange(len(run)), words)
    shift = bases[:-1][owner] + DEPTH - before[bounds[:-1]][owner] + np.arange(len(starts)) - bounds[:-1][owner]
    out[np.arange(before[-1]) + np.repeat(shift, lengths)] = run.data[np.arange(before[-1]) + np.repeat(starts - before[:-1], lengths)]
    after = before[1:] + shift
    last = np.zeros(len(starts), bool)
    last[bounds[1:][words > 0] - 1] = True
    out[after[~last]] = _SPACE
    return out, bases, word_hashes(run.data, starts, ends), bounds, before[:-1] + shift


def _real(bases: np.ndarray) -> np.ndarray:
    """Positions of the symbols that count, without the line feeds in front."""
    sizes = np.diff(bases) - DEPTH
    return np.arange(sizes.sum()) + np.repeat(bases[:-1] + DEPTH - (np.cumsum(sizes) - sizes), sizes)


class _Tally:
    def __init__(self, kind: int):
        self.kind, self.parts, self.held = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.held += len(self.parts[-1][0])
        if self.held > FLUSH:
            self._fold()
            if self.held > FLUSH // 2:
                yield from self.rows()

    def _fold(self) -> None:
        keys, n = np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.parts = [(keys[first], np.add.reduceat(n, first))]
        self.held = len(first)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        self._fold()
        keys, n = self.parts[0]
        self.parts, self.held = [], 0
        for a in range(0, len(keys), 1 << 16):
            k = signed(keys[a:a + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), self.kind, np.int32)), pa.array(k), pa.array(n[a:a + (1 << 16)], pa.int64())],
                                             ["kind", "key", "n"])


def count(training: DataFrame, text: str = "text") -> DataFrame:
    """Counts of words (kind 0), byte grams (kind 1) and documents (kind 2), written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams, documents = _Tally(0), _Tally(1), 0
        for batch in batches:
            for r in text_runs(batch.column(0)):
                out, bases, hashes, _, _ = stream(r)
                documents += len(r)
                yield from words.add(hashes)
                wide = out.astype(_U)
                at = _real(bases)
                codes = np.zeros(len(at), _U)
                for k in range(DEPTH, -1, -1):
                    codes = (codes << _U(8)) | wide[at - k]
                yield from grams.add(codes)
        yield from words.rows()
        yield from grams.rows()
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([documents], pa.int64())], ["kind", "key", "n"])

    parts = pick(training, text=text).mapInArrow(run, "kind int, key long, n long")
    return settle(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


class Tree:
    """The kept contexts as an automaton: next state and log10 probability by state and symbol class."""

    def __init__(self, depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray):
        seen = np.unique(symbol)
        self.classes = np.full(256, len(seen), np.int64)
        self.classes[seen] = np.arange(len(seen))
        width = len(seen) + 1
        own: list[dict[int, np.ndarray]] = []
        for k in range(DEPTH + 1):
            row = depth == k
            codes, place = np.unique(context[row], return_inverse=True)
            table = np.zeros((len(codes), width))
            table[place, self.classes[symbol[row]]] = n[row]
            own.append({int(c): table[i] for i, c in enumerate(codes)})
        self._build(own, self._kept(own), width)

    @staticmethod
    def _kept(own: list[dict[int, np.ndarray]]) -> list[set[int]]:
        kept = [set() for _ in range(DEPTH + 1)]
        for k in range(DEPTH, 0, -1):
            mask = (1 << 8 * (k - 1)) - 1
            for code, counts in own[k].items():
                parent = own[k - 1][code & mask]
                total, support = counts.sum(), int((counts > 0).sum())
                at = counts > 0
                divergence = float((counts[at] * np.log(counts[at] / total * parent.sum() / parent[at])).sum())
                if divergence > support * np.log(total) / 2:
                    kept[k].add(code)
            for code in kept[k]:  # a tree has the suffixes of its contexts
                kept[k - 1].add(code & mask)
        return kept

    def _build(self, own, kept, width: int) -> None:
        # all prefixes are states too, so that a state and the next symbol give the next state
        states = [set(s) for s in kept]
        states[0].add(0)
        for k in range(DEPTH, 1, -1):
            states[k - 1].update(code >> 8 for code in states[k])
            states[k - 1].update(code & ((1 << 8 * (k - 1)) - 1) for code in states[k])
        ids: list[dict[int, int]] = []
        start = 0
        for layer in states:
            ids.append({code: start + i for i, code in enumerate(sorted(layer))})
            start += len(layer)
        self.step = np.zeros((start, width), np.int32)
        probability = np.zeros((start, width))
        root = own[0].get(0, np.zeros(width))
        probability[0] = (root + 1) / (root.sum() + 256)
        for k in range(DEPTH + 1):
            mask = (1 << 8 * max(k - 1, 0)) - 1
            for code, i in ids[k].items():
                if k:
                    parent = ids[k - 1][code & mask]
                    self.step[i] = self.step[parent]
                    probability[i] = probability[parent]
                    if code in kept[k]:
                        counts = own[k][code]
                        distinct = int((counts > 0).sum())
                        probability[i] = (counts + distinct * probability[parent]) / (counts.sum() + distinct)
            if k < DEPTH:
                for code, i in ids[k + 1].items():
                    self.step[ids[k][code >> 8], self.classes[code & 255]] = i
        self.log = np.log10(probability).astype(np.float32)
        self.kept = sum(map(len, kept))

    def logs(self, out: np.ndarray, bases: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol of ``stream``; 0 for the line feeds in front."""
        symbols = self.classes[out]
        sizes = np.diff(bases) - DEPTH
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        inner = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRETCH
        at = bases[:-1][owner] + DEPTH + inner
        length = np.minimum(sizes[owner] - inner, STRETCH)
        order = np.argsort(-length, kind="stable")
        at, length = at[order], length[order]
        state, result = np.zeros(len(at), np.int64), np.zeros(len(out))
        active = len(at)
        for t in range(-DEPTH, int(length[0]) if len(length) else 0):
            if t >= 0:
                active = int(np.searchsorted(-length, -t, "left"))
            s, here = state[:active], at[:active] + t
            c = symbols[here]
            if t >= 0:
                result[here] = self.log[s, c]
            state[:active] = self.step[s, c]
        return result


def grow(counts: DataFrame) -> Tree:
    """The tree from ``count`` rows. Only contexts with at least MIN_SHARE of all bytes reach the driver."""
    grams = counts.where("kind = 1")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wide = grams.select("n", F.posexplode(F.array(*[F.expr(f"key & {(1 << 8 * (k + 1)) - 1}L") for k in range(DEPTH + 1)])).alias("depth", "code"))
    flat = settle(wide.groupBy("depth", "code").agg(F.sum("n").alias("n"))
                  .select("depth", F.shiftright("code", 8).alias("context"), F.expr("cast(code & 255 as int)").alias("symbol"), "n"), "grams")
    common = flat.groupBy("depth", "context").agg(F.sum("n").alias("all")).where(F.col("all") >= total * MIN_SHARE)
    got = flat.join(common.select("depth", "context"), ["depth", "context"]).select("depth", "context", "symbol", "n").toArrow()
    return Tree(*[got.column(c).to_numpy() for c in ("depth", "context", "symbol", "n")])


def score(docs: DataFrame, training, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``training`` is a condition on ``docs`` that picks the rows to learn from.
    """
    spark = docs.sparkSession
    counts = count(docs.where(training), text)
    tree = grow(counts)
    words = counts.where("kind = 0").select("key", "n")
    ends = counts.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    seen, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = seen + ends, distinct + (ends > 0)
    low = 1
    if distinct > HEAVY:
        tally = words.where("n < 4096").groupBy("n").count().collect()
        above = distinct - sum(r["count"] for r in tally)
        low = 4096
        for r in sorted(tally, key=lambda r: -r.n):
            if above + r["count"] > HEAVY:
                break
            above, low = above + r["count"], r.n
    heavy = words.where(F.col("n") >= low).toArrow()
    keys = heavy.column("key").to_numpy().view(_U)
    order = np.argsort(keys)
    model = spark.sparkContext.broadcast((tree, keys[order], heavy.column("n").to_numpy()[order], ends))
    rows = pick(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    room = n + v + 1.0
    share_of_end = float(np.log10((ends + 1) / room))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, table, times, ends = model.value
        times = np.append(times, 0)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for r in text_runs(batch.column(1)):
                out[0] += [int.from_bytes(content_key(r.text(i))[:8], "little", signed=True) for i in range(len(r))]
                symbols, bases, hashes, bounds, begin = stream(r)
                place = np.minimum(np.searchsorted(table, hashes), max(len(table) - 1, 0))
                known = table[place] == hashes if len(table) else np.zeros(len(hashes), bool)
                times_here = times[np.where(known, place, -1)]
                logs = _sums(np.log10(times_here + 1.0), bounds)
                size = np.diff(bounds)
                # a unit is a word with the byte after it; the last one has the end token too
                path = np.add.reduceat(tree.logs(symbols, bases), begin) if len(begin) else np.zeros(0)
                bonus = np.zeros(len(path))
                bonus[bounds[1:][size > 0] - 1] = share_of_end
                path -= bonus
                score = _sums(_mixed(path, (times_here + 1.0) / room) + bonus, bounds)
                if (size == 0).any():
                    alone = tree.logs(np.full(DEPTH + 1, _END, np.uint8), np.array([0, DEPTH + 1]))[-1:]
                    score[size == 0] = _mixed(alone, np.array([(ends + 1.0) / room]))[0]
                out[1] += (size + 1).tolist()
                out[2] += (_sums(known, bounds).astype(np.int64) + (ends > 0)).tolist()
                out[3] += (logs + np.log10(ends + 1.0)).tolist()
                light = np.split(~known, bounds[1:-1])
                out[4] += [signed(h)[m] for h, m in zip(np.split(hashes, bounds[1:-1]), light)]
                out[5] += [x[m] for x, m in zip(np.split(path, bounds[1:-1]), light)]
                out[6] += score.tolist()
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, k) for x, k in zip(out, kinds)]],
                                             ["doc_id", "text_key", "n_tokens", "known", "logs", "rare", "path", "score"])

    ddl = f"doc_id {kind}, text_key long, n_tokens long, known long, logs double, rare array<long>, path array<double>, score double"
    scored = settle(rows.mapInArrow(run, ddl), "scored")
    one = scored.groupBy("text_key").agg(F.first(F.arrays_zip("rare", "path")).alias("rare"))
    rare = one.select("text_key", F.explode("rare").alias("r")).select("text_key", F.col("r.rare").alias("key"), F.col("r.path").alias("path"))
    light = words.where(F.col("n") < low)
    path = F.pow(F.lit(10.0), F.col("path"))
    gain = F.log10(path + (F.col("n") + 1.0) / room) - F.log10(path + 1.0 / room)
    found = rare.join(light, "key").groupBy("text_key").agg(
        F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_logs"), F.sum(gain).alias("gain"))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(n + 1.0 * (v + 1)))
    return scored.join(found, "text_key", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"))


_TWO = np.log10(2.0)


def _mixed(path: np.ndarray, share: np.ndarray) -> np.ndarray:
    """log10 of the mean of 10^path and share."""
    return np.logaddexp(path * np.log(10.0), np.log(np.maximum(share, 1e-300))) / np.log(10.0) - _TWO


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the parts of ``x`` between consecutive ``bounds``; an empty part sums to 0."""
    out = np.zeros(len(bounds) - 1)
    full = np.diff(bounds) > 0
    if full.any():
        out[full] = np.add.reduceat(np.asarray(x, float), bounds[:-1][full])
    return out
