"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``size`` consecutive words of the benchmark items (a shorter item is
one window). Patterns of one length form a matcher: a shift table over blocks of two words says
how far a cursor may jump, blocks that end a pattern (shift 0) lead through a bucket of suffix
hashes to the patterns that may end there, and a byte comparison confirms each one. Many cursors,
one per stretch of text, move together.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z become a-z.

Cases: a null text, an empty text or one without word has no words and no hit; an item that is null
or has no word is no pattern; a null item id is dropped from the list of items (its windows still
hit); items that repeat a text all count; repeated documents get one row each; an empty benchmark
hits nothing; other columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variloom.llm.tables import arrow_schema, pick, settle
from variloom.llm.textbytes import WORDLIKE, Run, lower, mix, spans, text_runs, word_hashes

#: Words that one cursor covers before the next one starts.
STRETCH = 256
#: Bytes of benchmark text whose patterns are broadcast at once; a larger benchmark takes several passes.
PATTERN_BYTES = 8 << 20

_U = np.uint64


class Matcher:
    """Shift table, suffix buckets and texts of the patterns of one length in words."""

    def __init__(self, length: int, patterns: dict[bytes, list[int]]):
        self.length, self.width = length, min(2, length)
        self.texts = sorted(patterns)
        self.owners = [patterns[t] for t in self.texts]
        hashes = np.array([_words_of(t)[1] for t in self.texts], dtype=_U).reshape(len(self.texts), length)
        blocks = _blocks(hashes.ravel(), self.width)
        jump = length - self.width + 1
        table: dict[int, int] = {}
        for row in range(len(self.texts)):
            for k in range(jump):
                block = int(blocks[row * length + k])
                table[block] = min(table.get(block, jump), jump - 1 - k)
        self.jump = jump
        self.blocks = np.array(sorted(table), dtype=_U)
        self.shifts = np.array([table[int(b)] for b in self.blocks], dtype=np.int64)
        whole = _whole(hashes)
        order = np.argsort(whole, kind="stable")
        self.suffixes, self.order = whole[order], order

    def search(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern bucket position of every candidate; ``bounds`` part the documents."""
        n, m = len(words), self.length
        if n < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        blocks = _blocks(words, self.width)
        firsts, lasts = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= m:
                s = np.arange(a + m - 1, b, STRETCH)
                firsts.append(s)
                lasts.append(np.minimum(s + STRETCH, b))
        if not firsts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, stop = np.concatenate(firsts), np.concatenate(lasts)
        found = []
        while len(at):
            here = blocks[at - self.width + 1]
            slot = np.minimum(np.searchsorted(self.blocks, here), len(self.blocks) - 1)
            step = np.where(self.blocks[slot] == here, self.shifts[slot], self.jump)
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        starts = np.concatenate(found) - m + 1
        whole = _whole(words[starts[:, None] + np.arange(m)]) if len(starts) else np.zeros(0, _U)
        low, high = np.searchsorted(self.suffixes, whole), np.searchsorted(self.suffixes, whole, "right")
        count = high - low
        spread = np.repeat(np.arange(len(starts)), count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return starts[spread], self.order[low[spread] + inner]


def _blocks(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on (the tail of the array is padding)."""
    if width == 1:
        return words
    return mix(words + mix(np.append(words[1:], _U(0))))


def _whole(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(rows.shape[0], _U)
    for k in range(rows.shape[1]):
        out = mix(out + rows[:, k] * _U(2 * k + 1))
    return out


def _words_of(text: bytes | str | None) -> tuple[list[bytes], np.ndarray]:
    raw = text.encode() if isinstance(text, str) else text or b""
    run = Run(0, lower(np.frombuffer(raw, np.uint8)), np.array([0, len(raw)]), np.zeros(1, bool))
    starts, ends, _ = spans(run, WORDLIKE)
    return [raw_word.tobytes() for raw_word in (run.data[a:b] for a, b in zip(starts, ends))], word_hashes(run.data, starts, ends)


def build(items: list[tuple[object, str | None]], size: int) -> tuple[list[Matcher], list]:
    """Matchers by pattern length, and the item ids that patterns point to."""
    ids, by_length = [], {}
    for number, (item, text) in enumerate(items):
        words = _words_of(text)[0]
        ids.append(item)
        length = min(size, len(words))
        for k in range(len(words) - length + 1 if length else 0):
            owners = by_length.setdefault(length, {}).setdefault(b" ".join(words[k:k + length]), [])
            if not owners or owners[-1] != number:
                owners.append(number)
    return [Matcher(n, p) for n, p in sorted(by_length.items())], ids


def _hits(run: Run, matchers: list[Matcher]) -> tuple[np.ndarray, list[np.ndarray], list[set[int]]]:
    """For each document: its number of words, its hit words as flags, and the items found."""
    run.data = lower(run.data)
    starts, ends, bounds = spans(run, WORDLIKE)
    words = word_hashes(run.data, starts, ends)
    cover = np.zeros(len(words) + 1, np.int64)
    items: list[set[int]] = [set() for _ in range(len(run))]
    raw = run.data.tobytes()
    for m in matchers:
        first, pattern = m.search(words, bounds)
        documents = np.searchsorted(bounds, first, "right") - 1
        for f, p, d in zip(first.tolist(), pattern.tolist(), documents.tolist()):
            text = b" ".join(raw[a:b] for a, b in zip(starts[f:f + m.length].tolist(), ends[f:f + m.length].tolist()))
            if text == m.texts[p]:
                cover[f] += 1
                cover[f + m.length] -= 1
                items[d].update(m.owners[p])
    hit = np.cumsum(cover[:-1]) > 0
    return np.diff(bounds), [hit[a:b] for a, b in zip(bounds[:-1], bounds[1:])], items


def _intervals(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  size: int = 13, pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_from`` and ``hit_to`` (word runs inside an occurrence) and ``items``.

    The four columns replace columns of those names. The benchmark is taken in blocks of at most
    ``pattern_bytes`` of text (one item may be longer); each block is one pass over the documents.
    """
    spark = docs.sparkSession
    items = pick(benchmark, item=item_id, body=item_text)
    items = items.where(F.col("body").isNotNull()).select(F.col("item").cast("string").alias("item"), "body")
    total = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // pattern_bytes))
    number = F.pmod(F.xxhash64("body"), F.lit(blocks))
    own = {"n_words", "hit_from", "hit_to", "items"}
    kept = [c for c in docs.columns if c.lower() not in own]
    out = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<long>").alias("hit_from"), F.array().cast("array<long>").alias("hit_to"),
                      F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        rows = [(r.item, r.body) for r in items.where(number == k).toLocalIterator()] if blocks > 1 else \
            [(r.item, r.body) for r in items.collect()]
        shared = spark.sparkContext.broadcast((rows, size))
        out = out.mapInArrow(_marker(shared, text), out.schema)
        if k + 1 < blocks:
            out = settle(out, "passages")
    return out


def _marker(shared, text: str):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers, ids = build(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            n_words, starts, ends, items = [], [], [], []
            earlier = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("hit_from", "hit_to", "items")]
            row = 0
            for run in text_runs(batch.column(batch.schema.get_field_index(text))):
                counts, flags, found = _hits(run, matchers)
                n_words += counts.tolist()
                for hit, got in zip(flags, found):
                    for a, b in zip(earlier[0][row], earlier[1][row]):
                        hit[a:b] = True
                    a, b = _intervals(hit)
                    starts.append(a)
                    ends.append(b)
                    items.append(sorted({*earlier[2][row], *(ids[i] for i in got if ids[i] is not None)}))
                    row += 1
            new = {"n_words": n_words, "hit_from": starts, "hit_to": ends, "items": items}
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[f.name], f.type) if f.name in new else batch.column(i) for i, f in enumerate(batch.schema)],
                schema=batch.schema)

    return mark


def judged(found: DataFrame) -> DataFrame:
    """``find_passages`` with ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    n_hit = F.expr("aggregate(zip_with(hit_from, hit_to, (a, b) -> b - a), 0L, (s, x) -> s + x)")
    return (found.withColumn("n_hit", n_hit)
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("items"), ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns and texts."""
    return judged(find_passages(docs, benchmark, **options)).where(~F.col("contaminated")).select(*docs.columns)
