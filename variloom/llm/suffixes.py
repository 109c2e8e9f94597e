"""Removal of repeated long byte strings, by suffix sorting around shared anchors.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else, in the same
document or another. Two equal strings choose the same anchor (``anchors``), so strings are compared
only among the regions of one anchor hash:

1. anchors that occur once are dropped, before any text moves;
2. a region that occurs twice as a whole is repeated as a whole;
3. the distinct other regions of an anchor meet in one task. Their strings are put in suffix order
   by two-stage sorting: suffixes smaller than their successor are sorted directly, all others are
   induced by one scan over the first-byte buckets. Adjacent suffixes with a common prefix of at
   least ``length`` bytes are repeated. Anchors with very many distinct regions are compared in
   blocks of ``GROUP`` regions, every block with every other.

Documents are known by their content, so copies share one answer.

Cases: null and empty texts have no bytes and lose none; a text shorter than ``length`` stays;
repeated rows are copies of each other and lose everything if long enough; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variloom.llm.anchors import SLICE, anchors
from variloom.llm.tables import pick, settle
from variloom.llm.textbytes import content_key, signed, text_runs

GRAM = 24
#: Distinct regions of one anchor compared in one task, and bytes sorted at once.
GROUP, SORT_BYTES = 4096, 1 << 20
#: Bytes of region text for each task that sorts.
TASK_BYTES = 16 << 20


def _keys(run) -> np.ndarray:
    return np.array([int.from_bytes(content_key(run.text(i))[:8], "little", signed=True) for i in range(len(run))], np.int64)


def _regions(texts: DataFrame, length: int) -> DataFrame:
    """``anchor``, ``region``, ``doc``, ``at`` (its first string) and ``width`` (its strings) of all regions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in text_runs(batch.column(0), SLICE):
                keys = _keys(r)
                for anchor, region, document, at, width in anchors(r.data, r.starts, length, GRAM):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(anchor)), pa.array(signed(region)), pa.array(keys[document]), pa.array(at.astype(np.int32)), pa.array(width.astype(np.int32))],
                        ["anchor", "region", "doc", "at", "width"])

    return texts.mapInArrow(run, "anchor long, region long, doc long, at int, width int")


def _anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """``anchor``, ``low``, ``high`` and ``n`` regions, counted inside each batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(a, r) for t in text_runs(batch.column(0), SLICE) for a, r, *_ in anchors(t.data, t.starts, length, GRAM)]
            if not found:
                continue
            anchor, region = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((region, anchor))
            anchor, region = anchor[order], region[order]
            first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            last = np.append(first[1:], len(anchor)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(anchor[first])), pa.array(signed(region[first])), pa.array(signed(region[last])), pa.array(last - first + 1, pa.int64())],
                ["anchor", "low", "high", "n"])

    # inside a batch regions are ordered as unsigned numbers; only whether they differ matters
    return texts.mapInArrow(run, "anchor long, low long, high long, n long")


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` places of ``text`` in order of the first ``depth`` bytes from there, by two-stage sorting.

    ``text`` must end in ``depth`` zero bytes of padding after the last wanted place's string.
    """
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    # a run of equal bytes is smaller than its successor if the next other byte is larger; the last run counts as smaller
    run_end = np.append(change, n - 1)
    run_of = np.searchsorted(run_end, np.arange(n))
    following = text[np.minimum(run_end + 1, n - 1)]
    smaller = (following > text[run_end])
    smaller[-1] = True
    direct = smaller[run_of]
    # inducing a place needs the next one, up to the first that is sorted directly
    needed = np.zeros(n, bool)
    needed[wanted] = True
    spots = np.flatnonzero(direct)
    tail = wanted[~needed[np.minimum(wanted + 1, n - 1)]]
    stop = spots[np.searchsorted(spots, tail)]
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, tail, 1)
    np.add.at(mark, stop + 1, -1)
    needed |= np.cumsum(mark[:-1]) > 0

    own = np.flatnonzero(needed & direct)
    padded = np.concatenate((text, np.zeros(depth, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[own]
    own = own[np.argsort(np.ascontiguousarray(rows).view(f"S{depth}").ravel())]
    edges = np.searchsorted(text[own], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in np.unique(text[needed]).tolist():
        layer = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        bucket = [layer]
        while len(layer):  # equal bytes before: induced from the same bucket
            before = layer[layer > 0] - 1
            layer = before[needed[before] & (text[before] == c)]
            bucket.append(layer)
        bucket.append(own[edges[c]:edges[c + 1]])
        scanned = np.concatenate(bucket)
        out.append(scanned)
        before = scanned[scanned > 0] - 1
        before = before[needed[before]]
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cut = np.flatnonzero(byte[1:] != byte[:-1]) + 1
        for part in np.split(before, cut) if len(before) else []:
            waiting[int(text[part[0]])].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    keep = np.zeros(n, bool)
    keep[wanted] = True
    return order[keep[order]]


def repeated_places(text: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Those of the ``wanted`` places whose ``length`` bytes also start at another of them."""
    order = suffix_order(text, wanted, length)
    padded = np.concatenate((text, np.zeros(length, np.uint8)))
    pair = np.arange(len(order) - 1)
    prefix = np.zeros(len(pair), np.int64)  # common prefix of neighbours, in whole steps
    at = 0
    while len(pair) and at < length:
        step = min(20, length - at)
        window = np.lib.stride_tricks.sliding_window_view(padded, step)
        same = (window[order[pair] + at] == window[order[pair + 1] + at]).all(axis=1)
        pair = pair[same]
        at += step
        prefix[pair] = at
    full = np.flatnonzero(prefix >= length)
    return np.union1d(order[full], order[full + 1])


def _matched(length: int):
    """Sorted (tag, region, width, body) rows to (anchor, region, low, high) of repeated strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tag = 0, None
        met: dict[tuple, tuple] = {}  # a region may come in several pairs of blocks, but is not its own copy

        def flush() -> pa.RecordBatch:
            rows = list(met.values())
            text = np.frombuffer(b"".join(r[3] for r in rows) + bytes(length), np.uint8)
            sizes = np.array([len(r[3]) for r in rows])
            begin = np.cumsum(sizes) - sizes
            width = np.array([r[2] for r in rows], np.int64)
            wanted = np.arange(width.sum()) + np.repeat(begin - (np.cumsum(width) - width), width)
            places = repeated_places(text, wanted, length)
            owner = np.searchsorted(begin, places, "right") - 1
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
            last = np.append(first[1:], len(owner)) - 1 if len(owner) else first
            who = owner[first]
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[i][0] for i in who], pa.int64()), pa.array([rows[i][1] for i in who], pa.int64()),
                 pa.array((places[first] - begin[who]).astype(np.int32)), pa.array((places[last] - begin[who]).astype(np.int32))], ["anchor", "region", "low", "high"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if held >= SORT_BYTES and (row[0], row[4]) != tag:
                    yield flush()
                    met.clear()
                    held = 0
                tag = (row[0], row[4])
                if met.setdefault(row[:2], row) is row:
                    held += len(row[3])
        if met:
            yield flush()

    return run


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans``, ``cut_from`` and ``cut_to`` of every row."""
    source = pick(docs, doc_id=doc_id, text=text)
    texts = source.where(F.octet_length("text") >= length).select("text")
    twice = (_anchor_counts(texts, length).groupBy("anchor").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.min("high").alias("low2"),
                                                                 F.max("low").alias("high2"), F.max("high").alias("high"))
             .where("n > 1").select("anchor", (F.greatest("high", "high2") != F.least("low", "low2")).alias("mixed")))
    placed = settle(_regions(texts, length).join(settle(twice, "anchors"), "anchor"), "regions")
    mixed = placed.where("mixed").groupBy("anchor", "region").agg(F.count("*").alias("n"), F.min(F.struct("doc", "at", "width")).alias("one"))
    mixed = settle(mixed.select("anchor", "region", "n", "one.*"), "distinct")
    found = settle(_compare(source, mixed, length), "found")
    strings = F.col("at") + F.col("width") - 1 + length
    spans = (placed.where("not mixed").select("doc", F.col("at").alias("a"), strings.alias("b"))
             .union(placed.where("mixed").join(mixed.where("n > 1").select("anchor", "region"), ["anchor", "region"]).select("doc", "at", strings))
             .union(mixed.where("n = 1").join(found, ["anchor", "region"]).select("doc", F.col("at") + F.col("low"), F.col("at") + F.col("high") + length)))
    spans = spans.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    kind = source.schema["doc_id"].dataType.simpleString()
    packed = _packed(source, kind)
    joined = packed.join(spans, "doc", "left").select("doc_id", "packed", F.col("spans.a").alias("a"), F.col("spans.b").alias("b"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies, lows, highs = (batch.column(i) for i in range(4))
            for begin in range(0, len(ids), 256):
                out: list[list] = [[] for _ in range(6)]
                part = [c.slice(begin, 256).to_pylist() for c in (bodies, lows, highs)]
                for body, low, high in zip(*part):
                    raw = zstandard.decompress(body) if body else b""
                    runs = _union(low or [], high or [])
                    edge = [0, *[x for r in runs for x in r], len(raw)]
                    out[0].append(b"".join(raw[a:b] for a, b in zip(edge[::2], edge[1::2])))
                    out[1].append(len(raw))
                    out[2].append(sum(b - a for a, b in runs))
                    out[3].append(len(runs))
                    out[4].append([a for a, _ in runs])
                    out[5].append([b for _, b in runs])
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([ids.slice(begin, 256), *[pa.array(x, k) for x, k in zip(out, kinds)]],
                                                 ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "cut_from", "cut_to"])

    return joined.mapInArrow(cut, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long, cut_from array<long>, cut_to array<long>")


def _union(low: list[int], high: list[int]) -> list[list[int]]:
    """Maximal runs of intervals that overlap or touch."""
    out: list[list[int]] = []
    for a, b in sorted(zip(low, high)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _packed(source: DataFrame, kind: str) -> DataFrame:
    """``doc_id``, ``doc`` (content key) and the compressed text, for a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            keys, bodies = [], []
            for r in text_runs(batch.column(1)):
                keys.append(_keys(r))
                bodies += [pack.compress(r.text(i)) if r.starts[i] < r.starts[i + 1] else None for i in range(len(r))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), pa.array(bodies, pa.binary())],
                                             ["doc_id", "doc", "packed"])

    return source.mapInArrow(run, f"doc_id {kind}, doc long, packed binary")


def _compare(source: DataFrame, mixed: DataFrame, length: int) -> DataFrame:
    """``anchor``, ``region``, ``low``, ``high``: first and last string of a region that another region has too."""
    size = mixed.groupBy("anchor").agg(F.count("*").alias("regions"), F.max("n").alias("most"))
    parted = mixed.join(size.select("anchor", F.ceil(F.col("regions") / GROUP).cast("int").alias("parts")), "anchor")
    wanted = parted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "region", "at", "width", "parts")).alias("w"))
    bodies = _packed(source, source.schema["doc_id"].dataType.simpleString()).drop("doc_id").join(wanted, "doc")
    total = mixed.agg(F.coalesce(F.sum(F.col("width") + length - 1), F.lit(0))).first()[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                for packed, w in zip(batch.column(0).slice(begin, 256).to_pylist(), batch.column(1).slice(begin, 256).to_pylist()):
                    raw = zstandard.decompress(packed)
                    out += [(x["anchor"], x["region"], x["width"], raw[x["at"]:x["at"] + x["width"] + length - 1], x["parts"]) for x in w]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["anchor", "region", "width", "body", "parts"])

    rows = bodies.select("packed", "w").mapInArrow(cut, "anchor long, region long, width int, body binary, parts int")
    mine = F.pmod(F.xxhash64("region"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("mine", mine).withColumn("other", other)
    rows = rows.withColumn("pair", F.least("mine", "other") * F.col("parts") + F.greatest("mine", "other"))
    rows = rows.repartition(max(1, -(-total // TASK_BYTES)), "anchor", "pair").sortWithinPartitions("anchor", "pair")
    hits = rows.select("anchor", "region", "width", "body", "pair").mapInArrow(_matched(length), "anchor long, region long, low int, high int")
    return hits.groupBy("anchor", "region").agg(F.min("low").alias("low"), F.max("high").alias("high"))
