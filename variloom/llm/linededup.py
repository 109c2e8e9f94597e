"""Fuzzy line deduplication: SimHash and MinHash blocks, edit similarity, connected groups.

A line is normalised to its words (ASCII letters in lower case, digits, everything outside ASCII)
joined by single spaces. Its SimHash has ``BLOCKS`` blocks of 32 bits over its distinct words. Lines that
agree on a block are candidates (so all pairs that differ in fewer bits than there are blocks). As one
changed word flips many bits, lines are candidates also if they agree on one of ``BANDS`` bands of minima
over their word pairs or, up to ``SHORT`` bytes, over their runs of five bytes with a rough place. Two candidates link if their edit similarity, 1 - distance / longer length in characters of the
normalised lines, is at least ``similarity``. Of each connected group of lines the first
occurrence stays, by document id (nulls last), then content, then line number.

Cases: a line without word is never a duplicate and stays; a null text stays null and has no
lines; an empty text has one line without word; of rows that repeat id and text the first keeps
what the group allows, the others lose all lines with words; an empty table gives an empty result;
all columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variloom.llm.linking import link
from variloom.llm.tables import settle, spare
from variloom.llm.textbytes import WORDLIKE, content_key, mix, signed, word_hashes

BLOCKS = 6
#: Further candidates share a band of ``ROWS`` minima over a line's runs of five bytes, or its word pairs.
BANDS, ROWS = 12, 4
#: Bytes of a normalised line up to which runs are taken; below TINY no edit is allowed.
TINY, SHORT = 10, 170
#: Bytes over which a run's place counts as the same.
PLACE = 32
#: Edits up to which diagonals are followed one by one.
FEW = 8
#: Characters up to which the distance comes from the whole table, and beyond from all diagonals at once.
WIDE = 8192
#: Pairs compared at once at least, for each number of a column, and at most, the bytes they take, and steps after which pairs beyond their bound are left.
FEW_PAIRS, TOGETHER, TOGETHER_BYTES, CHECKED = 12, 2048, 8 << 20, 32
#: Lines of a block that take their turn at once at most.
TURN = 64
#: Bits and bytes of the lines of a chunk at most (one longer line is a chunk), and keys that a part of all keys should have.
CHUNK_BITS, CHUNK_BYTES, PART_KEYS = 14, 4 << 20, 1 << 21
#: States of a key's entry: to be judged by its part, already known to be shared, standing for those of its chunk.
OPEN, PASSED, MET = 0, 1, 2
#: Lines of a task, as bits.
TASK_BITS = 39
#: Bytes of text hashed at once.
RUN = 2 << 20
#: Numbers whose minima are taken at once.
CACHED = 1 << 15
#: Words of a line that are counted bit by bit at once.
PLANES = 8

_U = np.uint64
_FULL = _U((1 << 64) - 1)
#: A-Z to a-z, bytes outside words to spaces but for line feeds.
_PLAIN = bytes(c if c == 0x0A else c + 32 if 0x41 <= c <= 0x5A else c if WORDLIKE[c] else 0x20 for c in range(256))


def _simhash(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``BLOCKS`` 32-bit blocks for each part of ``words`` between ``bounds``: bits set in more than half of its distinct words."""
    out = np.zeros((len(bounds) - 1, BLOCKS // 2), _U)
    # distinct words of each part; repeated ones, above all stop words, would pull unlike lines together
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(_U)
    marked = part << _U(40) | words >> _U(24)
    marked.sort()
    marked = marked[np.append(True, marked[1:] != marked[:-1])[:len(marked)]]
    bounds = np.searchsorted(marked, np.arange(len(bounds)).astype(_U) << _U(40))
    words = marked & _U((1 << 40) - 1)
    # parts of many words are counted in pieces, the largest first: a step adds one word to all pieces that have another
    most = (1 << PLANES) - 1
    sizes = np.diff(bounds)
    pieces = -(-sizes // most)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    inner = most * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(sizes[owner] - inner, most)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = (bounds[owner] + inner)[order], size[order], owner[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")
    single = pieces[owner] == 1
    half = (size // 2).astype(_U)
    for k in range(BLOCKS // 2):
        codes = mix(words + _U(0xA0761D6478BD642F * (k + 1) & (1 << 64) - 1))
        # the counters of all 64 bits of a code, a bit of every counter in one number
        planes = np.zeros((PLANES, len(size)), _U)
        for t, n in enumerate(active.tolist()):
            add = codes[begin[:n] + t]
            for plane in planes[:(t + 1).bit_length(), :n]:
                carry = plane & add
                plane ^= add
                add = carry
        above, even = np.zeros(len(size), _U), np.full(len(size), _FULL)
        for p in range(PLANES - 1, -1, -1):
            bound = -(half >> _U(p) & _U(1))
            above |= even & planes[p] & ~bound
            even &= ~(planes[p] ^ bound)
        out[owner[single], k] = above[single]
        for i in np.unique(owner[~single]).tolist():
            counts = sum(np.unpackbits(plane[owner == i].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64) << p for p, plane in enumerate(planes))
            out[i, k] = np.packbits(2 * counts > sizes[i]).view(_U)[0]
    return out.view(np.uint32)


def bands(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``BANDS`` keys for each consecutive part of ``elements``; no part is empty."""
    out = np.zeros((len(sizes), BANDS), _U)
    least = np.empty((BANDS * ROWS, len(sizes)), _U)
    odds = [_U((0x9E3779B97F4A7C15 * (2 * k + 1) ^ k << 33) & (1 << 64) - 1 | 1) for k in range(BANDS * ROWS)]
    ends = np.cumsum(sizes)
    # stretches of parts whose numbers stay in the cache
    stretch = (np.flatnonzero(np.diff(ends // CACHED)) + 1).tolist()
    for low, high in zip([0, *stretch], [*stretch, len(sizes)] if len(sizes) else []):
        begin = ends[low:high] - sizes[low:high]
        part, begin = elements[begin[0]:ends[high - 1]], begin - begin[0]
        x, y = np.empty_like(part), np.empty_like(part)
        for k, odd in enumerate(odds):
            np.multiply(part, odd, out=x)
            np.right_shift(x, _U(32), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, odd, out=x)
            np.minimum.reduceat(x, begin, out=least[k, low:high])
    for k, row in enumerate(least):
        out[:, k // ROWS] = mix(out[:, k // ROWS] + row)
    return out


def _parts(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the given stretches, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


def simhash(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The blocks of each part of ``words`` between ``bounds``: those of its SimHash, and 40 bits for each band over its word pairs."""
    before = np.concatenate(([_U(0)], words[:-1]))[:len(words)]
    before[bounds[:-1][np.diff(bounds) > 0]] = 0
    full = np.flatnonzero(np.diff(bounds) > 0)
    pairs = np.zeros((len(bounds) - 1, BANDS), _U)
    pairs[full] = bands(mix(before * _U(3) + mix(words)), np.diff(bounds)[full]) & _U((1 << 40) - 1)
    return np.concatenate((_simhash(words, bounds).astype(_U), pairs), axis=1)


def run_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are short, and the bands over the runs of each of them; a line is ``data[starts:ends]``."""
    sizes = ends - starts + 1
    short = np.flatnonzero((sizes >= TINY) & (sizes <= SHORT))
    sizes = sizes[short] - 4
    at = _parts(starts[short], sizes)
    wide = np.concatenate((data, np.zeros(8, np.uint8)))
    runs = np.ndarray(len(data), "<u8", wide, strides=(1,))[at] & _U((1 << 40) - 1)
    place = (at - np.repeat(starts[short], sizes)) // PLACE
    return short, bands(mix(runs | place.astype(_U) << _U(40)), sizes)


def _entries(lines: list[bytes], places: np.ndarray) -> np.ndarray:
    """All keys of normalised ``lines``: the key in the upper 48 bits, the line's place in the lower 14."""
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    breaks = np.flatnonzero(data <= 0x20)
    last = np.flatnonzero(data[breaks] == 0x0A)
    starts, bounds = np.append(0, breaks[:-1] + 1), np.append(0, last + 1)
    sim = simhash(word_hashes(data, starts, breaks), bounds)
    short, runs = run_keys(np.where(data == 0x0A, np.uint8(0x20), data), starts[bounds[:-1]], breaks[last])
    column = lambda k, n: mix(np.arange(k + 1, k + n + 1, dtype=_U))
    place = places.astype(_U)[:, None]
    low = _U((1 << 16) - 1)
    both = (mix(sim + column(0, sim.shape[1])) & ~low | place, mix(runs + column(sim.shape[1], BANDS)) & ~low | place[short])
    return np.concatenate([x.ravel() for x in both])


def _key(text: bytes | None) -> int:
    return int.from_bytes(content_key(text)[:8], "little", signed=True)


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def _strings(texts: list[bytes | None]) -> pa.Array:
    try:
        return pa.array(texts, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x if x is None else x.decode("utf-8", "replace") for x in texts], pa.string())


def normalised(texts: list[bytes]) -> list[bytes]:
    """The words of each line, joined by single spaces, of all texts one after the other."""
    data = np.frombuffer(b"\n".join(texts).translate(_PLAIN), np.uint8)
    # a space stays after a word only, and not before a line feed
    kept = data != 0x20
    kept[1:] |= data[:-1] > 0x20
    return data[kept].tobytes().replace(b" \n", b"\n").removesuffix(b" ").split(b"\n") if texts else []


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with words, and chunks of normalised lines.

    A line has ``doc_id``, ``doc`` (content key), ``no``, ``line`` (64 bits of its words) and ``id``: the number of its
    chunk and its place there. A chunk has its first ``id`` and ``texts``; it holds a line once.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "doc", "no", "line", "id", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        base = TaskContext.get().partitionId() << TASK_BITS
        held: dict[bytes, int] = {}
        texts: list[bytes] = []
        size = 0
        none = None

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([none, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([base], pa.int64()),
                                               pa.array([pack.compress(b"\n".join(texts))], pa.binary())], names)

        for batch in batches:
            none = pa.nulls(1, batch.column(0).type)
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                own = _bytes(part.column(1))
                rows = [row for row, text in enumerate(own) if text]
                lines = normalised([own[row] for row in rows])
                counts = np.array([own[row].count(b"\n") + 1 for row in rows], np.int64)
                keys, ids = [], []
                for line in lines:
                    if line:
                        key = content_key(line)[:8]
                        if (at := held.get(key)) is None:
                            if size + len(line) > CHUNK_BYTES and texts or len(texts) >> CHUNK_BITS:
                                yield chunk()
                                base, held, texts, size = base + (1 << CHUNK_BITS), {}, [], 0
                            at = held[key] = base + len(texts)
                            texts.append(line)
                            size += len(line)
                        keys.append(key)
                        ids.append(at)
                full = np.array(list(map(bool, lines)), bool)
                owner, no = np.repeat(np.array(rows, np.int64), counts)[full], _parts(np.zeros(len(counts), np.int64), counts)[full]
                docs = np.array([_key(own[row]) for row in rows], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), pa.array(np.repeat(docs, counts)[full]), pa.array(no.astype(np.int32)), pa.array(np.frombuffer(b"".join(keys), np.int64)),
                     pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.binary())], names)
        if texts:
            yield chunk()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, doc long, no int, line long, id long, texts binary")


def _wanted(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """``base``, ``texts`` and the wanted ``places`` of the chunks (``id``, ``texts``) that hold some of ``ids``."""
    low = F.lit((1 << CHUNK_BITS) - 1)
    places = ids.groupBy((F.col("id") - F.col("id").bitwiseAND(low)).alias("base")).agg(F.collect_list(F.col("id").bitwiseAND(low).cast("int")).alias("places"))
    return chunks.withColumnRenamed("id", "base").join(places, "base")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """The first id, the wanted places and their lines for each chunk."""
    for batch in batches:
        for row in range(batch.num_rows):
            lines = zstandard.decompress(batch.column(1)[row].as_py()).split(b"\n")
            places = np.sort(batch.column(2)[row].values.to_numpy(zero_copy_only=False))
            yield batch.column(0)[row].as_py(), places, [lines[i] for i in places.tolist()]


def _payloads(wanted: DataFrame) -> DataFrame:
    """``id``, ``payload`` (normalised line) and ``weight`` of the wanted lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for base, places, lines in _opened(batches):
            texts = [x.decode("utf-8", "replace") for x in lines]
            yield pa.RecordBatch.from_arrays([pa.array(base + places.astype(np.int64)), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["id", "payload", "weight"])

    return wanted.select("base", "texts", "places").mapInArrow(run, "id long, payload string, weight long")


def shared_keys(wanted: DataFrame, parts: int) -> DataFrame:
    """``key`` and ``id`` of the keys that at least two lines of ``wanted`` have.

    Keys are hashed into ``parts``; a part gets, for each chunk of lines, a blob of eight bytes a key. Keys that
    several lines of a chunk share are known to be shared: all but one go to parts by key and chunk, to be passed on only.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for base, places, lines in _opened(batches):
            run = np.cumsum([len(x) + 1 for x in lines]) // RUN
            cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(lines)]
            entries = np.concatenate([_entries(lines[a:b], places[a:b]) for a, b in zip(cuts, cuts[1:])])
            entries.sort()
            yield _dealt(entries, base, parts)

    def gather(part: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, _U) for x in part.column("entries").to_pylist()]
        base = np.repeat(part.column("base").to_numpy(), [len(x) for x in blobs])
        entries = np.concatenate(blobs)
        key, state, ids = entries >> _U(16), entries >> _U(14) & _U(3), base + (entries & _U((1 << 14) - 1)).astype(np.int64)
        passed = state == PASSED
        judged = np.flatnonzero(~passed)
        judged = judged[np.argsort(key[judged], kind="stable")]
        same = key[judged][1:] == key[judged][:-1]
        twice = np.append(same, False) | np.insert(same, 0, False) if len(judged) else np.zeros(0, bool)
        found = judged[twice & (state[judged] == OPEN)]
        out = np.concatenate((np.flatnonzero(passed), found))
        return pa.table({"key": pa.array(signed(key[out])), "id": pa.array(ids[out])})

    dealt = wanted.select("base", "texts", "places").mapInArrow(deal, "part int, base long, entries binary")
    return dealt.groupBy("part").applyInArrow(gather, "key long, id long")


def _dealt(entries: np.ndarray, base: int, parts: int) -> pa.RecordBatch:
    """A chunk's sorted entries by part, those of keys shared inside the chunk passed on and one of each left to be met."""
    key = entries >> _U(16)
    same = np.append(key[1:] == key[:-1], False)[:len(key)]
    again = np.insert(same[:-1], 0, False)[:len(key)]
    shared = same | again
    part = (mix(key) % _U(parts)).astype(np.int32)
    salted = (mix(key[shared] + mix(np.array([base], np.int64).view(_U))) % _U(parts)).astype(np.int32)
    lead = same & ~again
    part = np.concatenate((part[~shared], salted, part[lead]))
    entries = np.concatenate((entries[~shared], entries[shared] | _U(PASSED << 14), entries[lead] | _U(MET << 14)))
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    part, entries = part[order], entries[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
    blobs = [entries[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]) if blobs else pa.array([], pa.int32()), pa.array([base] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())],
                                      ["part", "base", "entries"])


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance if at most ``most``, else ``most + 1``, by furthest reach on diagonals."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    n, m = len(a), len(b)
    if not n or not m:
        return n + m

    def slide(x: int, y: int) -> int:
        size = 16
        while x < n and y < m:
            if a[x:x + size] == b[y:y + size] and x + size <= n and y + size <= m:
                x, y, size = x + size, y + size, size * 2
            elif a[x] == b[y]:
                x, y, size = x + 1, y + 1, max(1, size // 2)
            else:
                break
        return x

    reach = {0: slide(0, 0)}
    if reach[0] == n and n == m:
        return 0
    for e in range(1, min(most, FEW) + 1):
        new = {}
        for k in range(-e, e + 1):  # k: place in b minus place in a
            x = max(reach.get(k, -2) + 1, reach.get(k + 1, -2) + 1, reach.get(k - 1, -1))
            x = min(x, n, m - k)
            if x < 0 or x + k < 0:
                continue
            new[k] = slide(x, x + k)
            if new[k] == n and n + k == m:
                return e
        reach = new
    if most <= FEW:
        return most + 1
    if max(n, m) <= WIDE:
        return min(_bit_parallel(a, b), most + 1)
    # many diagonals: all of them at once, only long slides one by one
    left, right = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    at = np.array([reach.get(k, -2) for k in range(-FEW, FEW + 1)])
    for e in range(FEW + 1, most + 1):
        k = np.arange(-e, e + 1)
        old = np.concatenate(([-2, -2], at, [-2, -2]))
        at = np.maximum(np.maximum(old[1:-1], old[2:]) + 1, old[:-2])
        at = np.minimum(np.minimum(at, n), m - k)
        at[(at < 0) | (at + k < 0)] = -2
        alive = np.flatnonzero((at >= 0) & (at < n) & (at + k < m))
        for _ in range(4):
            alive = alive[left[at[alive]] == right[at[alive] + k[alive]]]
            at[alive] += 1
            alive = alive[(at[alive] < n) & (at[alive] + k[alive] < m)]
        for i in alive.tolist():
            at[i] = slide(int(at[i]), int(at[i] + k[i]))
        if abs(m - n) <= e and at[m - n + e] == n:
            return e
    return most + 1


def _bit_parallel(a: str, b: str) -> int:
    """Levenshtein distance with a column of the table as bits of whole numbers."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top, distance = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for c in b:
        same = places.get(c, 0)
        flat = same | down
        carry = (((same & up) + up) ^ up) | same
        rise, fall = down | full & ~(carry | up), up & carry
        distance += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full
        up, down = fall | full & ~(flat | rise), rise & flat
    return distance


def within_bound(lefts: list[str], rights: list[str], mosts: np.ndarray) -> np.ndarray:
    """Whether the edit distance of each pair is at most its bound; many pairs at once.

    Few diagonals come first: a path on them proves a pair, and only pairs without one go on to twice as many.
    """
    sizes = np.array([[len(x), len(y)] for x, y in zip(lefts, rights)], np.int64).reshape(-1, 2)
    steps, gap = sizes.min(axis=1), np.abs(sizes[:, 0] - sizes[:, 1])
    out = np.array([x == y for x, y in zip(lefts, rights)], bool) & (mosts >= 0)
    alone = np.zeros(len(out), bool)
    left = np.flatnonzero(~out & (gap <= mosts) & (mosts > 0))
    width = 1
    while len(left):
        fits = gap[left] < 64 * width
        now = left[fits][np.argsort(-steps[left[fits]], kind="stable")]
        at = 0
        while at < len(now):
            # a few pairs, and a few much longer than the rest, cost less one by one
            next_ = at + FEW_PAIRS * (1 + width)
            if next_ >= len(now) or steps[now[at]] > 2 * steps[now[next_]]:
                i = int(now[at])
                out[i] = _one_banded(*sorted((lefts[i], rights[i]), key=len), int(mosts[i]))
                alone[i] = True
                at += 1
                continue
            room = TOGETHER_BYTES // (2 * int(steps[now[at]]) + 128 * width) + 1
            some = now[at:at + min(TOGETHER, room)]
            pairs = [(lefts[i], rights[i]) if len(lefts[i]) >= len(rights[i]) else (rights[i], lefts[i]) for i in some.tolist()]
            out[some] = _banded(pairs, steps[some], gap[some], mosts[some], width)
            at += len(some)
        left = left[~out[left] & ~alone[left] & (mosts[left] >= 64 * width)]
        width *= 2
    return out


def _codes(texts: list[str], width: int, before: np.ndarray) -> np.ndarray:
    """The characters of each text plus one, after ``before`` zeros, in rows of ``width``."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
    top = int(flat.max()) if len(flat) else 0
    out = np.zeros((len(texts), width), np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)
    sizes = np.array([len(x) for x in texts])
    out.ravel()[_parts(np.arange(len(texts)) * width + before, sizes)] = flat
    return out


def _banded(pairs: list[tuple[str, str]], steps: np.ndarray, gap: np.ndarray, mosts: np.ndarray, width: int) -> np.ndarray:
    """Which (longer, shorter) pairs, the shorter ones falling in length, have a path of at most ``mosts`` edits on 64 * ``width`` diagonals.

    A path of fewer edits than diagonals stays on them. A column's differences are the bits of ``width`` numbers that move
    down a row with each character of the shorter line; the distance is followed along the last cell's diagonal.
    """
    out = np.zeros(len(pairs), bool)
    slack = (np.minimum(mosts, 64 * width - 1) - gap) // 2
    below = _codes([b for _, b in pairs], int(steps[0]), np.zeros(len(pairs), np.int64))
    above = _codes([a for a, _ in pairs], max(int((steps + gap + slack).max()), int(steps[0])) + 64 * width, slack)
    if above.dtype != below.dtype:
        wider = max(above.dtype, below.dtype)
        above, below = above.astype(wider), below.astype(wider)
    first = [np.clip(slack - 64 * w, 0, 64) for w in range(width)]
    up = [np.where(x < 64, _FULL << np.minimum(x, 63).astype(_U), _U(0)) for x in first]
    down = [np.zeros(len(pairs), _U) for _ in range(width)]
    bit = gap + slack
    watch = [np.where(bit // 64 == w, _U(1) << (bit % 64).astype(_U), _U(0)) for w in range(width)]
    score, who = gap.copy(), np.arange(len(pairs))
    n = len(pairs)
    for s in range(int(steps[0])):
        done = n
        while n and steps[n - 1] <= s:
            n -= 1
        if n < done:
            out[who[n:done]] = score[n:done] <= mosts[n:done]
        if s % CHECKED == 0 and n:
            alive = np.flatnonzero(score[:n] <= mosts[:n])
            if 4 * len(alive) < 3 * n:
                above, below, steps, mosts, score, who = (x[alive] for x in (above, below, steps, mosts, score, who))
                up, down, watch = ([x[alive] for x in y] for y in (up, down, watch))
                n = len(alive)
        if not n:
            break
        same = np.packbits((above[:n, s:s + 64 * width] == below[:n, s:s + 1]).ravel(), bitorder="little").view("<u8").reshape(n, width)
        diagonal, carry, hit = [], None, None
        for w in range(width):
            eq, u = same[:, w], up[w][:n]
            total = (eq & u) + u
            over = total < u
            if carry is not None:
                total += carry
                over |= total < carry
            carry = over.astype(_U) if w + 1 < width else None
            total ^= u
            total |= eq
            total |= down[w][:n]
            diagonal.append(total)
            seen = total & watch[w][:n]
            hit = seen if hit is None else hit | seen
        score[:n] += hit == 0
        for w in range(width):
            d, u = diagonal[w], up[w][:n]
            rise, fall = down[w][:n] | ~(d | u), d & u
            shifted = d >> _U(1)
            if w + 1 < width:
                shifted |= diagonal[w + 1] << _U(63)
            up[w][:n], down[w][:n] = fall | ~(shifted | rise), shifted & rise
    out[who[:n]] = score[:n] <= mosts[:n]
    return out


def _one_banded(b: str, a: str, most: int) -> bool:
    """``_banded`` of a single pair, the shorter line first, on all diagonals that its bound allows."""
    score = len(a) - len(b)
    slack = (most - score) // 2
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i + slack
    full, watch = (1 << score + 2 * slack + 1) - 1, 1 << score + slack
    up, down = full >> slack << slack, 0
    for s, c in enumerate(b):
        same = places.get(c, 0) >> s & full
        diagonal = (((same & up) + up) ^ up | same | down) & full
        if not diagonal & watch:
            score += 1
            if score > most:
                return False
        rise, fall = down | full & ~(diagonal | up), diagonal & up
        diagonal >>= 1
        up, down = fall | full & ~(diagonal | rise), diagonal & rise
    return True


def _within(tenths: int):
    def within(blocks: list[tuple[list, list, list, list]]) -> list[tuple[int, int]]:
        """Links between different components inside each block; some lines of every block take their turn at once, more each time."""
        out, open_ = [], []
        for sides, ids, comps, lines in blocks:
            if len(ids) > 1:
                open_.append((np.array(sides), ids, np.unique(comps, return_inverse=True)[1], lines, np.array([len(x) for x in lines]), any(sides)))
        i, turn = 0, 1
        while open_:
            found, mosts = [], []
            for k, (sides, _, labels, _, sizes, two) in enumerate(open_):
                for one in range(i, min(i + turn, len(sizes) - 1)):
                    most = np.maximum(sizes[one + 1:], sizes[one]) * (1000 - tenths) // 1000
                    near = (labels[one + 1:] != labels[one]) & (np.abs(sizes[one + 1:] - sizes[one]) <= most)
                    if two:
                        near &= sides[one + 1:] != sides[one]
                    near = np.flatnonzero(near)
                    if len(near):
                        found.append(np.stack((np.full(len(near), k), np.full(len(near), one), near + one + 1), axis=1))
                        mosts.append(most[near])
            if found:
                found = np.concatenate(found)
                good = within_bound([open_[k][3][one] for k, one, _ in found.tolist()], [open_[k][3][j] for k, _, j in found.tolist()], np.concatenate(mosts))
                for k, one, j in found[good].tolist():
                    ids, labels = open_[k][1:3]
                    if labels[one] != labels[j]:
                        labels[labels == labels[j]] = labels[one]
                        out.append((ids[one], ids[j]))
            i, turn = i + turn, min(8 * turn, TURN)
            open_ = [x for x in open_ if len(x[1]) > i + 1 and (x[2] != x[2][0]).any()]
        return out

    return within


def _linked(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``lines``; ``nodes`` (``line``, its least ``id`` and its number ``n``); ``groups`` (``node``, ``component``) of the nodes that have links."""
    tenths = round(similarity * 1000)
    both = settle(_lines(docs), "lines")
    lines, chunks = both.where("texts is null").drop("texts"), both.where("texts is not null").select("id", "texts")
    nodes = settle(lines.groupBy("line").agg(F.min("id").alias("id"), F.count("*").alias("n")), "nodes")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.count() * (BLOCKS + 2 * BANDS) // PART_KEYS + 1)
    keys = settle(shared_keys(_wanted(chunks, nodes), parts), "keys")

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        a, b = a.tolist(), b.tolist()
        mosts = np.array([max(len(x), len(y)) * (1000 - tenths) // 1000 for x, y in zip(a, b)], np.int64)
        return pd.Series(within_bound(a, b, mosts))

    return lines, nodes, link(keys, lambda ids: _payloads(_wanted(chunks, ids)), similar, _within(tenths), 1 << 20, True)


def line_groups(docs: DataFrame, similarity: float = 0.9) -> DataFrame:
    """``doc_id``, ``doc``, ``no``, ``line`` and ``group`` of every line with words, from ``doc_id`` and ``text``."""
    lines, nodes, groups = _linked(docs, similarity)
    # a group is known by the line of its smallest id
    named = groups.join(nodes.select(F.col("id").alias("node"), "line"), "node").select("component", "line")
    name = groups.select("component").distinct().join(nodes.select(F.col("id").alias("component"), F.col("line").alias("group")), "component")
    named = named.join(name, "component").select("line", "group")
    return lines.drop("id").join(named, "line", "left").withColumn("group", F.coalesce("group", "line"))


def drop_repeated_lines(docs: DataFrame, similarity: float = 0.9) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) without repeated lines, plus ``n_lines`` and ``n_removed``.

    A line goes with the line feed that parts it from the others.
    """
    lines, nodes, groups = _linked(docs.select("doc_id", "text"), similarity)
    # a line that occurs once and is like no other stays
    shared = nodes.join(groups, nodes["id"] == groups["node"], "left").where("n > 1 or component is not null").select("line", F.coalesce("component", "id").alias("group"))
    grouped = settle(lines.drop("id").join(shared, "line").select("doc_id", "doc", "no", "group"), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("doc").alias("d"), F.col("no").alias("k"))
    lead = grouped.groupBy("group").agg(F.min(order).alias("first"))
    schema = docs.drop("n_lines", "n_removed").schema
    names = [f.name for f in schema.fields]
    at = names.index("text")
    own, key, body, drop, turn = (spare(docs, x) for x in ("own", "own_key", "own_body", "gone", "turn"))

    def row(doc: str) -> Column:
        """Id and text in one value: rows that agree on it meet in one exchange."""
        return F.md5(F.concat(F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n")), F.lit(" "), F.col(doc).cast("string")).cast("binary"))

    gone = grouped.join(lead, "group").where(order != F.col("first")).select(row("doc").alias(own), "no").groupBy(own).agg(F.collect_list("no").alias(drop))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = _bytes(part.column(at))
                bodies = [None if x is None else packer.compress(x) for x in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *part.columns[at + 1:], pa.array([_key(x) for x in texts], pa.int64()), pa.array(bodies, pa.binary())],
                                                 [*names[:at], *names[at + 1:], key, body])

    others = [f"`{n}` {schema[n].dataType.simpleString()}" for n in names if n != "text"]
    rows = docs.select(*[f"`{n}`" for n in names]).mapInArrow(pack, ", ".join([*others, f"{key} long", f"{body} binary"]))
    joined = rows.withColumn(own, row(key)).drop(key).join(gone, own, "left")
    # rows that repeat id and text are one document: the first keeps lines
    joined = joined.withColumn(turn, F.row_number().over(Window.partitionBy(own).orderBy(F.lit(0))))
    joined = joined.select(*[f"`{n}`" for n in names if n != "text"], body, drop, turn)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.num_columns - 3
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts, counts, removed = [], [], []
                for packed, gone, turn in zip(*[part.column(width + i).to_pylist() for i in range(3)]):
                    text = None if packed is None else zstandard.decompress(packed) if packed else b""
                    counts.append(0 if text is None else text.count(b"\n") + 1)
                    drop = set(gone or ()) if text else set()
                    if text and turn > 1:
                        drop = {i for i, x in enumerate(normalised([text])) if x}
                    if drop:
                        text = b"\n".join([x for i, x in enumerate(text.split(b"\n")) if i not in drop])
                    texts.append(text)
                    removed.append(len(drop))
                head = [part.column(i) for i in range(width)]
                yield pa.RecordBatch.from_arrays([*head[:at], _strings(texts), *head[at:], pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                                                 [*names, "n_lines", "n_removed"])

    out = [f"`{n}` {schema[n].dataType.simpleString()}" for n in names]
    return joined.mapInArrow(cut, ", ".join([*out, "n_lines long", "n_removed long"]))
