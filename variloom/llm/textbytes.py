"""Vectorised work on the UTF-8 bytes of Arrow string columns, for use inside Spark tasks.

A batch is cut into runs of whole documents (``text_runs``) so that the arrays made for one
run stay small whatever the batch holds; one document longer than the bound is a run of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
RUN_BYTES = 2 << 20

_U = np.uint64
_BLOCK = 1 << 18
#: Bytes whose sums stay in the cache.
_STEP = 1 << 15
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK + 1, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes inside the given closed ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words of ASCII letters, digits and everything outside ASCII.
WORDLIKE = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit (splitmix finaliser)."""
    y = x >> _U(30)
    y ^= x
    y *= _U(0xBF58476D1CE4E5B9)
    y ^= y >> _U(27)
    y *= _U(0x94D049BB133111EB)
    y ^= y >> _U(31)
    return y


_BYTE_CODES = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_POWERS, _INVERSES = _powers(_BASE), _powers(_INVERSE)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return _LOWER[data]


@dataclass
class Run:
    """Whole documents of a batch: ``data[starts[i]:starts[i+1]]`` is the text of row ``first + i``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i + 1]].tobytes()


def text_runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[Run]:
    """Runs of whole documents of at most ``limit`` bytes, or of one longer document."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Run(at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at], null[at:end])
        at = end


def spans(run: Run, wordlike: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each document's words begin in them."""
    inside = wordlike[run.data]
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(run) + 1, np.int64)
    edges = run.starts[:-1][np.diff(run.starts) > 0]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, run.starts)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]`` for disjoint spans in order."""
    left, right = np.zeros(len(starts), _U), np.zeros(len(starts), _U)
    shift = np.zeros(len(starts), _U)
    total, power, inverse = 0, 1, 1
    for low in range(0, len(data), _STEP):
        part = data[low:low + _STEP]
        high = low + len(part)
        sums = np.empty(len(part) + 1, _U)
        sums[0] = total
        np.cumsum(_BYTE_CODES[part] * _POWERS[:len(part)], out=sums[1:])
        sums[1:] *= _U(power)
        sums[1:] += _U(total)
        a, b = np.searchsorted(starts, (low, high))
        left[a:b] = sums[starts[a:b] - low]
        shift[a:b] = _INVERSES[starts[a:b] - low] * _U(inverse)
        a, b = np.searchsorted(ends, (low, high), "right")
        right[a:b] = sums[ends[a:b] - low]
        total = int(sums[-1])
        power = power * int(_POWERS[_STEP]) & _MASK
        inverse = inverse * int(_INVERSES[_STEP]) & _MASK
    return mix((right - left) * shift + (ends - starts).astype(_U))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive word hashes."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, _U)
    for k in range(size):
        out = mix(out + words[k:k + n]) if k else mix(words[:n] + _U(0x632BE59BD9B4E019))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed long."""
    return np.ascontiguousarray(x).view(np.int64)


def content_key(text: bytes | None) -> bytes:
    """16 bytes that stand for a text; a null text is not an empty one."""
    return hashlib.md5(text if text is not None else b"\x00null\xff", usedforsecurity=False).digest()
