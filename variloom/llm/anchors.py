"""Content-chosen anchors: places that two occurrences of one long string always share.

Of every string of ``length`` bytes the k-gram with the smallest hash (the last one of equals) is
its anchor. Equal strings therefore have their anchor at the same place. The consecutive strings that
have one anchor make up its region.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from variloom.llm.textbytes import _BYTE_CODES, _INVERSES, _POWERS, mix

_U = np.uint64
#: Strings that begin in one slice of a text; slices are cut so that the sums below stay small.
SLICE = 1 << 17
_LOW = 18  # bits for the place inside a slice


def anchors(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Slices of (anchor hash, region hash, document, first string of the region, number of its strings) as arrays.

    ``starts`` parts ``data`` into documents; strings are numbered by their first byte in the document. A text is cut
    into slices from its beginning, and several documents must fit one slice, so a text always gives the same regions.
    """
    span = length - gram + 1
    n = len(data)
    for low in range(0, max(0, n - length + 1), SLICE):
        high = min(low + SLICE, n - length + 1)
        a, b = max(0, low - span), min(n, high + 2 * length)
        part = data[a:b]
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(_BYTE_CODES[part] * _POWERS[:len(part)], out=sums[1:])
        first = low - a
        grams = (sums[first + gram:] - sums[first:-gram]) * _INVERSES[first:len(part) - gram + 1]
        grams = mix(grams[:high - low + span - 1])
        place = np.arange(len(grams), dtype=_U)
        keyed = grams >> _U(_LOW) << _U(_LOW) | _U((1 << _LOW) - 1) - place
        least = _window_min(keyed, span)
        # strings that stay inside one document
        begin = np.arange(low, high)
        document = np.searchsorted(starts, begin, "right") - 1
        inside = np.flatnonzero(begin + length <= starts[document + 1])
        if not len(inside):
            continue
        chosen = ((1 << _LOW) - 1) - (least[inside] & _U((1 << _LOW) - 1)).astype(np.int64)
        begin, document = begin[inside], document[inside]
        first = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (document[1:] != document[:-1]))))
        count = np.diff(np.append(first, len(chosen)))
        left = begin[first]
        right = left + count - 1 + length
        body = (sums[right - a] - sums[left - a]) * _INVERSES[left - a]
        offset = chosen[first] + low - left
        region = mix(mix(body) + offset.astype(_U) * _U(1 << 20) + count.astype(_U))
        yield grams[chosen[first]], region, document[first], left - starts[document[first]], count


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, ~_U(0), _U)
    padded[:n] = x
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])
