"""Prefix polynomial hashes of byte buffers, and the content-defined segments they give.

A repeat is a string of ``length`` bytes that starts in two places.  The
smallest hash among the ``GRAM``-byte strings inside it is the same wherever it
occurs, so places whose smallest hashes differ need not be compared.  Starts
in a row with one smallest hash form a segment.
"""

from __future__ import annotations

import numpy as np

from .bytesnp import Powers, mix, numbers

_U = np.uint64
GRAM = 64
LONGEST = 512  # windows of a segment; longer runs are cut
LETTER = numbers(256, 21)
POWERS = Powers(int(numbers(1, 22)[0]) | 1)


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """acc with hash(i, j) = (acc[j] - acc[i]) / base**i."""
    up, _ = POWERS.get(len(raw) + 1)
    acc = np.empty(len(raw) + 1, _U)
    acc[0] = 0
    np.cumsum(LETTER[raw] * up[:-1], out=acc[1:])
    return acc


def string_hash(acc: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hashes of the strings [i, j)."""
    _, down = POWERS.get(len(acc))
    return (acc[j] - acc[i]) * down[i]


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op (minimum or maximum) over every ``width`` neighbours, by doubling."""
    have, y = 1, x
    while 2 * have <= width:
        y = op(y[:-have], y[have:])
        have *= 2
    return op(y[:len(x) - width + 1], y[width - have:]) if have < width else y


def segments(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of all texts of a buffer: (text, start in it, windows, smallest hash, more).

    A segment is ``windows`` starts in a row; its bytes are those its windows
    cover.  ``more`` is true where its smallest hash occurs in it twice, so
    that it may repeat itself.
    """
    gram = min(GRAM, max(1, length // 2))
    width = length - gram + 1
    n = len(raw)
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, np.empty(0, bool)
    acc = prefix_hash(raw)
    _, down = POWERS.get(n + 1)
    g = mix((acc[gram:] - acc[:-gram]) * down[:n - gram + 1])
    low = sliding(g, width, np.minimum)
    starts = n - length + 1
    change = np.empty(starts, bool)
    change[0] = True
    np.not_equal(low[1:], low[:-1], out=change[1:])
    # starts of windows that stay inside their text
    inside = np.zeros(starts + 1, np.int8)
    begin, end = offsets[:-1], np.maximum(offsets[1:] - length + 1, offsets[:-1])
    some = end > begin
    np.add.at(inside, begin[some], 1)
    np.add.at(inside, end[some], -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    change[begin[some]] = True
    at = np.flatnonzero(inside & change)
    stop = np.append(at[1:], starts)
    text = np.searchsorted(offsets, at, "right") - 1
    stop = np.minimum(stop, offsets[text + 1] - length + 1)
    # occurrences of the smallest hash: places that are smallest in some window
    high = sliding(np.concatenate([np.zeros(width - 1, _U), low, np.zeros(width - 1, _U)]), width, np.maximum)
    spots = np.concatenate([[0], np.cumsum(g == high)])
    more = spots[np.minimum(stop + width - 1, len(g))] - spots[at] > 1
    more &= _twice(g, high, at, stop + width - 1, low[at]) if more.any() else False
    # cut long runs
    size = stop - at
    parts = -(-size // LONGEST)
    if parts.max(initial=1) > 1:
        rep = np.repeat(np.arange(len(at)), parts)
        nth = np.arange(len(rep)) - np.repeat(np.cumsum(parts) - parts, parts)
        at, stop = at[rep] + nth * LONGEST, np.minimum(at[rep] + (nth + 1) * LONGEST, stop[rep])
        text, more = text[rep], more[rep]
    return text, at - offsets[text], stop - at, low[at].view(np.int64), more


def _twice(g: np.ndarray, high: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether ``value`` occurs twice among the selected places of g[lo:hi]."""
    places = np.flatnonzero(g == high)
    first, last = np.searchsorted(places, lo), np.searchsorted(places, hi)
    owner = np.repeat(np.arange(len(lo)), last - first)
    at = places[np.repeat(first - np.concatenate([[0], np.cumsum(last - first)[:-1]]), last - first) + np.arange(len(owner))]
    return np.bincount(owner[g[at] == value[owner]], minlength=len(lo)) > 1
