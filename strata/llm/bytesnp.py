"""Vectorised words and shingles over the UTF-8 bytes of an Arrow batch.

All of a batch's texts are handled as one byte buffer; nothing loops over
words.  ASCII blanks never occur inside a multi-byte character, so words of
bytes are words of characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STEP = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(n, dtype=_U) + _U(seed * 1_000_003 + 1)) * _U(0x9E3779B97F4A7C15))


LETTER = numbers(256, 1)
BASE = int(numbers(1, 2)[0]) | 1


class Powers:
    """base**i and its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, _U), np.full(n - 1, b, _U)]), dtype=_U)
                                  for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


POWERS = Powers(BASE)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words, in order."""
    solid = ~BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True  # a text's end ends a word, too
    edge = edge[:-1]
    starts = np.flatnonzero(solid & (edge | np.concatenate([[True], ~solid[:-1]])))
    ends = np.flatnonzero(solid & np.concatenate([edge[1:] | ~solid[1:], [True]])) + 1
    return starts, ends


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, step: int = STEP) -> np.ndarray:
    """64-bit hash of each word (a polynomial over random letter codes, finalized), ``step`` bytes at a time."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + step, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = POWERS.get(hi - lo + 1)
        piece = raw[lo:hi]
        acc = np.empty(hi - lo + 1, _U)
        acc[0] = 0
        np.cumsum(LETTER[LOWER[piece] if lower else piece] * up[:-1], out=acc[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((acc[e] - acc[s]) * down[s] + (e - s).astype(_U))
        i = j
    return out


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and the offsets of each text's.

    A text of 1 to k-1 words has its whole word sequence as one shingle; a
    text without words has none.
    """
    raw, offsets = buffer_of(column)
    starts, ends = word_spans(raw, offsets)
    h = word_hashes(raw, starts, ends)
    first = np.searchsorted(starts, offsets[:-1])
    words = np.diff(np.concatenate([first, [len(starts)]]))
    count = np.where(words == 0, 0, np.maximum(words - k + 1, 1))
    out_at = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first - out_at[:-1], count) + np.arange(out_at[-1])
    width = np.repeat(np.minimum(words, k), count)
    acc = np.full(len(at), 0x243F6A8885A308D3, _U)
    for i in range(k):
        more = width > i
        acc[more] = mix(acc[more] * _U(3) + h[at[more] + i])
    return acc, out_at


def by_size(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into parts of about ``limit`` bytes of ``column`` (a longer text is a part of its own)."""
    for batch in batches:
        _, offsets = buffer_of(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j
