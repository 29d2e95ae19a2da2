"""Minimal perfect hashing of distinct numbers, in numpy.

Keys are dealt to parts by hash.  In each part a level gives every key a place
in a bit array; keys alone at their place set its bit and are done, the others
go to the next level.  A key's slot is the number of set bits before its own,
so n keys have the slots 0 to n - 1, at about 3 bits a key.  A key that is not
of the set may get any slot or none: users compare the slot's key.
"""

from __future__ import annotations

import numpy as np

from .bytesnp import mix, numbers

ROOM = 1.5  # places a key on each level
MOST_LEVELS = 64
_SEEDS = numbers(MOST_LEVELS, 12)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part (0..parts-1) of each key; rises with its hash."""
    return ((mix(keys.astype(np.uint64) + np.uint64(1)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _place(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return (mix(keys ^ _SEEDS[level]) % np.asarray(size, np.uint64)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of each level, bits as bytes, the keys in slot order) for a part's distinct keys."""
    left, sizes, bits, order = keys.astype(np.uint64), [], [], []
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("keys are not distinct")
        size = -(-int(len(left) * ROOM) // 64) * 64 + 64
        at = _place(left, len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bit = np.zeros(size, np.uint8)
        bit[at[alone]] = 1
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(size)
        bits.append(bit)
        left = left[~alone]
    none = np.empty(0, np.uint8)
    return (np.array(sizes, np.int64), np.packbits(np.concatenate([none, *bits]), bitorder="little"),
            np.concatenate([np.empty(0, np.uint64), *order]))


class PerfectHash:
    """Slots of the keys of the parts ``first``, ``first`` + 1, ... of ``parts``."""

    def __init__(self, parts: int, first: int, sizes: list[np.ndarray], bits: list[bytes]):
        self.parts, self.first, self.held = parts, first, len(sizes)
        depth = max((len(s) for s in sizes), default=0)
        self.size = np.zeros((depth, self.held), np.int64)
        for i, s in enumerate(sizes):
            self.size[:len(s), i] = s
        # places are numbered part by part, in each by level
        end = np.cumsum(self.size.T.ravel()).reshape(self.held, depth).T if depth else self.size
        self.start = end - self.size
        self.words = np.frombuffer(b"".join(bits), np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def mine(self, keys: np.ndarray) -> np.ndarray:
        """Which keys belong to the held parts."""
        part = part_of(keys, self.parts)
        return (part >= self.first) & (part < self.first + self.held)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key of the held parts; -1 where no level has one."""
        keys, out = keys.astype(np.uint64), np.full(len(keys), -1, np.int64)
        part, left = part_of(keys, self.parts) - self.first, np.arange(len(keys))
        for level in range(len(self.size)):
            size = self.size[level][part[left]]
            left, size = left[size > 0], size[size > 0]
            at = self.start[level][part[left]] + _place(keys[left], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot = self.before[word] + np.bitwise_count(below)
            out[left[hit]] = slot[hit]
            left = left[~hit]
        return out
