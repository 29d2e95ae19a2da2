"""Subword ids of texts, by a public tokenizer, with the work done once per distinct word.

A tokenizer whose pre-tokenizer breaks at white space gives a text the ids of
its blank-separated words in a row, so each Python worker keeps the packed ids
of the words it has met (a bounded cache) and joins them.
"""

from __future__ import annotations

import ctypes
import gc
import re
from array import array

import numpy as np
import pyarrow as pa

CACHE_WORDS = 500_000
CACHE_PIECES = 500_000
CUT_WORDS = 1 << 14  # at a time
WORD_OVER = 0xFFFFFFFF  # no id
LONGEST_KEPT = 256  # characters; longer pieces are cut each time, so that the cache is bounded in bytes
ODD_MARK = "\x01"  # before a word for the whole tokenizer
ODD = re.compile(r"[^!-~À-ÖØ-öø-ÿ\n]|<\|")
LINE_PIECES = re.compile(r"\x01[^\n]*|\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte: printable
    bytes stand for themselves, the others for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Ids of texts by ``word_bpe_49k.json`` (lower-casing, white space dropped, word ends marked).

    Words of printable ASCII and Latin-1 letters go piece by piece to the
    tokenizer's own BPE model; every other word goes through the whole
    tokenizer.  Both give the ids of ``encode(text, add_special_tokens=False)``.
    """

    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+\Z")

    def __init__(self, path: str, cache: int | None = None):
        from tokenizers import Tokenizer

        self.most_words, self.most_pieces = cache or CACHE_WORDS, cache or CACHE_PIECES

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        letters = _byte_letters()
        self.letter = {chr(c): "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.pieces: dict[str, bytes] = {}
        self.words, self.found = _Words(self), _Pieces(self)

    def piece(self, p: str) -> bytes:
        got = self.pieces.get(p)
        if got is None:
            text = p if p.isascii() else "".join(self.letter.get(c, c) for c in p)
            got = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
            if len(self.pieces) >= self.most_pieces:
                self.pieces.clear()
            self.pieces[p] = got
        return got

    def word(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        if self.SIMPLE.match(text) and "<|" not in text:
            return b"".join(map(self.piece, self.PIECES.findall(text.lower())))
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def lookup(self):
        """A function from a word's bytes to its packed ids."""
        if len(self.words) >= self.most_words:
            self.words.clear()
        return self.words.__getitem__

    def cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and how many each has.

        Keeps pieces only, and cuts some thousand words by one search."""
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(words), CUT_WORDS):
            text = b"\n".join([*words[i:i + CUT_WORDS], b""]).decode("utf-8", "replace")
            if ODD.search(text):
                text = "\n".join([ODD_MARK + w if ODD.search(w) else w.lower() for w in text.split("\n")])
            else:
                text = text.lower()
            if len(self.found) >= self.most_pieces:
                self.found.clear()
            flat = np.frombuffer(b"".join(map(self.found.__getitem__, LINE_PIECES.findall(text))), "<u4")
            ends = np.flatnonzero(flat == WORD_OVER)
            ids.append(flat[flat != WORD_OVER])
            sizes.append(np.diff(ends, prepend=-1) - 1)
        return np.concatenate(ids), np.concatenate(sizes)

    def packed(self, text: bytes) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.lookup(), text.split()))


class _Words(dict):
    def __init__(self, owner: WordBpe):
        self.owner = owner

    def __missing__(self, raw: bytes) -> bytes:
        ids = self[raw] = self.owner.word(raw)
        return ids


class _Pieces(dict):
    """Packed ids of the pieces (and marked odd words) of words in lines; a line's end is ``WORD_OVER``."""

    def __init__(self, owner: WordBpe):
        self.owner = owner

    def __missing__(self, p: str) -> bytes:
        if p == "\n":
            ids = [WORD_OVER]
        elif p[0] == ODD_MARK:
            ids = self.owner.whole.encode(p[1:], add_special_tokens=False).ids
        else:
            ids = [t.id for t in self.owner.model.tokenize(p if p.isascii() else "".join(self.owner.letter.get(c, c) for c in p))]
        packed = array("I", ids).tobytes()
        if len(p) <= LONGEST_KEPT:
            self[p] = packed
        return packed


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str, cache: int | None = None) -> WordBpe:
    """One tokenizer (and cache of so many words) per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path, cache)
    return _LOADED[path]


def forget() -> None:
    """Free the tokenizers and word caches of this Python worker, and give what is free back to the system."""
    _LOADED.clear()
    gc.collect()  # caches and tokenizers refer to each other
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass
