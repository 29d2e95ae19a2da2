"""Alignment of the tokens of two tokenizers, and how often each id pair is linked in the corpus.

Tokenizer A is byte-level BPE, tokenizer B a sentencepiece model with byte
fallback.  Both cut a text's bytes (after one leading space) into tokens.
Where a token of A and one of B end at the same byte a group ends; a token of A
and one of B whose bytes overlap are a link.

1. A first pass aligns all documents.  Every task hands on its distinct pairs
   with their counts, so a frequent pair leaves a task once per word cache.
2. The distinct pairs get a minimal perfect hash (perfect_hash.py), built in
   parts of about ``PART_KEYS`` pairs.
3. Every task adds its lists into a dense count vector indexed by the hash,
   comparing each slot's key; vectors are summed part by part in a tree.
4. A second pass aligns the documents again and looks the counts up.

Scale: neither tokenizer joins what a blank or line feed before a word parts,
which the model's vocabulary is checked for, so a worker keeps the alignment of
the words it has met (a bounded cache, which words met once leave first).  What is broadcast (hash, keys,
counts) is bounded by ``ROUND_KEYS`` pairs; the parts of a larger set take turns, and
the sums of a document's rounds are added.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe, default_pattern
from .bytesnp import by_size
from .common import Stage, bytes_of, query, table
from .perfect_hash import PerfectHash, build, part_of
from .subwords import _byte_letters

CACHE_WORDS = 200_000
LONG_WORD = 200    # longer words are not kept
UNIT = 1 << 20     # code points of a text handled at once
JOINED = 1 << 14   # new words are tokenized in texts of about so many code points
LIST_PAIRS = 1 << 16
PART_KEYS = 1 << 16
ROUND_KEYS = 8 << 20
FAN_IN = 16
BATCH_BYTES = 4 << 20
MARK = "▁"  # B's sign for a space
BREAK = re.compile(r"\S(?= \S)")
CROSSES = re.compile(f"[^ \n{MARK}][ \n{MARK}]")
SLOW, NONE = -1, -2


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Ids and bytes of both tokenizers."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece

        spec = json.loads(a)
        special = {t["content"] for t in spec["added_tokens"]}
        byte = {letter: i for i, letter in _byte_letters().items()}
        ranks = {bytes(map(byte.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.bpe = ByteBpe(ranks, default_pattern())
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.n_b = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(names)]
        self.length_a = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.length_a[i] = len(token)
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.splits = not any(CROSSES.search(p) for p in names)
        self.lead = self.pieces.encode("x")
        self._said: list[str] = []

    def said(self) -> list[str]:
        """Decimal ids, each followed by ``,``, ``|`` and ``;`` in turn (bounded by the vocabularies)."""
        if not self._said:
            self._said = [f"{i}{sign}" for i in range(max(len(self.length_a), self.n_b)) for sign in ",|;"]
        return self._said

    def both(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that begins with white space, or None where B's bytes are not the text's.

        B adds a space of its own, so it is given a word before the text."""
        ids = self.pieces.encode("x" + text)
        if ids[:len(self.lead)] != self.lead:
            return None
        ids, raw = ids[len(self.lead):], text.encode()
        if b"".join(map(self.bytes_b.__getitem__, ids)) != raw:
            return None
        a, b = self.bpe.encode(text).astype(np.int64), np.array(ids, np.int64)
        return (a, b) if self.bpe.decode(a) == raw else None


class Aligned:
    """Alignment of a row of segments: sizes by segment, pairs of all links, groups as text."""

    def __init__(self, tok: Tokenizers, a: np.ndarray, b: np.ndarray, segment_end: np.ndarray, texts: bool):
        ends_a, ends_b = np.cumsum(tok.length_a[a]), np.cumsum(tok.length_b[b])
        # the bytes between two neighbouring ends belong to one token of each: a link
        whose = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.int8)
        whose[ends_a] = 1
        whose[ends_b] += 2
        ends = np.flatnonzero(whose)
        whose = whose[ends]
        upto_a, upto_b = np.cumsum(whose & 1), np.cumsum(whose >> 1)
        self.pairs = a[upto_a - (whose & 1)] * tok.n_b + b[upto_b - (whose >> 1)]
        both = whose == 3
        common = ends[both]

        def per_segment(x: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(x, segment_end, "right"), prepend=0)

        self.sizes = np.stack([per_segment(x) for x in (ends_a, ends_b, common, ends)], 1)
        self.groups: list[str] = []
        if texts:
            # A's ids of a group, then B's: each id with the sign that follows it
            cut_a, cut_b = upto_a[both], upto_b[both]
            per_a, per_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
            said = np.empty(len(a) + len(b), np.int64)
            sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            sign_a[cut_a - 1], sign_b[cut_b - 1] = 1, 2
            said[np.arange(len(a)) + np.repeat(cut_b - per_b, per_a)] = a * 3 + sign_a
            said[np.arange(len(b)) + np.repeat(cut_a, per_b)] = b * 3 + sign_b
            words = list(map(tok.said().__getitem__, said.tolist()))
            at = 0
            for n in (self.sizes[:, 0] + self.sizes[:, 1]).tolist():
                self.groups.append("".join(words[at:at + n])[:-1])
                at += n


class Aligner:
    """Aligns texts, words at a time; ``value`` gives the numbers that each link adds to its text."""

    def __init__(self, a: bytes, b: bytes, texts: bool, value=None):
        self.tok, self.texts, self.value = Tokenizers(a, b), texts, value
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.sizes, self.sums = np.empty((0, 4), np.int64), np.empty((0, 2), np.int64)
        self.groups: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.used = np.zeros(0, np.int64)

    def trim(self) -> None:
        """Once too many words are kept: forget those met only once (all, if that leaves too many)."""
        if len(self.index) <= CACHE_WORDS:
            return
        keep = np.flatnonzero(self.used > 1)
        if len(keep) > CACHE_WORDS // 2:
            keep = keep[:0]
        place = np.full(len(self.sizes), -1, np.int64)
        place[keep] = np.arange(len(keep))
        known = [(w, at) for w, at in self.index.items() if at >= 0]
        new = place[np.fromiter((at for _, at in known), np.int64, len(known))].tolist()
        self.index = _Index((w, at) for (w, _), at in zip(known, new) if at >= 0)
        if self.value is None:
            kept = np.repeat(place >= 0, self.sizes[:, 3])
            self.pairs = [np.concatenate([np.empty(0, np.int64), *self.pairs])[kept]]
        if self.texts:
            self.groups = [self.groups[i] for i in keep.tolist()]
        self.sizes, self.sums = self.sizes[keep], self.sums[keep]
        self.used = np.zeros(len(keep), np.int64)

    def _align(self, segments: list[str]) -> list[tuple[range, Aligned | None]]:
        """Alignments of runs of segments (by their places); None for a segment without tokens."""
        out, todo, start = [], [], 0
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        upto = np.cumsum(size)
        while start < len(segments):
            stop = int(np.searchsorted(upto, upto[start] - size[start] + JOINED, "right")) + 1
            todo.append(range(start, min(stop, len(segments))))
            start = stop
        while todo:
            run = todo.pop()
            some = segments[run.start:run.stop]
            text = "".join(some)
            got = self.tok.both(text)
            if got is not None:
                end = np.cumsum(size[run.start:run.stop])
                if not text.isascii():  # characters begin at bytes that do not continue one
                    raw = np.frombuffer(text.encode(), np.uint8)
                    end = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))[end]
                out.append((run, Aligned(self.tok, *got, end, self.texts)))
            elif len(run) == 1:
                out.append((run, None))
            else:
                half = len(run) // 2
                todo += [run[half:], run[:half]]
        return out

    def _sums(self, found: Aligned) -> np.ndarray:
        if self.value is None:
            return np.zeros((len(found.sizes), 2), np.int64)
        run = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(self.value(found.pairs), 0)])
        end = np.cumsum(found.sizes[:, 3])
        return run[end] - run[end - found.sizes[:, 3]]

    def learn(self, words: list[str]) -> None:
        """Keep the alignments of new words."""
        fit = []
        for w in words:
            if not w or w[-1].isspace() or not self.tok.splits:
                self.index[w] = SLOW
            elif len(w) <= LONG_WORD:
                fit.append(w)
        sizes, sums, at = [self.sizes], [self.sums], len(self.sizes)
        for run, found in self._align([w if w[0] == "\n" else " " + w for w in fit]):
            if found is None:
                self.index[fit[run[0]]] = NONE
                continue
            self.index.update(zip(fit[run.start:run.stop], range(at, at + len(run))))
            at += len(run)
            sizes.append(found.sizes)
            sums.append(self._sums(found))
            self.groups += found.groups
            if self.value is None:
                self.pairs.append(found.pairs)
        self.sizes, self.sums = np.concatenate(sizes), np.concatenate(sums)

    def texts_of(self, texts: list[str]) -> list[list[tuple[np.ndarray, Aligned | None]] | None]:
        """Per text its units: (words' places, None) or (none, alignment of the whole unit); None without tokens."""
        units, of = [], []
        for i, t in enumerate(texts):
            for u in cut_units(t):
                units.append(u)
                of.append(i)
        out: list = [[] if t else None for t in texts]
        if not units:
            return out
        split = pc.split_pattern(pc.replace_substring(pa.array(units, pa.large_string()), "\n", " \n"), " ")
        begin = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()  # each distinct word is looked up once
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn([w for w in words if w not in self.index])
        places = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        lows = np.minimum.reduceat(places, begin[:-1])
        self.used = (np.bincount(places[places >= 0], minlength=len(self.sizes))
                     + np.pad(self.used, (0, len(self.sizes) - len(self.used))))
        for n, (i, u) in enumerate(zip(of, units)):
            if out[i] is None:
                continue
            low = lows[n]
            if low >= 0:
                out[i].append((places[begin[n]:begin[n + 1]], None))
                continue
            found = None if low == NONE else self._align([" " + u])[0][1]
            out[i] = None if found is None else [*out[i], (None, found)]
        return out


class _Index(dict):
    def __missing__(self, word: str) -> int:
        return SLOW


def cut_units(text: str) -> Iterator[str]:
    """Parts of a long text between words that one space parts (the space goes)."""
    at = 0
    while len(text) - at > UNIT:
        cut = BREAK.search(text, at + UNIT - 1)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end() + 1
    if at < len(text):
        yield text[at:]


_LOADED: dict[str, Aligner] = {}


def _aligner(token: str, make) -> Aligner:
    """One per Python worker and pass."""
    if token not in _LOADED:
        _LOADED.clear()
        _LOADED[token] = make()
    return _LOADED[token]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [x.as_py().decode("utf-8", "replace") for x in batch["body"]]


def _unique(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([np.empty(0, np.int64), *pairs]), return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, np.concatenate([np.empty(0, np.int64), *counts]))
    return keys, out


def _count(token: str, shared):
    """Distinct pairs and their counts, in lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(token, lambda: Aligner(*shared.value, texts=False))
        seen, whole = np.zeros(0, np.int64), []

        def lists() -> Iterator[pa.RecordBatch]:
            links = aligner.sizes[:len(seen), 3]
            flat = np.concatenate([np.empty(0, np.int64), *aligner.pairs])
            weight = np.repeat(seen, links)
            keys, counts = _unique([flat[:len(weight)][weight > 0], *whole],
                                   [weight[weight > 0], *[np.ones(len(x), np.int64) for x in whole]])
            for i in range(0, len(keys), LIST_PAIRS):
                yield pa.RecordBatch.from_arrays([pa.array([x[i:i + LIST_PAIRS].astype("<i8").tobytes()], pa.binary())
                                                  for x in (keys, counts)], names=["keys", "counts"])

        for batch in by_size(batches, "body", BATCH_BYTES):
            for units in aligner.texts_of(_texts(batch)):
                for at, found in units or ():
                    if found is None:
                        if len(seen) < len(aligner.sizes):
                            seen = np.concatenate([seen, np.zeros(len(aligner.sizes) - len(seen), np.int64)])
                        np.add.at(seen, at, 1)
                    else:
                        whole.append(found.pairs)
            if len(aligner.index) > CACHE_WORDS or sum(map(len, whole)) > 1 << 20:
                yield from lists()
                seen, whole = np.zeros(0, np.int64), []
                aligner.trim()
        yield from lists()

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch["keys"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), "<i8"))], names=["pair"])


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    sizes, bits, order = build(pdf["pair"].to_numpy(np.uint64))
    return pd.DataFrame({"part": pdf["part"][:1], "n": [len(order)], "sizes": [sizes.tolist()], "bits": [bits.tobytes()],
                         "keys": [order.astype("<i8").tobytes()]})


def _vectors(shared):
    """Each task's dense count vector over the slots, part by part; parts without a pair of the task are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, keys, base = shared.value
        dense = np.zeros(len(keys), np.int64)
        for batch in batches:
            for x, c in zip(batch["keys"], batch["counts"]):
                pairs = np.frombuffer(x.as_py(), "<i8")
                mine = hashed.mine(pairs)
                at = hashed.slots(pairs[mine])
                _verify(keys, at, pairs[mine])
                dense[at] += np.frombuffer(c.as_py(), "<i8")[mine]
        for i in range(hashed.held):
            v = dense[base[i]:base[i + 1]]
            if v.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([hashed.first + i], pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int64()),
                    pa.array([v.tobytes()], pa.binary())], names=["part", "node", "counts"])

    return run


def _verify(keys: np.ndarray, at: np.ndarray, pairs: np.ndarray) -> None:
    if len(at) and (at.min() < 0 or (keys[at] != pairs).any()):
        raise ValueError("a pair that the first pass did not meet: the documents changed between the passes")


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
    return pd.DataFrame({"part": pdf["part"][:1], "node": pdf["node"][:1], "counts": [total.tobytes()]})


def tree_sum(vectors: DataFrame, stage: Stage, name: str) -> DataFrame:
    """One vector a part: sums of at most ``FAN_IN`` vectors at a time."""
    level = stage.save(vectors, f"{name}-leaves")
    most = level.agg(F.max("node")).first()[0] or 0
    while most:
        level = level.withColumn("node", F.floor(F.col("node") / FAN_IN)).groupBy("part", "node").applyInPandas(
            lambda pdf: _add(pdf), "part long, node long, counts binary")
        most //= FAN_IN
    return stage.save(level, name)


OUT = ("rid long, id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def _look_up(token: str, shared, texts: bool):
    """Sizes of each text's alignment, and sums over its links of the round's pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, hashed, keys, counts, best = shared.value

        def value(pairs: np.ndarray) -> np.ndarray:
            out, mine = np.zeros((len(pairs), 2), np.int64), hashed.mine(pairs)
            at = hashed.slots(pairs[mine])
            _verify(keys, at, pairs[mine])
            out[mine, 0], out[mine, 1] = best[at], counts[at]
            return out

        aligner = _aligner(token, lambda: Aligner(a, b, texts, value))
        for batch in by_size(batches, "body", BATCH_BYTES):
            rows, groups = [], []
            for units in aligner.texts_of(_texts(batch)):
                total, said = np.zeros(6, np.int64), []
                for at, found in units or ():
                    if found is None:
                        total[:4] += aligner.sizes[at].sum(0)
                        total[4:] += aligner.sums[at].sum(0)
                        if texts:
                            said.append(";".join(map(aligner.groups.__getitem__, at.tolist())))
                    else:
                        total[:4] += found.sizes.sum(0)
                        total[4:] += aligner._sums(found).sum(0)
                        said += found.groups
                rows.append(total)
                groups.append(";".join(said))
            cells = np.array(rows).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [batch["rid"], batch["id"], *map(pa.array, cells), pa.array(groups, pa.string())],
                names=[x.split()[0] for x in OUT.split(", ")])
            aligner.trim()

    return run


def align(docs: DataFrame, text: str = "text", key: str = "doc_id", a: str | None = None, b: str | None = None) -> DataFrame:
    """Align the tokens of A (a byte-level BPE tokenizer file) and B (a sentencepiece model) in every text.

    Returns one row per input row: ``key``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair's corpus-wide count is the highest
    of its B id, ties included), ``count_sum`` (of the counts over the links)
    and ``groups`` (ids as ``a1,a2|b1;a3|b2,b3``).

    A text that is null, empty or not given back by the bytes of either
    tokenizer has no tokens: zeros and the empty string.  Special tokens'
    strings in a text are plain text.  Rows that repeat a key or a text count
    one by one; null keys are kept.  An empty table gives an empty result.
    Other columns play no part.  ``docs`` must be re-readable (a table).
    """
    spark = docs.sparkSession
    stage = Stage(spark, "align")
    paths = default_paths()
    files = []
    for path in (a or paths[0], b or paths[1]):
        with open(path, "rb") as f:  # bounded by the tokenizers' vocabularies
            files.append(f.read())
    given = spark.sparkContext.broadcast(tuple(files))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("id"), bytes_of(text).alias("body"))
    lists = stage.save(rows.select("body").mapInArrow(_count(stage.root + "-1", given), "keys binary, counts binary"), "lists")
    pairs = stage.save(lists.select("keys").mapInArrow(_unpack, "pair long").distinct(), "pairs")
    parts = max(1, -(-pairs.count() // PART_KEYS))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["pair"], pa.array(part_of(batch["pair"].to_numpy(), parts))],
                                             names=["pair", "part"])

    hashes = stage.save(pairs.mapInArrow(dealt, "pair long, part long").groupBy("part").applyInPandas(
        lambda pdf: _build(pdf), "part long, n long, sizes array<long>, bits binary, keys binary"), "hashes")
    held = {r["part"]: r["n"] for r in hashes.select("part", "n").collect()}  # one row a part
    rounds, first, size = [], 0, 0
    for p in range(parts):
        if size and size + held.get(p, 0) > ROUND_KEYS:
            rounds.append((first, p))
            first, size = p, 0
        size += held.get(p, 0)
    rounds.append((first, parts))

    def tables(first: int, last: int) -> tuple[PerfectHash, np.ndarray, np.ndarray]:
        """A round's hash, keys and first slots: at most about ``ROUND_KEYS`` pairs."""
        got = {r["part"]: r for r in hashes.where(F.col("part").between(first, last - 1)).collect()}
        some = [got.get(p) for p in range(first, last)]
        hashed = PerfectHash(parts, first, [np.array(r["sizes"], np.int64) if r else np.empty(0, np.int64) for r in some],
                             [r["bits"] if r else b"" for r in some])
        return (hashed, np.concatenate([np.frombuffer(r["keys"] if r else b"", "<i8") for r in some]),
                np.cumsum([0, *(r["n"] if r else 0 for r in some)]))

    counted = []
    best: np.ndarray = np.zeros(0, np.int64)
    n_b = Tokenizers(*files).n_b
    best = np.zeros(n_b, np.int64)
    for r, (first, last) in enumerate(rounds):
        hashed, keys, base = tables(first, last)
        shared = spark.sparkContext.broadcast((hashed, keys, base))
        summed = tree_sum(lists.mapInArrow(_vectors(shared), "part long, node long, counts binary"), stage, f"counts{r}")
        shared.unpersist()
        got = {x["part"]: np.frombuffer(x["counts"], np.int64) for x in summed.collect()}
        counts = np.concatenate([got.get(p, np.empty(0, np.int64)) for p in range(first, last)])
        np.maximum.at(best, keys % n_b, counts)
        counted.append((r, (first, last), summed))
    out = None
    for r, (first, last), summed in counted:
        if len(rounds) > 1:
            hashed, keys, base = tables(first, last)
            got = {x["part"]: np.frombuffer(x["counts"], np.int64) for x in summed.collect()}
            counts = np.concatenate([got.get(p, np.empty(0, np.int64)) for p in range(first, last)])
        shared = spark.sparkContext.broadcast((*files, hashed, keys, counts, counts == best[keys % n_b]))
        one = rows.mapInArrow(_look_up(f"{stage.root}-2-{r}", shared, r == 0), OUT.format(kind=kind))
        if len(rounds) > 1:
            one = stage.save(one, f"round{r}")
        out = one if out is None else out.unionAll(one)
    if len(rounds) > 1:
        same = [F.max(c).alias(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
        out = out.groupBy("rid").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"),
                                     F.max("groups").alias("groups"))
    return out.select(F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
