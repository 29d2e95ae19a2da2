"""Packing token sequences into fixed windows by best-fit decreasing.

A document's ids (closed by an end id) are cut into full windows first; what
is left goes into the open window with the least room that still takes it.  A
segment tree indexed by remaining capacity finds that window in log(window)
steps.

Scale: the texts are tokenized once, where they are read, and give one short
row per piece.  Pieces are dealt at random into groups of about
``GROUP_PIECES``, each packed on its own, so a group is bounded whatever the
input; a group leaves at most about one window half empty, a few hundredths of
a percent of its content.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stage, bytes_of, query, table
from .subwords import default_path, word_bpe

WINDOW = 4096
END_ID = 2
GROUP_PIECES = 4096
PIECE = "id {key}, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Open windows by remaining capacity (1..size); finds the least capacity that suffices."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def push(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        i = capacity + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def pop_fit(self, need: int) -> tuple[int, int] | None:
        """Take out the window of least capacity >= need: (capacity, window)."""
        i = need + self.leaves
        if not self.count[i]:
            while True:  # up until a right sibling holds a window
                if i == 1:
                    return None
                if not i & 1 and self.count[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.leaves:  # down to its smallest capacity
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        window = self.open[capacity].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each length (all from 1 to size), longest first, ties in given order."""
    tree, windows = CapacityTree(size), 0
    at, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        found = tree.pop_fit(n)
        if found is None:
            found = size, windows
            windows += 1
        room, w = found
        at[i], offset[i] = w, size - room
        if room > n:
            tree.push(room - n, w)
    return at, offset


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None,
           end_id: int = END_ID, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Tokenize and cut: one row per piece (id, start, length, ids_crc32, doc_tokens[, ids])."""
    path = tokenizer or default_path()
    kind = dict(docs.dtypes)[key]
    ids_col = ", ids binary" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = word_bpe(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for i, body in enumerate(batch["body"]):
                ids = bpe.packed(body.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start:4 * (start + window)]
                    for o, v in zip(out, (i, start, len(part) // 4, zlib.crc32(part), n, part)):
                        o.append(v)
            cols = [batch["id"].take(pa.array(out[0], pa.int64())),
                    *(pa.array(o, pa.int64()) for o in out[1:5])]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(out[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return (docs.select(F.col(key).alias("id"), bytes_of(text).alias("body"))
            .mapInArrow(cut, PIECE.format(key=kind) + ids_col))


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None,
         end_id: int = END_ID, window: int = WINDOW, group_pieces: int = GROUP_PIECES,
         with_ids: bool = False) -> DataFrame:
    """Pack every document into sequences of at most ``window`` ids.

    Returns one row per piece: ``key``, ``start`` (its document's ids before
    it), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` (gapless from 0 in each sequence) and, if asked for, the piece's
    ``ids`` (packed little-endian unsigned 32-bit numbers).

    A null or empty text is the end id alone.  Null and repeated keys are
    packed like others, one document a row; equal lengths are taken in key
    order, null first.  An empty table gives an empty result.  Only the two
    named columns are read.
    """
    stage = Stage(docs.sparkSession, "pack")
    cut = stage.save(pieces(docs, text, key, tokenizer, end_id, window, with_ids), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    # dealt by content and place, so that neither a key nor a text gathers in one group
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.col("ids_crc32")), F.lit(groups))
    extra = ", ids binary" if with_ids else ""
    kind = dict(docs.dtypes)[key]

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "start", "ids_crc32"], na_position="first", kind="stable")
        at, offset = best_fit_decreasing(pdf["length"].to_numpy(np.int64), window)
        pdf["sequence_id"] = pdf.pop("grp").to_numpy(np.int64) * (1 << 32) + at
        pdf["offset"] = offset
        return pdf

    out = cut.withColumn("grp", dealt).groupBy("grp").applyInPandas(
        lambda pdf: fill(pdf), PIECE.format(key=kind) + extra + ", sequence_id long, offset long")
    return out.withColumnRenamed("id", key)


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
