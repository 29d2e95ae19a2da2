"""Line dedup: later occurrences of repeated windows of three lines are removed.

Three consecutive lines are a window; windows overlap.  A window whose lines
have occurred before, in the same document or in one with a smaller key, is a
repeat, and the lines it covers go; covered positions are merged, so runs of
repeats of any length go as one.

Scale: lines are hashed where they are read (128 bits a window); the first
occurrence of each window is a map-side minimum, so a passage that a third of
all documents share reaches the reducers as one row per task, and the
occurrences join it by a merge join that AQE splits.  Texts are joined to their
covered lines once, by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesnp import by_size
from .common import Stage, bytes_of, query, table

WINDOW = 3


def split_lines(body: bytes) -> list[bytes]:
    """The lines of a text, without line ends; a text that ends in a line end has no line after it."""
    lines = body.split(b"\n")
    return lines[:-1] if lines[-1] == b"" else lines


def line_windows(lines: list[bytes], size: int) -> list[bytes]:
    """128-bit hashes of the overlapping windows of ``size`` lines (none where there are fewer lines)."""
    own = [hashlib.blake2b(x, digest_size=16).digest() for x in lines]
    return [hashlib.blake2b(b"".join(own[i:i + size]), digest_size=16).digest() for i in range(len(own) - size + 1)]


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 2 << 20):
            keys, rows, places, hashes = [], [], [], []
            for i, (k, r) in enumerate(zip(batch["id"].to_pylist(), batch["rid"].to_pylist())):
                found = line_windows(split_lines(batch["body"][i].as_py()), size)
                hashes += found
                places += range(len(found))
                keys += [k] * len(found)
                rows += [r] * len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(rows, pa.int64()), pa.array(places, pa.int64()),
                pa.array(hashes, pa.binary())], names=["id", "rid", "place", "hash"])

    return run


def covered_lines(places: list[int], size: int) -> list[list[int]]:
    """Merged runs [first, past the last] of the lines that windows at ``places`` cover."""
    runs: list[list[int]] = []
    for p in sorted(places):
        if runs and p <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], p + size)
        else:
            runs.append([p, p + size])
    return runs


def _remove(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 4 << 20):
            texts, counts, gone, spans = [], [], [], []
            for i, places in enumerate(batch["places"].to_pylist()):
                body = batch["body"][i].as_py()
                lines, runs = split_lines(body), covered_lines(places or [], size)
                if runs:
                    edges = [0, *(x for r in runs for x in r), len(lines)]
                    kept = [x for a, b in zip(edges[::2], edges[1::2]) for x in lines[a:b]]
                    end = b"\n" if kept and body.endswith(b"\n") else b""
                    texts.append((b"\n".join(kept) + end).decode("utf-8", "replace"))
                else:
                    texts.append(body.decode("utf-8", "replace"))
                counts.append(len(lines))
                gone.append(sum(b - a for a, b in runs))
                spans.append([{"first": a, "past": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays([
                batch["id"], pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
                pa.array(texts, pa.string())], names=["id", "n_lines", "n_removed", "spans", "kept_text"])

    return run


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """Remove later occurrences of windows of ``size`` lines.

    Returns one row per input row: ``key`` (an integer), ``n_lines``,
    ``n_removed`` (lines), ``spans`` (merged runs of removed lines, first and
    past the last, from 0) and ``kept_text``.

    Lines are parted by line feeds and compared byte for byte.  The first
    occurrence is the one of the smallest key (null first), then of the row
    that comes first in ``docs``, then of the smallest position; it stays, even
    where an overlapping window is removed elsewhere.  Documents of fewer
    lines than a window keep all; a null text is the empty one, which has no
    lines.  Rows that repeat a document lose what the first of them holds.  An
    empty table gives an empty result.  Other columns play no part.  ``docs``
    must be re-readable (a table).
    """
    stage = Stage(docs.sparkSession, "lines")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"),
                       bytes_of(text).alias("body"))
    windows = stage.save(rows.mapInArrow(_windows(size), "id long, rid long, place long, hash binary"), "windows")
    repeated = windows.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("id", "rid", "place")).alias("first")) \
        .where("n > 1").select("hash", "first")
    repeated = stage.save(repeated, "repeated")
    later = windows.join(repeated.hint("merge"), "hash") \
        .where((F.col("rid") != F.col("first.rid")) | (F.col("place") != F.col("first.place")))
    places = stage.save(later.select("rid", "place"), "later").groupBy("rid").agg(F.collect_list("place").alias("places"))
    places = stage.save(places, "places")
    return rows.join(places.hint("shuffle_hash"), "rid", "left").select("id", "body", "places").mapInArrow(
        _remove(size), "id long, n_lines long, n_removed long, spans array<struct<first:long,past:long>>, kept_text string") \
        .withColumnRenamed("id", key)


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (SELECT doc_id, CASE WHEN l[len(l)] = '' THEN l[1:len(l) - 1] ELSE l END AS l FROM d),
w AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM e),
o AS (SELECT doc_id, p, row_number() OVER (PARTITION BY l[p], l[p + 1], l[p + 2] ORDER BY doc_id NULLS FIRST, p) > 1 AS again FROM w),
c AS (SELECT DISTINCT doc_id, p + k AS line FROM o, range(0, 3) t(k) WHERE again),
n AS (SELECT doc_id, count(*) AS n, list(line) AS gone FROM c GROUP BY doc_id)
SELECT e.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN n.n IS NULL THEN coalesce(t.text, '') WHEN n.n = len(l) THEN ''
    ELSE array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(n.gone, i)), lambda i: l[i]), chr(10))
      || CASE WHEN t.text LIKE '%' || chr(10) THEN chr(10) ELSE '' END END) AS kept_sha256
FROM e JOIN documents t USING (doc_id) LEFT JOIN n USING (doc_id)"""


@query("op8_line_dedup", SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
