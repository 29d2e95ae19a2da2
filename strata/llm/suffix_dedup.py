"""Removal of repeated byte strings by hash-compared suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts elsewhere,
in another text or the same one, is removed.  Suffixes are compared up to
``length`` bytes: prefix polynomial hashes and binary search find the common
extension of two suffixes in logarithmic time, and a mergesort on the eight
bytes that follow it orders them.  Suffixes that the hashes call equal are
compared byte by byte.

Scale: sorting every suffix of a corpus would move it hundreds of times over.
Instead each text is cut into segments of starts whose strings share their
smallest ``GRAM``-byte hash (suffix_hash.py); equal strings have equal smallest
hashes, so a segment whose hash occurs once holds no repeat.  The bytes of the
others are fetched and grouped: segments of equal bytes repeat as a whole, and
what remains are the segments at the edges of repeats, which are suffix-sorted
by smallest hash, with one segment of each group of equal ones.  Where more
than ``GROUP`` different segments share their smallest hash, they are not
sorted in one task: their strings are counted with map-side combine, by hash
and then, where that occurs again, by their bytes.

A hash only ever leaves out what cannot repeat; every removal rests on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesnp import buffer_of, by_size, mix, numbers
from .common import Stage, bytes_of, query, table
from .suffix_hash import prefix_hash, segments, string_hash

LENGTH = 200
GROUP = 1024
_U = np.uint64
_SECOND = numbers(256, 23)


def eight_bytes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (zeros after the end)."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(_U)
    out = np.zeros(len(raw) + 1, _U)
    for i in range(8):
        out |= padded[i:i + len(out)] << _U(56 - 8 * i)
    return out


def common_extension(acc: np.ndarray, a: np.ndarray, b: np.ndarray, low: np.ndarray, length: int) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, known to be ``low`` at least, up to ``length``."""
    lo, hi = low.copy(), np.full(len(a), length, np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi + 1) // 2
        same = string_hash(acc, a, a + mid) == string_hash(acc, b, b + mid)
        lo, hi = np.where(open_ & same, mid, lo), np.where(open_ & ~same, mid - 1, hi)


def sort_suffixes(raw: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Class of each suffix: suffixes of a group with the same first ``length`` bytes share one; -1: alone."""
    acc, keys = prefix_hash(raw), eight_bytes(raw)
    out = np.full(len(at), -1, np.int64)
    mine, tie = np.arange(len(at)), group.astype(np.int64)
    depth = np.zeros(len(at), np.int64)
    classes = 0
    while len(mine):
        # the part of the key that lies within ``length`` bytes
        rest = np.minimum(8, length - depth)
        key = keys[at[mine] + depth] >> (_U(64) - rest.astype(_U) * _U(8))
        order = np.lexsort((key, tie))
        mine, tie, key, depth, rest = (x[order] for x in (mine, tie, key, depth, rest))
        new = np.concatenate([[True], (tie[1:] != tie[:-1]) | (key[1:] != key[:-1])])
        number = np.cumsum(new) - 1
        more = np.bincount(number)[number] > 1
        mine, number, depth = mine[more], number[more], (depth + rest)[more]
        if not len(mine):
            break
        new = np.concatenate([[True], number[1:] != number[:-1]])
        first = np.flatnonzero(new)
        ext = np.full(len(mine), length, np.int64)
        i = np.flatnonzero(~new)
        ext[i] = common_extension(acc, at[mine[i - 1]], at[mine[i]], depth[i], length)
        shared = np.minimum.reduceat(ext, first)  # what all of a tie have in common
        size = np.diff(np.append(first, len(mine)))
        done = np.repeat(shared >= length, size)
        tie = np.repeat(np.arange(len(first)), size)
        out[mine[done]] = classes + tie[done]
        classes += len(first)
        mine, depth, tie = mine[~done], np.repeat(shared, size)[~done], tie[~done]
    return _verified(keys, at, out, length)


def _verified(keys: np.ndarray, at: np.ndarray, classes: np.ndarray, length: int) -> np.ndarray:
    """Compare the bytes within each class; a class that the hashes joined wrongly is parted."""
    found = np.flatnonzero(classes >= 0)
    if not len(found):
        return classes
    found = found[np.argsort(classes[found], kind="stable")]
    c = classes[found]
    a, b = found[:-1][c[1:] == c[:-1]], found[1:][c[1:] == c[:-1]]
    wrong = np.zeros(len(a), bool)
    for i in range(0, length, 8):
        cut = _U(64 - 8 * min(8, length - i))
        wrong |= (keys[at[a] + i] >> cut) != (keys[at[b] + i] >> cut)
    for k in np.unique(classes[a[wrong]]):
        members, seen = np.flatnonzero(classes == k), {}
        for m in members:
            text = b"".join(int(keys[at[m] + i]).to_bytes(8, "big") for i in range(0, length, 8))[:length]
            seen.setdefault(text, []).append(m)
        top = classes.max() + 1
        for j, same in enumerate(seen.values()):
            classes[same] = top + j if len(same) > 1 else -1
    return classes


def _segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 2 << 20):
            text, start, windows, h, more = segments(*buffer_of(batch["body"]), length)
            yield pa.RecordBatch.from_arrays([
                batch["rid"].take(pa.array(text)), pa.array(start), pa.array(windows.astype(np.int32)),
                pa.array(h), pa.array(more)], names=["rid", "start", "windows", "h", "more"])

    return run


SEGMENT = "rid long, start long, windows int, h long, more boolean"
CUT = "h long, rid long, start long, windows int, body binary"
SPAN = "rid long, lo long, hi long"
STRING = "one long, two long, rid long, place long, single boolean, string binary"


def _cut(length: int):
    """The bytes of each segment that is to be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 4 << 20):
            raw, offsets = buffer_of(batch["body"])
            found, data = batch["segs"].flatten(), raw.tobytes()
            text = batch["segs"].value_parent_indices()
            start, windows = (found.field(k).to_numpy() for k in ("start", "windows"))
            lo = offsets[text.to_numpy()] + start
            bodies = [data[i:j] for i, j in zip(lo.tolist(), (lo + windows - 1 + length).tolist())]
            yield pa.RecordBatch.from_arrays([
                found.field("h"), batch["rid"].take(text), found.field("start"), found.field("windows"),
                pa.array(bodies, pa.binary())], names=[c.split()[0] for c in CUT.split(", ")])

    return run


def _spans(rid: np.ndarray, place: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of repeated starts (in order within a segment) as byte spans."""
    if not len(rid):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["rid", "lo", "hi"])
    new = np.flatnonzero(np.concatenate([[True], (rid[1:] != rid[:-1]) | (place[1:] != place[:-1] + 1)]))
    last = np.append(new[1:], len(rid)) - 1
    return pa.RecordBatch.from_arrays([pa.array(rid[new]), pa.array(place[new]), pa.array(place[last] + length)],
                                      names=["rid", "lo", "hi"])


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(raw, row, place in raw, start in text) of every window of the batch's segments."""
    raw, offsets = buffer_of(batch["body"])
    n = batch["windows"].to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return raw, row, offsets[row] + nth, batch["start"].to_numpy()[row] + nth


def _compare(length: int, limit: int = 2 << 20):
    """Suffix-sort whole groups (rows come in order of h), several at a time."""
    def spans(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, row, at, place = _windows(batch)
        h = batch["h"].to_numpy()
        group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])[row]
        again = (sort_suffixes(raw, at, group, length) >= 0) & batch["single"].to_numpy(zero_copy_only=False)[row]
        return _spans(batch["rid"].to_numpy()[row[again]], place[again], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in by_size(batches, "body", limit):
            held.append(batch)
            size += batch["body"].nbytes
            if size < limit:
                continue
            whole = pa.concat_batches(held)
            h = whole["h"].to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last group may go on
            if cut:
                yield spans(whole.slice(0, cut))
            held = [whole.slice(cut)]
            size = held[0]["body"].nbytes if cut else 0
        if held:
            whole = pa.concat_batches(held)
            if whole.num_rows:
                yield spans(whole)

    return run


def _strings(length: int, bits: int):
    """Every string of the batch's segments, with two hashes of ``bits`` bits."""
    down = _U(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 1 << 18):
            raw, row, at, place = _windows(batch)
            one = mix(string_hash(prefix_hash(raw), at, at + length)) >> down
            two = mix(string_hash(prefix_hash(raw ^ np.uint8(0x5A)), at, at + length) + _SECOND[raw[at]]) >> down
            data = raw.tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(batch["rid"].to_numpy()[row]),
                pa.array(place), pa.array(batch["single"].to_numpy(zero_copy_only=False)[row]),
                pa.array([data[i:i + length] for i in at.tolist()], pa.binary())],
                names=[c.split()[0] for c in STRING.split(", ")])

    return run


def _hot_spans(hot: DataFrame, stage: Stage, length: int, bits: int) -> DataFrame:
    """Repeated strings of the single segments among those of large groups."""
    strings = hot.mapInArrow(_strings(length, bits), STRING)
    twice = strings.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    likely = stage.save(strings.join(stage.save(twice, "twice").hint("merge"), ["one", "two"]), "likely")
    # rows that share their bytes with no other: their hashes are equal by chance
    alone = likely.groupBy("one", "two", "string").agg(
        F.count("*").alias("n"), F.min("rid").alias("rid"), F.min("place").alias("place")) \
        .where("n = 1").select("rid", "place")
    again = likely.where("single").select("rid", "place").join(stage.save(alone, "alone"), ["rid", "place"], "left_anti")
    spans = again.select("rid", F.col("place").alias("lo"), (F.col("place") + length).alias("hi"))
    return stage.save(spans, "counted")


def _remove():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 8 << 20):
            spans, kept = [], []
            for i, found in enumerate(batch["found"].to_pylist()):
                body, merged = batch["body"][i].as_py(), []
                for s in sorted((s["lo"], s["hi"]) for s in found or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                spans.append([{"lo": a, "hi": b} for a, b in merged])
                edges = [0, *(x for s in merged for x in s), len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else body)
            yield pa.RecordBatch.from_arrays([
                batch["id"], pa.array([len(b) for b in batch["body"].to_pylist()], pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH,
                   group: int = GROUP, bits: int = 64) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts elsewhere in the input.

    Returns one row per input row: ``key``, ``n_bytes``, ``spans`` (the maximal
    removed runs, in order, as byte offsets lo..hi) and ``kept`` (the remaining
    bytes).  Repeats are judged on the input; overlapping occurrences within
    one text count; a match never crosses texts.  ``group`` and ``bits`` (of the
    hashes that large groups are counted by first) change the cost, not the result.

    A null text is the empty one; a text shorter than ``length`` keeps all.
    Null and repeated keys are no matter: rows are told apart by their place,
    and rows of equal text repeat each other.  An empty table gives an empty
    result.  Other columns play no part.  ``docs`` must be re-readable (a table).
    """
    spark = docs.sparkSession
    stage = Stage(spark, "suffix")
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("rid"), bytes_of(text).alias("body"))
    texts = rows.select("rid", "body")
    segs = stage.save(texts.mapInArrow(_segments(length), SEGMENT), "segments")
    often = segs.groupBy("h").agg(F.sum(F.lit(1) + F.col("more").cast("int")).alias("n")).where("n > 1").select("h")
    again = segs.drop("more").join(stage.save(often, "often").hint("merge"), "h")
    again = stage.save(again, "again")
    stage.drop("segments")

    by_text = again.groupBy("rid").agg(F.collect_list(F.struct("h", "start", "windows")).alias("segs"))
    cut = texts.join(by_text.hint("shuffle_hash"), "rid").select("rid", "body", "segs").mapInArrow(_cut(length), CUT)
    cut = stage.save(cut, "cut")  # the texts' shuffle can go before the segments are shuffled
    stage.drop("again")
    # copies are put together before the shuffle; a class of one has its own place, the others need none
    equal = stage.save(cut.groupBy("h", "body").agg(
        F.count("*").alias("n"), F.min("rid").alias("rid"), F.min("start").alias("start"),
        F.min("windows").alias("windows")), "equal")
    single = F.col("n") == 1
    alone = equal.where(single).select("rid", "start")
    whole = cut.select("rid", "start", "windows").join(alone, ["rid", "start"], "left_anti") \
        .select("rid", F.col("start").alias("lo"), (F.col("start") + F.col("windows") - 1 + length).alias("hi"))
    found = stage.save(whole, "whole")
    stage.drop("cut")

    groups = equal.groupBy("h").agg(F.count("*").alias("different"), F.count_if(single).alias("singles")) \
        .where("singles > 0").select("h", (F.col("different") > group).alias("hot"))
    edges = equal.join(stage.save(groups, "groups").hint("merge"), "h") \
        .select("h", "hot", single.alias("single"), "rid", "start", "windows", "body")
    edges = stage.save(edges, "edges", by=("hot",))
    stage.drop("equal")
    compared = edges.where("not hot").drop("hot").repartition("h").sortWithinPartitions("h") \
        .mapInArrow(_compare(length), SPAN)
    found = found.unionAll(stage.save(compared, "compared"))
    hot = edges.where("hot").drop("hot")
    if not hot.isEmpty():
        found = found.unionAll(_hot_spans(hot, stage, length, bits))
    found = found.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    found = stage.save(found, "found")
    stage.drop("edges")
    return rows.join(found.hint("shuffle_hash"), "rid", "left").select("id", "body", "found").mapInArrow(
        _remove(), f"id {kind}, n_bytes long, spans array<struct<lo:long,hi:long>>, kept binary") \
        .withColumnRenamed("id", key)


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
