"""Near-duplicate detection by MinHash: signatures, banding, verification, components.

1. Each text's set of word shingles is hashed by ``PERMS`` universal functions;
   the minima are its signature.  Texts of one set form a class, and only one
   row of a class goes on.
2. Bands of minima are bucket keys.  A band holds as many minima as let a pair
   at the threshold share no bucket with probability ``MISS`` at most: with 32
   bands of 4 a pair of similarity 0.8 is missed with probability 5e-8.
3. Every member of a bucket is first paired with the bucket's smallest member,
   never with all.  Pairs are confirmed on the full sets and joined into
   components.  In a bucket whose other members still lie in different
   components, these are compared on the full sets, too: blocks of ``BLOCK``
   members (or ``BLOCK_SHINGLES`` shingles) meet as units, and a unit returns no more links than it takes to
   join what is apart.  So no link between different sets is lost to a cap.
4. Components come from alternating large-star and small-star.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesnp import by_size, mix, numbers, shingles
from .common import Stage, bytes_of, query, table
from .components import components

PERMS = 128
MISS = 1e-6
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
_U = np.uint64
_A, _B = numbers(PERMS, 11) | _U(1), numbers(PERMS, 12)


def signature(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minima of ``PERMS`` multiply-add-shift functions per text (rows; texts without shingles: zeros)."""
    n = len(offsets) - 1
    out = np.zeros((n, PERMS), np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    at = offsets[full]
    x = mix(hashes) >> _U(32)
    # texts of a block are handled together while its hashes stay in cache
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(at, at[i] + 16384, "right")) - 1)
        lo, hi = at[i], offsets[full[j - 1] + 1]
        part, cuts = x[lo:hi], at[i:j] - lo
        for p in range(PERMS):
            out[full[i:j], p] = np.minimum.reduceat(part * _A[p] + _B[p], cuts) >> _U(32)
        i = j
    return out


def sets_of(column: pa.Array, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    h, at = shingles(column, k)
    return [np.unique(h[at[i]:at[i + 1]]) for i in range(len(at) - 1)]


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body"):
            h, at = shingles(batch["body"], k)
            sets = [np.unique(h[at[i]:at[i + 1]]) for i in range(batch.num_rows)]
            sig = signature(h, at)
            yield pa.RecordBatch.from_arrays([
                batch["id"], batch["rid"], pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in sig], pa.binary())], names=["id", "rid", "n", "set_key", "sig"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.empty((0, PERMS), np.uint32)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PERMS)


def rows_per_band(percent: int) -> int:
    """The most minima a band may hold for pairs at the threshold to be missed with probability ``MISS`` at most."""
    for rows in (4, 2, 1):
        if (1 - (percent / 100) ** rows) ** (PERMS // rows) <= MISS:
            return rows
    raise ValueError(f"{PERMS} minima do not find pairs of {percent} percent")


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per text and band of ``rows`` minima."""
    acc = np.tile(numbers(PERMS // rows, 13), (len(sig), 1))
    for r in range(rows):
        acc = mix(acc * _U(5) + sig[:, r::rows].astype(_U))
    return acc.view(np.int64)


def _band(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch["sig"]), rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.ravel()), pa.array(np.repeat(batch["node"].to_numpy(), keys.shape[1]))],
                names=["bucket", "node"])

    return run


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |intersection| >= percent * |union| of two sorted distinct arrays."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in by_size(batches, "ta", 2 << 20):
            left = sets_of(batch["ta"], k)
            tb, hit = batch["tb"], []
            for i, (b, s) in enumerate(zip(batch["b"].to_pylist(), left)):
                raw = tb[i].as_py()
                if last[0] != raw:
                    last = raw, sets_of(pa.array([raw], pa.binary()), k)[0]
                if jaccard_at_least(s, last[1], percent):
                    hit.append(i)
            keep = pa.array(hit, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["a"].take(keep), batch["b"].take(keep)], names=["a", "b"])

    return run


def common_counts(sets: list[np.ndarray], split: int, chunk: int = 4096) -> np.ndarray:
    """Intersection sizes of each of the first ``split`` sets with each of the rest (with each of them all: split 0)."""
    sizes = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, df = np.unique(np.concatenate(sets) if sets else np.empty(0, _U), return_inverse=True, return_counts=True)
    shared = df[column] > 1  # a shingle of one set alone is in no intersection
    number = np.cumsum(df > 1) - 1
    column, owner = number[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((split, len(sets) - split) if split else (len(sets), len(sets)), np.float32)
    for c in range(0, int(number[-1]) + 1 if len(number) else 0, chunk):
        i, j = np.searchsorted(column, [c, c + chunk])
        m = np.zeros((len(sets), chunk), np.float32)
        m[owner[i:j], column[i:j] - c] = 1
        out += m[:split] @ m[split:].T if split else m @ m.T
    return out.astype(np.int64)


def _meet(k: int, percent: int):
    """Links between the members of a unit's two blocks that lie in different components, as many as join them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "node"])
        one = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
        split = 0 if one else int((pdf["side"] == 0).sum())
        out: list[tuple[int, int]] = []
        if one or 0 < split < len(pdf):
            sets = sets_of(pa.array(pdf["body"].tolist(), pa.binary()), k)
            size = np.array([len(x) for x in sets])
            inter = common_counts(sets, split)
            rows, cols = (slice(None), slice(None)) if one else (slice(0, split), slice(split, None))
            node, label = pdf["node"].to_numpy(), pdf["label"].to_numpy()
            alike = 100 * inter >= percent * (size[rows, None] + size[None, cols] - inter)
            alike &= label[rows, None] != label[None, cols]
            parent = {x: x for x in label.tolist()}

            def root(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in np.argwhere(alike):
                a, b = root(label[rows][i]), root(label[cols][j])
                if a != b:
                    parent[a] = b
                    out.append((node[rows][i], node[cols][j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype(np.int64)

    return run


def _joined(comp: DataFrame, links: DataFrame, stage: Stage) -> DataFrame:
    """Components after more links: the components so far are the nodes that the links join."""
    ends = links
    for end in ("a", "b"):
        named = comp.select(F.col("node").alias(end), F.col("component").alias("to"))
        ends = ends.join(named.hint("merge"), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    ends = stage.save(ends, "ends")
    merged = stage.save(components(ends), "merged")
    old = comp.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")).hint("merge"),
                    "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return old.unionAll(merged.join(comp.select("node").hint("merge"), "node", "left_anti"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 2,
                    percent: int = 80, carry: tuple[str, ...] = ()) -> DataFrame:
    """Link texts whose word-shingle sets have 100 * intersection >= percent * union.

    Returns one row per input row: ``key``, the ``carry`` columns,
    ``n_shingles``, ``component_id`` (smallest key reachable over links) and
    ``kept`` (key = component_id).

    Letters A-Z count as a-z.  A text of fewer words than a shingle has its
    whole sequence as one; a null, empty or blank text has the empty set and
    is linked with nothing.  A ``percent`` below what the minima can find (about
    11) is refused.  Keys are integers.  Rows that repeat a key and
    text share a component; a row with a null key gets a null component and is
    kept.  An empty table gives an empty result.  Other columns play no part.
    ``docs`` must be re-readable (a table).
    """
    spark = docs.sparkSession
    stage = Stage(spark, "minhash")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"),
                       bytes_of(text).alias("body"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    signed = stage.save(rows.select("id", "rid", "body").mapInArrow(
        _sign(shingle), "id long, rid long, n long, set_key binary, sig binary"), "signed")
    classes = stage.save(signed.where("n > 0 and id is not null").groupBy("set_key").agg(
        F.min(F.struct("id", "rid")).alias("first")).select("set_key", "first.*"), "classes")
    heads = signed.join(classes.select("rid", F.col("id").alias("node")).hint("merge"), "rid").select("node", "rid", "n", "sig")
    heads = stage.save(heads, "heads")

    banded = heads.select("node", "sig").mapInArrow(_band(rows_per_band(percent)), "bucket long, node long")
    buckets = stage.save(banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("head"))
                         .where("size > 1"), "buckets")
    members = stage.save(banded.join(buckets.hint("merge"), "bucket"), "members")
    pairs = stage.save(members.where("node <> head").select(
        F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "pairs")

    # texts of all rows that any bucket holds with another
    wanted = members.select("node").distinct().join(heads.select("node", "rid"), "node")
    texts = stage.save(rows.select("rid", "body").join(
        stage.save(wanted, "wanted").hint("shuffle_hash"), "rid").select("node", "body"), "texts")

    sides = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("ta")).hint("merge"), "b") \
        .join(texts.select(F.col("node").alias("a"), F.col("body").alias("tb")).hint("merge"), "a")
    links = stage.save(sides.select("a", "b", "ta", "tb").mapInArrow(_verify(shingle, percent), "a long, b long"), "links")
    comp = stage.save(components(links), "components")

    # the head was paired with all; a bucket matters further if its other members lie in several components
    labelled = members.where("size > 2 and node <> head").join(comp.hint("merge"), "node", "left") \
        .select("bucket", "node", "size", F.coalesce("component", "node").alias("label"))
    labelled = stage.save(labelled, "labelled")
    several = labelled.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1")
    inside = labelled.join(stage.save(several.select("bucket"), "several").hint("merge"), "bucket")
    inside = stage.save(inside.join(heads.select("node", "n").hint("merge"), "node"), "sized")
    blocks = F.ceil(F.greatest(F.max("size") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    inside = inside.drop("n").join(inside.groupBy("bucket").agg(blocks.alias("blocks")).hint("merge"), "bucket")
    inside = stage.save(inside, "inside")
    if not inside.isEmpty():
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        units = inside.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))) \
            .select("bucket", "node", "label", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                    (F.col("block") > F.col("other")).cast("int").alias("side"))
        more = units.join(texts.hint("merge"), "node").groupBy("bucket", "lo", "hi").applyInPandas(
            _meet(shingle, percent), "a long, b long")
        more = stage.save(more.distinct(), "more_links")
        if not more.isEmpty():
            comp = stage.save(_joined(comp, more, stage), "components_joined")

    out = signed.select("id", "rid", "n", "set_key").join(
        classes.select("set_key", F.col("id").alias("node")).hint("merge"), "set_key", "left")
    out = out.join(comp.hint("merge"), "node", "left").select(
        "id", "rid", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"))
    if carry:
        out = out.join(rows.drop("id", "body"), "rid")
    return out.select(F.col("id").alias(key), *[F.col(f"carry_{c}").alias(c) for c in carry],
                      F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)),
"""
SQL = "WITH RECURSIVE " + SQL.strip()[5:] + r"""
r(node, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen)
SELECT n.doc_id, n.n AS n_shingles, min(r.seen) AS component_id, n.doc_id = min(r.seen) AS kept
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n"""


@query("op4_minhash_dedup", SQL)
def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
