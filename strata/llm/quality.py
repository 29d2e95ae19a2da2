"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it.  Learned
filters run over every chunk; each filter's largest response in a chunk is
kept (max pooling), and the chunks' responses are combined over the whole
document (largest, mean and smallest per filter) by a small dense layer into
one probability.

Scale: the network is trained once on the driver from at most ``TRAIN_ROWS``
labelled rows per label, whole, and ``TRAIN_BYTES`` bytes (the documented bound
of a classifier's sample, taken by a hash of the id).  Scoring is a map over the texts with about 10,000 weights and
no shuffle; every byte of every text is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesnp import buffer_of, by_size
from .common import bytes_of, query, table

CHUNK, WIDTH, STRIDE = 256, 6, 2
STEP = CHUNK - (WIDTH - STRIDE)  # chunks overlap so that every window lies in one
FILTERS, HIDDEN = 32, 16
WINDOWS = (CHUNK - WIDTH) // STRIDE + 1
TRAIN_ROWS, TRAIN_BYTES = 1000, 8 << 20
EPOCHS, BATCH = 14, 32
THRESHOLD = 0.3
PAD = 256


def byte_codes() -> np.ndarray:
    """Fixed 12-number code of each byte (and of the padding): its kind, and six random numbers."""
    b = np.arange(257)
    kinds = [(b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b == 32) | (b == 10),
             (b > 32) & (b < 127) & ~((b >= 48) & (b <= 57)) & ~((b >= 65) & (b <= 90)) & ~((b >= 97) & (b <= 122)),
             (b >= 48) & (b <= 57), (b >= 128) & (b < 256)]
    noise = np.random.default_rng(7).normal(0, 0.7, (257, 6))
    codes = np.column_stack([*kinds, noise]).astype(np.float32)
    codes[PAD] = 0
    return codes


CODES = byte_codes()
CODE = CODES.shape[1]


def chunks_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks (rows of CHUNK byte numbers, PAD after the end) of all texts, and each text's first chunk."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - (WIDTH - STRIDE)) // STEP))
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    start = offsets[owner] + (np.arange(first[-1]) - first[owner]) * STEP
    at = start[:, None] + np.arange(CHUNK)
    inside = at < offsets[owner + 1][:, None]
    out = np.full(at.shape, PAD, np.int16)
    out[inside] = raw[at[inside]]
    return out, first


def windows_of(chunks: np.ndarray) -> np.ndarray:
    """(chunks, WINDOWS, WIDTH * CODE) view of the coded bytes."""
    x = CODES[chunks]
    a, b, c = x.strides
    return np.lib.stride_tricks.as_strided(x, (len(x), WINDOWS, WIDTH * CODE), (a, b * STRIDE, c))


def responses(chunks: np.ndarray, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled filter responses of each chunk and the windows they come from."""
    z = windows_of(chunks).reshape(-1, WIDTH * CODE) @ w
    z = z.reshape(len(chunks), WINDOWS, -1)
    at = z.argmax(axis=1)
    return np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0] + b, 0), at


class Network:
    """Weights: filters (w, b), dense layer (v, c), output (u, d)."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = WIDTH * CODE
        self.p = {"w": rng.normal(0, n ** -0.5, (n, FILTERS)), "b": np.zeros(FILTERS),
                  "v": rng.normal(0, (3 * FILTERS) ** -0.5, (3 * FILTERS, HIDDEN)), "c": np.zeros(HIDDEN),
                  "u": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "d": np.zeros(1)}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def pooled(self, chunks: np.ndarray, first: np.ndarray) -> np.ndarray:
        m = np.concatenate([responses(chunks[i:i + 64], self.p["w"], self.p["b"])[0]
                            for i in range(0, len(chunks), 64)])
        starts = first[:-1]
        mean = np.add.reduceat(m, starts) / np.diff(first)[:, None]
        return np.concatenate([np.maximum.reduceat(m, starts), mean, np.minimum.reduceat(m, starts)], axis=1)

    def head(self, pooled: np.ndarray) -> np.ndarray:
        h = np.tanh(pooled @ self.p["v"] + self.p["c"])
        return 1 / (1 + np.exp(-(h @ self.p["u"] + self.p["d"]).astype(np.float64)))

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) == 1:
            return np.empty(0)
        return self.head(self.pooled(*chunks_of(raw, offsets)))

    def gradients(self, raw: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        chunks, first = chunks_of(raw, offsets)
        starts, n = first[:-1], len(offsets) - 1
        m, at = responses(chunks, p["w"], p["b"])
        top, low = np.maximum.reduceat(m, starts), np.minimum.reduceat(m, starts)
        sizes = np.diff(first)
        pooled = np.concatenate([top, np.add.reduceat(m, starts) / sizes[:, None], low], axis=1)
        h = np.tanh(pooled @ p["v"] + p["c"])
        q = 1 / (1 + np.exp(-(h @ p["u"] + p["d"])))
        dz = ((q - y) * weight / n).astype(np.float32)
        dh = dz[:, None] * p["u"] * (1 - h * h)
        dp = dh @ p["v"].T
        owner = np.repeat(np.arange(n), sizes)
        dm = dp[owner, FILTERS:2 * FILTERS] / sizes[owner][:, None]
        for part, best in ((dp[:, :FILTERS], top), (dp[:, 2 * FILTERS:], low)):
            tie = m == best[owner]
            dm = dm + part[owner] * tie / np.add.reduceat(tie, starts, dtype=np.float32)[owner]
        dm = dm * (m > 0)
        dw = np.empty_like(p["w"])
        view, rows = windows_of(chunks), np.arange(len(chunks))
        for f in range(FILTERS):
            dw[:, f] = dm[:, f] @ view[rows, at[:, f]]
        return {"w": dw, "b": dm.sum(0), "v": pooled.T @ dh, "c": dh.sum(0), "u": h.T @ dz, "d": dz.sum(keepdims=True)}

    def fit(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS, rate: float = 4e-3) -> Network:
        y = np.array(labels, np.float32)
        share = y.mean()
        # both labels weigh the same in all
        weight = np.where(y == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3)).astype(np.float32)
        rng = np.random.default_rng(3)
        m1, m2 = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        t, steps = 0, max(epochs * -(-len(texts) // BATCH), 300)
        while t < steps:
            order = rng.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                pick = order[i:i + BATCH]
                offsets = np.concatenate([[0], np.cumsum([len(texts[j]) for j in pick])])
                raw = np.frombuffer(b"".join(texts[j] for j in pick), np.uint8)
                t += 1
                lr = rate * min(1.0, t / 20) * (1 - 0.9 * min(1.0, t / steps))
                for k, g in self.gradients(raw, offsets, y[pick], weight[pick]).items():
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.99 * m2[k] + 0.01 * g * g
                    self.p[k] -= (lr * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)
                if t >= steps:
                    break
        return self


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
                  key: str = "doc_id", rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> list[tuple[bytes, int]]:
    """The bounded sample: labelled texts, whole, in the order of a hash of the key, of each label at most
    ``rows`` and no more than fit ``most_bytes`` (the first always does).

    Labels without a document are passed over; of documents that repeat a key
    one counts.
    """
    lab = labels.select(F.col(key).alias("id"), F.col(label).alias("y")).where("id is not null and y in (0, 1)") \
        .groupBy("id").agg(F.max("y").alias("y"))
    body = docs.select(F.col(key).alias("id"), bytes_of(text).alias("body"))
    sized = body.select("id", F.length("body").alias("size")).join(lab, "id").groupBy("id", "y").agg(F.max("size").alias("size"))
    order = F.md5(F.col("id").cast("string").cast("binary"))
    picked = []
    for y in (0, 1):
        total = 0
        for i, r in enumerate(sized.where(F.col("y") == y).orderBy(order, "id").limit(rows).collect()):
            total += r["size"]
            if i and total > most_bytes:
                break
            picked.append((r["id"], r["y"]))
    if not picked:
        return []
    few = docs.sparkSession.createDataFrame(picked, "id long, y int")
    got = body.join(F.broadcast(few), "id").groupBy("id", "y").agg(F.min("body").alias("body")).collect()
    return [(b, y) for _, b, y in sorted((r["id"], bytes(r["body"]), int(r["y"])) for r in got)]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
          key: str = "doc_id", rows: int = TRAIN_ROWS) -> Network | None:
    """Fit a network; None where the labels do not hold both kinds."""
    sample = training_rows(docs, labels, label, text, key, rows)
    if len({y for _, y in sample}) < 2:
        return None
    return Network().fit([b for b, _ in sample], [y for _, y in sample])


def score(docs: DataFrame, model: Network | None, text: str = "text", name: str = "score",
          carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and ``name``, the probability that a text is good.

    A null text scores as the empty one, which is a chunk of padding.  Without
    a model (no labels, or one kind only) every score is 0.5.  An empty table
    gives an empty result; other columns play no part.
    """
    kinds = dict(docs.dtypes)
    cols = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], bytes_of(text).alias("body"))
    schema = ", ".join(f"c{i} {kinds[c]}" for i, c in enumerate(carry)) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "body", 1 << 20):
            s = np.full(batch.num_rows, 0.5) if model is None else model.score(*buffer_of(batch["body"]))
            keep = [batch[f"c{i}"] for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(s, pa.float64())],
                                             names=[*(f"c{i}" for i in range(len(carry))), "score"])

    return cols.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                                               F.col("score").alias(name))


def held_out(key: str = "doc_id", modulus: int = 5):
    """True where crc32 of the key as text is divisible by ``modulus`` (a null key counts as empty)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus == 0


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
