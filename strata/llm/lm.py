"""Language-model scores of texts: an add-one word model and a causal self-attention model.

1. Texts are read once, in blocks of about ``BLOCK`` bytes.  A block's distinct
   words are hashed, counted and cut into subword ids (by a public tokenizer)
   once each; its texts become numbers of words in its list.
2. Word counts: every block sends its list, split by hash, to the parts that
   add the counts up, and gets the corpus counts of its own words back.  No
   word's count is ever held for the whole corpus in one place.
3. The attention model (attention.py) takes its classes and shares from the
   counts of every subword in its context over all training texts, and its
   weights from gradient descent on all windows of the training texts: each
   part of the data takes its own steps on a share of its windows, another one
   in each of ``ROUNDS`` rounds, and the parts' weights are averaged after each.
   Both grow with the corpus.
4. Every text is scored in overlapping windows, each id once.  The score takes
   each word's probability as (1 - WORD_SHARE) times the attention model's,
   multiplied over its subword ids, and WORD_SHARE times its share of the
   training words.  ``attention_score`` is the attention model's alone.

What is broadcast (code vectors, class shares, weights) is bounded by the
tokenizer's vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention as A
from . import attention_graph
from .bytesnp import LOWER, buffer_of, by_size, word_hashes, word_spans
from .common import Stage, bytes_of, query, table
from .subwords import default_path, forget, word_bpe

PRODUCTS = attention_graph if attention_graph.READY else A  # numpy does the same, more slowly
BLOCK = 2 << 20
RUN = 10_000  # texts; a block ends with each run of a task's texts, too
CACHE_WORDS = 200_000  # per Python worker; a block looks each of its words up once
PART_BYTES = 32 << 20  # of text for each part that adds up counts; its word lists take a few times that at most
HASHED = 1 << 18  # bytes of text whose powers and sums are held at a time
# Blocks are rows of some MB: jobs on them hold one at a time, in buffers that Arrow and Parquet use again
# (larger ones lie outside of the heap until the JVM happens to collect).
AT_ONCE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "1"}
FEW_TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
PAGES = {"parquet.page.size.row.check.min": "1"}  # else a page holds 100 blocks
ROUNDS = 3
RATES = (1e-2, 5e-3, 2e-3)
LEAST_STEPS = 120  # a part's windows are gone over again until it has taken so many steps
WORD_SHARE = 0.2
HOLD_MODULUS, HOLD_REST = 7, 2
VOCABULARY, END = 49408, 49407  # of the tokenizer; its end-of-text id closes a text
NO_IDS = -50.0  # natural log for a word that the tokenizer gives no ids

ROWS = ("kind int, block long, part int, keys array<long>, held array<boolean>, a binary, b binary, c binary, "
        "d binary, cells array<long>, counts array<long>")
NAMES = [c.split()[0] for c in ROWS.split(", ")]
TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4,
         pa.list_(pa.int64()), pa.list_(pa.int64())]
TEXTS, WORDS, CELLS = range(3)


def _rows(kind: int, **columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n if c == "kind" else columns.get(c, [None] * n), t) for c, t in zip(NAMES, TYPES)], names=NAMES)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part (0..parts-1) that adds up a word's counts; rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def expand(words: np.ndarray, word_at: np.ndarray, ids: np.ndarray, id_at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ids of all texts, each closed by END: (ids, ids per text, ids per word, with the end as a word)."""
    sizes = np.diff(id_at)[words]
    texts = len(word_at) - 1
    per_word = np.insert(sizes, word_at[1:], 1)
    first = np.insert(id_at[words], word_at[1:], len(ids))
    flat = np.append(ids, np.uint16(END)).astype(np.int64)
    total = int(per_word.sum())
    at = np.repeat(first - np.concatenate([[0], np.cumsum(per_word)[:-1]]), per_word) + np.arange(total)
    ends = np.cumsum(per_word)
    closing = word_at[1:] + np.arange(texts)
    return flat[at], np.diff(np.concatenate([[0], ends[closing]])), per_word


def word_ends(path: str) -> np.ndarray:
    """Which ids close a word."""
    vocabulary = word_bpe(path, CACHE_WORDS).whole.get_vocab()
    out = np.zeros(VOCABULARY + 1, bool)
    for piece, i in vocabulary.items():
        out[i] = piece.endswith("</w>")
    out[END] = True
    return out


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts in blocks of about ``BLOCK`` bytes, whatever the size of the batches they come in."""
    rest, seen = None, 0  # rest: the last block so far, which may go on
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, RUN - seen)
            batch, seen = batch.slice(some.num_rows), seen + some.num_rows
            *whole, rest = by_size([some if rest is None else pa.concat_batches([rest, some])], "body", BLOCK)
            yield from whole
            if seen == RUN:
                yield rest
                rest, seen = None, 0
    if rest is not None:
        yield rest


def _read(path: str, parts: int):
    """Blocks, word lists and context counts of the texts of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _SCORERS.clear()  # of an earlier job in this worker
        bpe, closes = word_bpe(path, CACHE_WORDS), word_ends(path)
        counts = np.zeros((VOCABULARY, A.CONTEXTS), np.int32)
        block = TaskContext.get().partitionId() << 32
        for batch in blocks(batches):
            raw, offsets = buffer_of(batch["body"])
            starts, ends = word_spans(raw, offsets)
            hashes, first, words = np.unique(
                word_hashes(raw, starts, ends, step=HASHED), return_index=True, return_inverse=True)
            word_at = np.concatenate([np.searchsorted(starts, offsets[:-1]), [len(starts)]])
            low = LOWER[raw].tobytes()
            ids, per_word = bpe.cut([low[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())])
            ids, id_at = ids.astype(np.uint16), np.concatenate([[0], np.cumsum(per_word)])
            held = batch["held"].to_numpy(zero_copy_only=False)
            yield _rows(TEXTS, block=[block], keys=[batch["id"].to_pylist()], held=[held.tolist()],
                        a=[word_at.astype(np.int64).tobytes()], b=[words.astype(np.uint32).tobytes()],
                        c=[per_word.astype(np.uint32).tobytes()], d=[ids.tobytes()])
            learnt = np.repeat(~held, np.diff(word_at))
            tf = np.bincount(words[learnt], minlength=len(hashes)).astype(np.uint32)
            cut = np.searchsorted(part_of(hashes, parts), np.arange(parts + 1))
            some = [p for p in range(parts) if cut[p + 1] > cut[p]]
            if some:
                yield _rows(WORDS, block=[block] * len(some), part=some,
                            a=[hashes[cut[p]:cut[p + 1]].tobytes() for p in some],
                            b=[tf[cut[p]:cut[p + 1]].tobytes() for p in some])
            flat, sizes, _ = expand(words, word_at, ids, id_at)
            mine = np.repeat(~held, sizes)
            flat, sizes = flat[mine], sizes[~held]
            if len(sizes):
                begin = np.cumsum(sizes) - sizes
                before = np.concatenate([[END], flat[:-1]])
                before[begin] = END
                np.add.at(counts.ravel(), flat * A.CONTEXTS + A.contexts(before, closes), np.int32(1))
            block += 1
        cell = np.flatnonzero(counts)
        if len(cell):
            yield _rows(CELLS, cells=[cell], counts=[counts.ravel()[cell].astype(np.int64)])

    return run


def ids_of(row: dict) -> tuple[np.ndarray, ...]:
    """Words per text (as offsets), words, ids and ids per word (as offsets) of a block's row."""
    id_at = np.concatenate([[0], np.cumsum(np.frombuffer(row["c"], np.uint32), dtype=np.int64)])
    return (np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.uint32).astype(np.int64),
            np.frombuffer(row["d"], np.uint16), id_at)


def training_windows(row: dict, r: int) -> tuple[np.ndarray, ...]:
    """Round ``r``'s share of the windows of a block's training texts: (keys, targets, is a text's first).

    The shares are dealt at random; together they hold every window once.
    """
    word_at, words, ids, id_at = ids_of(row)
    learnt = ~np.array(row["held"], bool)
    flat, sizes, _ = expand(words, word_at, ids, id_at)
    flat, sizes = flat[np.repeat(learnt, sizes)], sizes[learnt]
    dealt = np.random.default_rng(row["block"]).permutation(int((-(-sizes // A.QUERIES)).sum()))
    if not len(dealt):
        return np.empty((0, A.KEYS), np.int64), np.empty((0, A.QUERIES), np.int64), np.empty(0, bool)
    return A.windows(flat, sizes, END, VOCABULARY, dealt[r::ROUNDS])[:3]


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of a part's words, one row for each block's list; ``v``, ``n``: distinct and all words."""
    forget()
    lists = [np.frombuffer(x, np.uint64) for x in pdf["a"]]
    words, at = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(at, np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["b"]]), len(words)).astype(np.int64)
    back = np.split(total[at], np.cumsum([len(x) for x in lists])[:-1])
    first = np.arange(len(pdf)) == 0
    return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "counts": [x.tobytes() for x in back],
                         "v": np.where(first, int((total > 0).sum()), 0), "n": np.where(first, int(total.sum()), 0)})


def _pack(w: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float32).tobytes()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    like, flat, out = A.start_weights(), np.frombuffer(data, np.float32), {}
    for k in sorted(like):
        out[k], flat = flat[:like[k].size].reshape(like[k].shape), flat[like[k].size:]
    return out


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Spark's settings for the jobs run inside."""
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, n in wanted.items():
            spark.conf.set(k, n)
        yield
    finally:
        for k, n in before.items():
            spark.conf.set(k, n)


def fit(stage: Stage, texts: DataFrame, cells: DataFrame) -> tuple[A.Tables, dict[str, np.ndarray]]:
    """Tables and weights from the texts and context counts of all blocks."""
    spark = stage.spark
    summed = cells.select(F.explode(F.arrays_zip("cells", "counts")).alias("x")).groupBy(F.col("x.cells").alias("cell")) \
        .agg(F.sum("x.counts").alias("n")).toPandas()  # at most vocabulary x contexts rows
    counts = np.zeros(VOCABULARY * A.CONTEXTS, np.float32)
    counts[summed["cell"].to_numpy(np.int64)] = summed["n"].to_numpy(np.float64)
    tables = A.fit_tables(counts.reshape(VOCABULARY, A.CONTEXTS))
    weights = A.start_weights()
    shared = spark.sparkContext.broadcast((tables.code, tables.kind))
    for r in range(ROUNDS):
        given = _pack(weights)

        def learn(batches: Iterator[pa.RecordBatch], r=r, given=given) -> Iterator[pa.RecordBatch]:
            own = A.Tables(*shared.value, np.empty(0))
            learner, n = PRODUCTS.Learner(own, _unpack(given), RATES[r]), 0
            forget()  # all words are cut by now
            last: list = []
            for batch in batches:
                for i in range(batch.num_rows):
                    some = training_windows(batch.slice(i, 1).to_pylist()[0], r)
                    learner.learn(*some)
                    n += len(some[0])
                    if learner.steps < LEAST_STEPS:
                        last.append(some)
            while n and learner.steps < LEAST_STEPS:
                for some in last:
                    learner.learn(*some)
            w = learner.w
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 64], pa.int32()),
                                              pa.array([n], pa.int64()), pa.array([_pack(w)], pa.binary())],
                                             names=["grp", "n", "w"])

        def average(pdf: pd.DataFrame) -> pd.DataFrame:
            n = pdf["n"].to_numpy(np.float64)
            mean = np.average([np.frombuffer(x, np.float32) for x in pdf["w"]], axis=0, weights=n)
            return pd.DataFrame({"grp": pdf["grp"][:1], "n": [int(n.sum())], "w": [mean.astype(np.float32).tobytes()]})

        shape = "grp int, n long, w binary"
        with settings(spark, AT_ONCE):
            got = texts.select("block", "held", "a", "b", "c", "d").mapInArrow(learn, shape).where("n > 0") \
                .groupBy("grp").applyInPandas(lambda pdf: average(pdf), shape).collect()  # 64 rows at most
        if not got:
            break
        got.sort(key=lambda x: x["grp"])
        weights = _unpack(average(pd.DataFrame([x.asDict() for x in got]))["w"].iloc[0])
    shared.unpersist()
    return tables, weights


_SCORERS: dict[str, A.Scorer | attention_graph.Scorer] = {}


def _scorer(shared) -> A.Scorer:
    """One per Python worker."""
    tables, weights, closes, token = shared.value
    if token not in _SCORERS:
        _SCORERS.clear()
        forget()
        _SCORERS[token] = PRODUCTS.Scorer(tables, weights, closes)
    return _SCORERS[token]


OUT = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, attention_score double"


def _score(shared, total: int, distinct: int, learnt: int):
    """Scores of the blocks' texts."""
    lowest = total + distinct + 1

    def one(row: dict) -> pa.RecordBatch:
        word_at, words, ids, id_at = ids_of(row)
        parts = sorted((x["part"], x["counts"]) for x in row["parts"] or ())
        counts = np.frombuffer(b"".join(x for _, x in parts), np.int64)
        # each text's words, closed by the end
        texts = len(word_at) - 1
        c = np.insert(counts[words], word_at[1:], learnt)
        first = word_at[:-1] + np.arange(texts)
        flat, sizes, per_word = expand(words, word_at, ids, id_at)
        run = np.concatenate([[0], np.cumsum(_scorer(shared).log_probs(flat, sizes, END))])
        ends = np.cumsum(per_word)
        model = np.where(per_word > 0, run[ends] - run[ends - per_word], NO_IDS)
        plain = np.add.reduceat(np.log10((c + 1) / lowest), first)
        mixed = np.log10(WORD_SHARE * c / max(total, 1) + (1 - WORD_SHARE) * np.exp(model) + 1e-300)
        return pa.RecordBatch.from_arrays([
            pa.array(row["keys"], pa.int64()), pa.array(row["held"], pa.bool_()),
            pa.array(np.diff(word_at) + 1), pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
            pa.array(plain), pa.array(np.add.reduceat(mixed, first)),
            pa.array(np.add.reduceat(model, first) / math.log(10))], names=[x.split()[0] for x in OUT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield one(batch.slice(i, 1).to_pylist()[0])

    return run


def parts_for(docs: DataFrame, text: str = "text") -> int:
    """How many parts add up the word counts: by bytes, as texts may be of any length."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(8, -(-size // PART_BYTES))


def lm_scores(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None) -> DataFrame:
    """Score every text by models learnt from those whose key's crc32 is not ``HOLD_REST`` modulo ``HOLD_MODULUS``.

    Returns one row per input row: ``key`` (an integer), ``held_out``,
    ``n_tokens`` (words and the end), ``n_known`` (of them, those in the
    training texts), ``train_tokens``, ``base_score`` (add-one word model,
    log10), ``score`` and ``attention_score`` (log10).

    A null text is the empty one: its only token is the end.  A null key
    counts as the empty text for the hold-out.  Rows that repeat a key count
    and are scored one by one.  Without training texts nothing is known, and
    the attention model is untrained.  An empty table gives an empty result.
    Other columns play no part.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "lm")
    path = tokenizer or default_path()
    parts = parts_for(docs, text)
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % HOLD_MODULUS == HOLD_REST
    rows = docs.select(F.col(key).cast("long").alias("id"), held.alias("held"), bytes_of(text).alias("body"))
    with settings(spark, FEW_TEXTS):
        read = stage.save(rows.mapInArrow(_read(path, parts), ROWS), "read", by=("kind",), options=PAGES)
    texts = read.where(F.col("kind") == TEXTS)

    added = read.where(F.col("kind") == WORDS).select("block", "part", "a", "b").groupBy("part").applyInPandas(
        _add_up, "block long, part int, counts binary, v long, n long")
    added = stage.save(added, "added")
    stage.drop(f"read/kind={WORDS}")
    words = added.agg(F.sum("v").alias("v"), F.sum("n").alias("n")).first()
    learnt = texts.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    total, distinct = (words["n"] or 0) + learnt, (words["v"] or 0) + (learnt > 0)

    tables, weights = fit(stage, texts, read.where(F.col("kind") == CELLS))
    stage.drop(f"read/kind={CELLS}")
    shared = spark.sparkContext.broadcast((tables, weights, word_ends(path), stage.root))
    counts = added.groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("parts"))
    scored = texts.select("block", "keys", "held", "a", "b", "c", "d").join(counts, "block", "left") \
        .select("keys", "held", "a", "b", "c", "d", "parts").mapInArrow(_score(shared, total, distinct, learnt), OUT)
    with settings(spark, AT_ONCE):
        scored = stage.save(scored, "scored")
    stage.drop("read")
    stage.drop("added")
    return scored.select(F.col("id").alias(key), "held_out", "n_tokens", "n_known",
                         F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "attention_score")


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
