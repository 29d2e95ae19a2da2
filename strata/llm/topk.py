"""Exact top-k inner-product search by a three-phase uniform threshold.

A score is the sum of ``LISTS`` partial scores, one per slice of the
dimensions.

1. Every block of vectors gathers, per query and slice, its ``k`` best partial
   scores; the vectors on those lists get their whole score.  The k-th best of
   them is a safe cutoff: the answer cannot score less.
2. The cutoff goes out with the query to every block.  A vector that reaches
   it has at least one partial score of cutoff / ``LISTS`` or more, so only
   entries at or above that uniform threshold are collected.
3. The collected vectors' remaining partial scores are added, and the best
   ``k`` of each block are merged.

Scale: vectors and queries are packed into blocks of bounded size, and a block
of queries meets a block of vectors as one row, so the work is a matrix
product per row and no pair of single vectors is ever shuffled.  A block hands
on at most k entries per query.  Arithmetic is exact: in doubles while all sums
stay below 2**53, else in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Stage, query, table

K, LISTS = 5, 2
VECTOR_BLOCK, QUERY_BLOCK = 4096, 512
SCALE = 256
_LONG = np.iinfo(np.int64)


def vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v) of the usable vectors: no null, no NaN, no infinity, scaled or not; of rows that repeat a key the greatest."""
    v = F.col(vector).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & usable) \
        .groupBy("id").agg(F.max("v").alias("v"))


def blocks(vecs: DataFrame, size: int, scale: int) -> tuple[DataFrame, int]:
    """Pack into rows (block, ids, dim, data) of about ``size`` vectors; and the number of blocks."""
    n = max(1, -(-vecs.count() // size))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        dim = max(len(v) for v in pdf["v"])
        data = np.zeros((len(pdf), dim))
        for row, v in zip(data, pdf["v"]):
            row[:len(v)] = np.floor(scale * np.asarray(v, np.float64))
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "dim": [dim], "data": [data.tobytes()]})

    dealt = vecs.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    return dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, dim int, data binary"), n


def _load(ids: bytes, dim: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(data, np.float64).reshape(len(i), dim)


def partial_scores(q: np.ndarray, v: np.ndarray, lists: int) -> list[np.ndarray]:
    """Score matrices (queries x vectors) of each slice of the dimensions; missing components are 0."""
    dim = min(q.shape[1], v.shape[1])
    q, v = q[:, :dim], v[:, :dim]
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(dim, 1)
    if top >= 2.0 ** 53:
        q, v = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (q, v))
    return [q[:, i::lists] @ v[:, i::lists].T if dim else np.zeros((len(q), len(v))) for i in range(lists)]


def best(rows: np.ndarray, cols: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of each row, ties to the smaller id."""
    order = np.lexsort((ids[cols], -score.astype(np.float64) if score.dtype != object else -score, rows))
    r = rows[order]
    start = np.concatenate([[True], r[1:] != r[:-1]])
    place = np.arange(len(r)) - np.maximum.accumulate(np.where(start, np.arange(len(r)), 0))
    return order[place < k]


def _search(k: int, lists: int, with_cutoff: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qid, q = _load(row["q_ids"], row["q_dim"], row["q_data"])
                vid, v = _load(row["ids"], row["dim"], row["data"])
                parts = partial_scores(q, v, lists)
                own = qid[:, None] == vid[None, :]
                if with_cutoff:
                    known = dict(zip(row["cut_ids"] or [], row["cuts"] or []))
                    cut = [known.get(int(i)) for i in qid]
                    low = np.array([_LONG.min if c is None else c for c in cut], object if parts[0].dtype == object else np.float64)
                    take = np.zeros(own.shape, bool)
                    for p in parts:
                        take |= (p * lists >= low[:, None]).astype(bool)
                    take |= np.array([c is None for c in cut])[:, None]
                else:
                    take = np.zeros(own.shape, bool)
                    n = min(k + 1, len(vid))  # one more, as the query itself may be on its list
                    for p in parts:
                        at = np.argpartition(-p.astype(np.float64), n - 1, axis=1)[:, :n]
                        np.put_along_axis(take, at, True, axis=1)
                rows, cols = np.nonzero(take & ~own)
                total = sum(p[rows, cols] for p in parts)
                if total.dtype == object:
                    total = np.array([min(max(s, _LONG.min), _LONG.max) for s in total], object)
                if with_cutoff:
                    reach = (total >= low[rows]).astype(bool)
                    rows, cols, total = rows[reach], cols[reach], total[reach]
                pick = best(rows, cols, total, vid, k)
                score = [int(s) for s in total[pick]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(qid[rows[pick]]), pa.array(vid[cols[pick]]), pa.array(score, pa.int64())],
                    names=["query_id", "vec_id", "score"])

    return run


def top_k(df: DataFrame, queries: Column, k: int = K, key: str = "vec_id", vector: str = "embedding",
          lists: int = LISTS, scale: int = SCALE) -> DataFrame:
    """Each query's k highest inner products: query_id, rank (from 1), vec_id, score.

    ``queries`` is a condition on the column ``id`` (the key).  Components x
    count as floor(scale * x).  Every usable vector but the query's own is a
    candidate; ties go to the smaller key; a query with fewer candidates gets
    all of them.  Vectors that are null or hold a component that is null or not
    finite (or not once scaled), and null keys, take no part; rows that repeat a key count once,
    as the greatest vector; a shorter vector's missing components count 0;
    sums beyond a long count as its bounds.  An empty table, or one without queries, gives an
    empty result.  Other columns play no part.
    """
    stage = Stage(df.sparkSession, "topk")
    vecs = stage.save(vectors(df, key, vector, scale), "vectors")
    v, n = blocks(vecs, VECTOR_BLOCK, scale)
    v = stage.save(v, "vector_blocks")
    q, q_blocks = blocks(vecs.where(queries), QUERY_BLOCK, scale)
    q = stage.save(q.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
                            F.col("dim").alias("q_dim"), F.col("data").alias("q_data")), "query_blocks")

    def meet(side: DataFrame) -> DataFrame:
        return side.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(v.hint("merge"), "block")

    entry = "query_id long, vec_id long, score long"
    cols = ["q_ids", "q_dim", "q_data", "ids", "dim", "data"]
    lists1 = meet(q).select(*cols).mapInArrow(_search(k, lists, False), entry)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cut = lists1.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k) \
        .where(F.col("rank") == k).select("query_id", F.col("score").alias("cut"))
    cut = cut.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))
    cut = stage.save(cut, "cutoffs")
    ids = cut.groupBy("q_block").agg(F.collect_list(F.struct("query_id", "cut")).alias("c")).select(
        "q_block", F.col("c.query_id").alias("cut_ids"), F.col("c.cut").alias("cuts"))
    found = meet(q.join(ids, "q_block", "left")).select(*cols, "cut_ids", "cuts") \
        .mapInArrow(_search(k, lists, True), entry)
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query("op1_topk_search", SQL)
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)
