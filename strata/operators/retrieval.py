"""Vector retrieval and its evaluation (V1-V9).

Scores are exact brute force.  Queries are packed into blocks of bounded
size; ``row_number() <= k`` per query lets Spark insert a partial
``WindowGroupLimit`` before the shuffle, so each partition ships at most k
rows per query and no (query, document) pair is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import preview
from .profiling import table_quantiles

QUERY_BLOCK = 512
METRICS = ("l2", "cosine", "ip")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit(v) -> Column:
    """V3: unit normalisation of a vector (array of numbers) as doubles."""
    v = F.transform(_c(v), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(v, lambda x: x / norm)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def score(doc_vec, query_vec, metric: str = "l2") -> Column:
    """Distance / similarity between unit vectors: ``l2`` squared euclidean
    (smaller is better, the vector store's default), ``cosine`` distance
    (1 - cos), or ``ip`` inner product (larger is better)."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    d = dot(doc_vec, query_vec)
    if metric == "ip":
        return d
    if metric == "cosine":
        return F.lit(1.0) - d
    diff = F.zip_with(_c(doc_vec), _c(query_vec), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diff, F.lit(0.0), lambda acc, x: acc + x)


def metadata_filter(spec: Mapping, schema: T.StructType | None = None) -> Column:
    """V4: a structured filter (``$eq $ne $gt $gte $lt $lte $in $nin $and
    $or``) -> predicate; attribute names are checked against ``schema``."""
    ops = {"$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v, "$gt": lambda c, v: c > v,
           "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
           "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~c.isin(list(v))}
    names = set(schema.fieldNames()) if schema is not None else None

    def build(node) -> Column:
        if not isinstance(node, Mapping) or not node:
            raise ValueError(f"invalid filter {node!r}")
        parts = []
        for k, v in node.items():
            if k in ("$and", "$or"):
                subs = [build(x) for x in v]
                acc = subs[0]
                for s in subs[1:]:
                    acc = (acc & s) if k == "$and" else (acc | s)
                parts.append(acc)
                continue
            if names is not None and k not in names:
                raise ValueError(f"unknown filter attribute {k!r}")
            col = F.col(k)
            if isinstance(v, Mapping):
                for op, val in v.items():
                    if op not in ops:
                        raise ValueError(f"unknown operator {op!r}")
                    parts.append(ops[op](col, val))
            else:
                parts.append(col == v)
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out

    return F.coalesce(build(spec), F.lit(False))


def batch_topk(docs: DataFrame, queries: DataFrame, k: int = 5, metric: str = "l2", doc_id: str = "doc_id",
               doc_vec: str = "vec", query_id: str = "query_id", query_vec: str = "qvec",
               where: Column | None = None, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Top-k documents per query: (query_id, rank (1-based), doc_id, score).
    Ties go to the smaller document id; without queries the result is empty.

    Queries of any number are packed into blocks of about ``query_block``, and
    every document meets every block (a stated query set against all rows).  The
    ``row_number() <= k`` filter is planned as a partial ``WindowGroupLimit``
    before the shuffle (at most k rows per query per partition move).
    """
    blocks = max(1, -(-queries.count() // query_block))
    qs = (queries.select(F.struct(F.col(query_id).alias("_q"), unit(query_vec).alias("_qv")).alias("_query"))
          .groupBy(F.pmod(F.xxhash64("_query._q"), F.lit(blocks)).cast("int").alias("_block"))
          .agg(F.collect_list("_query").alias("_queries")))
    d = docs if where is None else docs.where(where)
    extra = [c for c in d.columns if c not in (doc_id, doc_vec)]
    d = d.select(F.col(doc_id).alias("_doc"), unit(doc_vec).alias("_dv"), *extra,
                 F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    s = d.join(qs, "_block").select("_doc", "_dv", *extra, F.inline("_queries")).withColumn("score", score("_dv", "_qv", metric))
    order = F.col("score").desc() if metric == "ip" else F.col("score").asc()
    w = Window.partitionBy("_q").orderBy(order, F.col("_doc").asc())
    ranked = s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("_q").alias(query_id), "rank", F.col("_doc").alias(doc_id), "score", *extra)


def vector_topk(docs: DataFrame, query_vec: Sequence[float], k: int = 5, where: Column | None = None,
                with_scores: bool = False, metric: str = "l2", doc_id: str = "doc_id", doc_vec: str = "vec") -> DataFrame:
    """V1: top-k for one query vector (a literal: fixed size); optional
    metadata predicate applied before scoring; a per-partition top-k then one
    merge (``TakeOrderedAndProject``)."""
    qv = F.array(*[F.lit(float(x)) for x in query_vec])
    d = docs if where is None else docs.where(where)
    s = d.withColumn("score", score(unit(doc_vec), unit(qv), metric))
    order = F.col("score").desc() if metric == "ip" else F.col("score").asc()
    out = s.orderBy(order, F.col(doc_id).asc()).limit(k)
    return out if with_scores else out.drop("score")


def centroids(docs: DataFrame, group: str, vec: str) -> DataFrame:
    """Per-group mean vector (element-wise), partially aggregated per
    (group, dimension) and re-assembled in dimension order."""
    e = docs.select(group, F.posexplode(vec).alias("_d", "_x"))
    per = e.groupBy(group, "_d").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    g = per.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_d", "_m"))).alias("_v"))
    return g.select(group, F.transform("_v", lambda s: s["_m"]).alias("centroid"))


def append_documents(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """V5: add documents whose key is not yet in the collection."""
    return existing.unionByName(new.join(existing.select(key), on=key, how="left_anti"))


def collection_stats(coll: DataFrame, vec: str, key: str) -> DataFrame:
    """V5: number of documents, distinct keys and vector dimension range."""
    return coll.agg(F.count(F.lit(1)).alias("n_documents"), F.count_distinct(key).alias("n_ids"),
                    F.min(F.size(vec)).alias("min_dim"), F.max(F.size(vec)).alias("max_dim"))


def retrieval_detail(hits: DataFrame, texts: DataFrame, doc_id: str, text: str, query_id: str,
                     filter_text: Column | str = "No filter", extra: Sequence[str] = ()) -> DataFrame:
    """V8: one row per retrieved document with rank, score, filter text and a
    200-character preview; hits without a text keep a null preview."""
    t = texts.select(F.col(doc_id), F.col(text).alias("_text"))
    j = hits.join(t, on=doc_id, how="left")
    ft = F.lit(filter_text) if isinstance(filter_text, str) else filter_text
    return j.select(query_id, "rank", doc_id, "score", ft.alias("metadata_filter"),
                    preview("_text").alias("content_preview"), *extra)


def split_queries(queries: DataFrame, vec: str = "qvec", dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Queries that can be answered, and those that cannot, with their ``error``.

    A query fails on its own, not its batch: a vector that is missing, empty,
    of another dimension (where ``dim`` is given) or that holds a missing or
    non-finite number.
    """
    v = F.col(vec).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    error = F.when(v.isNull(), F.lit("no vector")).when(F.size(v) == 0, F.lit("empty vector"))
    if dim is not None:
        error = error.when(F.size(v) != dim, F.concat(F.lit("vector of "), F.size(v).cast("string"), F.lit(f" numbers, not {dim}")))
    marked = queries.withColumn("error", error.when(bad, F.lit("vector with a missing or non-finite number")))
    return marked.where("error IS NULL").drop("error"), marked.where("error IS NOT NULL")


def with_failures(detail: DataFrame, failed: DataFrame, query_id: str, doc_id: str) -> DataFrame:
    """V8: the detail table with one row for every failed query: rank 0, ``ERROR`` as document and filter, no
    score, the error in the preview and in ``error`` (null on other rows)."""
    ok = detail.withColumns({doc_id: F.col(doc_id).cast("string"), "error": F.lit(None).cast("string")})
    said = {query_id: F.col(query_id), "rank": F.lit(0), doc_id: F.lit("ERROR"), "metadata_filter": F.lit("ERROR"),
            "content_preview": F.concat(F.lit("Error: "), F.col("error")), "error": F.col("error")}
    rows = failed.select(*[said.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ok.schema.fields])
    return ok.unionByName(rows)


def attach_scores(detail: DataFrame, scores: DataFrame, query_id: str, score_col: str) -> DataFrame:
    """V7: question-level score on every retrieved row (null if none)."""
    return detail.join(scores.select(query_id, score_col), on=query_id, how="left")


def retrieval_metrics(detail: DataFrame, query_id: str, doc_id: str, group_col: str,
                      score_col: str = "score", relevance_col: str | None = None) -> DataFrame:
    """V6: totals, success rate, score statistics, per-question counts,
    diversity and filter usage in one aggregate, and the exact median."""
    ok = F.col(doc_id).cast("string") != "ERROR"
    aggs = [F.count(F.lit(1)).alias("total_retrievals"), F.count_if(ok).alias("successful_retrievals"),
            F.count_if(~ok).alias("failed_retrievals"),
            (F.count_if(ok) / F.count(F.lit(1))).alias("success_rate"),
            F.count(F.when(ok, F.col(score_col))).alias("score_count"),
            F.avg(F.when(ok, F.col(score_col))).alias("score_mean"),
            F.min(F.when(ok, F.col(score_col))).alias("score_min"),
            F.max(F.when(ok, F.col(score_col))).alias("score_max"),
            F.count_distinct(F.when(ok, F.col(group_col))).alias("unique_groups"),
            F.count_if(ok & ~F.col("metadata_filter").isin("No filter", "ERROR")).alias("with_filters")]
    if relevance_col:
        aggs.append(F.avg(F.when(ok, F.col(relevance_col))).alias("relevance_mean"))
    # questions with results, and their mean number of documents, from the same pass
    n_q = F.count_distinct(F.when(ok, F.col(query_id)))
    aggs += [n_q.alias("total_questions"), F.try_divide(F.count_if(ok), n_q).cast("double").alias("avg_docs_per_question")]
    # the median from ranks: no task holds all scores
    median = table_quantiles(detail.where(ok).select(score_col), [score_col], {"score_median": 0.5}).select("score_median")
    one = F.lit(1).alias("_one")
    return detail.agg(*aggs).select("*", one).join(median.select("*", one), "_one", "left").drop("_one")


def contexts_per_question(detail: DataFrame, query_id: str, doc_id: str, text_col: str = "content_preview") -> DataFrame:
    """V9: the previews of each question in rank order (errors excluded);
    bounded by k per question."""
    ok = detail.where(F.col(doc_id).cast("string") != "ERROR")
    g = ok.groupBy(query_id).agg(F.array_sort(F.collect_list(F.struct("rank", F.col(text_col).alias("t")))).alias("_c"))
    return g.select(query_id, F.transform("_c", lambda s: s["t"]).alias("contexts"))
