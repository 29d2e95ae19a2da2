"""Retrieval queries (V1-V9) over ``embeddings`` (vectors, ``label`` as the
metadata attribute) and ``documents`` (texts, joined on ``doc_id = vec_id``).

Query vectors are derived from the data: the centroid of each label (batch
top-k, one question per label) and the global centroid (single query).
Question-level relevance scores (V7) are the mean ``labels.quality`` of the
documents whose id falls in the question's residue class (doc_id mod 10).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval as R
from ..sources.tables import table
from .catalog import finish, r6, register

K = 5
FILTER = {"$or": [{"label": {"$lt": 3}}, {"label": {"$gte": 8}}]}
FILTER_SQL = "(label < 3 OR label >= 8)"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"),
                                                     F.col("embedding").alias("vec"), "label")


def _label_queries(spark, sf_dir):
    c = R.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return c.select(F.col("label").alias("query_id"), F.col("centroid").alias("qvec"))


# ----------------------------- SQL helpers --------------------------------- #
UNIT = "list_transform({v}, lambda x: x / sqrt(list_sum(list_transform({v}, lambda y: y * y))))"
E_SQL = """e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
eu AS (SELECT vec_id, label, """ + UNIT.format(v="v") + """ AS u FROM e)"""
CENTROIDS_SQL = """ex AS (SELECT label, unnest(generate_series(1, len(embedding))) AS d,
                   CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
cen AS (SELECT label AS query_id, list(m ORDER BY d) AS c FROM (SELECT label, d, avg(x) AS m FROM ex GROUP BY label, d)
        GROUP BY label),
q AS (SELECT query_id, """ + UNIT.format(v="c") + """ AS qu FROM cen)"""
GLOBAL_SQL = """gx AS (SELECT unnest(generate_series(1, len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS x
               FROM embeddings),
g AS (SELECT list(m ORDER BY d) AS c FROM (SELECT d, avg(x) AS m FROM gx GROUP BY d)),
gq AS (SELECT """ + UNIT.format(v="c") + """ AS qu FROM g)"""
L2 = "list_sum(list_transform(generate_series(1, len(a.u)), lambda i: (a.u[i] - b.qu[i]) * (a.u[i] - b.qu[i])))"


def _hits_sql() -> str:
    return f"""{E_SQL}, {CENTROIDS_SQL},
s AS (SELECT b.query_id, a.vec_id AS doc_id, a.label, {L2} AS score
      FROM eu a, q b),
hits AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, doc_id) AS INTEGER) AS rank,
                doc_id, score, label FROM s QUALIFY rank <= {K})"""


# --------------------------------------------------------------------------- #
@register("vector_batch_topk", sql=f"""
WITH {_hits_sql()}
SELECT query_id, rank, doc_id, {r6('score')} AS score, label FROM hits""", ops="V2, V3, W7")
def vector_batch_topk(spark, sf_dir):
    dims = table(spark, sf_dir, "embeddings").select(F.size("embedding").alias("d")).first()
    good, failed = R.split_queries(_all_queries(spark, sf_dir), "qvec", dims["d"] if dims else None)
    hits = R.batch_topk(_docs(spark, sf_dir), good, k=K)
    return finish(hits.select("query_id", "rank", "doc_id", "score", "label"))


def _global_centroid(spark, sf_dir):
    c = R.centroids(table(spark, sf_dir, "embeddings").withColumn("_all", F.lit(0)), "_all", "embedding")
    return c.select("centroid").first()["centroid"]  # one fixed-size vector


@register("vector_topk", sql=f"""
WITH {E_SQL}, {GLOBAL_SQL}
SELECT a.vec_id AS doc_id, a.label, {r6(L2)} AS score FROM eu a, gq b ORDER BY score, doc_id LIMIT {K}""",
          ops="V1 (with scores), V3")
def vector_topk(spark, sf_dir):
    qv = _global_centroid(spark, sf_dir)
    out = R.vector_topk(_docs(spark, sf_dir), qv, k=K, with_scores=True)
    return finish(out.select("doc_id", "label", "score"))


@register("vector_topk_filtered", sql=f"""
WITH {E_SQL}, {GLOBAL_SQL}
SELECT a.vec_id AS doc_id, a.label FROM eu a, gq b WHERE {FILTER_SQL.replace('label', 'a.label')}
ORDER BY {L2}, doc_id LIMIT {K}""", ops="V1 (no scores), V4 metadata filter")
def vector_topk_filtered(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    qv = _global_centroid(spark, sf_dir)
    where = R.metadata_filter(FILTER, docs.schema)
    return R.vector_topk(docs, qv, k=K, where=where, with_scores=False).select("doc_id", "label")


@register("collection_stats", sql="""
WITH coll AS (SELECT * FROM embeddings WHERE label < 5
              UNION ALL
              SELECT * FROM embeddings n WHERE label >= 3 AND vec_id NOT IN (SELECT vec_id FROM embeddings WHERE label < 5))
SELECT count(*) AS n_documents, count(DISTINCT vec_id) AS n_ids, CAST(min(len(embedding)) AS INTEGER) AS min_dim,
       CAST(max(len(embedding)) AS INTEGER) AS max_dim FROM coll""", ops="V5")
def collection_stats(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    coll = R.append_documents(e.where(F.col("label") < 5), e.where(F.col("label") >= 3), "vec_id")
    return R.collection_stats(coll, "embedding", "vec_id")


# --------------------------------------------------------------------------- #
def _detail(spark, sf_dir):
    dims = table(spark, sf_dir, "embeddings").select(F.size("embedding").alias("d")).first()
    good, failed = R.split_queries(_all_queries(spark, sf_dir), "qvec", dims["d"] if dims else None)
    hits = R.batch_topk(_docs(spark, sf_dir), good, k=K)
    docs = table(spark, sf_dir, "documents")
    det = R.retrieval_detail(hits, docs, "doc_id", "text", "query_id",
                             filter_text=F.concat(F.lit("label = "), F.col("query_id").cast("string")),
                             extra=["label"])
    lab = table(spark, sf_dir, "labels")
    scores = lab.groupBy(F.pmod("doc_id", F.lit(10)).cast("int").alias("query_id")).agg(
        F.avg(F.col("quality").cast("double")).alias("context_relevance_score"))
    det = R.attach_scores(det, scores, "query_id", "context_relevance_score")
    return R.with_failures(det, failed, "query_id", "doc_id")


def _all_queries(spark, sf_dir):
    """The label queries and, per label, copies that cannot be answered: without a vector, with an empty one, a
    shorter one, and one that holds a NaN."""
    q = _label_queries(spark, sf_dir).select("query_id", F.col("qvec").cast("array<double>").alias("qvec"))
    kind = q.schema["query_id"].dataType
    wrong = [F.lit(None).cast("array<double>"), F.array().cast("array<double>"), F.slice("qvec", 1, 3),
             F.concat(F.slice("qvec", 2, 100_000), F.array(F.lit(float("nan"))))]
    for i, v in enumerate(wrong):
        q = q.unionAll(_label_queries(spark, sf_dir).select(
            (F.col("query_id") + 100 * (i + 1)).cast(kind).alias("query_id"), v.alias("qvec")))
    return q


DETAIL_SQL = f"""{_hits_sql()},
det AS (SELECT h.query_id, h.rank, h.doc_id, h.score, h.label, 'label = ' || CAST(h.query_id AS VARCHAR) AS metadata_filter,
               CASE WHEN length(d.text) > 200 THEN substring(d.text, 1, 200) || '...' ELSE d.text END AS content_preview
        FROM hits h LEFT JOIN documents d ON d.doc_id = h.doc_id),
qs AS (SELECT CAST(doc_id % 10 AS INTEGER) AS query_id, avg(CAST(quality AS DOUBLE)) AS context_relevance_score
       FROM labels GROUP BY ALL),
fine AS (SELECT det.*, qs.context_relevance_score FROM det LEFT JOIN qs USING (query_id)),
dims AS (SELECT any_value(len(embedding)) AS d FROM embeddings),
failed AS (SELECT DISTINCT CAST(h.query_id + 100 * f.i AS INTEGER) AS query_id,
             CASE f.i WHEN 1 THEN 'no vector' WHEN 2 THEN 'empty vector' WHEN 3 THEN 'vector of 3 numbers, not ' || d
               ELSE 'vector with a missing or non-finite number' END AS error
           FROM hits h, range(1, 5) f(i), dims),
detail AS (SELECT query_id, rank, CAST(doc_id AS VARCHAR) AS doc_id, score, label, metadata_filter, content_preview,
             context_relevance_score, CAST(NULL AS VARCHAR) AS error FROM fine
           UNION ALL SELECT query_id, 0, 'ERROR', NULL, NULL, 'ERROR', 'Error: ' || error, NULL, error FROM failed)"""


@register("retrieval_detail", sql=f"""
WITH {DETAIL_SQL}
SELECT query_id, rank, doc_id, {r6('score')} AS score, metadata_filter, content_preview, label,
       {r6('context_relevance_score')} AS context_relevance_score, error FROM detail""", ops="V7, V8, X23")
def retrieval_detail(spark, sf_dir):
    return finish(_detail(spark, sf_dir).select("query_id", "rank", "doc_id", "score", "metadata_filter",
                                                 "content_preview", "label", "context_relevance_score", "error"))


@register("retrieval_metrics", sql=f"""
WITH {DETAIL_SQL},
m AS (SELECT count(*) AS total_retrievals, CAST(count_if(error IS NULL) AS BIGINT) AS successful_retrievals,
             CAST(count_if(error IS NOT NULL) AS BIGINT) AS failed_retrievals,
             {r6('1.0 * count_if(error IS NULL) / count(*)')} AS success_rate, count(score) AS score_count,
             {r6('avg(score)')} AS score_mean, {r6('quantile_cont(score, 0.5)')} AS score_median,
             {r6('min(score)')} AS score_min, {r6('max(score)')} AS score_max,
             count(DISTINCT label) AS unique_groups, CAST(count_if(error IS NULL) AS BIGINT) AS with_filters,
             {r6('avg(context_relevance_score)')} AS relevance_mean FROM detail),
qq AS (SELECT count(*) AS total_questions, {r6('avg(n)')} AS avg_docs_per_question
      FROM (SELECT query_id, count(*) AS n FROM detail WHERE error IS NULL GROUP BY query_id))
SELECT * FROM m, qq""", ops="V6")
def retrieval_metrics(spark, sf_dir):
    det = _detail(spark, sf_dir)
    return finish(R.retrieval_metrics(det, "query_id", "doc_id", "label", relevance_col="context_relevance_score"))


@register("retrieval_contexts", sql=f"""
WITH {DETAIL_SQL}
SELECT query_id, CAST(count(*) AS INTEGER) AS n_contexts,
       string_agg(coalesce(content_preview, ''), '\n---\n' ORDER BY rank) AS contexts
FROM detail WHERE error IS NULL GROUP BY query_id""", ops="V9")
def retrieval_contexts(spark, sf_dir):
    ctx = R.contexts_per_question(_detail(spark, sf_dir), "query_id", "doc_id")
    return ctx.select("query_id", F.size("contexts").alias("n_contexts"),
                      F.array_join(F.transform("contexts", lambda t: F.coalesce(t, F.lit(""))), "\n---\n")
                      .alias("contexts"))
