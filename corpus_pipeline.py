"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir), works
on all rows its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``; all but the last return the
columns of ``documents``.  Rows are told apart by their place in ``docs``, not
by ``doc_id``, so null and repeated ids go through unharmed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact_dedup, minhash, mixing, packing, quality
from strata.llm.common import Stage, table

ROW = "pipeline_row"
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (probability of a good text below the threshold)."""
    labels = table(spark, sf_dir, "labels").where(~quality.held_out()).select("doc_id", "quality")
    model = quality.train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    scored = quality.score(docs, model, name="pipeline_score", carry=tuple(docs.columns))
    return scored.where(F.col("pipeline_score") >= quality.THRESHOLD).drop("pipeline_score")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one document stays."""
    rows = _numbered(docs)
    kept = exact_dedup.exact_dedup(rows, carry=(ROW,)).where("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").drop(ROW)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, one document stays."""
    rows = _numbered(docs)
    kept = minhash.near_duplicates(rows, key=ROW, shingle=SHINGLE_WORDS, percent=SIMILAR_PERCENT) \
        .where("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").drop(ROW)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents repeat, or go, as the mix takes them."""
    rows = _numbered(docs)
    sized = rows.select("doc_id", "source", ROW, mixing.word_count("text").alias("words"))
    sized = mixing.label_quality(sized, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    mix = mixing.mix(sized, size="words", quality="quality_weight", carry=(ROW,))
    taken = mix.where("copies > 0").select(ROW, F.explode(F.sequence(F.lit(1), "copies")).alias("pipeline_copy"))
    return rows.join(taken, ROW).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of fixed length."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_filter), ("exact dedup", exact), ("near dedup", near),
          ("source mixing", mixed), ("packing", packed)]

ORACLE_SQL = None  # the classifier and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a staged table."""
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = stage.save(step(spark, docs, sf_dir), f"stage{i}")
    return docs
