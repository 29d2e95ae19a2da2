"""Exact dedup by distributed MSD radix partitioning.

A text is a string of bytes; its digits are runs of successive bytes.  Every
round splits each group by the next digit.  A group that becomes a singleton
leaves, and a group whose text has ended holds equal texts.  Equality is the
equality of the bytes themselves; no digest decides it.  The digits widen
eightfold from round to round, so the rounds grow with the logarithm of the
longest text.

Scale: a round's group sizes are a hash aggregate with map-side combine, so a
group of a third of all rows reaches the reducers as one row per task.  Only
groups of two or more are written and joined back, always by a merge join: both
of its sides are plain exchanges, which AQE splits where a group is hot.  Rows that are done give up
their bytes, so later rounds move only texts that still share a prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stage, bytes_of, query, table

FIRST_DIGIT = 64
WIDEN = 8


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id",
                carry: tuple[str, ...] = (), first_digit: int = FIRST_DIGIT) -> DataFrame:
    """Group equal texts; of each group the row with the largest key stays.

    Returns one row per input row: ``key``, the ``carry`` columns, ``keep_id``
    (key of the row that stays), ``group_size`` and ``kept``.

    A null text equals the empty text.  A null key sorts below every other.
    Rows that repeat key and text form a group in which exactly one row stays.
    An empty table gives an empty result.  Other columns, whatever their
    names, play no part.  ``docs`` must be re-readable (a table, not the
    output of an unstable computation), as its rows are numbered by position.
    """
    if not docs.columns:
        raise ValueError("no columns")
    spark = docs.sparkSession
    stage = Stage(spark, "radix")
    rows = docs.select(
        F.struct(F.col(key).alias("id"), *[F.col(c).alias(f"carry_{c}") for c in carry]).alias("row"),
        F.monotonically_increasing_id().alias("rid"),
        F.lit(-1).cast("long").alias("gid"), bytes_of(text).alias("rest"))
    width, level, done = first_digit, 0, []
    while True:
        digit = F.substring("rest", 1, width)
        groups = (rows.select("gid", digit.alias("digit"),
                              F.struct(F.col("row.id").alias("id"), "rid").alias("who"))
                  .groupBy("gid", "digit")
                  .agg(F.count("*").alias("n"), F.max("who").alias("top"))
                  .where("n > 1"))
        groups = stage.save(groups, f"groups{level}")
        ended = F.length("digit") < width
        split = (rows.withColumn("digit", digit).join(groups.hint("merge"), ["gid", "digit"], "left")
                 .select("row", "rid", "n", "top", F.col("top.rid").alias("gid"),
                         F.when(F.col("n").isNotNull() & ~ended,
                                F.expr(f"substring(rest, {width + 1})")).alias("rest")))
        split = stage.save(split, f"rows{level}")
        done.append(split.where("rest IS NULL").select("row", "rid", "n", "top"))
        rows = split.where("rest IS NOT NULL").select("row", "rid", "gid", "rest")
        stage.drop(f"groups{level}")
        if rows.isEmpty():
            break
        width *= WIDEN
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out.select(
        F.col("row.id").alias(key), *[F.col(f"row.carry_{c}").alias(c) for c in carry],
        F.when(F.col("n").isNull(), F.col("row.id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | (F.col("rid") == F.col("top.rid"))).alias("kept"))


SQL = """
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST)
"""


@query("op7_exact_dedup", SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2(bytes_of("text"), 256).alias("text_sha256"))
    return exact_dedup(docs, carry=("text_sha256",))
