"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target of words: its weight's share of the budget, at most
``max_epochs`` times its size, the excess going to the others by weight.  A
source is read in whole epochs first; the fraction left is a weighted sample
without replacement: each document draws the exponential key ``-ln(u) / w``
(``u`` from a hash of its id, ``w`` its quality weight), and documents are
taken in key order while their running sum of words meets the rest of the
target (the document at the boundary if that comes nearer to it).

Scale: the running sum is never taken over a whole source.  Keys fall into
``FAN`` ordered bins whose sums are map-side aggregates; the bin that the
budget ends in is split again, and only that sub-bin's rows are sorted.  The
tables that meet in one place have one row per source, or ``FAN`` per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Stage, query, table, words_sql

FAN = 1024
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
# Quality weights of documents that labels mark 1, mark 0, or do not mark.
GOOD, POOR, UNMARKED = 2.0, 0.5, 1.0


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")


def hash_unit(key: Column) -> Column:
    """A number in (0, 1) from the md5 of a key (52 bits); null counts as the empty text."""
    hexes = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(hexes, 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(2.0 ** 52)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of (no_source, src, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights``, repeating.  With
    caps, the reshared targets are min(level * weight, cap) for one level: the
    sources at their cap are those of least cap per weight, so one ordered pass
    over the sources finds it.
    """
    by_name = Window.orderBy("no_source", "src")
    ws = F.array(*[F.lit(float(w)) for w in weights])
    t = (sizes.withColumn("weight", F.get(ws, (F.row_number().over(by_name) - 1) % len(weights)))
         .withColumn("cap", F.col("source_size").cast("double") * max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "src")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("left", F.sum("source_size").over(every).cast("double") * share
                      - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(every)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", F.col("left") / F.col("open")))
    # the first source that its level leaves below its cap sets the level of all the rest
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    t = (t.withColumn("set", F.first(F.when(fits, F.col("level")), ignorenulls=True)
                      .over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return t.withColumn("target", F.when(F.col("set").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("set") * F.col("weight"), F.col("cap")))) \
            .select("no_source", "src", "source_size", "target")


def mix(docs: DataFrame, size: str, source: str = "source", key: str = "doc_id",
        quality: str | None = None, carry: tuple[str, ...] = (), weights=WEIGHTS,
        share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """How often each document enters the mix.

    Returns one row per input row: ``key``, the ``carry`` columns, ``size``,
    ``source_size``, ``target`` (both of its source), ``copies`` (0 to
    ``max_epochs``) and ``taken`` (= size * copies).

    ``size`` and ``quality`` (weight above 0; null or otherwise: 1) name input columns.  A
    null source is a source of its own; a null size counts 0, and a document
    of size 0 is taken with its neighbours in key order, at no cost.  Ties in
    the exponential key go by ``key`` (null first); rows that repeat a key
    (and quality) stand or fall together.  An empty table gives an empty
    result; where all sizes are 0, nothing is taken.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "mix")
    w = F.col(quality).cast("double") if quality else F.lit(1.0)
    rows = docs.select(
        F.struct(F.col(key).alias("id"), *[F.col(c).alias(f"carry_{c}") for c in carry]).alias("row"),
        F.col(source).isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("src"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"),
        F.when(w > 0, w).otherwise(1.0).alias("w"))
    rows = rows.withColumn("ekey", -F.log(hash_unit(F.col("row.id"))) / F.col("w"))
    # 1 - exp(-key) rises with the key and spreads unit-weight keys evenly
    place = (1 - F.exp(-F.col("ekey"))) * FAN
    rows = rows.withColumn("bin", F.least(F.floor(place), F.lit(FAN - 1)).cast("int"))
    rows = rows.withColumn("sub", F.least(F.floor((place - F.col("bin")) * FAN), F.lit(FAN - 1)).cast("int"))
    rows = stage.save(rows, "rows")

    src = ["no_source", "src"]
    bins = stage.save(rows.groupBy(*src, "bin").agg(F.sum("size").alias("words")), "bins")
    goal = targets(bins.groupBy(*src).agg(F.sum("words").alias("source_size")), weights, share, max_epochs)
    goal = (goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
                F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    goal = stage.save(goal, "goal")

    def ending(parts: DataFrame, by: str, left: DataFrame) -> DataFrame:
        """The part of each source in which its ``rest`` ends, with the rest that is left there."""
        order = Window.partitionBy(*src).orderBy(by)
        run = parts.withColumn("upto", F.sum("words").over(order))
        run = run.join(left, src).where((F.col("rest") > 0) & (F.col("upto") > F.col("rest")))
        first = run.groupBy(*src).agg(F.min(F.struct(by, "upto", "words", "rest")).alias("f"))
        return first.select(*src, F.col(f"f.{by}").alias(by),
                            (F.col("f.rest") - F.col("f.upto") + F.col("f.words")).alias("rest"))

    at = stage.save(ending(bins, "bin", goal.select(*src, "rest")), "at")
    inner = rows.join(F.broadcast(at) if _small(at) else at, [*src, "bin"])
    subs = inner.groupBy(*src, "bin", "sub").agg(F.sum("size").alias("words"))
    at = stage.save(ending(subs, "sub", at.select(*src, "rest"))
                    .join(at.select(*src, "bin"), src), "at_sub")
    last = rows.join(F.broadcast(at) if _small(at) else at, [*src, "bin", "sub"])
    order = Window.partitionBy(*src).orderBy("ekey", "row.id")
    # the middle of a document lies before the end of the rest: taking it comes nearer
    near = last.withColumn("upto", F.sum("size").over(order)).where(
        F.col("upto") - F.col("size") / 2 <= F.col("rest"))
    cut = near.groupBy(*src).agg(F.max(F.struct("ekey", F.col("row.id").alias("id"))).alias("cut"))
    goal = goal.join(at.select(*src, "bin", "sub"), src, "left").join(cut, src, "left")
    goal = stage.save(goal.select(*src, "source_size", "target", "epochs",
                                  F.col("bin").alias("bin_at"), F.col("sub").alias("sub_at"), "cut"), "cuts")

    place = F.struct("bin", "sub")
    edge = F.struct(F.col("bin_at").alias("bin"), F.col("sub_at").alias("sub"))
    within = F.when(F.col("bin_at").isNull(), F.lit(False)).otherwise(
        (place < edge) | ((place == edge) & F.coalesce(
            F.struct("ekey", F.col("row.id").alias("id")) <= F.col("cut"), F.lit(False))))
    out = rows.join(F.broadcast(goal) if _small(goal) else goal, src)
    out = out.withColumn("copies", F.col("epochs") + within.cast("int"))
    return out.select(F.col("row.id").alias(key), *[F.col(f"row.carry_{c}").alias(c) for c in carry],
                      "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def _small(df: DataFrame, limit: int = 10_000) -> bool:
    """True for a table of at most ``limit`` rows (one short row per source)."""
    return len(df.limit(limit + 1).select(F.lit(1)).take(limit + 1)) <= limit


def _sql() -> str:
    n = words_sql("text")
    return f"""
WITH lab AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source IS NULL AS no_source, coalesce(d.source, '') AS src, CAST({n} AS BIGINT) AS size,
        -ln((CAST(('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5) / pow(2, 52))
        / CASE l.quality WHEN 1 THEN {GOOD} WHEN 0 THEN {POOR} ELSE {UNMARKED} END AS ekey
      FROM documents d LEFT JOIN lab l ON l.doc_id = d.doc_id),
s AS (SELECT no_source, src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY no_source, src) - 1) % 3] AS DOUBLE) AS weight,
        CAST(source_size AS DOUBLE) * {MAX_EPOCHS} AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE} - coalesce(sum(cap) OVER b, 0.0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level FROM w
      WINDOW b AS (ORDER BY cap / weight, no_source, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (SELECT arg_min(x.level, (x.cap / x.weight, x.no_source, x.src)) FROM l x
        WHERE x.level * x.weight <= x.cap) AS set_level FROM l),
t AS (SELECT *, CASE WHEN (set_level IS NULL) OR set_level * weight > cap THEN cap ELSE set_level * weight END AS target FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        sum(d.size) OVER (PARTITION BY no_source, src ORDER BY d.ekey, d.doc_id NULLS FIRST) AS upto
      FROM d JOIN e USING (no_source, src))
SELECT doc_id, size, source_size, target,
  CAST(epochs + (CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END) AS INTEGER) AS copies,
  CAST(size * (epochs + (CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END)) AS BIGINT) AS taken
FROM r"""


def label_quality(docs: DataFrame, labels: DataFrame, name: str = "quality_weight") -> DataFrame:
    """Add the quality weight that ``labels`` gives each document."""
    lab = labels.groupBy("doc_id").agg(F.max("quality").alias("label"))
    weight = F.when(F.col("label") == 1, GOOD).when(F.col("label") == 0, POOR).otherwise(UNMARKED)
    return docs.join(lab, "doc_id", "left").withColumn(name, weight).drop("label")


@query("op2_source_mixing", _sql())
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    docs = label_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return mix(docs, size="size", quality="quality_weight")
