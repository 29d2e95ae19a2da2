"""Run summaries and table / JSON profiling."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def status_summary(log: DataFrame, status: str = "status", seconds: str = "seconds") -> DataFrame:
    """One row of counters over a run log with statuses
    'sampled' / 'copied' (succeeded), 'skipped' and 'failed'."""
    s = F.col(status)
    ok = s.isin("sampled", "copied")
    return log.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("succeeded"),
        F.count_if(s == "skipped").alias("skipped"), F.count_if(s == "failed").alias("failed"),
        F.count_if(s == "sampled").alias("sampled"), F.count_if(s == "copied").alias("copied"),
        F.avg(seconds).alias("avg_seconds"),
        (F.lit(100.0) * F.count_if(ok) / F.count(F.lit(1))).alias("success_rate"))


NUMBERS = ("integer", "long", "double", "float", "short", "byte", "decimal")
TIMES = ("date", "timestamp", "timestamp_ntz")


def table_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q5: one row per column of any plain type: its type, n, missing, distinct
    values, min, max, mean, std (sample), zeros, least and greatest text, and
    the most frequent value (ties: the least) with its count.

    Numbers fill ``min`` to ``zeros`` and ``top_number``; texts and times (as
    ``yyyy-MM-dd HH:mm:ss``) fill ``min_text``, ``max_text`` and ``top_text``.
    The table is unpivoted to (column, value) and aggregated twice, first per
    value with map-side combine, so no column's values meet in one task and the
    data is not expanded once per distinct count.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields if columns is None or f.name in columns}
    kinds = {c: k for c, k in kinds.items() if k in (*NUMBERS, *TIMES, "string", "boolean")}
    none, empty = F.lit(None).cast("double"), F.lit(None).cast("string")

    def text(c: str, kind: str):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind in TIMES else F.col(c).cast("string")

    # a value's key is its column's number and one of three: seconds stand for a timestamp's text until values
    # are few (in other zones than UTC two of them may have one text)
    utc = df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC")
    seconds = [c for c, k in kinds.items() if utc and k in ("timestamp", "timestamp_ntz")]
    cells = F.array(*[F.struct(
        F.lit(i).alias("i"), (F.col(c).cast("double") if k in NUMBERS else none).alias("num"),
        (empty if k in NUMBERS or c in seconds else text(c, k)).alias("txt"),
        (F.unix_seconds(F.col(c).cast("timestamp")) if c in seconds else F.lit(None).cast("long")).alias("sec")) for i, (c, k) in enumerate(kinds.items())])
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit("number" if k in NUMBERS else "time" if k in TIMES else "text")
                               .alias("type")) for c, k in kinds.items()])
    values = df.select(F.inline(cells)).groupBy("i", "num", "txt", "sec").agg(F.count(F.lit(1)).alias("c")).select(
        F.get(named, F.col("i")).alias("_n"), "num", "c",
        F.coalesce("txt", F.date_format(F.timestamp_seconds("sec"), "yyyy-MM-dd HH:mm:ss")).alias("txt")) \
        .select("_n.column_name", "_n.type", "num", "txt", "c")
    there = F.col("num").isNotNull() | F.col("txt").isNotNull()
    per = values.groupBy("column_name", "type").agg(
        F.coalesce(F.sum(F.when(there, F.col("c"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~there, F.col("c"))), F.lit(0)).alias("missing"),
        F.count_if(there).alias("distinct_values"), F.min("num").alias("min"), F.max("num").alias("max"),
        F.sum(F.when(F.col("num") == 0, F.col("c"))).alias("zeros"),
        F.min("txt").alias("min_text"), F.max("txt").alias("max_text"),
        F.min(F.when(there, F.struct((-F.col("c")).alias("c"), "num", "txt"))).alias("top"))
    numbers = [c for c, k in kinds.items() if k in NUMBERS]
    # exact decimal sums: the mean does not depend on summation order
    spread = df.agg(*[x for i, c in enumerate(numbers) for x in (
        F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"),
        F.sum(F.col(c).cast("double").cast("decimal(38,10)")).cast("double").alias(f"t{i}"))] or [F.count("*")])
    spread = spread.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("std"),
                                                       F.col(f"t{i}").alias("total")) for i, c in enumerate(numbers)]))) \
        if numbers else df.sparkSession.createDataFrame([], "column_name string, std double, total double")
    return per.join(spread, "column_name", "left").select(
        "column_name", "type", "n", "missing", "distinct_values", "min", "max",
        (F.col("total") / F.nullif("n", F.lit(0))).alias("mean"), "std",
        F.when(F.col("type") == "number", F.coalesce("zeros", F.lit(0))).alias("zeros"), "min_text", "max_text",
        F.col("top.num").alias("top_number"), F.col("top.txt").alias("top_text"), (-F.col("top.c")).alias("top_count"))


# Quantiles, histograms, correlations, duplicate rows (Q5) -----------------------------------------------

QUANTILES = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
MOST_COLUMNS = 2000  # of a correlation matrix: its sums are a task's memory


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields if (columns is None or f.name in columns) and f.dataType.typeName() in NUMBERS]


def _unpivoted(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, value) of the numbers that are there (null and NaN are not)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in names])
    return df.select(F.inline(cells)).where("value IS NOT NULL AND NOT isnan(value)")


def table_quantiles(df: DataFrame, columns: Sequence[str] | None = None, probs: Mapping[str, float] = QUANTILES,
                    accuracy: int | None = None) -> DataFrame:
    """One row per numeric column: ``column_name`` and its quantiles (missing without a number).

    With ``accuracy``, each is the value of a mergeable sketch, of a rank at
    most n / accuracy off, from one aggregate over all columns.  Without, they
    are exact (interpolated linearly between ranks): distinct values are
    counted with map-side combine and their ranks summed in one range-partitioned
    pass, so neither a column nor a frequent value meets in one task.
    """
    names = numeric_columns(df, columns)
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column_name string")
    if not names:
        return every.select("column_name", *[F.lit(None).cast("double").alias(p) for p in probs])
    if accuracy is not None:
        share = [float(p) for p in probs.values()]
        real = {c: F.col(f"`{c}`").cast("double") for c in names}
        found = df.agg(*[F.percentile_approx(F.when(~F.isnan(v), v), share, accuracy).alias(f"q{i}")
                         for i, v in enumerate(real.values())])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                  *[F.get(f"q{i}", F.lit(j)).alias(p) for j, p in enumerate(probs)]) for i, c in enumerate(names)])
        return found.select(F.inline(rows))
    counted = cut_lineage(_unpivoted(df, names).groupBy("column_name", "value").agg(F.count("*").alias("c")))
    ranked = counted.repartitionByRange("column_name", "value").sortWithinPartitions("column_name", "value") \
        .withColumn("part", F.spark_partition_id())
    ranked = cut_lineage(ranked)
    # one row per (part, column): parts are few, and so are columns
    sums = ranked.groupBy("part", "column_name").agg(F.sum("c").alias("n"))
    before = sums.select("part", "column_name", F.coalesce(F.sum("n").over(
        Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("column_name")).alias("n"))
    inside = Window.partitionBy("part", "column_name").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = ranked.join(before, ["part", "column_name"]).withColumn("upto", F.col("before") + F.sum("c").over(inside))
    aggs = []
    for p, share in probs.items():
        at = (F.col("n") - 1) * F.lit(float(share))
        low = F.min(F.when(F.col("upto") > F.floor(at), F.col("value")))
        high = F.min(F.when(F.col("upto") > F.ceil(at), F.col("value")))
        part = F.max(at - F.floor(at))
        aggs.append((low + (high - low) * part).alias(p))
    return every.join(upto.groupBy("column_name").agg(*aggs), "column_name", "left")


def table_histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Counts in ``bins`` bins of equal width from a column's least to its greatest number: ``column_name``,
    ``bin`` (from 0), ``low``, ``high``, ``n``, empty bins too.  The greatest number belongs to the last
    bin; a column of one value has it in bin 0; a column without numbers has no rows.  Infinities are left out."""
    names = numeric_columns(df, columns)
    cells = _unpivoted(df, names).where(F.abs("value") < F.lit(float("inf"))) if names else \
        df.sparkSession.createDataFrame([], "column_name string, value double")
    ends = cells.groupBy("column_name").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    width = (F.col("most") - F.col("least")) / F.lit(float(bins))
    place = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col("value") - F.col("least")) / width), F.lit(bins - 1)))
    # one row per column: broadcast
    held = cells.join(F.broadcast(ends), "column_name").groupBy("column_name", place.cast("int").alias("bin")) \
        .agg(F.count("*").alias("n"))
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(held, ["column_name", "bin"], "left").select(
        "column_name", "bin", (F.col("least") + F.col("bin") * width).alias("low"),
        F.when(F.col("bin") == bins - 1, F.col("most")).otherwise(F.col("least") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"))


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson's r of every pair of numeric columns over the rows where both are there: ``column_a`` <
    ``column_b`` (in table order), ``n`` (rows), ``r`` (missing for fewer than two rows or a constant).

    One pass of matrix products: every task sums values, squares and products of
    all pairs (shifted by the columns' means, which keeps them exact enough),
    and the sums are added up by pair.
    """
    names = numeric_columns(df, columns)
    k = len(names)
    if k > MOST_COLUMNS:
        raise ValueError(f"{k} columns: the matrix of a task would not be bounded; name at most {MOST_COLUMNS}")
    spark = df.sparkSession
    if k < 2:
        return spark.createDataFrame([], "column_a string, column_b string, n long, r double")
    real = [F.col(f"`{c}`").cast("double") for c in names]
    finite = [F.when(F.abs(v) < F.lit(float("inf")), v) for v in real]  # false for NaN, too
    mean = np.array([x or 0.0 for x in df.agg(*[F.avg(v) for v in finite]).first()])
    upper = np.triu_indices(k, 1)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            x = pc.fill_null(pc.list_flatten(batch["x"]), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, k) - mean
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0]), pa.array(upper[1]), *[pa.array(t[upper]) for t in total]],
            names=["i", "j", "n", "a", "b", "aa", "bb", "ab"])

    sums = df.select(F.array(*finite).alias("x")).mapInArrow(
        gram, "i long, j long, n double, a double, b double, aa double, bb double, ab double") \
        .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    va, vb = F.col("aa") - a * a / n, F.col("bb") - b * b / n
    r = (F.col("ab") - a * b / n) / F.sqrt(va * vb)
    tiny = F.lit(1e-12)  # of the squares: what rounding leaves of a constant
    ok = (n > 1) & (va > tiny * F.col("aa")) & (vb > tiny * F.col("bb"))
    label = F.array(*[F.lit(c) for c in names])
    return sums.select(F.get(label, F.col("i").cast("int")).alias("column_a"), F.get(label, F.col("j").cast("int")).alias("column_b"),
                       n.cast("long").alias("n"), F.when(ok, r).alias("r"))


def _comparable(df: DataFrame, name: str):
    """A column as rows can be grouped by: a map as its entries in key order."""
    c = F.col(f"`{name}`")
    return F.array_sort(F.map_entries(c)) if isinstance(df.schema[name].dataType, T.MapType) else c


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, ``duplicate_groups`` (rows that occur more than once) and ``duplicate_rows`` (their
    occurrences after the first).  Nulls equal nulls; fields may be nested.

    Rows are counted by a 64-bit fingerprint first; only those that share one go
    on, and are grouped by their fields, so equal fingerprints alone decide nothing.
    """
    fields = [_comparable(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)]
    # the places of nulls are part of the fingerprint, which skips null values
    marks = F.array(*[F.col(f"`{c}`").isNull() for c in df.columns])
    rows = df.select(*fields, marks.alias("marks"))
    names = [f"c{i}" for i in range(len(fields))]
    rows = rows.select(*names, F.xxhash64("marks", *names).alias("print"))
    some = rows.groupBy("print").agg(F.count("*").alias("k"))
    total = some.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n_rows"))
    again = rows.join(some.where("k > 1").select("print"), "print", "left_semi") \
        .groupBy(*names).agg(F.count("*").alias("k")).where("k > 1")
    found = again.agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("duplicate_rows"))
    return total.withColumn("one", F.lit(1)).join(found.withColumn("one", F.lit(1)), "one").drop("one")
