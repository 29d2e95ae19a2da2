"""Incremental batch: skip done keys (S14/J6), last write wins (S15), diff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_keys(candidates: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Candidates whose key is not in ``done`` (left anti join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return candidates.join(done.select(*keys).distinct(), on=keys, how="left_anti")


def upsert_latest(existing: DataFrame, new: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Union by name, then per key the row with the greatest ``order``
    (the last write).  ``max_by`` over a struct is partially aggregated, so a
    hot key never gathers its rows in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    u = existing.unionByName(new, allowMissingColumns=True)
    rest = [c for c in u.columns if c not in keys]
    ordv = F.struct(*[F.col(o) for o in order])
    g = u.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordv).alias("_row"))
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def dataset_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: rows of each side, keys only in a / only in b, in-sync.

    Both sides are tagged and unioned, reduced per key (partial aggregation
    before the shuffle), then summed: one pass, no join."""
    t = (a.select(F.col(key).alias("_k"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
         .unionByName(b.select(F.col(key).alias("_k"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per = t.groupBy("_k").agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    out = per.agg(F.sum("_na").cast("bigint").alias("a_count"), F.sum("_nb").cast("bigint").alias("b_count"),
                  F.count_if(F.col("_k").isNotNull() & (F.col("_na") > 0) & (F.col("_nb") == 0)).alias("only_in_a"),
                  F.count_if(F.col("_k").isNotNull() & (F.col("_nb") > 0) & (F.col("_na") == 0)).alias("only_in_b"))
    return out.withColumn("in_sync", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0))


def diff_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The keys themselves, tagged 'only_in_a' / 'only_in_b'."""
    ka = a.select(key).distinct()
    kb = b.select(key).distinct()
    return (ka.join(kb, on=key, how="left_anti").withColumn("side", F.lit("only_in_a"))
            .unionByName(kb.join(ka, on=key, how="left_anti").withColumn("side", F.lit("only_in_b"))))
