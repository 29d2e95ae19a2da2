"""Joins J1-J13 with explicit, checked strategies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only when the optimizer's size estimate is below this.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (file sizes for scans; no job runs)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # estimate unavailable: treat as large
        return 1 << 62


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the choice to
    the planner and AQE (sort-merge or shuffled hash join)."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def left_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], validate: str | None = None,
              max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left equi-join to a dimension; ``validate`` in {'m:1', '1:1', 'm:m'}."""
    on = list(on)
    if validate not in (None, "m:m", "m:1", "1:1"):
        raise ValueError("validate must be one of 'm:1', '1:1', 'm:m'")
    if validate in ("m:1", "1:1"):
        dim = unique_on(dim, on, "right")
    if validate == "1:1":
        fact = unique_on(fact, on, "left")
    return fact.join(broadcast_if_small(dim, max_broadcast_bytes), on=on, how="left")


def unique_on(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """J3 guard: fail the job if ``keys`` repeat in ``df``.

    The window leaves ``df`` hash-partitioned by the keys, which a sort-merge
    join on the same keys reuses, so the check adds no shuffle there.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    msg = f"join validation failed: {what} keys {list(keys)} are not unique"
    return df.withColumn("_n_key", n).where(F.assert_true(F.col("_n_key") == 1, F.lit(msg)).isNull()).drop("_n_key")


def join_role(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, suffix: str,
              validate: str | None = "m:1") -> DataFrame:
    """Join a dimension under a role; its columns get ``suffix``."""
    renamed = dim.select(*[F.col(c).alias(f"{c}{suffix}") for c in dim.columns])
    rk = f"{dim_key}{suffix}"
    if validate in ("m:1", "1:1"):
        renamed = unique_on(renamed, [rk], "right")
    j = df.join(broadcast_if_small(renamed), df[left_key] == renamed[rk], "left")
    return j


def full_outer_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on composite keys with null-safe equality; the key
    columns are coalesced from both sides (rule 7)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[F.col(c) for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    j = left.join(r, cond, "full")
    rest_l = [left[c] for c in left.columns if c not in keys]
    rest_r = [r[c] for c in right.columns if c not in keys]
    return j.select(*[F.coalesce(left[k], r[f"_r_{k}"]).alias(k) for k in keys], *rest_l, *rest_r)


def semi(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with a key present in ``keys_df``."""
    return df.join(keys_df.select(*on), on=list(on), how="left_semi")


def anti(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not (yet) in ``keys_df``."""
    return df.join(keys_df.select(*on), on=list(on), how="left_anti")


def first_per_group_join(df: DataFrame, entity: str, period: str, how: str = "min") -> DataFrame:
    """Keep rows at the group's extreme period (window, no self-join)."""
    agg = F.min if how == "min" else F.max
    w = Window.partitionBy(entity)
    return df.withColumn("_ext", agg(period).over(w)).where(F.col(period) == F.col("_ext")).drop("_ext")


def update_nested(records: DataFrame, updates: DataFrame, key: str, field_path: str,
                  value_col: str) -> DataFrame:
    """Replace ``field_path`` (``struct.field``) of ``records`` by
    ``updates.value_col`` where the key matches; keeps a ``_updated`` flag so
    counts of updated / unmatched come from the same join."""
    top, field = field_path.split(".", 1)
    u = updates.select(F.col(key).alias("_u_key"), F.col(value_col).alias("_u_val"))
    j = records.join(u, records[key] == u["_u_key"], "left")
    new_top = F.col(top).withField(field, F.coalesce(F.col("_u_val"), F.col(f"{top}.{field}")))
    return j.withColumn(top, new_top).withColumn("_updated", F.col("_u_key").isNotNull()).drop("_u_key", "_u_val")


def explode_candidates(df: DataFrame, key: str, array_col: str, out_col: str = "candidate") -> DataFrame:
    """One row per (entity, candidate) with the candidate position."""
    return df.select(key, F.posexplode_outer(array_col).alias("candidate_pos", out_col))
