"""Registry of named queries: a Spark callable plus, where SQL can say it, the
equivalent DuckDB SQL over the same Parquet tables (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
# The part of a last digit from which on it is rounded up.  Exact halves are
# common (means of a few decimals) and their sums differ in the last bit
# between engines, so the boundary lies a little below the half.
HALF = 0.503


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ops: str = ""):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn

    return wrap


SCALE = float(10 ** DIGITS)


def round_col(c, digits: int = DIGITS):
    """floor(x·10^d + HALF) / 10^d in IEEE double arithmetic.

    Written out (not ``round``) so that Spark and the DuckDB oracle apply the
    very same operations: ``round`` rounds the shortest decimal text in Spark
    but the binary value in DuckDB, which differ at half-way points."""
    scale = F.lit(float(10 ** digits))
    x = c.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) > F.lit(1e12)), x).otherwise(
        F.floor(x * scale + F.lit(HALF)).cast("double") / scale) + F.lit(0.0)


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (floating sums are order dependent); the
    oracle SQL applies the same expression (``r6``) to the same columns."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_col(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def r6(expr: str) -> str:
    """SQL twin of ``finish`` for one expression."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN isnan({x}) OR abs({x}) > 1e12 THEN {x} "
            f"ELSE CAST(floor({x} * {SCALE!r} + {HALF!r}) AS DOUBLE) / {SCALE!r} END + 0.0)")


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from . import q_basic, q_features, q_link, q_model, q_records, q_retrieval, q_sources, q_stats, q_stream, q_student, q_text  # noqa: F401
    return REGISTRY
