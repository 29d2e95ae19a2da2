"""Helpers shared by the corpus operators: query registry, input columns, staged tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sources.tables import table

__all__ = ["QUERIES", "query", "table", "bytes_of", "Stage", "WORD", "words_sql"]

# One word: a run of characters other than the ASCII blanks (space, tab..carriage return).
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class LlmQuery:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, LlmQuery] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its DuckDB twin, if SQL can express it."""
    def wrap(fn):
        QUERIES[name] = LlmQuery(name, fn, sql)
        return fn

    return wrap


def bytes_of(text: Column | str) -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit("")).cast("binary")


def words_sql(text: str) -> str:
    """DuckDB: number of words of a text."""
    return rf"len(regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+'))"


class Stage:
    """Parquet tables in the cluster's shared checkpoint folder.

    A staged table cuts the lineage like a reliable checkpoint: it survives the
    loss of any executor, and what follows it never recomputes what precedes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> DataFrame:
        """Write ``df`` (in a folder per value of ``by``) and return the DataFrame that reads it back."""
        df.write.mode("overwrite").options(**options or {}).partitionBy(*by).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a staged table that nothing reads any more, and let Spark's cleaner
        delete the shuffle files of the finished steps (it acts when the driver's JVM collects)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()
