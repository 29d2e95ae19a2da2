"""Incremental batch as Structured Streaming (S14, S15 in ``foreachBatch``).

New input files are picked up by a file stream; every micro-batch is written
to an append-only Parquet log under its batch id (an overwrite of that one
folder, so a retried batch replaces itself: exactly-once).  Readers get the
current state with last-write-wins (``upsert_latest``) at read time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import new_keys, upsert_latest


def log_micro_batches(stream: DataFrame, log_path: str, checkpoint: str, done: DataFrame | None = None,
                      key: Sequence[str] = (), available_now: bool = True):
    """Start the stream; optionally skip keys already in ``done``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        b = new_keys(batch, done, list(key)) if done is not None else batch
        b.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{log_path}/_batch={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_latest(spark: SparkSession, log_path: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """S15 at read time: per key the row of the latest batch, then ``order``."""
    log = spark.read.parquet(log_path)
    empty = log.limit(0)
    return upsert_latest(empty, log, list(key), ["_batch", *order])


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Take back the commit of the last batch (its number), so that the next start delivers that batch again.

    This is the state after a crash between a batch's write and its commit."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().isdigit()] if fs.exists(folder) else []
    if not done:
        return None
    last = max(done, key=lambda p: int(p.getName()))
    fs.delete(last, False)
    return int(last.getName())
