"""The incremental stream: several micro-batches, a batch delivered again, and last-write-wins over batches."""

from pyspark.sql import functions as F

from strata.sources import io
from strata.streaming.incremental import forget_last_commit, log_micro_batches, read_latest

SCHEMA = "k long, v string, t long"


def _deliver(spark, base, done=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    log_micro_batches(stream, f"{base}/log", f"{base}/checkpoint", done=done, key=["k"]).awaitTermination()


def _file(spark, base, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")


def test_batches_replay_and_last_write_wins(spark):
    base = io.scratch_dir(spark, "stream-test")
    _file(spark, base, [(1, "a", 9), (2, "b", 1), (7, "skipped", 1)])
    _file(spark, base, [(1, "c", 2), (3, "d", 1), (3, "e", 2)])
    _file(spark, base, [(2, "f", 0)])
    done = spark.createDataFrame([(7,)], "k long")
    _deliver(spark, base, done)
    log = spark.read.parquet(f"{base}/log")
    assert log.select("_batch").distinct().count() == 3
    rows = sorted(tuple(r) for r in log.select("_batch", "k", "v", "t").collect())

    # the last batch again: its folder replaces itself
    assert forget_last_commit(spark, f"{base}/checkpoint") == 2
    _deliver(spark, base, done)
    again = spark.read.parquet(f"{base}/log")
    assert sorted(tuple(r) for r in again.select("_batch", "k", "v", "t").collect()) == rows

    # a later batch wins over a later time within an earlier one
    latest = read_latest(spark, f"{base}/log", ["k"], ["t"])
    assert sorted(tuple(r) for r in latest.select("k", "v").collect()) == [(1, "c"), (2, "f"), (3, "e")]

    # new files go on where the stream stopped
    _file(spark, base, [(4, "g", 1)])
    _deliver(spark, base, done)
    assert spark.read.parquet(f"{base}/log").where(F.col("k") == 4).count() == 1


def test_no_commit_to_take_back(spark):
    assert forget_last_commit(spark, io.scratch_dir(spark, "stream-none")) is None
