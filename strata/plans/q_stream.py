"""Incremental batch through Structured Streaming (S14 + S15 in foreachBatch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import io
from ..sources.tables import table
from ..streaming.incremental import forget_last_commit, log_micro_batches, read_latest
from .catalog import finish, r6, register

FILES_PER_SPAN = 2


@register("incremental_stream_upsert", sql=f"""
SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey,
       arg_max(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderstatus,
       {r6('arg_max(o_totalprice, struct_pack(d := o_orderdate, k := o_orderkey))')} AS o_totalprice
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
GROUP BY o_custkey""", ops="S14, S15 as a file stream with foreachBatch, exactly-once per batch")
def incremental_stream_upsert(spark, sf_dir):
    """Orders arrive in files by time, a customer in one file of a span, and each file is a micro-batch; the last
    batch is delivered again, as after a crash between its write and its commit."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    base = io.scratch_dir(spark, "stream")
    year = F.year("o_orderdate")
    for span in (year < 1995, (year >= 1995) & (year < 1998), year >= 1998):
        orders.where(span).repartition(FILES_PER_SPAN, "o_custkey").write.mode("append").parquet(f"{base}/in")
    done = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))

    def deliver():
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        log_micro_batches(stream, f"{base}/log", f"{base}/checkpoint", done=done, key=["o_custkey"]).awaitTermination()

    deliver()
    forget_last_commit(spark, f"{base}/checkpoint")
    deliver()
    latest = read_latest(spark, f"{base}/log", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return finish(latest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"))
