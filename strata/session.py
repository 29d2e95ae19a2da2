"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults that hold on a cluster as well as in local mode.  Shuffle width is
# left to AQE: it starts wide and coalesces small partitions after each stage.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "strata", **conf) -> SparkSession:
    """Return the active session, creating one with ``DEFAULTS`` if none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only in local mode, where driver and executors are one process, a
    folder of our own is set when it is unset; elsewhere that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = os.environ.get("STRATA_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Paths of the tables staged in each open ``scratch``, the innermost last.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def staged(df, keep: bool = False):
    """Write a large table once into the shared folder, by column and compressed, and read it from there.

    Cuts the lineage as ``cut_lineage`` does, which writes whole rows uncompressed and
    keeps their partitioning: that is for tables that are small or read many times.
    ``keep``: the table outlives the ``scratch`` around it."""
    return staged_in_parts(df.sparkSession, lambda i: df, 1, keep)


def staged_in_parts(spark: SparkSession, build: Callable[[int], DataFrame], parts: int, keep: bool = False) -> DataFrame:
    """One staged table of the rows of ``build(0)``, ``build(1)``, ...: each is built and written before the next.

    The shuffle files of a part, and the tables that it stages, are deleted when it is
    written, so those of one part alone are on disk at a time."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    scopes = _SCRATCH.get()[:-1] if keep else _SCRATCH.get()
    if scopes:
        scopes[-1].append(path)
    for i in range(parts):
        with scratch(spark):
            df = build(i)
            schema = df.schema
            df.write.mode("append").orc(path)
            del df
    return spark.read.schema(schema).orc(path)


def part_of(i: int, parts: int, *cols: str) -> Column:
    """Whether a row is in part ``i`` of ``parts``, dealt by the hash of ``cols``; every row, null or not, is in one."""
    return F.pmod(F.xxhash64(*cols), F.lit(parts)) == F.lit(i) if parts > 1 else F.lit(True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, and the shuffle files of what was run:
    for steps whose results are written by then, into a table staged with ``keep`` or elsewhere."""
    paths: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), paths))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        # Spark's cleaner deletes shuffle files that nothing refers to when the driver's JVM collects
        gc.collect()
        spark._jvm.System.gc()
