"""Readers and writers (S1-S13): explicit schemas, no inference."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never node-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
             columns: Sequence[str] | None = None, encoding: str = "UTF-8",
             key: str | None = None) -> DataFrame:
    """CSV with header, declared schema and a column list; with
    ``key`` rows whose key is null (footer rows) are dropped."""
    df = (spark.read.schema(schema).option("header", True).option("encoding", encoding)
          .option("mode", "PERMISSIVE").csv(list(paths) if not isinstance(paths, str) else paths))
    if columns:
        df = df.select(*columns)
    if key:
        df = df.where(F.col(key).isNotNull())
    return df


def read_csv_any_encoding(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """S3: per file, UTF-8 when the bytes are valid UTF-8, else latin-1.

    The check reads the files line by line, so files of any size are split over
    tasks, in one pass; one row per file comes to the driver.  Each group of
    paths is then read with its encoding and the two are unioned by name.
    """
    probe = (spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")
             .groupBy("path").agg(F.every(F.is_valid_utf8("value")).alias("ok")).collect())
    good = sorted(unquote(r["path"]) for r in probe if r["ok"])  # file_path is a URI
    bad = sorted(unquote(r["path"]) for r in probe if not r["ok"])
    parts = []
    if good:
        parts.append(read_csv(spark, good, schema))
    if bad:
        parts.append(read_csv(spark, bad, schema, encoding="ISO-8859-1"))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType, multiline: bool = True,
              corrupt_col: str | None = None) -> DataFrame:
    """JSON records (arrays or one document per file) with a schema;
    bad files are kept as rows with ``corrupt_col`` set instead of failing."""
    r = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.json(path)


def with_file_stem(df: DataFrame, col: str = "file_stem") -> DataFrame:
    """The source file name without directory and extension."""
    return df.withColumn(col, F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``source`` path and whole ``text``."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))


def decode_texts(df: DataFrame, content: str = "content", text: str = "text") -> DataFrame:
    """Bytes as text, item by item: ``text`` and ``read_error`` (null if fine) instead of ``content``.

    Bytes that are missing or not valid UTF-8 give a row with a null text and
    the error, not a failed job; other columns stay."""
    ok = F.is_valid_utf8(F.col(content).cast("string"))
    error = F.when(F.col(content).isNull(), F.lit("no content")).when(~ok, F.lit("not valid UTF-8"))
    return df.select(*[c for c in df.columns if c != content], error.alias("read_error"),
                     F.when(ok, F.col(content).cast("string")).alias(text))


def read_text_files_checked(spark: SparkSession, path: str) -> DataFrame:
    """S7 with a status per file: ``source``, ``read_error`` and ``text`` (see ``decode_texts``).  A file of no
    bytes gives no row, as Spark plans no read for it."""
    files = spark.read.format("binaryFile").load(path)
    return decode_texts(files.select(F.col("path").alias("source"), "content"))


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, file name, extension and size of every file (contents are
    pruned from the scan)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select("path", name.alias("name"),
                     F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"),
                     F.col("length").alias("size_bytes"),
                     (F.col("length") / F.lit(1024.0 ** 2)).alias("size_mb"))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    """S10."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> str:
    """S11."""
    df.write.mode(mode).option("header", True).option("encoding", encoding).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """S12."""
    df.write.mode(mode).json(path)
    return path


def write_text_files(texts: DataFrame, path: str) -> str:
    """One text file per row of the one column ``texts`` has.

    The rows are dealt to as many tasks as a shuffle has, as opening files takes the time, not their bytes;
    every task moves its own files into place, so the driver does not move them one by one."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (texts.repartition(tasks, *texts.columns).write.option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path))
    return path


def write_documents(docs: DataFrame, path: str, key: str = "document_id", buckets: int = 64) -> str:
    """Documents stored as Parquet partitioned by a hash bucket of the
    key (one file set per bucket, not one file per document)."""
    b = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("bucket")
    docs.select("*", b).write.mode("overwrite").partitionBy("bucket").parquet(path)
    return path


def write_document_set(docs: DataFrame, path: str, key: str = "document_id", text: str = "markdown", buckets: int = 64) -> str:
    """Documents and the mapping from their id to everything else in ``docs`` (name, file name, slug, index),
    as one versioned pair.  Returns the version.

    Both parts are written in a folder of their own; a row in ``commits``, written
    last in one task, makes the pair the current one.  A job that fails in
    between, or is repeated, leaves the pair that readers see as it was.
    """
    spark = docs.sparkSession
    version = uuid.uuid4().hex
    write_documents(docs.select(key, text), f"{path}/{version}/documents", key, buckets)
    mapping = docs.drop(text)
    mapping.write.mode("errorifexists").parquet(f"{path}/{version}/mapping")
    number = 1 + max((r["number"] for r in _commits(spark, path)), default=0)
    spark.createDataFrame([(number, version)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return version


COMMIT = "number long, version string"


def _commits(spark: SparkSession, path: str) -> list:
    """One row per finished write."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return spark.read.schema(COMMIT).parquet(f"{path}/commits").collect()


def read_document_set(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The documents and the mapping of the last finished write."""
    done = _commits(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished document set under {path}")
    last = max(done, key=lambda r: (r["number"], r["version"]))["version"]
    return (spark.read.parquet(f"{path}/{last}/documents").drop("bucket"), spark.read.parquet(f"{path}/{last}/mapping"))
