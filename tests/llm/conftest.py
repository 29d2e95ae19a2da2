import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("source", T.StringType()),
                    # columns whose names clash with those the operators use inside
                    *[T.StructField(n, T.StringType()) for n in ("id", "rid", "body", "n", "row", "key", "node")]])


@pytest.fixture(scope="session")
def docs_of(spark, tmp_path_factory):
    """A documents table on disk from (doc_id, text[, source]) rows, with extra columns of clashing names."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, *["x"] * 7) for r in rows]
        path = str(tmp_path_factory.mktemp("docs"))
        df = spark.createDataFrame(full, DOC)
        (df.repartition(parts) if rows else df).write.mode("overwrite").parquet(path)
        return spark.read.schema(DOC).parquet(path)

    return make
