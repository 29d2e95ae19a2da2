"""The pipeline's stages, each against what its predecessor kept."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import mixing, packing, subwords
from strata.llm.queries import QUERIES
from test_dedup import near_brute
from test_models import junk, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_queries_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and set(QUERIES) < set(names) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rng = random.Random(8)
    good = [prose(rng) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(good)] + [(200 + i, junk(rng)) for i in range(60)]
    rows += [(300 + i, good[i]) for i in range(10)] + [(320 + i, good[i + 20] + " tail") for i in range(10)] + [(400, None), (400, ""), (None, good[5])]
    sf = tmp_path_factory.mktemp("sf")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    spark.createDataFrame([(k, t, "en", f"s{(k or 0) % 3}", len(t or "")) for k, t in rows], schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, int(k < 200), 0) for k, _ in rows[:180]], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    out, docs = [], spark.read.parquet(f"{sf}/documents.parquet")
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, str(sf)).write.parquet(f"{sf}/{i}")
        docs = spark.read.parquet(f"{sf}/{i}")
        out.append(docs)
    return str(sf), rows, out


def test_stages(spark, stages):
    sf, rows, (good, distinct, far, mixed, packed) = stages
    assert all(x.columns == COLUMNS for x in (good, distinct, far, mixed))
    have = [(r["doc_id"], r["text"]) for r in good.collect()]
    junk_left = [k for k, _ in have if k is not None and 200 <= k < 260]
    assert len(junk_left) <= 3 and {k for k, t in rows if t and (k is None or not 200 <= k < 260)} <= {k for k, _ in have}

    after = [(r["doc_id"], r["text"]) for r in distinct.collect()]
    assert sorted({t or "" for _, t in have}) == sorted(t or "" for _, t in after)

    # rows are told apart by their place: ids may be null or repeat
    want = [after[i] for i, _, c in near_brute([(i, t) for i, (_, t) in enumerate(after)], 5, 80) if i == c]
    have = [(r["doc_id"], r["text"]) for r in far.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)

    sizes = {r["source"]: r["w"] for r in far.groupBy("source").agg(F.sum(mixing.word_count("text")).alias("w")).collect()}
    got = {r["source"]: r["w"] for r in mixed.groupBy("source").agg(F.sum(mixing.word_count("text")).alias("w")).collect()}
    assert abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 0.2 * sum(sizes.values())
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2

    bpe = subwords.WordBpe(subwords.default_path())
    ids = sum(len(bpe.packed((r["text"] or "").encode())) // 4 + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == ids
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where(F.col("n") > packing.WINDOW).count() == 0


def test_run_gives_the_last_stage(spark, stages):
    sf, _, out = stages
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == out[-1].columns and got.agg(F.sum("length")).first() == out[-1].agg(F.sum("length")).first()


def test_near_stage_tells_rows_apart_by_place(spark, docs_of):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty " * 3
    other = "quite another text of many words that no one else has written down before now or will write down after"
    docs = docs_of([(1, long), (5, long + "more"), (5, other), (None, long + "less"), (None, other + " again")], parts=1)
    kept = [r["text"] for r in corpus_pipeline.near(spark, docs, "").collect()]
    assert len(kept) == 2 and sum(t.startswith("one two") for t in kept) == 1 and sum(t.startswith("quite") for t in kept) == 1
