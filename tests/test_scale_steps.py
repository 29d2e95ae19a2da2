"""Steps that must not grow faster than their input: file-per-record sources, ranked passes, profiles, key coverage."""

import os

from pyspark.sql import functions as F

from strata import session
from strata.operators import profiling, records, stats
from strata.plans import q_features, q_model
from strata.plans.catalog import load_all
from strata.sources import io

SF_SMOKE = "/root/testdata/sf0.001"
REG = load_all()


def test_ratio_query_compares_by_bits(spark):
    """The interpreted O(n·m) expression took seconds per thousand pairs."""
    plan = REG["fuzzy_ratio"].run(spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan


def test_one_file_per_row_is_written_by_many_tasks(spark):
    path = io.scratch_dir(spark, "many")
    io.write_text_files(spark.range(40).coalesce(1).select(F.col("id").cast("string").alias("value")), path)
    parts = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert len(parts) == 40 and len({f.split("-")[1] for f in parts}) > 1
    assert sorted(int(r["value"]) for r in spark.read.text(path).collect()) == list(range(40))


def test_ranked_values_leave_their_tie_breaks_behind(spark):
    df = spark.range(100).select((F.col("id") % 2 == 0).alias("g"), (F.col("id") % 10).cast("double").alias("v"),
                                 *[F.col("id").alias(f"t{i}") for i in range(6)])
    out = stats.order_stats(df, ["g"], "v", [f"t{i}" for i in range(6)], {"p": 0.5}, qq_name="r", bounded_groups=True)
    assert "t5" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()  # whole rows, uncompressed
    assert {r["g"]: (r["p"], r["_n"]) for r in out.collect()} == {True: (4.0, 50), False: (5.0, 50)}


def test_profile_shuffles_no_sums_or_texts_per_value(spark):
    df = spark.sql("""SELECT * FROM VALUES (1.5D, timestamp_ntz'2020-01-01 00:00:00.9', 'a'), (1.5D, timestamp_ntz'2020-01-01 00:00:00.1', 'b'),
        (-0.25D, NULL, 'a'), (NULL, timestamp_ntz'1969-12-31 23:59:59.5', NULL) AS t(x, at, s)""")
    out = profiling.table_profile(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("partial_count(1)") - 300:plan.index("partial_count(1)")]
    assert "decimal" not in first.rsplit("HashAggregate", 1)[-1] and "sec" in first
    got = {r["column_name"]: r for r in out.collect()}
    assert (got["x"]["mean"], got["x"]["distinct_values"], got["x"]["top_number"], got["x"]["top_count"]) == (2.75 / 3, 2, 1.5, 2)
    assert (got["at"]["distinct_values"], got["at"]["min_text"], got["at"]["top_text"], got["at"]["missing"]) == (
        2, "1969-12-31 23:59:59", "2020-01-01 00:00:00", 1)
    assert (got["s"]["top_text"], got["s"]["top_count"], got["s"]["missing"]) == ("a", 2, 1)


def test_key_coverage_keeps_no_plain_value_as_variant(spark, monkeypatch):
    levels = []
    cut = records.cut_lineage
    monkeypatch.setattr(records, "cut_lineage", lambda df: levels.append(cut(df)) or levels[-1])
    df = spark.createDataFrame([(1, '{"a": {"b": [1, 2]}, "c": "x", "d": null}'), (2, '{"c": [], "a": 3}'), (3, "no")], "id long, doc string")
    got = {r["path"]: (r["records"], r["samples"]) for r in records.json_key_coverage(df, "id", "doc").collect()}
    assert got == {"a": (2, "3"), "a.b": (1, "1"), "c": (2, "x"), "d": (1, "")}
    assert all(x.where("_v IS NOT NULL AND _kind NOT IN ('OBJECT', 'ARRAY')").isEmpty() for x in levels)


def _staged_tables(spark):
    return {f for f in os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) if f.startswith("staged-")}


def test_a_table_in_parts_has_every_row_once(spark):
    df = spark.createDataFrame([(k, y, i) for i, (k, y) in enumerate([("a", "1"), ("a", "2"), (None, "1"), ("b", None), (None, None), ("a", "1")])],
                               "k string, y string, i int")
    before = _staged_tables(spark)
    out = session.staged_in_parts(spark, lambda i: session.staged(df).where(session.part_of(i, 3, "k", "y")), 3)
    assert sorted(r["i"] for r in out.collect()) == list(range(6))
    assert len(_staged_tables(spark) - before) == 1  # what was staged for a part is gone
    with session.scratch(spark):
        kept = session.staged(out, keep=True)
        session.staged(out)
    assert len(_staged_tables(spark) - before) == 2 and kept.count() == 6


def test_features_in_parts_are_the_same_and_leave_one_table(spark, monkeypatch):
    """The facts and each source's features stayed in the checkpoint folder; all shuffle files were there at once."""
    def rows(df):
        return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())

    before = _staged_tables(spark)
    assert q_features.feature_parts(spark, SF_SMOKE) == 1
    whole = q_features.all_features(spark, SF_SMOKE)
    assert len(_staged_tables(spark) - before) == 1
    monkeypatch.setattr(q_features, "PART_FROM_BYTES", 0)
    assert q_features.feature_parts(spark, SF_SMOKE) == q_features.PARTS
    assert rows(q_features.all_features(spark, SF_SMOKE)) == rows(whole)
    assert len(_staged_tables(spark) - before) == 2


def test_training_table_in_parts_is_the_same_and_only_it_and_the_profile_stay(spark, monkeypatch):
    def rows(df):
        return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())

    before = _staged_tables(spark)
    whole, _ = q_model._training(spark, SF_SMOKE)
    assert len(_staged_tables(spark) - before) == 2
    monkeypatch.setattr(q_features, "PART_FROM_BYTES", 0)
    parts, _ = q_model._training(spark, SF_SMOKE)
    assert parts.schema == whole.schema and rows(parts) == rows(whole)
    assert len(_staged_tables(spark) - before) == 4
