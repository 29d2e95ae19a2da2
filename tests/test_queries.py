"""Every registered query against its DuckDB oracle (sf0.001), plus the
driver contract and plan-shape checks."""

import importlib.util
import os

import pytest
from pyspark.sql import functions as F

from strata.plans.catalog import load_all
from strata.plans.check import check_query, duckdb_conn

SF_SMOKE = "/root/testdata/sf0.001"

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMOKE)


@pytest.mark.parametrize("name", sorted(n for n, q in REG.items() if q.sql))
def test_against_oracle(spark, con, name):
    res = check_query(spark, REG[name], SF_SMOKE, con)
    assert res["problems"] == [] and res["rows"] > 0, res


@pytest.mark.parametrize("name", sorted(n for n, q in REG.items() if not q.sql))
def test_rows_only(spark, name):
    df = REG[name].run(spark, SF_SMOKE)
    assert df.count() > 0 and len(df.columns) > 0


def test_batch_topk_takes_many_query_blocks(spark):
    from strata.operators.retrieval import batch_topk

    v = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))
    qs = v.select(F.col("doc_id").alias("query_id"), F.col("vec").alias("qvec"))
    one, many = (sorted(batch_topk(v, qs, k=3, query_block=b).select("query_id", "rank", "doc_id").collect()) for b in (10 ** 6, 7))
    assert one == many and len(one) == 3 * v.count()
    assert batch_topk(v, qs.limit(0)).collect() == []


def test_entry_contract(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(mod.oracle_sql()) <= set(mod.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_features_have_no_python(spark):
    plan = _plan(REG["features_illuminate"].run(spark, SF_SMOKE))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_pushdown_and_pruning(spark):
    df = REG["scan_project_filter"].run(spark, SF_SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):].split("ReadSchema")[0]  # cut off after some, in the text
    assert all(f in pushed for f in ("IsNotNull(l_returnflag)", "IsNotNull(l_discount)", "EqualTo(l_returnflag,R)"))
    assert "l_comment" not in plan


def test_batch_topk_limits_before_shuffle(spark):
    df = REG["vector_batch_topk"].run(spark, SF_SMOKE)
    df.collect()
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_registry_validation():
    from strata.operators.features.registry import feature, features

    with pytest.raises(ValueError):
        features([])
    with pytest.raises(TypeError):
        feature(1, float)
    with pytest.raises(TypeError):
        feature("x", "not-a-type")


@pytest.mark.parametrize("name, tables", [("features_illuminate", 3), ("features_milestone", 3)])
def test_each_source_is_read_once(spark, name, tables):
    """What is planned after the positions reads the written table, not the source: no scan is left in the plan."""
    plan = _plan(REG[name].run(spark, SF_SMOKE))
    assert plan.count("FileScan parquet") == 0 and plan.count("Scan ExistingRDD") <= 4


def test_longitudinal_is_planned_in_one_aggregate(spark):
    df = REG["longitudinal_wide"].run(spark, SF_SMOKE)
    assert len(df.columns) == 260  # the student, 88 latest, 85 deltas, 85 slopes, the number of snapshots
    plan = _plan(df)
    assert plan.count("FileScan parquet") == 0 and plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_quantiles_of_all_targets_take_one_ranked_pass(spark):
    from strata.operators.stats import order_stats_many

    df = spark.createDataFrame([(i % 2 == 0, i, float(i), float(-i)) for i in range(50)], "g boolean, k long, a double, b double")
    got = {r["g"]: r for r in order_stats_many(df, ["g"], {"x": "a", "y": "b"}, ["k"], {"p": 0.5}, qq=True).collect()}
    assert got[True]["x_p"] == 24.0 and got[True]["y_p"] == -24.0 and got[False]["x_n"] == 25
    plan = _plan(order_stats_many(df, ["g"], {"x": "a", "y": "b"}, ["k"], {"p": 0.5}, bounded_groups=True))
    assert plan.count("Window [") <= 2


def test_bounded_groups_broadcast_block_table(spark):
    df = REG["qq_r2"].run(spark, SF_SMOKE)
    df.collect()
    plan = _plan(df)
    # the (partition, segment) block-offset join is broadcast: the ranked rows are not re-shuffled
    assert "BroadcastHashJoin [_pid" in plan
    assert "SortMergeJoin [_pid" not in plan
