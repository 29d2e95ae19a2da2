"""Quantiles, histograms, correlations and duplicate rows against numpy, with missing values and edges."""

import math
import random

import numpy as np
import pytest

from strata.operators import profiling as PR

KINDS = "a double, b bigint, same int, none double, t string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(None if rng.random() < .1 else float("nan") if rng.random() < .1 else rng.choice([0.5, rng.gauss(1e6, 3)]),
             None if rng.random() < .2 else rng.randrange(50), 7, None, "x") for _ in range(700)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, KINDS).repartition(5).cache()


def column(rows, i):
    return np.array([r[i] for r in rows if r[i] is not None and not math.isnan(r[i])], float)


def test_exact_quantiles(df, rows):
    got = {r["column_name"]: r for r in PR.table_quantiles(df).collect()}
    assert set(got) == {"a", "b", "same", "none"} and got["none"]["p50"] is None
    for name, i in (("a", 0), ("b", 1), ("same", 2)):
        for p, q in PR.QUANTILES.items():
            assert got[name][p] == pytest.approx(np.quantile(column(rows, i), q), rel=1e-12)


def test_sketched_quantiles_keep_their_rank_error(df, rows):
    got = {r["column_name"]: r for r in PR.table_quantiles(df, ["a", "none"], accuracy=50).collect()}
    values = np.sort(column(rows, 0))
    for p, q in PR.QUANTILES.items():
        low, high = np.searchsorted(values, got["a"][p], "left"), np.searchsorted(values, got["a"][p], "right")
        assert low - len(values) / 50 - 1 <= q * len(values) <= high + len(values) / 50 + 1
    assert got["none"]["p5"] is None


def test_histogram(df, rows):
    got = PR.table_histogram(df, bins=4).collect()
    assert {r["column_name"] for r in got} == {"a", "b", "same"}
    for name, i in (("a", 0), ("b", 1)):
        mine = sorted((r["bin"], r["low"], r["high"], r["n"]) for r in got if r["column_name"] == name)
        count, edges = np.histogram(column(rows, i), 4)
        assert [m[3] for m in mine] == count.tolist()
        assert [m[1] for m in mine] == pytest.approx(edges[:-1].tolist()) and mine[-1][2] == pytest.approx(edges[-1])
    assert sorted(r["n"] for r in got if r["column_name"] == "same") == [0, 0, 0, 700]


def test_correlations(df, rows):
    got = {(r["column_a"], r["column_b"]): (r["n"], r["r"]) for r in PR.correlations(df).collect()}
    both = np.array([(r[0], r[1]) for r in rows if r[0] is not None and not math.isnan(r[0]) and r[1] is not None])
    assert len(got) == 6 and got["a", "b"][0] == len(both)
    assert got["a", "b"][1] == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-9)
    assert got["a", "same"][1] is None and got["b", "none"] == (0, None)


def test_duplicate_rows_with_nested_and_null_fields(spark):
    kinds = "k int, m map<string,int>, s struct<a:int,b:array<string>>, t string"
    one = (1, {"x": 1, "y": 2}, (1, ["p", None]), None)
    data = [one, (1, {"y": 2, "x": 1}, (1, ["p", None]), None), one, (1, {"x": 1, "y": 2}, (1, ["p"]), None),
            (None, None, None, "q"), (None, None, None, "q"), (None, None, (None, None), "q"), (2, {}, None, None)]
    assert tuple(PR.duplicate_rows(spark.createDataFrame(data, kinds)).first()) == (8, 2, 3)
    shifted = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    assert tuple(PR.duplicate_rows(shifted).first()) == (3, 1, 1)


def test_empty_tables(spark):
    none = spark.createDataFrame([], KINDS)
    assert [r["p50"] for r in PR.table_quantiles(none).collect()] == [None] * 4
    assert PR.table_histogram(none).collect() == []
    assert all(r["n"] == 0 and r["r"] is None for r in PR.correlations(none).collect())
    assert tuple(PR.duplicate_rows(none).first()) == (0, 0, 0)
    assert PR.correlations(spark.createDataFrame([("x",)], "t string")).collect() == []
