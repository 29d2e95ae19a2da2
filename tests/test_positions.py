"""Positions and features of groups that stay together, and of groups too large for that."""

import datetime
import random

from pyspark.sql import functions as F

from strata.operators import ordering
from strata.operators.features import illuminate

KEYS, ORDER = ["k", "y"], ["responsedatevalue", "item"]


def _fact(spark):
    r = random.Random(5)
    rows = []
    for i in range(400):
        k = "hot" if i % 3 == 0 else f"s{i % 20}"
        day = None if i % 17 == 0 else datetime.date(2020, 1, 1 + i % 9)
        pct = None if i % 11 == 0 else float(r.randint(0, 100))
        rows.append((k, str(2019 + i % 2), day, i, r.choice(["widget", "ring", "other"]), 1.0, 2.0, pct, float(r.randint(0, 100)),
                     r.choice(["Reteach", None]), r.choice(["3", "4", "x", None])))
    return spark.createDataFrame(rows, "k string, y string, responsedatevalue date, item int, Standard_Subject string, "
                                       "Response_points double, Response_points_possible double, Response_percent_correct double, "
                                       "Standard_percent_correct double, condition string, GradeLevelDuringUnitTest string")


def _features(spark):
    out = illuminate.illuminate_features(_fact(spark), KEYS, ORDER, ["widget"], ["ring"])
    return out, sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.collect())


def test_large_groups_are_split_with_the_same_positions(spark):
    df = _fact(spark).select(*KEYS, *ORDER)
    flags = {"all": F.lit(True), "odd": F.col("item") % 2 == 1}
    few, many = (sorted(map(str, ordering.ordered_positions(df, KEYS, ORDER[0], ORDER, flags, large=n).select(
        *KEYS, "item", "_pos_all", "_pos_odd").collect())) for n in (10, 10 ** 6))
    assert few == many and len(few) == 400


def test_features_agree_and_groups_take_no_second_shuffle(spark, monkeypatch):
    out, together = _features(spark)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # the rows once: no buffers of a hundred columns for every (student, year, date), no second pass for the grades
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    monkeypatch.setattr(ordering.placed_rows, "__defaults__", (*ordering.placed_rows.__defaults__[:-1], 10))
    assert _features(spark)[1] == together


def test_tables_are_staged_compressed(spark):
    import os

    from strata.session import staged

    df = spark.range(200_000).select(*[(F.col("id") % 7).alias(f"c{i}") for i in range(20)])
    back = staged(df)
    path = back.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path))
    assert back.count() == 200_000 and size < 200_000 * 20 * 8 / 10
