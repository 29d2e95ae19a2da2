"""Binding of the driver's tables to the district concepts.

The studied application reads private district extracts.  The operators are
exercised on the driver's TPC-H-like tables instead; each function below
projects a driver table into the column names the operators expect.  The
same mapping is written out in each oracle SQL.

| concept             | binding                                                        |
| ------------------- | -------------------------------------------------------------- |
| student             | ``o_custkey`` / ``c_custkey`` (string)                         |
| school              | ``c_nationkey``                                                |
| school year (fall)  | ``year(o_orderdate)`` (string)                                 |
| illuminate item     | ``lineitem ⋈ orders ⋈ part``                                   |
| milestone test      | ``lineitem ⋈ orders ⋈ part``, subject ``p_type``               |
| MAP RIT test        | ``events`` grouped by (``user_id``, ISO week)                  |
| SAT event           | ``orders`` with ``o_orderpriority = '1-URGENT'``               |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

STUDENT = "mask_studentpersonkey"
YEAR = "SchoolYearFall"
KEYS = (STUDENT, YEAR)

# Subject keywords of the binding (the catalogue's own keywords are defaults
# of the feature functions; these map the driver's part names/types).
ILLUMINATE_MATH = ("widget", "gear")
ILLUMINATE_ELA = ("ring", "bolt")
MILESTONE_MATH = ("economy", "promo")
MILESTONE_ELA = ("standard", "medium")

ILLUMINATE_ORDER = ("responsedatevalue", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_extendedprice")
MILESTONE_ORDER = ("TestingDateId", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   "l_extendedprice")
RIT_ORDER = ("ts", "event_id")

# RIT quintile labels for the driver's event types.
QUINTILE_OF_EVENT = {"purchase": "High", "click": "HiAvg", "view": "Avg", "signup": "LoAvg",
                     "error": "Low"}


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .withColumns({STUDENT: F.col("o_custkey").cast("string"),
                            YEAR: F.year("o_orderdate").cast("string")}))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the Illuminate and the Milestone facts are made from; ``l_orderkey`` is its first join key."""
    return _items(spark, sf_dir).drop("o_orderkey", "o_custkey", "o_orderdate", "p_partkey", "l_tax")


def illuminate_fact(spark: SparkSession, sf_dir: str, it: DataFrame | None = None) -> DataFrame:
    """``it``: the rows of ``items``, where the caller has them."""
    it = _items(spark, sf_dir) if it is None else it
    return it.select(
        STUDENT, YEAR,
        F.to_date("l_shipdate").alias("responsedatevalue"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("p_name").alias("Standard_Subject"),
        F.col("l_quantity").alias("Response_points"),
        F.lit(50.0).alias("Response_points_possible"),
        (F.col("l_quantity") * F.lit(2.0)).alias("Response_percent_correct"),
        ((F.lit(1.0) - F.col("l_discount") * F.lit(10.0)) * F.lit(100.0)).alias("Standard_percent_correct"),
        F.when(F.col("l_returnflag") == "R", "Reteach")
         .when(F.col("l_returnflag") == "A", "Extension")
         .when(F.col("l_returnflag") == "N", "Review & Practice").alias("condition"),
        F.col("l_linenumber").cast("string").alias("GradeLevelDuringUnitTest"),
    )


def milestone_fact(spark: SparkSession, sf_dir: str, it: DataFrame | None = None) -> DataFrame:
    it = _items(spark, sf_dir) if it is None else it
    return it.select(
        STUDENT, YEAR,
        F.date_format("l_shipdate", "yyyyMMdd").cast("bigint").alias("TestingDateId"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("p_type").alias("SubjectDesc"),
        F.col("l_extendedprice").alias("ScaleScore"),
        F.col("l_linenumber").alias("AchievementLevel"),
        F.col("p_retailprice").alias("LexileScore"),
    )


def rit_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    q = F.col("event_type")
    quint = F.lit(None).cast("string")
    for k, v in QUINTILE_OF_EVENT.items():
        quint = F.when(q == k, F.lit(v)).otherwise(quint)
    return ev.select(
        F.col("user_id").cast("string").alias(STUDENT),
        F.lpad(F.weekofyear("ts").cast("string"), 2, "0").alias(YEAR),
        "ts", "event_id",
        F.get_json_object("props", "$.k").cast("double").alias("TestDurationMinutes"),
        F.col("value").alias("TestRITScore"),
        F.pmod(F.col("event_id"), F.lit(100)).cast("double").alias("TestPercentile"),
        F.least(F.col("value") / F.lit(5.0), F.lit(100.0)).alias("PercentCorrect"),
        quint.alias("AchievementQuintile"),
    )


def sat_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").cast("string").alias(STUDENT),
        F.year("o_orderdate").cast("string").alias(YEAR),
        F.date_format("o_orderdate", "yyyyMMdd").cast("bigint").alias("TestingDateId"),
        "o_orderkey",
        F.floor(F.col("o_totalprice") / F.lit(1000.0)).cast("double").alias("MathScore"),
        F.floor(F.pmod(F.col("o_totalprice"), F.lit(1000.0))).cast("double").alias("VerbalScore"),
    )


# --------------------------------------------------------------------------- #
# Student profile (M11) on the driver tables                                  #
# --------------------------------------------------------------------------- #
PKEYS = (STUDENT, "SchoolYearNumberFall")
AS_OF = "2026-01-01"
GIFTED_OF_SEGMENT = {"BUILDING": "Y", "AUTOMOBILE": "D"}


def enrolment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, order year): the enrolment record."""
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    per_year = (o.groupBy("o_custkey", F.year("o_orderdate").alias("yr"))
                 .agg(F.max("o_orderstatus").alias("OrderStatus"), F.count(F.lit(1)).alias("n_orders")))
    e = per_year.join(c, per_year.o_custkey == c.c_custkey, "left")
    seg = F.col("c_mktsegment")
    gifted = F.lit(None).cast("string")
    for k, v in GIFTED_OF_SEGMENT.items():
        gifted = F.when(seg == k, F.lit(v)).otherwise(gifted)
    last_year = F.max("yr").over(Window.partitionBy("o_custkey"))
    return e.select(
        F.col("o_custkey").cast("string").alias(STUDENT),
        F.col("yr").cast("string").alias("SchoolYearNumberFall"),
        F.col("c_nationkey").cast("bigint").alias("SchoolDetailFCSId"),
        F.pmod(F.col("c_nationkey") + F.lit(1), F.lit(25)).cast("bigint").alias("SchoolDetailFCSIdNextYear"),
        (F.col("yr") - F.lit(1990) + F.pmod(F.col("o_custkey"), F.lit(3))).cast("string").alias("GradeLevel"),
        F.when(F.col("OrderStatus") == "P", "Y").otherwise("N").alias("RetainedFlag"),
        gifted.alias("ActiveGiftedStudentResultRecordFlag"),
        F.when(last_year == 2001, "Y").otherwise("N").alias("CurrentEnrollment"),
        "OrderStatus", "n_orders",
    )


def school_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar dimension: one row per fall year (bounded by the years)."""
    o = table(spark, sf_dir, "orders")
    y = o.select(F.year("o_orderdate").alias("yr")).distinct()
    return y.select(F.col("yr").cast("string").alias("SchoolYearNumberFall"),
                    F.make_date(F.col("yr"), F.lit(8), F.lit(1)).alias("FirstDayOfSchoolYear"))


def profile_sources(spark: SparkSession, sf_dir: str) -> dict:
    """Per-(student, year) source tables that the profile joins."""
    from ..operators.snapshot import snapshot

    sat = sat_fact(spark, sf_dir).withColumnRenamed(YEAR, "SchoolYearNumberFall")
    sat_snap = snapshot(sat, PKEYS, ["TestingDateId", "o_orderkey"], ["MathScore", "VerbalScore"], "sat")
    ill = (illuminate_fact(spark, sf_dir).groupBy(STUDENT, F.col(YEAR).alias("SchoolYearNumberFall"))
           .agg(F.count(F.lit(1)).alias("n_illuminate")))
    mil = (milestone_fact(spark, sf_dir).where(F.col("ScaleScore") >= 50000)
           .groupBy(STUDENT, F.col(YEAR).alias("SchoolYearNumberFall"))
           .agg(F.count(F.lit(1)).alias("n_milestone")))
    ev = table(spark, sf_dir, "events")
    rit = (ev.groupBy(F.col("user_id").cast("string").alias(STUDENT),
                      (F.lit(1994) + F.weekofyear("ts")).cast("string").alias("SchoolYearNumberFall"))
             .agg(F.count(F.lit(1)).alias("n_rit")))
    o = table(spark, sf_dir, "orders")
    grad = (o.where(F.col("o_orderstatus") == "F")
             .groupBy(F.col("o_custkey").cast("string").alias(STUDENT),
                      F.year("o_orderdate").cast("string").alias("SchoolYearNumberFall"))
             .agg(F.count(F.lit(1)).alias("n_grad")))
    return {"grad": grad, "sat": sat_snap, "illuminate": ill, "milestone": mil, "rit": rit}


def student_profile(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    from ..operators.profile import build_profile

    return build_profile(enrolment(spark, sf_dir), school_year(spark, sf_dir),
                         profile_sources(spark, sf_dir), PKEYS, as_of=as_of)


# --------------------------------------------------------------------------- #
# Prediction errors (NB004) on lineitem                                       #
# --------------------------------------------------------------------------- #
ERROR_TIE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
SEGMENT_FLAGS = ("has_rit", "has_illuminate", "has_milestone")
SEGMENT_NAMES = {"has_rit": "RIT", "has_illuminate": "ILL", "has_milestone": "MS"}
TARGETS = ("math", "verbal")


def prediction_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: actual and predicted scores of two targets,
    availability flags, error and absolute error."""
    from ..operators.stats import with_errors

    li = table(spark, sf_dir, "lineitem")
    base = li.select(
        *ERROR_TIE,
        (F.col("l_extendedprice") / F.lit(100.0)).alias("actual_sat_math_score"),
        F.rint(F.col("l_quantity") * F.lit(15.0)).alias("pred_sat_math_score"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) / F.lit(100.0)).alias("actual_sat_verbal_score"),
        F.rint(F.col("l_quantity") * F.lit(14.0)).alias("pred_sat_verbal_score"),
        (F.col("l_returnflag") == "R").alias("has_rit"),
        (F.col("l_linestatus") == "O").alias("has_illuminate"),
        (F.col("l_returnflag") == "N").alias("has_milestone"),
    )
    return with_errors(base, {"math": ("actual_sat_math_score", "pred_sat_math_score"),
                              "verbal": ("actual_sat_verbal_score", "pred_sat_verbal_score")})
