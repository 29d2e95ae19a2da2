"""Campus life and completeness sections of the rendered documents."""

import json

import pytest
from pyspark.sql import functions as F

from strata.operators import records as R


@pytest.mark.parametrize("value, lines", [
    (["b", "a"], ["- b", "- a"]), ([], ["- Not Reported"]), (None, ["- Not Reported"]), ({}, ["- Not Reported"]), ("text", ["- Not Reported"]),
    ({"patrols": "yes", "emergency_services": True}, ["- Emergency services: Yes", "- Patrols: Yes"]),
    ({"student_patrols": True, "dormitory_entrances": "no"}, ["- Not Reported"]),
    ({"transport_services": "  until 2 ", "patrols": "", "other_security": None}, ["- Transport services: until 2"]),
    ({"other_security": 5, "patrols": False}, ["- Patrols: No", "- Additional security: 5"]),
    (["a", None, 3], ["- a", "- 3"]),
])
def test_security_is_a_list_or_an_object(spark, value, lines):
    df = spark.createDataFrame([(None if value is None else json.dumps(value),)], "j string")
    assert df.select(R.security_lines(F.col("j"))).first()[0].split("\n") == lines


def test_text_that_is_not_json_is_not_reported(spark):
    df = spark.createDataFrame([("{oops",)], "j string")
    assert df.select(R.security_lines(F.col("j"))).first()[0] == "- Not Reported"


@pytest.mark.parametrize("kind, there, absent", [
    ("string", "x", ""), ("bigint", 1, 0), ("double", .5, 0.0), ("boolean", True, False), ("array<string>", ["a"], []),
    ("struct<a:string,b:bigint>", ("x", None), (None, None)),
])
def test_present(spark, kind, there, absent):
    df = spark.createDataFrame([(1, there), (2, absent), (3, None)], f"i int, c {kind}")
    got = df.select("i", R.present(F.col("c"), df.schema["c"].dataType).alias("p")).collect()
    assert {r["i"]: r["p"] for r in got} == {1: True, 2: False, 3: False}


SCHEMA = (
    "location_contact struct<address:struct<city:string>>, majors_and_degrees array<string>, admissions struct<overall:struct<applied:bigint>,"
    "requirements:array<string>>, campus_life struct<student_services:array<string>,campus_security_and_safety_json:string>,"
    "athletics struct<`Men's Sports`:array<string>>")


def test_completeness_orders_what_is_there_first(spark):
    full = ((("x",),), ["m"], ((5,), ["r"]), (["s"], "[ ]"), (["a", "b"],))
    none = (None, [], None, None, None)
    df = spark.createDataFrame([full, none], SCHEMA)
    a, b = (r[0].split("\n") for r in df.select(R.completeness_md(df.schema)).collect())
    assert a[4:10] == ["✅ Location and Contact Information", "✅ Academic Information", "✅ Admissions Information",
                       "✅ Campus Life Information", "✅ Athletics Information", "❌ Tuition and Financial Aid"]
    assert "- Student Services: ✅" in a and "- Campus Security: ❌" in a and "- Campus Events: ❌" in a
    assert "- Men's Sports: ✅ (2 sports)" in a and "- Women's Sports: ❌ (0 sports)" in a and "- Overall Statistics: ✅" in a
    assert all(x.startswith("❌") for x in b[4:10]) and not any("Details" in x for x in b)


def test_campus_life_without_any_data(spark):
    df = spark.createDataFrame([(None,)], "campus_life struct<housing:struct<college_owned_housing:boolean>>")
    lines = df.select(R.campus_life_md(df.schema["campus_life"].dataType)).first()[0].split("\n")
    assert lines[:5] == ["## Campus Life", "", "### Housing", "", "- **College-Owned Housing Available:** Not Reported"]
    assert "### Student Body" not in lines and "### Campus Events" not in lines and lines.count("- Not Reported") == 4
