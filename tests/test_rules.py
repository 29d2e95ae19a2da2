"""Literal fixtures, one per semantic rule (FIXTURES.md §6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import scalars as X
from strata.operators import batches, cohort, joins, linkage, longitudinal, pages, records, snapshot, stats
from strata.operators.features import illuminate, milestone

KEYS = ["s", "y"]
ORDER = ["responsedatevalue", "tie"]


def ill_fact(spark, rows):
    """rows: (s, y, day, tie, subject, pct, std_pct, cond, grade)"""
    data = [(s, y, dt.date(2024, 1, d), t, sub, None if p is None else float(p), None if sp is None else float(sp),
             c, g, None if p is None else p / 2.0, 50.0) for (s, y, d, t, sub, p, sp, c, g) in rows]
    schema = ("s string, y string, responsedatevalue date, tie int, Standard_Subject string, "
              "Response_percent_correct double, Standard_percent_correct double, condition string, "
              "GradeLevelDuringUnitTest string, Response_points double, Response_points_possible double")
    return spark.createDataFrame(data, schema)


def feats(spark, rows):
    out = illuminate.illuminate_features(ill_fact(spark, rows), KEYS, ORDER)
    return {r["s"]: r for r in out.collect()}


def test_null_inside_numeric_list(spark):
    r = feats(spark, [("a", "1", 1, 1, "Math", 50, 50, None, "3"), ("a", "1", 2, 1, "Math", None, 50, None, "3"),
                      ("a", "1", 3, 1, "Math", 70, 50, None, "3")])["a"]
    assert r["mean_item_percent_correct"] == pytest.approx(60.0)
    assert r["last_percent_correct"] == 70.0
    assert r["slope_percent_correct_over_time"] == pytest.approx(20.0)
    assert r["num_items"] == 3


def test_sd_guard(spark):
    r = feats(spark, [("a", "1", 1, 1, "x", 1, 1, None, "1"), ("b", "1", 1, 1, "x", 1, 1, None, "1"),
                      ("b", "1", 2, 1, "x", 3, 1, None, "1")])
    assert r["a"]["std_item_percent_correct"] == 0.0
    assert r["b"]["std_item_percent_correct"] == pytest.approx(1.0)


def test_mode_first_seen_on_ties(spark):
    rows = [("a", "1", d, 1, "x", 10, 10, None, g) for d, g in zip(range(1, 6), ["3", "2", "2", "3", "K"])]
    r = feats(spark, rows)["a"]
    assert r["grade_mode_numeric"] == 3
    assert r["is_on_sat_grade_level"] == 0


def test_thresholds_include_both_ends(spark):
    rows = [("a", "1", d, 1, "x", 10, v, None, "1") for d, v in zip(range(1, 5), [80, 50, 49, 81])]
    r = feats(spark, rows)["a"]
    assert r["mastery_rate_above_80"] == 0.5
    assert r["low_mastery_rate_below_50"] == 0.5


def test_keyword_substring(spark):
    r = feats(spark, [("a", "1", 1, 1, "Related Arts", 10, 40, "Reteach", "1")])["a"]
    assert r["mean_std_pct_ela"] == 40.0  # "ela" inside "Related"
    assert r["verbal_percent_reteach"] == 1.0


def test_condition_tags_exclude_nulls(spark):
    r = feats(spark, [("a", "1", 1, 1, "x", 1, 1, "Extension", "1"), ("a", "1", 2, 1, "x", 1, 1, None, "1")])["a"]
    assert r["percent_extension"] == 1.0


def test_ties_in_dates_use_tie_break(spark):
    r = feats(spark, [("a", "1", 1, 2, "x", 90, 1, None, "1"), ("a", "1", 1, 1, "x", 10, 1, None, "1")])["a"]
    assert r["last_percent_correct"] == 90.0
    assert r["improvement_first_to_last"] == 80.0


def test_milestone_pairs_sorted_by_date(spark):
    data = [("a", "1", 20240103, 1, "Algebra I", 300.0, 3, 1.0), ("a", "1", 20240101, 1, "Algebra I", 100.0, 2, 1.0),
            ("a", "1", 20240102, 1, "American Literature", 200.0, 4, None)]
    df = spark.createDataFrame(data, "s string, y string, TestingDateId long, tie int, SubjectDesc string, "
                                     "ScaleScore double, AchievementLevel int, LexileScore double")
    r = milestone.milestone_features(df, KEYS, ["TestingDateId", "tie"]).collect()[0]
    assert r["scale_score_improvement_all"] == 200.0
    assert r["scale_score_slope_all"] == pytest.approx(100.0)
    assert r["scale_score_improvement_math"] == 200.0
    assert r["pct_proficient_all"] == pytest.approx(2 / 3)
    assert r["mean_lexile_score_all"] == 1.0
    assert r["num_unique_test_dates"] == 3


def test_snapshot_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, 5)], "k string, d int, v int")
    s = snapshot.snapshot(df, ["k"], ["d"], ["v"], "snap").collect()[0]["snap"]
    assert [(x["d"], x["v"]) for x in s] == [(1, 5), (2, None)]


def test_nest_unnest_identity(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, x string, y double")
    back = snapshot.unnest(snapshot.nest(df, "n", ["x", "y"]), "n")
    assert sorted(back.columns) == sorted(df.columns)
    assert back.select(*df.columns).collect() == df.collect()
    with pytest.raises(ValueError):
        snapshot.nest(df, "", ["x"])
    with pytest.raises(ValueError):
        snapshot.nest(df, "n", ["missing"], handle_missing="error")


def test_longitudinal_single_and_null(spark):
    df = spark.createDataFrame([("a", "2020", 5.0), ("a", "2021", None), ("b", "2020", 1.0)],
                               "s string, y string, f double")
    r = {x["s"]: x for x in longitudinal.longitudinal_features(df, "s", "y").collect()}
    assert r["a"]["f_latest"] is None and r["a"]["f_delta"] is None and r["a"]["f_slope"] is None
    assert r["b"]["f_delta"] == 0.0 and r["b"]["f_slope"] == 0.0 and r["b"]["num_snapshots"] == 1
    with pytest.raises(ValueError):
        longitudinal.longitudinal_features(df.drop("f"), "s", "y")


def test_slope_of_a_line(spark):
    df = spark.createDataFrame([("a", str(2000 + i), 3.0 + 2.5 * i) for i in range(6)], "s string, y string, f double")
    r = longitudinal.longitudinal_features(df, "s", "y").collect()[0]
    assert r["f_slope"] == pytest.approx(2.5)


def test_last_non_null(spark):
    df = spark.createDataFrame([("a", "2020", 5.0), ("a", "2021", None)], "s string, y string, v double")
    assert cohort.last_non_null(df, ["s"], "y", ["v"]).collect()[0]["v"] == 5.0


def test_cohort_cut(spark):
    rows = [("A", "10", True, True), ("A", "11", False, True), ("A", "12", False, True),
            ("B", "10", False, True), ("B", "11", True, True), ("B", "12", False, True)]
    df = spark.createDataFrame(rows, "s string, y string, sat boolean, ill boolean")
    out = cohort.cohort_until_event(df, "s", "y", F.col("sat"), [F.col("ill")])
    got = sorted((r["s"], r["y"]) for r in out.collect())
    assert got == [("A", "10"), ("B", "10"), ("B", "11")]


def test_null_key_match_and_outer_only_rows(spark):
    a = spark.createDataFrame([(None, 1, "2020-08-01"), ("x", 2, "2020-08-01")], "k string, a int, d string")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, b int")
    j = joins.full_outer_null_safe(a, b, ["k"])
    assert j.count() == 3
    kept = j.where(F.to_date("d") < F.lit("2026-01-01"))
    assert sorted((r["k"], r["b"]) for r in kept.collect() if r["k"] is None) == [(None, 10)]
    assert "LeftOuter" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_half_even(spark):
    r = spark.range(1).select(*[X.rint_int(F.lit(v)).alias(str(i)) for i, v in enumerate([0.5, 1.5, 2.5])]).collect()[0]
    assert list(r) == [0, 2, 2]


def test_quantile_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 8)], "combined_rmse double")
    lv = [r["uncertainty_level"] for r in stats.uncertainty_levels(df).orderBy("combined_rmse").collect()]
    assert lv == ["Low", "Low", "Low", "Low", "Medium", "High", "High"]


def test_qq_small_n(spark):
    df = spark.createDataFrame([("s", float(v), i) for i, v in enumerate([1, 5, 2, 8, 3, 9, 4])],
                               "g string, error_math double, t int")
    r = stats.qq_r2(df, ["g"], ["math"], ["t"]).collect()[0]
    assert r["math_qq_r2"] == 0.0 and r["math_qq_assessment"] == "Poor"


def test_inverse_normal(spark):
    from statistics import NormalDist

    ps = [0.01, 0.1, 0.3, 0.5, 0.77, 0.99, 1e-10]
    r = spark.range(1).select(*[X.inv_norm_cdf(F.lit(p)).alias(f"p{i}") for i, p in enumerate(ps)]).collect()[0]
    for i, p in enumerate(ps):
        assert r[f"p{i}"] == pytest.approx(NormalDist().inv_cdf(p), abs=1e-12)


def test_similarity(spark):
    df = spark.createDataFrame([("harvard university", "harvard univ"), ("kitten", "sitting"), ("abc", "xyz")],
                               "a string, b string")
    assert [r[0] for r in df.select(linkage.similarity_ratio("a", "b")).collect()] == [80, 62, 0]


def test_acceptance_tiers(spark):
    rows = [(1, False, False, True, 60, "u1"), (2, False, False, True, 61, "u2"), (3, False, False, False, 90, "u3"),
            (4, False, False, False, 91, "u4"), (5, False, False, False, None, "u5")]
    df = spark.createDataFrame(rows, "row_id int, Overall_Match boolean, Name_Match boolean, Location_Match boolean, "
                                     "Name_Similarity int, URL string").withColumns(
        {"Scraped_Name": F.lit("n"), "Scraped_Location": F.lit("l")})
    assert sorted(r["URL"] for r in linkage.link_accept(df).collect()) == ["u2", "u4"]


def test_batches(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "i int")
    b = [r["batch"] for r in batches.batches(df, 3, ["i"]).orderBy("i").collect()]
    assert b == [0, 0, 0, 1, 1, 2, 2]
    with pytest.raises(ValueError):
        batches.batches(df, 0, ["i"])


def test_malformed_json_list(spark):
    df = spark.createDataFrame([('[{"category":"x","items":["ok","bad:[{"]}, "bad:[{"]',)], "j string")
    r = df.select(records.keep_objects("j").alias("k")).collect()[0]["k"]
    assert len(r) == 1 and r[0]["category"] == "x"
    assert df.select(records.drop_malformed(F.array(F.lit("ok"), F.lit("bad:[{"))).alias("d")).collect()[0]["d"] == ["ok"]


def test_ratio_text(spark):
    df = spark.createDataFrame([("18:1",), ("0:1",), ("x:1",), (None,)], "r string")
    assert [r[0] for r in df.select(X.ratio_value("r")).collect()] == [18.0, None, None, None]


def test_slug(spark):
    df = spark.createDataFrame([("Swarthmore College",), ("",), ("Not Reported",)], "n string")
    assert [r[0] for r in df.select(X.slug("n")).collect()] == ["swarthmore-college", "unknown", "unknown"]


def test_year_text(spark):
    df = spark.createDataFrame([("AP 2023-24",), ("2019 file",), ("none",)], "t string")
    assert [r[0] for r in df.select(X.year_in_text("t")).collect()] == ["2023-24", "2019", None]


def test_grade_text(spark):
    df = spark.createDataFrame([("kk",), ("Pre-K",), ("09",), ("9.0",), ("13",), (" HS ",), (None,), ("9.7",)],
                               "g string")
    assert [r[0] for r in df.select(X.standard_grade("g")).collect()] == ["K", "PK", "9", "9", "13", "HS", None, "9"]


def test_dc_region(spark):
    df = spark.createDataFrame([("DC",)], "c string").select(X.state_name("c").alias("s"))
    r = df.select("s", X.region_of("s").alias("r")).collect()[0]
    assert (r["s"], r["r"]) == ("District of Columbia", "Other")


MAJORS_1 = """<section id="degrees"><table><tbody>
<tr><th>Stray</th><td><img alt="Checkmark"></td><td></td></tr>
<tr><th class="top-level">Arts</th></tr>
<tr><th>Music</th><td><img alt="Checkmark"></td><td></td></tr>
<tr><th>Dance</th><td></td><td><img alt="Checkmark"></td></tr>
<tr><th class="top-level">Science</th></tr>
<tr><th>Physics</th><td></td><td><img src="a.png" alt="Checkmark"></td></tr>
<tr><th>Chemistry</th><td><img alt="Checkmark"></td><td><img alt="Checkmark"></td></tr>
</tbody></table></section>"""
MAJORS_2 = """<table>
<tr><th>Stray</th><td><i class="check-teal"></i></td><td></td></tr>
<tr><th>Arts</th><td>Associate</td><td>Bachelors</td></tr>
<tr><th>Music</th><td><i class="check-teal"></i></td><td></td></tr>
</table>"""


def test_majors_table_layouts(spark):
    df = spark.createDataFrame([(1, MAJORS_1), (2, MAJORS_2)], "page_id long, html string")
    m1 = pages.majors_table(df.where("page_id = 1"), layout=1).collect()[0]["majors_and_degrees"]
    assert [c["category"] for c in m1] == ["Arts", "Science"]
    assert [(p["name"], p["offers_associate"], p["offers_bachelors"]) for p in m1[0]["programs"]] == \
        [("Music", True, False), ("Dance", False, True)]
    m2 = pages.majors_table(df.where("page_id = 2"), layout=2).collect()[0]["majors_and_degrees"]
    assert [c["category"] for c in m2] == [None, "Arts"]
    assert m2[0]["programs"][0]["name"] == "Stray"


CATALOGUE = """<table><tr><th>Data Category</th><th>Description</th><th>Files</th></tr>
<tr><td>Graduation Rate</td><td>Rates</td><td><a href="/f/grad_2023-24.csv">Grad 2023-24</a>
<a href="/f/readme.pdf">Readme</a></td></tr>
<tr><td>Old (Retired)</td><td>x</td><td><a href="/f/old.csv">Old 2019</a></td></tr></table>
<table><tr><td>Retired Reporting</td><td>x</td><td><a href="/f/r.csv">r</a></td></tr></table>"""


def test_catalogue_links(spark):
    df = spark.createDataFrame([(1, CATALOGUE)], "page_id long, html string")
    links = pages.catalogue_links(df).collect()
    assert [(r["category"], r["year"], r["filename"]) for r in links] == [("Graduation Rate", "2023-24", "grad_2023-24.csv")]
    paths = pages.target_paths(pages.catalogue_links(df)).collect()
    assert paths[0]["path"] == "graduation_rate/2023-24/grad_2023-24.csv"


def test_page_heading_fallbacks(spark):
    df = spark.createDataFrame([('<h1 class="mb-1 pr-3 pl-0 h3 text-white"> Name U </h1><title>T</title>',),
                                ("<title>Big U - Tuition and Acceptance Rate 2024</title>",), ("<p>x</p>",)], "h string")
    assert [r[0] for r in df.select(pages.page_heading("h")).collect()] == ["Name U", "Big U", "Unknown University"]


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_positions_keep_every_row_and_column(spark, reuse):
    """Against row_number, with payload columns, with and without groups."""
    from pyspark.sql import Window

    from strata.operators.batches import batches
    from strata.operators.ordering import group_positions

    orders = spark.read.parquet("/root/testdata/sf0.1/orders.parquet").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.pmod("o_custkey", F.lit(300)).alias("grp"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        for group in ([], ["grp"]):
            got = group_positions(orders, group, ["o_totalprice", "o_orderkey"], num_partitions=40)
            w = Window.partitionBy(*group).orderBy("o_totalprice", "o_orderkey")
            want = orders.withColumn("_pos", F.row_number().over(w) - 1)
            cols = [*orders.columns, "_pos"]
            assert got.count() == orders.count()
            assert got.select(*cols).exceptAll(want.select(*cols)).isEmpty()
        sizes = [r["count"] for r in batches(orders, 7, ["o_totalprice", "o_orderkey"]).groupBy("batch").count().collect()]
        assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_key_coverage_reaches_any_depth(spark):
    import json

    from strata.operators.records import coverage_report, json_key_coverage

    deep = {"a": {"b": {"c": [{"d": [[{"e": {"f": {"g": [3, 4]}}}]]}]}}, "majors": [{"programs": [{"name": "x"}, {"other": 1}]}],
            "tags": ["t1", "t2"], "none": None, "empty": [], "nothing": {}}
    df = spark.createDataFrame([(1, json.dumps(deep)), (2, '{"tags": ["t0"]}'), (3, None), (4, "not json"), (5, "[1]")], "id long, doc string")
    got = {r["path"]: (r["records"], r["samples"]) for r in json_key_coverage(df, "id", "doc").collect()}
    assert got == {
        "a": (1, ""), "a.b": (1, ""), "a.b.c": (1, ""), "a.b.c[0].d": (1, ""), "a.b.c[0].d[0][0].e": (1, ""),
        "a.b.c[0].d[0][0].e.f": (1, ""), "a.b.c[0].d[0][0].e.f.g": (1, "3"), "majors": (1, ""), "majors[0].programs": (1, ""),
        "majors[0].programs[0].name": (1, "x"), "tags": (2, "t0 | t1"), "none": (1, ""), "empty": (1, ""), "nothing": (1, "")}
    assert coverage_report(json_key_coverage(df, "id", "doc")).count() == len(got)
    assert json_key_coverage(df.limit(0), "id", "doc").collect() == []


def test_blank_texts_are_stripped_of_all_white_space(spark):
    r = spark.createDataFrame([("\t", "K\t")], "a string, g string").select(
        X.display("a").alias("a"), X.standard_grade("g").alias("g")).first()
    assert (r["a"], r["g"]) == ("Not Reported", "K")


def test_one_period_with_a_missing_value_has_slope_zero(spark):
    from strata.operators.longitudinal import longitudinal_features

    df = spark.createDataFrame([("a", 2020, None), ("b", 2020, 1.0), ("b", 2021, None)], "k string, y int, f double")
    got = {r["k"]: r["f_slope"] for r in longitudinal_features(df, "k", "y").collect()}
    assert got == {"a": 0.0, "b": None}


def test_trees_take_more_categories_than_the_default_bins(spark):
    from strata.operators.model import fit_regressors, predict

    df = spark.createDataFrame([(i, f"c{i % 40}", float(i % 40)) for i in range(200)], "k long, cat string, t double")
    model = fit_regressors(df, "k", ["t"], iterations=2, depth=3)
    got = predict(model, df, "k").join(df, "k")
    mean_error = df.select(F.stddev_pop("t")).first()[0]
    assert got.select(F.sqrt(F.avg((F.col("pred_t") - F.col("t")) ** 2))).first()[0] < mean_error


def test_table_profile_covers_every_kind_of_column(spark):
    from strata.operators.profiling import table_profile

    df = spark.sql("""SELECT * FROM VALUES (1, 'a', DATE'2020-01-01', true), (1, 'b', null, false), (0, 'b', DATE'2021-01-01', null),
                      (null, null, null, null) AS t(i, s, d, b)""")
    got = {r["column_name"]: r for r in table_profile(df).collect()}
    assert (got["i"]["n"], got["i"]["missing"], got["i"]["distinct_values"], got["i"]["zeros"], got["i"]["top_number"],
            got["i"]["top_count"]) == (3, 1, 2, 1, 1.0, 2)
    assert got["i"]["mean"] == pytest.approx(2 / 3) and got["i"]["std"] == pytest.approx(0.57735, abs=1e-5)
    assert (got["s"]["min_text"], got["s"]["top_text"], got["s"]["top_count"]) == ("a", "b", 2)
    assert (got["d"]["max_text"], got["d"]["top_text"], got["d"]["missing"]) == ("2021-01-01 00:00:00", "2020-01-01 00:00:00", 2)
    assert (got["b"]["distinct_values"], got["b"]["top_text"]) == (2, "false")
    assert {r["n"] for r in table_profile(df.limit(0)).collect()} <= {0}
