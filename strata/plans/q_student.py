"""Queries of the student pipeline: profile, snapshots, registry, longitudinal,
cohort, targets, joins and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cohort, coverage, joins, longitudinal, snapshot
from ..operators.features import illuminate, milestone, rit, student
from ..operators.features.registry import FeatureSet
from ..sources.tables import table
from . import bindings as B
from . import oracle_views as V
from .catalog import finish, r6, register
from .q_features import _illuminate_sql, _milestone_sql, _rit_sql, all_features

K = B.STUDENT
P = "SchoolYearNumberFall"
SOURCES = ("grad", "milestone", "illuminate", "sat", "rit")


def flat_profile(spark, sf_dir):
    prof = B.student_profile(spark, sf_dir)
    sat = F.col("sat")
    return prof.select(
        K, P, "SchoolDetailFCSId", "SchoolDetailFCSIdNextYear", "GradeLevel", "RetainedFlag",
        "ActiveGiftedStudentResultRecordFlag", "CurrentEnrollment", "OrderStatus", "n_orders",
        "FirstDayOfSchoolYear", "n_grad",
        F.when(sat.isNotNull(), F.size(sat)).cast("bigint").alias("sat_n"),
        snapshot.last_item(sat).getField("MathScore").alias("sat_math_score"),
        snapshot.last_item(sat).getField("VerbalScore").alias("sat_verbal_score"),
        F.array_join(F.transform(snapshot.values_in_order(sat, "MathScore"),
                                 lambda x: x.cast("bigint").cast("string")), ",").alias("sat_math_values"),
        "n_illuminate", "n_milestone", "n_rit")


def _present():
    return {
        "grad": F.col("n_grad").isNotNull(), "milestone": F.col("n_milestone").isNotNull(),
        "illuminate": F.col("n_illuminate").isNotNull(), "sat": F.col("sat_n").isNotNull(),
        "rit": F.col("n_rit").isNotNull(),
    }


# --------------------------------------------------------------------------- #
@register("profile_full_outer", sql=f"SELECT * FROM ({V.PROFILE}) p",
          ops="M11, J1, J4, P9, S4 (null keys), A1 nested SAT list")
def profile_full_outer(spark, sf_dir):
    return finish(flat_profile(spark, sf_dir))


@register("features_registry", sql=f"""
SELECT mask_studentpersonkey, SchoolYearNumberFall AS SchoolYearFall, GradeLevel,
       CASE WHEN ActiveGiftedStudentResultRecordFlag IN ('Y', 'D') THEN ActiveGiftedStudentResultRecordFlag
            ELSE 'N' END AS is_gifted,
       RetainedFlag, {r6('sat_math_score')} AS sat_math_score, {r6('sat_verbal_score')} AS sat_verbal_score
FROM ({V.PROFILE}) p""", ops="C1-C7, F1-F6, X5, N6")
def features_registry(spark, sf_dir):
    prof = B.student_profile(spark, sf_dir)
    return finish(FeatureSet(student.row_features()).transform(prof))


@register("snapshot_lists", sql=f"""
SELECT mask_studentpersonkey, SchoolYearFall,
       CAST(count(*) AS BIGINT) AS n_items,
       {r6('arg_min(MathScore, struct_pack(d := TestingDateId, o := o_orderkey))')} AS first_math,
       {r6('arg_max(MathScore, struct_pack(d := TestingDateId, o := o_orderkey))')} AS last_math,
       string_agg(CAST(CAST(MathScore AS BIGINT) AS VARCHAR), ',' ORDER BY TestingDateId, o_orderkey) AS math_values,
       string_agg(CAST(CAST(VerbalScore AS BIGINT) AS VARCHAR), ',' ORDER BY TestingDateId, o_orderkey) AS verbal_values
FROM ({V.SAT}) x GROUP BY ALL""", ops="A1, A2, N1, N2, N5, N6")
def snapshot_lists(spark, sf_dir):
    sat = B.sat_fact(spark, sf_dir)
    snap = snapshot.snapshot(sat, B.KEYS, ["TestingDateId", "o_orderkey"], ["MathScore", "VerbalScore"], "sat")
    nested = snapshot.nest(snap, "key", list(B.KEYS))
    flat = snapshot.unnest(nested, "key")
    s = F.col("sat")

    def joined(field):
        return F.array_join(F.transform(snapshot.values_in_order(s, field),
                                        lambda x: x.cast("bigint").cast("string")), ",")

    return finish(flat.select(
        *B.KEYS, F.size(s).cast("bigint").alias("n_items"),
        snapshot.first_item(s).getField("MathScore").alias("first_math"),
        snapshot.last_item(s).getField("MathScore").alias("last_math"),
        joined("MathScore").alias("math_values"), joined("VerbalScore").alias("verbal_values")))


# --------------------------------------------------------------------------- #
def _longitudinal_sql() -> str:
    names = [n for m in (illuminate, milestone, rit) for f in m.features_of(m) for n, _ in f.schema]
    ints = {"num_items", "num_assessments", "grade_mode_numeric", "is_on_sat_grade_level",
            "num_subjects_tested", "num_unique_test_dates", "num_test_days", "num_tests"}
    ints |= {n for n in names if n.startswith("count_quintile_")}
    cols = []
    for n in names:
        last = f"max(CASE WHEN rd = 1 THEN {n} END)"
        first = f"max(CASE WHEN i = 0 THEN {n} END)"
        if n in ints:
            cols.append(f"CAST({last} AS BIGINT) AS {n}_latest")
        else:
            cols.append(f"{r6(last)} AS {n}_latest")
    for n in ("GradeLevel", "is_gifted", "RetainedFlag"):
        cols.append(f"max(CASE WHEN rd = 1 THEN {n} END) AS {n}_latest")
    for n in names:
        last = f"max(CASE WHEN rd = 1 THEN {n} END)"
        first = f"max(CASE WHEN i = 0 THEN {n} END)"
        cols.append(f"CAST({last} - {first} AS BIGINT) AS {n}_delta" if n in ints
                    else f"{r6(f'{last} - {first}')} AS {n}_delta")
    for n in names:
        nd = "CAST(count(*) AS DOUBLE)"
        si = f"({nd} * ({nd} - 1) / 2)"
        sii = f"(({nd} - 1) * {nd} * (2 * {nd} - 1) / 6)"
        den = f"({nd} * {sii} - {si} * {si})"
        y = f"CAST({n} AS DOUBLE)"
        expr = (f"CASE WHEN count(*) < 2 THEN 0.0 WHEN count({n}) < count(*) THEN NULL WHEN {den} = 0 THEN 0.0 "
                f"ELSE ({nd} * sum(i * {y}) - {si} * sum({y})) / {den} END")
        cols.append(f"{r6(expr)} AS {n}_slope")
    sel = ",\n  ".join(cols)
    return f"""
WITH feat AS (SELECT * FROM ({_illuminate_sql(rounded=False)}) x
  FULL JOIN ({_milestone_sql(rounded=False)}) y USING (mask_studentpersonkey, SchoolYearFall)
  FULL JOIN ({_rit_sql(rounded=False)}) z USING (mask_studentpersonkey, SchoolYearFall)
  LEFT JOIN (SELECT mask_studentpersonkey, SchoolYearNumberFall AS SchoolYearFall, GradeLevel, RetainedFlag,
               coalesce(ActiveGiftedStudentResultRecordFlag, 'N') AS is_gifted FROM ({V.ENROL}) e0) s
    USING (mask_studentpersonkey, SchoolYearFall)),
r AS (SELECT *, row_number() OVER (PARTITION BY mask_studentpersonkey ORDER BY SchoolYearFall) - 1 AS i,
             row_number() OVER (PARTITION BY mask_studentpersonkey ORDER BY SchoolYearFall DESC) AS rd
      FROM feat)
SELECT mask_studentpersonkey,
  {sel},
  CAST(count(*) AS BIGINT) AS num_snapshots
FROM r GROUP BY mask_studentpersonkey
"""


@register("longitudinal_wide", sql=_longitudinal_sql(), ops="W3-W6 over the student, Illuminate, Milestone and RIT features")
def longitudinal_wide(spark, sf_dir):
    return finish(longitudinal.longitudinal_features(all_features(spark, sf_dir), B.STUDENT, B.YEAR))


@register("feature_matrix", sql=f"""
SELECT mask_studentpersonkey, SchoolYearNumberFall, GradeLevel, coalesce(ActiveGiftedStudentResultRecordFlag, 'N') AS is_gifted,
       {r6('sat_math_score')} AS sat_math_score, {r6('sat_verbal_score')} AS sat_verbal_score
FROM ({V.PROFILE}) p""", ops="F2, F4 (two groups of raw values, each of its own type)")
def feature_matrix(spark, sf_dir):
    from ..operators.features.registry import features

    @features([("sat_math_score", float), ("sat_verbal_score", float)], stage="post")
    def sat_scores(c):
        return [F.try_element_at(c.sat[name], F.lit(-1)) for name in ("MathScore", "VerbalScore")]

    sets = FeatureSet([student.get_student_grade_level, student.is_gifted], [sat_scores])
    return finish(sets.to_matrix(B.student_profile(spark, sf_dir), [K, P]).select(K, P, "group_0.*", "group_1.*"))


# --------------------------------------------------------------------------- #
@register("cohort_until_event", sql=f"""
WITH p AS ({V.PROFILE}),
a AS (SELECT *, min(CASE WHEN sat_n IS NOT NULL THEN SchoolYearNumberFall END)
                    OVER (PARTITION BY mask_studentpersonkey) AS first_event FROM p),
b AS (SELECT * FROM a WHERE SchoolYearNumberFall <= first_event),
c AS (SELECT *, max(SchoolYearNumberFall) OVER (PARTITION BY mask_studentpersonkey) AS latest FROM b),
d AS (SELECT *, bool_or(SchoolYearNumberFall = latest AND (n_illuminate IS NOT NULL OR n_milestone IS NOT NULL
                                                          OR n_rit IS NOT NULL))
                    OVER (PARTITION BY mask_studentpersonkey) AS keep FROM c)
SELECT mask_studentpersonkey, SchoolYearNumberFall, GradeLevel, sat_n FROM d WHERE keep""",
          ops="M1, J7, J8, P10")
def cohort_until_event(spark, sf_dir):
    prof = flat_profile(spark, sf_dir)
    out = cohort.cohort_until_event(
        prof, K, P, F.col("sat_n").isNotNull(),
        [F.col("n_illuminate").isNotNull(), F.col("n_milestone").isNotNull(), F.col("n_rit").isNotNull()])
    return out.select(K, P, "GradeLevel", "sat_n")


@register("target_last_nonnull", sql=f"""
SELECT mask_studentpersonkey,
       {r6('arg_max(sat_math_score, SchoolYearNumberFall) FILTER (WHERE sat_math_score IS NOT NULL)')} AS sat_math_score,
       {r6('arg_max(sat_verbal_score, SchoolYearNumberFall) FILTER (WHERE sat_verbal_score IS NOT NULL)')} AS sat_verbal_score
FROM ({V.PROFILE}) p GROUP BY mask_studentpersonkey""", ops="A8, M2")
def target_last_nonnull(spark, sf_dir):
    prof = flat_profile(spark, sf_dir)
    return finish(cohort.last_non_null(prof, [K], P, ["sat_math_score", "sat_verbal_score"]))


@register("sat_latest_previous", sql=f"""
WITH s AS (SELECT mask_studentpersonkey, SchoolYearNumberFall, sat_math_score, sat_verbal_score,
                  row_number() OVER (PARTITION BY mask_studentpersonkey ORDER BY SchoolYearNumberFall DESC) AS rk
           FROM ({V.PROFILE}) p WHERE sat_math_score IS NOT NULL OR sat_verbal_score IS NOT NULL)
SELECT c.mask_studentpersonkey,
       coalesce(c.SchoolYearNumberFall, '-1') AS latest_SchoolYearNumberFall,
       {r6('coalesce(c.sat_math_score, -1)')} AS sat_math_score,
       {r6('coalesce(c.sat_verbal_score, -1)')} AS sat_verbal_score,
       coalesce(v.SchoolYearNumberFall, '-1') AS previous_SchoolYearNumberFall,
       {r6('coalesce(v.sat_math_score, -1)')} AS previous_sat_math_score,
       {r6('coalesce(v.sat_verbal_score, -1)')} AS previous_sat_verbal_score
FROM s c LEFT JOIN s v ON c.mask_studentpersonkey = v.mask_studentpersonkey AND v.rk = 2
WHERE c.rk = 1""", ops="M9, P14")
def sat_latest_previous(spark, sf_dir):
    prof = flat_profile(spark, sf_dir)
    return finish(cohort.latest_and_previous(prof, K, P, ["sat_math_score", "sat_verbal_score"], fill=-1))


# --------------------------------------------------------------------------- #
@register("dim_joins_two_roles", sql=f"""
SELECT e.mask_studentpersonkey, e.SchoolYearNumberFall, n.n_name AS school_name,
       r.r_name AS school_region, nx.n_name AS school_name_next
FROM ({V.ENROL}) e
LEFT JOIN nation n ON e.SchoolDetailFCSId = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN nation nx ON e.SchoolDetailFCSIdNextYear = nx.n_nationkey""", ops="J1, J2, J3, P3")
def dim_joins_two_roles(spark, sf_dir):
    e = B.enrolment(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("SchoolDetailFCSId"), "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    out = joins.left_join(e, nation, on=["SchoolDetailFCSId"], validate="m:1")
    out = joins.left_join(out, region, on=["n_regionkey"], validate="m:1")
    out = joins.join_role(out, nation.select("SchoolDetailFCSId", "n_name"), "SchoolDetailFCSIdNextYear",
                          "SchoolDetailFCSId", "_next")
    return out.select(K, P, F.col("n_name").alias("school_name"), F.col("r_name").alias("school_region"),
                      F.col("n_name_next").alias("school_name_next"))


@register("semi_join_members", sql=f"""
WITH p AS ({V.PROFILE})
SELECT mask_studentpersonkey, SchoolYearNumberFall, GradeLevel FROM p
WHERE mask_studentpersonkey IN (SELECT mask_studentpersonkey FROM p WHERE CurrentEnrollment = 'Y')
  AND GradeLevel IN ('9', '10', '11', '12')""", ops="J5, P7, P8, M8")
def semi_join_members(spark, sf_dir):
    prof = flat_profile(spark, sf_dir)
    cur = prof.where(F.col("CurrentEnrollment") == "Y")
    out = joins.semi(prof, cur, [K]).where(F.col("GradeLevel").isin("9", "10", "11", "12"))
    return out.select(K, P, "GradeLevel")


# --------------------------------------------------------------------------- #
def _coverage_matrix_sql() -> str:
    pres = {"grad": "n_grad", "milestone": "n_milestone", "illuminate": "n_illuminate", "sat": "sat_n",
            "rit": "n_rit"}
    per = ", ".join(f"count_if({c} IS NOT NULL) AS r_{n}" for n, c in pres.items())
    tot = ", ".join(
        f"sum(r_{n}) AS {n}_r, count_if(r_{n} > 0) AS {n}_e, sum(CASE WHEN cur THEN r_{n} ELSE 0 END) AS {n}_cr, "
        f"count_if(cur AND r_{n} > 0) AS {n}_ce" for n in pres)

    def pct(a, b):
        return r6(f"coalesce(CAST({a} AS DOUBLE) * CAST(100.0 AS DOUBLE) / nullif({b}, 0), 0.0)")

    parts = [f"""SELECT '{n}' AS source, CAST({n}_r AS BIGINT) AS records, {pct(f'{n}_r', 'tr')} AS records_pct,
  CAST({n}_e AS BIGINT) AS entities, {pct(f'{n}_e', 'te')} AS entities_pct,
  CAST({n}_cr AS BIGINT) AS current_records, {pct(f'{n}_cr', 'cr')} AS current_records_pct,
  CAST({n}_ce AS BIGINT) AS current_entities, {pct(f'{n}_ce', 'ce')} AS current_entities_pct FROM tot"""
             for n in pres]
    return f"""
WITH p AS ({V.PROFILE}),
per AS (SELECT mask_studentpersonkey, count(*) AS records, bool_or(CurrentEnrollment = 'Y') AS cur, {per}
        FROM p GROUP BY mask_studentpersonkey),
tot AS (SELECT sum(records) AS tr, count(*) AS te, sum(CASE WHEN cur THEN records ELSE 0 END) AS cr,
               count_if(cur) AS ce, {tot} FROM per)
{' UNION ALL '.join(parts)}
"""


@register("coverage_matrix", sql=_coverage_matrix_sql(), ops="A4, A13")
def coverage_matrix(spark, sf_dir):
    prof = flat_profile(spark, sf_dir)
    return finish(coverage.coverage_matrix(prof, K, _present(), F.col("CurrentEnrollment") == "Y"))


def _coverage_subsets_sql() -> str:
    pres = {"grad": "n_grad", "milestone": "n_milestone", "illuminate": "n_illuminate", "sat": "sat_n",
            "rit": "n_rit"}
    combos = coverage.combinations("sat", ["grad", "milestone", "illuminate", "rit"])
    parts = []
    for i, (label, cols) in enumerate(combos):
        cond = " AND ".join(f"{pres[c]} IS NOT NULL" for c in cols)
        parts.append(f"""SELECT {i} AS combo_id, '{label}' AS combination, {len(cols)} AS n_sources,
  CAST(count(DISTINCT CASE WHEN {cond} THEN mask_studentpersonkey END) AS BIGINT) AS entities,
  CAST(count(DISTINCT CASE WHEN {cond} AND cur THEN mask_studentpersonkey END) AS BIGINT) AS current_entities
FROM pc""")
    return f"""
WITH p AS ({V.PROFILE}),
pc AS (SELECT *, bool_or(CurrentEnrollment = 'Y') OVER (PARTITION BY mask_studentpersonkey) AS cur FROM p)
{' UNION ALL '.join(parts)}
"""


@register("coverage_subsets", sql=_coverage_subsets_sql(), ops="A14")
def coverage_subsets(spark, sf_dir):
    prof = flat_profile(spark, sf_dir)
    combos = coverage.combinations("sat", ["grad", "milestone", "illuminate", "rit"])
    out = coverage.coverage_subsets(prof, K, _present(), combos, F.col("CurrentEnrollment") == "Y")
    return out.select("combo_id", "combination", "n_sources",
                      F.col("entities").cast("bigint").alias("entities"),
                      F.col("current_entities").cast("bigint").alias("current_entities"))
