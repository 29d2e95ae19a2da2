"""University records built from the driver's tables (one record per customer).

Every field is a deterministic expression of the customer row, its nation and
its number of orders, so the DuckDB oracle can derive the expected flat
metadata with the same formulas.  Mixed-type lists (admission requirements,
campus security) are JSON text, as stored pages would deliver them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import constants as K
from ..sources.tables import table

CODES = sorted(K.STATE_NAMES) + ["ZZ"]
SPORT_NAMES = ["Basketball", "Volleyball", "Soccer", "Cross-country Running", "Track and Field",
               "Swimming And Diving", "Ice Hockey", "Fencing", "Golf", "Rowing", "Tennis", "Water Polo"]
REQUIREMENTS = {
    0: '[{"category": "Required", "items": ["Essay", "Transcript", "test_scores_accepted:[{"]}, '
       '"test_scores_accepted:[{", {"category": "Recommended", "items": ["Interview", "x\\":]}"]}]',
    1: '[{"category": "Required", "items": ["Essay"]}]',
    2: '["only a stray string"]',
}
SECURITY = {0: '["24-hour patrols", "Late-night transport"]', 1: '{"patrols": true}'}


def _mod(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(m))


def _d(c: Column) -> Column:
    return c.cast("double")


def records(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    base = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(o, c.c_custkey == o.o_custkey, "left")
    k = F.col("c_custkey")
    nk = F.col("c_nationkey")
    applied = F.col("n_orders") * 100
    rate = _mod(k, 90) + 5
    accepted = F.floor(applied * rate / 100).cast("bigint")
    f_app = F.floor(applied * (_mod(k, 60) + 20) / 100).cast("bigint")
    total_fac = (_mod(k, 500) + 20).cast("bigint")
    full = F.floor(total_fac * 2 / 3).cast("bigint")
    male = F.floor(total_fac / 2).cast("bigint")
    codes = F.array(*[F.lit(x) for x in CODES])
    sports = F.array(*[F.lit(x) for x in SPORT_NAMES])

    def sport(idx, scholarship, intramural):
        return F.struct(F.element_at(sports, (idx + 1).cast("int")).alias("sport"), intramural.alias("intramural"),
                        F.concat(F.lit("Division "), (_mod(k, 3) + 1).cast("string")).alias("intercollegiate"),
                        scholarship.alias("scholarship"))

    def case(col, mapping):
        out = F.lit(None).cast("string")
        for key, val in mapping.items():
            out = F.when(col == key, F.lit(val)).otherwise(out)
        return out

    prog = lambda name, a, b: F.struct(name.alias("name"), a.alias("offers_associate"), b.alias("offers_bachelors"))
    majors = F.when(_mod(k, 5) == 0, F.array().cast(
        "array<struct<category:string,programs:array<struct<name:string,offers_associate:boolean,offers_bachelors:boolean>>>>"
    )).otherwise(F.array(F.struct(F.col("c_mktsegment").alias("category"), F.array(
        prog(F.concat(F.lit("Program "), _mod(k, 7).cast("string")), _mod(k, 2) == 0, F.lit(True)),
        prog(F.concat(F.lit("Program "), (_mod(k, 7) + 1).cast("string")), F.lit(False), _mod(k, 3) == 0)
    ).alias("programs"))))

    def test(name, avg, p25, p75):
        return F.struct(F.lit(name).alias("test"), avg.alias("avg_score"), p25.alias("percentile_25"),
                        p75.alias("percentile_75"))

    tests = F.when(_mod(k, 5) == 0, F.array().cast(
        "array<struct<test:string,avg_score:double,percentile_25:double,percentile_75:double>>")).otherwise(F.array(
            test("SAT Critical Reading", _d(400 + _mod(k, 300)), _d(350 + _mod(k, 300)),
                 F.when(_mod(k, 6) != 0, _d(450 + _mod(k, 300)))),
            test("SAT Math", _d(420 + _mod(k, 280)), _d(370 + _mod(k, 280)), _d(470 + _mod(k, 280))),
            test("ACT Composite", _d(15 + _mod(k, 20)), _d(12 + _mod(k, 20)), _d(18 + _mod(k, 20)))))

    def cat_amount(cat, amount):
        return F.struct(cat.alias("category"), amount.alias("amount"))

    rec = base.select(
        F.concat(F.lit("https://example.com/college/"), k.cast("string")).alias("url"),
        F.col("c_name").alias("university_name"),
        F.struct(
            F.struct(F.concat(k.cast("string"), F.lit(" College Ave")).alias("street"),
                     F.col("n_name").alias("city"),
                     F.element_at(codes, (_mod(nk * 3, len(CODES)) + 1).cast("int")).alias("state"),
                     F.lpad(_mod(k, 100000).cast("string"), 5, "0").alias("zip_code"),
                     F.lit("United States").alias("country")).alias("address"),
            F.struct(F.when(_mod(k, 3) != 0, F.concat(F.lit("555-"), F.lpad(_mod(k, 10000).cast("string"), 4, "0")))
                     .alias("phone"), F.lit(None).cast("string").alias("fax"),
                     F.concat(F.lit("admissions"), k.cast("string"), F.lit("@example.edu")).alias("email"),
                     F.when(_mod(k, 2) == 0, F.concat(F.lit("Dean "), k.cast("string"))).alias("name"),
                     F.when(_mod(k, 4) == 0, F.lit("Director")).alias("title")).alias("contact"),
        ).alias("location_contact"),
        majors.alias("majors_and_degrees"),
        F.struct(
            F.struct(applied.alias("applied"), accepted.alias("accepted"), F.floor(accepted / 3).cast("bigint")
                     .alias("enrolled"), _d(rate).alias("acceptance_rate")).alias("overall"),
            F.when(applied.isNotNull(), F.struct(
                F.struct(f_app.alias("applied"), F.lit(None).cast("bigint").alias("accepted"),
                         _d(_mod(k, 50) + 10).alias("acceptance_rate")).alias("female"),
                F.struct((applied - f_app).alias("applied"), F.lit(None).cast("bigint").alias("accepted"),
                         F.lit(None).cast("double").alias("acceptance_rate")).alias("male"))).alias("by_gender"),
            F.struct(_d(_mod(k, 10) * 10).alias("application_fee"),
                     (F.lit(2.5) + _mod(k, 15) / F.lit(10.0)).alias("avg_high_school_gpa")).alias("applying"),
            case(_mod(k, 4), REQUIREMENTS).alias("requirements_json"),
            F.array(
                F.struct(F.lit("Fall freshmen").alias("type"),
                         F.when(_mod(k, 4) != 0, F.concat(F.lit("01-"), F.lpad((_mod(k, 28) + 1).cast("string"), 2, "0")))
                         .alias("application_closing"),
                         F.lit("04-01").alias("notification_date"), (_mod(k, 2) == 1).alias("rolling_admissions")),
                F.struct(F.lit("Early decision").alias("type"),
                         F.when(_mod(k, 3) != 0, F.lit("11-15")).alias("application_closing"),
                         F.lit(None).cast("string").alias("notification_date"),
                         F.lit(False).alias("rolling_admissions"))).alias("application_deadlines"),
            tests.alias("test_scores_accepted"),
        ).alias("admissions"),
        F.struct(
            F.array(cat_amount(F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Private")).otherwise(F.lit("In-state")),
                               F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * F.lit(3.0))),
                    cat_amount(F.lit("Out-of-state"), _d(20000 + _mod(k, 10000)))).alias("tuition"),
            F.array(cat_amount(F.lit("Room & board"), _d(8000 + _mod(k, 3000))),
                    cat_amount(F.lit("Full-time student fees"), F.when(_mod(k, 2) != 0, _d(500 + _mod(k, 500)))))
            .alias("fees"),
            F.when(_mod(k, 4) == 0, F.lit("Installment plans")).when(_mod(k, 4) == 1, F.lit(" "))
            .alias("other_payment_considerations"),
        ).alias("tuition_and_fees"),
        F.struct(
            F.struct(_d(10000 + _mod(k, 5000)).alias("avg_financial_aid_package"),
                     F.when(_mod(k, 3) != 0, _d(9000 + _mod(k, 4000))).alias("avg_freshman_financial_aid_package"),
                     F.lit(None).cast("double").alias("avg_international_financial_aid_package")).alias("package_stats"),
            F.struct(_d(5000 + _mod(k, 2000)).alias("avg_loan_aid"), _d(6000 + _mod(k, 3000)).alias("avg_grant_aid"),
                     _d(7000 + _mod(k, 3500)).alias("avg_scholarship_and_grant_aid_awarded")).alias("amounts"),
            F.struct(_d(_mod(k, 100)).alias("percentage_need_receive_financial_aid"),
                     _d(50 + _mod(k, 50)).alias("avg_percentage_of_financial_need_met"),
                     F.when(_mod(k, 4) != 0, _d(_mod(k, 30))).alias("percentage_students_need_fully_met"))
            .alias("coverage_stats"),
        ).alias("financial_aid"),
        F.struct(
            F.array(sport(_mod(k, 12), _mod(k, 2) == 0, _mod(k, 3) == 0),
                    sport(_mod(k * 7, 12), F.lit(False), F.lit(True))).alias("Men's Sports"),
            F.when(_mod(k, 6) != 0, F.array(sport(_mod(k * 5, 12), F.lit(False), F.lit(False))))
            .otherwise(F.array().cast("array<struct<sport:string,intramural:boolean,intercollegiate:string,"
                                      "scholarship:boolean>>")).alias("Women's Sports"),
        ).alias("athletics"),
        F.struct(
            F.struct((_mod(k, 3) != 0).alias("college_owned_housing"), (_mod(k, 2) == 0).alias("housing_requirements"),
                     F.when(_mod(k, 4) != 0, F.array(F.lit("Co-ed dorms"), F.lit("Apartments")))
                     .otherwise(F.array().cast("array<string>")).alias("housing_options"),
                     F.when(_mod(k, 7) != 0, _d(_mod(k, 100))).alias("percent_undergrads_in_college_housing"))
            .alias("housing"),
            case(_mod(k, 2), SECURITY).alias("campus_security_and_safety_json"),
        ).alias("campus_life"),
        F.struct(total_fac.alias("total_faculty"),
                 F.when(_mod(k, 7) == 0, F.lit("0:1")).when(_mod(k, 7) == 1, F.lit("x:1"))
                 .when(_mod(k, 7) == 2, F.lit(None).cast("string"))
                 .otherwise(F.concat((_mod(k, 20) + 5).cast("string"), F.lit(":1"))).alias("student_faculty_ratio"),
                 F.struct(full.alias("full_time"), (total_fac - full).alias("part_time")).alias("employment"),
                 F.struct(male.alias("male"), (total_fac - male).alias("female")).alias("gender")).alias("faculty"),
        k.alias("ordinal"),
    )
    return rec


CAMPUS_SECURITY = {0: '["24-hour patrols", "Late-night transport"]', 1: '{"patrols": true, "student_patrols": true}', 2: "[]",
                   3: '{"emergency_services": "yes", "patrols": false, "transport_services": "Until midnight", '
                      '"other_security": " Cameras "}'}


def with_campus_life(rec):
    """Records with every part of campus life present in some rows and absent in others; some records
    have no campus life, or no athletics, at all."""
    k = F.col("ordinal")

    def texts(cond, *values):
        return F.when(cond, F.array(*[F.lit(v) for v in values]))

    body = F.struct(
        F.when(_mod(k, 5) != 0, (_mod(k, 9000) + 100).cast("bigint")).alias("total_undergrad_students"),
        F.when(_mod(k, 4) != 0, _d(_mod(k, 30))).alias("international_students_percentage"),
        F.when(_mod(k, 6) != 0, _d(_mod(k, 60))).alias("out_of_state_students_percentage"),
        F.when(_mod(k, 2) == 0, F.struct(_d(_mod(k, 100)).alias("male"),
                                         F.when(_mod(k, 8) != 0, _d(F.lit(100) - _mod(k, 100))).alias("female")))
        .alias("gender_distribution"))
    none = F.array().cast("array<string>")
    security = F.lit(None).cast("string")
    for i, v in CAMPUS_SECURITY.items():
        security = F.when(_mod(k, 5) == i, F.lit(v)).otherwise(security)
    life = F.struct(
        F.col("campus_life.housing").alias("housing"), F.when(_mod(k, 3) != 2, body).alias("student_body"),
        F.when(_mod(k, 3) == 0, none).otherwise(texts(_mod(k, 3) == 1, "Band", "Choir")).alias("student_activities"),
        F.coalesce(texts(_mod(k, 4) != 0, "Health service"), none).alias("student_services"),
        texts(_mod(k, 5) != 0, "Chess, and go", "Debate").alias("student_organizations"),
        texts(_mod(k, 4) == 1, "Zeta", "Alpha").alias("most_popular_organizations"),
        texts(_mod(k, 5) == 1, "Homecoming").alias("campus_events"), security.alias("campus_security_and_safety_json"))
    return rec.withColumns({"campus_life": F.when(_mod(k, 11) != 0, life),
                            "athletics": F.when(_mod(k, 13) != 0, F.col("athletics"))})
