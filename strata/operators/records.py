"""Nested university records: unwrap, clean, flatten, render (D1-D12, D18,
N8-N12, X3, X4, X11, X12, X16, X21, X22, Q1).

Records are ``StructType`` rows; the one mixed-type list (admission
requirements, objects mixed with stray strings) is carried as JSON text and
handled with ``VARIANT``.  Everything is row-local: no operator here shuffles
except the key-coverage profile, which aggregates per JSON path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..session import cut_lineage
from ..functions.scalars import (display, display_bool, display_list, record_id, region_of, slug, state_name,
                                 with_prefix)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- #
# Envelope and cleaning (D1, D2, D3, N8, N9, X3)                              #
# --------------------------------------------------------------------------- #
def unwrap(envelopes: DataFrame) -> DataFrame:
    """Keep pages with a ``json`` record; ``url`` = ``metadata.sourceURL``."""
    ok = envelopes.where(F.col("json").isNotNull())
    return ok.select(F.col("metadata.sourceURL").alias("url"), "json.*")


def failed_pages(envelopes: DataFrame) -> DataFrame:
    """Pages without a ``json`` record, with their source URL."""
    return envelopes.where(F.col("json").isNull() & F.col("metadata.sourceURL").isNotNull()).select(
        F.col("metadata.sourceURL").alias("url"), F.col("metadata.error").alias("error"))


def drop_malformed(arr, patterns: Sequence[str] = K.MALFORMED_PATTERNS) -> Column:
    """Remove strings that look like broken JSON from a string array."""
    def bad(x):
        cond = F.lit(False)
        for p in patterns:
            cond = cond | F.contains(x, F.lit(p))
        return cond
    return F.filter(_c(arr), lambda x: ~bad(x))


def keep_objects(json_text) -> Column:
    """From a JSON list mixing objects and strings keep only the objects,
    as ``array<struct<category, items: array<string>>>``."""
    raw = F.try_variant_get(F.try_parse_json(_c(json_text)), "$", "array<variant>")
    kept = F.filter(raw, lambda x: F.startswith(F.schema_of_variant(x), F.lit("OBJECT")))
    return F.transform(kept, lambda x: F.struct(
        F.try_variant_get(x, "$.category", "string").alias("category"),
        F.coalesce(F.try_variant_get(x, "$.items", "array<string>"), F.array().cast("array<string>")).alias("items")))


def clean_records(records: DataFrame) -> DataFrame:
    """D3: requirements -> objects only, malformed list strings removed (N8,
    N9), state code -> state name (X3); counts of removed items per record."""
    req_json = F.col("admissions.requirements_json")
    req_raw = F.try_variant_get(F.try_parse_json(req_json), "$", "array<variant>")
    as_struct = keep_objects(req_json)
    cleaned = F.transform(as_struct, lambda s: F.struct(s["category"].alias("category"),
                                                        drop_malformed(s["items"]).alias("items")))
    n_items_before = F.aggregate(as_struct, F.lit(0), lambda acc, s: acc + F.size(s["items"]))
    n_items_after = F.aggregate(cleaned, F.lit(0), lambda acc, s: acc + F.size(s["items"]))
    adm = F.col("admissions").withField("requirements", cleaned).dropFields("requirements_json")
    loc = F.col("location_contact").withField("address.state", state_name(F.col("location_contact.address.state")))
    out = records.withColumns({
        "admissions": adm, "location_contact": loc,
        "removed_non_objects": F.coalesce(F.size(req_raw) - F.size(as_struct), F.lit(0)),
        "removed_malformed_items": F.coalesce(n_items_before - n_items_after, F.lit(0)),
    })
    return out


# --------------------------------------------------------------------------- #
# Flat metadata (D4-D11)                                                      #
# --------------------------------------------------------------------------- #
def _pick(arr: Column, tag_field: str, tag: str, value_field: str) -> Column:
    """Value of the last item whose tag equals ``tag`` and value is set."""
    hit = F.filter(arr, lambda x: (x[tag_field] == F.lit(tag)) & x[value_field].isNotNull())
    return F.try_element_at(hit, F.lit(-1))[value_field]


def identity_columns() -> list[Column]:
    """D4."""
    st = F.col("location_contact.address.state")
    return [F.col("url"), F.col("university_name"), st.alias("state"),
            F.col("location_contact.address.city").alias("city"),
            F.col("location_contact.address.zip_code").alias("zip_code"),
            F.col("location_contact.address.country").alias("country"),
            F.when(st.isNotNull() & (st != ""), region_of(st)).alias("region")]


def admissions_columns() -> list[Column]:
    """D5."""
    adm = F.col("admissions")
    dl = F.coalesce(adm["application_deadlines"], F.array())
    typ = lambda x: F.lower(F.coalesce(x["type"], F.lit("")))
    regular = F.filter(dl, lambda x: F.contains(typ(x), F.lit("fall freshmen")) & x["application_closing"].isNotNull()
                       & (x["application_closing"] != ""))
    early = F.filter(dl, lambda x: ~F.contains(typ(x), F.lit("fall freshmen")) & F.contains(typ(x), F.lit("early"))
                     & x["application_closing"].isNotNull() & (x["application_closing"] != ""))
    ts = F.coalesce(adm["test_scores_accepted"], F.array())
    cols = [(adm["overall"]["acceptance_rate"] / F.lit(100.0)).alias("accept_rate"),
            adm["applying"]["avg_high_school_gpa"].alias("avg_high_school_gpa"),
            adm["applying"]["application_fee"].alias("application_fee"),
            F.try_element_at(regular, F.lit(-1))["application_closing"].alias("application_deadline_regular"),
            F.try_element_at(early, F.lit(-1))["application_closing"].alias("application_deadline_early")]
    names = {"SAT Critical Reading": "sat_verbal", "SAT Math": "sat_math", "ACT Composite": "act_composite"}
    for test, short in names.items():
        for fld, suf in (("percentile_25", "25"), ("percentile_75", "75"), ("avg_score", "avg")):
            cols.append(_pick(ts, "test", test, fld).alias(f"{short}_{suf}"))
    v = _pick(ts, "test", "SAT Critical Reading", "avg_score")
    m = _pick(ts, "test", "SAT Math", "avg_score")
    cols.append((v.cast("bigint") + m.cast("bigint")).alias("sat_total_avg"))
    return cols


def cost_aid_columns() -> list[Column]:
    """D6."""
    tf = F.col("tuition_and_fees")
    tu = F.coalesce(tf["tuition"], F.array())
    fe = F.coalesce(tf["fees"], F.array())
    fa = F.col("financial_aid")
    cols = [_pick(tu, "category", "In-state", "amount").alias("tuition_in_state"),
            _pick(tu, "category", "Out-of-state", "amount").alias("tuition_out_of_state"),
            _pick(tu, "category", "Private", "amount").alias("tuition_private"),
            _pick(fe, "category", "Room & board", "amount").alias("room_and_board"),
            _pick(fe, "category", "Full-time student fees", "amount").alias("full_time_student_fees")]
    for f in ("avg_financial_aid_package", "avg_freshman_financial_aid_package",
              "avg_international_financial_aid_package"):
        cols.append(fa["package_stats"][f].alias(f))
    for f in ("avg_loan_aid", "avg_grant_aid", "avg_scholarship_and_grant_aid_awarded"):
        cols.append(fa["amounts"][f].alias(f))
    for f in ("percentage_need_receive_financial_aid", "avg_percentage_of_financial_need_met",
              "percentage_students_need_fully_met"):
        cols.append((fa["coverage_stats"][f] / F.lit(100.0)).alias(f))
    return cols


def academic_columns() -> list[Column]:
    """D7 (X16 ratio text)."""
    r = F.col("faculty.student_faculty_ratio")
    ok = r.isNotNull() & F.contains(r, F.lit(":")) & (r != "0:1") & F.split(r, ":")[0].rlike(r"^[0-9]+$")
    return [F.col("faculty.total_faculty").alias("total_faculty"),
            F.when(ok, F.split(r, ":")[0].cast("double")).alias("student_faculty_ratio")]


def housing_columns() -> list[Column]:
    """D8."""
    h = F.col("campus_life.housing")
    return [h["college_owned_housing"].alias("college_owned_housing"),
            h["housing_requirements"].alias("housing_required_first_year"),
            (h["percent_undergrads_in_college_housing"] / F.lit(100.0)).alias("percent_students_on_campus")]


def athletics_columns() -> list[Column]:
    """D9 (N11): one flag per sport across men's and women's lists, and any
    scholarship."""
    both = F.concat(F.coalesce(F.col("athletics.`Men's Sports`"), F.array()),
                    F.coalesce(F.col("athletics.`Women's Sports`"), F.array()))
    cols = []
    for sport, names in K.SPORT_VARIATIONS.items():
        cols.append(F.exists(both, _in(names)).alias(f"sport_{sport}"))
    cols.append(F.exists(both, lambda x: F.coalesce(x["scholarship"], F.lit(False))).alias("scholarship_sports_available"))
    return cols


def _in(names):
    return lambda x: F.coalesce(x["sport"].isin(*names), F.lit(False))


def student_body_columns() -> list[Column]:
    """Female applied / total applied; null when no total or no gender data."""
    adm = F.col("admissions")
    total = F.coalesce(adm["overall"]["applied"], F.lit(0))
    fem = F.coalesce(adm["by_gender"]["female"]["applied"], F.lit(0))
    return [F.when(adm["by_gender"].isNotNull() & (total > 0), fem / total).alias("percent_women")]


def extract_metadata(records: DataFrame) -> DataFrame:
    """Every section's columns in one projection (nulls = key absent)."""
    cols = (identity_columns() + admissions_columns() + cost_aid_columns() + academic_columns()
            + housing_columns() + athletics_columns() + student_body_columns())
    return records.select(*cols)


def metadata_json(meta: DataFrame) -> Column:
    """The flat record as JSON without null keys."""
    return F.to_json(F.struct(*[F.col(c) for c in meta.columns]), {"ignoreNullFields": "true"})


# --------------------------------------------------------------------------- #
# Markdown (D12, X11, X21, X22, N12)                                          #
# --------------------------------------------------------------------------- #
def _lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)


def _pct_or(c: Column) -> Column:
    return with_prefix(c, suffix="%")


def _money(c: Column) -> Column:
    return with_prefix(c, prefix="$")


def _num(c: Column) -> Column:
    return display(c)


def general_md() -> Column:
    """D12a."""
    a = F.col("location_contact.address")
    ct = F.col("location_contact.contact")
    city, state, country = display(a["city"]), display(a["state"]), display(a["country"])
    name, title = display(ct["name"]), display(ct["title"])
    person = (F.when((name != "Not Reported") & (title != "Not Reported"),
                     F.concat(F.lit("- **Contact Person:** "), name, F.lit(" ("), title, F.lit(")")))
              .when(name != "Not Reported", F.concat(F.lit("- **Contact Person:** "), name))
              .otherwise(F.lit("- **Contact Person:** Not Reported")))
    return _lines(F.lit("## General Information"), F.lit(""),
                  F.concat(F.lit("- **Location:** "), city, F.lit(", "), state, F.lit(", "), country),
                  F.concat(F.lit("- **Address:** "), display(a["street"]), F.lit(", "), city, F.lit(", "), state,
                           F.lit(" "), display(a["zip_code"])),
                  F.concat(F.lit("- **Phone:** "), display(ct["phone"])),
                  F.concat(F.lit("- **Fax:** "), display(ct["fax"])),
                  F.concat(F.lit("- **Email:** "), display(ct["email"])), person, F.lit(""))


def academics_md() -> Column:
    """D12b (N12: nested transform of categories and programs)."""
    md = F.col("majors_and_degrees")

    def prog(p):
        return F.concat(F.lit("- "), display(p["name"]), F.lit(" (Bachelors: "), display_bool(p["offers_bachelors"]),
                        F.lit(", Associates: "), display_bool(p["offers_associate"]), F.lit(")"))

    def cat(c):
        progs = F.array_join(F.transform(F.coalesce(c["programs"], F.array()), prog), "\n")
        return F.concat_ws("\n", F.concat(F.lit("#### "), display(c["category"])), F.lit(""),
                           F.when(F.size(F.coalesce(c["programs"], F.array())) > 0, F.concat(progs, F.lit("\n")))
                           .otherwise(F.lit("")))

    majors = F.when(F.coalesce(F.size(md), F.lit(0)) > 0, F.array_join(F.transform(md, cat), "\n")) \
        .otherwise(F.lit("No major and degree information reported.\n"))
    f = F.col("faculty")
    return _lines(F.lit("## Academics"), F.lit(""), F.lit("### Majors and Degrees"), F.lit(""), majors,
                  F.lit("### Faculty"), F.lit(""),
                  F.concat(F.lit("- **Total Faculty:** "), _num(f["total_faculty"])),
                  F.concat(F.lit("- **Student-Faculty Ratio:** "), display(f["student_faculty_ratio"])),
                  F.concat(F.lit("- **Full-time Faculty:** "), _num(f["employment"]["full_time"])),
                  F.concat(F.lit("- **Part-time Faculty:** "), _num(f["employment"]["part_time"])),
                  F.concat(F.lit("- **Male Faculty:** "), _num(f["gender"]["male"])),
                  F.concat(F.lit("- **Female Faculty:** "), _num(f["gender"]["female"])), F.lit(""))


def admissions_md() -> Column:
    """D12c (X22 prefixes, N12 lists)."""
    adm = F.col("admissions")
    o, fe, ma = adm["overall"], adm["by_gender"]["female"], adm["by_gender"]["male"]
    req = F.coalesce(adm["requirements"], F.array())
    req_md = F.when(F.size(req) > 0, F.array_join(F.transform(req, lambda r: F.concat(
        F.lit("#### "), display(r["category"]), F.lit("\n\n"),
        F.array_join(F.transform(F.coalesce(r["items"], F.array()), lambda i: F.concat(F.lit("- "), i)), "\n"),
        F.when(F.size(F.coalesce(r["items"], F.array())) > 0, F.lit("\n")).otherwise(F.lit("")))), "\n")) \
        .otherwise(F.lit("No specific requirements reported.\n"))
    dl = F.coalesce(adm["application_deadlines"], F.array())
    dl_md = F.when(F.size(dl) > 0, F.array_join(F.transform(dl, lambda d: F.concat(
        F.lit("- **"), display(d["type"]), F.lit(":** Closing Date: "), display(d["application_closing"]),
        F.lit(", Notification: "), display(d["notification_date"]), F.lit(", Rolling Admissions: "),
        display_bool(d["rolling_admissions"]))), "\n")).otherwise(F.lit("No application deadline information reported."))
    ts = F.coalesce(adm["test_scores_accepted"], F.array())
    ts_md = F.when(F.size(ts) > 0, F.array_join(F.transform(ts, lambda t: F.concat(
        F.lit("- **"), display(t["test"]), F.lit(":** Average: "), display(t["avg_score"]),
        F.lit(", 25th Percentile: "), display(t["percentile_25"]), F.lit(", 75th Percentile: "),
        display(t["percentile_75"]))), "\n")).otherwise(F.lit("- No specific test score data reported."))
    return _lines(
        F.lit("## Admissions"), F.lit(""), F.lit("### Overview"), F.lit(""),
        F.concat(F.lit("- **Acceptance Rate:** "), _pct_or(o["acceptance_rate"])),
        F.concat(F.lit("- **Applied:** "), _num(o["applied"])),
        F.concat(F.lit("- **Accepted:** "), _num(o["accepted"])),
        F.concat(F.lit("- **Enrolled:** "), _num(o["enrolled"])),
        F.concat(F.lit("- **Female Applied:** "), _num(fe["applied"])),
        F.concat(F.lit("- **Female Accepted:** "), _num(fe["accepted"])),
        F.concat(F.lit("- **Female Acceptance Rate:** "), _pct_or(fe["acceptance_rate"])),
        F.concat(F.lit("- **Male Applied:** "), _num(ma["applied"])),
        F.concat(F.lit("- **Male Accepted:** "), _num(ma["accepted"])),
        F.concat(F.lit("- **Male Acceptance Rate:** "), _pct_or(ma["acceptance_rate"])),
        F.lit(""), F.lit("### Application Details"), F.lit(""),
        F.concat(F.lit("- **Application Fee:** "), _money(adm["applying"]["application_fee"])),
        F.concat(F.lit("- **Average High School GPA:** "), _num(adm["applying"]["avg_high_school_gpa"])),
        F.lit(""), F.lit("### Requirements"), F.lit(""), req_md,
        F.lit("### Application Deadlines"), F.lit(""), dl_md, F.lit(""),
        F.lit("### Test Scores Accepted"), F.lit(""), ts_md, F.lit(""))


def tuition_md() -> Column:
    """D12d."""
    tf = F.col("tuition_and_fees")
    fa = F.col("financial_aid")
    tu = F.array_join(F.transform(F.coalesce(tf["tuition"], F.array()), lambda t: F.concat(
        F.lit("- **Tuition ("), display(t["category"]), F.lit("):** "), _money(t["amount"]))), "\n")
    fe = F.array_join(F.transform(F.coalesce(tf["fees"], F.array()), lambda t: F.concat(
        F.lit("- **Fees ("), display(t["category"]), F.lit("):** "), _money(t["amount"]))), "\n")
    tu, fe = F.nullif(tu, F.lit("")), F.nullif(fe, F.lit(""))  # an empty list has no line
    other = display(tf["other_payment_considerations"])
    other = F.when(other != "Not Reported", F.concat(F.lit("- **Other Payment Considerations:** "), other))
    labels = [("package_stats", "avg_financial_aid_package", "Average Financial Aid Package"),
              ("package_stats", "avg_freshman_financial_aid_package", "Average Freshman Financial Aid Package"),
              ("package_stats", "avg_international_financial_aid_package",
               "Average International Financial Aid Package"),
              ("amounts", "avg_loan_aid", "Average Loan Aid"), ("amounts", "avg_grant_aid", "Average Grant Aid"),
              ("amounts", "avg_scholarship_and_grant_aid_awarded", "Average Scholarship and Grant Aid Awarded")]
    aid = [F.concat(F.lit(f"- **{lab}:** "), _money(fa[g][f])) for g, f, lab in labels]
    cov = [("percentage_need_receive_financial_aid", "Percentage of Students Receiving Financial Aid Who Had Need"),
           ("avg_percentage_of_financial_need_met", "Average Percentage of Financial Need Met"),
           ("percentage_students_need_fully_met", "Percentage of Students Whose Financial Need Was Fully Met")]
    cov_md = [F.concat(F.lit(f"- **{lab}:** "), _pct_or(fa["coverage_stats"][f])) for f, lab in cov]
    return _lines(F.lit("## Tuition and Financial Aid"), F.lit(""), F.lit("### Tuition & Fees"), F.lit(""),
                  tu, fe, other, F.lit(""), F.lit("### Financial Aid Overview"), F.lit(""), *aid, *cov_md, F.lit(""))


def _field(section: T.DataType | None, path: str, kind: str) -> Column:
    """``<section>.<path>``, or a missing value of ``kind`` where the schema has no such field."""
    at = section
    for name in path.split(".")[1:]:
        if not isinstance(at, T.StructType) or name not in at.names:
            return F.lit(None).cast(kind)
        at = at[name].dataType
    return F.col(path)


def _bullets(items: Column) -> Column:
    """One line per item, in order; missing where there are none."""
    return F.nullif(F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit(""))


def _reported(value: Column, before: str, after: str = "") -> Column:
    """A line for a value that is reported; missing otherwise."""
    v = display(value)
    return F.when(v != "Not Reported", F.concat(F.lit(before), v, F.lit(after)))


SECURITY_FIELDS = [  # field, line if it is "True", how another value begins (none: not shown)
    ("emergency_services", "24-hour emergency telephone/alarm services", "Emergency services: "),
    ("patrols", "24-hour patrols by trained officers", "Patrols: "),
    ("student_patrols", "Student patrols", None),
    ("transport_services", "Late-night transport/escort services", "Transport services: "),
    ("dormitory_entrances", "Controlled dormitory entrances", None),
    ("other_security", None, "Additional security: "),
]


def security_lines(text: Column) -> Column:
    """The security field, JSON text of a list or of an object, as lines.

    A list gives its items, in order.  An object gives a line per known field
    that is reported, in the order of ``SECURITY_FIELDS``.  An empty or
    missing list, an object without such fields and any other value are not
    reported."""
    v = F.try_parse_json(text)
    kind = F.schema_of_variant(v)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string"))
    said = []
    for name, if_true, begin in SECURITY_FIELDS:
        d = display(F.try_variant_get(v, f"$.{name}", "string"))
        line = F.when(d == "Not Reported", F.lit(None))
        if if_true is not None:
            line = line.when(d == "True", F.lit(f"- {if_true}"))
        if begin is not None:
            said.append(line.when(d != "False", F.concat(F.lit(f"- {begin}"), d)))
        else:
            said.append(line)
    lines = F.when(kind.startswith("ARRAY"), _bullets(F.filter(items, lambda x: x.isNotNull()))) \
        .when(kind.startswith("OBJECT"), F.nullif(F.concat_ws("\n", *said), F.lit("")))
    return F.coalesce(lines, F.lit("- Not Reported"))


def campus_life_md(section: T.DataType | None = None) -> Column:
    """D12e: nine parts, in order.  Student body, most popular organisations and events only show with
    data; activities, services and organisations say so where there is none.  ``section`` is the type of
    ``campus_life``: fields that it lacks are missing."""
    def f(path: str, kind: str = "string") -> Column:
        return _field(section, f"campus_life.{path}", kind)

    strings = "array<string>"
    body = section["student_body"].dataType if isinstance(section, T.StructType) and "student_body" in section.names else None
    male, female = (display(f(f"student_body.gender_distribution.{g}")) for g in ("male", "female"))
    gender = F.when((male != "Not Reported") & (female != "Not Reported"), F.concat(
        F.lit("- **Gender Distribution:** Male: "), male, F.lit("%, Female: "), female, F.lit("%")))
    student_body = F.when(present(f("student_body"), body), _lines(
        F.lit("### Student Body"), F.lit(""),
        _reported(f("student_body.total_undergrad_students"), "- **Total Undergraduate Students:** "),
        _reported(f("student_body.international_students_percentage"), "- **International Students:** ", "%"),
        _reported(f("student_body.out_of_state_students_percentage"), "- **Out-of-State Students:** ", "%"),
        gender, F.lit("")))

    def listed(title: str, path: str) -> list[Column]:
        return [F.lit(f"### {title}"), F.lit(""), F.coalesce(_bullets(f(path, strings)), F.lit("- Not Reported"))]

    popular = _bullets(f("most_popular_organizations", strings))
    events = _bullets(f("campus_events", strings))
    return _lines(
        F.lit("## Campus Life"), F.lit(""), student_body, F.lit("### Housing"), F.lit(""),
        F.concat(F.lit("- **College-Owned Housing Available:** "), display(f("housing.college_owned_housing"))),
        F.concat(F.lit("- **Housing Requirements:** "), display(f("housing.housing_requirements"))),
        F.concat(F.lit("- **Housing Options:** "), display_list(f("housing.housing_options", strings))),
        F.concat(F.lit("- **Percent Undergrads in College Housing:** "),
                 _pct_or(f("housing.percent_undergrads_in_college_housing"))), F.lit(""),
        *listed("Student Activities", "student_activities"), F.lit(""),
        *listed("Student Services", "student_services"), F.lit(""),
        *listed("Student Organizations", "student_organizations"),
        F.when(popular.isNotNull(), _lines(F.lit(""), F.lit("#### Most Popular Organizations"), F.lit(""), popular)), F.lit(""),
        F.when(events.isNotNull(), _lines(F.lit("### Campus Events"), F.lit(""), events, F.lit(""))),
        F.lit("### Campus Security and Safety"), F.lit(""), security_lines(f("campus_security_and_safety_json")), F.lit(""))


def sport_line(s: Column) -> Column:
    """X21 / D12f: one sport as a Markdown line."""
    return F.concat(F.lit("- **"), display(s["sport"]), F.lit(":** Intercollegiate: "), display(s["intercollegiate"]),
                    F.lit(", Scholarship: "), display_bool(s["scholarship"]), F.lit(", Intramural: "),
                    display_bool(s["intramural"]))


def athletics_md() -> Column:
    """D12f."""
    def block(col, empty):
        arr = F.coalesce(F.col(col), F.array())
        return F.when(F.size(arr) > 0, F.array_join(F.transform(arr, sport_line), "\n")).otherwise(F.lit(empty))
    return _lines(F.lit("## Athletics"), F.lit(""), F.lit("### Men's Sports"), F.lit(""),
                  block("athletics.`Men's Sports`", "- No men's sports data reported."), F.lit(""),
                  F.lit("### Women's Sports"), F.lit(""),
                  block("athletics.`Women's Sports`", "- No women's sports data reported."), F.lit(""))


def present(c: Column, kind: T.DataType | None) -> Column:
    """Whether a value counts as there: not missing, not an empty text or list, not zero or false, and
    of an object, with any field that is not missing.  ``kind`` None: the schema has no such value."""
    if kind is None:
        return F.lit(False)
    if isinstance(kind, T.ArrayType):
        ok = F.size(c) > 0
    elif isinstance(kind, T.StructType):
        ok = F.lit(False)
        for name in kind.names:
            ok = ok | c.getField(name).isNotNull()
        ok = c.isNotNull() & ok
    elif isinstance(kind, T.StringType):
        ok = c != ""
    elif isinstance(kind, T.BooleanType):
        ok = c
    else:
        ok = c != 0
    return F.coalesce(ok, F.lit(False))


# Sections of the overview, with the parts of a record of which any makes them present.
COMPLETENESS = [("Location and Contact Information", ["location_contact"]),
                ("Academic Information", ["majors_and_degrees", "faculty"]),
                ("Admissions Information", ["admissions"]),
                ("Tuition and Financial Aid", ["tuition_and_fees", "financial_aid"]),
                ("Campus Life Information", ["campus_life"]), ("Athletics Information", ["athletics"])]
# Sections with details, and the label of each field.
DETAILS = [("campus_life", "Campus Life Details", [
                ("Housing Information", "housing"), ("Student Activities", "student_activities"),
                ("Student Services", "student_services"), ("Student Organizations", "student_organizations"),
                ("Campus Security", "campus_security_and_safety_json"),
                ("Most Popular Organizations", "most_popular_organizations"), ("Campus Events", "campus_events"),
                ("Student Body Demographics", "student_body")]),
           ("admissions", "Admissions Details", [
                ("Overall Statistics", "overall"), ("Gender-based Statistics", "by_gender"), ("Requirements", "requirements"),
                ("Application Deadlines", "application_deadlines"), ("Test Score Information", "test_scores_accepted")]),
           ("athletics", "Athletics Details", [("Men's Sports", "Men's Sports"), ("Women's Sports", "Women's Sports")])]


def completeness_md(schema: T.StructType) -> Column:
    """D12g: the sections with data, then those without, then what the sections with details hold.
    Both orders are those of the lists above; sports come with their numbers."""
    def there(path: list[str]) -> Column:
        kind: T.DataType | None = schema
        for name in path:
            kind = kind[name].dataType if isinstance(kind, T.StructType) and name in kind.names else None
        if kind is None:
            return F.lit(False)
        c = F.col(".".join(f"`{p}`" for p in path))
        if path[-1].endswith("_json"):  # JSON text: empty lists, objects and texts are not there
            return F.coalesce(~F.regexp_replace(c, r"\s+", "").isin("", "[]", "{}", "null", '""'), F.lit(False))
        return present(c, kind)

    def sign(ok: Column) -> Column:
        return F.when(ok, F.lit("✅")).otherwise(F.lit("❌"))

    seen = []
    for label, parts in COMPLETENESS:
        ok = F.lit(False)
        for part in parts:
            ok = ok | there([part])
        seen.append((label, ok))
    overview = [F.when(ok, F.lit(f"✅ {label}")) for label, ok in seen] + [F.when(~ok, F.lit(f"❌ {label}")) for label, ok in seen]
    details = []
    for section, title, fields in DETAILS:
        lines = []
        for label, name in fields:
            line = F.concat(F.lit(f"- {label}: "), sign(there([section, name])))
            if section == "athletics":
                known = isinstance(schema[section].dataType, T.StructType) and name in schema[section].dataType.names \
                    if section in schema.names else False
                n = F.coalesce(F.size(F.col(f"`{section}`.`{name}`")), F.lit(0)) if known else F.lit(0)
                line = F.concat(line, F.lit(" ("), n.cast("string"), F.lit(" sports)"))
            lines.append(line)
        details.append(F.when(there([section]), _lines(F.lit(f"**{title}:**"), *lines, F.lit(""))))
    return _lines(F.lit("## Data Completeness"), F.lit(""),
                  F.lit("This section shows which data categories are available for this university:"), F.lit(""),
                  *overview, F.lit(""), F.lit("### Detailed Data Availability"), F.lit(""), *details)


def render_documents(records: DataFrame, ordinal: str) -> DataFrame:
    """(document_id, university_name, filename, slug, markdown).
    The document id is the md5 of name|city|state|zip|ordinal, where the
    ordinal is an explicit column (not row order)."""
    a = F.col("location_contact.address")
    doc_id = record_id(F.coalesce(F.col("university_name"), F.lit("Unknown")), a["city"], a["state"],
                       a["zip_code"], F.col(ordinal))
    name = F.coalesce(F.col("university_name"), F.lit("N/A"))
    md = _lines(F.concat(F.lit("# "), name), F.lit(""),
                F.concat(F.lit("**Document ID:** `"), doc_id, F.lit("`")), F.lit(""),
                general_md(), academics_md(), admissions_md(), tuition_md(),
                campus_life_md(records.schema["campus_life"].dataType), athletics_md(), completeness_md(records.schema))
    return records.select(doc_id.alias("document_id"), name.alias("university_name"),
                          F.concat(slug(name), F.lit("_"), doc_id, F.lit(".md")).alias("filename"),
                          slug(name).alias("slug"), F.col(ordinal).alias("json_index"), md.alias("markdown"))


# --------------------------------------------------------------------------- #
# Documents and ids (X12, J12, D18)                                           #
# --------------------------------------------------------------------------- #
def audit_document_ids(texts: DataFrame, text: str = "text", source: str = "source", error: str | None = None) -> DataFrame:
    """Per file the document id, NOT_FOUND, or ERROR where the file could not be read: where ``error`` (the
    column of reading errors, if there is one) is not null."""
    from ..functions.scalars import document_id

    d = document_id(F.col(text))
    found = F.when(F.coalesce(d, F.lit("")) == "", F.lit("NOT_FOUND")).otherwise(d)
    if error is not None:
        found = F.when(F.col(error).isNotNull(), F.lit("ERROR")).otherwise(found)
    return texts.select(source, found.alias("document_id"))


def load_documents(texts: DataFrame, mapping: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Documents joined to their record by extracted id; unmatched kept
    (``matched`` false)."""
    from ..functions.scalars import document_id

    d = texts.select(source, F.col(text).alias("page_content"), document_id(F.col(text)).alias("document_id"))
    m = mapping.select("document_id", "university_name", "filename")
    j = d.join(m, on="document_id", how="left")
    return j.withColumn("matched", F.col("university_name").isNotNull())


# --------------------------------------------------------------------------- #
# JSON key coverage (Q1-Q4)                                                   #
# --------------------------------------------------------------------------- #
def json_key_coverage(df: DataFrame, id_col: str, json_col: str, samples: int = 3) -> DataFrame:
    """Q1: for every key path (array items as ``[0]``, first item only) the
    number of records having it (null values count), its percent, and up to
    ``samples`` smallest distinct non-null scalar values (as text; a list of
    plain values offers its first item).

    The parsed ``VARIANT`` is taken apart level by level, to whatever depth the
    records have.  Each level is one pass that gives object entries and first
    array items together, written to the shared checkpoint folder, so the JSON
    is read and parsed once.  Counts are per (path, record), then per path,
    and the samples come from a per-path top-n with a partial window limit, so
    no path's values are gathered in one task.
    """
    def kind(v):
        return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)

    def plain(v, of=None):
        return F.when(~(kind(v) if of is None else of).isin("OBJECT", "ARRAY") & ~F.is_variant_null(v),
                      F.try_variant_get(v, "$", "string"))

    nested = F.col("_kind").isin("OBJECT", "ARRAY")
    level = df.select(F.col(id_col).alias("_id"), F.lit("").alias("path"), F.try_parse_json(F.col(json_col)).alias("_v")) \
        .withColumn("_kind", kind("_v"))
    found = None
    while True:
        entries = F.transform(F.map_entries(F.try_variant_get("_v", "$", "map<string,variant>")), lambda e: F.struct(
            F.when(F.col("path") == "", e["key"]).otherwise(F.concat_ws(".", "path", e["key"])).alias("path"),
            e["value"].alias("_v"), F.lit(True).alias("_key")))
        first = F.array(F.struct(F.concat(F.col("path"), F.lit("[0]")).alias("path"),
                                 F.try_variant_get("_v", "$[0]", "variant").alias("_v"), F.lit(False).alias("_key")))
        inner = F.when(F.col("_kind") == "OBJECT", entries).when(F.col("_kind") == "ARRAY", first)
        # a value's kind and text are found once, where it is met; only what goes deeper is kept as a variant
        item = F.try_variant_get("_v", "$[0]", "variant")
        step = level.where(nested).select("_id", F.inline(inner)).where(F.col("_v").isNotNull()).withColumn("_kind", kind("_v"))
        level = cut_lineage(step.select(
            "_id", "path", "_key", "_kind", F.when(nested, F.col("_v")).alias("_v"),
            F.when(F.col("_kind") == "ARRAY", plain(item)).when(~nested, plain(F.col("_v"), F.col("_kind"))).alias("val")))
        if level.isEmpty():
            break
        found = level if found is None else found.unionByName(level)
    if found is None:
        found = level
    vals = found.where("_key").select("_id", "path", "val")
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    counts = vals.select("_id", "path").distinct().groupBy("path").agg(F.count(F.lit(1)).alias("records"))
    dv = vals.where(F.col("val").isNotNull()).select("path", "val").distinct()
    w = Window.partitionBy("path").orderBy("val")
    top = dv.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= samples)
    smp = top.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("val")), " | ").alias("samples"))
    one = F.lit(1).alias("_one")
    out = (counts.join(smp, on="path", how="left").select("*", one)
           .join(F.broadcast(total.select("*", one)), on="_one", how="inner").drop("_one"))  # one row
    return out.select("path", "records", (F.lit(100.0) * F.col("records") / F.col("_total")).alias("percent"),
                      F.coalesce("samples", F.lit("")).alias("samples"))


def category_coverage(df: DataFrame, id_col: str, array_col: str, tag: str = "category",
                      value: str = "amount", samples: int = 3) -> DataFrame:
    """Q2: per category of a nested list: its items, records having it, records with a value, the mean value,
    and the texts of the first ``samples`` distinct values in the order of records and items.

    Items without a category do not count.  Records are counted from one row per
    (category, record), samples from one row per (category, value) and a limit
    before the shuffle, so no category meets in one task.
    """
    e = df.select(F.col(id_col).alias("_id"), F.posexplode_outer(array_col).alias("_pos", "_x")).where(F.col("_x").isNotNull())
    e = e.select("_id", "_pos", F.col(f"_x.{tag}").alias("category"), F.col(f"_x.{value}").alias("_v")) \
        .where(F.coalesce(F.col("category"), F.lit("")) != "")
    per = e.groupBy("category", "_id").agg(F.count("*").alias("_n"), F.count("_v").alias("_nv"), F.sum("_v").alias("_sv"))
    counts = per.groupBy("category").agg(
        F.sum("_n").alias("items"), F.count("*").alias("records"), F.count_if(F.col("_nv") > 0).alias("records_with_value"),
        (F.sum("_sv") / F.nullif(F.sum("_nv"), F.lit(0))).alias("mean_value"))
    seen = e.where("_v IS NOT NULL").groupBy("category", F.col("_v").cast("string").alias("_t")) \
        .agg(F.min(F.struct("_id", "_pos")).alias("_first"))
    first = seen.withColumn("_rank", F.row_number().over(Window.partitionBy("category").orderBy("_first"))) \
        .where(F.col("_rank") <= samples)
    said = first.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("_rank", "_t"))).alias("_s"))
    return counts.join(said, "category", "left").select(
        "category", "items", "records", "records_with_value", "mean_value",
        F.coalesce(F.array_join(F.transform("_s", lambda x: x["_t"]), " | "), F.lit("")).alias("samples"))


def attribute_coverage(df: DataFrame, id_col: str, lists: dict, tag: str = "sport",
                       attrs: Sequence[str] = ("intramural", "intercollegiate", "scholarship")) -> DataFrame:
    """Q3: per tag value (sport): records listing it in each list, and records
    where each attribute is reported (not null)."""
    parts = None
    for label, col in lists.items():
        e = df.select(id_col, F.lit(label).alias("_list"), F.explode_outer(col).alias("_x")).where(F.col("_x").isNotNull())
        parts = e if parts is None else parts.unionByName(e)
    t = parts.select(id_col, "_list", F.col(f"_x.{tag}").alias(tag), *[F.col(f"_x.{a}").alias(a) for a in attrs])
    # one row per (tag, record) first, so that nothing is expanded per distinct count
    seen = {f"records_{lab}": F.col("_list") == lab for lab in lists} | {f"records_with_{a}": F.col(a).isNotNull() for a in attrs}
    per = t.groupBy(tag, id_col).agg(*[F.bool_or(c).alias(n) for n, c in seen.items()])
    some = [F.count_if(n).alias(n) for n in seen]
    return per.groupBy(tag).agg(*some[:len(lists)], F.count("*").alias("records_any"), *some[len(lists):])


def coverage_report(cov: DataFrame, total_col: str = "records", top: int | None = None) -> DataFrame:
    """The paths by record count (ties by path) with their samples
    escaped and cut for a Markdown table; all of them, or the first ``top``."""
    from ..functions.scalars import table_cell

    ranked = cov.orderBy(F.col(total_col).desc(), F.col("path"))
    return (ranked if top is None else ranked.limit(top)).withColumn("examples", table_cell(F.col("samples")))
