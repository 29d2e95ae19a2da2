"""Queries over university records (D1-D19, N8-N12, X3, X4, X11, X12, X16,
X21, X22, Q1, Q5, S7, S13, J12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import profiling as PR
from ..operators import records as RC
from ..sources import io
from ..sources.tables import table
from . import records_binding as RB
from .catalog import finish, r6, register
from .q_text import _sql_list, _sql_region, _sql_state, sql_slug

CUST = """(SELECT c.*, n.n_name, o.n_orders FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
           LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
             ON c.c_custkey = o.o_custkey)"""
CODE_SQL = f"{_sql_list(RB.CODES)}[(c_nationkey * 3) % {len(RB.CODES)} + 1]"
STATE_SQL = _sql_state(CODE_SQL)


def _cleaned(spark, sf_dir):
    return RC.clean_records(RB.records(spark, sf_dir))


# --------------------------------------------------------------------------- #
@register("record_clean", sql=f"""
SELECT 'https://example.com/college/' || CAST(c_custkey AS VARCHAR) AS url, {STATE_SQL} AS state,
       CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_requirements,
       CASE c_custkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS n_items,
       CASE c_custkey % 4 WHEN 0 THEN 'Required|Recommended' WHEN 1 THEN 'Required' ELSE '' END AS categories,
       CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS removed_non_objects,
       CASE c_custkey % 4 WHEN 0 THEN 2 ELSE 0 END AS removed_malformed_items
FROM {CUST} x""", ops="D3, N8, N9, X3")
def record_clean(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    req = F.coalesce(F.col("admissions.requirements"), F.array())
    return c.select("url", F.col("location_contact.address.state").alias("state"),
                    F.size(req).alias("n_requirements"),
                    F.aggregate(req, F.lit(0), lambda acc, r: acc + F.size(r["items"])).alias("n_items"),
                    F.array_join(F.transform(req, lambda r: r["category"]), "|").alias("categories"),
                    "removed_non_objects", "removed_malformed_items")


def _metadata_sql() -> str:
    k = "c_custkey"
    sp = _sql_list(RB.SPORT_NAMES)
    men1, men2 = f"{sp}[{k} % 12 + 1]", f"{sp}[({k} * 7) % 12 + 1]"
    wom = f"CASE WHEN {k} % 6 <> 0 THEN {sp}[({k} * 5) % 12 + 1] END"
    sports = []
    for s, names in K.SPORT_VARIATIONS.items():
        lst = ", ".join("'" + x + "'" for x in names)
        sports.append(f"(coalesce({men1} IN ({lst}), false) OR coalesce({men2} IN ({lst}), false) "
                      f"OR coalesce({wom} IN ({lst}), false)) AS sport_{s}")
    t5 = f"{k} % 5 <> 0"
    cols = [
        f"'https://example.com/college/' || CAST({k} AS VARCHAR) AS url", "c_name AS university_name",
        "st AS state", "n_name AS city", f"lpad(CAST({k} % 100000 AS VARCHAR), 5, '0') AS zip_code",
        "'United States' AS country",
        f"CASE WHEN st IS NOT NULL AND st <> '' THEN {_sql_region('st')} END AS region",
        f"CAST({k} % 90 + 5 AS DOUBLE) / 100.0 AS accept_rate",
        f"2.5 + ({k} % 15) / 10.0 AS avg_high_school_gpa",
        f"CAST(({k} % 10) * 10 AS DOUBLE) AS application_fee",
        f"CASE WHEN {k} % 4 <> 0 THEN '01-' || lpad(CAST({k} % 28 + 1 AS VARCHAR), 2, '0') END "
        "AS application_deadline_regular",
        f"CASE WHEN {k} % 3 <> 0 THEN '11-15' END AS application_deadline_early",
        f"CASE WHEN {t5} THEN CAST(350 + {k} % 300 AS DOUBLE) END AS sat_verbal_25",
        f"CASE WHEN {t5} AND {k} % 6 <> 0 THEN CAST(450 + {k} % 300 AS DOUBLE) END AS sat_verbal_75",
        f"CASE WHEN {t5} THEN CAST(400 + {k} % 300 AS DOUBLE) END AS sat_verbal_avg",
        f"CASE WHEN {t5} THEN CAST(370 + {k} % 280 AS DOUBLE) END AS sat_math_25",
        f"CASE WHEN {t5} THEN CAST(470 + {k} % 280 AS DOUBLE) END AS sat_math_75",
        f"CASE WHEN {t5} THEN CAST(420 + {k} % 280 AS DOUBLE) END AS sat_math_avg",
        f"CASE WHEN {t5} THEN CAST(12 + {k} % 20 AS DOUBLE) END AS act_composite_25",
        f"CASE WHEN {t5} THEN CAST(18 + {k} % 20 AS DOUBLE) END AS act_composite_75",
        f"CASE WHEN {t5} THEN CAST(15 + {k} % 20 AS DOUBLE) END AS act_composite_avg",
        f"CASE WHEN {t5} THEN CAST(400 + {k} % 300 + 420 + {k} % 280 AS BIGINT) END AS sat_total_avg",
        f"CASE WHEN c_mktsegment <> 'BUILDING' AND c_acctbal > 0 THEN c_acctbal * 3.0 END AS tuition_in_state",
        f"CAST(20000 + {k} % 10000 AS DOUBLE) AS tuition_out_of_state",
        f"CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 0 THEN c_acctbal * 3.0 END AS tuition_private",
        f"CAST(8000 + {k} % 3000 AS DOUBLE) AS room_and_board",
        f"CASE WHEN {k} % 2 <> 0 THEN CAST(500 + {k} % 500 AS DOUBLE) END AS full_time_student_fees",
        f"CAST(10000 + {k} % 5000 AS DOUBLE) AS avg_financial_aid_package",
        f"CASE WHEN {k} % 3 <> 0 THEN CAST(9000 + {k} % 4000 AS DOUBLE) END AS avg_freshman_financial_aid_package",
        "CAST(NULL AS DOUBLE) AS avg_international_financial_aid_package",
        f"CAST(5000 + {k} % 2000 AS DOUBLE) AS avg_loan_aid", f"CAST(6000 + {k} % 3000 AS DOUBLE) AS avg_grant_aid",
        f"CAST(7000 + {k} % 3500 AS DOUBLE) AS avg_scholarship_and_grant_aid_awarded",
        f"CAST({k} % 100 AS DOUBLE) / 100.0 AS percentage_need_receive_financial_aid",
        f"CAST(50 + {k} % 50 AS DOUBLE) / 100.0 AS avg_percentage_of_financial_need_met",
        f"CASE WHEN {k} % 4 <> 0 THEN CAST({k} % 30 AS DOUBLE) / 100.0 END AS percentage_students_need_fully_met",
        f"CAST({k} % 500 + 20 AS BIGINT) AS total_faculty",
        f"CASE WHEN {k} % 7 IN (0, 1, 2) THEN NULL ELSE CAST({k} % 20 + 5 AS DOUBLE) END AS student_faculty_ratio",
        f"{k} % 3 <> 0 AS college_owned_housing", f"{k} % 2 = 0 AS housing_required_first_year",
        f"CASE WHEN {k} % 7 <> 0 THEN CAST({k} % 100 AS DOUBLE) / 100.0 END AS percent_students_on_campus",
        *sports,
        f"{k} % 2 = 0 AS scholarship_sports_available",
        f"CASE WHEN n_orders IS NOT NULL AND n_orders * 100 > 0 THEN "
        f"floor(n_orders * 100 * ({k} % 60 + 20) / 100) / (n_orders * 100) END AS percent_women",
    ]
    sel = ",\n  ".join(cols)
    return f"""SELECT {sel}
FROM (SELECT *, {STATE_SQL} AS st FROM {CUST} x) y"""


@register("record_metadata", sql=f"SELECT * REPLACE ({', '.join(f'{r6(c)} AS {c}' for c in ('accept_rate', 'avg_high_school_gpa', 'tuition_in_state', 'tuition_private', 'percent_women'))}) FROM ({_metadata_sql()}) m",
          ops="D4-D11, N10, N11, X4, X16")
def record_metadata(spark, sf_dir):
    return finish(RC.extract_metadata(_cleaned(spark, sf_dir)))


def record_markdown(spark, sf_dir):
    docs = RC.render_documents(RB.with_campus_life(_cleaned(spark, sf_dir)), "ordinal")
    return docs.select("document_id", "university_name", "filename", "slug", "json_index",
                       F.length("markdown").alias("chars"), "markdown")


def _doc_id_sql() -> str:
    return (f"md5(c_name || '|' || coalesce(n_name, '') || '|' || coalesce({STATE_SQL}, '') || '|' || "
            f"lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || '|' || CAST(c_custkey AS VARCHAR))")


@register("document_audit", sql=f"""
SELECT {sql_slug('c_name')} || '_' || {_doc_id_sql()} || '.md' AS source,
  CASE WHEN c_custkey % 9 IN (0, 4) THEN 'ERROR' WHEN c_custkey % 9 = 1 THEN 'NOT_FOUND' ELSE {_doc_id_sql()} END AS document_id
FROM {CUST} x""", ops="D18 (ids, absent ids and files that cannot be read)")
def document_audit(spark, sf_dir):
    docs = RC.render_documents(RB.with_campus_life(_cleaned(spark, sf_dir)), "ordinal")
    raw, k = F.col("markdown").cast("binary"), F.col("json_index")
    content = (F.when(k % 9 == 0, F.concat(F.unhex(F.lit("C328")), raw))  # a lead byte without its follower
               .when(k % 9 == 1, F.regexp_replace("markdown", r"\*\*Document ID:\*\*", "Id").cast("binary"))
               .when(k % 9 != 4, raw))
    files = docs.select(F.col("filename").alias("source"), content.alias("content"))
    return RC.audit_document_ids(io.decode_texts(files), error="read_error")


@register("document_mapping", sql=f"""
SELECT {_doc_id_sql()} AS document_id, c_name AS university_name, {sql_slug('c_name')} || '_' || {_doc_id_sql()} || '.md' AS filename,
  {sql_slug('c_name')} AS slug, c_custkey AS json_index, true AS stored
FROM {CUST} x""", ops="S13 (documents and id mapping as one committed pair, read back)")
def document_mapping(spark, sf_dir):
    docs = RC.render_documents(_cleaned(spark, sf_dir), "ordinal")
    path = io.scratch_dir(spark, "set")
    io.write_document_set(docs.limit(0), path)  # an earlier set, which the next one replaces
    io.write_document_set(docs, path)
    stored, mapping = io.read_document_set(spark, path)
    has = stored.select("document_id", (F.length("markdown") > 0).alias("stored"))
    return mapping.join(has, "document_id", "left")


@register("document_join", sql=f"""
SELECT {_doc_id_sql()} AS document_id, c_name AS university_name,
       {sql_slug('c_name')} || '_' || {_doc_id_sql()} || '.md' AS filename, true AS matched
FROM {CUST} x""", ops="S13, X11, X12, D18, J12 (documents stored as bucketed Parquet and read back)")
def document_join(spark, sf_dir):
    docs = RC.render_documents(_cleaned(spark, sf_dir), "ordinal")
    path = io.write_documents(docs.select("document_id", "filename", "markdown"), io.scratch_dir(spark, "docs"),
                              key="document_id", buckets=16)
    stored = spark.read.parquet(path).select(F.col("filename").alias("source"), F.col("markdown").alias("text"))
    audit = RC.audit_document_ids(stored)
    mapping = docs.select("document_id", "university_name", "filename")
    loaded = RC.load_documents(stored, mapping)
    j = loaded.join(audit.withColumnRenamed("document_id", "audited_id"), on="source", how="left")
    return j.select("document_id", "university_name", "filename",
                    (F.col("matched") & (F.col("audited_id") == F.col("document_id"))).alias("matched"))


# --------------------------------------------------------------------------- #
def _cov_json_spark(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    codes = F.array(*[F.lit(x) for x in RB.CODES])
    rec = F.struct(
        F.struct(F.struct(F.col("n_name").alias("city"),
                          F.element_at(codes, (F.pmod(F.col("c_nationkey") * 3, F.lit(len(RB.CODES))) + 1).cast("int"))
                          .alias("state"),
                          F.lpad(F.pmod(k, F.lit(100000)).cast("string"), 5, "0").alias("zip_code")).alias("address"),
                 F.struct(F.when(F.pmod(k, F.lit(3)) != 0, F.concat(F.lit("555-"), F.lpad(F.pmod(k, F.lit(10000)).cast("string"), 4, "0")))
                          .alias("phone"), F.lit(None).cast("string").alias("fax")).alias("contact")).alias("location_contact"),
        F.struct((F.pmod(k, F.lit(500)) + 20).cast("bigint").alias("total_faculty"),
                 F.col("c_mktsegment").alias("segment")).alias("faculty"),
        F.array(F.struct(F.concat(F.lit("Program "), F.pmod(k, F.lit(7)).cast("string")).alias("name")),
                F.struct(F.lit("Other").alias("name"))).alias("programs"),
        F.array(F.concat(F.lit("Tag "), F.pmod(k, F.lit(4)).cast("string")), F.lit("last")).alias("tags"),
        F.struct(F.struct(F.struct(F.array(F.struct(F.struct(F.struct(F.pmod(k, F.lit(9)).cast("bigint").alias("g")).alias("f"))
                                                    .alias("e"))).alias("d")).alias("c")).alias("b")).alias("a"))
    return j.select(k.alias("id"), F.to_json(rec, {"ignoreNullFields": "false"}).alias("doc"))


def _cov_sql() -> str:
    doc = (f"json_object('location_contact', json_object('address', json_object('city', n_name, 'state', "
           f"{CODE_SQL}, 'zip_code', lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')), 'contact', "
           f"json_object('phone', CASE WHEN c_custkey % 3 <> 0 THEN '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END, "
           f"'fax', NULL)), 'faculty', json_object('total_faculty', c_custkey % 500 + 20, 'segment', c_mktsegment), "
           f"'programs', json_array(json_object('name', 'Program ' || CAST(c_custkey % 7 AS VARCHAR)), "
           f"json_object('name', 'Other')), 'tags', json_array('Tag ' || CAST(c_custkey % 4 AS VARCHAR), 'last'), "
           f"'a', json_object('b', json_object('c', json_object('d', json_array(json_object('e', "
           f"json_object('f', json_object('g', c_custkey % 9))))))))")
    return f"""
WITH d AS (SELECT c_custkey AS id, {doc} AS doc FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
t AS (SELECT d.id, regexp_replace(j.fullkey, '^\\$\\.', '') AS path, j.type, j.value
      FROM d, json_tree(d.doc) j
      WHERE j.key IS NOT NULL AND NOT regexp_matches(j.key, '^[0-9]+$')
        AND NOT regexp_matches(j.fullkey, '\\[[1-9][0-9]*\\]')),
tot AS (SELECT count(*) AS total FROM customer),
c AS (SELECT path, count(DISTINCT id) AS records FROM t GROUP BY path),
v AS (SELECT DISTINCT path, json_extract_string(value, '$') AS val FROM t
      WHERE type NOT IN ('OBJECT', 'ARRAY', 'NULL')
      UNION SELECT path, json_extract_string(value, '$[0]') FROM t
      WHERE type = 'ARRAY' AND json_type(value, '$[0]') NOT IN ('OBJECT', 'ARRAY', 'NULL')),
s AS (SELECT path, string_agg(val, ' | ' ORDER BY val) AS samples
      FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY val) AS rn FROM v) WHERE rn <= 3 GROUP BY path)
SELECT c.path, c.records, {r6('100.0 * c.records / tot.total')} AS percent, coalesce(s.samples, '') AS samples
FROM c LEFT JOIN s USING (path), tot"""


@register("json_key_coverage", sql=_cov_sql(), ops="Q1, Q2, Q4 (paths, counts, percent, samples)")
def json_key_coverage(spark, sf_dir):
    d = _cov_json_spark(spark, sf_dir)
    return finish(RC.json_key_coverage(d, "id", "doc"))


NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax")


TEXTS = {"l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time"}


def _profile_sql() -> str:
    parts = []
    for c in NUMERIC:
        top = f"(SELECT struct_pack(v := {c}, c := count(*)) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        parts.append(f"""SELECT '{c}' AS column_name, 'number' AS type, CAST(count({c}) AS BIGINT) AS n,
  CAST(count(*) - count({c}) AS BIGINT) AS missing, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values,
  {r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max, {r6(f'CAST(sum(CAST({c} AS DECIMAL(38, 10))) AS DOUBLE) / count({c})')} AS mean,
  {r6(f'stddev_samp({c})')} AS std, CAST(count_if({c} = 0) AS BIGINT) AS zeros, NULL AS min_text, NULL AS max_text,
  {r6(f'{top}.v')} AS top_number, NULL AS top_text, CAST({top}.c AS BIGINT) AS top_count FROM lineitem""")
    for c, kind in TEXTS.items():
        x = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if kind == "time" else c
        top = f"(SELECT struct_pack(v := {x}, c := count(*)) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {x} ORDER BY count(*) DESC, {x} LIMIT 1)"
        parts.append(f"""SELECT '{c}', '{kind}', CAST(count({c}) AS BIGINT), CAST(count(*) - count({c}) AS BIGINT),
  CAST(count(DISTINCT {x}) AS BIGINT), NULL, NULL, NULL, NULL, NULL, min({x}), max({x}), NULL, {top}.v, CAST({top}.c AS BIGINT) FROM lineitem""")
    return " UNION ALL ".join(parts)


@register("table_profile", sql=_profile_sql(), ops="Q5 (type, counts, range, mean, std, top value; all columns)")
def table_profile(spark, sf_dir):
    return finish(PR.table_profile(table(spark, sf_dir, "lineitem"), [*NUMERIC, *TEXTS]))


def _per_number(sql: str, sep: str = " UNION ALL ") -> str:
    return sep.join(sql.replace("{c}", c) for c in NUMERIC)


@register("table_quantiles", sql=_per_number(
    "SELECT '{c}' AS column_name, " + ", ".join(r6(f"quantile_cont(CAST({{c}} AS DOUBLE), {q})") + f" AS {p}"
                                                 for p, q in PR.QUANTILES.items()) + " FROM lineitem"), ops="Q5 (quantiles)")
def table_quantiles(spark, sf_dir):
    return finish(PR.table_quantiles(table(spark, sf_dir, "lineitem"), NUMERIC))


@register("table_histogram", sql="WITH e AS (" + _per_number(
    "SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS most FROM lineitem") + """),
v AS (""" + _per_number("SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM lineitem WHERE {c} IS NOT NULL") + """),
w AS (SELECT *, (most - least) / 10.0::DOUBLE AS width FROM e),
h AS (SELECT column_name, CASE WHEN width = 0 THEN 0 ELSE least(floor((value - least) / width), 9) END AS bin, count(*) AS n
      FROM v JOIN w USING (column_name) GROUP BY ALL),
g AS (SELECT w.*, CAST(t.b AS INTEGER) AS bin FROM w, range(0, 10) t(b))
SELECT column_name, g.bin, """ + r6("least + g.bin * width") + " AS low, " + r6(
    "CASE WHEN g.bin = 9 THEN most ELSE least + (g.bin + 1) * width END") + """ AS high, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM g LEFT JOIN h USING (column_name, bin)""", ops="Q5 (histogram)")
def table_histogram(spark, sf_dir):
    return finish(PR.table_histogram(table(spark, sf_dir, "lineitem"), NUMERIC))


@register("table_correlations", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, CAST(count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS BIGINT) AS n, "
    f"{r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM lineitem"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]), ops="Q5 (correlations)")
def table_correlations(spark, sf_dir):
    return finish(PR.correlations(table(spark, sf_dir, "lineitem"), NUMERIC))


DUPLICATES = """SELECT l_partkey % 40 AS part, l_quantity, CASE WHEN l_linenumber > 3 THEN l_returnflag END AS flag, l_linestatus
FROM lineitem"""


@register("duplicate_rows", sql=f"""
SELECT CAST(sum(k) AS BIGINT) AS n_rows, CAST(count_if(k > 1) AS BIGINT) AS duplicate_groups, CAST(sum(k - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS k FROM ({DUPLICATES}) GROUP BY part, l_quantity, flag, l_linestatus)""", ops="Q5 (duplicate rows)")
def duplicate_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return PR.duplicate_rows(li.select((F.col("l_partkey") % 40).alias("part"), "l_quantity",
                                       F.when(F.col("l_linenumber") > 3, F.col("l_returnflag")).alias("flag"), "l_linestatus"))


@register("category_coverage", sql=f"""
WITH t AS (SELECT c_custkey AS id, 0 AS pos, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Private' ELSE 'In-state' END AS category,
                  CASE WHEN c_acctbal > 0 THEN c_acctbal * CAST(3.0 AS DOUBLE) END AS v FROM customer
           UNION ALL SELECT c_custkey, 1, 'Out-of-state', CAST(20000 + c_custkey % 10000 AS DOUBLE) FROM customer),
d AS (SELECT category, v, row_number() OVER (PARTITION BY category ORDER BY min(id)) AS r FROM t WHERE v IS NOT NULL GROUP BY category, v),
s AS (SELECT category, string_agg(CAST(v AS VARCHAR), ' | ' ORDER BY r) AS samples FROM d WHERE r <= 3 GROUP BY category)
SELECT category, CAST(count(*) AS BIGINT) AS items, count(DISTINCT id) AS records,
       count(DISTINCT CASE WHEN v IS NOT NULL THEN id END) AS records_with_value, {r6('avg(v)')} AS mean_value,
       coalesce(any_value(samples), '') AS samples FROM t LEFT JOIN s USING (category) GROUP BY category""", ops="Q2")
def category_coverage(spark, sf_dir):
    rec = RB.records(spark, sf_dir)
    return finish(RC.category_coverage(rec, "ordinal", "tuition_and_fees.tuition"))


@register("athletics_coverage", sql=f"""
WITH s AS (SELECT {_sql_list(RB.SPORT_NAMES)} AS names),
t AS (SELECT c_custkey AS id, 'men' AS lst, names[c_custkey % 12 + 1] AS sport, c_custkey % 2 = 0 AS sch FROM customer, s
      UNION ALL SELECT c_custkey, 'men', names[(c_custkey * 7) % 12 + 1], false FROM customer, s
      UNION ALL SELECT c_custkey, 'women', names[(c_custkey * 5) % 12 + 1], false FROM customer, s
                WHERE c_custkey % 6 <> 0)
SELECT sport, count(DISTINCT CASE WHEN lst = 'men' THEN id END) AS records_men,
       count(DISTINCT CASE WHEN lst = 'women' THEN id END) AS records_women, count(DISTINCT id) AS records_any,
       count(DISTINCT id) AS records_with_intramural, count(DISTINCT id) AS records_with_intercollegiate,
       count(DISTINCT id) AS records_with_scholarship
FROM t GROUP BY sport""", ops="Q3")
def athletics_coverage(spark, sf_dir):
    rec = RB.records(spark, sf_dir)
    return RC.attribute_coverage(rec, "ordinal", {"men": "athletics.`Men's Sports`", "women": "athletics.`Women's Sports`"})


@register("coverage_report", sql=f"""
WITH cov AS ({_cov_sql()})
SELECT path, records, percent, samples,
       CASE WHEN length(replace(replace(replace(samples, '|', '\\|'), '[', '\\['), ']', '\\]')) > 100
            THEN substring(replace(replace(replace(samples, '|', '\\|'), '[', '\\['), ']', '\\]'), 1, 97) || '...'
            ELSE replace(replace(replace(samples, '|', '\\|'), '[', '\\['), ']', '\\]') END AS examples
FROM cov""", ops="Q4, O3, X23")
def coverage_report(spark, sf_dir):
    cov = RC.json_key_coverage(_cov_json_spark(spark, sf_dir), "id", "doc")
    return finish(RC.coverage_report(cov))


# ----------------------------- Markdown oracle ----------------------------- #
def _disp(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return (f"(CASE WHEN {s} IS NULL OR trim({s}) = '' THEN 'Not Reported' "
            f"WHEN lower({s}) IN ('true', 'yes', 'y') THEN 'Yes' WHEN lower({s}) IN ('false', 'no', 'n') THEN 'No' "
            f"ELSE regexp_replace({s}, '^\\s+|\\s+$', '', 'g') END)")


def _yn(b: str) -> str:
    return f"(CASE WHEN {b} IS NULL THEN 'Not Reported' WHEN {b} THEN 'Yes' ELSE 'No' END)"


def _pre(x: str, prefix: str = "", suffix: str = "") -> str:
    d = _disp(x)
    return f"(CASE WHEN {d} = 'Not Reported' THEN {d} ELSE '{prefix}' || {d} || '{suffix}' END)"


def _lines_sql(*parts: str) -> str:
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


def _markdown_sql() -> str:
    k = "c_custkey"
    nl = "chr(10)"
    sp = _sql_list(RB.SPORT_NAMES)
    applied = "(n_orders * 100)"
    rate = f"({k} % 90 + 5)"
    accepted = f"CAST(floor({applied} * {rate} / 100) AS BIGINT)"
    f_app = f"CAST(floor({applied} * ({k} % 60 + 20) / 100) AS BIGINT)"
    tot = f"({k} % 500 + 20)"
    full = f"CAST(floor({tot} * 2 / 3) AS BIGINT)"
    male = f"CAST(floor({tot} / 2) AS BIGINT)"
    person = (f"CASE WHEN {k} % 4 = 0 THEN '- **Contact Person:** Dean ' || CAST({k} AS VARCHAR) || ' (Director)' "
              f"WHEN {k} % 2 = 0 THEN '- **Contact Person:** Dean ' || CAST({k} AS VARCHAR) "
              f"ELSE '- **Contact Person:** Not Reported' END")
    phone = f"CASE WHEN {k} % 3 <> 0 THEN '555-' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') END"
    zipc = f"lpad(CAST({k} % 100000 AS VARCHAR), 5, '0')"
    general = _lines_sql("'## General Information'", "''",
                         f"'- **Location:** ' || {_disp('n_name')} || ', ' || {_disp('st')} || ', United States'",
                         f"'- **Address:** ' || CAST({k} AS VARCHAR) || ' College Ave, ' || {_disp('n_name')} || ', ' "
                         f"|| {_disp('st')} || ' ' || {zipc}",
                         f"'- **Phone:** ' || {_disp(phone)}", "'- **Fax:** Not Reported'",
                         f"'- **Email:** admissions' || CAST({k} AS VARCHAR) || '@example.edu'", person, "''")
    prog = lambda name, a, b: f"'- ' || {name} || ' (Bachelors: ' || {_yn(b)} || ', Associates: ' || {_yn(a)} || ')'"
    progs = (prog(f"'Program ' || CAST({k} % 7 AS VARCHAR)", f"({k} % 2 = 0)", "true") + f" || {nl} || "
             + prog(f"'Program ' || CAST({k} % 7 + 1 AS VARCHAR)", "false", f"({k} % 3 = 0)"))
    majors = (f"CASE WHEN {k} % 5 = 0 THEN 'No major and degree information reported.' || {nl} "
              f"ELSE '#### ' || {_disp('c_mktsegment')} || {nl} || {nl} || {progs} || {nl} END")
    ratio = (f"CASE WHEN {k} % 7 = 0 THEN '0:1' WHEN {k} % 7 = 1 THEN 'x:1' WHEN {k} % 7 = 2 THEN NULL "
             f"ELSE CAST({k} % 20 + 5 AS VARCHAR) || ':1' END")
    academics = _lines_sql("'## Academics'", "''", "'### Majors and Degrees'", "''", majors, "'### Faculty'", "''",
                           f"'- **Total Faculty:** ' || CAST({tot} AS VARCHAR)",
                           f"'- **Student-Faculty Ratio:** ' || {_disp(ratio)}",
                           f"'- **Full-time Faculty:** ' || CAST({full} AS VARCHAR)",
                           f"'- **Part-time Faculty:** ' || CAST({tot} - {full} AS VARCHAR)",
                           f"'- **Male Faculty:** ' || CAST({male} AS VARCHAR)",
                           f"'- **Female Faculty:** ' || CAST({tot} - {male} AS VARCHAR)", "''")
    has_g = f"({applied} IS NOT NULL)"
    req = (f"CASE {k} % 4 WHEN 0 THEN '#### Required' || {nl} || {nl} || '- Essay' || {nl} || '- Transcript' || {nl} "
           f"|| {nl} || '#### Recommended' || {nl} || {nl} || '- Interview' || {nl} "
           f"WHEN 1 THEN '#### Required' || {nl} || {nl} || '- Essay' || {nl} "
           f"ELSE 'No specific requirements reported.' || {nl} END")
    closing = f"CASE WHEN {k} % 4 <> 0 THEN '01-' || lpad(CAST({k} % 28 + 1 AS VARCHAR), 2, '0') END"
    dl = (f"'- **Fall freshmen:** Closing Date: ' || {_disp(closing)} || ', Notification: 04-01, Rolling Admissions: ' "
          f"|| {_yn(f'({k} % 2 = 1)')} || {nl} || '- **Early decision:** Closing Date: ' || "
          f"{_disp(f'CASE WHEN {k} % 3 <> 0 THEN {chr(39)}11-15{chr(39)} END')} "
          f"|| ', Notification: Not Reported, Rolling Admissions: No'")
    d = lambda e: _disp(f"CAST({e} AS DOUBLE)")
    tests = (f"CASE WHEN {k} % 5 = 0 THEN '- No specific test score data reported.' ELSE "
             f"'- **SAT Critical Reading:** Average: ' || {d(f'400 + {k} % 300')} || ', 25th Percentile: ' || "
             f"{d(f'350 + {k} % 300')} || ', 75th Percentile: ' || "
             f"{_disp(f'CASE WHEN {k} % 6 <> 0 THEN CAST(450 + {k} % 300 AS DOUBLE) END')} || {nl} || "
             f"'- **SAT Math:** Average: ' || {d(f'420 + {k} % 280')} || ', 25th Percentile: ' || {d(f'370 + {k} % 280')} "
             f"|| ', 75th Percentile: ' || {d(f'470 + {k} % 280')} || {nl} || "
             f"'- **ACT Composite:** Average: ' || {d(f'15 + {k} % 20')} || ', 25th Percentile: ' || {d(f'12 + {k} % 20')} "
             f"|| ', 75th Percentile: ' || {d(f'18 + {k} % 20')} END")
    admissions = _lines_sql(
        "'## Admissions'", "''", "'### Overview'", "''",
        f"'- **Acceptance Rate:** ' || {_pre(f'CAST({rate} AS DOUBLE)', suffix='%')}",
        f"'- **Applied:** ' || {_disp(applied)}", f"'- **Accepted:** ' || {_disp(accepted)}",
        f"'- **Enrolled:** ' || {_disp(f'CAST(floor({accepted} / 3) AS BIGINT)')}",
        f"'- **Female Applied:** ' || {_disp(f'CASE WHEN {has_g} THEN {f_app} END')}",
        "'- **Female Accepted:** Not Reported'",
        f"'- **Female Acceptance Rate:** ' || {_pre(f'CASE WHEN {has_g} THEN CAST({k} % 50 + 10 AS DOUBLE) END', suffix='%')}",
        f"'- **Male Applied:** ' || {_disp(f'CASE WHEN {has_g} THEN {applied} - {f_app} END')}",
        "'- **Male Accepted:** Not Reported'", "'- **Male Acceptance Rate:** Not Reported'",
        "''", "'### Application Details'", "''",
        f"'- **Application Fee:** ' || {_pre(f'CAST(({k} % 10) * 10 AS DOUBLE)', prefix='$')}",
        f"'- **Average High School GPA:** ' || {_disp(f'2.5 + ({k} % 15) / 10.0')}",
        "''", "'### Requirements'", "''", req, "'### Application Deadlines'", "''", dl, "''",
        "'### Test Scores Accepted'", "''", tests, "''")
    cat1 = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Private' ELSE 'In-state' END"
    tu = (f"'- **Tuition (' || {cat1} || '):** ' || {_pre('CASE WHEN c_acctbal > 0 THEN c_acctbal * 3.0 END', prefix='$')}"
          f" || {nl} || '- **Tuition (Out-of-state):** ' || {_pre(f'CAST(20000 + {k} % 10000 AS DOUBLE)', prefix='$')}")
    fe = (f"'- **Fees (Room & board):** ' || {_pre(f'CAST(8000 + {k} % 3000 AS DOUBLE)', prefix='$')} || {nl} || "
          f"'- **Fees (Full-time student fees):** ' || "
          f"{_pre(f'CASE WHEN {k} % 2 <> 0 THEN CAST(500 + {k} % 500 AS DOUBLE) END', prefix='$')}")
    aid = [("Average Financial Aid Package", f"CAST(10000 + {k} % 5000 AS DOUBLE)"),
           ("Average Freshman Financial Aid Package", f"CASE WHEN {k} % 3 <> 0 THEN CAST(9000 + {k} % 4000 AS DOUBLE) END"),
           ("Average International Financial Aid Package", "CAST(NULL AS DOUBLE)"),
           ("Average Loan Aid", f"CAST(5000 + {k} % 2000 AS DOUBLE)"),
           ("Average Grant Aid", f"CAST(6000 + {k} % 3000 AS DOUBLE)"),
           ("Average Scholarship and Grant Aid Awarded", f"CAST(7000 + {k} % 3500 AS DOUBLE)")]
    cov = [("Percentage of Students Receiving Financial Aid Who Had Need", f"CAST({k} % 100 AS DOUBLE)"),
           ("Average Percentage of Financial Need Met", f"CAST(50 + {k} % 50 AS DOUBLE)"),
           ("Percentage of Students Whose Financial Need Was Fully Met", f"CASE WHEN {k} % 4 <> 0 THEN CAST({k} % 30 AS DOUBLE) END")]
    tuition = _lines_sql("'## Tuition and Financial Aid'", "''", "'### Tuition & Fees'", "''", tu, fe,
                         f"CASE WHEN {k} % 4 = 0 THEN '- **Other Payment Considerations:** Installment plans' END", "''",
                         "'### Financial Aid Overview'", "''",
                         *[f"'- **{lab}:** ' || {_pre(e, prefix='$')}" for lab, e in aid],
                         *[f"'- **{lab}:** ' || {_pre(e, suffix='%')}" for lab, e in cov], "''")
    life = f"({k} % 11 <> 0)"
    opt = lambda cond, *lines: f"CASE WHEN {life} AND {cond} THEN {_lines_sql(*lines)} END"
    or_none = lambda cond, *lines: (f"CASE WHEN {life} AND {cond} THEN {_lines_sql(*lines)} "  # noqa: E731
                                    "ELSE '- Not Reported' END")
    num = lambda cond, x: f"CASE WHEN {cond} THEN CAST(CAST({x} AS DOUBLE) AS VARCHAR) END"
    campus = _lines_sql(
        "'## Campus Life'", "''",
        opt(f"{k} % 3 <> 2", "'### Student Body'", "''",
            f"'- **Total Undergraduate Students:** ' || CASE WHEN {k} % 5 <> 0 THEN CAST({k} % 9000 + 100 AS VARCHAR) END",
            f"'- **International Students:** ' || {num(f'{k} % 4 <> 0', f'{k} % 30')} || '%'",
            f"'- **Out-of-State Students:** ' || {num(f'{k} % 6 <> 0', f'{k} % 60')} || '%'",
            f"'- **Gender Distribution:** Male: ' || {num(f'{k} % 2 = 0', f'{k} % 100')} || '%, Female: ' || "
            f"{num(f'{k} % 8 <> 0', f'100 - {k} % 100')} || '%'", "''"),
        "'### Housing'", "''",
        f"'- **College-Owned Housing Available:** ' || CASE WHEN {life} THEN {_yn(f'({k} % 3 <> 0)')} ELSE 'Not Reported' END",
        f"'- **Housing Requirements:** ' || CASE WHEN {life} THEN {_yn(f'({k} % 2 = 0)')} ELSE 'Not Reported' END",
        f"'- **Housing Options:** ' || CASE WHEN {life} AND {k} % 4 <> 0 THEN 'Co-ed dorms, Apartments' ELSE 'Not Reported' END",
        f"'- **Percent Undergrads in College Housing:** ' || CASE WHEN {life} THEN "
        f"{_pre(f'CASE WHEN {k} % 7 <> 0 THEN CAST({k} % 100 AS DOUBLE) END', suffix='%')} ELSE 'Not Reported' END", "''",
        "'### Student Activities'", "''", or_none(f"{k} % 3 = 1", "'- Band'", "'- Choir'"), "''",
        "'### Student Services'", "''", or_none(f"{k} % 4 <> 0", "'- Health service'"), "''",
        "'### Student Organizations'", "''", or_none(f"{k} % 5 <> 0", "'- Chess, and go'", "'- Debate'"),
        opt(f"{k} % 4 = 1", "''", "'#### Most Popular Organizations'", "''", "'- Zeta'", "'- Alpha'"), "''",
        opt(f"{k} % 5 = 1", "'### Campus Events'", "''", "'- Homecoming'", "''"),
        "'### Campus Security and Safety'", "''",
        f"CASE WHEN {life} AND {k} % 5 = 0 THEN '- 24-hour patrols' || {nl} || '- Late-night transport' "
        f"WHEN {life} AND {k} % 5 = 1 THEN '- Patrols: Yes' "
        f"WHEN {life} AND {k} % 5 = 3 THEN {_lines_sql(repr('- Emergency services: Yes'), repr('- Patrols: No'), repr('- Transport services: Until midnight'), repr('- Additional security: Cameras'))} "
        "ELSE '- Not Reported' END", "''")
    div = f"'Division ' || CAST({k} % 3 + 1 AS VARCHAR)"
    sport = lambda name, sch, intra: (f"'- **' || {name} || ':** Intercollegiate: ' || {div} || ', Scholarship: ' || "  # noqa: E731
                                      f"{_yn(sch)} || ', Intramural: ' || {_yn(intra)}")
    men = sport(f"{sp}[{k} % 12 + 1]", f"({k} % 2 = 0)", f"({k} % 3 = 0)") + f" || {nl} || " + \
        sport(f"{sp}[({k} * 7) % 12 + 1]", "false", "true")
    women = (f"CASE WHEN {k} % 6 <> 0 THEN " + sport(f"{sp}[({k} * 5) % 12 + 1]", "false", "false")
             + " ELSE '- No women''s sports data reported.' END")
    sports = f"({k} % 13 <> 0)"
    athletics = _lines_sql("'## Athletics'", "''", "'### Men''s Sports'", "''",
                           f"CASE WHEN {sports} THEN {men} ELSE '- No men''s sports data reported.' END", "''",
                           "'### Women''s Sports'", "''",
                           f"CASE WHEN {sports} THEN {women} ELSE '- No women''s sports data reported.' END", "''")
    sign = lambda cond: f"CASE WHEN {cond} THEN '✅' ELSE '❌' END"
    shown = [("Location and Contact Information", "true"), ("Academic Information", "true"), ("Admissions Information", "true"),
             ("Tuition and Financial Aid", "true"), ("Campus Life Information", life), ("Athletics Information", sports)]
    complete = _lines_sql(
        "'## Data Completeness'", "''",
        "'This section shows which data categories are available for this university:'", "''",
        *[f"CASE WHEN {c} THEN '✅ {lab}' END" for lab, c in shown], *[f"CASE WHEN NOT {c} THEN '❌ {lab}' END" for lab, c in shown],
        "''", "'### Detailed Data Availability'", "''",
        f"CASE WHEN {life} THEN " + _lines_sql(
            "'**Campus Life Details:**'", "'- Housing Information: ✅'", f"'- Student Activities: ' || {sign(f'{k} % 3 = 1')}",
            f"'- Student Services: ' || {sign(f'{k} % 4 <> 0')}", f"'- Student Organizations: ' || {sign(f'{k} % 5 <> 0')}",
            f"'- Campus Security: ' || {sign(f'{k} % 5 IN (0, 1, 3)')}",
            f"'- Most Popular Organizations: ' || {sign(f'{k} % 4 = 1')}", f"'- Campus Events: ' || {sign(f'{k} % 5 = 1')}",
            f"'- Student Body Demographics: ' || {sign(f'{k} % 3 <> 2')}", "''") + " END",
        "'**Admissions Details:**'", "'- Overall Statistics: ✅'", f"'- Gender-based Statistics: ' || {sign(f'{applied} IS NOT NULL')}",
        f"'- Requirements: ' || {sign(f'{k} % 4 IN (0, 1)')}", "'- Application Deadlines: ✅'",
        f"'- Test Score Information: ' || {sign(f'{k} % 5 <> 0')}", "''",
        f"CASE WHEN {sports} THEN " + _lines_sql(
            "'**Athletics Details:**'", "'- Men''s Sports: ✅ (2 sports)'",
            f"'- Women''s Sports: ' || CASE WHEN {k} % 6 <> 0 THEN '✅ (1 sports)' ELSE '❌ (0 sports)' END", "''") + " END")
    doc_id = _doc_id_sql()
    md = _lines_sql("'# ' || c_name", "''", f"'**Document ID:** `' || {doc_id} || '`'", "''",
                    general, academics, admissions, tuition, campus, athletics, complete)
    return f"""
SELECT document_id, university_name, filename, slug, json_index, CAST(length(markdown) AS INTEGER) AS chars, markdown
FROM (SELECT {doc_id} AS document_id, c_name AS university_name,
             {sql_slug('c_name')} || '_' || {doc_id} || '.md' AS filename, {sql_slug('c_name')} AS slug,
             c_custkey AS json_index, {md} AS markdown
      FROM (SELECT *, {STATE_SQL} AS st FROM {CUST} x) y) z"""


MARKDOWN_SQL = _markdown_sql()


register("record_markdown", sql=MARKDOWN_SQL, ops="D12, D12a-g, X11, X21, X22, N12")(record_markdown)
