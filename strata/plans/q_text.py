"""Queries over pages and documents (D13-D17, X1-X23) and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as X
from ..operators import pages as PG
from ..sources.tables import table
from . import pages_binding as PB
from .catalog import register


# ----------------------------- SQL helpers --------------------------------- #
def sql_html_text(x: str) -> str:
    s = f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        s = f"replace({s}, '{ent}', '{ch}')"
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


def sql_slug(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' OR {x} = 'Not Reported' THEN 'unknown' ELSE "
            f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') END")


def sql_folder(x: str) -> str:
    s = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g')"
    s = f"regexp_replace({s}, '[-\\s]+', '_', 'g')"
    return f"regexp_replace(lower({s}), '^_+|_+$', '', 'g')"


def sql_norm(x: str) -> str:
    return (f"regexp_replace(lower(regexp_replace(coalesce({x}, ''), '^\\s+|\\s+$', '', 'g')), "
            f"'\\s+', ' ', 'g')")


def sql_year(x: str) -> str:
    return (f"CASE WHEN regexp_extract({x}, '(20\\d{{2}}-\\d{{2}})', 1) <> '' "
            f"THEN regexp_extract({x}, '(20\\d{{2}}-\\d{{2}})', 1) "
            f"WHEN regexp_extract({x}, '(20\\d{{2}})', 1) <> '' THEN regexp_extract({x}, '(20\\d{{2}})', 1) END")


def sql_basename(x: str) -> str:
    path = f"regexp_extract({x}, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)"
    return f"regexp_extract({path}, '([^/]+)$', 1)"


LINK_SQL = PG.LINK.replace("'", "''")


# --------------------------------------------------------------------------- #
@register("page_titles", sql=f"""
SELECT page_id, title, {sql_slug('title')} AS title_slug, {sql_folder('title')} AS title_folder,
       {sql_norm('title')} AS title_norm, heading,
       CASE WHEN heading IS NULL THEN false
            ELSE contains({sql_norm('title')}, {sql_norm('heading')})
              OR contains({sql_norm('heading')}, {sql_norm('title')}) END AS heading_matches
FROM (SELECT page_id,
             CASE WHEN regexp_matches(html, '(?s)<title[^>]*>')
                  THEN regexp_replace({sql_html_text("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")},
                                      '\\s*-\\s*Tuition and Acceptance Rate.*$', '')
                  ELSE 'Unknown University' END AS title,
             CASE WHEN regexp_matches(html, '(?s)<h1[^>]*>')
                  THEN {sql_html_text("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} END AS heading
      FROM pages) p""", ops="D13, X7, X8, X10, X14")
def page_titles(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    title = PG.page_heading(F.col("html"))
    heading = F.when(F.col("html").rlike(r"(?s)<h1[^>]*>"),
                     PG.html_text(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)))
    t = p.select("page_id", title.alias("title"), heading.alias("heading"))
    return t.select("page_id", "title", X.slug("title").alias("title_slug"),
                    X.safe_folder("title").alias("title_folder"), X.norm_text("title").alias("title_norm"),
                    "heading", X.contains_either("title", "heading").alias("heading_matches"))


@register("page_links", sql=f"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS link_pos, href, text, {sql_year('text')} AS year,
       {sql_basename('href')} AS filename,
       (ends_with(href, '.csv') OR ends_with(href, '.xls') OR ends_with(href, '.xlsx')
        OR ends_with(href, '.zip')) AS is_data_file,
       'https://example.com' || href AS absolute_url,
       replace(replace(replace(replace('https://example.com' || href, 'https://', ''), 'http://', ''), '/', '_'), ':', '')
         AS url_file,
       regexp_replace(text, '[<>:"/\\|?*]', '_', 'g') AS safe_name
FROM (SELECT page_id, href, {sql_html_text('raw')} AS text, pos
      FROM (SELECT page_id,
                   unnest(regexp_extract_all(html, '{LINK_SQL}', 1)) AS href,
                   unnest(regexp_extract_all(html, '{LINK_SQL}', 2)) AS raw,
                   unnest(generate_series(1, len(regexp_extract_all(html, '{LINK_SQL}', 1)))) AS pos
            FROM pages) a) b""", ops="D16, X13, X14, X15, N7")
def page_links(spark, sf_dir):
    links = PG.page_links(table(spark, sf_dir, "pages"))
    links = links.withColumn("absolute_url", F.concat(F.lit("https://example.com"), F.col("href")))
    return links.withColumns({"url_file": X.url_filename("absolute_url"), "safe_name": X.safe_filename("text")})


@register("candidate_urls", sql=f"""
SELECT page_id, count(*) AS n_urls, string_agg(u, ' ' ORDER BY first_pos) AS urls
FROM (SELECT page_id, u, min(pos) AS first_pos
      FROM (SELECT page_id, 'https://example.com' || href AS u, pos
            FROM (SELECT page_id, unnest(regexp_extract_all(html, '{LINK_SQL}', 1)) AS href,
                         unnest(generate_series(1, len(regexp_extract_all(html, '{LINK_SQL}', 1)))) AS pos
                  FROM pages) a WHERE contains(href, '/')) b
      GROUP BY page_id, u) c
GROUP BY page_id""", ops="D16, A19")
def candidate_urls(spark, sf_dir):
    c = PG.candidate_links(table(spark, sf_dir, "pages"), marker="/", base="https://example.com")
    c = c.where(F.size("urls") > 0)
    return c.select("page_id", F.size("urls").cast("bigint").alias("n_urls"), F.array_join("urls", " ").alias("urls"))


@register("majors_table", sql="""
WITH r AS (SELECT p_partkey AS k, p_partkey // 8 AS page_id, p_partkey % 4 = 1 AS is_cat, p_brand, p_size,
             p_name || ' & ' || p_partkey AS name FROM part),
c AS (SELECT *, sum(CAST(is_cat AS INTEGER)) OVER (PARTITION BY page_id ORDER BY k) AS cat_idx FROM r),
g AS (SELECT page_id, cat_idx, max(CASE WHEN is_cat THEN p_brand END) AS category FROM c GROUP BY ALL)
SELECT page_id, CAST(page_id % 2 + 1 AS INTEGER) AS layout, category, name, p_size % 2 = 0 AS offers_associate, p_size % 3 = 0 AS offers_bachelors,
  CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS place
FROM c JOIN g USING (page_id, cat_idx) WHERE NOT is_cat AND (page_id % 2 = 1 OR cat_idx > 0)""",
          ops="D14 (both layouts, on pages built from part)")
def majors_table(spark, sf_dir):
    out = None
    for layout in (1, 2):
        m = PG.majors_table(PB.majors_pages(spark, sf_dir, layout), layout=layout)
        flat = F.flatten(F.transform("majors_and_degrees", lambda c: F.transform(c["programs"], lambda p: F.struct(
            c["category"].alias("category"), p["name"].alias("name"), p["offers_associate"].alias("offers_associate"),
            p["offers_bachelors"].alias("offers_bachelors")))))
        one = m.select("page_id", F.lit(layout).alias("layout"), F.posexplode(flat).alias("place", "p")) \
            .select("page_id", "layout", "p.*", "place")
        out = one if out is None else out.unionByName(one)
    return out


CATALOGUE_SQL = """
WITH r AS (SELECT p_partkey AS k, p_partkey // 8 AS page_id, p_type || ' - Tests & more' AS category, p_name AS description,
             'https://example.com/f/' || replace(p_brand, '#', '-') || '/' || p_partkey || '.csv' AS url,
             CASE WHEN p_partkey % 3 = 0 THEN '20' || lpad(CAST(p_partkey % 20 + 1 AS VARCHAR), 2, '0') || '-' ||
                    lpad(CAST(p_partkey % 20 + 2 AS VARCHAR), 2, '0')
                  WHEN p_partkey % 3 = 1 THEN '2015' END AS year,
             p_partkey || '.csv' AS filename, lower(p_type) || '_tests_more' AS folder
           FROM part WHERE p_partkey % 7 > 1 AND p_partkey // 8 % 9 <> 0)
"""


@register("catalogue_links", sql=CATALOGUE_SQL + """
SELECT page_id, category, description, url, year, filename, folder || '/' || coalesce(year, 'unknown_year') || '/' || filename AS path
FROM r WHERE (year IS NULL OR year IN ('2015', '2007-08', '2010-11'))
  AND folder || '/' || coalesce(year, 'unknown_year') || '/' || filename NOT IN (
    SELECT lower(p_type) || '_tests_more/2015/' || p_partkey || '.csv' FROM part WHERE p_partkey % 5 = 0)""",
          ops="D15, D19, P15 (on pages built from part)")
def catalogue_links(spark, sf_dir):
    links = PG.filter_catalogue(PG.catalogue_links(PB.catalogue_pages(spark, sf_dir)), years=["2015", "2007-08", "2010-11"])
    done = table(spark, sf_dir, "part").where(F.col("p_partkey") % 5 == 0).select(F.concat(
        F.lower("p_type"), F.lit("_tests_more/2015/"), F.col("p_partkey").cast("string"), F.lit(".csv")).alias("path"))
    return PG.target_paths(links, done).select("page_id", "category", "description", "url", "year", "filename", "path")


@register("catalogue_categories", sql=CATALOGUE_SQL + "SELECT DISTINCT category FROM r", ops="D17 (on pages built from part)")
def catalogue_categories(spark, sf_dir):
    return PG.categories(PG.catalogue_links(PB.catalogue_pages(spark, sf_dir)))


# --------------------------------------------------------------------------- #
def _doc_sql() -> str:
    prev = "CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END"
    cell = "replace(replace(replace(text, '|', '\\|'), '[', '\\['), ']', '\\]')"
    cell = f"CASE WHEN length({cell}) > 100 THEN substring({cell}, 1, 97) || '...' ELSE {cell} END"
    lang_q = "'\"' || lang || '\"'"
    return f"""
SELECT doc_id, {prev} AS preview, {cell} AS table_cell, {sql_year('text')} AS year,
       CAST(length({sql_norm('text')}) AS INTEGER) AS norm_chars, {sql_slug('source')} AS source_slug,
       CASE WHEN lang IS NULL OR trim(lang) = '' THEN 'Not Reported'
            WHEN lower(lang) IN ('true', 'yes', 'y') THEN 'Yes' WHEN lower(lang) IN ('false', 'no', 'n') THEN 'No'
            ELSE regexp_replace(lang, '^\\s+|\\s+$', '', 'g') END AS lang_display,
       regexp_replace(lower({lang_q}), '^[''"]+|[''"]+$', '', 'g') AS lang_unquoted,
       CASE WHEN regexp_full_match(CAST(n_chars AS VARCHAR), '[0-9]+') THEN CAST(n_chars AS BIGINT) END AS n_digits,
       '$' || CAST(n_chars AS VARCHAR) AS n_chars_money
FROM documents"""


@register("text_scalars", sql=_doc_sql(), ops="X7, X10, X13, X19, X20, X21, X22, X23")
def text_scalars(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", X.preview("text").alias("preview"), X.table_cell("text").alias("table_cell"),
        X.year_in_text("text").alias("year"), F.length(X.norm_text("text")).alias("norm_chars"),
        X.slug("source").alias("source_slug"), X.display("lang").alias("lang_display"),
        X.strip_quotes_lower(F.concat(F.lit('"'), F.col("lang"), F.lit('"'))).alias("lang_unquoted"),
        X.digits_int(F.col("n_chars")).alias("n_digits"),
        X.with_prefix(F.col("n_chars"), prefix="$").alias("n_chars_money"))


# --------------------------------------------------------------------------- #
WITHDRAWAL = list(K.WITHDRAWAL_GROUPS) + ["Moved Away"]
ENROLMENT = list(K.ENROLLMENT_GROUPS) + ["Other Reason"]


def _sql_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _sql_map_case(x: str, groups: dict) -> str:
    whens = " ".join(f"WHEN {x} = '{value}' THEN '{group}'" for value, group in groups.items())
    return f"CASE {whens} ELSE 'Unclassified' END"


@register("reason_groups", sql=f"""
SELECT withdrawal_group, enrollment_group, CAST(count(*) AS BIGINT) AS n_customers
FROM (SELECT {_sql_map_case('w', K.WITHDRAWAL_GROUPS)} AS withdrawal_group,
             {_sql_map_case('e', K.ENROLLMENT_GROUPS)} AS enrollment_group
      FROM (SELECT {_sql_list(WITHDRAWAL)}[c_custkey % {len(WITHDRAWAL)} + 1] AS w,
                   {_sql_list(ENROLMENT)}[(c_custkey * 7) % {len(ENROLMENT)} + 1] AS e
            FROM customer) a) b
GROUP BY ALL""", ops="X2, M12 (grouping)")
def reason_groups(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    w = F.element_at(F.array(*[F.lit(x) for x in WITHDRAWAL]), F.pmod("c_custkey", F.lit(len(WITHDRAWAL))).cast("int") + 1)
    e = F.element_at(F.array(*[F.lit(x) for x in ENROLMENT]),
                     F.pmod(F.col("c_custkey") * 7, F.lit(len(ENROLMENT))).cast("int") + 1)
    g = c.select(X.reason_group(w, "withdrawal").alias("withdrawal_group"),
                 X.reason_group(e, "enrollment").alias("enrollment_group"))
    return g.groupBy("withdrawal_group", "enrollment_group").agg(F.count(F.lit(1)).alias("n_customers"))


CODES = sorted(K.STATE_NAMES)


def _sql_state(x: str) -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in K.STATE_NAMES.items())
    return f"CASE {whens} ELSE {x} END"


def _sql_region(x: str) -> str:
    whens = " ".join(f"WHEN {x} = '{state}' THEN '{region}'" for state, region in K.CENSUS_REGIONS.items())
    return f"CASE {whens} ELSE 'Other' END"


@register("region_lookup", sql=f"""
SELECT c_custkey, code, state, {_sql_region('state')} AS region
FROM (SELECT c_custkey, code, {_sql_state('code')} AS state
      FROM (SELECT c.c_custkey, {_sql_list(CODES + ['ZZ'])}[n.n_nationkey * 3 % {len(CODES) + 1} + 1] AS code
            FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) a) b""", ops="X3, X4, J1")
def region_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    codes = F.array(*[F.lit(x) for x in CODES + ["ZZ"]])
    j = c.join(n, on="n_nationkey", how="inner")
    code = F.element_at(codes, F.pmod(F.col("n_nationkey") * 3, F.lit(len(CODES) + 1)).cast("int") + 1)
    s = j.select("c_custkey", code.alias("code")).withColumn("state", X.state_name("code"))
    return s.withColumn("region", X.region_of("state"))


def _grade_raw_spark():
    ln = F.col("l_linenumber").cast("string")
    k = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(8))
    return (F.when(k == 0, F.lpad(ln, 2, "0")).when(k == 1, F.concat(ln, F.lit(".0")))
            .when(k == 2, F.lit("kk")).when(k == 3, F.lit(" HS ")).when(k == 4, F.lit("Pre-K"))
            .when(k == 5, (F.col("l_linenumber") + 10).cast("string")).when(k == 6, F.lit("Kindergarten"))
            .otherwise(F.concat(F.lit("x"), ln)))


GRADE_RAW_SQL = """CASE (l_orderkey + l_linenumber) % 8 WHEN 0 THEN lpad(CAST(l_linenumber AS VARCHAR), 2, '0')
  WHEN 1 THEN CAST(l_linenumber AS VARCHAR) || '.0' WHEN 2 THEN 'kk' WHEN 3 THEN ' HS ' WHEN 4 THEN 'Pre-K'
  WHEN 5 THEN CAST(l_linenumber + 10 AS VARCHAR) WHEN 6 THEN 'Kindergarten'
  ELSE 'x' || CAST(l_linenumber AS VARCHAR) END"""


def _sql_grade(x: str) -> str:
    t = f"trim({x})"
    u = f"upper({t})"
    num = f"TRY_CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS BIGINT)"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {u} IN ('KINDERGARTEN', 'KK', 'K') THEN 'K' "
            f"WHEN {u} IN ('PK', 'PRE-K', 'PREK') THEN 'PK' WHEN {u} IN ('HS', 'HIGH SCHOOL') THEN 'HS' "
            f"WHEN {num} BETWEEN 1 AND 12 THEN CAST({num} AS VARCHAR) ELSE {t} END")


@register("grade_standardise", sql=f"""
SELECT raw_grade, {_sql_grade('raw_grade')} AS grade, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {GRADE_RAW_SQL} AS raw_grade FROM lineitem) a GROUP BY ALL""", ops="X1, X20, A6")
def grade_standardise(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(_grade_raw_spark().alias("raw_grade"))
    return li.groupBy("raw_grade", X.standard_grade("raw_grade").alias("grade")).agg(
        F.count(F.lit(1)).alias("n"))
