"""Record-linkage queries (X8, X9, W11, L1, L2, P11, U2) on the driver pages.

Binding: pages are the scraped candidates of 'entities' (three consecutive
page ids per entity).  The expected name of an entity is the title of its
middle page (padded with blanks, or reversed for every fourth entity so that the
fuzzy tier is exercised); the expected town is the host of one of its pages;
every seventh page counts as a failed scrape.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import norm_text
from ..operators import linkage as LK
from ..operators import pages as PG
from ..sources.tables import table
from .catalog import r6, register
from .q_text import sql_html_text, sql_norm

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


def candidates(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    heading = PG.html_text(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1))
    base = p.select(
        F.floor(F.col("page_id") / 3).cast("bigint").alias("entity_id"),
        F.pmod(F.col("page_id"), F.lit(3)).cast("int").alias("candidate_pos"),
        F.col("url").alias("URL"),
        PG.page_heading(F.col("html")).alias("_title"),
        F.when(F.pmod(F.col("page_id"), F.lit(7)) != 0, heading).alias("Scraped_Name"),
        F.when(F.pmod(F.col("page_id"), F.lit(7)) != 0, F.regexp_extract("url", HOST, 1)).alias("Scraped_Location"),
        (F.pmod(F.col("page_id"), F.lit(7)) != 0).alias("Scrape_Success"),
        F.regexp_extract("url", HOST, 1).alias("_host"))
    ent = base.groupBy("entity_id").agg(
        F.max(F.when(F.col("candidate_pos") == 1, F.col("_title"))).alias("_t"),
        F.max(F.when(F.col("candidate_pos") == F.pmod(F.col("entity_id"), F.lit(3)), F.col("_host"))).alias("Town"))
    name = F.when(F.pmod(F.col("entity_id"), F.lit(4)) == 0, F.reverse("_t")).otherwise(
        F.concat(F.lit(" "), F.col("_t"), F.lit("  ")))
    ent = ent.select("entity_id", name.alias("University"), "Town")
    return base.drop("_title", "_host").join(ent, on="entity_id", how="inner")


def sql_lcs(a: str, b: str) -> str:
    inner = (f"list_reduce(list_transform(generate_series(1, length({b})), lambda j: j), "
             f"lambda acc, j: list_append(acc, CASE WHEN ca = substring({b}, j, 1) THEN prev[j] + 1 "
             f"ELSE greatest(prev[j + 1], acc[j]) END), [0])")
    outer = (f"list_reduce(string_split({a}, ''), lambda prev, ca: {inner}, "
             f"list_transform(generate_series(0, length({b})), lambda j: 0))")
    return f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE {outer}[-1] END)"


def sql_ratio(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE CAST(round_even(100.0 * "
            f"((2.0 * {sql_lcs(a, b)}) / CAST(length({a}) + length({b}) AS DOUBLE)), 0) AS INTEGER) END)")


@register("fuzzy_ratio", sql=f"""
SELECT c.c_custkey, {sql_ratio(sql_norm('c.c_name'), sql_norm('n.n_name'))} AS name_ratio,
       {sql_ratio(sql_norm('c.c_mktsegment'), sql_norm('r.r_name'))} AS segment_ratio
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
          ops="X7, X9")
def fuzzy_ratio(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select("c_custkey",
                    LK.similarity_ratio_arrow(norm_text("c_name"), norm_text("n_name")).alias("name_ratio"),
                    LK.similarity_ratio_arrow(norm_text("c_mktsegment"), norm_text("r_name")).alias("segment_ratio"))


def _cands_sql() -> str:
    host = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"
    title = (f"regexp_replace({sql_html_text(chr(39).join(['regexp_extract(html, ', '(?s)<title[^>]*>(.*?)</title>', ', 1)']))}, "
             f"'\\s*-\\s*Tuition and Acceptance Rate.*$', '')")
    heading = sql_html_text("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")
    return f"""
base AS (SELECT CAST(floor(page_id / 3) AS BIGINT) AS entity_id, CAST(page_id % 3 AS INTEGER) AS candidate_pos,
                url AS URL, {title} AS t, {host} AS h, page_id % 7 <> 0 AS Scrape_Success,
                CASE WHEN page_id % 7 <> 0 THEN {heading} END AS Scraped_Name,
                CASE WHEN page_id % 7 <> 0 THEN {host} END AS Scraped_Location
         FROM pages),
ent AS (SELECT entity_id,
               CASE WHEN entity_id % 4 = 0 THEN reverse(max(CASE WHEN candidate_pos = 1 THEN t END))
                    ELSE ' ' || max(CASE WHEN candidate_pos = 1 THEN t END) || '  ' END AS University,
               max(CASE WHEN candidate_pos = entity_id % 3 THEN h END) AS Town
        FROM base GROUP BY entity_id),
c0 AS (SELECT b.entity_id, b.candidate_pos, b.URL, b.Scraped_Name, b.Scraped_Location, b.Scrape_Success,
              e.University, e.Town FROM base b JOIN ent e USING (entity_id)),
c1 AS (SELECT *, Scrape_Success AND Scraped_Name IS NOT NULL AND
                 (contains({sql_norm('University')}, {sql_norm('Scraped_Name')})
                  OR contains({sql_norm('Scraped_Name')}, {sql_norm('University')})) AS Name_Match,
                 Scrape_Success AND Scraped_Location IS NOT NULL AND
                 (contains({sql_norm('Town')}, {sql_norm('Scraped_Location')})
                  OR contains({sql_norm('Scraped_Location')}, {sql_norm('Town')})) AS Location_Match
       FROM c0),
c2 AS (SELECT *, Name_Match AND Location_Match AS Overall_Match,
              max(CASE WHEN Scrape_Success THEN Name_Match ELSE false END) OVER (PARTITION BY entity_id) AS ex
       FROM c1),
c3 AS (SELECT *, CASE WHEN Scrape_Success AND NOT ex THEN
                   CASE WHEN Scraped_Name IS NULL THEN 0
                        ELSE {sql_ratio(sql_norm('University'), sql_norm('Scraped_Name'))} END END AS Name_Similarity,
              CASE WHEN NOT Scrape_Success THEN 9 WHEN Name_Match AND Location_Match THEN 1
                   WHEN Name_Match THEN 2 ELSE 3 END AS tier
       FROM c2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id
                                 ORDER BY tier, Name_Similarity DESC NULLS LAST, candidate_pos) AS rn FROM c3)
         WHERE rn = 1)"""


LINK_COLS = ("entity_id, candidate_pos, URL, University, Town, Scraped_Name, Scraped_Location, Scrape_Success, "
             "Name_Match, Location_Match, Overall_Match, Name_Similarity")


@register("link_best_match", sql=f"""
WITH {_cands_sql()}
SELECT {LINK_COLS},
       CASE tier WHEN 1 THEN 'overall_match' WHEN 2 THEN 'name_match' WHEN 3 THEN 'fuzzy_match'
                 ELSE 'all_failed' END AS status,
       CASE WHEN tier = 9 THEN 'All URLs failed to scrape' ELSE '' END AS Error
FROM best""", ops="L1, W11, X7, X8, X9, J13")
def link_best_match(spark, sf_dir):
    best = LK.link_best_match(candidates(spark, sf_dir), entity="entity_id")
    return best.select(*[c.strip() for c in LINK_COLS.split(",")], "status", "Error")


@register("link_accept", sql=f"""
WITH {_cands_sql()},
acc AS (SELECT *, CASE WHEN Overall_Match THEN 1 WHEN Name_Match THEN 2
                       WHEN Location_Match AND Name_Similarity > 60 THEN 3
                       WHEN NOT Location_Match AND Name_Similarity > 90 THEN 4 END AS acc_tier
        FROM best)
SELECT Scraped_Name, Scraped_Location, URL,
       arg_min(entity_id, struct_pack(t := acc_tier, r := entity_id)) AS entity_id,
       arg_min(University, struct_pack(t := acc_tier, r := entity_id)) AS University,
       min(acc_tier) AS tier
FROM acc WHERE acc_tier IS NOT NULL GROUP BY Scraped_Name, Scraped_Location, URL""", ops="L2, P11, U2, A16")
def link_accept(spark, sf_dir):
    best = LK.link_best_match(candidates(spark, sf_dir), entity="entity_id")
    acc = LK.link_accept(best.withColumn("row_id", F.col("entity_id")))
    return acc.select("Scraped_Name", "Scraped_Location", "URL", "entity_id", "University", "tier")


@register("link_totals", sql=f"""
WITH {_cands_sql()}
SELECT CAST(count(DISTINCT (University, Town)) AS BIGINT) AS entity_groups,
       CAST(count(*) AS BIGINT) AS total_urls,
       CAST(count_if(Scrape_Success) AS BIGINT) AS scraped_urls,
       CAST(count(DISTINCT URL) AS BIGINT) AS distinct_urls
FROM c0""", ops="A19")
def link_totals(spark, sf_dir):
    c = candidates(spark, sf_dir)
    return c.agg(F.count_distinct(F.struct("University", "Town")).alias("entity_groups"),
                 F.count(F.lit(1)).alias("total_urls"),
                 F.count_if(F.col("Scrape_Success")).alias("scraped_urls"),
                 F.count_distinct("URL").alias("distinct_urls"))
