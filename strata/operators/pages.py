"""Stored HTML pages -> tables (D13-D19), with regular expressions in Catalyst.

Every parser works on the whole page text of each row; rows explode into one
row per table row / link, so a page never crosses tasks and no page is cut.
Patterns are parameters: they hold only for the page layouts they name, and
malformed pages give nulls or no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import safe_folder, url_basename, year_in_text

DATA_EXTENSIONS = (".csv", ".xls", ".xlsx", ".zip")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def html_text(c) -> Column:
    """Visible text of an HTML fragment: tags removed, the five basic entities
    decoded, whitespace trimmed (``get_text(strip=True)`` on simple markup)."""
    s = F.regexp_replace(_c(c), r"(?s)<[^>]*>", "")
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def page_heading(html, h1_class: str = "mb-1 pr-3 pl-0 h3 text-white",
                 suffix: str = r"\s*-\s*Tuition and Acceptance Rate.*$",
                 default: str = "Unknown University") -> Column:
    """Heading by ``h1`` class, else ``<title>`` without the suffix,
    else ``default``."""
    h = _c(html)
    cls = h1_class.replace(" ", r"\s+")
    h1 = F.regexp_extract(h, rf'(?s)<h1[^>]*class="{cls}"[^>]*>(.*?)</h1>', 1)
    has_title = h.rlike(r"(?s)<title[^>]*>")
    title = html_text(F.regexp_extract(h, r"(?s)<title[^>]*>(.*?)</title>", 1))
    return (F.when(h.rlike(rf'(?s)<h1[^>]*class="{cls}"'), html_text(h1))
            .when(has_title, F.regexp_replace(title, suffix, ""))
            .otherwise(F.lit(default)))


LINK = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """All anchors of every page in document order: (key, link_pos, href,
    text, year (X13), filename (X15), is_data_file)."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LINK), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(LINK), 2)
    z = pages.select(key, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("raw"))).alias("link_pos", "l"))
    href = F.col("l.href")
    text = html_text(F.col("l.raw"))
    return z.select(
        key, "link_pos", href.alias("href"), text.alias("text"), year_in_text(text).alias("year"),
        url_basename(href).alias("filename"),
        F.exists(F.array(*[F.lit(e) for e in DATA_EXTENSIONS]), lambda e: F.endswith(href, e)).alias("is_data_file"))


def candidate_links(pages: DataFrame, marker: str, base: str, key: str = "page_id",
                    html: str = "html") -> DataFrame:
    """Unique hrefs containing ``marker``, made absolute, first-seen order."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LINK), 1)
    picked = F.filter(hrefs, lambda h: F.contains(h, F.lit(marker)))
    full = F.transform(picked, lambda h: F.concat(F.lit(base), h))
    return pages.select(key, F.array_distinct(full).alias("urls"))


# --------------------------------------------------------------------------- #
# Majors table (D14)                                                          #
# --------------------------------------------------------------------------- #
def _rows(pages: DataFrame, key: str, html: str, container: str) -> DataFrame:
    body = F.regexp_extract(F.col(html), container, 1)
    rows = F.regexp_extract_all(body, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)
    return pages.select(key, F.posexplode(rows).alias("row_pos", "row"))


def majors_table(pages: DataFrame, key: str = "page_id", html: str = "html", layout: int = 1) -> DataFrame:
    """``key`` + ``majors_and_degrees`` array<struct<category,
    programs: array<struct<name, offers_associate, offers_bachelors>>>>.

    Layout 1: ``<section id="degrees">`` table, category rows have a
    ``th.top-level``, ticks are ``img alt="Checkmark"``; program rows before
    any category are dropped.  Layout 2: category rows carry the cell texts
    'associate' / 'bachelors', ticks are ``check-teal``; program rows before
    any category go to a category null.
    """
    if layout == 1:
        container = r'(?s)<section[^>]*id="degrees"[^>]*>.*?<table[^>]*>.*?<tbody[^>]*>(.*?)</tbody>'
    else:
        container = r"(?s)<table[^>]*>(.*?)</table>"
    r = _rows(pages, key, html, container)
    th_attr = F.regexp_extract("row", r"(?s)<th([^>]*)>", 1)
    th_text = html_text(F.regexp_extract("row", r"(?s)<th[^>]*>(.*?)</th>", 1))
    tds = F.regexp_extract_all(F.col("row"), F.lit(r"(?s)<td[^>]*>(.*?)</td>"), 1)
    has_th = F.col("row").rlike(r"(?s)<th[^>]*>")
    two = F.size(tds) >= 2
    if layout == 1:
        tick = r'<img[^>]*alt="Checkmark"'
        is_cat = has_th & F.regexp_extract(th_attr, r'class="([^"]*)"', 1).rlike(r"(^|\s)top-level(\s|$)")
        is_prog = has_th & ~is_cat
        assoc = two & F.element_at(tds, 1).rlike(tick)
        bach = two & F.element_at(tds, 2).rlike(tick)
    else:
        is_cat = two & (F.lower(html_text(F.element_at(tds, 1))) == "associate") & \
            (F.lower(html_text(F.element_at(tds, 2))) == "bachelors")
        is_prog = two & ~is_cat
        assoc = two & F.contains(F.element_at(tds, 1), F.lit("check-teal"))
        bach = two & F.contains(F.element_at(tds, 2), F.lit("check-teal"))
    t = r.select(key, "row_pos", is_cat.alias("is_cat"), is_prog.alias("is_prog"), th_text.alias("name"),
                 F.coalesce(assoc, F.lit(False)).alias("assoc"), F.coalesce(bach, F.lit(False)).alias("bach"))
    w = Window.partitionBy(key).orderBy("row_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.where("is_cat OR is_prog").withColumn("cat_idx", F.sum(F.col("is_cat").cast("int")).over(w))
    if layout == 1:
        t = t.where("cat_idx > 0")
    prog = F.struct(F.col("row_pos"), F.col("name"), F.col("assoc").alias("offers_associate"),
                    F.col("bach").alias("offers_bachelors"))
    g = t.groupBy(key, "cat_idx").agg(
        F.max(F.when(F.col("is_cat"), F.col("name"))).alias("category"),
        F.array_sort(F.collect_list(F.when(F.col("is_prog"), prog))).alias("_progs"))
    programs = F.transform("_progs", lambda p: F.struct(p["name"].alias("name"),
                                                       p["offers_associate"].alias("offers_associate"),
                                                       p["offers_bachelors"].alias("offers_bachelors")))
    cats = g.select(key, F.struct("cat_idx", "category", programs.alias("programs")).alias("c"))
    out = cats.groupBy(key).agg(F.array_sort(F.collect_list("c")).alias("_cats"))
    return out.select(key, F.transform("_cats", lambda c: F.struct(c["category"].alias("category"),
                                                                    c["programs"].alias("programs")))
                      .alias("majors_and_degrees"))


# --------------------------------------------------------------------------- #
# Data catalogue (D15, D17, D19, P15)                                         #
# --------------------------------------------------------------------------- #
RETIRED_TABLE = ("Retired Reporting", "Retired Georgia Assessments")
HEADER_NAMES = ("DATA CATEGORY", "RETIRED REPORTING")


def catalogue_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per data-file link of catalogue tables: (key, table_pos,
    row_pos, link_pos, category, description, url, text, year, filename).
    Tables mentioning retired reporting, header rows, empty and '(Retired)'
    categories are skipped; only .csv/.xls/.xlsx/.zip links are kept."""
    tables = F.regexp_extract_all(F.col(html), F.lit(r"(?s)<table[^>]*>(.*?)</table>"), 1)
    t = pages.select(key, F.posexplode(tables).alias("table_pos", "tbl"))
    retired = F.lit(False)
    for s in RETIRED_TABLE:
        retired = retired | F.contains(html_text(F.col("tbl")), F.lit(s))
    t = t.where(~retired)
    r = t.select(key, "table_pos", F.posexplode(
        F.regexp_extract_all(F.col("tbl"), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)).alias("row_pos", "row"))
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"), 1)
    r = r.select(key, "table_pos", "row_pos", cells.alias("cells")).where(F.size("cells") >= 3)
    cat = html_text(F.element_at("cells", 1))
    r = r.select(key, "table_pos", "row_pos", cat.alias("category"),
                 html_text(F.element_at("cells", 2)).alias("description"),
                 F.element_at("cells", 3).alias("dl"))
    r = r.where((F.col("category") != "") & ~F.upper("category").isin(*HEADER_NAMES)
                & ~F.contains(F.col("category"), F.lit("(Retired)")))
    hrefs = F.regexp_extract_all(F.col("dl"), F.lit(LINK), 1)
    texts = F.regexp_extract_all(F.col("dl"), F.lit(LINK), 2)
    links = r.select(key, "table_pos", "row_pos", "category", "description",
                     F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("raw"))).alias("link_pos", "l"))
    href = F.col("l.href")
    text = html_text(F.col("l.raw"))
    ok = F.lit(False)
    for e in DATA_EXTENSIONS:
        ok = ok | F.endswith(href, F.lit(e))
    return links.where(ok).select(
        key, "table_pos", "row_pos", "link_pos", "category", "description", href.alias("url"),
        text.alias("text"), year_in_text(text).alias("year"), url_basename(href).alias("filename"))


def categories(links: DataFrame) -> DataFrame:
    """Sorted distinct categories that have data files."""
    return links.select("category").distinct().orderBy("category")


def filter_catalogue(links: DataFrame, categories: Sequence[str] | None = None,
                     years: Sequence[str] | None = None) -> DataFrame:
    """Keep chosen categories; links without a year always pass."""
    out = links
    if categories:
        out = out.where(F.col("category").isin(*categories))
    if years:
        out = out.where(F.col("year").isNull() | F.col("year").isin(*years))
    return out


def target_paths(links: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``category_folder/year-or-unknown_year/filename``; paths present
    in ``existing`` (column ``path``) are skipped (S14)."""
    path = F.concat_ws("/", safe_folder(F.col("category")), F.coalesce(F.col("year"), F.lit("unknown_year")),
                       F.col("filename"))
    out = links.withColumn("path", path)
    if existing is not None:
        out = out.join(existing.select("path"), on="path", how="left_anti")
    return out
