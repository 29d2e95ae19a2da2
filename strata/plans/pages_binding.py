"""Stored pages with tables, built from ``part``: eight parts a page, in key order.

Even pages have the first layout of a majors table and odd pages the second.  A
part whose key leaves 1 modulo 4 is a category row, so a page's first program
row comes before any category.  Catalogue pages hold one table each: a header
row and a row per part with two links; every ninth page's table is a retired one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table

PER_PAGE = 8


def _pages(rows, row, before: str, after: str):
    """One page of each group of parts: ``row`` of its parts in key order between the two texts."""
    lines = F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("row"))))
    return rows.withColumn("page_id", F.floor(F.col("p_partkey") / PER_PAGE)).groupBy("page_id").agg(lines.alias("lines")) \
        .select("page_id", F.concat(F.lit(before), F.array_join(F.transform("lines", lambda x: x["row"]), "\n"), F.lit(after))
                .alias("html"))


def majors_pages(spark, sf_dir, layout: int):
    p = table(spark, sf_dir, "part").where(F.floor(F.col("p_partkey") / PER_PAGE) % 2 == layout - 1)
    tick = '<img src="x.png" alt="Checkmark">' if layout == 1 else '<i class="check-teal"></i>'
    head = '<th class="wide top-level">' if layout == 1 else "<th>"
    name = F.concat(F.col("p_name"), F.lit(" &amp; "), F.col("p_partkey").cast("string"))

    def cell(on):
        return F.when(on, F.lit(f"<td>{tick}</td>")).otherwise(F.lit("<td> </td>"))

    row = F.when(F.col("p_partkey") % 4 == 1, F.concat(F.lit(f"<tr>{head}"), F.col("p_brand"),
                                                        F.lit("</th><td>Associate</td><td>Bachelors</td></tr>"))) \
        .otherwise(F.concat(F.lit("<tr><th><b>"), name, F.lit("</b></th>"), cell(F.col("p_size") % 2 == 0),
                            cell(F.col("p_size") % 3 == 0), F.lit("</tr>")))
    if layout == 1:
        return _pages(p, row, '<p>x</p><section class="a" id="degrees"><table><thead></thead><tbody>', "</tbody></table></section>")
    return _pages(p, row, "<div><table>", "</table></div>")


def catalogue_pages(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    category = F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.concat("p_type", F.lit(" (Retired)"))) \
        .otherwise(F.concat(F.col("p_type"), F.lit(" - Tests &amp; more")))
    year = F.when(k % 3 == 0, F.concat(F.lit(" 20"), F.lpad((k % 20 + 1).cast("string"), 2, "0"), F.lit("-"),
                                       F.lpad((k % 20 + 2).cast("string"), 2, "0"))) \
        .when(k % 3 == 1, F.lit(" of 2015")).otherwise(F.lit(""))
    row = F.concat(F.lit("<tr><td>"), category, F.lit("</td><td>"), F.col("p_name"), F.lit('</td><td><a href="https://example.com/f/'),
                   F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("/"), k.cast("string"), F.lit('.csv">'), F.col("p_name"), year,
                   F.lit('</a> <a href="/notes/'), k.cast("string"), F.lit('.pdf">Notes 2020</a></td></tr>'))
    pages = _pages(p, row, "<table><tr><th>Data Category</th><th>About</th><th>Files</th></tr>", "</table>")
    retired = F.regexp_replace("html", "</table>", "<tr><td>Retired Reporting</td></tr></table>")
    return pages.withColumn("html", F.when(F.col("page_id") % 9 == 0, retired).otherwise(F.col("html")))
