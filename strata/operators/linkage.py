"""Record linkage: similarity ratio (X9), best candidate (W11, L1), tiered
acceptance and de-duplication (P11, L2, U2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import contains_either, norm_text


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lcs_length(a, b) -> Column:
    """Length of the longest common subsequence of two strings.

    Row-by-row dynamic programme with nested ``aggregate`` over the characters:
    O(len(a)·len(b)) per pair, entirely in Catalyst (no Python UDF).  Meant
    for short strings such as names.
    """
    a, b = _c(a), _c(b)
    lb = F.length(b)
    cols = F.when(lb > 0, F.sequence(F.lit(1), lb)).otherwise(F.array().cast("array<int>"))
    first_row = F.array_repeat(F.lit(0), lb + 1)

    def row(prev, ca):
        def step(acc, j):
            hit = ca == F.substring(b, j, F.lit(1))
            return F.concat(acc, F.array(F.when(hit, prev[j - 1] + 1)
                                         .otherwise(F.greatest(prev[j], acc[j - 1]))))
        return F.aggregate(cols, F.array(F.lit(0)), step)

    last = F.aggregate(F.split(a, ""), first_row, row)
    return F.when((F.length(a) == 0) | (lb == 0), F.lit(0)).otherwise(F.element_at(last, -1))


def similarity_ratio(a, b) -> Column:
    """``round(100 · 2·LCS / (len(a)+len(b)))`` half-even, 0 when either
    string is empty (insert/delete similarity; not the Levenshtein ratio)."""
    a, b = _c(a), _c(b)
    total = (F.length(a) + F.length(b)).cast("double")
    r = F.lit(100.0) * ((F.lit(2.0) * lcs_length(a, b).cast("double")) / total)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(F.bround(r, 0).cast("int"))


def link_best_match(cands: DataFrame, entity: str = "University", pos: str = "candidate_pos",
                    name: str = "University", town: str = "Town", scraped_name: str = "Scraped_Name",
                    scraped_location: str = "Scraped_Location", success: str = "Scrape_Success",
                    fast: bool = True) -> DataFrame:
    """Per entity the first overall match, else the first name match,
    else the scraped candidate with the highest similarity (first on ties);
    entities whose scrapes all failed keep one status row.

    Candidates of one entity are few (its search results), so the window
    per entity is bounded; the similarity is computed (by an Arrow-batched
    function, unless ``fast`` is false) only for entities without an exact match.
    """
    ok = F.coalesce(F.col(success), F.lit(False))
    name_match = F.when(F.col(scraped_name).isNull(), F.lit(False)).otherwise(
        contains_either(F.col(name), F.col(scraped_name)))
    loc_match = F.when(F.col(scraped_location).isNull(), F.lit(False)).otherwise(
        contains_either(F.col(town), F.col(scraped_location)))
    c = cands.withColumns({"Name_Match": ok & name_match, "Location_Match": ok & loc_match})
    c = c.withColumn("Overall_Match", F.col("Name_Match") & F.col("Location_Match"))
    w_ent = Window.partitionBy(entity)
    has_exact = F.max(F.when(ok, F.col("Name_Match")).otherwise(F.lit(False))).over(w_ent)
    c = c.withColumn("_exact", has_exact)
    ratio = similarity_ratio_arrow if fast else similarity_ratio
    # only rows that are ranked by similarity are compared: a Python function is
    # evaluated for every row it is given, whatever condition stands around it
    needs = ok & ~F.col("_exact")
    compared = needs & F.col(scraped_name).isNotNull()
    c = c.where(compared).withColumn(
        "Name_Similarity", ratio(norm_text(F.col(name)), norm_text(F.col(scraped_name)))).unionByName(
        c.where(~compared).withColumn("Name_Similarity", F.when(needs, F.lit(0))))
    tier = (F.when(~ok, F.lit(9)).when(F.col("Overall_Match"), F.lit(1)).when(F.col("Name_Match"), F.lit(2))
            .otherwise(F.lit(3)))
    w = Window.partitionBy(entity).orderBy(tier, F.col("Name_Similarity").desc_nulls_last(), F.col(pos))
    ranked = c.withColumns({"_tier": tier, "_rn": F.row_number().over(w)})
    best = ranked.where("_rn = 1")
    status = (F.when(F.col("_tier") == 1, "overall_match").when(F.col("_tier") == 2, "name_match")
              .when(F.col("_tier") == 3, "fuzzy_match").otherwise("all_failed"))
    error = F.when(F.col("_tier") == 9, F.lit("All URLs failed to scrape")).otherwise(F.lit(""))
    return best.withColumns({"status": status, "Error": error}).drop("_exact", "_tier", "_rn")


def link_accept(results: DataFrame, order: str = "row_id") -> DataFrame:
    """Keep overall ∨ name ∨ (location ∧ similarity > 60) ∨
    (¬location ∧ similarity > 90); tier order wins when the same
    (Scraped_Name, Scraped_Location, URL) appears more than once.  A null
    similarity compares false, as in pandas."""
    o, n, loc = F.col("Overall_Match"), F.col("Name_Match"), F.col("Location_Match")
    sim = F.col("Name_Similarity")
    tier = (F.when(o, F.lit(1)).when(n & ~o, F.lit(2))
            .when(~n & ~o & loc & (sim > 60), F.lit(3))
            .when(~n & ~o & ~loc & (sim > 90), F.lit(4)))
    t = results.withColumn("tier", tier).where(F.col("tier").isNotNull())
    keys = ["Scraped_Name", "Scraped_Location", "URL"]
    rest = [c for c in t.columns if c not in keys]
    g = t.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]),
                                      F.struct(F.col("tier"), F.col(order))).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def _lcs_bits(a: str, b: str) -> int:
    """LCS length by the bit-parallel recurrence (Allison-Dix / Hyyrö):
    one machine-word operation per character of ``b`` (Python ints scale)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def _ratio_series(a, b):
    import pandas as pd

    out = []
    for x, y in zip(a, b):
        if x is None or y is None or not x or not y:
            out.append(0)
            continue
        r = 100.0 * ((2.0 * _lcs_bits(x, y)) / float(len(x) + len(y)))
        out.append(int(round(r)))  # half-even, as bround
    return pd.Series(out, dtype="int32")


def similarity_ratio_arrow(a, b) -> Column:
    """X9 fast path: the same ratio as ``similarity_ratio`` through an
    Arrow-batched pandas UDF with a bit-parallel LCS (for long strings, where
    the interpreted higher-order-function loop is slow)."""
    from pyspark.sql.functions import pandas_udf

    udf = pandas_udf(_ratio_series, returnType="int")
    return udf(_c(a), _c(b))
