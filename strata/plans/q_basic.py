"""Scans, projections, filters, aggregates, de-duplication, incremental batch,
batching, sampling and the file readers/writers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import batches as BT
from ..operators import incremental as INC
from ..operators import joins as J
from ..operators import pages as PG
from ..sources import io
from ..sources.tables import table
from .catalog import finish, r6, register


@register("scan_project_filter", sql=f"""
SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS qty,
       CAST(l_shipdate AS DATE) AS ship_date, {r6('l_extendedprice * (1 - l_discount)')} AS net_price,
       CAST(coalesce(CASE WHEN l_tax > 0 THEN l_tax * 100 END, -1) AS INTEGER) AS tax_pct
FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate IS NOT NULL AND l_linestatus IN ('O', 'F')
  AND l_shipdate < TIMESTAMP '1998-09-02' AND l_discount <= l_tax""", ops="S8, P1-P6, P8-P10, P14")
def scan_project_filter(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    f = li.where((F.col("l_returnflag") == "R") & F.col("l_shipdate").isNotNull()
                 & F.col("l_linestatus").isin("O", "F")
                 & (F.col("l_shipdate") < F.lit("1998-09-02").cast("timestamp_ntz"))
                 & (F.col("l_discount") <= F.col("l_tax")))
    out = f.select(
        F.col("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("line"), "l_quantity",
        F.to_date("l_shipdate").alias("ship_date"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net_price"),
        F.coalesce(F.when(F.col("l_tax") > 0, F.col("l_tax") * 100), F.lit(-1)).cast("int").alias("tax_pct"),
        "l_returnflag")
    # Drop ignores names that are absent; P3: rename
    out = out.drop("l_returnflag", "no_such_column").withColumnsRenamed({"l_orderkey": "order_key", "l_quantity": "qty"})
    return finish(out)


@register("value_counts", sql="""
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderpriority""", ops="A6, O1")
def value_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderpriority")


@register("grouped_sum_distinct", sql=f"""
SELECT c.c_nationkey, {r6('sum(o.o_totalprice)')} AS total_price,
       CAST(count(DISTINCT o.o_custkey) AS BIGINT) AS n_customers,
       CAST(count(DISTINCT c.c_mktsegment) AS BIGINT) AS n_segments
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey""", ops="A4, A5, A15")
def grouped_sum_distinct(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    # per (nation, customer) first: the distinct counts then aggregate small partials
    per = j.groupBy("c_nationkey", "o_custkey", "c_mktsegment").agg(F.sum("o_totalprice").alias("s"))
    out = per.groupBy("c_nationkey").agg(F.sum("s").alias("total_price"),
                                         F.count_distinct("o_custkey").alias("n_customers"),
                                         F.count_distinct("c_mktsegment").alias("n_segments"))
    return finish(out)


@register("dedupe_first", sql=f"""
SELECT o_custkey, arg_min(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS first_orderkey,
       arg_min(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS first_status,
       {r6('arg_min(o_totalprice, struct_pack(d := o_orderdate, k := o_orderkey))')} AS first_price,
       CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS n_statuses
FROM orders GROUP BY o_custkey""", ops="A16, A17, U2, W1")
def dedupe_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ordv = F.struct("o_orderdate", "o_orderkey")
    first = o.groupBy("o_custkey").agg(
        F.min_by(F.struct("o_orderkey", "o_orderstatus", "o_totalprice"), ordv).alias("f"),
        F.count_distinct("o_orderstatus").alias("n_statuses"))
    return finish(first.select("o_custkey", F.col("f.o_orderkey").alias("first_orderkey"),
                               F.col("f.o_orderstatus").alias("first_status"),
                               F.col("f.o_totalprice").alias("first_price"), "n_statuses"))


@register("status_summary", sql=f"""
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(event_type NOT IN ('error', 'signup')) AS BIGINT) AS succeeded,
       CAST(count_if(event_type = 'signup') AS BIGINT) AS skipped,
       CAST(count_if(event_type = 'error') AS BIGINT) AS failed,
       CAST(count_if(event_type NOT IN ('error', 'signup') AND value > 100) AS BIGINT) AS sampled,
       CAST(count_if(event_type NOT IN ('error', 'signup') AND value <= 100) AS BIGINT) AS copied,
       {r6('avg(value)')} AS avg_seconds, {r6("100.0 * count_if(event_type NOT IN ('error', 'signup')) / count(*)")} AS success_rate
FROM events""", ops="A18 (events read as a run log)")
def status_summary(spark, sf_dir):
    from ..operators.profiling import status_summary as summary

    ev = table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "skipped")
              .when(F.col("value") > 100, "sampled").otherwise("copied"))
    return finish(summary(ev.select(status.alias("status"), F.col("value").alias("seconds"))))


# --------------------------------------------------------------------------- #
def _customers_in(spark, sf_dir, pred):
    o = table(spark, sf_dir, "orders")
    return o.where(pred).select(F.col("o_custkey").alias("c_custkey")).distinct()


@register("incremental_new_keys", sql="""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) < 1997)""", ops="S14, J6")
def incremental_new_keys(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    done = _customers_in(spark, sf_dir, F.year("o_orderdate") < 1997)
    return INC.new_keys(c, done, "c_custkey")


@register("upsert_latest", sql=f"""
SELECT o_custkey, arg_max(o_orderkey, struct_pack(b := batch, d := o_orderdate, k := o_orderkey)) AS o_orderkey,
       arg_max(o_orderstatus, struct_pack(b := batch, d := o_orderdate, k := o_orderkey)) AS o_orderstatus,
       {r6('arg_max(o_totalprice, struct_pack(b := batch, d := o_orderdate, k := o_orderkey))')} AS o_totalprice,
       max(batch) AS batch
FROM (SELECT *, CASE WHEN year(o_orderdate) < 1998 THEN 1 ELSE 2 END AS batch FROM orders) o
GROUP BY o_custkey""", ops="S15, U1")
def upsert_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate")
    old = o.where(F.year("o_orderdate") < 1998).withColumn("batch", F.lit(1))
    new = o.where(F.year("o_orderdate") >= 1998).withColumn("batch", F.lit(2))
    u = INC.upsert_latest(old, new, "o_custkey", ["batch", "o_orderdate", "o_orderkey"])
    return finish(u.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "batch"))


@register("dataset_diff", sql="""
WITH a AS (SELECT o_custkey AS k FROM orders WHERE year(o_orderdate) = 1995),
     b AS (SELECT o_custkey AS k FROM orders WHERE year(o_orderdate) = 2000),
     d AS (SELECT count_if(b.k IS NULL) AS only_in_a, count_if(a.k IS NULL) AS only_in_b
           FROM (SELECT DISTINCT k FROM a) a FULL JOIN (SELECT DISTINCT k FROM b) b ON a.k = b.k)
SELECT (SELECT count(*) FROM a) AS a_count, (SELECT count(*) FROM b) AS b_count,
       CAST(d.only_in_a AS BIGINT) AS only_in_a, CAST(d.only_in_b AS BIGINT) AS only_in_b,
       (d.only_in_a = 0 AND d.only_in_b = 0) AS in_sync FROM d""", ops="U3")
def dataset_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = o.where(F.year("o_orderdate") == 1995)
    b = o.where(F.year("o_orderdate") == 2000)
    return INC.dataset_diff(a, b, "o_custkey")


# --------------------------------------------------------------------------- #
@register("batches_ntile", sql="""
SELECT c_custkey, c_name, c_mktsegment, CAST(ntile(7) OVER (ORDER BY c_acctbal, c_custkey) - 1 AS INTEGER) AS batch
FROM customer""",
          ops="W8")
def batches_ntile(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name", "c_mktsegment")
    return BT.batches(c, 7, ["c_acctbal", "c_custkey"]).select("c_custkey", "c_name", "c_mktsegment", "batch")


@register("batches_fixed", sql="""
SELECT c_custkey, c_name, c_mktsegment,
       CAST((row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) // 100 AS INTEGER) AS batch
FROM customer""", ops="W9")
def batches_fixed(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name", "c_mktsegment")
    return BT.batches_fixed(c, 100, ["c_acctbal", "c_custkey"]).select("c_custkey", "c_name", "c_mktsegment", "batch")


@register("deterministic_sample", sql="""
SELECT * FROM lineitem ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, '42')), l_orderkey, l_linenumber, l_partkey,
  l_suppkey, l_shipdate, l_extendedprice LIMIT 500""", ops="O4 (the limit is the sample)")
def deterministic_sample(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return BT.deterministic_sample(li, 500, ["l_orderkey", "l_linenumber"],
                                   ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"])


# --------------------------------------------------------------------------- #
@register("explode_candidates", sql=f"""
SELECT p.page_id, c.candidate_pos, c.candidate, p.title
FROM (SELECT page_id, CAST(pos - 1 AS INTEGER) AS candidate_pos, 'https://example.com' || href AS candidate
      FROM (SELECT page_id, unnest(regexp_extract_all(html, '{PG.LINK.replace("'", "''")}', 1)) AS href,
                   unnest(generate_series(1, len(regexp_extract_all(html, '{PG.LINK.replace("'", "''")}', 1)))) AS pos
            FROM pages) a) c
JOIN (SELECT page_id, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) AS title FROM pages) p
  ON p.page_id = c.page_id""", ops="J13, N7")
def explode_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(PG.LINK), 1)
    cand = p.select("page_id", F.transform(hrefs, lambda h: F.concat(F.lit("https://example.com"), h)).alias("urls"))
    ex = J.explode_candidates(cand, "page_id", "urls").where(F.col("candidate").isNotNull())
    names = p.select("page_id", F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1).alias("title"))
    return ex.join(names, on="page_id", how="left")


@register("update_nested_field", sql="""
SELECT c.c_custkey, CASE WHEN u.k IS NOT NULL THEN 'ACTIVE' ELSE c.c_mktsegment END AS segment,
       c.c_name AS name, u.k IS NOT NULL AS updated
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 2001) u
  ON c.c_custkey = u.k""", ops="J11")
def update_nested_field(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rec = c.select("c_custkey", F.struct(F.col("c_name").alias("name"),
                                         F.col("c_mktsegment").alias("segment")).alias("info"))
    upd = (_customers_in(spark, sf_dir, F.year("o_orderdate") == 2001)
           .withColumn("value", F.lit("ACTIVE")))
    out = J.update_nested(rec, upd, "c_custkey", "info.segment", "value")
    return out.select("c_custkey", F.col("info.segment").alias("segment"), F.col("info.name").alias("name"),
                      F.col("_updated").alias("updated"))


# --------------------------------------------------------------------------- #
@register("file_inventory", sql=None, ops="S9 (rows-only: the oracle has no file listing)")
def file_inventory(spark, sf_dir):
    inv = io.file_inventory(spark, sf_dir, "*.parquet")
    return inv.groupBy("extension").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("bytes"),
                                        F.sum("size_mb").alias("mb"))


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


@register("csv_json_roundtrip", sql=f"""
SELECT c_custkey, c_name, c_nationkey, {r6('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer""",
          ops="S1, S2, S4, S5, S10, S11, S12")
def csv_json_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    base = io.scratch_dir(spark, "roundtrip")
    low = c.where(F.col("c_custkey") % 2 == 0)
    high = c.where(F.col("c_custkey") % 2 == 1)
    io.write_csv(low, f"{base}/csv_a", encoding="ISO-8859-1")
    io.write_csv(high, f"{base}/csv_b", encoding="ISO-8859-1")
    back = io.read_csv(spark, [f"{base}/csv_a", f"{base}/csv_b"], CUSTOMER_SCHEMA,
                       columns=[f.name for f in CUSTOMER_SCHEMA.fields], encoding="ISO-8859-1", key="c_custkey")
    io.write_json(back, f"{base}/json")
    again = io.read_json(spark, f"{base}/json", CUSTOMER_SCHEMA, multiline=False)
    io.write_parquet(again, f"{base}/parquet")
    return finish(spark.read.parquet(f"{base}/parquet"))
