"""File-per-record sources, mixed encodings, reason joins, nested access and
several features of one function, over files and columns made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..operators import records as R
from ..operators.features.registry import FeatureSet, feature, features
from ..operators.profile import join_reasons
from ..operators.snapshot import nest, nested_get, unnest
from ..session import staged
from ..sources import io
from ..sources.tables import table
from .catalog import finish, r6, register
from .q_text import ENROLMENT, WITHDRAWAL, _sql_list, _sql_map_case

# --------------------------------------------------------------------------- #
NAMES = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("name", T.StringType()),
                      T.StructField("segment", T.StringType())])


@register("csv_mixed_encodings", sql="""
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 2 THEN c_name ELSE 'José ' || c_name || ' à Malmö' END AS name,
       c_mktsegment AS segment
FROM customer""", ops="S3, S2, S11")
def csv_mixed_encodings(spark, sf_dir):
    """A third of the nations' files are UTF-8, a third latin-1 and a third plain ASCII (valid as either)."""
    c = table(spark, sf_dir, "customer")
    kind = F.col("c_nationkey") % 3
    name = F.when(kind == 2, F.col("c_name")).otherwise(F.concat(F.lit("José "), "c_name", F.lit(" à Malmö")))
    rows = c.select("c_custkey", name.alias("name"), F.col("c_mktsegment").alias("segment"), kind.alias("kind"))
    base = io.scratch_dir(spark, "encodings")
    paths = [io.write_csv(rows.where(F.col("kind") == i).drop("kind"), f"{base}/{i}", encoding=e)
             for i, e in enumerate(("UTF-8", "ISO-8859-1", "US-ASCII"))]
    return io.read_csv_any_encoding(spark, paths, NAMES)


# --------------------------------------------------------------------------- #
ENVELOPE = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("sourceURL", T.StringType()),
                                            T.StructField("error", T.StringType())])),
    T.StructField("json", T.StructType([T.StructField("university_name", T.StringType()),
                                        T.StructField("balance", T.DoubleType())])),
    T.StructField("_corrupt", T.StringType())])


@register("json_record_files", sql=f"""
SELECT CASE s_suppkey % 5 WHEN 0 THEN 'corrupt' WHEN 1 THEN 'failed' ELSE 'record' END AS status,
       CASE WHEN s_suppkey % 5 <> 0 THEN 'https://example.com/' || s_suppkey END AS url,
       CASE WHEN s_suppkey % 5 > 1 THEN s_name END AS university_name,
       CASE WHEN s_suppkey % 5 > 1 THEN {r6('s_acctbal')} END AS balance,
       CASE s_suppkey % 5 WHEN 0 THEN '{{not json ' || s_suppkey WHEN 1 THEN 'timeout ' || s_nationkey END AS error,
       CASE WHEN s_suppkey % 5 > 1 THEN CAST(1 AS BIGINT) END AS records_of_stem
FROM supplier""", ops="S6, D1, D2, S12")
def json_record_files(spark, sf_dir):
    """One JSON file per supplier: records, envelopes of failed pages, and files that are no JSON."""
    s = table(spark, sf_dir, "supplier")
    which, key = F.col("s_suppkey") % 5, F.col("s_suppkey").cast("string")
    meta = F.struct(F.concat(F.lit("https://example.com/"), key).alias("sourceURL"),
                    F.when(which == 1, F.concat(F.lit("timeout "), F.col("s_nationkey").cast("string"))).alias("error"))
    record = F.when(which > 1, F.struct(F.col("s_name").alias("university_name"), F.col("s_acctbal").alias("balance")))
    body = F.when(which == 0, F.concat(F.lit("{not json "), key)) \
        .otherwise(F.to_json(F.struct(meta.alias("metadata"), record.alias("json"))))
    base = io.scratch_dir(spark, "json-files")
    io.write_text_files(s.select(body.alias("value")), f"{base}/in")
    read = io.with_file_stem(io.read_json(spark, f"{base}/in", ENVELOPE, multiline=True, corrupt_col="_corrupt"))
    # the files are read and parsed once, whatever is asked of them
    files = spark.read.schema(read.schema).parquet(io.write_parquet(read, f"{base}/files"))
    good = files.where(F.col("_corrupt").isNull())
    per_stem = good.groupBy("file_stem").agg(F.count(F.lit(1)).alias("records_of_stem"))
    keyed = good.join(per_stem, "file_stem", "left") \
        .withColumn("json", F.col("json").withField("records_of_stem", F.col("records_of_stem")))
    text, count = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    records = R.unwrap(keyed).select(F.lit("record").alias("status"), "url", "university_name", "balance",
                                     text.alias("error"), "records_of_stem")
    failed = R.failed_pages(good).select(F.lit("failed").alias("status"), "url", text.alias("university_name"),
                                         F.lit(None).cast("double").alias("balance"), "error", count.alias("records_of_stem"))
    corrupt = files.where(F.col("_corrupt").isNotNull()).select(
        F.lit("corrupt").alias("status"), text.alias("url"), text.alias("university_name"),
        F.lit(None).cast("double").alias("balance"), F.rtrim(F.regexp_replace("_corrupt", r"\s+$", "")).alias("error"),
        count.alias("records_of_stem"))
    return finish(records.unionAll(failed).unionAll(corrupt))


@register("text_file_documents", sql="""
SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'NOT_FOUND' ELSE 'd' || s_suppkey END AS document_id,
       CAST(count(*) AS BIGINT) AS n_files, CAST(sum(3 + s_nationkey) AS BIGINT) AS n_lines,
       min(s_name) AS first_name
FROM supplier GROUP BY 1""", ops="S7, D18")
def text_file_documents(spark, sf_dir):
    """One text file of several lines per supplier, read whole and audited for its document id."""
    s = table(spark, sf_dir, "supplier")
    mark = F.when(F.col("s_suppkey") % 4 == 0, F.lit("no id")).otherwise(
        F.concat(F.lit("**Document ID:** `d"), F.col("s_suppkey").cast("string"), F.lit("`")))
    body = F.concat(F.lit("# "), "s_name", F.lit("\n\n"), mark, F.repeat(F.lit("\nline"), F.col("s_nationkey")))
    base = io.scratch_dir(spark, "text-files")
    io.write_text_files(s.select(body.alias("value")), f"{base}/in")
    # the files are read once, whatever is asked of them
    texts = staged(io.read_text_files(spark, f"{base}/in"))
    found = R.audit_document_ids(texts)
    lines = texts.select("source", F.size(F.split(F.rtrim(F.regexp_replace("text", r"\n$", "")), "\n")).alias("lines"),
                         F.regexp_extract("text", "^# ([^\n]*)", 1).alias("name"))
    return found.join(lines, "source").groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("lines").alias("n_lines"), F.min("name").alias("first_name"))


# --------------------------------------------------------------------------- #
def _reason_table(spark, sf_dir, kind: str, key: str, text: str, flag: str):
    """Reasons by id, from ``nation``: every seventh one is inactive, and each has a second, inactive row."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias(key), "n_nationkey")
    reasons = ENROLMENT if kind == "enrollment" else WITHDRAWAL
    desc = F.element_at(F.array(*[F.lit(x) for x in reasons]), (F.col(key) % len(reasons) + 1).cast("int"))
    now = n.select(key, desc.alias(text), F.when(F.col(key) % 7 == 6, "N").otherwise("Y").alias(flag))
    return now.unionAll(now.select(key, F.lit("superseded").alias(text), F.lit("N").alias(flag)))


def _sql_reason(reasons, key: str) -> str:
    return f"CASE WHEN {key} <= 24 AND {key} % 7 <> 6 THEN {_sql_list(reasons)}[{key} % {len(reasons)} + 1] END"


@register("enrolment_reasons", sql=f"""
SELECT sid, eid AS "EnrollmentReasonId", wid AS "WithdrawalReasonId", e AS "EnrollmentReasonDesc",
       w AS "WithDrawalReasonDesc", {_sql_map_case('e', K.ENROLLMENT_GROUPS)} AS "EnrollmentGroup",
       {_sql_map_case('w', K.WITHDRAWAL_GROUPS)} AS "WithdrawalGroup"
FROM (SELECT sid, eid, wid, {_sql_reason(ENROLMENT, 'eid')} AS e, {_sql_reason(WITHDRAWAL, 'wid')} AS w
      FROM (SELECT o_orderkey AS sid, o_custkey % 30 AS eid, CASE WHEN o_orderstatus <> 'O' THEN o_orderkey % 27 END AS wid
            FROM orders) a) b""", ops="M12, J1, X2, P2")
def enrolment_reasons(spark, sf_dir):
    """Reason ids of every order; some are unknown, some inactive, and open orders have no withdrawal."""
    o = table(spark, sf_dir, "orders")
    enrol = o.select(F.col("o_orderkey").alias("sid"), (F.col("o_custkey") % 30).alias("EnrollmentReasonId"),
                     F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey") % 27).alias("WithdrawalReasonId"),
                     F.col("o_orderpriority").alias("GradeLevel"))
    return join_reasons(
        enrol, _reason_table(spark, sf_dir, "enrollment", "EnrollmentReasonId", "EnrollmentReasonDesc",
                             "ActiveDimEnrollmentReasonRecordFlag"),
        _reason_table(spark, sf_dir, "withdrawal", "WithdrawalReasonId", "WithDrawalReasonDesc",
                      "ActiveDimWithdrawalReasonRecordFlag"))


# --------------------------------------------------------------------------- #
@register("nested_defaults", sql=f"""
SELECT c_custkey, c_mktsegment AS segment, coalesce(o.status, 'none') AS status, coalesce(o.n, 0) AS n_orders,
       {r6('coalesce(o.total, -1)')} AS total, 'latest,segment' AS fields, 'n,status,total' AS latest_fields,
       CASE WHEN o.k IS NOT NULL THEN 3 ELSE 0 END AS n_keys
FROM customer c LEFT JOIN (
  SELECT o_custkey AS k, arg_max(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS status,
         count(*) AS n, max(o_totalprice) AS total FROM orders GROUP BY o_custkey) o ON o.k = c.c_custkey""",
          ops="N1, N2, N3")
def nested_defaults(spark, sf_dir):
    """A nested record of a nested record, read with defaults where a customer has no orders."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"),
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("total"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    j = c.join(nest(o, "latest", ["n", "status", "total"]), c.c_custkey == o.o_custkey, "left").drop("o_custkey")
    j = nest(j, "info", ["latest", "segment"])
    info = j.schema["info"].dataType
    as_dict = F.from_json(F.to_json("info.latest"), "map<string,string>")
    out = j.select("c_custkey", "info", nested_get("info", "latest.status", "none").alias("status"),
                   nested_get("info", "latest.n", 0).alias("n_orders"),
                   nested_get("info", "latest.total", -1.0).alias("total"),
                   F.lit(",".join(info.fieldNames())).alias("fields"),
                   F.lit(",".join(info["latest"].dataType.fieldNames())).alias("latest_fields"),
                   F.coalesce(F.size(F.map_keys(as_dict)), F.lit(0)).alias("n_keys"))
    return finish(unnest(out, "info").drop("latest"))


# --------------------------------------------------------------------------- #
@features([("first_order", "timestamp"), ("last_order", "timestamp"), ("n_orders", int)])
def order_span(c):
    return [F.min(c.o_orderdate), F.max(c.o_orderdate), F.count(c.o_orderkey)]


@features([("cheapest", float), ("dearest", "float64")])
def order_prices(c):
    return F.min(c.o_totalprice), F.max(c.o_totalprice)


@feature("has_open", bool)
def has_open(c):
    return F.bool_or(c.o_orderstatus == "O")


@register("features_several_values", sql=f"""
SELECT o_custkey, CAST(epoch(min(o_orderdate)) AS BIGINT) AS first_order, CAST(epoch(max(o_orderdate)) AS BIGINT) AS last_order,
       CAST(count(*) AS BIGINT) AS n_orders, bool_or(o_orderstatus = 'O') AS has_open,
       {r6('min(o_totalprice)')} AS cheapest, {r6('max(o_totalprice)')} AS dearest
FROM orders GROUP BY o_custkey""", ops="F1, F2, F3, F5")
def features_several_values(spark, sf_dir):
    """Functions that give three values, two and one, in one aggregate."""
    out = FeatureSet([order_span, order_prices, has_open]).transform(table(spark, sf_dir, "orders"), ["o_custkey"])
    return finish(out.withColumns({k: F.unix_timestamp(k) for k in ("first_order", "last_order")}))
