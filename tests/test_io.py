"""Readers, writers and envelope handling on small fixture files."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import pages, records
from strata.operators.features.registry import FeatureSet, feature
from strata.operators.profile import join_reasons
from strata.sources import io


def _tmp():
    return tempfile.mkdtemp(prefix="strata-io-")


def test_csv_encoding_fallback_and_footer(spark):
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as f:
        f.write("id,name\n1,Zoë\n2,Ann\n")
    with open(os.path.join(d, "b %41+é.csv"), "w", encoding="latin-1") as f:
        f.write("id,name\n3,José\n,footer\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    df = io.read_csv_any_encoding(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b %41+é.csv")], schema)
    rows = sorted((r["id"], r["name"]) for r in df.where(F.col("id").isNotNull()).collect())
    assert rows == [(1, "Zoë"), (2, "Ann"), (3, "José")]
    footer_dropped = io.read_csv(spark, os.path.join(d, "b %41+é.csv"), schema, encoding="ISO-8859-1", key="id")
    assert footer_dropped.count() == 1


def test_json_files_keyed_by_stem_and_envelope(spark):
    d = _tmp()
    docs = {"alpha": {"metadata": {"sourceURL": "https://x/a"}, "json": {"university_name": "A"}},
            "beta": {"metadata": {"sourceURL": "https://x/b", "error": "timeout"}}}
    for stem, body in docs.items():
        with open(os.path.join(d, f"{stem}.json"), "w") as f:
            json.dump(body, f)
    with open(os.path.join(d, "broken.json"), "w") as f:
        f.write("{not json")
    schema = T.StructType([
        T.StructField("metadata", T.StructType([T.StructField("sourceURL", T.StringType()),
                                                T.StructField("error", T.StringType())])),
        T.StructField("json", T.StructType([T.StructField("university_name", T.StringType())])),
        T.StructField("_corrupt", T.StringType())])
    df = io.with_file_stem(io.read_json(spark, d, schema, multiline=True, corrupt_col="_corrupt"))
    good = df.where(F.col("_corrupt").isNull())
    assert sorted(r["file_stem"] for r in good.collect()) == ["alpha", "beta"]
    assert [r["university_name"] for r in records.unwrap(good).collect()] == ["A"]
    assert [(r["url"], r["error"]) for r in records.failed_pages(good).collect()] == [("https://x/b", "timeout")]


def test_text_files_and_document_ids(spark):
    d = _tmp()
    for name, body in (("one.md", "# A\n\n**Document ID:** `abc123`\n"), ("two.md", "# B\nno id")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    texts = io.read_text_files(spark, d)
    audit = {os.path.basename(r["source"]): r["document_id"] for r in records.audit_document_ids(texts).collect()}
    assert audit == {"one.md": "abc123", "two.md": "NOT_FOUND"}
    mapping = spark.createDataFrame([("abc123", "A", "a.md")], "document_id string, university_name string, filename string")
    loaded = {os.path.basename(r["source"]): r["matched"] for r in records.load_documents(texts, mapping).collect()}
    assert loaded == {"one.md": True, "two.md": False}


def test_file_inventory_prunes_content(spark):
    inv = io.file_inventory(spark, "/root/testdata/sf0.001", "*.parquet")
    assert inv.count() == 14
    assert "content" not in inv.columns


def test_join_reasons(spark):
    enrol = spark.createDataFrame([(1, 10, 20, "9"), (2, 11, 99, "10")],
                                  "sid int, EnrollmentReasonId int, WithdrawalReasonId int, GradeLevel string")
    er = spark.createDataFrame([(10, "Continuing in same school", "Y"), (11, "Something new", "Y")],
                               "EnrollmentReasonId int, EnrollmentReasonDesc string, ActiveDimEnrollmentReasonRecordFlag string")
    wr = spark.createDataFrame([(20, "Expelled", "Y"), (20, "Expelled", "N")],
                               "WithdrawalReasonId int, WithDrawalReasonDesc string, ActiveDimWithdrawalReasonRecordFlag string")
    out = {r["sid"]: r for r in join_reasons(enrol, er, wr).collect()}
    assert out[1]["EnrollmentGroup"] == "Continuing" and out[1]["WithdrawalGroup"] == "Legal/Disciplinary"
    assert out[2]["EnrollmentGroup"] == "Unclassified" and out[2]["WithdrawalGroup"] == "Unclassified"
    assert "GradeLevel" not in join_reasons(enrol, er, wr).columns


def test_categories_sorted_distinct(spark):
    links = spark.createDataFrame([("b",), ("a",), ("b",)], "category string")
    assert [r[0] for r in pages.categories(links).collect()] == ["a", "b"]


@feature("double_x", float, stage="post")
def _double_x(c):
    return c.x * 2


def test_to_matrix_and_row_features(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, x double")
    fs = FeatureSet([_double_x])
    assert fs.transform(df).collect()[0]["double_x"] == 4.0
    assert fs.to_matrix(df, ["id"]).collect()[0]["group_0"].asDict() == {"double_x": 4.0}
    assert fs.schema() == [[("double_x", "double")]]


def test_streaming_upsert_log(spark):
    from strata.streaming.incremental import log_micro_batches, read_latest

    src = _tmp()
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int").write.parquet(os.path.join(src, "p1"))
    schema = "k int, v string, t int"
    stream = spark.readStream.schema(schema).parquet(os.path.join(src, "p1"))
    base = _tmp()
    q = log_micro_batches(stream, os.path.join(base, "log"), os.path.join(base, "ckpt"))
    q.awaitTermination()
    latest = {r["k"]: r["v"] for r in read_latest(spark, os.path.join(base, "log"), ["k"], ["t"]).collect()}
    assert latest == {1: "a", 2: "b"}


def test_document_set_shows_finished_writes_alone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        io.read_document_set(spark, path)
    one = spark.createDataFrame([("a", "A", "text a", 0)], "document_id string, university_name string, markdown string, json_index int")
    two = spark.createDataFrame([("b", "B", "text b", 1), ("c", None, None, 2)], one.schema)
    io.write_document_set(one, path)

    def seen():
        docs, mapping = io.read_document_set(spark, path)
        return sorted(map(tuple, docs.collect())), sorted(map(tuple, mapping.collect()))

    first = ([("a", "text a")], [("a", "A", 0)])
    assert seen() == first
    write = io.write_documents
    monkeypatch.setattr(io, "write_documents", lambda *a, **k: (write(*a, **k), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        io.write_document_set(two, path)
    assert seen() == first  # documents were written, the pair was not finished
    monkeypatch.setattr(io, "write_documents", write)
    io.write_document_set(two, path)
    io.write_document_set(two, path)  # a repeated job
    assert seen() == ([("b", "text b"), ("c", None)], [("b", "B", 1), ("c", None, 2)])


def test_unreadable_files_have_rows_of_their_own(spark, tmp_path):
    from strata.operators import records

    doc_id = "0123456789abcdef0123456789abcdef"
    (tmp_path / "good.md").write_text(f"# X\n\n**Document ID:** `{doc_id}`\n")
    (tmp_path / "plain.md").write_text("no id é")
    (tmp_path / "empty.md").write_text("")
    (tmp_path / "bad.md").write_bytes(b"\xc3\x28" + f"**Document ID:** `{doc_id}`".encode())
    files = io.read_text_files_checked(spark, str(tmp_path))
    got = records.audit_document_ids(files, error="read_error").collect()
    assert {r["source"].rsplit("/", 1)[1]: r["document_id"] for r in got} == {
        "good.md": doc_id, "plain.md": "NOT_FOUND", "bad.md": "ERROR"}
