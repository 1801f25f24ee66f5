"""Classification, sensitive-data scans and metadata documents on hand-built
frames (the driver tables hold few edge cases: no nulls, one row group)."""

from quarry.operators import classify as C
from quarry.operators import metadata as M
from quarry.operators.metadata import Constraints, ForeignKey


def test_name_rules_can_tag_a_column_twice(spark):
    cols = spark.createDataFrame([("pages", "html"), ("orders", "o_orderkey"), ("t", "misc")],
                                 "table_name string, column_name string")
    got = {(r["column_name"], r["tag"]) for r in C.name_tags(cols).collect()}
    assert got == {("html", "FreeText"), ("html", "Web"), ("o_orderkey", "Identifier")}


def test_sensitive_scan_counts_rows_and_matches_over_whole_texts(spark):
    filler = "word " * 5000  # matches far from the start of the text still count
    docs = spark.createDataFrame([
        (1, "write to a@b.io or c.d@e-f.org"),
        (2, filler + "host 10.0.0.1 card 1234 5678 9012 3456"),
        (3, "call (555) 123-4567"),
        (4, None),
        (5, "nothing here"),
    ], "doc_id long, text string")
    got = {r["pattern"]: (r["rows_scanned"], r["rows_with_match"], r["match_count"])
           for r in C.sensitive_scan({"docs": (docs, "text")}).collect()}
    assert got["email"] == (5, 1, 2)
    assert got["ipv4"] == (5, 1, 1)
    assert got["card16"] == (5, 1, 1)
    assert got["phone"] == (5, 1, 1)


def test_content_tags_only_for_columns_with_a_hit(spark):
    t = spark.createDataFrame([("x@y.com", "plain", 1), (None, "also plain", 2)], "a string, b string, n int")
    got = {(r["column_name"], r["tag"]) for r in C.content_tags({"t": t}).collect()}
    assert got == {("a", "PII:email")}


def test_metadata_documents_composite_keys_in_ordinal_order(spark):
    child = spark.createDataFrame([], "b2 int, x string, b1 int")
    parent = spark.createDataFrame([], "k1 int, k2 int")
    cons = Constraints(primary_keys={"parent": ("k1", "k2"), "child": ("x",)},
                       foreign_keys=[ForeignKey("fk_c_p", "child", ("b1", "b2"), "parent", ("k1", "k2"))])
    tc, kcu, ccu = M.constraint_relations(spark, cons)
    cols = M.meta_columns(spark, {"child": child, "parent": parent})
    docs = {r["table_name"]: r for r in M.flatten_documents(
        M.metadata_documents(cols, M.primary_key_columns(tc, kcu), M.foreign_key_columns(tc, kcu, ccu))).collect()}
    assert docs["child"]["columns"] == "b2,x,b1"  # schema position order
    assert docs["parent"]["primary_keys"] == "k1,k2"
    assert docs["child"]["foreign_keys"] == "b1->parent.k1,b2->parent.k2"  # paired by ordinal, no cross product
    assert docs["parent"]["foreign_keys"] == ""


def test_row_tags_also_tag_the_column_in_the_same_pass(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "a@b.io"), (2, "x@y.org and 10.1.2.3"), (3, "none")], "doc_id long, text string")
    got = set(map(tuple, C.row_tags(docs, F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), "text",
                                    column_qn="col:text").distinct().collect()))
    assert got == {("doc:1", "PII:email"), ("doc:2", "PII:email"), ("doc:2", "PII:ipv4"),
                   ("col:text", "PII:email"), ("col:text", "PII:ipv4")}


def test_table_row_counts_one_aggregate_keeps_empty_tables(spark):
    counts = {r["table_name"]: r["row_count"] for r in M.table_row_counts({
        "a": spark.range(7), "b": spark.createDataFrame([], "x int"), "c": spark.range(3)}).collect()}
    assert counts == {"a": 7, "b": 0, "c": 3}
