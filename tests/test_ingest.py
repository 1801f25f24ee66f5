"""Raw-layer ingest: a failing table is reported, the others go on; the
summary counts what each run wrote (from the commit log), plus a total row."""

from quarry.operators.ingest import AUDIT_COLUMNS, batch_summary, ingest_tables
from quarry.session import fresh_dir
from quarry.sources.versioned import VersionedTable


def test_ingest_isolates_a_failing_table_and_counts_written_rows(spark):
    wh = fresh_dir(spark, "ingest")
    a = spark.range(5).withColumnRenamed("id", "x")
    b = spark.range(3).withColumnRenamed("id", "y")
    first = ingest_tables(spark, {"a": a, "b": b}, wh)
    assert {r["table_name"]: (r["status"], r["snapshot_id"]) for r in first.collect()} == {
        "a": ("ok", 1), "b": ("ok", 1)}
    # second run: b arrives with another schema, so its append fails; a still appends
    second = ingest_tables(spark, {"a": a, "b": spark.range(2).withColumnRenamed("id", "z")}, wh)
    got = {r["table_name"]: (r["status"], r["snapshot_id"], r["error"]) for r in second.collect()}
    assert got["a"][:2] == ("ok", 2)
    assert got["b"][0] == "failed" and got["b"][1] is None and "schema mismatch" in got["b"][2]
    summary = {r["table_name"]: (r["records_extracted"], r["tables_ok"])
               for r in batch_summary(spark, second, wh).collect()}
    assert summary == {"a": (5, 1), "b": (0, 0), "__total__": (5, 1)}
    raw_a = VersionedTable(spark, wh, "raw_a")
    assert raw_a.read().count() == 10 and set(AUDIT_COLUMNS) <= set(raw_a.read().columns)
    assert VersionedTable(spark, wh, "raw_b").read().count() == 3  # the failed append left nothing behind
