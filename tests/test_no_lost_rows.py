"""Cases in which rows once could get lost: two writers, half-written folders,
several streams into one table, null batches, repeated backfills, deep trees."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.graph import hierarchy
from quarry.operators.ingest import batch_summary, ingest_tables
from quarry.session import fresh_dir
from quarry.sources.versioned import VersionedTable, VersionNotFound
from quarry.streaming.events import append_stream, run_to_completion, stream_source


def test_two_handles_do_not_write_over_each_other(spark):
    root = fresh_dir(spark, "t")
    a, b = VersionedTable(spark, root, "x"), VersionedTable(spark, root, "x")
    a.create(spark.range(3))
    assert b.read().count() == 3
    assert (a.append(spark.range(5)), b.append(spark.range(1))) == (2, 3)
    a.refresh()
    assert a.read().count() == 9


def test_only_logged_versions_are_read(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "x")
    t.create(spark.range(3))
    spark.range(5).write.parquet(f"{t.data_path}/_snapshot_id=2")  # a half-written append
    assert t.read().count() == t.read(version=1).count() == 3
    for unknown in (2, 99):
        with pytest.raises(VersionNotFound):
            t.read(version=unknown)
    assert t.append(spark.range(4)) == 2 and t.read().count() == 7


def test_backfill_with_null_batches_runs_once(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "x")
    df = spark.range(40).withColumn("y", F.when(F.col("id") % 4 > 0, F.col("id") % 4))
    first = t.append_batches(df, "y", committed_at_for=lambda v: __import__("datetime").datetime(2000 + v, 1, 1))
    assert first == [1, 2, 3, 4] and t.read().count() == 40
    assert t.append_batches(df, "y") == first and t.read().count() == 40
    assert t.append_batches(df, "y", run_id="more") == [5, 6, 7, 8] and t.read().count() == 80


@pytest.mark.parametrize("folder", [True, False])
def test_streams_into_one_table_keep_their_rows(spark, folder):
    root = fresh_dir(spark, "t")
    table = VersionedTable(spark, root, "raw")
    for n, source in enumerate(("a", "b")):
        path = f"{root}/{source}.parquet"
        spark.range(1000 * n, 1000 * n + 1000).coalesce(1).write.parquet(path)
        if not folder:
            path = spark.read.parquet(path).inputFiles()[0]
        run_to_completion(append_stream(stream_source(spark, path, spark.range(1).schema), table, f"{root}/checkpoint-{source}"))
    table.refresh()
    assert table.read().select("id").distinct().count() == table.read().count() == 2000


def test_deep_trees_are_walked_whole(spark):
    nodes = spark.range(67).select(F.col("id").cast("string").alias("node"),
                                   F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"),
                                   F.lit("n").alias("kind"))
    assert hierarchy(nodes).agg(F.max("depth")).first()[0] == 66
    assert hierarchy(nodes, max_depth=3).count() == 4


def test_a_run_without_sources_has_an_empty_summary(spark):
    root = fresh_dir(spark, "t")
    assert batch_summary(spark, ingest_tables(spark, {}, root), root).collect() == []
