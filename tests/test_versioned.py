import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.session import fresh_dir
from quarry.sources.versioned import TableExists, TableNotFound, VersionedTable

SCHEMA = "code string, label string, owner string, region string"


def _customers(spark, n):
    rows = [(f"C{i:03d}", f"Company {i}", f"Contact {i}", ["USA", "France", "Germany"][i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_counts_91_then_93_and_time_travel(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "customers")
    t.create_if_not_exists(_customers(spark, 1).schema)
    assert t.current_snapshot_id() is None  # declaring a table makes no snapshot
    assert t.read().count() == 0
    s1 = t.append(_customers(spark, 91), committed_at=dt.datetime(2024, 1, 1))
    new = spark.createDataFrame([("N-1", "north depot", "crew a", "R1"),
                                 ("N-2", "south depot", "crew b", "R2")], SCHEMA)
    s2 = t.append(new, committed_at=dt.datetime(2024, 1, 2))
    assert (s1, s2) == (1, 2)
    assert t.read().count() == 93
    assert t.read(version=1).count() == 91  # old version unchanged by the append
    assert t.count_at(1).first()["row_count"] == 91
    hist = t.history().orderBy("snapshot_id").collect()
    assert [(h["previous_total_rows"], h["total_rows"]) for h in hist] == [(0, 91), (91, 93)]
    assert [h["parent_id"] for h in hist] == [None, 1]


def test_time_travel_prunes_partitions(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "pruned")
    t.create(_customers(spark, 5))
    t.append(_customers(spark, 3))
    plan = t.read(version=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_snapshot_id" in plan


def test_create_twice_and_append_missing(spark):
    root = fresh_dir(spark, "t")
    t = VersionedTable(spark, root, "x")
    with pytest.raises(TableNotFound):
        t.append(_customers(spark, 1))
    t.create(_customers(spark, 1))
    with pytest.raises(TableExists):
        VersionedTable(spark, root, "x").create(_customers(spark, 1))


def test_create_or_append_and_idempotent_batch(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "raw")
    assert t.create_or_append(_customers(spark, 4), batch_id="b1") == 1
    assert t.create_or_append(_customers(spark, 2), batch_id="b2") == 2
    assert t.create_or_append(_customers(spark, 4), batch_id="b1") == 1  # replay is a no-op
    assert t.read().count() == 6
    # a fresh handle reads the same state from storage
    again = VersionedTable(spark, t.path.rsplit("/", 1)[0], "raw")
    assert again.current_snapshot_id() == 2 and again.read().count() == 6


def test_uncommitted_snapshot_is_invisible(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "crash")
    t.create(_customers(spark, 3))
    # data written for snapshot 2 but no log row: a crashed append
    (_customers(spark, 5).write.mode("overwrite").parquet(f"{t.data_path}/_snapshot_id=2"))
    fresh = VersionedTable(spark, t.path.rsplit("/", 1)[0], "crash")
    assert fresh.read().count() == 3
    # the retried append overwrites the leftovers
    assert fresh.append(_customers(spark, 2)) == 2
    assert fresh.read().count() == 5


def test_schema_mismatch_fails(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "strict")
    t.create(_customers(spark, 1))
    with pytest.raises(ValueError):
        t.append(_customers(spark, 1).withColumn("extra", F.lit(1)))


def test_append_batches_one_snapshot_per_value(spark):
    df = spark.createDataFrame([(i, 2000 + i % 3) for i in range(30)], "id long, yr int")
    t = VersionedTable(spark, fresh_dir(spark, "t"), "by_year")
    ids = t.append_batches(df, "yr")
    assert ids == [1, 2, 3]
    snaps = t.snapshots().orderBy("snapshot_id").collect()
    assert [s["added_rows"] for s in snaps] == [10, 10, 10]
    assert [s["operation"] for s in snaps] == ["create", "append", "append"]
    assert t.read(version=2).count() == 20
    files = t.files().collect()
    assert sum(f["record_count"] for f in files) == 30


def test_append_batches_takes_any_number_of_batches(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "many_batches")
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 5).alias("day"))
    assert len(t.append_batches(df, "k")) == 50
    assert t.read().count() == 50

def test_append_batches_keeps_rows_with_a_null_batch_value(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t"), "null_batches")
    df = spark.createDataFrame([(1, None), (2, 2020), (3, None), (4, 2021)], "id int, yr int")
    ids = t.append_batches(df, "yr")
    assert len(ids) == 3 and t.read().count() == 4
    added = {r["snapshot_id"]: r["added_rows"] for r in t.snapshots().collect()}
    assert sorted(added.values()) == [1, 1, 2]
