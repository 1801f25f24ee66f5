"""Hot keys: one key holding a third of the rows must give exact results
whichever join strategy runs (broadcast or shuffle)."""

from pyspark.sql import functions as F

from quarry.operators import entities as E
from quarry.operators import quality as Q
from quarry.operators.graph import hierarchy, walk
from quarry.operators.lineage import cascade_soft_delete
from quarry.operators.metadata import ForeignKey

N = 3000


def _hot(spark):
    # key 7 holds a third of the rows; the rest are spread over 100 keys
    return spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100 + 1000)
                                 .alias("k"), F.col("id").alias("v"))


def test_duplicates_with_hot_key(spark):
    r = Q.duplicate_keys(_hot(spark), "t", ("k",), "pk").first()
    assert r["duplicate_groups"] == 101 and r["duplicate_rows"] == N


def test_orphans_with_hot_key(spark):
    parent = spark.range(1000, 1050).select(F.col("id").alias("k"))
    r = Q.orphan_references(_hot(spark), parent, ForeignKey("fk", "c", ("k",), "p", ("k",))).first()
    # key 7 and keys 1050..1099 are missing from the parent
    assert r["violating_keys"] == 51 and r["violating_rows"] == N // 3 + 50 * 20


def test_latest_per_key_with_hot_key(spark):
    got = {r["k"]: r["v"] for r in E.latest_per_key(_hot(spark).withColumn("version", F.col("v")), "k").collect()}
    assert got[7] == N - 3 and len(got) == 101


def test_walk_and_hierarchy_hot_node_shuffle_join(spark):
    edges = _hot(spark).select(F.concat(F.lit("row:"), F.col("v").cast("string")).alias("src"),
                               F.concat(F.lit("key:"), F.col("k").cast("string")).alias("dst"))
    start = spark.createDataFrame([("key:7",)], "node string")
    for b in (0, 10_000_000):  # forced shuffle join, then broadcast
        got = walk(edges, start, "IN", 1, broadcast_rows=b)
        assert got.where("depth = 1").count() == N // 3
    nodes = (edges.select(F.col("src").alias("node"), F.col("dst").alias("parent"), F.lit("row").alias("kind"))
             .unionByName(edges.select(F.col("dst").alias("node")).distinct()
                          .select("node", F.lit(None).cast("string").alias("parent"), F.lit("key").alias("kind"))))
    h = hierarchy(nodes, broadcast_rows=0)
    assert h.where("root = 'key:7' AND depth = 1").count() == N // 3


def test_cascade_hot_parent_shuffle_join(spark):
    top = spark.createDataFrame([(7, "drop"), (8, "keep")], "k long, name string")
    child = _hot(spark)
    levels = [("top", top, "k", None), ("child", child, None, "k")]
    got = {r["table_name"]: (r["deleted_rows"], r["remaining_rows"])
           for r in cascade_soft_delete(levels, F.col("name") == "drop", broadcast_rows=0).collect()}
    assert got["child"] == (N // 3, N - N // 3)


def test_materialize_measures_rows_and_bytes(spark):
    from quarry.operators.graph import _materialize, broadcastable
    df = spark.range(10).select(F.lit("abcdefghij").alias("s"), F.col("id"))
    m = _materialize(df)
    # per row: 8-byte header + 2 fields x 8 bytes + 10-byte string padded to 16
    assert (m.rows, m.bytes) == (10, 10 * 40)
    assert m.frame.count() == 10
    assert broadcastable(m, 10, 400) and not broadcastable(m, 10, 399) and not broadcastable(m, 9, 10**9)


def test_byte_bound_alone_forces_shuffle_join(spark):
    edges = _hot(spark).select(F.concat(F.lit("row:"), F.col("v").cast("string")).alias("src"),
                               F.concat(F.lit("key:"), F.col("k").cast("string")).alias("dst"))
    start = spark.createDataFrame([("key:7",)], "node string")
    got = walk(edges, start, "IN", 1, broadcast_bytes=0)
    assert got.where("depth = 1").count() == N // 3
    top = spark.createDataFrame([(7, "drop"), (8, "keep")], "k long, name string")
    levels = [("top", top, "k", None), ("child", _hot(spark), None, "k")]
    got = {r["table_name"]: r["deleted_rows"]
           for r in cascade_soft_delete(levels, F.col("name") == "drop", broadcast_bytes=0).collect()}
    assert got["child"] == N // 3


def test_materialize_measures_nested_columns(spark):
    from quarry.sources.scratch import materialize
    df = spark.range(4).select(F.create_map(F.lit("k"), F.lit("v")).alias("m"), F.array(F.lit(1.5)).alias("a"))
    m = materialize(df, "nested")
    # 8 + 2 x 8 fixed, {"k":"v"} (9 bytes -> 16) and [1.5] (5 bytes -> 8) measured as JSON text
    assert (m.rows, m.bytes) == (4, 4 * (24 + 16 + 8))
    assert m.frame.count() == 4


def test_broadcast_bounds_follow_the_session(spark):
    from quarry.sources.scratch import broadcastable, materialize
    m = materialize(spark.range(10), "bounds")
    assert broadcastable(m)
    spark.conf.set("quarry.broadcast.maxRows", "5")
    try:
        assert not broadcastable(m)
    finally:
        spark.conf.unset("quarry.broadcast.maxRows")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not broadcastable(m)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert broadcastable(m)


def test_unmeasured_materialization_is_never_broadcast(spark):
    from quarry.sources.scratch import broadcastable, materialize
    m = materialize(spark.range(3), "unmeasured", measure_bytes=False)
    assert m.rows == 3 and m.bytes == -1 and not broadcastable(m)
