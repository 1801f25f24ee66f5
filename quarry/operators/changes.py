"""What changed between two states of a table: inserted, updated and deleted rows.

Each state is kept with a tree of digests over its key ranges. A leaf is a range of
keys (a folder of the stored table); its digest is the sum of its rows' hashes, which
partial aggregates combine and which does not depend on their order. Sixteen neighbours
have a parent whose digest sums theirs, and so on up. Two states are compared from the top: only
children of nodes that differ are looked at, and only the rows of leaves that differ
are read, joined by key and compared column by column. The work follows the change,
not the table.

Both states must be cut alike: the first is cut by quantiles of its keys (``cuts_of``), the second
takes the first's cuts, so a key is in the same leaf of both.

Defined results: keys are compared null-safe, a null key lies in the first leaf; nulls equal nulls; a row that repeats a key
is compared by how often each version of it occurs (``copies``), so a repeated row that is there once more is
an insert of one; columns that one state lacks are null there; two empty states have no changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import sql_id

FANOUT_BITS = 4
LEAF = "_leaf"
ROWS_PER_LEAF = 1_000_000
MAX_LEAVES = 4096  # folders of a stored state; larger tables have larger leaves


@dataclass(frozen=True)
class State:
    """A stored state: its rows under ``path``/rows, its digests under ``path``/digests."""
    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    cuts: tuple

    def rows(self) -> DataFrame:
        full = T.StructType(self.schema.fields + [T.StructField(LEAF, T.IntegerType(), True)])
        return self.spark.read.schema(full).option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")

    def digests(self) -> DataFrame:
        return self.spark.read.schema("level int, node long, digest decimal(38,0), row_count long").parquet(f"{self.path}/digests")


def cuts_of(df: DataFrame, key: str, rows_per_leaf: int = ROWS_PER_LEAF) -> tuple:
    """The upper keys of all leaves but the last (at most ``MAX_LEAVES``), from the key column alone."""
    rows = df.count()
    leaves = min(MAX_LEAVES, max(1, -(-rows // rows_per_leaf)))
    if leaves == 1:
        return ()
    shares = [i / leaves for i in range(1, leaves)]
    got = df.agg(F.percentile_approx(key, shares, F.lit(max(10_000, 20 * leaves))).alias("q")).first()["q"]
    return tuple(sorted(set(got or [])))


def _leaf_of(key: Column, cuts: tuple) -> Column:
    """The number of cuts below the key, by binary search (steps beyond the last cut meet a null)."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < key, at + step).otherwise(at))
    return F.when(key.isNull(), 0).otherwise(found)


def row_hash(columns: list[str]) -> Column:
    """64 bits of a row; nulls and column order count."""
    return F.xxhash64(*[F.struct(F.col(sql_id(c)), F.col(sql_id(c)).isNull()) for c in columns])


def store_state(df: DataFrame, path: str, key: str, cuts: tuple | None = None, rows_per_leaf: int = ROWS_PER_LEAF) -> State:
    """Writes the rows by leaf and the digests of all levels."""
    cuts = cuts_of(df, key, rows_per_leaf) if cuts is None else cuts
    state = State(df.sparkSession, path, df.schema, key, cuts)
    (df.withColumn(LEAF, _leaf_of(F.col(sql_id(key)), cuts).cast("int")).hint("rebalance", LEAF)
     .write.mode("overwrite").partitionBy(LEAF).parquet(f"{path}/rows"))
    columns = sorted(df.columns)
    leaves = state.rows().groupBy(F.col(LEAF).cast("long").alias("node")).agg(
        F.sum(row_hash(columns).cast("decimal(38,0)")).cast("decimal(38,0)").alias("digest"), F.count(F.lit(1)).alias("row_count"))
    # a row of each level above (as many as 16-fold parents need) for every leaf, summed once
    levels = F.explode(F.sequence(F.lit(0), F.lit(levels_of(cuts))))
    tree = leaves.select(levels.alias("level"), "node", "digest", "row_count").select(
        "level", F.expr(f"shiftright(node, level * {FANOUT_BITS})").alias("node"), "digest", "row_count")
    (tree.groupBy("level", "node").agg(F.sum("digest").cast("decimal(38,0)").alias("digest"), F.sum("row_count").alias("row_count"))
     .write.mode("overwrite").parquet(f"{path}/digests"))
    return state


def levels_of(cuts: tuple) -> int:
    """The level of the root."""
    return -(-len(cuts).bit_length() // FANOUT_BITS)


def changed_leaves(before: State, after: State) -> DataFrame:
    """``node``: the leaves whose digests differ, found from the root down."""
    if before.cuts != after.cuts:
        raise ValueError("both states must be stored with the same cuts")
    a, b = before.digests(), after.digests()
    open_nodes = None
    for level in range(levels_of(before.cuts), -1, -1):
        one, two = (d.where(F.col("level") == level).select("node", "digest", "row_count") for d in (a, b))
        if open_nodes is not None:  # children of nodes that differ
            of = open_nodes.select(F.col("node").alias("parent"))
            parent = F.shiftright("node", FANOUT_BITS).alias("parent")
            one, two = (d.select("*", parent).join(of, "parent", "left_semi").drop("parent") for d in (one, two))
        two = two.select("node", F.col("digest").alias("digest2"), F.col("row_count").alias("rows2"))
        open_nodes = (one.join(two, "node", "full")
                      .where(~F.col("digest").eqNullSafe(F.col("digest2")) | ~F.col("row_count").eqNullSafe(F.col("rows2"))).select("node"))
    return open_nodes


def changes(before: State, after: State) -> DataFrame:
    """``change`` (insert, update or delete), the key, ``columns`` (an update's changed columns, sorted) and ``copies``."""
    key = before.key
    # the leaves that differ come to the driver as folder numbers: at most MAX_LEAVES
    leaves = [r["node"] for r in changed_leaves(before, after).collect()]
    names = sorted({*before.schema.names, *after.schema.names} - {key})

    def rows(state: State, side: str) -> DataFrame:
        own = state.rows().where(F.col(LEAF).isin(leaves)) if leaves else state.rows().where("false")
        values = [(F.col(sql_id(c)) if c in state.schema.names else F.lit(None)).alias(c) for c in names]
        value = F.struct(*values)
        counted = own.select(F.col(sql_id(key)).alias("key"), value.alias("value")).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
        return counted.withColumnRenamed("n", side)

    # rows that are in both as often go; what is left is matched by key
    one, two = rows(before, "was"), rows(after, "now")
    both = (one.withColumn("now", F.lit(0).cast("long")).unionByName(two.withColumn("was", F.lit(0).cast("long")))
            .groupBy("key", "value").agg(F.sum("was").alias("was"), F.sum("now").alias("now")).where("was <> now"))
    gone = both.where("was > now").select("key", F.col("value").alias("old"), (F.col("was") - F.col("now")).alias("gone"))
    come = both.where("now > was").select("key", F.col("value").alias("new"), (F.col("now") - F.col("was")).alias("come"))
    alone = both.groupBy("key").agg(F.count(F.lit(1)).alias("versions"), F.sum("was").alias("was"), F.sum("now").alias("now"))
    # an update is a key with one row before and one after; all else is inserts and deletes
    updated = alone.where("versions = 2 AND was = 1 AND now = 1").select(F.col("key"))
    marked = updated.withColumn("single", F.lit(True))

    def on(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        renamed = right.withColumnRenamed("key", "key2")
        return left.join(renamed, left["key"].eqNullSafe(renamed["key2"]), how).drop("key2")

    pairs = on(on(gone, come, "inner"), marked, "inner")
    differ = F.filter(F.array(*[F.when(~F.col(f"old.{sql_id(c)}").eqNullSafe(F.col(f"new.{sql_id(c)}")), F.lit(c)) for c in names]),
                      lambda c: c.isNotNull()) if names else F.array()
    none = F.array().cast("array<string>")
    update = pairs.select(F.lit("update").alias("change"), "key", differ.alias("columns"), F.lit(1).cast("long").alias("copies"))
    deleted = on(gone, marked, "left").where("single IS NULL").select(F.lit("delete").alias("change"), "key", none.alias("columns"), F.col("gone").alias("copies"))
    inserted = on(come, marked, "left").where("single IS NULL").select(F.lit("insert").alias("change"), "key", none.alias("columns"), F.col("come").alias("copies"))
    return update.unionByName(deleted).unionByName(inserted).withColumnRenamed("key", key)
