"""Roots and depths of a parent-pointer forest in logarithmic rounds.

A level-by-level walk takes as many rounds as the forest is deep. Here every node
keeps a pointer to an ancestor and the distance to it; a round replaces the ancestor
by the ancestor's ancestor, so distances double and a chain of 1,000 nodes takes
10 rounds. Nodes whose pointer is at the top are done and leave the rounds.

Pointers that run in a circle never get to a top. When a round finishes no node, the rest are
those on cycles and below them (a node twice as deep as what is done has an ancestor
of every depth between, so some node would have finished). Their pointers go on doubling
until what they point at no longer shrinks: then it is the cycles' members and
nothing else. The smallest name on a cycle names it.

Each round is one join of the open rows with the pointers of the nodes that they point
at, written to the shared folder. A hot ancestor (a root of a third of all nodes) is
a hot key of the open side only, which AQE splits; its pointer is one row.

Defined results: a node whose parent is not there is the top of its own tree, and the
tree's status is ``missing_parent``; a null node is left out; of repeated nodes the smallest parent counts
(a null one only if there is no other); an empty frame gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.frames import union_all
from quarry.session import fresh_dir

TREE, MISSING, CYCLE, BELOW = "tree", "missing_parent", "cycle", "below_cycle"


def _kept(df: DataFrame, **sums) -> tuple[DataFrame, dict]:
    """The frame written and read back, with its rows and the named aggregates from the same job."""
    path, seen = fresh_dir(df.sparkSession, "ancestry"), Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in sums.items()])
     .write.mode("overwrite").parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)


def _jump(rows: DataFrame, pointers: DataFrame) -> DataFrame:
    """Each row's pointer replaced by its ancestor's."""
    at = pointers.select(F.col("node").alias("anc"), F.col("anc").alias("anc2"), F.col("dist").alias("dist2"),
                         F.col("top").alias("top2"), F.col("low").alias("low2"))
    return rows.join(at, "anc").select("node", F.col("anc2").alias("anc"), (F.col("dist") + F.col("dist2")).alias("dist"),
                                       F.col("top2").alias("top"), F.least("low", "low2").alias("low"))


def ancestry(nodes: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """``node, root, depth, status`` for each ``node`` with a ``parent`` (both of one type).
    On or below a cycle, root is the cycle's smallest member and depth is null. ``rounds`` gets the open
    rows of each round."""
    rounds = [] if rounds is None else rounds
    own = nodes.where("node IS NOT NULL").groupBy("node").agg(F.min("parent").alias("parent"))
    there = own.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    start = own.join(there, "parent", "left")
    alone = F.col("there").isNull()
    first, seen = _kept(start.select(
        "node", F.when(alone, F.col("node")).otherwise(F.col("parent")).alias("anc"), F.when(alone, 0).otherwise(1).cast("long").alias("dist"),
        alone.alias("top"), F.col("node").alias("low"), (alone & F.col("parent").isNotNull()).alias("missing")),
        open=F.count_if(~F.col("top")))
    missing = first.where("missing").select(F.col("node").alias("root"), F.lit(MISSING).alias("status"))
    pointers = first.drop("missing")
    done, open_rows, still = [pointers.where("top")], pointers.where("NOT top"), seen["open"]
    rounds.append(still)
    while still:
        now, seen = _kept(_jump(open_rows, union_all([*done, open_rows])), open=F.count_if(~F.col("top")))
        done.append(now.where("top"))
        open_rows = now.where("NOT top")
        rounds.append(seen["open"])
        if seen["open"] == still:  # no node finished
            break
        still = seen["open"]
    finished = union_all(done).select("node", F.col("anc").alias("root"), F.col("dist").alias("depth"))
    trees = finished.join(missing, "root", "left").select("node", "root", "depth", F.coalesce("status", F.lit(TREE)).alias("status"))
    if not still:
        return trees
    return trees.unionByName(_circles(open_rows))


def _circles(rows: DataFrame) -> DataFrame:
    """The nodes on and below cycles."""
    last = None
    while True:
        rows, seen = _kept(_jump(rows, rows), lows=F.sum(F.xxhash64("node", "low").cast("decimal(38,0)")))
        members = rows.select(F.col("anc").alias("node")).distinct().withColumn("on_cycle", F.lit(True))
        members, found = _kept(members)
        if last == (seen["lows"], found["rows"]):
            break
        last = (seen["lows"], found["rows"])
    names = rows.join(members, "node").select(F.col("node").alias("anc"), F.col("low").alias("root"))
    on_cycle = members.select("node", "on_cycle")
    return (rows.select("node", "anc").join(names, "anc").join(on_cycle, "node", "left")
            .select("node", "root", F.lit(None).cast("long").alias("depth"),
                    F.when(F.col("on_cycle"), F.lit(CYCLE)).otherwise(F.lit(BELOW)).alias("status")))
