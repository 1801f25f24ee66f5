"""Graph walks over edge DataFrames: lineage traversal and parent-pointer trees.

Both walks are breadth-first rounds of joins. Each round's frontier is
written as a Parquet table into the shared work folder (reliable, survives
executor loss, cuts the lineage) and measured by an observation on that same
write job (rows and in-memory bytes), so the round's plan runs exactly once.
The measured size decides the next join: a frontier within both
``broadcast_rows`` and ``broadcast_bytes`` is broadcast so the big edge table
is streamed without a shuffle (and a hot node cannot skew a shuffle
partition); a larger frontier uses a shuffle join, where AQE splits skewed
partitions.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.frames import union_all
from quarry.sources.scratch import (DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, Materialized,  # noqa: F401
                                    broadcastable, materialize)
from quarry.sources.tables import spread

_materialize = materialize  # the walks' name for it


def _union(frames: list[DataFrame]) -> DataFrame:
    return union_all(frames)


def _join_frontier(frontier: DataFrame, small: bool, big: DataFrame, on) -> DataFrame:
    side = F.broadcast(frontier) if small else frontier
    return big.join(side, on)


def adjacency(edges: DataFrame, direction: str = "OUT", src: str = "src", dst: str = "dst") -> DataFrame:
    """``(frm, to)`` pairs for a walk direction: OUT follows edges, IN reverses
    them, BOTH does either."""
    out = edges.select(F.col(src).alias("frm"), F.col(dst).alias("to"))
    inn = edges.select(F.col(dst).alias("frm"), F.col(src).alias("to"))
    direction = direction.upper()
    if direction == "OUT":
        adj = out
    elif direction == "IN":
        adj = inn
    elif direction == "BOTH":
        adj = out.unionByName(inn)
    else:
        raise ValueError(f"direction must be IN, OUT or BOTH, not {direction}")
    return adj.where(F.col("frm").isNotNull() & F.col("to").isNotNull())


def walk(edges: DataFrame, start: DataFrame, direction: str = "BOTH", max_depth: int = 3,
         src: str = "src", dst: str = "dst", broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
         broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Nodes reachable from ``start`` (column ``node``) within ``max_depth``
    steps, with their minimum depth (start nodes have depth 0)."""
    starts = (start.select("node").distinct()
              .select(F.lit("w").alias("walk"), F.lit("g").alias("graph"), "node",
                      F.lit(direction.upper()).alias("direction"), F.lit(max_depth).alias("max_depth")))
    g = edges.select(F.lit("g").alias("graph"), F.col(src).alias("src"), F.col(dst).alias("dst"))
    return (walk_many(g, starts, broadcast_rows, broadcast_bytes, settings=(max_depth, {direction.upper()}))
            .select("node", "depth"))


def walk_many(edges: DataFrame, starts: DataFrame, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, settings=None) -> DataFrame:
    """Several walks in one breadth-first loop.

    ``edges``: ``graph, src, dst``; ``starts``: ``walk, graph, node, direction,
    max_depth`` (direction IN / OUT / BOTH per walk). Returns ``walk, node,
    depth`` with the minimum depth per (walk, node). A visited anti-join keeps
    each node in the first round that reaches it, so cycles terminate; the
    loop stops when every frontier is empty or at its depth limit. Each walk
    has one graph, direction and depth limit; frontier rows carry them, so a
    round needs no lookup of its walk's settings. ``settings`` = (deepest
    limit, set of directions) when the caller knows them; otherwise one small
    job reads them from ``starts``.
    """
    if settings is None:
        # one small job: the deepest limit and the directions in use (bounded by the number of walks)
        summary = starts.agg(F.max("max_depth").alias("deepest"),
                             F.collect_set(F.upper("direction")).alias("dirs")).first()
        settings = (summary["deepest"], set(summary["dirs"]))
    deepest, dirs = settings[0] or 0, set(settings[1])
    for d in dirs:
        if d not in ("IN", "OUT", "BOTH"):
            raise ValueError(f"direction must be IN, OUT or BOTH, not {d}")
    edges = edges.select("graph", "src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if deepest > 1:
        # every round reads the edges again: derive them once and keep them as a table
        edges = _materialize(spread(edges)).frame
    out = edges.select("graph", F.col("src").alias("frm"), F.col("dst").alias("to"), F.lit("OUT").alias("dir"))
    inn = edges.select("graph", F.col("dst").alias("frm"), F.col("src").alias("to"), F.lit("IN").alias("dir"))
    # only the orientations some walk follows: an upstream-only walk never reads the edges forwards
    sides = ([out] if dirs & {"OUT", "BOTH"} else []) + ([inn] if dirs & {"IN", "BOTH"} else [])
    adj = _union(sides)
    carried = ["walk", "graph", "direction", "max_depth"]
    m = _materialize(starts.select("walk", "graph", F.upper("direction").alias("direction"), "max_depth", "node")
                     .distinct().withColumn("depth", F.lit(0)))
    levels = [m.frame]  # materialized levels: their union has a short lineage
    for d in range(1, deepest + 1):
        if m.rows == 0:
            break
        active = m.frame.where(F.col("max_depth") >= d).select(*carried, F.col("node").alias("frm"))
        # the probe side is a filtered projection of the measured frontier, so the measure bounds it
        side = F.broadcast(active) if broadcastable(m, broadcast_rows, broadcast_bytes) else active
        # not de-duplicated edges: the distinct on (walk, node) absorbs repeats
        reached = (adj.join(side, ["graph", "frm"])
                   .where((F.col("direction") == "BOTH") | (F.col("direction") == F.col("dir")))
                   .select(*carried, F.col("to").alias("node")).distinct())
        visited = _union(levels).select("walk", "node")
        m = _materialize(reached.join(visited, ["walk", "node"], "left_anti").withColumn("depth", F.lit(d)))
        levels.append(m.frame)
    return _union(levels).select("walk", "node", "depth")


def hierarchy(nodes: DataFrame, max_depth: int | None = None, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Top-down walk of a parent-pointer forest.

    ``nodes`` has ``node, parent, kind``; roots have a null parent. Returns
    ``node, kind, root, depth`` for every node reachable from a root. Each
    node has one parent, so every node is reached once; nodes on a pointer
    cycle, or under a missing parent, are never reached. The walk ends when a
    level has no children; ``max_depth`` cuts it only if given.
    """
    m = _materialize(nodes.where(F.col("parent").isNull())
                     .select("node", "kind", F.col("node").alias("root"), F.lit(0).alias("depth")))
    levels = [m.frame]
    for d in count(1):
        if m.rows == 0 or (max_depth is not None and d > max_depth):
            break
        # the probe side is a projection of the measured level, so the measure bounds it
        parents = m.frame.select(F.col("node").alias("parent"), "root")
        small = broadcastable(m, broadcast_rows, broadcast_bytes)
        children = (_join_frontier(parents, small, nodes.where(F.col("parent").isNotNull()), "parent")
                    .select("node", "kind", "root", F.lit(d).alias("depth")))
        m = _materialize(children)
        levels.append(m.frame)
    return _union(levels)
