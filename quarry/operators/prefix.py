"""Positions and running totals over data of any size, without one task for all rows.

A window without partitions, or one over a group that holds a third of the rows,
sorts all of that in one task. Here the rows are range-partitioned by (group, order)
instead, so a large group spans many partitions. What comes before a partition in its
group is a prefix sum over one row a (partition, group): at most partitions + groups
rows, whatever the number of rows. Joined back, it is added to what is counted
inside the partition.

The sorted partitions are written once (lineage cut), so that a row's partition
and place there are fixed before they are counted; range partitioning samples its
input, so hand in a frame that is cheap to read twice (a scan, not a parse).

Defined results: null group or order values sort first and group together; rows that tie in
``order`` get different positions in an arbitrary but fixed order (add columns to settle
it); an empty frame gives no rows; a null amount adds nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.sources.scratch import materialize

_PART_BITS = 33  # monotonically_increasing_id: partition in the upper bits, row in the lower 33


def _free(df: DataFrame, *names: str) -> list[str]:
    """Names not taken by ``df``'s columns (Spark compares them without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _placed(df: DataFrame, group: list[str], order: list[str], uid: str, part: str, purpose: str) -> DataFrame:
    """The rows, sorted by (group, order) over range partitions and written, with the
    row's number there (``uid``, rising in that order) and its partition."""
    keys = [_quoted(c) for c in [*group, *order]]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(uid, F.monotonically_increasing_id())
    written = materialize(laid, purpose, measure_bytes=False).frame
    return written.withColumn(part, F.shiftright(_quoted(uid), _PART_BITS).cast("int"))


def _with_offsets(placed: DataFrame, group: list[str], part: str, totals: dict[str, Column], firsts: dict[str, Column],
                  whole: str | None = None) -> DataFrame:
    """``placed`` joined with, for each named total, its sum over the earlier partitions
    of the row's group, and with each named aggregate of the row's own (partition, group);
    ``whole`` names the first total's sum over the whole group."""
    keys = [part, *group]
    per_part = placed.groupBy(*[_quoted(k) for k in keys]).agg(*[c.alias(n) for n, c in (totals | firsts).items()])
    of_group = Window.partitionBy(*[_quoted(g) for g in group] or [F.lit(0)])
    before = of_group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    renamed = {k: f"__k{i}" for i, k in enumerate(keys)}
    offsets = per_part.select(*[_quoted(k).alias(renamed[k]) for k in keys],
                              *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals], *firsts,
                              *[F.sum(next(iter(totals))).over(of_group).alias(whole)] if whole else [])
    matched = reduce(and_, [_quoted(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    return placed.join(offsets, matched, "left").drop(*renamed.values())


def with_positions(df: DataFrame, group: list[str], order: list[str], out: str = "position", size: str = "group_size",
                   purpose: str = "positions") -> DataFrame:
    """``df`` with each row's position (long, from 0) in its group by ``order`` and
    the group's number of rows. One shuffle of the rows; nothing is sorted or counted in one task."""
    uid, part, first, offset = _free(df, "__uid", "__part", "__first", "__offset")
    placed = _placed(df, group, order, uid, part, purpose)
    known = _with_offsets(placed, group, part, {offset: F.count(F.lit(1))}, {first: F.min(_quoted(uid))}, size)
    return (known.withColumn(out, F.col(uid) - F.col(first) + F.col(offset))
            .select(*[_quoted(c) for c in df.columns], out, size))


def running_totals(df: DataFrame, group: list[str], order: list[str], amounts: dict[str, Column],
                   purpose: str = "running_totals") -> DataFrame:
    """``df`` with, for each named amount, its running total in the row's group up to
    and with the row, by ``order``. Inside a partition the total is a window over
    (partition, group), which is at most one partition's rows."""
    uid, part = _free(df, "__uid", "__part")
    offsets = {f"__before_{n}": F.sum(c) for n, c in amounts.items()}
    placed = _placed(df, group, order, uid, part, purpose)
    known = _with_offsets(placed, group, part, offsets, {})
    inside = (Window.partitionBy(part, *[_quoted(g) for g in group]).orderBy(uid)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return known.select(*[_quoted(c) for c in df.columns],
                        *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__before_{n}")).alias(n) for n, c in amounts.items()])
