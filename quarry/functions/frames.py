"""DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame | None:
    """Bag union by column name of any number of frames (None for none).

    Unions are paired up as a balanced tree: each ``unionByName`` analyses
    the plan it builds, so a left-deep chain of n parts costs O(n^2) planning
    while the tree costs O(n log n). Catalyst flattens nested unions, so the
    physical plan is the same.
    """
    parts = list(frames)
    if not parts:
        return None
    while len(parts) > 1:
        nxt = [parts[i].unionByName(parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
        if len(parts) % 2:
            nxt.append(parts[-1])
        parts = nxt
    return parts[0]


def sql_str(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_id(name: str) -> str:
    """A Spark SQL identifier (back-quoted)."""
    return "`" + name.replace("`", "``") + "`"


# Semi- and anti-joins written as a left outer join against the right side's
# distinct keys plus a match marker. Catalyst pushes LEFT SEMI / LEFT ANTI
# joins below a union, one copy per branch: the right side is then planned
# once per branch, and a branch whose key is a constant turns into a
# nested-loop existence check. An outer join stays above the union, so the
# right side is computed once and the join is a plain equi-join (its distinct
# keys are what gets shuffled or, when AQE measures them small, broadcast).

def _marked(right: DataFrame, on: list[str]) -> DataFrame:
    from pyspark.sql import functions as F
    return right.select(*on).distinct().withColumn("__matched", F.lit(True))


def _on(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose ``on`` key occurs in ``right`` (null keys never match)."""
    from pyspark.sql import functions as F
    keys = _on(on)
    return (left.join(_marked(right, keys), keys, "left").where(F.col("__matched").isNotNull())
            .drop("__matched").select(*left.columns))


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose ``on`` key does not occur in ``right`` (null keys are kept)."""
    from pyspark.sql import functions as F
    keys = _on(on)
    return (left.join(_marked(right, keys), keys, "left").where(F.col("__matched").isNull())
            .drop("__matched").select(*left.columns))
