"""Group-by / top-k analytics over (versioned) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k_counts(df: DataFrame, key: str, k: int = 10, count_name: str = "row_count") -> DataFrame:
    """``GROUP BY key ORDER BY count DESC, key LIMIT k``.

    The key is the second sort column, so ties at the cut are resolved the
    same way on every run. Spark plans this as partial/final hash aggregation
    followed by TakeOrderedAndProject (a per-partition top-k, never a full sort).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.col(count_name).desc(), F.col(key).asc()).limit(k)


def top_k_counts_via_lookup(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                            label: str, k: int = 10, count_name: str = "row_count") -> DataFrame:
    """Top-k of a fact table grouped by a dimension label.

    The facts are counted per join key *before* the join (one row per key
    leaves the map side), so a hot key costs one partial-aggregate row rather
    than a skewed join partition; the small result then meets the dimension,
    and counts are re-summed per label (labels need not be unique).
    """
    per_key = facts.groupBy(fact_key).agg(F.count(F.lit(1)).alias("_n"))
    joined = per_key.join(dim.select(dim_key, label), per_key[fact_key] == dim[dim_key])
    counts = joined.groupBy(label).agg(F.sum("_n").cast("long").alias(count_name))
    return counts.orderBy(F.col(count_name).desc(), F.col(label).asc()).limit(k)
