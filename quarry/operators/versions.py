"""What a versioned table held at each of its versions, from one scan.

Reading the table once a version repeats the early rows for every later version. A
version's totals are running totals over the snapshots instead: one pass counts each
snapshot, and a prefix sum over one row a snapshot gives what each version held. Distinct keys
add up the same way once each key is counted in the snapshot that first has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.prefix import running_totals
from quarry.sources.scratch import materialize


def version_totals(rows: DataFrame, version_col: str, sums: dict[str, Column], distinct: dict[str, Column] | None = None) -> DataFrame:
    """One row a version: ``version``, ``n_rows`` and each named sum and number of distinct keys over the rows
    up to it, and ``new_n_rows`` and ``new_<sum>`` over the rows that came with it. Sums skip nulls; nulls are no key."""
    keys = distinct or {}
    # one scan: rows and sums of each (version, keys); what follows reads this, a row a key and version
    parts = (rows.groupBy(F.col(version_col).cast("long").alias("version"), *[c.alias(f"key_{n}") for n, c in keys.items()])
             .agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(n) for n, c in sums.items()]))
    kept = materialize(parts, "version_totals", measure_bytes=False).frame
    totals = kept.groupBy("version").agg(F.sum("n_rows").alias("n_rows"), *[F.sum(n).alias(n) for n in sums])
    for n in keys:
        first = (kept.where(F.col(f"key_{n}").isNotNull()).groupBy(f"key_{n}").agg(F.min("version").alias("version"))
                 .groupBy("version").agg(F.count(F.lit(1)).alias(n)))
        totals = totals.join(first, "version", "left").withColumn(n, F.coalesce(n, F.lit(0)))
    new = [F.col(n).alias(f"new_{n}") for n in ["n_rows", *sums]]
    named = totals.select("version", *new, *[F.col(n).alias(f"new_{n}") for n in keys])
    running = {n: F.col(f"new_{n}") for n in ["n_rows", *sums, *keys]}
    return running_totals(named, [], ["version"], running, "version_totals").drop(*[f"new_{n}" for n in keys])
