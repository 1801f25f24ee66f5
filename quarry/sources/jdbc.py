"""Relational (JDBC) scans.

The reference reads each source table through one JDBC connection, i.e. one
partition. Here a numeric key column splits the read into ``num_partitions``
range queries that run in parallel on the executors; the bounds are fetched
with one pushed-down ``min/max`` query instead of a full scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def key_bounds(spark: SparkSession, options: dict[str, str], key: str):
    """min/max of ``key``, computed inside the database."""
    probe = dict(options)
    table = probe.pop("dbtable")
    probe["query"] = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**probe).load().first()
    return row["lo"], row["hi"]


def read_jdbc(spark: SparkSession, options: dict[str, str], partition_column: str | None = None,
              num_partitions: int = 8, bounds=None) -> DataFrame:
    """A JDBC table as a DataFrame, range-partitioned on ``partition_column``.

    Without a partition column the read is a single partition, which is only
    right for small tables.
    """
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is None:
        return reader.load()
    lo, hi = bounds if bounds is not None else key_bounds(spark, options, partition_column)
    if lo is None:  # empty table
        return reader.load()
    return (reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lo))
            .option("upperBound", str(hi))
            .option("numPartitions", str(max(1, num_partitions)))
            .load())
