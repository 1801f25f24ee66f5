"""Results in pages by key, and lookups by parameter.

A page begins after a key, not at an offset: the filter ``key > :after`` goes down to the
scan (row groups of a table stored by key are skipped), and rows that come or go
before it do not shift the page. Values reach the SQL text as parameters
(``spark.sql(..., args=...)``), never by pasting.

``numbered_pages`` gives every row of a result its page at once, by positions from range
partitions (quarry.operators.prefix), with the total and the key to go on from.

Defined results: pages follow the key's order; the key must be unique and not null (rows with a null
key are on no page); an empty result has no pages; a page that is not there is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.frames import sql_id
from quarry.operators.prefix import with_positions


def page_after(rows: DataFrame, key: str, after=None, size: int = 200) -> DataFrame:
    """The ``size`` rows that follow the key ``after`` (the first ones if None)."""
    k = sql_id(key)
    where = f"{k} > :after" if after is not None else f"{k} IS NOT NULL"
    args = {"size": size} | ({"after": after} if after is not None else {})
    return rows.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {where} ORDER BY {k} LIMIT :size", args=args, rows=rows)


def next_key(page: DataFrame, key: str, size: int):
    """The key to go on from (a page's rows only); None where the page is the last."""
    last = page.agg(F.max(key).alias("key"), F.count(F.lit(1)).alias("n")).first()
    return last["key"] if last["n"] == size else None


def numbered_pages(rows: DataFrame, key: str, size: int) -> DataFrame:
    """``rows`` with ``page`` (from 1), ``total`` (all rows) and ``next_key`` (the page's last key; null on the last page)."""
    placed = with_positions(rows.where(F.col(key).isNotNull()), [], [key], out="position", size="total", purpose="pages")
    numbered = placed.withColumn("page", (F.expr(f"position div {int(size)}") + 1).cast("long"))
    ends = numbered.where((F.col("position") + 1) % size == 0).where(F.col("position") + 1 < F.col("total")).select(
        "page", F.col(key).alias("next_key"))
    return numbered.join(ends, "page", "left").drop("position")


def columns_of_table(spark: SparkSession, columns: DataFrame, table: str) -> DataFrame:
    """One table's columns in ordinal order; the name is a bound parameter."""
    return spark.sql("SELECT * FROM {columns} WHERE table_name = :name ORDER BY position", args={"name": table}, columns=columns)


def first_tables(tables: DataFrame, n: int) -> DataFrame:
    """The first ``n`` tables by name."""
    return tables.sparkSession.sql("SELECT * FROM {tables} ORDER BY table_name LIMIT :n", args={"n": n}, tables=tables)
