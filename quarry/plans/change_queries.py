"""Registered queries: what changed between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.changes import changes, store_state
from quarry.session import fresh_dir
from quarry.sources.tables import read_table

ROWS_PER_LEAF = 2000


def next_orders(orders: DataFrame) -> DataFrame:
    """The orders' next state: in a tenth of the key range, of each seven keys one is deleted, one
    updated (status, every other one also the price), and one comes again with a new key."""
    top = orders.agg(F.max("o_orderkey")).first()[0] or 0
    key = F.col("o_orderkey")
    near = (key >= top * 0.3) & (key < top * 0.4)
    kept = orders.where(~(near & (key % 7 == 0))).withColumns({
        "o_totalprice": F.when(near & (key % 7 == 1) & (key % 2 == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(near & (key % 7 == 1), F.lit("X")).otherwise(F.col("o_orderstatus"))})
    return kept.unionByName(orders.where(near & (key % 7 == 2)).withColumn("o_orderkey", key + top))


def table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted, updated (with the changed columns) and deleted between two states of orders;
    only the key ranges whose digests differ are read again."""
    orders = read_table(spark, sf_dir, "orders")
    root = fresh_dir(spark, "table_changes")
    before = store_state(orders, f"{root}/before", "o_orderkey", rows_per_leaf=ROWS_PER_LEAF)
    after = store_state(next_orders(orders), f"{root}/after", "o_orderkey", before.cuts)
    return changes(before, after).withColumn("columns", F.array_join("columns", ","))


QUERIES = {"table_changes": table_changes}

ORACLE = {
    "table_changes": """
        WITH t AS (SELECT max(o_orderkey) AS top FROM orders),
        o AS (SELECT orders.*, o_orderkey >= top * 0.3 AND o_orderkey < top * 0.4 AS near, top FROM orders, t),
        b AS (SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN near AND o_orderkey % 7 = 1 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS o_totalprice,
                     CASE WHEN near AND o_orderkey % 7 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderdate, o_orderpriority
              FROM o WHERE NOT (near AND o_orderkey % 7 = 0)
              UNION ALL SELECT o_orderkey + top, o_custkey, o_totalprice, o_orderstatus, o_orderdate, o_orderpriority FROM o
              WHERE near AND o_orderkey % 7 = 2),
        c AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderkey IS NULL AS came, b.o_orderkey IS NULL AS went,
                     array_to_string(list_filter([CASE WHEN a.o_custkey IS DISTINCT FROM b.o_custkey THEN 'o_custkey' END,
                       CASE WHEN a.o_orderdate IS DISTINCT FROM b.o_orderdate THEN 'o_orderdate' END,
                       CASE WHEN a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'o_orderpriority' END,
                       CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END,
                       CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END], lambda x: x IS NOT NULL), ',') AS differ
              FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
        SELECT CASE WHEN came THEN 'insert' WHEN went THEN 'delete' ELSE 'update' END AS change, o_orderkey,
               CASE WHEN came OR went THEN '' ELSE differ END AS columns, CAST(1 AS BIGINT) AS copies
        FROM c WHERE came OR went OR differ <> ''""",
}
