"""Registered queries: raw-layer ingest and versioned tables.

Every query reads the driver's tables from ``sf_dir``; queries that write do
so into a fresh folder under the session's shared work folder, so re-running
a query never sees the previous run's snapshots.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.names import DEFAULT_RUN_TS
from quarry.operators.analytics import top_k_counts_via_lookup
from quarry.operators.ingest import (batch_summary, ingest_tables, select_with_timestamp,
                                     with_audit_columns)
from quarry.operators.prefix import running_totals
from quarry.operators.versions import version_totals
from quarry.session import fresh_dir
from quarry.sources.tables import ALL_TABLES, read_table, table_path
from quarry.sources.versioned import SNAPSHOT_COL, VersionedTable

INGEST_SET = ALL_TABLES
RUN_TS = dt.datetime(2024, 1, 1)


def topk_by_key(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Slice 0: customer -> raw snapshot 1 -> read back -> customers per nation, top k."""
    table = VersionedTable(spark, fresh_dir(spark, "topk_by_key"), "raw_customer")
    table.create(with_audit_columns(read_table(spark, sf_dir, "customer"), DEFAULT_RUN_TS), committed_at=RUN_TS)
    customers = table.read()
    nation = read_table(spark, sf_dir, "nation")
    return top_k_counts_via_lookup(customers, "c_nationkey", nation, "n_nationkey", "n_name",
                                   k=k, count_name="customer_count")


def raw_ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_audit_columns(read_table(spark, sf_dir, "orders"), DEFAULT_RUN_TS)


def raw_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-schema table, then append a 4-column projection + timestamp."""
    projected = select_with_timestamp(read_table(spark, sf_dir, "customer"),
                                      ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], ts_value=DEFAULT_RUN_TS)
    table = VersionedTable(spark, fresh_dir(spark, "raw_projection"), "customers_demo")
    table.create_if_not_exists(projected.schema)
    table.append(projected, committed_at=RUN_TS)
    return table.read().drop(SNAPSHOT_COL)


def raw_create_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declare, then create-or-append two batches; read the union back."""
    customer = with_audit_columns(read_table(spark, sf_dir, "customer"), DEFAULT_RUN_TS)
    table = VersionedTable(spark, fresh_dir(spark, "raw_create_append"), "raw_customer")
    table.create_if_not_exists(customer.schema)  # declares, no snapshot
    first = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False))  # every row lands in exactly one batch
    table.create_or_append(customer.where(first), committed_at=RUN_TS, batch_id="b1")
    table.create_or_append(customer.where(~first), committed_at=RUN_TS, batch_id="b2")
    table.create_or_append(customer.where(first), committed_at=RUN_TS, batch_id="b1")  # replay: no-op
    return table.read()


def version_current(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    return raw_create_append(spark, sf_dir).orderBy("c_custkey").limit(k)


def raw_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = fresh_dir(spark, "raw_batch_summary")
    sources = {t: read_table(spark, sf_dir, t) for t in INGEST_SET}
    results = ingest_tables(spark, sources, warehouse, DEFAULT_RUN_TS, committed_at=RUN_TS)
    return batch_summary(spark, results, warehouse)


def orders_by_year(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """orders appended one calendar year per snapshot, in year order, in one write."""
    orders = read_table(spark, sf_dir, "orders").withColumn("_year", F.year("o_orderdate"))
    table = VersionedTable(spark, fresh_dir(spark, "orders_by_year"), "raw_orders")
    table.append_batches(orders, "_year", committed_at_for=lambda y: dt.datetime(int(y) + 1, 1, 1))  # not asked for a null year
    return table


def _no_null_parent(df: DataFrame) -> DataFrame:
    # 0 = "no parent": snapshot ids start at 1, and a non-null column keeps its integer type.
    return df.withColumn("parent_id", F.coalesce("parent_id", F.lit(0).cast("long")))


def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_null_parent(orders_by_year(spark, sf_dir).history())


def version_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_null_parent(orders_by_year(spark, sf_dir).snapshots().drop("batch_id"))


def version_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_year(spark, sf_dir).files()


def time_travel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count as of every snapshot: running totals over the snapshots, from one scan."""
    totals = version_totals(orders_by_year(spark, sf_dir).read(), SNAPSHOT_COL, {})
    return totals.select(F.col("version").alias("snapshot_id"), F.col("n_rows").alias("row_count"))


def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every version of orders: its rows, customers and value, and the rows
    and value that came with it, from one scan of the table."""
    totals = version_totals(orders_by_year(spark, sf_dir).read(), SNAPSHOT_COL, {"total_price": F.col("o_totalprice")},
                            {"n_customers": F.col("o_custkey")})
    return totals.select("version", F.col("n_rows").alias("n_orders"), "n_customers", F.round("total_price", 2).alias("total_price"),
                         F.col("new_n_rows").alias("new_orders"), F.round("new_total_price", 2).alias("new_price"))


def running_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the running count and value (in cents) of its status, and of all
    orders, by date and key: running totals without a task that sees all rows."""
    orders = (read_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_orderstatus", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")))
    order = ["o_orderdate", "o_orderkey"]
    one = {"running_orders": F.lit(1).cast("long"), "running_cents": F.col("cents")}
    of_status = running_totals(orders, ["o_orderstatus"], order, one, "running_orders")
    of_all = running_totals(orders.select(*order), [], order, {"overall_orders": F.lit(1).cast("long")}, "running_orders")
    return of_status.join(of_all, order)


def raw_topk_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over ingested tables: the raw customers as a temporary view."""
    table = VersionedTable(spark, fresh_dir(spark, "raw_topk_sql"), "raw_customer")
    table.create(with_audit_columns(read_table(spark, sf_dir, "customer"), DEFAULT_RUN_TS), committed_at=RUN_TS)
    return spark.sql("""
        SELECT c_mktsegment, count(*) AS n_customers, round(avg(c_acctbal), 2) AS mean_balance
        FROM {raw_customer} GROUP BY c_mktsegment ORDER BY n_customers DESC, c_mktsegment LIMIT 3""",
                     raw_customer=table.read())


def stream_events_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events through a file stream (availableNow) appended per micro-batch to a raw table."""
    from quarry.streaming.events import append_stream, run_to_completion, stream_source
    root = fresh_dir(spark, "stream_events_append")
    table = VersionedTable(spark, root, "raw_events")
    schema = read_table(spark, sf_dir, "events").schema
    query = append_stream(stream_source(spark, table_path(sf_dir, "events"), schema), table,
                          checkpoint=f"{root}/_checkpoint", extracted_at=DEFAULT_RUN_TS)
    run_to_completion(query)
    table.refresh()
    return table.read().drop(SNAPSHOT_COL)


QUERIES = {
    "topk_by_key": topk_by_key,
    "raw_ingest_audit": raw_ingest_audit,
    "raw_projection": raw_projection,
    "raw_create_append": raw_create_append,
    "version_current": version_current,
    "raw_batch_summary": raw_batch_summary,
    "version_history": version_history,
    "version_snapshots": version_snapshots,
    "version_files": version_files,
    "time_travel_counts": time_travel_counts,
    "version_changes": version_changes,
    "running_orders": running_orders,
    "raw_topk_sql": raw_topk_sql,
    "stream_events_append": stream_events_append,
}

_TS = f"TIMESTAMP '{DEFAULT_RUN_TS}'"
_AUDIT = f"{_TS} AS _extracted_at, 'tpch' AS _source_system, 'raw' AS _layer"
_YEARS = """
WITH y AS (SELECT year(o_orderdate) AS yr, count(*) AS added_rows FROM orders GROUP BY 1),
s AS (SELECT CAST(row_number() OVER (ORDER BY yr) AS BIGINT) AS snapshot_id, yr, added_rows FROM y)
"""

ORACLE = {
    "topk_by_key": """
        SELECT n.n_name, count(*) AS customer_count
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name ORDER BY customer_count DESC, n.n_name LIMIT 10""",
    "raw_ingest_audit": f"SELECT *, {_AUDIT} FROM orders",
    "stream_events_append": f"SELECT *, {_AUDIT} FROM events",
    "raw_projection": f"SELECT c_custkey, c_name, c_nationkey, c_mktsegment, {_TS} AS created_at FROM customer",
    "raw_create_append": f"""
        SELECT *, {_AUDIT}, CAST(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 2 END AS BIGINT) AS _snapshot_id
        FROM customer""",
    "version_current": f"""
        SELECT *, {_AUDIT}, CAST(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 2 END AS BIGINT) AS _snapshot_id
        FROM customer ORDER BY c_custkey LIMIT 10""",
    "raw_batch_summary": """
        WITH c AS (
          SELECT 'region' AS table_name, count(*) AS n FROM region UNION ALL
          SELECT 'nation', count(*) FROM nation UNION ALL
          SELECT 'customer', count(*) FROM customer UNION ALL
          SELECT 'supplier', count(*) FROM supplier UNION ALL
          SELECT 'part', count(*) FROM part UNION ALL
          SELECT 'orders', count(*) FROM orders UNION ALL
          SELECT 'lineitem', count(*) FROM lineitem UNION ALL
          SELECT 'events', count(*) FROM events UNION ALL
          SELECT 'documents', count(*) FROM documents UNION ALL
          SELECT 'embeddings', count(*) FROM embeddings UNION ALL
          SELECT 'pages', count(*) FROM pages UNION ALL
          SELECT 'benchmark', count(*) FROM benchmark UNION ALL
          SELECT 'labels', count(*) FROM labels UNION ALL
          SELECT 'conversations', count(*) FROM conversations)
        SELECT table_name, CAST(n AS BIGINT) AS records_extracted, CAST(1 AS BIGINT) AS tables_ok FROM c
        UNION ALL
        SELECT '__total__', CAST(sum(n) AS BIGINT), CAST(count(*) AS BIGINT) FROM c""",
    "version_history": _YEARS + """
        SELECT make_timestamp(CAST(yr + 1 AS BIGINT), 1, 1, 0, 0, 0.0) AS made_current_at, snapshot_id,
               snapshot_id - 1 AS parent_id,
               CASE WHEN snapshot_id = 1 THEN 'create' ELSE 'append' END AS operation,
               added_rows,
               CAST(coalesce(sum(added_rows) OVER (ORDER BY snapshot_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS previous_total_rows,
               CAST(sum(added_rows) OVER (ORDER BY snapshot_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_rows
        FROM s""",
    "version_snapshots": _YEARS + """
        SELECT make_timestamp(CAST(yr + 1 AS BIGINT), 1, 1, 0, 0, 0.0) AS committed_at, snapshot_id,
               snapshot_id - 1 AS parent_id,
               CASE WHEN snapshot_id = 1 THEN 'create' ELSE 'append' END AS operation,
               added_rows
        FROM s""",
    "version_changes": """
        WITH y AS (SELECT *, dense_rank() OVER (ORDER BY year(o_orderdate)) AS v FROM orders),
        versions AS (SELECT DISTINCT v FROM y)
        SELECT CAST(s.v AS BIGINT) AS version, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers,
               round(sum(o_totalprice), 2) AS total_price, count(*) FILTER (WHERE y.v = s.v) AS new_orders,
               round(sum(o_totalprice) FILTER (WHERE y.v = s.v), 2) AS new_price
        FROM versions s JOIN y ON y.v <= s.v GROUP BY s.v""",
    "running_orders": """
        SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
               count(*) OVER s AS running_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER s AS BIGINT) AS running_cents,
               count(*) OVER a AS overall_orders
        FROM orders
        WINDOW s AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING),
               a AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
    "raw_topk_sql": """
        SELECT c_mktsegment, count(*) AS n_customers, round(avg(c_acctbal), 2) AS mean_balance
        FROM customer GROUP BY c_mktsegment ORDER BY n_customers DESC, c_mktsegment LIMIT 3""",
    "time_travel_counts": _YEARS + """
        SELECT snapshot_id,
               CAST(sum(added_rows) OVER (ORDER BY snapshot_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS row_count
        FROM s""",
}
