"""Registered queries: column-level lineage of the layered ETL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import metadata as M
from quarry.operators import quality as Q
from quarry.operators.column_lineage import column_edges, trace
from quarry.plans.lineage_queries import DB, LAYERS_ANALYTICS, _run_layers
from quarry.sources.tables import read_tables, table_path

SOURCES = ["orders", "customer"]


def column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column upstream of the analytics table's columns, through all jobs of the layered ETL:
    jobs between, the expression of the target, and rows and nulls of the source columns."""
    jobs: list = []
    stages = _run_layers(spark, sf_dir, jobs)
    names = {table_path(sf_dir, t): f"source.{DB}.{t}" for t in SOURCES} | {t.path: qn for qn, t in stages.items()}
    edges = [e for target, frame in jobs for e in column_edges(frame, target, names)]
    made = (spark.createDataFrame(edges, "src string, dst string, expression string")
            .groupBy(F.col("dst").alias("target_column")).agg(F.min("expression").alias("expression")))
    tables = read_tables(spark, sf_dir, SOURCES)
    column = F.concat(F.lit(f"source.{DB}."), "table_name", F.lit("."), "column_name").alias("source_column")
    profile = Q.all_null_profiles(tables).select(column, F.col("row_count").alias("source_rows"), F.col("null_count").alias("source_nulls"))
    whole = M.table_row_counts(tables).select(F.concat(F.lit(f"source.{DB}."), "table_name", F.lit(".*")).alias("source_column"),
                                              F.col("row_count").alias("source_rows"), F.lit(0).cast("long").alias("source_nulls"))
    return (trace(spark, edges, LAYERS_ANALYTICS).join(made, "target_column")
            .join(profile.unionByName(whole), "source_column", "left")
            .withColumn("source_rows", F.coalesce("source_rows", F.lit(-1))).withColumn("source_nulls", F.coalesce("source_nulls", F.lit(-1))))


QUERIES = {"column_lineage": column_lineage}

# --------------------------------------------------------------------- oracles
# What the layered ETL's jobs do, column by column (target, expression, upstream columns from near to far).
_STEPS = [("processed.tpch.processed_orders", 1), ("raw.tpch.raw_orders", 2), ("source.tpch.orders", 3)]
_EXPECTED = [("c_custkey", "c_custkey", "source.tpch.customer.c_custkey", 1, True),
             ("c_name", "c_name", "source.tpch.customer.c_name", 1, True),
             ("c_mktsegment", "c_mktsegment", "source.tpch.customer.c_mktsegment", 1, True)]
for _target, _how, _column in (("order_count", "CAST(count(1) AS BIGINT)", "*"), ("total_spent", "round(sum(o_totalprice), 2)", "o_totalprice"),
                               ("last_order_date", "max(o_orderdate)", "o_orderdate")):
    _EXPECTED += [(_target, _how, f"{table}.{_column}", depth, depth == 3) for table, depth in _STEPS]


def _column_lineage_sql() -> str:
    rows = ", ".join(f"('{LAYERS_ANALYTICS}.{t}', '{how}', '{src}', {depth}, {str(end).lower()})" for t, how, src, depth, end in _EXPECTED)
    counted = " UNION ALL ".join(f"SELECT 'source.{DB}.{t}.{c}' AS source_column, count(*) AS source_rows, count(*) - count({c}) AS source_nulls FROM {t}"
                                 for t, c in (("customer", "c_custkey"), ("customer", "c_name"), ("customer", "c_mktsegment"),
                                              ("orders", "o_totalprice"), ("orders", "o_orderdate")))
    return f"""
        WITH e AS (SELECT * FROM (VALUES {rows}) v(target_column, expression, source_column, depth, is_source)),
        n AS ({counted} UNION ALL SELECT 'source.{DB}.orders.*', count(*), 0 FROM orders)
        SELECT target_column, expression, source_column, CAST(depth AS INTEGER) AS depth, is_source,
               coalesce(source_rows, -1) AS source_rows, coalesce(source_nulls, -1) AS source_nulls
        FROM e LEFT JOIN n USING (source_column)"""


ORACLE = {"column_lineage": _column_lineage_sql()}
