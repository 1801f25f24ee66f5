"""Registered queries: metadata extraction and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import metadata as M
from quarry.operators import profiles as P
from quarry.operators import quality as Q
from quarry.plans.declared import (DRIVER_CONSTRAINTS, FOREIGN_KEYS, LENGTHS, NOT_NULL, PRIMARY_KEYS, REQUIRED,
                                   REVERSE_CHECKS)
from quarry.plans.ingest_queries import orders_by_year
from quarry.sources.scratch import materialize
from quarry.sources.tables import ALL_TABLES, read_tables
from quarry.sources.versioned import SNAPSHOT_COL

SCHEMA = "main"


def _tables(spark, sf_dir):
    return read_tables(spark, sf_dir, ALL_TABLES)


def meta_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    listed = M.meta_tables(spark, tables, SCHEMA, allow=ALL_TABLES)
    return (listed.join(M.table_row_counts(tables), "table_name").select("table_schema", "table_name", "row_count")
            .orderBy("table_name"))


def meta_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.meta_columns(spark, _tables(spark, sf_dir), SCHEMA, allow=ALL_TABLES)


def columns_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (meta_columns(spark, sf_dir).groupBy("table_name")
            .agg(F.count(F.lit(1)).cast("long").alias("n_columns")))


def _constraints(spark):
    return M.constraint_relations(spark, DRIVER_CONSTRAINTS, SCHEMA)


def meta_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tc, kcu, _ = _constraints(spark)
    return M.primary_key_columns(tc, kcu, meta_columns(spark, sf_dir))


def meta_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tc, kcu, ccu = _constraints(spark)
    cols = meta_columns(spark, sf_dir).select("table_name", "column_name", "data_type")
    fks = M.foreign_key_columns(tc, kcu, ccu)
    ref = cols.select(F.col("table_name").alias("foreign_table_name"),
                      F.col("column_name").alias("foreign_column_name"),
                      F.col("data_type").alias("foreign_data_type"))
    return fks.join(cols, ["table_name", "column_name"]).join(ref, ["foreign_table_name", "foreign_column_name"])


def meta_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tc, kcu, ccu = _constraints(spark)
    cols = meta_columns(spark, sf_dir)
    docs = M.metadata_documents(cols, M.primary_key_columns(tc, kcu), M.foreign_key_columns(tc, kcu, ccu))
    return M.flatten_documents(docs)


def quality_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.all_null_profiles(_tables(spark, sf_dir))


def quality_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.all_length_profiles(_tables(spark, sf_dir), DRIVER_CONSTRAINTS)


def quality_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.all_duplicate_keys(_tables(spark, sf_dir), DRIVER_CONSTRAINTS)


def quality_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.all_reference_checks(_tables(spark, sf_dir), DRIVER_CONSTRAINTS, REVERSE_CHECKS)


def quality_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.quality_tags(Q.check_results(_tables(spark, sf_dir), DRIVER_CONSTRAINTS))


def not_null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every NOT NULL rule of every table, judged on profiles of one pass a table."""
    return P.not_null_results(P.store_of(_tables(spark, sf_dir), store_sketches=False), REQUIRED)


def profile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and range of every column of orders at every version (a year a version), and
    whether its NOT NULL rule holds there: merges of the versions' profiles, from one scan."""
    orders = orders_by_year(spark, sf_dir).read()
    store = materialize(P.profile_rows(orders, "orders", SNAPSHOT_COL), "profiles", measure_bytes=False).frame
    profiles = P.as_of(store)
    rules = P.not_null_results(profiles, REQUIRED).select("version", "column_name", "holds")
    return (profiles.join(rules, ["version", "column_name"], "left")
            .select("version", "column_name", "row_count", "null_count", F.round("low", 2).alias("low"), F.round("high", 2).alias("high"),
                    F.coalesce("holds", F.lit(True)).alias("holds")))


def profile_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values and quartiles of every column of every table, read out of its sketches."""
    return P.estimates(P.merge(P.store_of(_tables(spark, sf_dir))))


QUERIES = {
    "meta_tables": meta_tables,
    "meta_columns": meta_columns,
    "columns_per_table": columns_per_table,
    "meta_primary_keys": meta_primary_keys,
    "meta_foreign_keys": meta_foreign_keys,
    "meta_documents": meta_documents,
    "quality_nulls": quality_nulls,
    "quality_lengths": quality_lengths,
    "quality_pk_duplicates": quality_pk_duplicates,
    "quality_fk_orphans": quality_fk_orphans,
    "quality_tags": quality_tags,
    "not_null_rules": not_null_rules,
    "profile_versions": profile_versions,
    "profile_estimates": profile_estimates,
}

# --------------------------------------------------------------------- oracles
_IN = ", ".join(f"'{t}'" for t in ALL_TABLES)

# DuckDB type names -> Spark simple strings (fixed values for the driver's types).
_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"""

_COLS = f"""(SELECT DISTINCT table_name, column_name, {_TYPE} AS data_type, is_nullable,
      CAST(ordinal_position AS INTEGER) AS position
    FROM information_schema.columns WHERE table_name IN ({_IN}))"""


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


_PK_VALUES = _values([(f"pk_{t}", t, c, i + 1) for t, cols in PRIMARY_KEYS.items() for i, c in enumerate(cols)])
_FK_VALUES = _values([(fk.name, fk.table, c, i + 1, fk.ref_table, fk.ref_columns[i])
                      for fk in FOREIGN_KEYS for i, c in enumerate(fk.columns)])
_PK = f"(SELECT * FROM ({_PK_VALUES}) AS v(constraint_name, table_name, column_name, ordinal))"
_FK = (f"(SELECT * FROM ({_FK_VALUES}) AS v(constraint_name, table_name, column_name, ordinal, "
       f"foreign_table_name, foreign_column_name))")


def _counts_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES)


def _nulls_sql() -> str:
    parts = []
    for t in ALL_TABLES:
        parts.append(
            f"SELECT '{t}' AS table_name, u.column_name, r.row_count, CAST(u.null_count AS BIGINT) AS null_count "
            f"FROM (UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) "
            f"INTO NAME column_name VALUE null_count) u, (SELECT count(*) AS row_count FROM {t}) r")
    return " UNION ALL ".join(parts)


def _lengths_sql() -> str:
    parts = []
    for t, lim in LENGTHS.items():
        for c, n in lim.items():
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                f"CAST(coalesce(max(length({c})), 0) AS INTEGER) AS max_length, "
                f"CAST({n} AS INTEGER) AS declared_length, "
                f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS over_limit FROM {t}")
    return " UNION ALL ".join(parts)


def _dups_sql() -> str:
    parts = []
    for t, keys in PRIMARY_KEYS.items():
        k = ", ".join(keys)
        nk = " OR ".join(f"{c} IS NULL" for c in keys)
        parts.append(
            f"SELECT 'pk_{t}' AS constraint_name, '{t}' AS table_name, '{','.join(keys)}' AS key_columns, "
            f"CAST(count(*) FILTER (WHERE n > 1 AND NOT nk) AS BIGINT) AS duplicate_groups, "
            f"CAST(coalesce(sum(n) FILTER (WHERE n > 1 AND NOT nk), 0) AS BIGINT) AS duplicate_rows, "
            f"CAST(coalesce(sum(n) FILTER (WHERE nk), 0) AS BIGINT) AS null_key_rows "
            f"FROM (SELECT count(*) AS n, ({nk}) AS nk FROM {t} GROUP BY {k}) g")
    return " UNION ALL ".join(parts)


def _orphans_sql(with_reverse: bool = True) -> str:
    parts = []
    for fk in FOREIGN_KEYS:
        ks = [f"k{i}" for i in range(len(fk.columns))]
        child = ", ".join(f"{c} AS k{i}" for i, c in enumerate(fk.columns))
        parent = ", ".join(f"{c} AS k{i}" for i, c in enumerate(fk.ref_columns))
        on = " AND ".join(f"g.{k} = p.{k}" for k in ks)
        nk = " OR ".join(f"g.{k} IS NULL" for k in ks)
        miss = f"p.{ks[0]} IS NULL"
        parts.append(
            f"SELECT '{fk.name}' AS constraint_name, 'orphan' AS check_type, '{fk.table}' AS table_name, "
            f"'{fk.ref_table}' AS ref_table, "
            f"CAST(count(*) FILTER (WHERE NOT ({nk}) AND {miss}) AS BIGINT) AS violating_keys, "
            f"CAST(coalesce(sum(g.n) FILTER (WHERE NOT ({nk}) AND {miss}), 0) AS BIGINT) AS violating_rows, "
            f"CAST(coalesce(sum(g.n) FILTER (WHERE {nk}), 0) AS BIGINT) AS null_key_rows "
            f"FROM (SELECT {child}, count(*) AS n FROM {fk.table} GROUP BY ALL) g "
            f"LEFT JOIN (SELECT DISTINCT {parent} FROM {fk.ref_table}) p ON {on}")
    if with_reverse:
        by = {fk.name: fk for fk in FOREIGN_KEYS}
        for name, check in REVERSE_CHECKS:
            fk = by[name]
            cond = " AND ".join(f"c.{a} = p.{b}" for a, b in zip(fk.columns, fk.ref_columns))
            parts.append(
                f"SELECT '{check}' AS constraint_name, 'unreferenced' AS check_type, '{fk.ref_table}' AS table_name, "
                f"'{fk.table}' AS ref_table, CAST(count(*) AS BIGINT) AS violating_keys, "
                f"CAST(count(*) AS BIGINT) AS violating_rows, CAST(0 AS BIGINT) AS null_key_rows "
                f"FROM {fk.ref_table} p WHERE NOT EXISTS (SELECT 1 FROM {fk.table} c WHERE {cond})")
    return " UNION ALL ".join(parts)


def _required_sql(rules) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS violations, "
        f"count(*) = count({c}) AS holds FROM {t}" for t, columns in rules.items() for c in columns)


def _tags_sql() -> str:
    return f"""
WITH d AS ({_dups_sql()}), o AS ({_orphans_sql(False)}), l AS ({_lengths_sql()}),
n AS ({_required_sql(NOT_NULL)}),
r AS (
  SELECT table_name, duplicate_groups AS violations FROM d UNION ALL
  SELECT table_name, null_key_rows FROM d UNION ALL
  SELECT table_name, violating_rows FROM o UNION ALL
  SELECT table_name, violations FROM n UNION ALL
  SELECT table_name, over_limit FROM l)
SELECT table_name, CAST(count(*) AS BIGINT) AS checks,
       CAST(count(*) FILTER (WHERE violations > 0) AS BIGINT) AS failed_checks,
       CASE WHEN count(*) FILTER (WHERE violations > 0) > 0 THEN 'quality:fail' ELSE 'quality:pass' END AS tag
FROM r GROUP BY table_name"""


def _profile_versions_sql() -> str:
    columns = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "length(o_orderstatus)", "o_totalprice": "o_totalprice",
               "o_orderdate": "epoch(o_orderdate)", "o_orderpriority": "length(o_orderpriority)"}
    return " UNION ALL ".join(f"""
        SELECT CAST(s.v AS BIGINT) AS version, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
               round(min({number}), 2)::DOUBLE AS low, round(max({number}), 2)::DOUBLE AS high,
               {str(c in REQUIRED["orders"]).lower()} = false OR count(*) = count({c}) AS holds
        FROM (SELECT DISTINCT dense_rank() OVER (ORDER BY year(o_orderdate)) AS v FROM orders) s
        JOIN (SELECT *, dense_rank() OVER (ORDER BY year(o_orderdate)) AS v FROM orders) o ON o.v <= s.v GROUP BY s.v"""
                              for c, number in columns.items())


ORACLE = {
    "meta_tables": f"""
        SELECT 'main' AS table_schema, t.table_name, c.row_count
        FROM (SELECT DISTINCT table_name FROM information_schema.tables WHERE table_name IN ({_IN})) t
        JOIN ({_counts_sql()}) c ON c.table_name = t.table_name""",
    "meta_columns": f"""
        SELECT 'main' AS table_schema, table_name, column_name, data_type, is_nullable = 'YES' AS is_nullable,
               CAST(NULL AS VARCHAR) AS column_default, position FROM {_COLS}""",
    "columns_per_table": f"SELECT table_name, count(*) AS n_columns FROM {_COLS} GROUP BY table_name",
    "meta_primary_keys": f"""
        SELECT 'main' AS table_schema, k.table_name, k.constraint_name, k.column_name,
               CAST(k.ordinal AS INTEGER) AS ordinal, c.data_type
        FROM {_PK} k JOIN {_COLS} c ON c.table_name = k.table_name AND c.column_name = k.column_name""",
    "meta_foreign_keys": f"""
        SELECT 'main' AS table_schema, k.table_name, k.constraint_name, k.column_name,
               CAST(k.ordinal AS INTEGER) AS ordinal, k.foreign_table_name, k.foreign_column_name,
               c.data_type, p.data_type AS foreign_data_type
        FROM {_FK} k
        JOIN {_COLS} c ON c.table_name = k.table_name AND c.column_name = k.column_name
        JOIN {_COLS} p ON p.table_name = k.foreign_table_name AND p.column_name = k.foreign_column_name""",
    "meta_documents": f"""
        WITH c AS (SELECT table_name, count(*) AS n_columns,
                          string_agg(column_name, ',' ORDER BY position) AS columns FROM {_COLS} GROUP BY 1),
             p AS (SELECT table_name, string_agg(column_name, ',' ORDER BY ordinal) AS primary_keys
                   FROM {_PK} GROUP BY 1),
             f AS (SELECT table_name, string_agg(column_name || '->' || foreign_table_name || '.' || foreign_column_name,
                          ',' ORDER BY constraint_name, ordinal) AS foreign_keys FROM {_FK} GROUP BY 1)
        SELECT c.table_name, c.n_columns, c.columns, coalesce(p.primary_keys, '') AS primary_keys,
               coalesce(f.foreign_keys, '') AS foreign_keys
        FROM c LEFT JOIN p ON p.table_name = c.table_name LEFT JOIN f ON f.table_name = c.table_name""",
    "quality_nulls": _nulls_sql(),
    "quality_lengths": _lengths_sql(),
    "quality_pk_duplicates": _dups_sql(),
    "quality_fk_orphans": _orphans_sql(),
    "quality_tags": _tags_sql(),
    "not_null_rules": f"SELECT *, 1::BIGINT AS version FROM ({_required_sql(REQUIRED)})",
    "profile_versions": _profile_versions_sql(),
}
