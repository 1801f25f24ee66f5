"""Registered queries: keys and foreign keys found in the data."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import discovery as D
from quarry.operators import semantic as S
from quarry.plans.declared import FOREIGN_KEYS, PRIMARY_KEYS
from quarry.sources.tables import ALL_TABLES, read_tables

LEAST_PERCENT = 90
MAX_KEY_COLUMNS = 2


def foreign_keys_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose values are (to 90 %) in a unique column, with matching and orphan rows;
    ``declared``: the pair is a declared foreign key."""
    found = D.foreign_keys_found(read_tables(spark, sf_dir, ALL_TABLES), LEAST_PERCENT)
    declared = spark.createDataFrame([(fk.table, fk.columns[0], fk.ref_table, fk.ref_columns[0], True) for fk in FOREIGN_KEYS if len(fk.columns) == 1],
                                     "child_table string, child_column string, parent_table string, parent_column string, declared boolean")
    on = ["child_table", "child_column", "parent_table", "parent_column"]
    return found.join(declared, on, "left").withColumn("declared", F.coalesce("declared", F.lit(False)))


def keys_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimal unique sets of at most two columns of every table; ``declared``: it is the declared primary key."""
    found = D.unique_combinations(read_tables(spark, sf_dir, ALL_TABLES), MAX_KEY_COLUMNS)
    declared = spark.createDataFrame([(t, ",".join(k), True) for t, k in PRIMARY_KEYS.items()], "table_name string, key_columns string, declared boolean")
    return found.join(declared, ["table_name", "key_columns"], "left").withColumn("declared", F.coalesce("declared", F.lit(False)))


def semantic_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What kind of values every string column of every table holds, from the shapes of all of its values."""
    return S.semantic_types(read_tables(spark, sf_dir, ALL_TABLES))


QUERIES = {
    "semantic_types": semantic_types,
    "foreign_keys_found": foreign_keys_found,
    "keys_found": keys_found,
}

# --------------------------------------------------------------------- oracles
# The columns of the driver's tables, by the type that they are compared as.
_COLUMNS = {
    "region": {"r_regionkey": "i", "r_name": "s"},
    "nation": {"n_nationkey": "i", "n_name": "s", "n_regionkey": "i"},
    "customer": {"c_custkey": "i", "c_name": "s", "c_nationkey": "i", "c_acctbal": "f", "c_mktsegment": "s"},
    "supplier": {"s_suppkey": "i", "s_name": "s", "s_nationkey": "i", "s_acctbal": "f"},
    "part": {"p_partkey": "i", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "i", "p_retailprice": "f"},
    "orders": {"o_orderkey": "i", "o_custkey": "i", "o_orderstatus": "s", "o_totalprice": "f", "o_orderdate": "t", "o_orderpriority": "s"},
    "lineitem": {"l_orderkey": "i", "l_partkey": "i", "l_suppkey": "i", "l_linenumber": "i", "l_quantity": "f", "l_extendedprice": "f",
                 "l_discount": "f", "l_tax": "f", "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"},
    "events": {"event_id": "i", "ts": "t", "user_id": "i", "event_type": "s", "value": "f", "props": "s"},
    "documents": {"doc_id": "i", "text": "s", "lang": "s", "source": "s", "n_chars": "i"},
    "embeddings": {"vec_id": "i", "embedding": "a", "label": "i"},
    "pages": {"page_id": "i", "url": "s", "html": "s"},
    "benchmark": {"item_id": "i", "text": "s"},
    "labels": {"doc_id": "i", "quality": "i", "toxic": "i"},
    "conversations": {"conv_id": "i", "turn": "i", "role": "s", "text": "s"},
}


def _foreign_keys_sql() -> str:
    values = " UNION ALL ".join(
        f"SELECT '{t}' AS tab, '{c}' AS col, '{fam}' AS fam, CAST({c} AS VARCHAR) AS val, count(*) AS n FROM {t} GROUP BY ALL"
        for t, columns in _COLUMNS.items() for c, fam in columns.items())
    declared = ", ".join(f"('{fk.table}', '{fk.columns[0]}', '{fk.ref_table}', '{fk.ref_columns[0]}')" for fk in FOREIGN_KEYS)
    return f"""
WITH c AS MATERIALIZED ({values}),
v AS MATERIALIZED (SELECT * FROM c WHERE val IS NOT NULL),
s AS MATERIALIZED (SELECT tab, col, count(val) AS vals, coalesce(max(n) FILTER (WHERE val IS NOT NULL), 0) AS most,
                          coalesce(sum(n) FILTER (WHERE val IS NOT NULL), 0) AS with_value,
                          coalesce(sum(n) FILTER (WHERE val IS NULL), 0) AS nulls FROM c GROUP BY tab, col),
p AS (SELECT a.tab AS child_table, a.col AS child_column, b.tab AS parent_table, b.col AS parent_column,
             count(*) AS matched_values, sum(a.n) AS matching_rows
      FROM v a JOIN v b ON a.fam = b.fam AND a.val = b.val AND (a.tab, a.col) <> (b.tab, b.col) GROUP BY ALL)
SELECT p.child_table, p.child_column, p.parent_table, p.parent_column, x.vals AS child_values, matched_values, y.vals AS parent_values,
       CAST(matching_rows AS BIGINT) AS matching_rows, CAST(x.with_value - matching_rows AS BIGINT) AS orphan_rows,
       CAST(x.nulls AS BIGINT) AS null_rows,
       regexp_replace(child_column, '^[a-z]{{1,2}}_', '') = regexp_replace(parent_column, '^[a-z]{{1,2}}_', '') AS name_match,
       (child_table, child_column, parent_table, parent_column) IN ({declared}) AS declared
FROM p JOIN s x ON x.tab = child_table AND x.col = child_column JOIN s y ON y.tab = parent_table AND y.col = parent_column
WHERE y.most = 1 AND y.nulls = 0 AND 100 * matched_values >= {LEAST_PERCENT} * x.vals"""


def _keys_sql() -> str:
    one, two = [], []
    for t, columns in _COLUMNS.items():
        one += [f"SELECT '{t}' AS table_name, '{c}' AS a, NULL AS b, count(*) AS row_count, count(DISTINCT {{'v': {c}}}) AS vals, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {t}" for c in columns]
        two += [f"SELECT '{t}' AS table_name, '{a}' AS a, '{b}' AS b, count(*) AS row_count, count(DISTINCT {{'v': {a}, 'w': {b}}}) AS vals, "
                f"count(*) FILTER (WHERE {a} IS NULL OR {b} IS NULL) AS null_rows FROM {t}" for a, b in combinations(columns, 2)]
    declared = ", ".join(f"('{t}', '{','.join(k)}')" for t, k in PRIMARY_KEYS.items())
    return f"""
WITH one AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(one)}) WHERE row_count > 0 AND vals = row_count),
two AS (SELECT * FROM ({" UNION ALL ".join(two)}) x WHERE row_count > 0 AND vals = row_count
        AND NOT EXISTS (SELECT 1 FROM one WHERE one.table_name = x.table_name AND one.a IN (x.a, x.b))),
k AS (SELECT table_name, a AS key_columns, 1 AS size, row_count, null_rows FROM one
      UNION ALL SELECT table_name, a || ',' || b, 2, row_count, null_rows FROM two)
SELECT *, (table_name, key_columns) IN ({declared}) AS declared FROM k"""


def _semantic_types_sql() -> str:
    def replaced(value, steps):
        for pattern, by in steps:
            value = f"regexp_replace({value}, '{pattern}', '{by}', 'g')"
        return value
    cells = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CASE WHEN length({c}) > {S.LONGEST} THEN '*' ELSE {replaced(c, S.LEVELS[0])} END AS p0 "
        f"FROM {t} WHERE {c} IS NOT NULL" for t, columns in _COLUMNS.items() for c, kind in columns.items() if kind == "s")
    shapes = " ".join(f"WHEN regexp_matches(p1, '{pattern}') THEN '{name}'" for name, pattern in S.TYPES)
    order = ", ".join(f"'{n}'" for n, _ in S.TYPES)
    return f"""
WITH c AS (SELECT table_name, column_name, p0, count(*) AS n FROM ({cells}) GROUP BY ALL),
c1 AS (SELECT *, {replaced("p0", S.LEVELS[1])} AS p1 FROM c), c2 AS (SELECT *, {replaced("p1", S.LEVELS[2])} AS p2 FROM c1),
p AS MATERIALIZED (SELECT *, {replaced("p2", S.LEVELS[3])} AS p3 FROM c2),
l AS (SELECT table_name, column_name, 0 AS level, p0 AS pattern, n FROM p UNION ALL SELECT table_name, column_name, 1, p1, n FROM p
      UNION ALL SELECT table_name, column_name, 2, p2, n FROM p UNION ALL SELECT table_name, column_name, 3, p3, n FROM p),
m AS (SELECT table_name, column_name, level, pattern, sum(n) AS n FROM l GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY table_name, column_name, level ORDER BY n DESC, pattern) AS rank FROM m),
d AS (SELECT table_name, column_name, level, sum(n) AS covered, string_agg(pattern, ' | ' ORDER BY rank) AS patterns FROM r WHERE rank <= {S.TOP} GROUP BY ALL),
v AS (SELECT table_name, column_name, sum(n) AS n_values FROM p GROUP BY ALL),
b AS (SELECT d.*, n_values FROM d JOIN v USING (table_name, column_name)
      QUALIFY row_number() OVER (PARTITION BY table_name, column_name
        ORDER BY CASE WHEN 100 * covered >= {S.SHARE_PERCENT} * n_values THEN level ELSE 8 - level END) = 1),
y AS (SELECT table_name, column_name, CASE {shapes} ELSE '{S.OTHER}' END AS semantic_type, sum(n) AS of_type FROM p GROUP BY ALL),
k AS (SELECT * FROM y
      QUALIFY row_number() OVER (PARTITION BY table_name, column_name
        ORDER BY of_type DESC, coalesce(list_position([{order}], semantic_type), 99)) = 1)
SELECT b.table_name, b.column_name, CAST(n_values AS BIGINT) AS n_values, CAST(level AS INTEGER) AS level, patterns, CAST(covered AS BIGINT) AS covered,
       semantic_type, CAST(of_type AS BIGINT) AS of_type FROM b JOIN k USING (table_name, column_name)"""


ORACLE = {
    "semantic_types": _semantic_types_sql(),
    "foreign_keys_found": _foreign_keys_sql(),
    "keys_found": _keys_sql(),
}
