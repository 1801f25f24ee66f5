"""Metadata extraction: tables, columns, keys, per-table metadata documents.

Schemas are read from the sources' footers (no data scan) and turned into
one small DataFrame per relation with a single ``createDataFrame``; every
further step (allow-list, joins, nesting) is a DataFrame operation. Parquet
carries no key constraints, so keys are *declared* in the shape of the three
SQL constraint relations and joined exactly like the database's own views.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.frames import union_all

META_TABLES_SCHEMA = T.StructType([
    T.StructField("table_schema", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
])

META_COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_schema", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
    T.StructField("is_nullable", T.StringType(), False),
    T.StructField("column_default", T.StringType(), True),
    T.StructField("ordinal", T.IntegerType(), False),
])

TABLE_CONSTRAINTS_SCHEMA = T.StructType([
    T.StructField("constraint_name", T.StringType(), False),
    T.StructField("table_schema", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("constraint_type", T.StringType(), False),
])

KEY_USAGE_SCHEMA = T.StructType([
    T.StructField("constraint_name", T.StringType(), False),
    T.StructField("table_schema", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
])


@dataclass(frozen=True)
class ForeignKey:
    name: str
    table: str
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]


@dataclass
class Constraints:
    """Declared keys: ``primary_keys[table] = (cols...)`` and a list of FKs."""
    primary_keys: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: list[ForeignKey] = field(default_factory=list)
    lengths: dict[str, dict[str, int]] = field(default_factory=dict)
    not_null: dict[str, tuple[str, ...]] = field(default_factory=dict)  # besides the primary keys

    def pk_name(self, table: str) -> str:
        return f"pk_{table}"


def schema_rows(tables: dict[str, DataFrame], schema_name: str):
    for t, df in tables.items():
        for i, f in enumerate(df.schema.fields):
            yield (schema_name, t, f.name, f.dataType.simpleString(),
                   "YES" if f.nullable else "NO", None, i + 1)


def meta_tables(spark: SparkSession, tables: dict[str, DataFrame], schema_name: str = "main",
                allow: list[str] | None = None, ordered: bool = False) -> DataFrame:
    """``(table_schema, table_name)`` for the allow-listed tables.

    ``ordered=True`` sorts by name for a listing; catalog builds leave it off,
    since a sort inside a larger plan costs a sampling job and the joins
    after it do not keep the order anyway.
    """
    df = spark.createDataFrame([(schema_name, t) for t in tables], META_TABLES_SCHEMA)
    if allow is not None:
        df = df.where(F.col("table_name").isin(list(allow)))
    df = df.where(F.col("table_schema") == schema_name)
    return df.orderBy("table_name") if ordered else df


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, all tables in one aggregate (count(*) reads no column data).

    Each scan is labelled with its table name and the union is grouped once:
    partial counts per map task, one small exchange for all tables. A seed
    row per table (counted as 0) keeps empty tables in the result.
    """
    if not tables:
        raise ValueError("no tables to count")
    spark = next(iter(tables.values())).sparkSession
    labelled = union_all([df.select(F.lit(t).alias("table_name"), F.lit(1).alias("_one"))
                          for t, df in tables.items()])
    seed = spark.createDataFrame([(t, 0) for t in tables], "table_name string, _one int")
    return (labelled.unionByName(seed).groupBy("table_name")
            .agg(F.sum("_one").cast("long").alias("row_count")))


def meta_columns(spark: SparkSession, tables: dict[str, DataFrame], schema_name: str = "main",
                 allow: list[str] | None = None) -> DataFrame:
    """One row per column with a dense 1-based ``position`` in ordinal order."""
    raw = spark.createDataFrame(list(schema_rows(tables, schema_name)), META_COLUMNS_SCHEMA)
    if allow is not None:
        raw = raw.where(F.col("table_name").isin(list(allow)))
    w = Window.partitionBy("table_schema", "table_name").orderBy("ordinal")
    return (raw.withColumn("position", F.row_number().over(w).cast("int"))
            .withColumn("is_nullable", F.col("is_nullable") == "YES")
            .drop("ordinal"))


def constraint_relations(spark: SparkSession, cons: Constraints, schema_name: str = "main"):
    """The three SQL constraint relations for a declaration."""
    tc, kcu, ccu = [], [], []
    for table, cols in cons.primary_keys.items():
        name = cons.pk_name(table)
        tc.append((name, schema_name, table, "PRIMARY KEY"))
        kcu.extend((name, schema_name, table, c, i + 1) for i, c in enumerate(cols))
        ccu.extend((name, schema_name, table, c, i + 1) for i, c in enumerate(cols))
    for fk in cons.foreign_keys:
        tc.append((fk.name, schema_name, fk.table, "FOREIGN KEY"))
        kcu.extend((fk.name, schema_name, fk.table, c, i + 1) for i, c in enumerate(fk.columns))
        ccu.extend((fk.name, schema_name, fk.ref_table, c, i + 1) for i, c in enumerate(fk.ref_columns))
    return (spark.createDataFrame(tc, TABLE_CONSTRAINTS_SCHEMA),
            spark.createDataFrame(kcu, KEY_USAGE_SCHEMA),
            spark.createDataFrame(ccu, KEY_USAGE_SCHEMA))


def primary_key_columns(table_constraints: DataFrame, key_usage: DataFrame,
                        columns: DataFrame | None = None) -> DataFrame:
    """PK columns: constraints ⋈ key usage on (constraint_name, table_schema).

    With ``columns`` given, each key column is checked against the extracted
    schema (inner join) and carries its data type.
    """
    pks = (table_constraints.where(F.col("constraint_type") == "PRIMARY KEY")
           .join(key_usage.drop("table_name"), ["constraint_name", "table_schema"]))
    pks = pks.select("table_schema", "table_name", "constraint_name", "column_name", "ordinal")
    if columns is not None:
        pks = pks.join(columns.select("table_schema", "table_name", "column_name", "data_type"),
                       ["table_schema", "table_name", "column_name"])
    return pks


def foreign_key_columns(table_constraints: DataFrame, key_usage: DataFrame,
                        ref_usage: DataFrame) -> DataFrame:
    """FK columns with their referenced column, matched by ordinal position.

    Joining on the constraint name alone would pair every column of a
    multi-column key with every referenced column; the ordinal keeps pairs.
    """
    fk = (table_constraints.where(F.col("constraint_type") == "FOREIGN KEY")
          .join(key_usage.drop("table_name"), ["constraint_name", "table_schema"]))
    ref = ref_usage.select("constraint_name", "table_schema",
                           F.col("table_name").alias("foreign_table_name"),
                           F.col("column_name").alias("foreign_column_name"), "ordinal")
    return (fk.join(ref, ["constraint_name", "table_schema", "ordinal"])
            .select("table_schema", "table_name", "constraint_name", "column_name", "ordinal",
                    "foreign_table_name", "foreign_column_name"))


def metadata_documents(columns: DataFrame, pks: DataFrame, fks: DataFrame) -> DataFrame:
    """Per table: ``columns[]`` (by position), ``primary_keys[]``, ``foreign_keys[]``.

    Groups are tables, so each collected list is bounded by a table's width.
    """
    cols = (columns.groupBy("table_schema", "table_name")
            .agg(F.array_sort(F.collect_list(F.struct("position", "column_name", "data_type", "is_nullable")))
                 .alias("columns")))
    pk = (pks.groupBy("table_schema", "table_name")
          .agg(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))).alias("_pk")))
    fk = (fks.groupBy("table_schema", "table_name")
          .agg(F.array_sort(F.collect_list(F.struct("constraint_name", "ordinal", "column_name",
                                                    "foreign_table_name", "foreign_column_name")))
               .alias("foreign_keys")))
    return (cols.join(pk, ["table_schema", "table_name"], "left")
            .join(fk, ["table_schema", "table_name"], "left")
            .select("table_schema", "table_name", "columns",
                    F.coalesce(F.transform("_pk", lambda s: s["column_name"]),
                               F.array().cast("array<string>")).alias("primary_keys"),
                    F.coalesce("foreign_keys", F.array().cast(fk.schema["foreign_keys"].dataType))
                    .alias("foreign_keys")))


def flatten_documents(docs: DataFrame) -> DataFrame:
    """Render the nested documents as scalar strings (for reports and checks)."""
    return docs.select(
        "table_name",
        F.size("columns").cast("long").alias("n_columns"),
        F.array_join(F.transform("columns", lambda c: c["column_name"]), ",").alias("columns"),
        F.array_join("primary_keys", ",").alias("primary_keys"),
        F.array_join(F.transform("foreign_keys", lambda k: F.concat(
            k["column_name"], F.lit("->"), k["foreign_table_name"], F.lit("."), k["foreign_column_name"])),
            ",").alias("foreign_keys"),
    )
