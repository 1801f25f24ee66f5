"""Entities of free shape: one nested document each, as Spark's variant type.

A table with its columns, keys and figures is one document, whatever fields its source
knows: documents of different shape lie in one column, and a reader takes typed fields out of
them by path. Where sources name a field differently (``type``, ``dataType``), the reader names the
paths in order and the first that is there counts. ``shape_of`` infers the schema
that all rows together have.

Defined results: a path that is not there, or whose value cannot be read as the type asked for, is
null; a document goes to JSON and back unchanged (its fields in order of their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_documents(columns: DataFrame, profiles: DataFrame, layer: str, type_field: str = "dataType") -> DataFrame:
    """``qualified_name, document``: a table of ``columns`` (table_name, column_name, data_type, position) with the
    rows and nulls of ``profiles`` (table_name, column_name, row_count, null_count), its columns nested. The list of a table's
    columns is as long as the table is wide."""
    column = F.struct(F.col("column_name").alias("name"), F.col("data_type").alias(type_field), F.col("position").alias("position"),
                      F.struct(F.col("null_count").alias("nulls")).alias("profile"))
    nested = (columns.join(profiles, ["table_name", "column_name"]).groupBy("table_name")
              .agg(F.max("row_count").alias("row_count"), F.array_sort(F.collect_list(F.struct("position", column.alias("c")))).alias("listed")))
    document = F.struct(F.lit("table").alias("kind"), F.lit(layer).alias("layer"), F.col("table_name").alias("name"),
                        F.col("row_count").alias("rows"), F.transform("listed", lambda x: x["c"]).alias("columns"))
    return nested.select(F.concat_ws(".", F.lit(layer), "table_name").alias("qualified_name"), F.to_variant_object(document).alias("document"))


def process_documents(processes: DataFrame) -> DataFrame:
    """``qualified_name, document`` of processes with their ``inputs`` and ``outputs`` as arrays."""
    document = F.struct(F.lit("process").alias("kind"), F.col("process_qn").alias("name"), F.col("inputs"), F.col("outputs"))
    return processes.select(F.col("process_qn").alias("qualified_name"), F.to_variant_object(document).alias("document"))


def field(document: str, paths: list[str], kind: str) -> Column:
    """The first of the paths that is there, as the type ``kind``."""
    return F.coalesce(*[F.try_variant_get(document, p, kind) for p in paths])


def nested_columns(documents: DataFrame) -> DataFrame:
    """One row for each column in the documents: ``qualified_name, position, column_name, data_type, nulls``."""
    each = documents.select("qualified_name", F.explode(F.try_variant_get("document", "$.columns", "array<variant>")).alias("c"))
    return each.select("qualified_name", field("c", ["$.position"], "int").alias("position"), field("c", ["$.name"], "string").alias("column_name"),
                       field("c", ["$.dataType", "$.type"], "string").alias("data_type"), field("c", ["$.profile.nulls"], "long").alias("nulls"))


def through_json(documents: DataFrame) -> DataFrame:
    """The documents written as JSON text and parsed again."""
    return documents.select("qualified_name", F.parse_json(F.to_json("document")).alias("document"))


def shape_of(documents: DataFrame) -> DataFrame:
    """``kind, shape``: the schema that all documents of a kind have together."""
    return (documents.groupBy(field("document", ["$.kind"], "string").alias("kind"))
            .agg(F.schema_of_variant_agg("document").alias("shape")))
