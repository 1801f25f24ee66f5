"""Raw-layer ingest: audit columns, create-or-append into versioned tables,
batch summary.

Each source table is one distributed write; independent tables are submitted
from a small pool of driver threads so their jobs share the cluster. Errors
are isolated per table and reported in the summary instead of being swallowed.
Record counts come from the commit log (rows counted from the written files),
so the source is scanned exactly once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.names import DEFAULT_SOURCE_SYSTEM, RAW_LAYER, ts_ntz
from quarry.functions.frames import union_all
from quarry.sources.versioned import VersionedTable

AUDIT_COLUMNS = ["_extracted_at", "_source_system", "_layer"]

RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("raw_table", T.StringType(), False),
    T.StructField("snapshot_id", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
])


def with_audit_columns(df: DataFrame, extracted_at: str | None = None,
                       source_system: str = DEFAULT_SOURCE_SYSTEM, layer: str = RAW_LAYER) -> DataFrame:
    """Add the three audit columns. ``extracted_at=None`` stamps the query time."""
    stamp = ts_ntz(extracted_at) if extracted_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({
        "_extracted_at": stamp,
        "_source_system": F.lit(source_system),
        "_layer": F.lit(layer),
    })


def select_with_timestamp(df: DataFrame, columns: list[str], ts_name: str = "created_at",
                          ts_value: str | None = None) -> DataFrame:
    """Projection plus a computed timestamp column (the demo's ``select``)."""
    stamp = ts_ntz(ts_value) if ts_value is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.select(*[F.col(c) for c in columns], stamp.alias(ts_name))


def raw_table_name(table: str) -> str:
    return f"raw_{table}"


def ingest_tables(spark: SparkSession, sources: dict[str, DataFrame], warehouse: str,
                  extracted_at: str | None = None, source_system: str = DEFAULT_SOURCE_SYSTEM,
                  committed_at=None, batch_id: str | None = None, parallelism: int = 8) -> DataFrame:
    """Copy every source into ``raw_<table>`` (create or append).

    Returns one row per table: ``table_name, raw_table, snapshot_id, status, error``.
    """
    def one(item):
        name, df = item
        table = VersionedTable(spark, warehouse, raw_table_name(name))
        try:
            sid = table.create_or_append(with_audit_columns(df, extracted_at, source_system),
                                         committed_at=committed_at, batch_id=batch_id)
            return (name, table.name, sid, "ok", None)
        except Exception as exc:  # isolate the failure to this table
            return (name, table.name, None, "failed", f"{type(exc).__name__}: {exc}")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(one, sources.items()))
    return spark.createDataFrame(results, RESULT_SCHEMA)


def batch_summary(spark: SparkSession, results: DataFrame, warehouse: str) -> DataFrame:
    """Per-table written row counts plus a grand-total row, in one aggregate.

    Counts are read from each raw table's commit log for the snapshot the run
    produced (``records_extracted``); ``tables_ok`` counts successful tables.
    """
    logs = []
    for r in results.select("table_name", "raw_table").collect():  # one row per source table
        logs.append(VersionedTable(spark, warehouse, r["raw_table"]).log()
                    .select(F.lit(r["table_name"]).alias("table_name"), "snapshot_id", "added_rows"))
    written = union_all(logs)
    if written is None:  # no sources: an empty summary
        written = spark.createDataFrame([], "table_name string, snapshot_id long, added_rows long")
    per_table = results.join(written, ["table_name", "snapshot_id"], "left")
    return (per_table.rollup("table_name")
            .agg(F.coalesce(F.sum("added_rows"), F.lit(0)).cast("long").alias("records_extracted"),
                 F.count_if(F.col("status") == "ok").cast("long").alias("tables_ok"))
            .select(F.coalesce("table_name", F.lit("__total__")).alias("table_name"),
                    "records_extracted", "tables_ok"))
