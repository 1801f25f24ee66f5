"""Column expressions shared by the catalog, lineage and ingest operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults used by the registered queries so results are repeatable.
DEFAULT_RUN_TS = "2024-01-01 00:00:00"
DEFAULT_SOURCE_SYSTEM = "tpch"
DEFAULT_DB = "tpch"
DEFAULT_SCHEMA = "main"
RAW_LAYER = "raw"


def ts_ntz(value: str) -> Column:
    """A constant ``timestamp_ntz`` (wall-clock, no session time zone)."""
    return F.lit(value).cast("timestamp_ntz")


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def qualified_name(layer, db, table=None, column=None) -> Column:
    """One naming scheme for every entity: ``layer.db[.table[.column]]``."""
    parts = [_as_col(layer), _as_col(db)]
    if table is not None:
        parts.append(_as_col(table))
    if column is not None:
        parts.append(_as_col(column))
    return F.concat_ws(".", *parts)


def entity_key(qn: Column) -> Column:
    """Deterministic entity id: SHA-256 of the qualified name, hex."""
    return F.sha2(qn, 256)


def count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")
