"""Written intermediate tables in the shared work folder.

``materialize`` writes a frame as Parquet under the session's work folder
(``spark.checkpoint.dir`` on a cluster) and reads it back: the lineage is cut,
the result survives executor loss, and a frame that later plans reference
several times is computed once. The same write job measures the rows and
the in-memory bytes, which is what the size-checked broadcasts use.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import fresh_dir

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_VAR_WIDTH = (T.StringType, T.BinaryType)


class Materialized(NamedTuple):
    frame: DataFrame
    rows: int
    bytes: int


def _row_bytes(df: DataFrame):
    """Per-row size as Spark holds it in memory (UnsafeRow): an 8-byte header,
    8 bytes per field, plus the variable-length payload of string / binary
    fields rounded up to 8 bytes. Nested fields (arrays, maps, structs) are
    measured by the length of their JSON text, which bounds their payload."""
    def padded(length):
        return F.coalesce(F.ceil(length / 8) * 8, F.lit(0))
    size = F.lit(8 + 8 * len(df.schema.fields))
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _VAR_WIDTH):
            size = size + padded(F.octet_length(c))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + padded(F.octet_length(F.to_json(c)))
    return size


def materialize(df: DataFrame, purpose: str = "rounds", measure_bytes: bool = True) -> Materialized:
    """The frame read back from a written table, with its measured rows and
    in-memory bytes, all from one write job. ``measure_bytes=False`` skips the
    per-row size (bytes is then -1, which is never broadcastable).

    Unlike ``checkpoint(eager=True)``, which runs the plan once to count and
    again to write, the write computes the plan once and the observation
    measures its rows on the way out.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    seen = Observation()
    size = F.sum(_row_bytes(df)) if measure_bytes else F.lit(-1)
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), size.alias("bytes"))
     .write.mode("overwrite").parquet(path))
    got = seen.get
    return Materialized(spark.read.schema(df.schema).parquet(path), int(got["rows"]), int(got["bytes"] or 0))


MAX_ROWS_CONF = "quarry.broadcast.maxRows"
MAX_BYTES_CONF = "quarry.broadcast.maxBytes"


def broadcastable(m: Materialized, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when a measured side is small enough to ship to every executor.

    The session can lower or raise the defaults (``quarry.broadcast.maxRows``,
    ``quarry.broadcast.maxBytes``); a session that disables broadcast joins
    (``spark.sql.autoBroadcastJoinThreshold = -1``) gets none from here either.
    """
    if m.bytes < 0:  # not measured
        return False
    conf = m.frame.sparkSession.conf
    if str(conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip() == "-1":
        return False
    if broadcast_rows == DEFAULT_BROADCAST_ROWS:
        broadcast_rows = int(conf.get(MAX_ROWS_CONF, str(broadcast_rows)))
    if broadcast_bytes == DEFAULT_BROADCAST_BYTES:
        broadcast_bytes = int(conf.get(MAX_BYTES_CONF, str(broadcast_bytes)))
    return m.rows <= broadcast_rows and m.bytes <= broadcast_bytes
