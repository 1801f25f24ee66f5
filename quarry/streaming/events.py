"""Incremental raw-layer ingest with Structured Streaming.

The scheduled re-run of an ingest (new rows appended each run) becomes a file
stream: every micro-batch is appended to a versioned raw table through
``foreachBatch``. The commit's batch id is the streaming query's id (kept in its
checkpoint) with the micro-batch id, so a batch that is replayed after a
failure (same checkpoint) is not committed twice, while another stream into
the same table, or one that starts with a new checkpoint, has ids of its own.
The streaming checkpoint lives in the shared work folder like every other state.
"""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.operators.ingest import with_audit_columns
from quarry.sources.versioned import VersionedTable


def stream_source(spark: SparkSession, path: str, schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of one table, stored as a folder of files or as one file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    reader = spark.readStream.schema(schema)
    if not folder:  # file streams read folders: the parent, only this file
        reader = reader.option("pathGlobFilter", at.getName())
        path = at.getParent().toString()
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def append_stream(stream: DataFrame, table: VersionedTable, checkpoint: str, extracted_at=None,
                  source_system: str = "tpch", available_now: bool = True):
    """Start a query that appends each micro-batch (with audit columns) to ``table``.

    Returns the started ``StreamingQuery``; with ``available_now`` it processes
    what is there and stops.
    """
    started, query = Event(), []

    def commit(batch: DataFrame, epoch_id: int) -> None:
        started.wait()  # the query's id is known once it has started
        table.create_or_append(with_audit_columns(batch, extracted_at, source_system),
                               batch_id=f"{query[0].id}-epoch-{epoch_id}")

    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query.append(writer.start())
    started.set()
    return query[0]


def run_to_completion(query, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query, however long it takes; with
    ``timeout_s`` stop it and fail if it takes longer. Errors of the query
    itself are raised by ``awaitTermination``."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.id} did not finish within {timeout_s} s")
