"""Versioned tables on plain Parquet: create, append, time travel, history, files.

Layout under ``<root>/<name>/``::

    schema/                     empty Parquet dataset carrying the declared schema
    data/_snapshot_id=N/*.parquet   rows added by snapshot N
    snapshots/*.parquet         append-only commit log, one small file per commit

A commit writes its data folder first (overwriting leftovers of a failed
attempt with the same id), counting the rows as they are written (an
``observe`` on the write job, no second scan), and only then appends the log
row. Readers see only snapshot ids present in the log,
so a half-written append is invisible and a retried job simply rewrites it.
Snapshot ids are 1, 2, 3, ... in commit order; reading version ``v`` is the
partition filter ``_snapshot_id <= v``, which Spark prunes at planning time.
One writer per table is assumed.

Executor loss: the data write goes through Spark's file commit protocol, so
a lost task is re-run and only committed task output becomes visible; the
row-count observation sits in the write's result stage, where Spark applies
each task's update exactly once, so retried tasks are not counted twice. A
failed job leaves no log row, and re-running it with the same batch id
rewrites the snapshot folder.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_COL = "_snapshot_id"

LOG_SCHEMA = T.StructType([
    T.StructField("snapshot_id", T.LongType(), False),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("committed_at", T.TimestampNTZType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("added_rows", T.LongType(), False),
    T.StructField("schema_json", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), True),
])


class TableNotFound(Exception):
    pass


class TableExists(Exception):
    pass


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (any scheme)."""
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))
    except AttributeError:  # no JVM gateway (Spark Connect): probe with a read
        try:
            spark.read.parquet(path).schema
            return True
        except AnalysisException:
            return False


class VersionNotFound(Exception):
    """The commit log has no such version."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.name = name
        self.path = f"{root.rstrip('/')}/{name}"
        self.schema_path = f"{self.path}/schema"
        self.data_path = f"{self.path}/data"
        self.log_path = f"{self.path}/snapshots"
        # What this handle has read or written itself (single writer per table):
        # saves a Spark job per metadata lookup.
        self._schema: T.StructType | None = None
        self._log_cache: list | None = None

    # ------------------------------------------------------------------ state
    def exists(self) -> bool:
        if self._schema is not None:
            return True
        if not path_exists(self.spark, self.schema_path):
            return False
        self._schema = self.spark.read.parquet(self.schema_path).schema
        return True

    def schema(self) -> T.StructType:
        if not self.exists():
            raise TableNotFound(self.name)
        return self._schema

    def log(self) -> DataFrame:
        """The commit log as a DataFrame (empty if nothing was committed)."""
        if not path_exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def _log_rows(self):
        # One row per commit: bounded by the number of commits, not by data.
        if self._log_cache is None:
            self._log_cache = [(r["snapshot_id"], r["batch_id"])
                               for r in self.log().select("snapshot_id", "batch_id").collect()]
        return [{"snapshot_id": a, "batch_id": b} for a, b in self._log_cache]

    def refresh(self) -> None:
        """Forget cached state (another writer may have committed)."""
        self._schema, self._log_cache = None, None

    def current_snapshot_id(self) -> int | None:
        return max((r["snapshot_id"] for r in self._log_rows()), default=None)

    # ----------------------------------------------------------------- writes
    def create_if_not_exists(self, schema: T.StructType) -> bool:
        """Declare the table; creates no snapshot. Returns True if created."""
        if self.exists():
            return False
        self.spark.createDataFrame([], schema).write.mode("errorifexists").parquet(self.schema_path)
        self._schema = schema
        self._log_cache = []
        return True

    def create(self, df: DataFrame, committed_at=None, batch_id: str | None = None) -> int:
        if self.exists():
            raise TableExists(self.name)
        self.create_if_not_exists(df.schema)
        return self._commit(df, "create", committed_at, batch_id)

    def append(self, df: DataFrame, committed_at=None, batch_id: str | None = None) -> int:
        if not self.exists():
            raise TableNotFound(self.name)
        return self._commit(df, "append", committed_at, batch_id)

    def create_or_append(self, df: DataFrame, committed_at=None, batch_id: str | None = None) -> int:
        """``exists ? append : create``; an append error propagates to the caller."""
        if self.exists():
            return self.append(df, committed_at, batch_id)
        return self.create(df, committed_at, batch_id)

    def _conform(self, df: DataFrame) -> DataFrame:
        target = self.schema()
        names = [f.name for f in target.fields]
        missing = [n for n in names if n not in df.columns]
        extra = [c for c in df.columns if c not in names]
        if missing or extra:
            raise ValueError(f"{self.name}: schema mismatch, missing={missing} extra={extra}")
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])

    def _commit(self, df: DataFrame, operation: str, committed_at, batch_id) -> int:
        self.refresh()  # another handle may have committed: its snapshot must not be written over
        rows = self._log_rows()
        if batch_id is not None:
            for r in rows:
                if r["batch_id"] == batch_id:
                    return r["snapshot_id"]  # already committed: idempotent re-run
        parent = max((r["snapshot_id"] for r in rows), default=None)
        sid = 1 if parent is None else parent + 1
        folder = f"{self.data_path}/{SNAPSHOT_COL}={sid}"
        data = self._conform(df)
        # rows are counted as they are written, in the same job (no second scan)
        written = Observation(f"commit_{self.name}_{sid}")
        data.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
        added = int(written.get["rows"])
        entry = (sid, parent, committed_at or _now(), operation, added, data.schema.json(), batch_id)
        self.spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.log_path)
        self._log_cache = (self._log_cache or []) + [(sid, batch_id)]
        return sid

    def append_batches(self, df: DataFrame, batch_col: str, committed_at_for=None,
                       run_id: str | None = None) -> list[int]:
        """One snapshot per distinct ``batch_col`` value, ascending, written in one job.

        Backfills (e.g. one snapshot per year) scan the source once: rows get
        their snapshot id from a broadcast of the small value->id map and are
        written with dynamic partition overwrite, so only the new snapshot
        folders are touched. The log rows for all batches land in one file.
        Each value's batch id is ``run_id:batch_col=value`` (``run_id``: the
        column's name by default), so running the same backfill again writes
        nothing; more rows for the same values need another ``run_id``. Only
        the values reach the driver, one for each folder that is written (a
        batch column is a coarse grain such as a day or a year, never a key).
        A null value is a batch of its own; ``committed_at_for`` is not asked
        for it.
        """
        self.refresh()
        done = {r["batch_id"]: r["snapshot_id"] for r in self._log_rows() if r["batch_id"] is not None} if self.exists() else {}
        batch_ids = {r[0]: f"{run_id or batch_col}:{batch_col}={r[0]}"
                     for r in df.select(batch_col).distinct().orderBy(batch_col).collect()}
        values = [v for v, b in batch_ids.items() if b not in done]
        if not values:
            return [done[b] for b in batch_ids.values()]
        first_op = "append" if self.exists() else "create"
        self.create_if_not_exists(df.drop(batch_col).schema)
        parent = max((r["snapshot_id"] for r in self._log_rows()), default=None)
        base = 0 if parent is None else parent
        ids = {v: base + i + 1 for i, v in enumerate(values)}
        mapping = self.spark.createDataFrame([(v, s) for v, s in ids.items()],
                                             f"_batch {df.schema[batch_col].dataType.simpleString()}, {SNAPSHOT_COL} long")
        # null-safe: rows whose batch value is null get that value's snapshot instead of vanishing
        body = df.join(F.broadcast(mapping), df[batch_col].eqNullSafe(mapping["_batch"])).drop(batch_col, "_batch")
        schema = self.schema()
        body = body.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], SNAPSHOT_COL)
        # a batch's rows come together (AQE splits a large one), not in a file for each task and batch
        (body.hint("rebalance", SNAPSHOT_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(SNAPSHOT_COL).parquet(self.data_path))
        full = T.StructType(schema.fields + [T.StructField(SNAPSHOT_COL, T.LongType(), True)])
        counts = {r[SNAPSHOT_COL]: r["n"] for r in
                  self.spark.read.schema(full).option("basePath", self.data_path).parquet(self.data_path)
                  .where(F.col(SNAPSHOT_COL) > base).groupBy(SNAPSHOT_COL)
                  .agg(F.count(F.lit(1)).alias("n")).collect()}
        entries, prev = [], parent
        for v, sid in ids.items():
            when = committed_at_for(v) if committed_at_for and v is not None else _now()
            entries.append((sid, prev, when, first_op if sid == base + 1 else "append",
                            int(counts.get(sid, 0)), schema.json(), batch_ids[v]))
            prev = sid
        self.spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.log_path)
        self._log_cache = (self._log_cache or []) + [(e[0], e[-1]) for e in entries]
        return [ids[v] if v in ids else done[b] for v, b in batch_ids.items()]

    # ------------------------------------------------------------------ reads
    def read(self, version: int | None = None) -> DataFrame:
        """Rows visible at ``version`` (default: the latest committed snapshot):
        those of the logged snapshots up to it. Folders that no log row names
        (half-written appends) are never read; an unknown version is an error."""
        schema = self.schema()
        full = T.StructType(schema.fields + [T.StructField(SNAPSHOT_COL, T.LongType(), True)])
        upto = self.current_snapshot_id() if version is None else version
        if upto is None:
            return self.spark.createDataFrame([], full)
        logged = {r["snapshot_id"] for r in self._log_rows()}
        if upto not in logged:
            self.refresh()
            logged = {r["snapshot_id"] for r in self._log_rows()}
            if upto not in logged:
                raise VersionNotFound(f"{self.name}: version {upto}")
        ids = sorted(i for i in logged if i <= upto)
        col = F.col(SNAPSHOT_COL)
        # ids without gaps are a range, which prunes folders however long the log is
        seen = col.between(ids[0], ids[-1]) if len(ids) == ids[-1] - ids[0] + 1 else col.isin(ids)
        return (self.spark.read.schema(full).option("basePath", self.data_path)
                .parquet(self.data_path).where(seen))

    def snapshots(self) -> DataFrame:
        return self.log().select("committed_at", "snapshot_id", "parent_id", "operation",
                                 "added_rows", "batch_id")

    def history(self) -> DataFrame:
        """One row per snapshot with the running row total before and after it."""
        w = Window.orderBy("snapshot_id")
        return (self.log()
                .withColumn("total_rows", F.sum("added_rows").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("previous_total_rows", F.coalesce(F.lag("total_rows").over(w), F.lit(0)))
                .select(F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id",
                        "operation", "added_rows", "previous_total_rows", "total_rows"))

    def count_at(self, version: int | None = None) -> DataFrame:
        """Row count at a version from the log alone (no data scan)."""
        log = self.log()
        if version is not None:
            log = log.where(F.col("snapshot_id") <= version)
        return log.agg(F.coalesce(F.sum("added_rows"), F.lit(0)).cast("long").alias("row_count"))

    def files(self, version: int | None = None) -> DataFrame:
        """Data files visible at a version with their size and row count."""
        return (self.read(version)
                .select(SNAPSHOT_COL, F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_size").alias("file_size_in_bytes"))
                .groupBy(SNAPSHOT_COL, "file_path", "file_size_in_bytes")
                .agg(F.count(F.lit(1)).alias("record_count")))

    def declared_schema_json(self) -> str:
        return json.dumps(json.loads(self.schema().json()))
