"""Session construction and the shared work folder.

Every job that has to cut lineage or persist intermediate state writes under
one shared folder. On a cluster that folder is ``spark.checkpoint.dir`` (else
``quarry.work.dir``); only local sessions without either fall back to a fresh
folder under /tmp, which is what the tests use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

WORK_DIR_CONF = "quarry.work.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "quarry", driver_memory: str = "8g",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way every job in this package expects.

    AQE is on so small shuffle outputs are coalesced and skewed join
    partitions are split at runtime; the broadcast threshold stays at Spark's
    size-checked default so only sides measured below it are broadcast.
    """
    master = master or os.environ.get("QUARRY_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """A plain local master (one JVM): ``local``, ``local[n]``; not ``local-cluster``."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written tables.

    Read from the session: the cluster's ``spark.checkpoint.dir`` first (or
    the folder already given to ``setCheckpointDir``), then
    ``quarry.work.dir``. Only a local session with neither gets a fresh
    folder under /tmp (tests); a cluster session with neither is a
    configuration error, because a machine-local folder would not survive
    executor loss.
    """
    sc = spark.sparkContext
    found = (sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
             or spark.conf.get(WORK_DIR_CONF, None))
    if not found:
        if not _is_local(spark):
            raise RuntimeError(
                "set spark.checkpoint.dir (a shared folder) before running quarry jobs on a cluster")
        found = tempfile.mkdtemp(prefix="quarry-work-", dir="/tmp")
    found = found.rstrip("/")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{found}/checkpoints")
    return found


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared work folder for one job run."""
    return f"{work_dir(spark)}/{purpose}/{uuid.uuid4().hex}"
