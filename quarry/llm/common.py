"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.session import fresh_dir

# A-Z to a-z only, as the contracts ask.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets the executors' Python import this package, once an application:
    Spark serves a small archive of its sources to them."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="quarry-sources-"), "quarry_sources.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "quarry")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (any store that Spark reads)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def written(df: DataFrame, purpose: str, **sums: Column) -> tuple[DataFrame, dict]:
    """``df`` written as Parquet to the session's shared folder and read back
    (lineage cut that survives lost executors), with its row count and the
    named aggregates, all from the one write job."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm/{purpose}")
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in sums.items()])
     .write.mode("overwrite").parquet(path))
    return spark.read.schema(df.schema).parquet(path), dict(seen.get)


def give_back() -> None:
    """Memory that a task no longer uses goes back to the system: Spark keeps the
    worker for later tasks, whose stages it would otherwise burden."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def runs(*keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal keys in sorted arrays, with the end appended."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)
