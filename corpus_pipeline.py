"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the session's shared folder and reads back as the next
stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, line_dedup, packing, quality, simhash
from quarry.llm.common import ship, table
from quarry.llm.tokens import vocabulary
from quarry.session import fresh_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (op 9) rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like an earlier line are cut out of the texts (op 5)."""
    ship(spark)
    return line_dedup.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (op 4)."""
    ship(spark)
    return simhash.near_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go (op 1)."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences (op 10)."""
    ship(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_deduplication),
          ("simhash_near_dedup", simhash_near_dedup), ("benchmark_decontamination", benchmark_decontamination),
          ("packing", sequence_packing)]

# The trained classifier, the tokenizer and the packing heuristic have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"llm/pipeline/{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
