"""Exact dedup by progressive refinement (native: DataFrame functions only).

Rows are grouped by the length of the normalised text, then by a hash of its
prefix, and only rows of groups that still hold more than one row have their
whole text hashed:

1. one scan gives (id, length, prefix hash) for each row, without a full hash;
2. ``groupBy(length)`` and ``groupBy(length, prefix hash)`` - partial sums, so a
   group with a third of all rows leaves each task as one row - give the groups
   that survive;
3. rows of surviving groups are read again, hashed in full (SHA-256) and
   grouped by (length, full hash); the largest id of a group stays.

The surviving keys are broadcast only behind a check of their measured size;
above it the same join shuffles (and Spark splits skewed partitions).

Defined results: null text counts as empty; empty texts are equal to each
other; a null id never beats another id (a group whose ids are all null keeps
them all); rows that repeat both id and text share one verdict, as one
document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower
from quarry.sources.scratch import broadcastable, materialize

PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """The text as compared: A-Z lower-cased, null as empty."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, and the
    ``carry`` expressions, evaluated on the input's columns."""
    carry = carry or {}
    text = normalised(docs[text_col])
    keyed = docs.select(docs[id_col].alias("doc_id"), F.octet_length(text).alias("_len"),
                        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_prefix"),
                        text.alias("_text"), *[c.alias(n) for n, c in carry.items()])

    # lengths, then (length, prefix): keys of one-row groups are settled here
    lengths = keyed.groupBy("_len").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_len")
    pairs = (keyed.groupBy("_len", "_prefix").agg(F.count("*").alias("_rows")).where("_rows > 1")
             .select("_len", "_prefix").join(lengths, "_len", "left_semi"))
    open_groups = materialize(pairs.withColumn("_open", F.lit(True)), "llm/dedup")
    side = F.broadcast(open_groups.frame) if broadcastable(open_groups) else open_groups.frame

    rows = keyed.join(side, ["_len", "_prefix"], "left")
    full = rows.select("doc_id", *carry, "_len",
                       F.when(F.col("_open"), F.sha2(F.col("_text"), 256)).alias("_full"))
    groups = (full.where("_full is not null").groupBy("_len", "_full")
              .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    found = full.join(groups, ["_len", "_full"], "left")
    alone = F.col("_full").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"),
                        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), *carry)
