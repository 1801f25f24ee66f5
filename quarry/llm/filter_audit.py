"""Filter interaction audit by the Hart-Mas-Colell potential.

Five filters are judged by what they remove in every order. The removal game of a
part of the corpus gives a coalition S of filters the number v(S) of documents that
fail at least one filter in S. All that is asked follows from v on the 32 coalitions:

* an order's step with filter i after the coalition S removes v(S + i) - v(S)
  documents and keeps v({}) minus v(S + i) of all; of those that fail i, the rest
  were removed earlier; the same differences over labelled documents give the
  labelled losses, and v(all) - v(all without i) the documents that fail i alone;
* the potential is P({}) = 0, P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,
  computed coalition by coalition; the Shapley value of i is P(all) - P(all without i).
  Potentials are kept times 120 (the number of orders), where each is a whole number,
  so P(all) - P(all without i) is filter i's removals summed over all orders.

On Spark: one pass over the texts judges the four filters that look at one
document and takes the text's SHA-256; a row leaves it with 5 small columns. The
fifth filter (an identical text has a smaller id, anywhere in the table) needs the
least id of each text, a partial aggregate (a group of copies leaves each task as
one row), and a join on id and digest, in which no group of copies meets. Then
documents are only counted, by part and by the set of filters that they fail: at
most 32 rows a part. The 31 coalition sums, potentials and 600 steps a part are
columns and one explode.

Defined results: null text is empty; null part is the empty string; a label counts if
any row of the id has it; a row with a null id has no labels, is never a copy and makes none;
rows that repeat the smallest id of a text are all first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import utf8, written

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
# The capitals, the symbols of filter D, and the bytes that continue a code point.
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
CONTINUES = bytes(range(0x80, 0xC0))

_ALL = (1 << len(FILTERS)) - 1
_ORDERS = 120


def text_failures(text: bytes) -> int:
    """The filters A to D that UTF-8 text fails, as a bit mask (bytes methods know
    ASCII white space only, as wanted)."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUES))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > MAX_CAPITAL_PERCENT * points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def _judged(docs: DataFrame, id_col: str, part_col: str, text_col: str) -> DataFrame:
    """doc_id, part, mask (filters A to D failed) and digest of each row, written once."""
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                       docs[text_col].alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, digests = np.empty(b.num_rows, dtype=np.int32), []
            for i, text in enumerate(utf8(b.column("text"))):
                masks[i] = text_failures(text)
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(masks), pa.array(digests, pa.binary())],
                                             names=["doc_id", "part", "mask", "digest"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    rows, _ = written(slim.mapInArrow(judge, f"doc_id {kind}, part string, mask int, digest binary"), "filter_audit")
    return rows


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "lang",
                   text_col: str = "text") -> DataFrame:
    """part, mask (the filters a document fails), n, good, toxic: documents and labelled documents."""
    rows = _judged(docs, id_col, part_col, text_col)
    first = (rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    marks = (labels.select(labels["doc_id"].alias("doc_id"), (labels["quality"] == 1).alias("good"), (labels["toxic"] == 1).alias("toxic"))
             .where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (rows.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
            .groupBy("part", F.when(copy, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")))


def _members(coalition: int) -> list[int]:
    return [i for i in range(len(FILTERS)) if coalition >> i & 1]


def removal_games(counts: DataFrame) -> DataFrame:
    """part, n, and three arrays over the 32 coalitions: the documents that fail at
    least one filter of it (``v``), those labelled good (``g``) and toxic (``t``)."""
    def game(of: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(of))), F.lit(0)) for s in range(_ALL + 1)])
    return counts.groupBy("part").agg(F.sum("n").alias("n"), game("n").alias("v"), game("good").alias("g"), game("toxic").alias("t"))


def with_potentials(games: DataFrame) -> DataFrame:
    """``games`` with ``p``: the potential of each coalition times 120, an array built
    coalition by coalition (one without a filter has a smaller number, so it is there)."""
    parts = F.array(*[F.array(*[F.lit(s & ~(1 << i)) for i in _members(s)]) for s in range(1, _ALL + 1)])

    def potential(p: Column, without: Column) -> Column:
        s = F.size(p)
        lower = F.aggregate(without, F.lit(0).cast("long"), lambda total, w: total + F.get(p, w))
        whole = (F.get(F.col("v"), s) * _ORDERS + lower)
        return F.array_append(p, (whole / F.size(without)).cast("long"))  # no remainder

    return games.withColumn("p", F.aggregate(parts, F.array(F.lit(0).cast("long")), potential))


def _steps() -> list[dict]:
    """The 600 steps: order, number, the step's filter and the coalition before it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for k, i in enumerate(order, 1):
            out.append({"filter_order": "".join(FILTERS[j] for j in order), "step": k, "own": 1 << i, "before": before})
            before |= 1 << i
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row for each part, order of the filters and step."""
    games = with_potentials(removal_games(failure_counts(docs, labels, id_col, part_col, text_col)))
    shape = "array<struct<filter_order: string, step: int, own: int, before: int>>"
    steps = games.select("*", F.inline(F.from_json(F.lit(json.dumps(_steps())), shape)))
    steps = steps.withColumn("after", F.col("before").bitwiseOR(F.col("own")))

    def at(game: str, coalition: Column | str) -> Column:
        return F.get(F.col(game), F.col(coalition) if isinstance(coalition, str) else coalition)

    def lost(game: str) -> Column:
        return at(game, "after") - at(game, "before")

    rest = F.lit(_ALL).bitwiseXOR(F.col("own"))
    return steps.select("part", "filter_order", "step", (F.col("n") - at("v", "after")).alias("kept"), lost("v").alias("removed"),
                        (at("v", "own") - lost("v")).alias("redundant"), (at("v", F.lit(_ALL)) - at("v", rest)).alias("unique_fails"),
                        lost("g").alias("good_lost"), lost("t").alias("toxic_lost"),
                        (at("p", F.lit(_ALL)) - at("p", rest)).alias("shapley"))
