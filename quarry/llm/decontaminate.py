"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as words of letters and digits in lower case
with one space between. An item of m characters may differ from a passage in
k = m * ``error_rate`` edits (insert, delete, replace). It is split into k + 1
pieces: in any passage within k edits one piece at least is whole. All pieces
go into one Aho-Corasick automaton; each exact hit gives the place where the item
would lie, and Myers' bit-parallel algorithm computes the item's least edit
distance to the text around that place. Hits of one item on the same place are
verified once.

Items are shipped in blocks of at most ``block_chars`` characters (a proven
bound for what a task holds); a longer benchmark takes more narrow passes over
the documents, never a join. Documents are not shuffled.

Defined results: null texts count as empty; an item without a letter or digit
matches nothing; rows that repeat are judged each; an empty benchmark matches
nothing; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name
from quarry.llm.tokens import texts_of

ERROR_RATE = 0.05
BLOCK_CHARS = 8_000_000
_OTHER = re.compile(r"[\W_]+")


def normalise(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def budget(m: int, error_rate: float) -> int:
    return int(m * error_rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(place, piece): the item cut into k + 1 parts of about equal length."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Myers:
    """Least edit distance of a pattern to any part of a text, one column of
    the table a character, its differences kept as bits of two integers."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.match: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.match[c] = self.match.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end of the first passage with it)."""
        m, get = self.m, self.match.get
        full, top = (1 << m) - 1, 1 << m - 1
        up, down, score, found, end = full, 0, m, m, 0
        for j, c in enumerate(text, 1):
            eq = get(c, 0)
            x = eq | down
            d0 = ((((eq & up) + up) ^ up) | x) & full
            right, left = down | ~(d0 | up) & full, up & d0
            if right & top:
                score += 1
            elif left & top:
                score -= 1
            right, left = right << 1 & full, left << 1 & full  # a passage may start anywhere
            up, down = left | ~(d0 | right) & full, right & d0
            if score < found:
                found, end = score, j
        return found, end


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items: list[tuple[int, str, int, Myers]] = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalise(text)
            if not text:
                continue
            k = budget(len(text), error_rate)
            for at, piece in pieces(text, k):
                where.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, text, k, Myers(text)))
        self.machine = ahocorasick.Automaton()
        for piece, places in where.items():
            self.machine.add_word(piece, (len(piece), places))
        if where:
            self.machine.make_automaton()

    def hits(self, text: str) -> dict[int, tuple[int, int, int]]:
        """By item id: the best (distance, start, end) in normalised ``text``."""
        if not self.items:
            return {}
        places: dict[int, list[int]] = {}
        for last, (n, found) in self.machine.iter(text):
            for i, at in found:
                places.setdefault(i, []).append(last + 1 - n - at)
        out: dict[int, tuple[int, int, int]] = {}
        for i, starts in places.items():
            item_id, item, k, myers = self.items[i]
            m = len(item)
            starts.sort()
            done = None
            for s in starts:
                if done is not None and s - k >= done[0] and s + m + k <= done[1]:
                    continue
                lo, hi = max(0, s - 2 * k), min(len(text), s + m + 2 * k)  # some slack, so that near places share it
                done = (s - 2 * k, s + m + 2 * k)
                if text.startswith(item, max(0, s)):
                    got = (0, max(0, s), max(0, s) + m)
                else:
                    distance, end = myers.best(text[lo:hi])
                    got = (distance, max(lo, lo + end - m - k), lo + end)
                if got[0] <= k and (item_id not in out or got < out[item_id]):
                    out[item_id] = got
                    if got[0] == 0:
                        break
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items, at most ``block_chars`` characters at a time (one longer item alone)."""
    rows = benchmark.select(benchmark[item_col].alias("item"), F.coalesce(benchmark[text_col], F.lit("")).alias("text"))
    block, size = [], 0
    for r in rows.orderBy("item", "text").toLocalIterator():
        if block and size + len(r["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["item"], r["text"]))
        size += len(r["text"])
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id,
    distance, start and end of the passage in the normalised text (a start is
    exact at distance 0, else the earliest possible)."""
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int, start int, end int"
    out = None
    for block in _blocks(benchmark, item_col, item_text, block_chars):
        shipped = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shipped.value, error_rate)
            for b in batches:
                rows = [(d, i, *hit) for d, t in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text")))
                        for i, hit in matcher.hits(normalise(t)).items()]
                cols = list(zip(*rows)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "item_id", "distance", "start", "end"])

        got = slim.mapInArrow(find, schema)
        out = got if out is None else out.unionAll(got)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text: str = "text",
                  error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows whose text holds an item of the benchmark (all columns kept)."""
    source = free_name(docs, "_text")
    for block in _blocks(benchmark, benchmark.columns[0], item_text, block_chars):
        shipped = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shipped.value, error_rate)
            for b in batches:
                at = b.schema.get_field_index(source)
                clean = pa.array([not matcher.hits(normalise(t)) for t in texts_of(b.column(at))], pa.bool_())
                left = [i for i in range(b.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([b.column(i) for i in left],
                                                 names=[b.schema.names[i] for i in left]).filter(clean)

        docs = docs.withColumn(source, docs[text_col]).mapInArrow(keep, docs.schema)
    return docs
