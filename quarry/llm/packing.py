"""Packing of token sequences: vector bin packing by the dot-product heuristic.

Each document is its ids and an end id. Documents of more than a sequence give
whole sequences first; the tails are items with three sizes: tokens, one
segment, and loss-bearing tokens (those from ``loss_from`` on: the answers of
instruction data; all tokens of plain text). A sequence is filled by choosing,
again and again, the item that fits under all three limits and whose size
vector has the largest dot product with what is left of the sequence. When no
item fits whole, one is cut so that its head fills what is left; the rest stays
an item. Only a task's last sequences can so end short.

Tasks pack on their own, a window of ``window`` items at a time, so memory is
bounded and no shuffle is needed; a lost task packs the same rows again to the
same sequence ids (task number and counter).

Defined results: null text counts as empty (one piece: the end id); a null id
gives pieces with a null id; rows that repeat are packed each; an empty table
gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back, utf8
from quarry.llm.tokens import encoder, slices

SEQUENCE_TOKENS = 1024
MAX_SEGMENTS = 64
WINDOW = 2048
SCHEMA = ("doc_id long, start long, length long, ids binary, loss_tokens long, doc_tokens long, "
          "sequence_id long, offset long")


class Packer:
    """Packs items (doc_id, ids, first id's place in the document, loss_from,
    document's tokens) into sequences; ``done`` collects finished pieces."""

    def __init__(self, first_id: int, tokens: int, segments: int, loss: int):
        self.limits = np.array([tokens, segments, loss], dtype=np.int64)
        self.next_id = first_id
        self.items: list[tuple] = []
        self.done: list[tuple] = []

    @staticmethod
    def _loss(start: int, length: int, loss_from: int) -> int:
        return max(0, start + length - max(start, loss_from))

    def add(self, doc_id, ids: bytes, loss_from: int) -> None:
        """Cuts off whole sequences; the tail becomes an item."""
        total, at = len(ids) // 4, 0
        tokens, _, loss = (int(x) for x in self.limits)
        while total - at >= tokens or self._loss(at, total - at, loss_from) > loss:
            n = min(tokens, total - at)
            if self._loss(at, n, loss_from) > loss:  # as many as the loss limit lets through
                n = max(at, loss_from) - at + loss
            self._close([(doc_id, ids[4 * at:4 * (at + n)], at, loss_from, total)])
            at += n
        if at < total:
            self.items.append((doc_id, ids[4 * at:], at, loss_from, total))

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, ids, start, loss_from, total in pieces:
            n = len(ids) // 4
            self.done.append((doc_id, start, n, ids, self._loss(start, n, loss_from), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def pack(self, final: bool) -> None:
        """Fills sequences while items are left; before the end, only while they suffice."""
        items = self.items
        sizes = np.array([(len(i[1]) // 4, 1, self._loss(i[2], len(i[1]) // 4, i[3])) for i in items],
                         dtype=np.int64).reshape(-1, 3)
        open_ = np.ones(len(items), dtype=bool)
        share = sizes / self.limits
        left_tokens = int(sizes[:, 0].sum())
        while open_.any() and (final or left_tokens >= len(items) // 4 * 64 and open_.sum() > 256):
            rest, pieces = self.limits.copy(), []
            while rest[0] > 0 and rest[1] > 0:
                fits = np.flatnonzero(open_ & (sizes <= rest).all(axis=1))
                if len(fits):
                    pick = int(fits[np.argmax(share[fits] @ (rest / self.limits))])
                    pieces.append(items[pick])
                    open_[pick] = False
                    rest -= sizes[pick]
                    left_tokens -= int(sizes[pick, 0])
                    continue
                # none fits whole: the head of the item with the fewest loss tokens a token fills the rest
                many = np.flatnonzero(open_)
                if not len(many):
                    break
                pick = int(many[np.argmax(sizes[many, 0])])
                doc_id, ids, start, loss_from, total = items[pick]
                n = int(min(rest[0], sizes[pick, 0]))
                if self._loss(start, n, loss_from) > rest[2]:
                    n = max(0, loss_from - start) + int(rest[2])
                if n <= 0:
                    break
                pieces.append((doc_id, ids[:4 * n], start, loss_from, total))
                items[pick] = (doc_id, ids[4 * n:], start + n, loss_from, total)
                rest -= (n, 1, self._loss(start, n, loss_from))
                left_tokens -= n
                m = len(items[pick][1]) // 4
                sizes[pick] = (m, 1, self._loss(start + n, m, loss_from))
                share[pick] = sizes[pick] / self.limits
                open_[pick] = m > 0
            self._close(pieces)
        self.items = [i for i, o in zip(items, open_) if o]


def pack(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         loss_from: str | None = None, parts: str = "spaces", tokens: int = SEQUENCE_TOKENS,
         segments: int = MAX_SEGMENTS, loss_tokens: int | None = None, window: int = WINDOW) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian
    unsigned 32-bit), loss_tokens, doc_tokens, sequence_id, offset.
    ``loss_from`` names a column with the first loss-bearing token's place."""
    limit = tokens if loss_tokens is None else loss_tokens
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       (F.coalesce(docs[loss_from], F.lit(0)) if loss_from else F.lit(0)).cast("long").alias("loss"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(packer: Packer) -> Iterator[pa.RecordBatch]:
        done, packer.done = packer.done, []
        for at in range(0, len(done), 5000):
            cols = list(zip(*done[at:at + 5000]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "start", "length", "ids", "loss_tokens", "doc_tokens",
                                                    "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, tokens, segments, limit)
        encode = encoder(path, parts).encode
        for b in batches:
            keys, loss = b.column("doc_id").to_pylist(), b.column("loss").to_pylist()
            text = utf8(b.column("text"))
            for at, to in slices(text):
                for k, ids, f in zip(keys[at:to], encode(text[at:to]), loss[at:to]):
                    packer.add(k, ids + end, f)
                    if len(packer.items) >= window:
                        packer.pack(final=False)
                if packer.done:
                    yield from rows(packer)
        packer.pack(final=True)
        yield from rows(packer)
        give_back()

    return slim.mapInArrow(run, SCHEMA)
