"""SimHash near-dedup with BK-trees.

Each text gets a 64-bit fingerprint: over the XXH64 (seed 42) hashes of its
word shingles (repeats included), a bit is 1 if it is set in more than half of
them. Texts whose fingerprints differ in at most ``max_bits`` bits are linked,
and linked texts form components.

Links are searched among the distinct fingerprints only, so a group of copies
is one fingerprint. The 64 bits are cut into six blocks; two fingerprints that
differ in two bits or fewer agree on at least four whole blocks, so they meet
in one of 15 shards (choice of four blocks, their value). A shard holds at most
2^22 fingerprints by construction, whatever the data. Shards are dealt out by
a shuffle and sorted; the task that holds a shard keeps its BK-tree (children
keyed by the integer Hamming distance to the parent) and looks each
fingerprint up in it, following only the edges within the radius. The tree
travels to its queries by the shuffle rather than by a broadcast, as trees
over all fingerprints must not pass through the driver. A shard gives one row
for each linked fingerprint (to its root in the shard), not all pairs.
Components over the shards' links follow (components.py).

Defined results: null text counts as empty; a text with fewer words than a
shingle counts as one shingle; no word at all gives fingerprint zero, linked
like any other; a null id is never a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name, runs, utf8, written
from quarry.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
_CHUNK = 1 << 16


def _masks(max_bits: int, blocks: int = 6) -> list[int]:
    """One mask for each choice of ``max_bits`` blocks that may differ."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    everything = (1 << 64) - 1
    return [everything ^ sum(chosen) for chosen in combinations(parts, max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of UTF-8 text, A-Z lower-cased (bytes
    methods know ASCII letters and white space only, as wanted)."""
    words = text.lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        end = min(n, at + _CHUNK)
        parts = [words[at + i:end + i] for i in range(k)]
        h = np.fromiter((digest(b" ".join(s), SEED) for s in zip(*parts)), dtype=np.uint64, count=end - at)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text_col: str, out_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with a long column: the fingerprint's 64 bits as a signed integer."""
    source = free_name(docs, "_text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(source)
            prints = np.array([fingerprint(t, shingle_words) for t in utf8(b.column(at))], dtype=np.uint64)
            kept = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in kept] + [pa.array(prints.view(np.int64))],
                                             names=[b.schema.names[i] for i in kept] + [out_col])

    wide = docs.withColumn(source, docs[text_col])
    schema = docs.withColumn(out_col, F.lit(0).cast("long")).schema
    return wide.mapInArrow(add, schema)


class BKTree:
    """Integers by Hamming distance; a node's children are keyed by their distance to it."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            here, children = todo.pop()
            d = (here ^ value).bit_count()
            if d <= radius:
                found.append(here)
            if children:
                todo.extend(children[e] for e in range(max(1, d - radius), d + radius + 1) if e in children)
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, root) for the linked values of one shard."""
    tree, parent = BKTree(), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for v in values:
        parent[v] = v
        for near in tree.within(v, radius):
            a, b = root(v), root(near)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(v)
    return [(v, r) for v in values if (r := root(v)) != v]


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints (long column ``fp``)
    as all pairs within ``max_bits`` would."""
    masks = _masks(max_bits)
    shards = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
                                 for i, m in enumerate(masks)]))
    dealt = (prints.select("fp", shards.alias("s")).select("s.choice", "s.part", "fp")
             .repartition("choice", "part").sortWithinPartitions("choice", "part", "fp"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_values = None, []

        def close():
            if len(open_values) > 1:
                return shard_links(open_values, max_bits)
            return []

        for b in batches:
            choice, part = b.column("choice").to_numpy(), b.column("part").to_numpy()
            value = b.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            cuts = runs(choice, part)
            out: list[tuple[int, int]] = []
            sizes = np.diff(cuts)
            # only runs of two or more, and the two at the batch's ends, need a look
            todo = sorted(set(np.flatnonzero(sizes > 1).tolist()) | ({0, len(sizes) - 1} if len(sizes) else set()))
            for r in todo:
                lo, hi = cuts[r], cuts[r + 1]
                here = (choice[lo], part[lo])
                if here != key:
                    out += close()
                    key, open_values = here, []
                open_values += value[lo:hi].tolist()
            u = np.array([x[0] for x in out], dtype=np.uint64).view(np.int64)
            v = np.array([x[1] for x in out], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        out = close()
        u = np.array([x[0] for x in out], dtype=np.uint64).view(np.int64)
        v = np.array([x[1] for x in out], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.mapInArrow(search, "u long, v long")


def fingerprint_components(rows: DataFrame, fp_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the fingerprints that have a link to another one."""
    distinct = rows.select(F.col(fp_col).alias("fp")).distinct()
    found = connected_components(fingerprint_links(distinct, max_bits))
    return found.select(F.col("node").alias("fp"), F.col("component").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long), component_id (smallest id reachable) for each row."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows, _ = written(with_fingerprints(slim, "text", "fp", shingle_words).drop("text"), "simhash")
    roots = fingerprint_components(rows, "fp", max_bits)
    # least id of each fingerprint, then of each component: partial sums, no hot group
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp", "left")
    least = least.withColumn("root", F.coalesce("root", "fp"))
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = least.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(by_print, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without all but one row of each component: the row with the
    smallest id stays (nulls last; of rows that repeat the id, one stays)."""
    fp, uid = free_name(docs, "_fp"), free_name(docs, "_uid")
    # written once with a row number, so that a row has a stable name even if its id is null or repeats
    rows, _ = written(with_fingerprints(docs, text_col, fp, shingle_words)
                      .withColumn(uid, F.monotonically_increasing_id()), "simhash")
    slim = rows.select(F.col(fp).alias("fp"), F.col(id_col).alias("id"), F.col(uid).alias("uid"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uid"))).alias("first")
    least = slim.groupBy("fp").agg(first).join(fingerprint_components(slim, "fp", max_bits), "fp", "left")
    stay = (least.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
            .select(F.col("first.uid").alias(uid)))
    return rows.join(stay, uid, "left_semi").select(*docs.columns)
