"""Token-id shards with a minimal perfect hash index over the document keys.

Documents are encoded, cut by key ranges into shards and sorted by key. A shard
is one row of a Parquet table (so that any store Spark reaches can hold it):

* ``payload``: the raw ids of its documents one after the other, little-endian
  unsigned 16-bit (32-bit if the vocabulary is larger);
* ``levels``, ``ranks``: the minimal perfect hash over its distinct keys: bit
  arrays by level (a key's bit is set on the first level where no other key
  shares it) with the number of set bits before each word;
* ``slots``: by slot, the key's fingerprint, its first document and number of
  documents; ``ends``: the end of each document in the payload.

A lookup hashes the key on a few levels, checks the stored fingerprint and cuts
the payload: constant time, without reading keys. ``starts`` (a second, small
table) holds the number of ids in all shards before each shard.

The shard of a key comes from key ranges found in one pass over the key column
alone. A shard that gets more than ``PAYLOAD_BYTES`` of ids (long texts), or twice its
documents, is cut into several rows, each a shard of its own with the next number. Rows that repeat one hot key are spread over as many shards as that key
has bounds, so no task gets a group of unbounded size.

Defined results: null text counts as empty (the end id only); null keys sort
last and are looked up as any key; rows that repeat a key are each stored and
all returned; an empty table gives an empty folder of shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import runs, utf8
from quarry.llm.tokens import encoder, slices
from quarry.sources.scratch import broadcastable, materialize

DOCS_PER_SHARD = 4096
MAX_SHARDS = 65_536  # key ranges; a range may be cut into several shards
PAYLOAD_BYTES = 64 << 20
_GAMMA = 2.0
_LEVELS = 40
_NO_KEY = (1 << 63) - 1  # a null key is kept as the last one
SHARD = ("shard long, first_key long, last_key long, docs long, ids long, width int, payload binary, "
         "ends binary, levels binary, ranks binary, sizes binary, slots binary")


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys for one level (multiply, shift, xor)."""
    with np.errstate(over="ignore"):
        h = (keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, words: np.ndarray, ranks: np.ndarray, sizes: np.ndarray):
        self.words, self.ranks, self.sizes = words, ranks, sizes
        self.firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        left, words, sizes = keys.astype(np.uint64), [], []
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("keys repeat")
            bits = max(64, int(np.ceil(_GAMMA * len(left) / 64)) * 64)
            at = (_mix(left, len(sizes)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(bits // 64)
            left = left[~alone[at]]
        flat = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(flat))])[:-1].astype("<u4") if len(flat) else np.zeros(0, "<u4")
        return cls(flat, ranks, np.array(sizes, dtype="<u4"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            bit = (_mix(keys[todo].astype(np.uint64), level) % np.uint64(int(size) * 64)).astype(np.int64)
            word, low = self.firsts[level] + bit // 64, (bit % 64).astype(np.uint64)
            w = self.words[word]
            hit = (w >> low) & np.uint64(1) == 1
            below = np.bitwise_count(w[hit] & ((np.uint64(1) << low[hit]) - np.uint64(1)))
            out[todo[hit]] = self.ranks[word[hit]].astype(np.int64) + below
            todo = todo[~hit]
        return out


def _hashes(keys: np.ndarray) -> np.ndarray:
    """64-bit hashes of keys (one to one: multiply by an odd number, shift, xor)."""
    return _mix(keys.astype(np.int64).view(np.uint64), 97)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.astype(np.int64).view(np.uint64), 13) >> np.uint64(32)).astype("<u4")


def build_shard(shard: int, keys: np.ndarray, ids: list[bytes], width: int) -> dict:
    """One shard of documents sorted by key; ``ids``: raw ids of ``width`` bytes."""
    counts = np.array([len(x) // width for x in ids], dtype=np.int64)
    cuts = runs(keys)
    distinct, first, many = keys[cuts[:-1]], cuts[:-1], np.diff(cuts)
    mph = PerfectHash.build(_hashes(distinct))
    slots = np.zeros(len(distinct), dtype=[("print", "<u4"), ("first", "<u4"), ("many", "<u4")])
    at = mph.slots(_hashes(distinct))
    slots["print"][at], slots["first"][at], slots["many"][at] = _fingerprints(distinct), first, many
    return {"shard": shard, "first_key": int(keys[0]), "last_key": int(keys[-1]), "docs": len(keys),
            "ids": int(counts.sum()), "width": width, "payload": b"".join(ids),
            "ends": np.cumsum(counts).astype("<u8").tobytes(), "levels": mph.words.astype("<u8").tobytes(),
            "ranks": mph.ranks.tobytes(), "sizes": mph.sizes.tobytes(), "slots": slots.tobytes()}


class Shard:
    """Keyed access to one stored shard."""

    def __init__(self, row: dict):
        self.width, self.payload = row["width"], row["payload"]
        self.ends = np.frombuffer(row["ends"], dtype="<u8").astype(np.int64)
        self.mph = PerfectHash(np.frombuffer(row["levels"], "<u8"), np.frombuffer(row["ranks"], "<u4"),
                               np.frombuffer(row["sizes"], "<u4"))
        self.table = np.frombuffer(row["slots"], dtype=[("print", "<u4"), ("first", "<u4"), ("many", "<u4")])

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(position in ``keys``, first id's place in the shard, ids) of each stored document."""
        slots = self.mph.slots(_hashes(keys))
        known = np.flatnonzero(slots >= 0)
        known = known[self.table["print"][slots[known]] == _fingerprints(keys[known])]
        kind = "<u2" if self.width == 2 else "<u4"
        for i in known.tolist():
            _, first, many = self.table[slots[i]]
            for d in range(int(first), int(first) + int(many)):
                lo, hi = int(self.ends[d - 1]) if d else 0, int(self.ends[d])
                yield i, lo, np.frombuffer(self.payload, kind, hi - lo, lo * self.width).astype("<u4")


def _bounds(keys: DataFrame, docs_per_shard: int) -> np.ndarray:
    """Upper keys of all shards but the last, from the key column alone."""
    n = keys.count()
    shards = min(MAX_SHARDS, max(1, -(-n // docs_per_shard)))
    if shards == 1:
        return np.zeros(0, dtype=np.int64)
    share = [i / shards for i in range(1, shards)]
    got = keys.agg(F.percentile_approx("key", share, F.lit(max(10_000, 4 * shards))).alias("q")).first()["q"]
    return np.array(got or [], dtype=np.int64)


def _key(df: DataFrame, id_col: str):
    return F.coalesce(df[id_col].cast("long"), F.lit(_NO_KEY)).alias("key")


def id_width(vocabulary: str, end_id: int) -> int:
    """Bytes of an id: two where all ids of the vocabulary and the end id fit, else four."""
    from tokenizers import Tokenizer
    ids = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True).values()
    return 2 if max(max(ids, default=0), end_id) < 1 << 16 else 4


def write_shards(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", parts: str = "words", width: int | None = None,
                 docs_per_shard: int = DOCS_PER_SHARD, payload_bytes: int = PAYLOAD_BYTES) -> None:
    """Writes ``path``/shards and ``path``/starts in ascending key order."""
    slim = docs.select(_key(docs, id_col), docs[text_col].cast("string").alias("text"))
    bounds = _bounds(docs.select(_key(docs, id_col)), docs_per_shard)
    width = width or id_width(vocabulary, end_id)
    kind = "<u2" if width == 2 else "<u4"
    end = np.array([end_id], dtype=kind).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, parts).encode
        for b in batches:
            texts, keys = utf8(b.column("text")), b.column("key").to_numpy()
            for at, to in slices(texts):
                key = keys[at:to]
                ids = [np.frombuffer(x, "<u4").astype(kind).tobytes() + end for x in enc(texts[at:to])]
                lo, hi = np.searchsorted(bounds, key, "left"), np.searchsorted(bounds, key, "right")
                # a key that is several bounds fills the shards between them in turn
                spread = np.array([xxhash.xxh32_intdigest(x) for x in ids], dtype=np.int64) + np.arange(len(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((lo + spread % (hi - lo + 1)).astype(np.int64)), pa.array(key), pa.array(ids, pa.binary())],
                    names=["shard", "key", "ids"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, keys, ids, held = None, 0, [], [], 0

        def close():
            row = build_shard(now << 32 | part, np.array(keys, dtype=np.int64), ids, width)
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t])
                            for n, t in (x.split() for x in SHARD.split(", "))])
        for b in batches:
            shard = b.column("shard").to_numpy()
            key, raw = b.column("key").to_numpy().tolist(), b.column("ids")
            for i, s in enumerate(shard.tolist()):
                x = raw[i].as_py()
                if keys and (s != now or held + len(x) > payload_bytes or len(keys) == 2 * docs_per_shard):
                    yield close()
                    part = part + 1 if s == now else 0
                    keys, ids, held = [], [], 0
                now = s
                keys.append(key[i])
                ids.append(x)
                held += len(x)
        if keys:
            yield close()

    spark = docs.sparkSession
    encoded = slim.mapInArrow(encode, "shard long, key long, ids binary")
    sorted_ = (encoded.repartitionById(len(bounds) + 1, F.col("shard").cast("int"))
               .sortWithinPartitions("shard", "key"))
    sorted_.mapInArrow(build, SHARD).write.mode("overwrite").parquet(f"{path}/shards")
    # ids before each shard: one row a shard
    sizes = {r["shard"]: r["ids"] for r in spark.read.parquet(f"{path}/shards").select("shard", "ids").collect()}
    start, rows = 0, []
    for s in sorted(sizes):
        rows.append((s, start))
        start += sizes[s]
    (spark.createDataFrame(rows, "shard long, shard_start long").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/starts"))


def read_documents(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian
    unsigned 32-bit) of the documents with the given keys (first column), found
    through the index of each shard whose key range holds the key."""
    shards = spark.read.parquet(f"{path}/shards")
    starts = spark.read.parquet(f"{path}/starts")
    ranges = shards.select("shard", "first_key", "last_key").join(starts, "shard")
    wanted = keys.select(_key(keys, keys.columns[0])).distinct()
    limits = [(r["first_key"], r["last_key"], r["shard"]) for r in ranges.select("first_key", "last_key", "shard").collect()]
    limits.sort(key=lambda r: r[2])  # one row a shard
    first, last = (np.array([r[i] for r in limits], dtype=np.int64) for i in (0, 1))
    number = np.array([r[2] for r in limits], dtype=np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("key").to_numpy()
            lo, hi = np.searchsorted(last, key, "left"), np.searchsorted(first, key, "right")
            many = np.maximum(hi - lo, 0)
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(number[at] if len(at) else at.astype(np.int64)),
                                              pa.array(np.repeat(key, many))], names=["shard", "key"])

    asked = wanted.mapInArrow(assign, "shard long, key long").groupBy("shard").agg(F.collect_list("key").alias("keys"))
    # the keys go to the shards if their measured size allows, else both are shuffled
    keys_by_shard = materialize(asked, "llm/token_files")
    side = F.broadcast(keys_by_shard.frame) if broadcastable(keys_by_shard) else keys_by_shard.frame
    rows = shards.join(side, "shard").join(starts, "shard")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                key = np.array(row["keys"], dtype=np.int64)
                got = [(int(key[i]), row["shard_start"] + lo, ids.tobytes()) for i, lo, ids in Shard(row).find(key)]
                for at in range(0, len(got), 1024):
                    k, s, x = zip(*got[at:at + 1024])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if v == _NO_KEY else v for v in k], pa.int64()), pa.array(s, pa.int64()),
                         pa.array(x, pa.binary())], names=["doc_id", "start", "ids"])

    return rows.mapInArrow(find, "doc_id long, start long, ids binary")
