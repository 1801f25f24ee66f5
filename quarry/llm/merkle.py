"""Merkle dataset manifest by cogrouped subtree exchange.

Each row is a leaf: the SHA-256 of its fields. The rows of a part (a language, say), in
order of their id, are the leaves of a binary tree whose root is the part's subroot; the
subroots, in order of the part, are the leaves of the tree of the whole dataset.

A tree is cut into superblocks of 2^10 consecutive nodes. Going up, each superblock is
reduced to its root in one task, and the superblocks' roots are the nodes of the next
layer, until a layer is one node: three layers hold 2^30 leaves. Going down, a superblock
needs of the rest of the tree only the siblings on the path from its root to the top,
one short row. Its nodes and that row are cogrouped by superblock in ``applyInPandas``,
where the local tree is built again, each node's siblings inside are joined with those
outside, and (at the leaves) the presented leaf is folded up to a root in the same
call. A group is at most 2^10 rows, whatever the size of a part.

Places in a part come from range partitions and prefix sums over their counts
(quarry.operators.prefix), not from a sort of a part in one task. Texts are read once, hashed
by Spark's own functions; from there on a row is two hashes.

Defined results: a null field is ``-`` and an empty one ``0:``; a null part is a part of its own,
before all others; rows with a null id come first in their part; rows that share an id
are ordered by their leaf (rows equal in all fields have equal leaves, so any order of them
gives the same trees); an empty table gives no rows. A node without a neighbour is hashed alone.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.operators.prefix import with_positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 10
_STEP = 65  # a side (L, R, or - for none) and 64 hex digits


def leaf_hash(values: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields, each with its length in bytes before it."""
    cells = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*cells).cast("binary"), 256)


def _h(*nodes: bytes) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


def local_levels(nodes: list[bytes], total: int, block_levels: int) -> list[list[bytes]]:
    """The levels of one superblock: its nodes, then each level of parents, up to the
    superblock's root or the tree's (``total`` nodes in the whole layer)."""
    levels = [nodes]
    for _ in range(min(block_levels, (total - 1).bit_length())):
        below = levels[-1]
        levels.append([_h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def local_path(levels: list[list[bytes]], i: int) -> list[tuple[bytes, bytes]]:
    """The siblings of node ``i`` inside its superblock, level by level: (side, hex), side - where there is none."""
    out = []
    for level in levels[:-1]:
        at = i ^ 1
        out.append((b"-", b"") if at >= len(level) else (b"R" if at > i else b"L", level[at]))
        i >>= 1
    return out


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for side, sibling in path:
        leaf = _h(sibling, leaf) if side == b"L" else _h(leaf, sibling)
    return leaf


def _packed(path: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(side + sibling.ljust(64, b"0") for side, sibling in path)


def _unpacked(path: bytes) -> list[tuple[bytes, bytes]]:
    steps = [path[i:i + _STEP] for i in range(0, len(path), _STEP)]
    return [(s[:1], b"" if s[:1] == b"-" else s[1:]) for s in steps]


def _hexes(column: pd.Series) -> list[bytes]:
    return [bytes(x).hex().encode() for x in column]


def _up(nodes: DataFrame, block_levels: int) -> DataFrame:
    """The layer above: one row for each superblock."""
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        total = int(pdf["total"].iloc[0])
        top = local_levels(_hexes(pdf["hash"]), total, block_levels)[-1]
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "pos": pdf["block"].iloc[:1], "hash": [bytes.fromhex(top[0].decode())],
                             "total": [-(-total >> block_levels)]})
    return _blocked(nodes.select("tree", "pos", "hash", "total"), block_levels).groupBy("tree", "block").applyInPandas(
        reduce, "tree string, pos long, hash binary, total long")


def _blocked(nodes: DataFrame, block_levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", block_levels))


def layers(nodes: DataFrame, block_levels: int, purpose: str) -> list[DataFrame]:
    """All layers of the trees (tree, pos, hash, total; the lowest may have more
    columns), each written; the last has one node a tree."""
    now, seen = written(nodes, purpose, total=F.max("total"))
    out = [now]
    while (seen["total"] or 0) > 1:
        now, seen = written(_up(out[-1], block_levels), purpose, total=F.max("total"))
        out.append(now)
    return out


def _down(nodes: DataFrame, outer: DataFrame, block_levels: int) -> DataFrame:
    """The outer rows of the layer below: tree, pos, path (all siblings from this node up),
    subroot and root. ``outer`` has the same columns for each superblock's root."""
    def join(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, above = inner.sort_values("pos"), above.iloc[0]
        levels = local_levels(_hexes(inner["hash"]), int(inner["total"].iloc[0]), block_levels)
        outside = bytes(above["path"])
        return pd.DataFrame({"tree": inner["tree"], "pos": inner["pos"], "root": above["root"], "subroot": above["subroot"],
                             "path": [_packed(local_path(levels, i)) + outside for i in range(len(inner))]})
    left = _blocked(nodes.select("tree", "pos", "hash", "total"), block_levels).groupBy("tree", "block")
    right = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(join, "tree string, pos long, root string, subroot string, path binary")


def _proven(leaves: DataFrame, outer: DataFrame, block_levels: int) -> DataFrame:
    """At the leaves: local reduction, proofs joined with the outer siblings, and the fold of the presented leaf."""
    def prove(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, above = inner.sort_values("pos"), above.iloc[0]
        own = _hexes(inner["hash"])
        levels = local_levels(own, int(inner["total"].iloc[0]), block_levels)
        outside = _unpacked(bytes(above["path"]))
        outside_proof = b"".join(sibling for _, sibling in outside)
        proofs, folded = [], []
        for i, shown in enumerate(inner["shown"]):
            inside = local_path(levels, i)
            proofs.append(_h(*[sibling for _, sibling in inside], outside_proof).decode())
            leaf = own[i] if shown is None else bytes(shown).hex().encode()
            folded.append(fold(fold(leaf, inside), outside).decode())
        return pd.DataFrame({"id": inner["id"], "leaf": [x.decode() for x in own], "subroot": above["subroot"], "root": above["root"],
                             "proof_sha256": proofs, "folded_root": folded, "verified": [f == above["root"] for f in folded]})
    left = _blocked(leaves, block_levels).groupBy("tree", "block")
    right = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(
        prove, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", part_col: str = "lang",
             altered: Column | None = None, presented: dict[str, Column] | None = None,
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for each row.

    ``altered`` tells which rows are presented for proof with other values than the
    manifest was made of: those of ``presented`` (field: column) in place of their own."""
    id_type = docs.schema[id_col].dataType
    own = [docs[f] for f in fields]
    shown = [(presented or {}).get(f, docs[f]) for f in fields]
    shown_leaf = F.when(altered, F.unhex(leaf_hash(shown))) if altered is not None else F.lit(None).cast("binary")
    # the null part comes first: its tree's name is empty, all others begin with =
    tree = F.coalesce(F.concat(F.lit("="), docs[part_col].cast("string")), F.lit(""))
    rows, _ = written(docs.select(docs[id_col].alias("id"), tree.alias("tree"), F.unhex(leaf_hash(own)).alias("hash"),
                                  shown_leaf.alias("shown"), F.monotonically_increasing_id().alias("uid")), "merkle/leaves")
    placed = with_positions(rows, ["tree"], ["id", "hash", "uid"], out="pos", size="total", purpose="llm/merkle/placed")
    parts = layers(placed.select("tree", "pos", "hash", "total", F.col("id").cast("string").alias("id"), "shown"), block_levels,
                   "merkle/parts")
    subroots = parts[-1].select("tree", "hash")
    tops = layers(with_positions(subroots, [], ["tree"], out="pos", size="total", purpose="llm/merkle/subroots")
                  .select(F.lit("").alias("tree"), "pos", "hash", "total", F.col("tree").alias("part")), block_levels, "merkle/top")

    outer = tops[-1].select("tree", "pos", F.lower(F.hex("hash")).alias("root"), F.lit("").alias("subroot"),
                            F.unhex(F.lit("")).alias("path"))
    for layer in reversed(tops[:-1]):
        outer = _down(layer, outer, block_levels)
    by_part = (tops[0].select(F.col("part"), "pos", F.lower(F.hex("hash")).alias("sub"))
               .join(outer.select("pos", "root", "path"), "pos"))
    outer, _ = written(by_part.select(F.col("part").alias("tree"), F.lit(0).cast("long").alias("pos"), "root", F.col("sub").alias("subroot"),
                                      "path"), "merkle/outer")
    for layer in reversed(parts[1:-1]):
        outer, _ = written(_down(layer, outer, block_levels), "merkle/outer")
    found = _proven(parts[0], outer, block_levels)
    return found.select(F.col("id").cast(id_type).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
