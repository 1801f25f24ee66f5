"""N-gram Jaccard join over size-banded tiles with hashed bitmap signatures.

A document is the set of its word 5-grams (A-Z lower-cased, white space between the
words; a text with fewer words is one gram, one without words is empty and linked with
nothing). Two documents are linked if 100 x intersection >= 80 x union; linked
documents form classes.

1. One pass over the texts counts the grams in 2^18 hashed counters (a bounded broadcast): any
   order of the grams gives the same result, rare grams first give short tiles.
2. A second pass gives each document its size n, a 128-bit digest of its set, the first
   n - ceil(0.8 n) + 1 grams in that order (linked sets share one of them), and a
   bitmap of 4 to 8 n bits with one bit set for each gram. Equal sets are one from here on.
3. A tile is a gram with the sets that have it in front. Sets of a tile are compared only
   within their size band (sizes within 0.8) and where enough grams follow (positions).
   A tile of at most 32 sets gives its pairs at once; the same pair from many tiles is one.
   A longer tile stays a tile, and a gram with far more sets than others is dealt out in several.
4. Bitmaps bound what is left: with d bits set in one and not in the other, at least d grams are
   missing, so the overlap is at most n - d. Pairs whose bound is too small go.
5. First, each set has the pair verified that can be most alike, and in long tiles the earliest set
   that it meets most, and the set that it most often stands next to when tiles are ordered by a minimum hash.
   Verified pairs join components, so groups of thousands of near copies do not become a square of pairs.
6. Then only pairs of different components are left. The best of each two components are
   verified, then, with the components that result, all others; long tiles with sets of several
   components are compared all with all, by bitmaps, in blocks. No pair is left out but those within a
   component, which add nothing to the classes.
7. To verify, the texts of the sets in question are read again and their sorted arrays of grams intersected.

Grams are compared by 64-bit hashes within a pair (two sets of 10^4 grams meet by accident
with odds of 10^-11), whole sets across the corpus by 128 bits.

Defined results: null text is empty; component_id is the smallest id reachable, a null id
only if no other is; rows with a null id or a repeated one are judged like any other row;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import runs, utf8, written
from quarry.llm.components import connected_components
from quarry.llm.line_dedup import _hashes
from quarry.sources.scratch import broadcastable, materialize

WORDS = 5
PERCENT = 80
COUNTERS = 1 << 18
RUN = 1 << 15  # rows of a tile that is not dealt out
_SHORT = 32  # sets of a tile that gives its pairs at once
_BLOCK = 1 << 13  # sets compared all with all, where components are several
_PIECE = 2 << 20  # bytes of text hashed at once
_PAIRS = 1 << 17  # pairs compared at once
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Odd multipliers of the hash mixes.
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k words in a row."""
    n = len(words) - k + 1
    h = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        h = _mixed(h * _ODD[0] + words[j:j + n])
    return h


def gram_sets(texts: list[bytes], k: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct gram hashes (unsigned 64-bit) of each text."""
    data = b" " + b" ".join(texts).lower() + b" " * 9
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        words = _hashes(data, start, end - start)
        whole = _grams(words, k) if len(words) >= k else np.zeros(0, dtype=np.uint64)
        cuts = np.searchsorted(start, np.cumsum([1] + [len(t) + 1 for t in texts]))
        out = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = whole[lo:hi - k + 1] if hi - lo >= k else _grams(words[lo:hi], hi - lo) if hi > lo else whole[:0]
            own = np.sort(own)
            out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def _sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """``gram_sets`` of any number of texts, a bounded piece at a time."""
    lo, held = 0, 0
    for i, text in enumerate(texts):
        if i > lo and held + len(text) > _PIECE:
            yield from gram_sets(texts[lo:i], k)
            lo, held = i, 0
        held += len(text)
    yield from gram_sets(texts[lo:], k) if lo < len(texts) else ()


def digest_of(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def least_overlap(total, percent: int):
    """The least intersection of two linked sets of ``total`` grams together (numbers or arrays)."""
    return -(-percent * total // (100 + percent))


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def bitmap(grams: np.ndarray) -> bytes:
    """One bit a gram, of the power of two from 4 n to 8 n (64 at least)."""
    width = max(64, 1 << (4 * len(grams) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(grams & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _gram_counts(texts: DataFrame, k: int) -> np.ndarray:
    """How many sets have a gram of each counter, over all documents (at most COUNTERS rows to the driver)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for b in batches:
            for grams in _sets(utf8(b.column("text")), k):
                np.add.at(total, _slot(grams), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["slot", "n"])

    rows = texts.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table, out = rows.toArrow(), np.zeros(COUNTERS, dtype=np.int64)
    out[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return out


_SIGNED = "doc_id {kind}, n long, digest binary, prefix array<long>, tiles array<int>, bits binary, mins long"


def _signed(texts: DataFrame, counts, kind: str, k: int, percent: int, run: int) -> DataFrame:
    """One row a document: size, digest, and what step 2 says (null for a set that the batch
    has met before). ``tiles``: into how many each prefix gram's sets are dealt, null if into one."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = counts.value
        usual = float(seen.mean())
        dealt = np.where(seen > np.maximum(run, 8 * usual), -(-seen // run), 1).astype(np.int32)
        for b in batches:
            rows, met = [], set()
            for grams in _sets(utf8(b.column("text")), k):
                n, digest = len(grams), digest_of(grams)
                if not n or digest in met:
                    rows.append((n, digest, None, None, None, None))
                    continue
                met.add(digest)
                slot = _slot(grams)
                count = seen[slot]
                p = prefix_length(n, percent)
                cut = np.partition(count, p - 1)[p - 1]
                few = np.flatnonzero(count <= cut)  # sorted by hash; then by count, hashes break ties
                few = few[np.argsort(count[few], kind="stable")][:p]
                tiles = dealt[slot[few]]
                least = np.array([(grams * odd).min() for odd in _ODD[:4]])
                mins = sum(m << 16 * i for i, m in enumerate((_mixed(least) >> np.uint64(48)).tolist()))
                rows.append((n, digest, grams[few].view(np.int64), tiles if (tiles > 1).any() else None, bitmap(grams),
                             mins - (1 << 64) if mins >> 63 else mins))
            n, digest, prefix, tiles, bits, mins = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(tiles, pa.list_(pa.int32())), pa.array(bits, pa.binary()), pa.array(mins, pa.int64())],
                names=["doc_id", "n", "digest", "prefix", "tiles", "bits", "mins"])
    return texts.mapInArrow(sign, _SIGNED.format(kind=kind))


_TILED = "gram long, sid long, n long, pos int, prev long, hub long, other long"


def _tiles(sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of short tiles (sid, other: sizes and positions allow a link) and the rows of long ones:
    gram, set, its size and the gram's place in it, the set's neighbour (``prev``) and the tile's
    earliest set (``hub``), where those can be linked with it."""
    exploded = sets.select("sid", "n", "mins", "tiles", F.posexplode("prefix").alias("pos", "gram"))
    rows = exploded.select(
        "gram", F.expr("CAST(pmod(xxhash64(sid), coalesce(get(tiles, pos), 1)) AS INT)").alias("tile"),
        F.expr("CAST(shiftright(mins, CAST(16 * (gram & 3) AS INT)) & 65535 AS INT)").alias("mark"), "sid", "n", "pos",
        F.expr("coalesce(get(tiles, pos), 1) > 1").alias("dealt"))
    laid = rows.repartition("gram", "tile").sortWithinPartitions("gram", "tile", "mark", "sid")
    names = ["gram", "tile", "sid", "n", "pos", "dealt"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cut = {c: np.zeros(0, dtype=np.int64) for c in names}, None  # the last run, not yet ended

        def allowed(a, b, r):
            """Whether the sets at ``a`` and ``b`` can be linked, by sizes and positions."""
            n, after = r["n"], r["n"] - r["pos"]
            size = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
            return size & (np.minimum(after[a], after[b]) >= least_overlap(n[a] + n[b], percent)) & (r["sid"][a] != r["sid"][b])

        def pairs(r, at, of) -> pa.RecordBatch:
            """The pairs of the rows ``at``, whose runs are ``of``."""
            found = [np.zeros((2, 0), dtype=np.int64)]
            for d in range(1, _SHORT):
                a, b = at[:-d], at[d:]
                same = of[:-d] == of[d:]
                if not same.any():
                    break
                a, b = a[same], b[same]
                good = allowed(a, b, r)
                one, two = r["sid"][a[good]], r["sid"][b[good]]
                found.append(np.stack([np.minimum(one, two), np.maximum(one, two)]))
            a, b = np.concatenate(found, axis=1)
            order = np.lexsort((b, a))
            order = order[runs(a[order], b[order])[:-1]]
            none = pa.nulls(len(order), pa.int64())
            return pa.RecordBatch.from_arrays([none, pa.array(a[order]), none, none.cast(pa.int32()), none, none, pa.array(b[order])],
                                              names=["gram", "sid", "n", "pos", "prev", "hub", "other"])

        def made(r) -> Iterator[pa.RecordBatch]:
            total = len(r["gram"])
            if not total:
                return
            cuts = runs(r["gram"], r["tile"])
            size = np.diff(cuts)
            of = np.repeat(np.arange(len(size)), size)
            dealt = np.logical_or.reduceat(r["dealt"] > 0, cuts[:-1])
            short = np.flatnonzero(((size > 1) & (size <= _SHORT) & ~dealt)[of])
            if len(short):
                yield pairs(r, short, of[short])
            wide = np.flatnonzero(((size > _SHORT) | dealt)[of])
            if not len(wide):
                return
            sid = r["sid"]
            least = np.minimum.reduceat(sid, cuts[:-1])
            at_least = np.flatnonzero(sid == least[of])
            hub = at_least[np.searchsorted(of[at_least], of[wide])]
            before = np.maximum(wide - 1, 0)
            near = (wide > cuts[:-1][of[wide]]) & allowed(wide, before, r)
            star = allowed(wide, hub, r)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["gram"][wide]), pa.array(sid[wide]), pa.array(r["n"][wide]), pa.array(r["pos"][wide].astype(np.int32)),
                 pa.array(sid[before], mask=~near), pa.array(sid[hub], mask=~star), pa.nulls(len(wide), pa.int64())],
                names=["gram", "sid", "n", "pos", "prev", "hub", "other"])

        for b in batches:
            r = {c: np.concatenate([held[c], b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)]) for c in names}
            if not len(r["gram"]):
                continue
            if cut is not None:  # the rest of a run that was too long to hold is long, whatever its rows
                r["dealt"][(r["gram"] == cut[0]) & (r["tile"] == cut[1])] = 1
            last, cut = int(runs(r["gram"], r["tile"])[-2]), None
            if len(r["gram"]) - last > RUN:
                last, cut = len(r["gram"]), (r["gram"][-1], r["tile"][-1])
            held = {c: v[last:] for c, v in r.items()}
            yield from made({c: v[:last] for c, v in r.items()})
        yield from made(held)
    return laid.mapInArrow(keep, _TILED)


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a link, with ``bound``: thousandths of the similarity that they can reach."""
    both = (pairs.join(sets.select(F.col("sid").alias("a"), F.col("n").alias("n"), F.col("bits").alias("one")), "a")
            .join(sets.select(F.col("sid").alias("b"), F.col("n").alias("m"), F.col("bits").alias("two")), "b")
            .select("a", "b", "n", "m", "one", "two"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            n, m = r.column("n").to_numpy(), r.column("m").to_numpy()
            over = np.zeros(len(n), dtype=np.int64)
            one, two = r.column("one").to_pylist(), r.column("two").to_pylist()
            words = np.array([min(len(x), len(y)) // 8 for x, y in zip(one, two)], dtype=np.int64)
            for w in np.unique(words).tolist():
                of = np.flatnonzero(words == w)
                step = max(1, 8 * _PAIRS // w)
                for at in (of[p:p + step] for p in range(0, len(of), step)):
                    over[at] = _most(_folded([one[i] for i in at], w), _folded([two[i] for i in at], w), n[at], m[at])
            good = over >= least_overlap(n + m, percent)
            reach = 1000 * over[good] // (n + m - over)[good]
            yield pa.RecordBatch.from_arrays([r.column("a").filter(pa.array(good)), r.column("b").filter(pa.array(good)), pa.array(reach)],
                                             names=["a", "b", "bound"])
    return both.mapInArrow(bound, "a long, b long, bound long")


def _most(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The largest overlap that the bitmaps of sets of n and m grams allow."""
    return np.minimum(n - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64), m - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))


def _intersections(pairs: DataFrame, percent: int) -> DataFrame:
    """The linked pairs (a, b) of rows a, b, one, two (the sorted arrays)."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for one, two in zip(b.column("one"), b.column("two")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (one, two))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(large, small)
                same = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                good.append(same >= least_overlap(len(x) + len(y), percent))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])
    return pairs.mapInArrow(verify, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The linked ones of the candidate pairs (a, b), verified by the sets' texts."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    need = materialize(asked.join(sets.select("sid", "digest", F.col("doc_id").alias("of")), "sid"), "llm/ngram/asked")
    side = F.broadcast(need.frame) if broadcastable(need) else need.frame
    found = texts.join(side, texts["doc_id"].eqNullSafe(side["of"])).select("sid", "digest", "text")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, digest, out = b.column("sid").to_pylist(), b.column("digest").to_pylist(), []
            for i, grams in enumerate(_sets(utf8(b.column("text")), k)):
                if digest_of(grams) == digest[i]:  # another row may have the id of the set's document
                    out.append((sid[i], grams.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())],
                                             names=["sid", "grams"])
    got, _ = written(found.mapInArrow(arrays, "sid long, grams binary").dropDuplicates(["sid"]), "ngram/sets")
    both = (pairs.join(got.select(F.col("sid").alias("b"), F.col("grams").alias("two")), "b")
            .join(got.select(F.col("sid").alias("a"), F.col("grams").alias("one")), "a"))
    links, _ = written(_intersections(both, percent), "ngram/links")
    return links


def _first_pairs(tiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each set the pair of short tiles that can be most alike, and the hub and the neighbour that it meets in
    most long tiles."""
    met = tiles.where("gram IS NOT NULL").select("sid", F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("hub").alias("other")),
        F.struct(F.lit(1).alias("kind"), F.col("prev").alias("other"))))).where("other IS NOT NULL")
    times = met.groupBy("sid", "kind", "other").agg(F.count(F.lit(1)).alias("weight"))
    short = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("sid"), F.lit(2).alias("kind"), F.col("b").alias("other"), F.col("bound").alias("weight")),
                                          F.struct(F.col("b").alias("sid"), F.lit(2).alias("kind"), F.col("a").alias("other"), F.col("bound").alias("weight")))))
    best = (times.unionByName(short).groupBy("sid", "kind")
            .agg(F.max(F.struct("weight", (-F.col("other")).alias("other"))).alias("best")))
    other = -F.col("best.other")
    return best.select(F.least("sid", other).alias("a"), F.greatest("sid", other).alias("b")).distinct()


def _folded(bits: list[bytes], words: int) -> np.ndarray:
    """The bitmaps as rows of ``words`` 64-bit words; longer ones are folded (their halves put together)."""
    out = np.empty((len(bits), words), dtype=np.uint64)
    for i, raw in enumerate(bits):
        row = np.frombuffer(raw, dtype=np.uint64)
        while len(row) > words:
            row = row[:len(row) // 2] | row[len(row) // 2:]
        out[i] = row
    return out


def _passing(r: dict, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, bound) of the pairs of a tile's rows, in order of size, from different components, that sizes,
    positions and bitmaps let pass; ``bound``: thousandths of the similarity that they can reach."""
    n, comp, side = r["n"], r["comp"], r["side"]
    after = n - r["pos"]
    width = np.array([len(x) // 8 for x in r["bits"]])
    maps, place = {}, {}  # sets of one band are at most a factor of two apart in width
    for w in np.unique(width).tolist():
        at = np.flatnonzero((width == w) | (width == 2 * w))
        maps[w] = _folded([r["bits"][i] for i in at], w)
        place[w] = np.zeros(len(n), dtype=np.int64)
        place[w][at] = np.arange(len(at))

    reach = np.searchsorted(n, n * 100 // percent, side="right")  # in order of size: the end of the band
    total = len(n)
    lo = 0
    while lo < total:
        hi = lo + 1
        while hi < total and (hi - lo) * (int(reach[hi]) - lo) < 4 * _PAIRS:
            hi += 1
        x, y = np.arange(lo, hi), np.arange(lo + 1, int(reach[hi - 1]))
        lo = hi
        if not len(y):
            continue
        ok = (y[None, :] > x[:, None]) & (y[None, :] < reach[x][:, None]) & (comp[x][:, None] != comp[y][None, :])
        ok &= (side[x][:, None] != side[y][None, :]) | (side[x][:, None] == 2)
        need = least_overlap(n[x][:, None] + n[y][None, :], percent)
        ok &= np.minimum(after[x][:, None], after[y][None, :]) >= need
        i, j = np.nonzero(ok)
        i, j = x[i], y[j]
        w = np.minimum(width[i], width[j])
        for words in np.unique(w).tolist():
            of = np.flatnonzero(w == words)
            step = max(1, 8 * _PAIRS // words)
            for part in (of[p:p + step] for p in range(0, len(of), step)):
                a, b = (maps[words][place[words][v[part]]] for v in (i, j))
                over = _most(a, b, n[i[part]], n[j[part]])
                both = n[i[part]] + n[j[part]]
                good = over >= least_overlap(both, percent)
                yield i[part][good], j[part][good], 1000 * over[good] // (both - over)[good]


def _open_pairs(tiles: DataFrame, sets: DataFrame, comps: DataFrame, percent: int, best: bool) -> DataFrame | None:
    """The candidate pairs (a, b, one and two: their components, bound) between different components in the long tiles that have
    several; with ``best``, one a task for each two components (the one that can be most alike). None where no tile has several."""
    slim = (tiles.where("gram IS NOT NULL").select("gram", "sid", "n", "pos").join(comps, "sid", "left")
            .withColumn("comp", F.coalesce("comp", "sid")))
    mixed = (slim.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows"))
             .where("lo <> hi").select("gram", F.ceil(F.col("rows") / _BLOCK).cast("int").alias("blocks")))
    asked, seen = written(slim.join(mixed, "gram"), "ngram/open")
    if not seen["rows"]:
        return None
    own = F.expr("CAST(pmod(xxhash64(sid), blocks) AS INT)")  # a long tile is dealt in blocks, each two of which meet
    cells = (asked.join(sets.select("sid", "bits"), "sid").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("gram", (F.least("own", "other") * F.col("blocks").cast("long") + F.greatest("own", "other")).alias("cell"),
                     F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"),
                     "sid", "n", "pos", "comp", "bits"))
    laid = cells.repartition("gram", "cell").sortWithinPartitions("gram", "cell", "n", "sid")
    numbers = ["side", "sid", "n", "pos", "comp"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_run(r) -> Iterator[pa.RecordBatch]:
            if len(r["n"]) < 2 or not (r["comp"] != r["comp"][0]).any():
                return
            for x, y, bound in _passing(r, percent):
                cols = [np.minimum(r["sid"][x], r["sid"][y]), np.maximum(r["sid"][x], r["sid"][y]),
                        np.minimum(r["comp"][x], r["comp"][y]), np.maximum(r["comp"][x], r["comp"][y]), bound]
                if best and len(bound):  # one for each two components
                    order = np.lexsort((-bound, cols[3], cols[2]))
                    order = order[runs(cols[2][order], cols[3][order])[:-1]]
                    cols = [c[order] for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "b", "one", "two", "bound"])

        held, key = [], None
        for b in batches:
            gram, cell = b.column("gram").to_numpy(), b.column("cell").to_numpy()
            cuts = runs(gram, cell)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if key != (gram[lo], cell[lo]):
                    yield from of_run(_joined(held, numbers))
                    held, key = [], (gram[lo], cell[lo])
                held.append(b.slice(lo, hi - lo))
        yield from of_run(_joined(held, numbers))

    return laid.mapInArrow(compare, "a long, b long, one long, two long, bound long")


def _joined(parts: list[pa.RecordBatch], numbers: list[str]) -> dict:
    if not parts:
        return {"n": ()}
    r = {c: np.concatenate([p.column(c).to_numpy().astype(np.int64) for p in parts]) for c in numbers}
    return r | {"bits": [v for p in parts for v in p.column("bits").to_pylist()]}


def _between(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs of different components, with the components (one, two)."""
    def of(side: str) -> DataFrame:
        return comps.select(F.col("sid").alias(side), F.col("comp").alias(f"of_{side}"))
    joined = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    x, y = F.coalesce("of_a", "a"), F.coalesce("of_b", "b")
    return joined.where(x != y).select("a", "b", F.least(x, y).alias("one"), F.greatest(x, y).alias("two"), "bound")


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links).select(F.col("node").alias("sid"), F.col("component").alias("comp"))


def _joined_components(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after ``links`` between them (a set without a component is its own)."""
    now = _components(links)
    moved = comps.join(now.select(F.col("sid").alias("comp"), F.col("comp").alias("into")), "comp", "left")
    return moved.select("sid", F.coalesce("into", "comp").alias("comp")).union(now).distinct()


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                 run: int = RUN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sets, links): doc_id, n, digest of each document; sid, digest, doc_id (the least) and comp of each
    distinct set; verified links (a, b) between sets, which connect what all links connect."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    counts = texts.sparkSession.sparkContext.broadcast(_gram_counts(texts, words))
    signed = _signed(texts, counts, kind, words, percent, run).withColumn("uid", F.monotonically_increasing_id())
    rows, _ = written(signed, "ngram/signed")
    counts.unpersist()
    # the first row of a set has its signature: a batch leaves it out of later rows only
    firsts = rows.where("n > 0").groupBy("digest").agg(F.min("uid").alias("uid"), F.min("doc_id").alias("least"))
    sets, _ = written(rows.drop("doc_id", "digest").join(firsts, "uid")
                      .select(F.col("uid").alias("sid"), "n", "digest", F.col("least").alias("doc_id"), "prefix", "tiles", "bits", "mins"),
                      "ngram/distinct")
    tiles, _ = written(_tiles(sets, percent), "ngram/tiles")
    short = tiles.where("other IS NOT NULL").select(F.col("sid").alias("a"), F.col("other").alias("b")).distinct()
    short, _ = written(_bounded(short, sets, percent), "ngram/short")
    tried, _ = written(_first_pairs(tiles, short), "ngram/pairs")
    links = _verified(tried, sets, texts, words, percent)
    comps = _components(links)
    for best in (True, False):
        pairs = _between(short, comps)
        long = _open_pairs(tiles, sets, comps, percent, best)
        pairs = pairs if long is None else pairs.unionByName(long)
        left = pairs.join(tried, ["a", "b"], "left_anti")
        if best:
            left = left.groupBy("one", "two").agg(F.max(F.struct("bound", "a", "b")).alias("best")).select("best.a", "best.b", "one", "two")
        left, seen = written(left.select("a", "b", "one", "two").distinct(), "ngram/pairs")
        if not seen["rows"]:
            break
        tried = tried.union(left.select("a", "b"))
        found = _verified(left.select("a", "b"), sets, texts, words, percent)
        links = links.union(found)
        comps = _joined_components(comps, found.join(left, ["a", "b"]).select("one", "two"))
    return rows.select("doc_id", "n", "digest"), sets.select("sid", "digest", "doc_id").join(comps, "sid", "left"), links


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                       run: int = RUN) -> DataFrame:
    """doc_id, n_shingles and component_id of each row."""
    rows, sets, _ = similar_sets(docs, id_col, text_col, words, percent, run)
    classed = sets.withColumn("comp", F.coalesce("comp", "sid"))
    least = classed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    members = classed.join(least, "comp").select("digest", "component_id")
    single = F.col("n") == 0  # the empty set is linked with nothing
    return (rows.withColumn("digest", F.when(~single, F.col("digest"))).join(members, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(single, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
