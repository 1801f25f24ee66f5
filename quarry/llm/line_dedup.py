"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased, white space between); two lines
are alike if the Jaccard similarity of their sets is ``THRESHOLD`` or more. A line
is removed if any earlier line (by document id, then line number) is like it.

Lines with equal sets (by a 64-bit hash) meet first, those of the same 500 texts
already before the shuffle: all but the first are removed, and only the first, the
lead, goes on. What is like any line of an equal set is like its lead, which is the earliest.

The join: a lead's words are ordered by rarity, and only its prefix (the first
n - ceil(0.8 n) + 1 of n words) is sent to the other tasks, one row a word; like
lines share a prefix word. Where two lines meet on a word, the length filter (sizes
within 0.8), the positional filter (the words left after this place must be
enough) and a bitmap filter (the set bits that differ bound the words that
differ) drop pairs before their words are compared. A word with more than ``RUN``
leads is dealt in blocks of them: each two blocks meet in a run of their own.

Rarity comes from the counts of all words in 2^18 hashed counters (a bounded
broadcast): any order gives the same result, rare words first give short runs. A word
has no more leads than its counter has words, so few are counted to find those with blocks.

Groups of thousands of near copies would make a square of pairs. So a line
first takes the ``NEAREST`` candidates of each run (least bitmap difference),
which are verified by their words. Only lines that no such pair settles, and
that have more candidates, go into a second pass over the runs of their words,
with all their candidates: the result is the same as with all pairs. Words are compared by the lines'
text, fetched for the lines in question.

Defined results: null text has no lines; lines without a word are kept and never
compared; rows with a null id, and those after the first of a repeated id, come
after all others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name, runs, utf8, written
from quarry.sources.scratch import Materialized, broadcastable, materialize

THRESHOLD = 0.8
NEAREST = 2
COUNTERS = 1 << 18
RUN = 1 << 16
_BLOCK = 512
_SMALL = 128
_OUT = 200_000  # rows of a batch, about
_IN = 1 << 16  # rows that are met at once, at least
_CHUNK = 1 << 14  # counters of one row


def words_of(line: bytes) -> list[bytes]:
    return line.lower().split()


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the first n of 8 bytes
_LONG = 64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _hashes(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``data`` (which goes on for 8 bytes after
    the last one), eight bytes a step for all words at once; words over
    ``_LONG`` bytes one by one."""
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = _mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(size <= _LONG)
    for done in range(0, _LONG, 8):
        at = at[size[at] > done]
        if not len(at):
            break
        h[at] = _mix(h[at] ^ (eight[start[at] + done] & _MASK[np.minimum(size[at] - done, 8)]))
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + size[i]])
    return h


def _parts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a column by pieces of at most 500 rows and about 2 MB, each
    with the number of its first row."""
    texts = utf8(column)
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and (i - first == 500 or held + len(text) > 2 << 20):
            yield first, texts[first:i]
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, line number) of each line with words and (line, word hash) of
    each word, repeats included, in order of the texts; lines count through."""
    data = b"\n" + b"\n".join(texts).lower() + b"\n" * 9
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    newline = np.flatnonzero(raw == 10)
    upto = np.searchsorted(start, newline)  # words before each line break
    words = np.diff(upto)
    used = np.flatnonzero(words)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])  # the line break before each text
    top = np.searchsorted(newline, begin)
    doc = np.searchsorted(top, used, side="right") - 1
    return doc, used - top[doc], np.repeat(np.arange(len(used)), words[used]), _hashes(data, start, end - start)


def _ranked(line: np.ndarray, rank: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The order by line, rank and hash, by one sort on a packed key (``line`` is
    in order already); by all three where the packed keys leave ties open."""
    h = (h << np.uint64(40)) | (h >> np.uint64(24))  # the rank follows from the first bits: the others tell words apart
    key = (line.astype(np.uint64) << np.uint64(42)) | (rank.astype(np.uint64) << np.uint64(24)) | (h >> np.uint64(40))
    order = np.argsort(key)
    key, sorted_h = key[order], h[order]
    if len(key) and (int(line[-1]) >= 1 << 22 or bool(((key[1:] == key[:-1]) & (sorted_h[1:] != sorted_h[:-1])).any())):
        return np.lexsort((h, rank, line))
    return order


def _prefix(n: np.ndarray, threshold: float) -> np.ndarray:
    """Length of the prefix of a set of n words."""
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def _least_overlap(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9).astype(np.int64)


def _counter(word: np.ndarray) -> np.ndarray:
    """The counter of a word, from the first 32 bits of its hash."""
    return (word.view(np.uint32) // np.uint32((1 << 32) // COUNTERS)).astype(np.int64)


def _first_bits(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32)


def _counters(slim: DataFrame) -> np.ndarray:
    """How often the words of each counter occur, over all lines. A task's counters, and
    their sums, go in rows of ``_CHUNK`` counters."""
    def pieces(of: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(of), pa.int32()), pa.array([n.tobytes() for n in of.values()], pa.binary())],
                                          names=["chunk", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype="<i8")
        for b in batches:
            for _, texts in _parts(b.column("text")):
                _, _, _, h = _flat(texts)
                total += np.bincount(_counter(_first_bits(h)), minlength=COUNTERS)
        cut = total.reshape(-1, _CHUNK)
        yield pieces({i: cut[i] for i in np.flatnonzero(cut.any(axis=1)).tolist()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, n in zip(b.column("chunk").to_pylist(), b.column("n").to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(n, "<i8")
        yield pieces(total)

    out = np.zeros((COUNTERS // _CHUNK, _CHUNK), dtype=np.int64)
    rows = slim.select("text").mapInArrow(count, "chunk int, n binary").repartition("chunk").mapInArrow(add, "chunk int, n binary")
    for i, n in zip(*rows.toArrow().to_pydict().values()):  # COUNTERS // _CHUNK rows at most
        out[i] = np.frombuffer(n, "<i8")
    return out.reshape(-1)


def _ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each counter by how often its words occur; rare first."""
    rank = np.empty(COUNTERS, dtype=np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(COUNTERS)
    return rank


def _first_of_each(line: np.ndarray, word: np.ndarray) -> np.ndarray | slice:
    """The rows that are the first of their line and word."""
    key = (line.astype(np.uint64) << np.uint64(32)) | word
    ordered = np.sort(key)
    if not (ordered[1:] == ordered[:-1]).any():
        return slice(None)
    return np.sort(np.unique(key, return_index=True)[1])


_SETS = "doc long, line int, low long, high long, same long, size int, words array<int>, gone boolean"


def _sets(slim: DataFrame, counters, threshold: float) -> DataFrame:
    """One row for each line with words: its place in the order (doc, line), 128-bit
    bitmap, set hash and size, and the words of its prefix (32 bits of each hash: where two
    words share them, their lines meet for nothing; none in lines so short that only equal sets
    are alike). ``gone``: an equal line of the same piece of texts comes before it (no words, and a
    hash of its place for the set's)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = counters.value
        for b in batches:
            ids = b.column("doc").to_numpy()
            for at, texts in _parts(b.column("text")):
                key = ids[at:at + len(texts)]
                doc, number, line, h = _flat(texts)
                if not len(h):
                    continue
                order = _ranked(line, rank[_counter(_first_bits(h))], h)
                line, h = line[order], h[order]
                new = runs(line, h)[:-1]  # repeats of a word go
                line, h = line[new], h[new]
                first = runs(line)
                size = np.diff(first)
                place = np.arange(len(h)) - first[:-1][line]
                # the set's hash and its bitmap (a word turns one of 128 bits over): sums and xors over the line
                with np.errstate(over="ignore"):
                    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    same = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), first[:-1]) * np.uint64(2 * 0x632BE59BD9B4E019 + 1 & (1 << 64) - 1)
                bit = (h >> np.uint64(40)) & np.uint64(127)
                one = np.uint64(1) << (bit & np.uint64(63))
                low = np.bitwise_xor.reduceat(np.where(bit < 64, one, np.uint64(0)), first[:-1])
                high = np.bitwise_xor.reduceat(np.where(bit >= 64, one, np.uint64(0)), first[:-1])
                doc = key[doc]
                order = np.lexsort((number, doc, same))
                gone = np.ones(len(size), dtype=bool)
                gone[order[runs(same[order])[:-1]]] = False
                same = np.where(gone, _spread(doc, number), same)
                # below this size one more word is too many: only equal sets are alike
                met = ~gone & (size + 1e-9 >= threshold / (1 - threshold))
                keep = (place < _prefix(size, threshold)[line]) & met[line]
                ends = np.cumsum(np.bincount(line[keep], minlength=len(size)))
                words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                                 pa.array(_first_bits(h[keep]).view(np.int32)))
                cols = [pa.array(c) for c in (doc, number.astype(np.int32), low.view(np.int64), high.view(np.int64), same.view(np.int64),
                                              size.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*cols, words, pa.array(gone)],
                                                 names=["doc", "line", "low", "high", "same", "size", "words", "gone"])
    return slim.mapInArrow(sets, _SETS)


def _spread(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A hash of a line's place."""
    with np.errstate(over="ignore"):
        return _mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + line.astype(np.uint64))


def _led(sets: DataFrame) -> DataFrame:
    """``sets`` with ``lead``: true for the first line of each set; the others have an equal earlier line."""
    names = ["doc", "line", "low", "high", "size", "words", "lead"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            same = b.column("same").to_numpy()
            lead = np.append(last is None or same[0] != last, same[1:] != same[:-1])
            lead &= ~b.column("gone").to_numpy(zero_copy_only=False)  # these come after all others
            last = same[-1]
            for good in (True, False):
                part = b.filter(pa.array(lead == good))
                cols = [part.column(c) for c in names[:5]]
                words = part.column("words") if good else pa.nulls(part.num_rows, b.column("words").type)
                yield pa.RecordBatch.from_arrays([*cols, words, pa.array(np.full(part.num_rows, good))], names=names)

    dealt = sets.repartition("same").sortWithinPartitions("gone", "same", "doc", "line")
    return dealt.mapInArrow(mark, "doc long, line int, low long, high long, size int, words array<int>, lead boolean")


def _blocks_of(leads: DataFrame, run: int, counts: np.ndarray | None = None):
    """The words with more than ``run`` leads, in order, and the number of blocks of each, as a
    broadcast (at most one word for every ``run`` rows of the index). A word has no more leads than
    its counter has words (``counts``): those of smaller counters are not counted."""
    sc = leads.sparkSession.sparkContext
    words = leads.select("words")
    if counts is not None:
        if not (counts > run).any():
            return sc.broadcast((np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)))
        large = sc.broadcast(counts > run)

        def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                word = b.column("words").flatten().to_numpy()
                word = word[large.value[_counter(word)]]
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.int32())], names=["word"])

        words = words.mapInArrow(often, "word int")
    else:
        words = words.select(F.explode("words").alias("word"))
    table = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") > run).orderBy("word").toArrow()
    many = -(-table.column("n").to_numpy() // run)
    return sc.broadcast((table.column("word").to_numpy(), many))


_INDEX = "word int, cell int, side byte, doc long, low long, high long, line int, size int, place int"


def _index(leads: DataFrame, blocks) -> DataFrame:
    """One row for each prefix word of each lead (one for two words that share their 32
    bits, at the smaller place): the word, the lead, and the word's place. Where a word has blocks, a
    lead goes to the cell of its block and each block: ``side`` tells the two blocks of a cell
    apart, 2 where all its rows meet."""
    names = ["word", "cell", "side", "doc", "low", "high", "line", "size", "place"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, many = blocks.value
        for b in batches:
            counts = np.diff(b.column("words").offsets.to_numpy())
            ends = np.cumsum(counts)
            lo = 0
            while lo < len(counts):  # at most _OUT words, or one line
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _OUT, side="right")))
                part, n = b.slice(lo, hi - lo), counts[lo:hi]
                lo = hi
                word = part.column("words").flatten().to_numpy()
                if not len(word):
                    continue
                at = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
                one_each = _first_of_each(at, word.view(np.uint32))
                at, word, place = at[one_each], word[one_each], place[one_each]
                cell, side = np.zeros(len(word), dtype=np.int32), np.full(len(word), 2, dtype=np.int8)
                cols = {c: part.column(c).to_numpy() for c in ("doc", "low", "high", "line", "size")}
                if len(hot):
                    found = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
                    of = np.where(hot[found] == word, many[found], 1)
                    other = np.arange(of.sum()) - np.repeat(np.cumsum(of) - of, of)
                    at, word, place, of = (np.repeat(x, of) for x in (at, word, place, of))
                    own = (_spread(cols["doc"], cols["line"])[at] % of.astype(np.uint64)).astype(np.int64)
                    cell = (np.minimum(own, other) * of + np.maximum(own, other)).astype(np.int32)
                    side = np.where(own == other, 2, own > other).astype(np.int8)
                made = [word, cell, side, *(cols[c][at] for c in ("doc", "low", "high", "line", "size")), place.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=names)
    return leads.mapInArrow(index, _INDEX)


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``_IN`` rows or more, but for the last (none of no rows)."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= _IN:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


_PAIR = "doc long, line int, other_doc long, other_line int, more boolean"


def _pairs(index: DataFrame, threshold: float, nearest: int | None) -> DataFrame:
    """Candidate pairs (a line, an earlier one) of each run of one word (and cell). With
    ``nearest``, at most so many a line and run; ``more`` tells that there are
    others. Without it, all candidates of the lines whose column ``ask`` is true."""
    names = ["doc", "line", "other_doc", "other_line", "more"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*rows)] if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def of_run(r: dict[str, np.ndarray]) -> Iterator[tuple]:
        """``r``: the rows of one run in order of (doc, line)."""
        n = len(r["doc"])
        size, place = r["size"].astype(np.int64), r["place"].astype(np.int64)
        low, high = r["low"].view(np.uint64), r["high"].view(np.uint64)
        doc, line, side = r["doc"], r["line"], r["side"]
        ask = r["ask"] if "ask" in r else np.ones(n, bool)
        for at in range(1, n, _BLOCK):
            y = np.arange(at, min(n, at + _BLOCK))
            y = y[ask[y]]
            if not len(y):
                continue
            far = np.full((len(y), nearest or 0), 1 << 30, dtype=np.int64)
            who = np.full((len(y), nearest or 0), -1, dtype=np.int64)
            total = np.zeros(len(y), dtype=np.int64)
            for from_ in range(0, int(y[-1]), 4096):
                x = np.arange(from_, min(int(y[-1]), from_ + 4096))
                need = _least_overlap(size[y][:, None], size[x][None, :], threshold)
                left = np.minimum((size - place)[y][:, None], (size - place)[x][None, :])
                differ = (np.bitwise_count(low[y][:, None] ^ low[x][None, :]).astype(np.int64)
                          + np.bitwise_count(high[y][:, None] ^ high[x][None, :]))
                ok = ((x[None, :] < y[:, None]) & (np.minimum(size[y][:, None], size[x][None, :]) >= need) & (left >= need)
                      & (differ <= size[y][:, None] + size[x][None, :] - 2 * need))
                if side[0] != 2:
                    ok &= side[y][:, None] != side[x][None, :]
                if nearest is None:
                    i, j = np.nonzero(ok)
                    if len(i):
                        yield doc[y[i]], line[y[i]], doc[x[j]], line[x[j]], np.zeros(len(i), bool)
                    continue
                total += ok.sum(axis=1)
                both = np.hstack([far, np.where(ok, differ, 1 << 30)])
                names_ = np.hstack([who, np.broadcast_to(x, ok.shape)])
                pick = np.argsort(both, axis=1, kind="stable")[:, :nearest]
                far, who = np.take_along_axis(both, pick, 1), np.take_along_axis(names_, pick, 1)
            if nearest is not None:
                i, j = np.nonzero(far < 1 << 30)
                if len(i):
                    yield doc[y[i]], line[y[i]], doc[who[i, j]], line[who[i, j]], total[i] > nearest

    columns = [c for c in index.columns if c not in ("word", "cell")]

    def of_small(r: dict[str, np.ndarray], left: np.ndarray) -> tuple:
        """The same for many runs of at most ``_SMALL`` rows one after the other;
        ``left``: rows from each one to the end of its run."""
        n = len(left)
        size, place = r["size"].astype(np.int64), r["place"].astype(np.int64)
        low, high, side = r["low"].view(np.uint64), r["high"].view(np.uint64), r["side"]
        rest = size - place
        found = [np.zeros((3, 0), dtype=np.int64)]
        go = np.arange(n)
        for k in range(1, _SMALL):
            x = go = go[left[go] > k]
            if not len(x):
                break
            both = size[x] + size[x + k]
            need = _least_overlap(both, 0, threshold)
            meet_ = (side[x] == 2) | (side[x] != side[x + k])
            ok = np.flatnonzero((np.minimum(rest[x], rest[x + k]) >= need) & meet_)  # a size is at least its rest
            x, need, both = x[ok], need[ok], both[ok]
            differ = np.bitwise_count(low[x] ^ low[x + k]).astype(np.int64) + np.bitwise_count(high[x] ^ high[x + k])
            ok = np.flatnonzero(differ <= both - 2 * need)
            found.append(np.stack([x[ok] + k, differ[ok], x[ok]]))
        y, differ, x = np.concatenate(found, axis=1)
        order = np.lexsort((x, differ, y))
        y, x = y[order], x[order]
        many = np.bincount(y, minlength=n)
        cuts = runs(y)
        nearer = np.arange(len(y)) - np.repeat(cuts[:-1], np.diff(cuts)) < nearest
        y, x = y[nearer], x[nearer]
        return r["doc"][y], r["line"][y], r["doc"][x], r["line"][x], many[y] > nearest

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = None, []  # the last word and cell, and its rows so far

        def found() -> Iterator[tuple]:
            nonlocal run, held
            for b in _larger(batches):
                w, cell = b.column("word").to_numpy(), b.column("cell").to_numpy()
                cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in columns}
                cuts = runs(w, cell)
                lo = 0
                if run == (w[0], cell[0]):  # goes on
                    held.append({c: v[:cuts[1]] for c, v in cols.items()})
                    lo = 1
                if lo == len(cuts) - 1:
                    continue
                yield from close()
                sizes = np.diff(cuts)
                inner = np.arange(len(sizes))[lo:-1]
                for k in inner[sizes[inner] > (_SMALL if nearest is not None else 1)].tolist():
                    yield from of_run({c: v[cuts[k]:cuts[k + 1]] for c, v in cols.items()})
                if nearest is not None:
                    small = inner[(sizes[inner] > 1) & (sizes[inner] <= _SMALL)]
                    if len(small):
                        left = np.repeat(cuts[1:], sizes) - np.arange(len(w))
                        chosen = np.isin(np.repeat(np.arange(len(sizes)), sizes), small)
                        yield of_small({c: v[chosen] for c, v in cols.items()}, left[chosen])
                run, held = (w[-1], cell[-1]), [{c: v[cuts[-2]:] for c, v in cols.items()}]
            yield from close()

        def close() -> Iterator[tuple]:
            if sum(len(x["doc"]) for x in held) > 1:
                yield from of_run(held[0] if len(held) == 1 else {c: np.concatenate([x[c] for x in held]) for c in columns})

        rows, size = [], 0
        for r in found():
            rows.append(r)
            size += len(r[0])
            if size > _OUT:
                yield batch(rows)
                rows, size = [], 0
        yield batch(rows)

    dealt = index.repartition("word", "cell").sortWithinPartitions("word", "cell", "doc", "line")
    return dealt.mapInArrow(meet, _PAIR)


def _alike(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        good = []
        for a, c in zip(utf8(b.column("words")), utf8(b.column("other_words"))):
            p, q = set(words_of(a)), set(words_of(c))
            both = len(p & q)
            good.append(both >= threshold * (len(p) + len(q) - both) - 1e-9)
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("line")], names=["doc", "line"]).filter(pa.array(good, pa.bool_()))


def _small_side(m: Materialized) -> DataFrame:
    """The table for a join's small side: broadcast if its measured size allows."""
    return F.broadcast(m.frame) if broadcastable(m) else m.frame


def _verified(pairs: DataFrame, slim: DataFrame, threshold: float) -> DataFrame:
    """(doc, line) of the pairs' lines that are like the earlier one, by their words."""
    wanted = materialize(pairs.select("doc", "line").union(pairs.select("other_doc", "other_line")).distinct(), "llm/lines")
    lines = slim.select("doc", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    fetched = lines.join(_small_side(wanted), ["doc", "line"])
    fetched, _ = written(fetched.select("doc", "line", "words"), "lines")
    one = pairs.join(fetched, ["doc", "line"])
    two = one.join(fetched.select(F.col("doc").alias("other_doc"), F.col("line").alias("other_line"),
                                  F.col("words").alias("other_words")), ["other_doc", "other_line"])
    return (two.select("doc", "line", "words", "other_words")
            .mapInArrow(lambda it: _alike(it, threshold), "doc long, line int").distinct())


def keyed(docs: DataFrame, id_col: str, key: str) -> DataFrame:
    """``docs`` with the column ``key``: a unique long in the order of the ids.
    Rows after the first of a repeated id, and rows without an id, get keys
    above all ids (by a row number of the written table)."""
    ids = docs.select(docs[id_col].cast("long").alias("id"))
    odd = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").select("id")
    if odd.isEmpty():
        return docs.withColumn(key, docs[id_col].cast("long"))
    uid, id_, n = (free_name(docs, x) for x in ("_uid", "_id", "_n"))
    rows, _ = written(docs.withColumn(uid, F.monotonically_increasing_id()), "lines")
    first = (rows.select(F.col(id_col).cast("long").alias(id_), F.col(uid)).where(F.col(id_).isNotNull())
             .groupBy(id_).agg(F.min(uid).alias(n)))
    return (rows.join(first, F.col(id_col).cast("long") == first[id_], "left")
            .withColumn(key, F.when(F.col(uid) == F.col(n), F.col(id_)).otherwise(F.col(uid) + F.lit(1 << 62)))
            .select(*docs.columns, key))


def later_matches(slim: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST, run: int = RUN) -> DataFrame:
    """(doc, line) of the lines to remove. ``slim``: doc (a unique long that
    orders the documents) and text (not null)."""
    counts = _counters(slim)
    counters = slim.sparkSession.sparkContext.broadcast(_ranks(counts))
    sets, _ = written(_led(_sets(slim, counters, threshold)), "lines")
    leads = sets.where("lead").drop("lead")
    blocks = _blocks_of(leads, run, counts)
    first, _ = written(_pairs(_index(leads, blocks), threshold, nearest).groupBy("doc", "line", "other_doc", "other_line")
                       .agg(F.max("more").alias("more")), "lines")
    alike = _verified(first.select("doc", "line", "other_doc", "other_line"), slim, threshold)
    good, _ = written(alike.union(sets.where("not lead").select("doc", "line")), "lines")
    rest, seen = written(first.where("more").select("doc", "line").distinct().join(good, ["doc", "line"], "left_anti"), "lines")
    if not seen["rows"]:
        return good
    # the second pass takes the runs of the open lines' words only
    asked = materialize(rest.withColumn("ask", F.lit(True)), "llm/lines")
    own = leads.join(_small_side(asked), ["doc", "line"])
    words = materialize(own.select(F.explode("words").alias("word")).distinct(), "llm/lines")
    index = (_index(leads, blocks).join(_small_side(words), "word").join(_small_side(asked), ["doc", "line"], "left")
             .withColumn("ask", F.coalesce("ask", F.lit(False))))
    again = _pairs(index.select("word", "cell", "side", "doc", "low", "high", "line", "size", "place", "ask"), threshold, None)
    again = again.select("doc", "line", "other_doc", "other_line").distinct().join(first, ["doc", "line", "other_doc", "other_line"], "left_anti")
    return good.union(_verified(written(again, "lines")[0], slim, threshold))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (numbers from 0, comma-joined) for each row."""
    rows = keyed(docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")), "doc_id", "doc")
    gone = _by_document(later_matches(rows.select("doc", "text"), threshold), "doc", "removed")
    counts = rows.select("doc_id", "doc", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    return (counts.join(gone, "doc", "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed")))


def _by_document(gone: DataFrame, key: str, out: str) -> DataFrame:
    """The removed lines of each document (at most as many as it has lines)."""
    return gone.groupBy(F.col("doc").alias(key)).agg(F.array_sort(F.collect_list("line")).alias(out))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the later matches cut out of the texts (all rows and columns kept)."""
    key, cut = free_name(docs, "_doc"), free_name(docs, "_cut")
    rows = keyed(docs, id_col, key)
    slim = rows.select(F.col(key).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    gone = _by_document(later_matches(slim, threshold), key, cut)
    joined = rows.join(gone, key, "left").select(*docs.columns, cut)
    place = docs.columns.index(text_col)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = b.column(place).to_pylist()
            for i, lines in enumerate(b.column(b.num_columns - 1).to_pylist()):
                if lines:
                    gone = set(lines)
                    out[i] = "\n".join(x for n, x in enumerate(out[i].split("\n")) if n not in gone)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols[place] = pa.array(out, b.column(place).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return joined.mapInArrow(drop, docs.schema)
