"""Whole-text token ids from a public tokenizer file, with a bounded cache of words.

The two kinds of tokenizer file used here never join characters across certain
places of a text, so a text's ids are the ids of its parts in order:

* ``words`` (white space is dropped before the merges): each white-space
  separated word is a part, cut further where two ASCII characters of different kinds
  (letters, digits, others) meet, for no piece of the published pattern holds two kinds
  but a contraction such as ``'s`` (so no cut from an apostrophe to a letter; none
  at other bytes, whose characters may be joined with their neighbours);
* ``spaces`` (byte-level merges within pieces of the published pattern, in which
  a piece has at most one leading space): a part is a run without white space
  with the space before it, or a run of white space (less its last character
  where a word follows; that character is the word's if it is a space, else a part).

Parts repeat, texts do not. A batch of texts is cut into parts and hashed as one array
of bytes, each distinct part is looked up once, and the ids of all parts are gathered from
one pool, all by array operations. The cache is three flat arrays sorted by hash (about
40 bytes a part), emptied when it has ``CACHE_PARTS`` parts. A part is
known by its 64-bit hash, its length and its first and last eight bytes (so any part of up to 16
bytes by its whole content). Parts not in the cache are encoded as one text with a mark
between them, whose one id shows where to cut; where a part holds the mark itself, one by one.

Texts with rare white space or control characters, on which bytes and the library might disagree,
are encoded as a whole, and so are texts with the string of an added token such as
``<|endoftext|>``, which gets its one id as the library's plain encode has it. tests/llm compare both ways on whole texts.

Defined results: a null text is empty and has no ids; a text of any length is whole.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from quarry.llm.line_dedup import _hashes

CACHE_PARTS = 400_000
_RECENT = 60_000
_BATCH_BYTES = 1 << 19
# White space and formats of three UTF-8 bytes, first and last: U+1680, U+180E, U+2000-200F, U+2028-202F,
# U+205F-206F, U+3000, U+FEFF.
_RARE = [(0xE19A80, 0xE19A80), (0xE1A08E, 0xE1A08E), (0xE28080, 0xE2808F), (0xE280A8, 0xE280AF), (0xE2819F, 0xE281AF),
         (0xE38080, 0xE38080), (0xEFBBBF, 0xEFBBBF)]
_CUT = re.compile(rb"[A-Za-z0-9](?=[ \t-\r])")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Kinds of bytes: 0 white space, 1 letter, 2 digit, 3 other, 4 apostrophe, 5 not ASCII; and between which kinds a part ends.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[_SPACE], _KIND[128:], _KIND[39] = 0, 5, 4
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_MEET = np.zeros((6, 6), dtype=bool)
_MEET[0, 1:] = _MEET[1:, 0] = True
for _a, _b in [(1, 2), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)]:
    _MEET[_a, _b] = True
_ODD = np.zeros(256, dtype=np.uint8)  # 1: rare by itself; 2: may begin a rare character
_ODD[[*range(9), *range(14, 32), 127]] = 1
_ODD[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = 2
_EIGHT = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run without white space; the bytes begin and end with white space."""
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    return edge[0::2], edge[1::2]


def kinds_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of each part of the words: they are cut where two kinds of characters meet."""
    kind = _KIND[raw]
    at = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    before, after = kind[at - 1], kind[at]
    cut = _MEET[before, after]
    return at[cut & (after > 0)], at[cut & (before > 0)]


def rare_places(raw: np.ndarray) -> np.ndarray:
    """Where rare white space and controls begin (the bytes go on for two more after the last)."""
    kind = _ODD[raw]
    at = np.flatnonzero(kind)
    lead, one, two = raw[at], raw[at + 1], raw[at + 2]
    pair = lead.astype(np.uint32) << 16 | one.astype(np.uint32) << 8 | two
    found = kind[at] == 1
    found |= (lead == 0xC2) & (one >= 0x80) & (one <= 0xA0)
    for low, high in _RARE:
        found |= (pair >= low) & (pair <= high)
    return at[found]


class _Cache:
    """Parts by hash: sorted hashes, what tells parts of one hash apart, and their ids in a pool."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hash = np.zeros(0, dtype=np.uint64)
        self.size = np.zeros(0, dtype=np.int32)
        self.head, self.tail = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.at, self.many = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def find(self, hashes: np.ndarray, size, head, tail) -> np.ndarray:
        """The place of each part, -1 where it is not here."""
        if not len(self.hash):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        same = (self.hash[at] == hashes) & (self.size[at] == size) & (self.head[at] == head) & (self.tail[at] == tail)
        return np.where(same, at, -1)

    def knows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.zeros(len(hashes), dtype=bool)
        return self.hash[np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)] == hashes

    def add(self, *columns: np.ndarray) -> None:
        """More parts (hash, size, head, tail, at, many), whose hashes are not here."""
        mine = (self.hash, self.size, self.head, self.tail, self.at, self.many)
        both = [np.concatenate([a, b.astype(a.dtype)]) for a, b in zip(mine, columns)]
        order = np.argsort(both[0], kind="stable")
        self.hash, self.size, self.head, self.tail, self.at, self.many = (c[order] for c in both)


class _Pool:
    """All ids of the cache, one after the other."""

    def __init__(self):
        self.ids, self.used = np.zeros(1 << 16, dtype=np.uint32), 0

    def add(self, ids: np.ndarray) -> int:
        first = self.used
        if first + len(ids) > len(self.ids):
            more = np.zeros(max(2 * len(self.ids), first + len(ids)), dtype=np.uint32)
            more[:first] = self.ids[:first]
            self.ids = more
        self.ids[first:first + len(ids)] = ids
        self.used += len(ids)
        return first


def _pieces(text: bytes) -> list[bytes]:
    """A long text in pieces: cut between a letter or digit and white space, where two parts always meet."""
    out, at = [], 0
    while len(text) - at > 2 * _BATCH_BYTES and (cut := _CUT.search(text, at + _BATCH_BYTES)):
        out.append(text[at:cut.end()])
        at = cut.end()
    return [*out, text[at:]] if at else [text]


def _joined(texts: list[bytes], todo: list[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts with a line break around each (several after the last), the bytes as an array, and
    where each text begins (and one more)."""
    data = b"\n" + b"\n".join([texts[i] for i in todo]) + b"\n" * 17
    return data, np.frombuffer(data, dtype=np.uint8), np.cumsum([1] + [len(texts[i]) + 1 for i in todo])


class Encoder:
    """Encodes batches of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, parts: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(re.escape(a.encode()) for a in added), re.I) if added else None
        self.first = sorted({a.encode()[:1] for a in added})
        self.spaces = parts != "words"
        # neither mark is joined with its neighbours: a word of its own, or white space before a part
        self.between = "\n" if self.spaces else " ☼ "
        mark = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.forget()

    def forget(self) -> None:
        self.old, self.young, self.pool = _Cache(), _Cache(), _Pool()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part_ids(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts (none of white space only) one after the other, and how many each has."""
        if self.mark is not None:
            # a lone surrogate cannot be in UTF-8, so all bytes decode
            ids = self._ids([self.between.join([p.decode("utf-8", "replace") for p in parts])])[0]
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(parts) - 1:
                many = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
                return np.delete(ids, marks), many
        each = self._ids([p.decode("utf-8", "replace") for p in parts])  # a part holds the mark
        return np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each whole text (UTF-8; null is empty)."""
        texts = [t.encode() if isinstance(t, str) else t or b"" for t in texts]
        pieces, of = [], []
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                pieces.append(piece)
                of.append(i)
        ids: list[bytes] = [b""] * len(pieces)
        todo, held = [], 0
        for i, piece in enumerate(pieces):
            if todo and held + len(piece) > _BATCH_BYTES:
                self._batch(pieces, todo, ids)
                todo, held = [], 0
            todo.append(i)
            held += len(piece)
        if todo:
            self._batch(pieces, todo, ids)
        if len(pieces) == len(texts):
            return ids
        out: list[list[bytes]] = [[] for _ in texts]
        for i, x in zip(of, ids):
            out[i].append(x)
        return [b"".join(x) for x in out]

    def _batch(self, texts: list[bytes], todo: list[int], out: list[bytes]) -> None:
        data, raw, begin = _joined(texts, todo)
        # texts with rare characters or with strings of added tokens are encoded as a whole
        at = [rare_places(raw), *[np.flatnonzero(raw == f[0]) for f in self.first]]
        rare, *perhaps = [np.unique(np.searchsorted(begin, x, side="right") - 1).tolist() for x in at]
        odd = set(rare)
        for j in chain(*perhaps):
            if j < len(todo) and j not in odd and self.added.search(texts[todo[j]]):
                odd.add(j)
        if odd:
            for j in odd:
                out[todo[j]] = self._ids([texts[todo[j]].decode("utf-8", "replace")])[0].astype("<u4").tobytes()
            todo = [i for j, i in enumerate(todo) if j not in odd]
            data, raw, begin = _joined(texts, todo)
        start, end, blank = self._bounds(raw, begin)
        if not len(start):
            return
        if len(self.young.hash) + len(self.old.hash) > CACHE_PARTS:
            self.forget()
        size = end - start
        with np.errstate(over="ignore"):
            hashes = _hashes(data, start, size)
        eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
        short = np.minimum(size, 8)
        head, tail = eight[start] & _EIGHT[short], eight[end - short] & _EIGHT[short]
        distinct, at, of = np.unique(hashes, return_index=True, return_inverse=True)
        first, many = self._looked_up(data, distinct, start[at], size[at], head[at], tail[at], blank[at])
        first, many = first[of], many[of]
        # parts that share a hash and nothing else are encoded apart
        differ = (size != size[at][of]) | (head != head[at][of]) | (tail != tail[at][of])
        for i in np.flatnonzero(differ).tolist():
            ids = self._ids([data[start[i]:end[i]].decode("utf-8", "replace")])[0]
            first[i], many[i] = self.pool.add(ids), len(ids)
        ends = np.cumsum(many)
        place = np.arange(ends[-1]) + np.repeat(first - (ends - many), many)
        ids = self.pool.ids[place].astype("<u4").tobytes()
        cuts = np.concatenate([[0], ends])[np.searchsorted(start, begin)].tolist()
        for i, lo, hi in zip(todo, cuts[:-1], cuts[1:]):
            out[i] = ids[4 * lo:4 * hi]

    def _bounds(self, raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and kind (white space only) of all parts of the texts, in order."""
        if not self.spaces:
            start, end = kinds_of(raw)
            return start, end, np.zeros(len(start), dtype=bool)
        start, end = words_of(raw)
        # the white space between: cut at the texts' ends (a line break of our own stands there)
        text_of_word = np.searchsorted(begin, start, side="right") - 1
        before = np.concatenate([[1], end])  # where the white space before each word (and after the last) begins
        after = np.concatenate([start, [begin[-1] - 1]])
        gap_from, gap_to = before[:-1], after[:-1]
        # the part of a gap that lies in the word's own text: from its beginning at least
        in_text = np.maximum(gap_from, begin[text_of_word])
        lead = (gap_to > in_text) & (raw[gap_to - 1] == 32)
        single = (gap_to > in_text) & ~lead  # its last character is a part of its own
        rest_to = gap_to - (gap_to > in_text)
        # and what lies at the end of texts before (the last word's white space, texts of white space only)
        tails = self._tails(begin, start, end)
        starts = [start - lead, gap_to[single] - 1, in_text[rest_to > in_text], tails[0]]
        ends = [end, gap_to[single], rest_to[rest_to > in_text], tails[1]]
        blank = [np.zeros(len(start), dtype=bool), *[np.ones(len(x), dtype=bool) for x in starts[1:]]]
        starts, ends, blank = np.concatenate(starts), np.concatenate(ends), np.concatenate(blank)
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order], blank[order]

    @staticmethod
    def _tails(begin: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The white space after the last word of each text (the whole text where it has no word)."""
        stop = begin[1:] - 1
        last = np.searchsorted(start, stop) - 1  # the last word before each text's end
        from_ = np.where(last >= 0, end[np.maximum(last, 0)] if len(end) else 0, 0)
        from_ = np.maximum(from_, begin[:-1])
        some = stop > from_
        return from_[some], stop[some]

    def _looked_up(self, data, hashes, start, size, head, tail, blank) -> tuple[np.ndarray, np.ndarray]:
        """The first id's place in the pool and the number of ids of distinct parts."""
        first, many = np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        todo = np.arange(len(hashes))
        for cache in (self.young, self.old):
            at = cache.find(hashes[todo], size[todo], head[todo], tail[todo])
            hit = at >= 0
            first[todo[hit]], many[todo[hit]] = cache.at[at[hit]], cache.many[at[hit]]
            todo = todo[~hit]
        if not len(todo):
            return first, many
        words, blanks = todo[~blank[todo]], todo[blank[todo]]
        for these, encode in ((words, self._part_ids), (blanks, self._blank_ids)):
            if len(these):
                ids, counts = encode([data[a:a + n] for a, n in zip(start[these].tolist(), size[these].tolist())])
                many[these] = counts
                first[these] = self.pool.add(ids) + np.cumsum(counts) - counts
        fresh = todo[~self.young.knows(hashes[todo]) & ~self.old.knows(hashes[todo])]  # a hash has one part
        self.young.add(hashes[fresh], size[fresh], head[fresh], tail[fresh], first[fresh], many[fresh])
        if len(self.young.hash) > _RECENT:
            y = self.young
            self.old.add(y.hash, y.size, y.head, y.tail, y.at, y.many)
            self.young = _Cache()
        return first, many

    def _blank_ids(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        each = self._ids([p.decode() for p in parts])
        return np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, parts: str) -> Encoder:
    """The worker's encoder for one file (kept while the worker is reused)."""
    if (path, parts) not in _ENCODERS:
        _ENCODERS[path, parts] = Encoder(path, parts)
    return _ENCODERS[path, parts]


def slices(texts: list[bytes], rows: int = 2048, size: int = 2 * _BATCH_BYTES):
    """(first, end) of runs of texts of at most so many rows and about so many bytes."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and (i - first == rows or held + len(text) > size):
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def texts_of(column) -> list[str]:
    """The strings of an Arrow column; null counts as empty."""
    return ["" if v is None else v for v in column.to_pylist()]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)
