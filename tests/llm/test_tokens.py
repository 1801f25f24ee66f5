"""The encoder's parts, cache and pieces against the library's plain encode."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarry.llm import token_files, tokens
from quarry.llm.tokens import Encoder, slices, vocabulary

FILES = [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")]


def texts_of(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "Straße", "naïve", "don't", "x=1;", "日本語", "a" * 70, "12,345.6", "☼", "w☼w", "<|endoftext|>", "<|EndOfText|>", "<b>", "é", "--"]
    gaps = [" ", "  ", "\n", " \n", "\n ", "\t\t ", "\r\n", "\x0b", "   \n\n  "]
    out = ["", " ", "\n", "  x", "x  ", " x", "a b", "　", "﻿x", "a\x00b", "\x7f", "  y", "a b"]
    for _ in range(n):
        out.append("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(30))) + rng.choice(["", "end", " "]))
    return out


def plain(path, texts):
    lib = Tokenizer.from_file(path)
    return [np.array(lib.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


@pytest.mark.parametrize("name, parts", FILES)
def test_ids_equal_the_librarys(name, parts):
    path, texts = vocabulary(name), texts_of(1)
    e, want = Encoder(path, parts), plain(path, texts_of(1))
    assert e.encode([t.encode() for t in texts]) == want
    assert e.encode(texts) == want and e.encode([t.encode() for t in reversed(texts)]) == want[::-1]  # from the cache
    assert [e.encode([t])[0] for t in texts] == want
    assert e.encode([]) == [] and e.encode([None, b""]) == [b"", b""]


@pytest.mark.parametrize("name, parts", FILES)
def test_small_cache_batches_and_pieces(monkeypatch, name, parts):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 20)
    monkeypatch.setattr(tokens, "_RECENT", 5)
    monkeypatch.setattr(tokens, "_BATCH_BYTES", 200)
    path, texts = vocabulary(name), texts_of(2) + [" ".join(texts_of(3, 40)), "nospaces" * 300, " " * 3000 + "x"]
    assert Encoder(path, parts).encode(texts) == plain(path, texts)


@pytest.mark.parametrize("name, parts", FILES)
def test_parts_of_one_hash_are_told_apart(monkeypatch, name, parts):
    monkeypatch.setattr(tokens, "_hashes", lambda data, start, size: np.full(len(start), 7, dtype=np.uint64))
    path, texts = vocabulary(name), texts_of(4, 25)
    e = Encoder(path, parts)
    assert e.encode(texts) == plain(path, texts) and e.encode(texts) == plain(path, texts)


def test_words_with_punctuation_share_their_parts(monkeypatch):
    path, asked = vocabulary("word_bpe_49k.json"), []
    e, inner = Encoder(path, "words"), Encoder._part_ids
    monkeypatch.setattr(Encoder, "_part_ids", lambda self, parts: asked.extend(parts) or inner(self, parts))
    texts = ["alpha alpha, alpha. alpha; (alpha) [alpha] alpha's alpha9 9alpha"]
    assert e.encode(texts) == plain(path, texts)
    assert [p for p in asked if b"alpha" in p] == [b"alpha"]


def test_parts_of_words_meet_where_the_librarys_pieces_do():
    rng, path = random.Random(6), vocabulary("word_bpe_49k.json")
    chars = [*"abstremvldSTRK", *"", *"019.,;<>|!-_", " ", "\n", "\u0338", "\u0301", "\u0307", "J\u030c", "\u0130", "\u212a", "\u037e",
             "é", "ß", "日", "’", "½", "Ⅷ", "ſ"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    assert Encoder(path, "words").encode(texts) == plain(path, texts)


def test_slices_are_whole_and_bounded():
    texts = [b"x" * n for n in (0, 5, 100, 3, 3, 3, 0, 0)]
    got = list(slices(texts, rows=3, size=10))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(texts)))
    assert all(b - a <= 3 and (b - a == 1 or sum(map(len, texts[a:b])) <= 10) for a, b in got)
    assert list(slices([])) == []


def test_id_width_follows_the_vocabulary():
    path = vocabulary("word_bpe_49k.json")
    assert token_files.id_width(path, 2) == 2 and token_files.id_width(path, 70_000) == 4
