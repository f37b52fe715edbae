from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tabspark.llm import bpe, tokencount, tokenfile

from .helpers import ODD, docs, key, texts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("ab") for _ in range(2000)), "".join(chr(r.randint(32, 0x2FFF)) for _ in range(2000)), "a" * 20_000, "ab" * 9_000, " " * 700]


def test_rank_queue_equals_library(library):
    codec = bpe.ByteBPE(open(RANKS, "rb").read(), P.PATTERN, cache=10)
    for text in noise(1) + [x for _, x in texts()]:
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    assert not any(codec.words)


def test_ties_and_lower_new_ranks():
    # "bc" is worth less than the "abc" it makes possible: the queue must step back
    table = {b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"cc": 4, b"bc": 5, b"aa": 6}
    lines = b"\n".join(base64.b64encode(k) + b" %d" % v for k, v in table.items())
    ours = bpe.ByteBPE(lines, r"\S+|\s+")
    theirs = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=table | {bytes([i]): 300 + i for i in range(256) if bytes([i]) not in table}, special_tokens={})
    r = random.Random(2)
    for n in range(1, 60):
        text = "".join(r.choice("abc") for _ in range(n))
        assert ours.encode(text) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("piece", [bpe.PIECE, 3500])
def test_encode_decode_query(spark, library, monkeypatch, piece):
    monkeypatch.setattr(bpe, "PIECE", piece)  # rows in one batch, and cut by their decoded bytes
    ids = bpe.encode(docs(spark), RANKS, P.PATTERN)
    got = bpe.digests(bpe.decode(ids, RANKS, P.PATTERN)).collect()
    want = []
    for i, text in texts():
        t = library.encode_ordinary(text)
        want.append((i, len(t), hashlib.sha256(",".join(map(str, t)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe.encode(docs(spark).limit(0), RANKS, P.PATTERN).count() == 0


def test_overlap_resynchronisation():
    table = open(P.path("byte_bpe_50k.json"), "rb").read()
    counter = tokencount.Counter(table)
    for text in [*noise(3), "<|endoftext|>" * 500 + "x", "foo  bar   \n" * 600, "don't we'll  " * 500, "日本 語テ キス" * 400, "x" * 3000 + " y z" * 300]:
        for chunk, overlap in ((2000, 64), (300, 8), (100, 40), (64, 1)):
            assert counter.count(text, chunk, overlap) == counter.whole([text])[0]


def test_short_texts_equal_library():
    counter = tokencount.Counter(open(P.path("byte_bpe_50k.json"), "rb").read())
    assert counter.cuts
    r = random.Random(8)
    signs = ["a", "B", " ", " ", " ", "\n", "\t", "'s", "'ll", "é", "1", "٣", "中", "\x1c", "\x1f", "\x85", "\u180e", "\u200b", "\ufeff", "\u0301", "\u00a0", "\u2003", "<|endoftext|>", ".", "!!", "😀", "\r\n", "x" * 70]
    given = ["".join(r.choices(signs, k=r.randint(0, 14))) for _ in range(20_000)] + [x for _, x in texts()] + noise(8)
    assert sum(not tokencount.UNSAFE(x) for x in given) > 2000
    for _ in range(2):  # parts new, and parts remembered
        assert counter.short(given) == counter.whole(given)


def test_count_query(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = tokencount.count_tokens(docs(spark), P.path("byte_bpe_50k.json"), limit=5, chunk=200, overlap=16).collect()
    want = [(i, len(x.encode()), n := len(library.encode(x, add_special_tokens=False).ids), n > 5) for i, x in texts()]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert tokencount.count_tokens(docs(spark).limit(0), P.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("high", [0, 1, 255, 256, 65_535, 1 << 24, (1 << 32) - 1])
def test_codes(high):
    r = np.random.default_rng(high)
    for n in (0, 1, 7, 511, 512, 513, 3000):
        ids = r.integers(0, high + 1, n, dtype="u8").astype("u4")
        segment = tokenfile.Segment(*tokenfile.pack(ids))
        assert (segment.all() == ids).all() and len(segment.all()) == n
        for i in range(0, n, 97):
            assert segment.get(i) == ids[i]


def test_words_equal_library():
    path = P.path("word_bpe_49k.json")
    library, words = Tokenizer.from_file(path), tokenfile.Words(open(path, "rb").read())
    assert words.by_word
    text = ["The THE the, thé, thé. É! naïve... don't DON'T it'stuff. x's's's, İstanbul, Straße; e\u0301, a\u0338= A1b2,,, 3.14 <|endoftext|> <|ENDOFTEXT|> <|endoftext|>. a<|endoftext|>b", "ﬁne ½ … a…, \u00a0nb\u00a0sp, \u2003 日本語、テスト. K \U0001f600, ok:) --x-- \x1c\x1d z"]
    for given in (text, noise(7), [x for _, x in texts()]):
        assert [np.frombuffer(x, "<u4").tolist() for x in words.packed([x.encode() for x in given])] == [library.encode(x, add_special_tokens=False).ids for x in given]


def test_token_files(spark, monkeypatch):
    path_ = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path_)
    rows = [*ODD, *[(100 + i, "word%d and more <|endoftext|>x y " % i * (i % 5), "en", "a", 1) for i in range(40)]]
    path = tokenfile.write(docs(spark, rows), path_, shards=5)
    got = sorted(map(tuple, tokenfile.documents(spark, path).collect()), key=lambda r: r[1])
    start, want, flat = 0, [], []
    for i, text in sorted(texts(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        flat += ids
    assert got == want
    assert [tokenfile.get_token(spark, path, i) for i in (0, 17, len(flat) - 1, len(flat))] == [flat[0], flat[17], flat[-1], None]
    assert sorted(r.ids for r in tokenfile.tokens(spark, path).collect())
    empty = tokenfile.write(docs(spark).limit(0), path_)
    assert tokenfile.documents(spark, empty).count() == 0
