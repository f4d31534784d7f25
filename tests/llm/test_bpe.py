import base64
import hashlib
import random
from functools import lru_cache

import public_tokenizers as P
import pytest
import tiktoken

from costlens.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@lru_cache
def codec():
    return bpe.BytePairCodec.from_rank_file(open(PATH, "rb").read(), P.PATTERN)


@lru_cache
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_equal_rank_order_merging():
    rnd = random.Random(5)
    kinds = ["aab", "abcdefghij", " \n\tae'st", "éàüß日本語한", "the and ing tion", "😀🇦 a", "0123456789 .,"]
    for _ in range(2000):
        t = "".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randint(0, 80)))
        ids = codec().encode(t)
        assert ids == reference().encode_ordinary(t)
        assert codec().decode(ids) == t.encode()


def test_joined_tokens_as_one_piece():
    rnd = random.Random(6)
    tokens = list(codec().ranks)
    for _ in range(3000):
        piece = b"".join(rnd.choice(tokens) for _ in range(rnd.randint(2, 6)))
        assert list(codec()._encode_bytes(piece)) == reference()._encode_single_piece(piece)


@pytest.mark.parametrize("piece", ["a" * 20_000, "ab" * 10_000, " " * 5_000, "<|endoftext|>" * 50])
def test_long_pieces(piece):
    assert codec().encode(piece) == reference().encode_ordinary(piece)


def test_bounded_memo_tables(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES_KEPT", 3)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 3)
    c = bpe.BytePairCodec(codec().ranks, P.PATTERN)
    t = " ".join(f"word{i} zyxwvut{i}" for i in range(50))
    assert c.encode(t) == reference().encode_ordinary(t)
    assert len(c._pieces) <= 3 and len(c._pairs) <= 3


def test_query_shape_and_edges(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "héllo", "y"), (2, None, None), (3, "", "z"), (4, "w " * 50_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.encode(df, PATH, P.PATTERN).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for i, t, _ in rows:
        ids = reference().encode_ordinary(t or "")
        for r in by[i]:
            assert r.token_ids == ids and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(df.filter("false"), PATH, P.PATTERN).count() == 0


def test_long_pieces_block_by_block(monkeypatch):
    for name, value in (("LONG_PIECE", 0), ("MATCH_BLOCK", 7), ("BLOCKS_KEPT", 1)):
        monkeypatch.setattr(bpe, name, value)
    rnd = random.Random(8)
    tokens = list(codec().ranks)
    for _ in range(1500):
        piece = b"".join(rnd.choice(tokens) for _ in range(rnd.randint(2, 9)))
        assert list(codec()._encode_bytes(piece)) == reference()._encode_single_piece(piece)
    for piece in ("ab" * 500, "a" * 999, "\u00e0\u65e5" * 200, " " * 333):
        assert codec().encode(piece) == reference().encode_ordinary(piece)


def test_an_unbroken_piece_takes_little_memory():
    import tracemalloc

    rnd = random.Random(9)
    size = 500_000
    piece = bytes(rnd.choices(b"etaoinshrdlu", k=size))
    whole = codec()
    whole._encode_bytes(piece)  # its tables of pairs, bounded on their own, are not counted
    tracemalloc.start()
    ids = whole._encode_bytes(piece)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert whole.decode(ids) == piece
    assert peak < 25 * size + 16_000_000  # with the list of matches per position: 280 * size
