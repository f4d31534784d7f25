import json
import random
from functools import lru_cache

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from costlens.llm import token_counts as T
from costlens.llm.common import table
from costlens.llm.queries import op11_token_counts

PATH = P.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@lru_cache
def merger():
    return T.PairMerger(json.load(open(PATH)))


@lru_cache
def library():
    return Tokenizer.from_file(PATH)


def expected(texts):
    return [len(e.ids) for e in library().encode_batch(list(texts), add_special_tokens=False)]


def test_random_texts_equal_the_library():
    rnd = random.Random(11)
    kinds = [
        "aab", "abcdefghij", " \n\tae'st", "éàüß日本語한", "the and ing tion", "😀🇦 a", "0123456789 .,",
        "'s't'LL're ", "ΣσςΑ ", "İIıi", "éà ", "\x1c\x1f\x85\xa0　!", "<|endoftext|>", "²①ำ",
    ]
    texts = ["".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randint(0, 90))) for _ in range(4000)]
    assert [merger().count(t) for t in texts] == expected(texts)


def test_every_letter_of_the_first_planes():
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} X" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    wrong = [t for t, n in zip(texts, expected(texts)) if merger().count(t) != n]
    assert not wrong, wrong[:20]


@pytest.mark.parametrize(
    "text",
    [
        "a" * 50_000,
        "ab" * 20_000,
        "<|startoftext|>Some<|endoftext|><|endoftext|> text<|EndOfText|>",
        "Word1234567890 " * 20_000,
        "thequickbrownfox" * 5_000,
        "!?" * 9_000,
    ],
)
def test_long_pieces_and_special_strings(text):
    assert [merger().count(text)] == expected([text])


def test_long_texts_are_counted_in_stretches(monkeypatch):
    text = "Some words of 12 kinds,\x1cit's \n" * 300
    monkeypatch.setattr(T, "STRETCH", 37)
    assert "".join(T.stretches(text)) == text and len(list(T.stretches(text))) > 100
    assert [merger().count(text)] == expected([text])


def test_bounded_memo_table(monkeypatch):
    monkeypatch.setattr(T, "STRINGS_KEPT", 3)
    m = T.PairMerger(json.load(open(PATH)))
    text = " ".join(f"word{i} zyxwvut{i}" for i in range(50))
    assert [m.count(text)] == expected([text]) and len(m._known) <= 3


def test_merges_wait_for_a_lower_rank():
    """A merge list whose new pair ranks below the merge that made it."""
    letters = T.byte_letters()
    names = [*letters, *(c + "</w>" for c in letters), "abc</w>", "bc</w>", "xy", "xyabc</w>", "aa", "aab</w>"]
    merges = [["xy", "abc</w>"], ["a", "bc</w>"], ["b", "c</w>"], ["x", "y"]]
    spec = json.load(open(PATH))
    spec["model"]["vocab"] = {n: i for i, n in enumerate(names)}
    spec["model"]["merges"] = merges
    own = T.PairMerger(spec)
    again = Tokenizer.from_str(json.dumps(spec))
    for t in ["xyabc", "abc", "abcxyabc", "bcxy", "xyabcxyabc"]:
        assert own.count(t) == len(again.encode(t, add_special_tokens=False).ids)


def test_query_shape_and_edges(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "héllo", "y"), (2, None, None), (3, "", "z"), (4, "w " * 3_000, "z"), (5, " \n ", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = T.token_counts(df, PATH).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in out)
    counts = expected([t or "" for _, t, _ in rows])
    assert got == sorted((i or 0, len((t or "").encode()), n, n > 2048) for (i, t, _), n in zip(rows, counts))
    assert T.token_counts(df.filter("false"), PATH).count() == 0


def test_query_equals_the_library(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    out = op11_token_counts(spark, SF).collect()
    counts = dict(zip(docs, expected(docs.values())))
    assert len(out) == len(docs)
    for r in out:
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), counts[r.doc_id])
        assert r.over_limit == (r.n_tokens > 2048)
