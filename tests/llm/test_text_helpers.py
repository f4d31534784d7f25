import random

import numpy as np
import pyarrow as pa
import pytest

from costlens.llm import common
from tests.llm.brute import ALNUM, WHITE, lower


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_hash_words_equals_regex(monkeypatch, chunk):
    monkeypatch.setattr(common, "CHUNK_BYTES", chunk)
    rnd = random.Random(3)
    letters = "aB9 \t\n.é日𝒳-_"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 200))) for _ in range(50)]
    texts += [None, "", " ", "x" * 9000, "no separators" * 3, "end "]
    for table, pattern in (
        (common.byte_table(b"\x20\x09\x0a\x0b\x0c\x0d"), WHITE),
        (common.byte_table(bytes(b for b in range(128) if not chr(b).isalnum())), ALNUM),
    ):
        raw, offsets = common.text_buffer(pa.array(texts, pa.string()))
        h, s, e, first = common.hash_words(raw, offsets, table)
        got = [
            [bytes(table[raw[a:b]]).decode() for a, b in zip(s[x:y], e[x:y])]
            for x, y in zip(first[:-1], first[1:])
        ]
        want = [pattern.findall(lower(t)) for t in texts]
        assert got == want
        flat = [w for row in want for w in row]
        assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_grams_depend_on_order_and_length():
    w = np.arange(1, 9, dtype=np.uint64)
    assert len(common.hash_grams(w, 9)) == 0
    assert len(set(common.hash_grams(w, 4).tolist())) == 5
    assert common.hash_grams(w[:4], 4)[0] != common.hash_grams(w[:4][::-1].copy(), 4)[0]


def test_key_filter_holds_every_key(spark):
    keys = spark.range(-500, 500).selectExpr("xxhash64(id) as k")
    held = common.KeyFilter(keys, "k").lookup()
    own = np.array([r.k for r in keys.collect()], np.int64)
    assert held(own).all()
    other = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 10_000)
    assert held(other).mean() < 0.2
    none = common.KeyFilter(keys.filter("false"), "k").lookup()
    assert not none(own).any()


def test_workspace_keeps_and_drops(spark):
    ws = common.Workspace(spark, "t")
    df = ws.keep(spark.range(5), "five")
    assert df.count() == 5
    ws.drop(df)
    with pytest.raises(Exception):
        spark.read.parquet(df._kept_path)
