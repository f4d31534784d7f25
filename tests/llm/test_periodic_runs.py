import hashlib
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from costlens.llm import periodic_runs as R
from costlens.llm.common import table
from costlens.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=3):
    """(start, end, smallest period) of all maximal blocks of ``least`` periods or more."""
    out = []
    for p in range(1, len(w) // least + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= least * p:
                if not any(s <= i and j + p <= e and p % q == 0 for s, e, q in out):
                    out.append((i, j + p, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda s: (s[0], s[2]))


def row(doc_id, text):
    """The query's row, by its definition."""
    w = WORD.findall(text or "")
    n, h = len(w), crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = [(s, e - s, p) for s, e, p in brute(w, 4) if e - s >= 6]
    keep = [True] * n
    for s, length, p in runs:
        for i in range(s + p, s + length):
            keep[i] = False
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = [
        hashlib.sha256(t.encode()).hexdigest()
        for t in ("".join("%d,%d,%d\n" % r for r in runs), " ".join(x for x, k in zip(w, keep) if k))
    ]
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *sha)


def text_of(rnd):
    letters = rnd.choice([1, 2, 2, 3, 4, 30])
    w = []
    for _ in range(rnd.randint(0, 6)):
        if rnd.random() < 0.3:
            w += [rnd.randrange(letters) for _ in range(rnd.randint(0, 60))]
        else:
            p = rnd.choice([*range(1, 14), 15, 16, 17, 20, 23, 24, 25, 31, 33, 40, 47, 48, 49, 63, 64, 65, 90])
            block = [rnd.randrange(letters) for _ in range(p)]
            if rnd.random() < 0.5 and p > 4:
                x = rnd.randrange(1, p)
                block = [0] * x + block[x:]
            w += (block * 9)[: int(p * rnd.choice([2.5, 3, 3, 3.2, 4, 4, 5, 8])) + rnd.randint(0, 2)]
    if rnd.random() < 0.3:
        w = w[: rnd.randint(1, 80)] * rnd.randint(2, 6)
    return w


@pytest.mark.parametrize("seed", range(4))
def test_all_stretches_of_random_texts(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        texts = [text_of(rnd) for _ in range(rnd.randint(1, 12))]
        got = R.stretches([np.array(t, np.int32) for t in texts])
        assert got == [brute(t) for t in texts]


def test_long_periods_and_words_of_strings_without_repeats():
    rnd = random.Random(7)
    block = [rnd.randrange(9) for _ in range(20_011)]
    text = list(range(100, 150)) + block * 4 + list(range(200, 250))
    assert (50, 50 + 4 * 20_011, 20_011) in R.stretches([np.array(text, np.int32)])[0]
    thue = [bin(i).count("1") & 1 for i in range(1 << 14)]  # no overlaps, so no cubes
    assert R.stretches([np.array(thue, np.int32)]) == [[]]
    fib = [0, 1]
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    fib = b
    assert R.stretches([np.array(fib, np.int32)])[0] == brute(fib)


def test_chosen_positions_leave_out_periodic_regions():
    words = np.array([1, 2] * 400 + list(range(10, 400)), np.int64)
    hashes = R.mix64(words.view(np.uint64) * R._LEFT + R._RIGHT)
    for s in (1, 2, 4, 8):
        double = hashes * R._LEFT
        double[:-s] += hashes[s:] * R._RIGHT
        hashes = R.mix64(double)
    at = R.synchronising(hashes, 16, [(0, 800, 2)])
    assert not ((at >= 0) & (at < 800 - 32)).any() and (at > 800).sum() < 200


def test_query_equals_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, SF).collect()}
    short = [r for r in docs if len((r.text or "").split()) <= 4000]
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert sum(r[1] > 0 for r in got.values()) >= 5
    for r in short:
        assert got[r.doc_id] == row(r.doc_id, r.text)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(R, "SPLIT_BYTES", 50)
    hit = next(i for i in range(10_000) if crc32(str(i).encode()) % 10 == 0 and i > 50)
    rows = [
        (1, "a b " * 4, 1), (1, "a b " * 4, 1), (2, None, 2), (3, "", 3), (4, " \n\t\x0b\x0c\r ", 4),
        (5, "x x x x x x", 5), (6, "x x x x x", 6), (7, "word\x00 é " * 30, 7), (8, "\x85 \xa0" * 9, 8),
        (hit, "one two three four five six seven", 9), (hit + 0, None, 9),
        (9, "a b a b a b a b c c c c c c a b a b a b a b", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = R.digests(R.repeated_runs(R.planted(df)))
    assert sorted(map(tuple, found.collect())) == sorted(row(i, t) for i, t, _ in rows)
    nulls = spark.createDataFrame([(None, "k " * 9, 0), (None, None, 0)], "doc_id long, text string, g int")
    out = {r.n_words: r for r in R.repeated_runs(R.planted(nulls)).collect()}
    assert [tuple(x) for x in out[9].runs] == [(0, 9, 1)] and bytes(out[9].collapsed) == b"k"
    assert out[0].runs == [] and bytes(out[0].collapsed) == b"" and out[0].doc_id is None
    assert R.digests(R.repeated_runs(R.planted(df.filter("false")))).count() == 0


def test_documents_are_searched_in_groups(spark, monkeypatch):
    rows = [(i, ("w%d v " % (i % 7)) * (i % 9) + "tail " * (i % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(R, "GROUP_WORDS", 40)
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in R.repeated_runs(df).collect()}
    for i, text in rows:
        assert got[i] == [(s, e - s, p) for s, e, p in brute(WORD.findall(text), 4) if e - s >= 6]
