import hashlib
import random

import numpy as np

from costlens.llm import decontaminate as dc
from tests.llm.brute import benchmark_hits


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, window string, pos long")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, finger string")
    got = sorted((tuple(r) for r in dc.decontaminate(d, b).collect()), key=str)
    want = []
    for i, n, hit, found in benchmark_hits(docs, items):
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        want.append((i, n, hit, len(found), digest, hit > 0))
    assert got == sorted(want, key=str)
    return d, b


def words(rnd, n):
    return [rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(n)]


def test_random_passages_with_few_words(spark):
    """Few different words, so grams repeat, tie and overlap."""
    rnd = random.Random(8)
    items = [(i, " ".join(words(rnd, rnd.choice([1, 2, 4, 5, 7, 9, 10, 11, 30])))) for i in range(12)]
    items += [(3, items[3][1]), (40, None), (41, ""), (42, "..."), (43, items[11][1]), (None, " ".join(words(rnd, 12)))]
    docs = []
    for i in range(60):
        w = words(rnd, rnd.randint(0, 60))
        own = (items[rnd.randrange(12)][1] or "").split()
        at = rnd.randint(0, len(own))
        w[len(w) // 2 : len(w) // 2] = own[at:] if i % 2 else own
        docs.append((i, rnd.choice([" ", ", ", "--"]).join(w).upper() if i % 3 else " ".join(w)))
    docs += [(100, None), (101, ""), (102, " "), (103, items[7][1]), (104, "x " * 40_000 + items[8][1])]
    d, b = check(spark, docs, [x for x in items if x[0] is not None])
    kept = {r.doc_id for r in dc.clean(d, b).collect()}
    hit = {i for i, _, n, _ in benchmark_hits(docs, [x for x in items if x[0] is not None]) if n}
    assert kept == {i for i, _ in docs} - hit and hit and kept
    assert dc.clean(d, b).columns == d.columns


def test_repeated_and_unnamed_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    items = [(1, passage), (1, passage), (2, passage)]
    check(spark, [(1, passage), (1, passage), (2, "zero " + passage + " zero"), (None, passage), (3, "one two")], items)


def test_empty_tables(spark):
    passage = "one two three four five six seven eight nine ten"
    check(spark, [(1, passage)], [(9, None)])
    check(spark, [(1, None)], [(9, passage)])
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(d, b).count() == 0


def test_shared_spans_share_fingerprints():
    """Winnowing's guarantee: a window picks the same gram wherever it stands."""
    rnd = np.random.default_rng(3)
    span = rnd.integers(0, 5, 10).astype(np.uint64)
    for _ in range(50):
        a = np.concatenate([rnd.integers(0, 5, rnd.integers(0, 9)).astype(np.uint64), span])
        picks = dc.winnow(a, 10)
        assert picks[-1] - (len(a) - 10) == dc.winnow(span, 10)[0]


def test_rows_of_one_id_do_not_share_hits(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [
        (None, "a clean null row"), (None, "another clean row here"), (None, passage + " eleven"),
        (7, passage), (7, "x " + passage), (7, "clean under a dirty id"), (7, None), (8, passage), (8, passage),
        (9, "clean alone"), (None, None), (None, ""),
    ]
    d, b = check(spark, docs, [(1, passage)])
    out = dc.decontaminate(d, b).collect()
    assert all(r.n_hit <= r.n_words for r in out)
    kept = sorted(((r.doc_id, r.text) for r in dc.clean(d, b).collect()), key=str)
    assert kept == sorted(((i, t) for i, t in docs if passage not in (t or "")), key=str)
