import random

import numpy as np
import pyarrow as pa

from costlens.llm import near_dedup as nd
from tests.llm.brute import near_groups, shingles

SCHEMA = "doc_id long, text string, kept string, rep long, bucket long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def drifting_copies(rnd, n, start):
    """A text edited again and again: neighbours are near copies, distant ones are not."""
    words = [f"w{rnd.randint(0, 5000)}" for _ in range(120)]
    for i in range(n):
        words = list(words)
        words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 10**6)}"
        yield start + i, " ".join(words)


def check(spark, rows):
    out = nd.near_duplicates(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    named = [(i, t) for i, t in rows if i is not None]
    want = near_groups(named)
    sizes = {}
    for i, t in rows:
        sizes.setdefault(i, set()).add(len(shingles(t)))
    for r in out:
        assert r.n_shingles in sizes[r.doc_id]
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.kept == (r.component_id == r.doc_id)
    return out


def test_chains_copies_and_edges(spark, monkeypatch):
    rnd = random.Random(4)
    rows = list(drifting_copies(rnd, 150, 1000))
    rnd.shuffle(rows)
    rows += [(i, "the very same text of many copies here") for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "one"), (54, "ONE"), (55, "one two"), (56, "é É")]
    rows += [(None, "one"), (None, None), (60, "x " * 30_000), (61, "X " * 30_000)]
    rows += [(70, "a b c d e f"), (70, "a b c d e f"), (71, "a b c d e f")]
    # one id with two texts ties their groups together
    rows += [(80, "p q r s t u v w"), (80, "k l m n o p q r x y"), (81, "p q r s t u v w"), (82, "k l m n o p q r x y")]
    check(spark, rows)
    monkeypatch.setattr(nd, "CELL_WEIGHT", 2_000)  # the chain's buckets fall into several cells
    check(spark, rows)


def test_no_rows_and_no_words(spark):
    assert nd.near_duplicates(frame(spark, []).filter("false")).count() == 0
    check(spark, [(1, None), (2, " ")])


def test_sketch_agreement_follows_similarity():
    rnd = np.random.default_rng(2)
    for shared, own in ((80, 10), (50, 25), (8, 1)):
        agree = []
        for _ in range(60):
            x = rnd.integers(0, 2**63, shared + 2 * own).astype(np.uint64)
            a, b = np.unique(x[: shared + own]), np.unique(np.concatenate([x[:shared], x[shared + own :]]))
            s = nd.similarity_sketches([a, b])
            assert (s != nd._EMPTY).all()  # every coordinate fills, small sets included
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - shared / (shared + 2 * own)) < 0.05


def test_cell_links_find_all_joins():
    texts = ["a b c d e f g h i j", "a b c d e f g h i j k", "z y x w v u", "z y x w v u"]
    cell = pa.table({"part": [0, 0, 1, 1], "rep": [1, 2, 3, 4], "label": [1, 2, 3, 4], "text": texts})
    got = {(r["a"], r["b"]) for r in nd._cell_links(cell).to_pylist()}
    assert got == set()  # two parts: only pairs across parts are looked at
    cell = cell.set_column(0, "part", pa.array([0, 0, 0, 0]))
    got = {(r["a"], r["b"]) for r in nd._cell_links(cell).to_pylist()}
    assert got == {(1, 2), (3, 4)}


def test_small_table_equals_brute_force(spark):
    from costlens.llm.queries import op8_near_dedup

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = near_groups(docs)
    got = {r.doc_id: r.component_id for r in op8_near_dedup(spark, sf).collect()}
    assert got == want


def test_one_document_of_each_group_stays(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, "q r s t u"), (3, "q r s t u"), (None, "n")]
    out = nd.keep_one_per_group(frame(spark, rows))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"]
    assert out.columns == ["doc_id", "text", "kept", "rep", "bucket"]
