import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from costlens.llm import sharding


def rows_of(spark, docs):
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, shard string, size int")
    return sharding.assign(df).collect()


def check_law(rows, docs):
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["size"]
    return np.array([sizes[s] for s in range(40)])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_sizes_are_near_equal_and_groups_whole(spark, sf):
    from costlens.llm.queries import op6_sharding

    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = op6_sharding(spark, f"/root/testdata/{sf}").collect()
    sizes = check_law(rows, docs)
    assert sizes.max() < 1.02 * sizes.mean() and sizes.min() > 0.95 * sizes.mean()
    shard = {r.doc_id: r.shard for r in rows}
    groups = defaultdict(set)
    for i, t in docs:
        groups[t].add(shard[i])
    assert all(len(s) == 1 for s in groups.values())


def test_hot_group_is_cut(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 5)
    docs = [(i, "copy of the same text, again and again") for i in range(2000)]
    docs += [(10_000 + i, "other " * (i % 50)) for i in range(4000)]
    sizes = check_law(rows_of(spark, docs), docs)
    assert sizes.max() < 1.05 * sizes.mean() and sizes.min() > 0.95 * sizes.mean()


def test_small_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELLS", 400)
    docs = [(i, f"text {i} " * (1 + i % 17)) for i in range(3000)]
    sizes = check_law(rows_of(spark, docs), docs)
    assert sizes.max() < 1.1 * sizes.mean()


def test_edges(spark):
    docs = [(1, None), (None, None), (2, ""), (3, "é"), (3, "é"), (4, "long " * 50_000), (5, "x"), (5, "y")]
    check_law(rows_of(spark, docs), docs)
    assert rows_of(spark, [(1, None)])[0].slot == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign(empty).count() == 0


def test_packing_balances_all_dimensions():
    rng = np.random.default_rng(4)
    v = rng.lognormal(0, 1, (4000, 3))
    v /= v.sum(axis=0) / 8
    out = sharding.pack(v, 8)
    loads = np.array([v[out == s].sum(axis=0) for s in range(8)])
    assert abs(loads - 1).max() < 0.1 and abs(loads[:, 0] - 1).max() < 0.02
