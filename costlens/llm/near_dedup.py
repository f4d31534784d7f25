"""Operator 8: near-duplicate detection by fast similarity sketching.

A document's set holds the distinct 4-word shingles of its text, lower-cased
A-Z, words being runs of anything but ASCII white space (one shingle of all its
words when there are fewer than four).  Two documents are linked when
``100 * |A & B| >= 80 * |A | B|``; a group is a connected component of links.

Sketch.  In round i < T every shingle is hashed to one of T bins with a value
between i and i + 1; in round T + j every shingle goes to bin j.  A bin keeps its
smallest value and a set leaves as soon as all its bins are filled, so every
coordinate is filled after at most 2T rounds, a coordinate of two sets agrees
with the probability of their similarity, and the share of equal coordinates is
concentrated around it like that of independent samples.

Candidates.  32 bands of 4 coordinates: a pair at the threshold shares no band
with probability (1 - 0.8^4)^32 < 5e-8.  Equal sets are merged first, so a group
of copies enters as one representative.  No bucket emits all its pairs:

1. each bucket pairs its smallest and its largest member with the others;
2. the pairs are verified and the links joined into components;
3. where a bucket still holds members of several components, its members are
   dealt to cells of bounded size and all links between different components are
   found in each cell by counting shared shingles in an inverted index; a cell
   returns only the links that join components.

Pairs inside a component need no test, so nothing that could change a component
is left out.  A candidate of step 1 is dropped before the exact test only if its
set sizes rule the threshold out, or if fewer than ``MIN_EQUAL`` of the 128
coordinates agree (for a pair at the threshold less likely than 1e-10).  All
others are compared on their full sets.

Components are found by alternating large-star and small-star steps on the link
table; nothing is collected to the driver.

Defined results: a null or blank text has an empty set, is linked with nothing
and forms its own group; rows that share a doc_id are one document as far as
links go, and each row is returned; a null doc_id is returned unlinked with a
null component and kept; an empty table gives an empty result; further columns
are ignored.  Long texts are tokenized in bounded pieces; equal results for ties.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import (
    KeyFilter,
    Workspace,
    bound_batches,
    byte_table,
    hash_grams,
    hash_words,
    map_batches,
    mix64,
    spare_name,
    split_by_keys,
    text_buffer,
)

SHINGLE = 4
BINS = 128  # T, a power of two
BANDS = 32
ROWS = BINS // BANDS
MIN_EQUAL = 70
THRESHOLD = 80  # per cent
CELL_WEIGHT = 400_000  # shingles of a cell's part; a row adds CELL_ROW to its own
CELL_ROW = 100
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"

_TABLE = byte_table(SEPARATORS)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = mix64(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_BAND_KEYS = mix64(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a column."""
    raw, offsets = text_buffer(column)
    words, _, _, first = hash_words(raw, offsets, _TABLE)
    out = []
    for lo, hi in zip(first[:-1], first[1:]):
        own = words[lo:hi]
        k = min(SHINGLE, len(own))
        out.append(np.unique(hash_grams(own, k)) if k else own)
    return out


def similarity_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The sketch of every non-empty set: one row of ``BINS`` coordinates each."""
    n = len(sets)
    sketch = np.full((n, BINS), _EMPTY)
    flat = sketch.reshape(-1)
    items = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    for i in range(2 * BINS):
        if not len(items):
            break
        h = mix64(items ^ _SEEDS[i])
        bins = (h & np.uint64(BINS - 1)).astype(np.int64) if i < BINS else i - BINS
        value = (h >> np.uint64(8)) | np.uint64(min(i, 255) << 56)
        np.minimum.at(flat, owner * BINS + bins, value)
        open_ = (sketch == _EMPTY).any(axis=1)[owner]
        items, owner = items[open_], owner[open_]
    return sketch


def band_hashes(sketch: np.ndarray) -> np.ndarray:
    """One hash per band of ``ROWS`` coordinates; bands never share a hash by design."""
    weighted = sketch * _BAND_KEYS
    joined = weighted.reshape(len(sketch), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
    return mix64(joined + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


SKETCH_SCHEMA = (
    "doc_id long, n_shingles long, sig_a long, sig_b long, bands array<long>, sketch binary"
)


def _sketch_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sets = shingle_sets(batch.column(1))
    full = [i for i, s in enumerate(sets) if len(s)]
    sketch = similarity_sketches([sets[i] for i in full])
    bands = band_hashes(sketch)
    short = mix64(sketch).astype("<u2")
    n = len(sets)
    sig = [None] * n
    band_col, sketch_col = [None] * n, [None] * n
    for row, i in enumerate(full):
        digest = xxhash.xxh3_128_intdigest(sets[i].tobytes())
        sig[i] = ((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63))
        band_col[i], sketch_col[i] = bands[row], short[row].tobytes()
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(0).cast(pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([x and x[0] for x in sig], pa.int64()),
            pa.array([x and x[1] for x in sig], pa.int64()),
            pa.array(band_col, pa.list_(pa.int64())),
            pa.array(sketch_col, pa.binary()),
        ],
        names=["doc_id", "n_shingles", "sig_a", "sig_b", "bands", "sketch"],
    )


def _likely_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Drop pairs that set sizes or the sketches rule out."""
    n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
    side = [
        np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, BINS)
        for i in (4, 5)
    ]
    equal = (side[0] == side[1]).sum(axis=1)
    keep = (equal >= MIN_EQUAL) & (
        100 * np.minimum(n_a, n_b) >= THRESHOLD * np.maximum(n_a, n_b)
    )
    yield pa.RecordBatch.from_arrays(
        [batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"]
    )


def _linked_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose full sets reach the threshold."""
    a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    keep = []
    left, right = batch.column(2), batch.column(3)
    before, set_a = None, None
    sets_b = shingle_sets(right)
    for i in range(len(a)):
        text = left[i]
        if before is None or text != before:
            before, set_a = text, shingle_sets(left.slice(i, 1))[0]
        both = len(np.intersect1d(set_a, sets_b[i], assume_unique=True))
        keep.append(100 * both >= THRESHOLD * (len(set_a) + len(sets_b[i]) - both))
    keep = pa.array(keep, pa.bool_())
    yield pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()).filter(keep), pa.array(b, pa.int64()).filter(keep)],
        names=["a", "b"],
    )


def _fetch(ws: Workspace, docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the documents in ``ids`` (column doc_id), read once, in one table."""
    held = KeyFilter(ids, "doc_id").lookup()

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = held(batch.column(0).to_numpy(zero_copy_only=False))
        yield batch.filter(pa.array(keep))

    few = map_batches(docs.filter("doc_id is not null"), some, "doc_id long, text string")
    return ws.keep(few.join(ids, "doc_id", "left_semi"), "texts")


def _verified(ws: Workspace, docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) that are links."""
    side = reps.select("rep", "n_shingles", "sketch")
    joined = pairs.join(side.toDF("b", "n_b", "s_b"), "b").join(side.toDF("a", "n_a", "s_a"), "a")
    joined = joined.select("a", "b", "n_a", "n_b", "s_a", "s_b")
    likely = ws.keep(map_batches(joined, _likely_batch, "a long, b long"), "likely")
    ids = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = _fetch(ws, docs, ws.keep(ids, "tried"))
    both = likely.join(texts.toDF("b", "t_b"), "b").join(texts.toDF("a", "t_a"), "a")
    linked = map_batches(both.select("a", "b", "t_a", "t_b"), _linked_batch, "a long, b long")
    return ws.keep(linked.distinct(), "links")


def _cell_links(cell: pa.Table) -> pa.Table:
    """Links that join components among the members of one cell.

    A cell holds two parts of a bucket (or one part with itself); parts are
    compared with each other.  Per member, shared shingles are counted over the
    inverted index of the cell.
    """
    part = cell["part"].to_numpy()
    rep, label = cell["rep"].to_numpy(), cell["label"].to_numpy()
    sets = shingle_sets(cell["text"])
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    items = np.concatenate(sets)
    order = np.argsort(items, kind="stable")
    owner = owner[order]
    _, first, count = np.unique(items[order], return_index=True, return_counts=True)
    place = np.empty(len(items), np.int64)  # index of each shingle in the vocabulary
    place[order] = np.repeat(np.arange(len(first)), count)
    bounds = np.concatenate([[0], np.cumsum(sizes)])

    root = {x: x for x in label.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    two = part.min() != part.max()
    main = Counter(label.tolist()).most_common(1)[0][0]
    a, b = [], []
    for i in np.flatnonzero(label != main):  # pairs inside the main component need no test
        own = place[bounds[i] : bounds[i + 1]]
        n = count[own]
        at = np.repeat(first[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        linked = 100 * both >= THRESHOLD * (sizes[i] + sizes - both)
        linked &= label != label[i]
        if two:
            linked &= part != part[i]
        for j in np.flatnonzero(linked):
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(min(rep[i], rep[j]))
                b.append(max(rep[i], rep[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def connected_components(ws: Workspace, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b).

    Alternating large-star and small-star steps; each ends in a written table.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        near = edges.unionByName(back) if large else edges  # edges have v < u
        least = ws.keep(near.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = near.join(least, "u")
        if large:  # larger neighbours move to the smallest of the neighbourhood
            moved = out.filter("v > u").select(
                F.col("v").alias("u"), F.least("u", "m").alias("v")
            )
        else:  # smaller neighbours and the node itself move to the smallest of them
            moved = out.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        moved = ws.keep(moved.distinct(), "star")
        ws.drop(least)
        return moved

    def digest(edges: DataFrame):
        return edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()

    edges = ws.keep(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    seen = digest(edges)
    while True:
        first = star(edges, large=True)
        after = star(first, large=False)
        ws.drop(edges, first)
        edges, now = after, digest(after)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def _star_pairs(ws: Workspace, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each bucket's smallest and largest member, and their pairs with the others."""
    ends = ws.keep(
        rows.groupBy("bucket")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .filter("low < high"),
        "bucket-ends",
    )
    met = rows.join(ends, "bucket")
    pairs = met.select(
        F.explode(
            F.array(
                F.struct(F.col("low").alias("a"), F.col("rep").alias("b")),
                F.struct(F.col("rep").alias("a"), F.col("high").alias("b")),
            )
        ).alias("p")
    ).select("p.a", "p.b")
    return ends, pairs.filter("a < b").distinct()


def _rest_links(
    ws: Workspace, docs: DataFrame, rows: DataFrame, ends: DataFrame, components: DataFrame
) -> DataFrame:
    """Links between components that still share a bucket (step 3)."""
    labelled = (
        rows.join(ends, "bucket")
        .filter("rep <> low and rep <> high")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select("bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("label"))
    )
    labelled = ws.keep(labelled, "open-rows")
    mixed = (
        labelled.groupBy("bucket")
        .agg(
            F.min("label").alias("x"),
            F.max("label").alias("y"),
            F.sum(F.col("n_shingles") + CELL_ROW).alias("weight"),
        )
        .filter("x < y")
        .select("bucket", F.ceil(F.col("weight") / CELL_WEIGHT).cast("int").alias("parts"))
    )
    mixed = ws.keep(mixed, "mixed-buckets")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    open_rows = ws.keep(
        labelled.join(mixed, "bucket").select("bucket", "rep", "label", "parts", part.alias("part")),
        "mixed-rows",
    )
    ids = ws.keep(open_rows.select(F.col("rep").alias("doc_id")).distinct(), "open")
    texts = _fetch(ws, docs, ids)
    # part p meets every part q: the cell is (smaller, larger)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = (
        open_rows.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
        .withColumn("q", other)
        .select(
            "bucket",
            F.least("part", "q").alias("p"),
            F.greatest("part", "q").alias("q"),
            "part",
            "rep",
            "label",
            "text",
        )
    )
    bound_batches(cells.sparkSession)
    found = cells.groupBy("bucket", "p", "q").applyInArrow(_cell_links, "a long, b long")
    return ws.keep(found.distinct(), "rest-links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    ws = Workspace(docs.sparkSession, "near-dedup")
    source = docs.select(
        docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")
    )
    table = ws.keep(map_batches(source, _sketch_batch, SKETCH_SCHEMA), "sketches")

    # Equal sets: one class, represented by its smallest document.
    named = table.filter("doc_id is not null and n_shingles > 0")
    sig = ["sig_a", "sig_b"]
    classes = ws.keep(named.groupBy(*sig).agg(F.min("doc_id").alias("rep")), "classes")
    members = table.select("doc_id", "n_shingles", *sig).join(classes, sig, "left")
    members = ws.keep(members.select("doc_id", "n_shingles", "rep"), "members")
    reps = named.join(classes, sig).filter("doc_id = rep")
    reps = ws.keep(reps.select("rep", "n_shingles", "bands", "sketch"), "representatives")
    rows = reps.select("rep", "n_shingles", F.explode("bands").alias("bucket"))

    ends, pairs = _star_pairs(ws, rows)
    links = _verified(ws, source, reps, pairs)
    # Rows with one doc_id are one document: their sets belong together.
    split = (
        members.groupBy("doc_id")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("high"))
        .filter("a < high")
    )
    split = split.join(members, "doc_id").filter("a < rep").select("a", F.col("rep").alias("b"))
    links = links.unionByName(split)
    components = connected_components(ws, links)
    rest = _rest_links(ws, source, rows, ends, components)
    if not rest.isEmpty():
        components = connected_components(ws, links.unionByName(rest))

    placed = members.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    out = placed.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, all columns as they came.

    Of rows that share a kept doc_id one stays; rows without a doc_id all stay.
    Only rows whose id may be a dropped or a repeated one are shuffled.
    """
    ws = Workspace(docs.sparkSession, "near-dedup")
    groups = near_duplicates(docs).filter("doc_id is not null")
    ids = ws.keep(
        groups.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("rows")),
        "decisions",
    )
    ids = ids.filter("not kept or rows > 1").select(F.col("doc_id").alias("id"), "kept")
    ids = ws.keep(ids, "contested")
    free, contested = split_by_keys(docs, "doc_id", ids.select("id"))
    dropped = ids.filter("not kept")
    kept = contested.join(dropped, contested["doc_id"].cast("long") == dropped["id"], "left_anti")
    once = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    place = spare_name(docs, "place")
    kept = kept.withColumn(place, F.row_number().over(once)).filter(F.col(place) == 1)
    return free.unionByName(kept.drop(place))
