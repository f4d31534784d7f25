"""Operator 7: benchmark decontamination by winnowing.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.  A
benchmark *window* is 10 consecutive words of an item; an item of fewer words
(but not none) is one window.  A document word is hit if it lies inside any
occurrence of a window.

Winnowing.  A text's fingerprints are the smallest 5-gram hash of every 6
consecutive 5-grams, i.e. of every 10 words, so a span of 10 words has the same
fingerprint, at the same place, wherever it occurs: every shared span of that
length is found.  Each benchmark window is stored under its fingerprint.  A
document position whose fingerprint may be a benchmark one (bitmap of bounded
size) leaves the scan with the 15 words around it; it is joined with the
windows on the fingerprint and extended to whole windows, compared word by
word.  The union of all windows is the maximal extension of every hit.

Items of fewer than 10 words are windows of their own length n; their
fingerprint is the smallest k-gram hash with k = min(5, n), and document
positions of those (at most nine) lengths are fingerprinted window by window.

Texts never cross the network: only the words around candidate positions do.
Equal windows of different items are stored once, and items are joined by
window id at the end, so repeated benchmark rows do not multiply the hits.

Defined results: a null or wordless text has no words and no hits; a null or
wordless item has no windows and occurs nowhere; every row is a document of its
own, whether its doc_id is null, repeated or neither, and rows without hits stay
clean beside others of their id that have some; rows of the benchmark with one
item_id are one item; empty tables give empty results or no hits; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import (
    KeyFilter,
    Workspace,
    byte_table,
    hash_grams,
    hash_words,
    map_batches,
    mix64,
    sha256_hex,
    split_by_keys,
    text_buffer,
)

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 50_000  # windows of about 100 bytes

_SEPARATORS = bytes(b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123))
_TABLE = byte_table(_SEPARATORS)


def winnow(words: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``window`` words: the index of its fingerprint gram.

    The fingerprint is the smallest gram hash, the rightmost on ties.
    """
    k = min(GRAM, window)
    grams = hash_grams(words, k)
    span = window - k + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    low = grams[:n].copy()
    for i in range(1, span):
        here = grams[i : i + n]
        new = here <= low
        best[new] = (np.arange(n) + i)[new]
        low[new] = here[new]
    return best


def _finger(gram_hash: np.ndarray, window: int) -> np.ndarray:
    """Fingerprints of different window lengths never meet."""
    return mix64(gram_hash + np.uint64(window)).view(np.int64)


def _words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    return " ".join(_TABLE[raw[s:e]].tobytes().decode() for s, e in zip(starts, ends))


WINDOW_SCHEMA = "item_id string, length int, finger long, at int, words string"


def _window_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Benchmark windows: fingerprint, its word index in the window, the words."""
    raw, offsets = text_buffer(batch.column(1))
    words, starts, ends, first = hash_words(raw, offsets, _TABLE)
    items = batch.column(0).to_pylist()
    out: list[tuple] = []
    for row, (lo, hi) in enumerate(zip(first[:-1], first[1:])):
        n = min(WINDOW, hi - lo)
        if not n:
            continue
        own = words[lo:hi]
        grams = _finger(hash_grams(own, min(GRAM, n)), n)
        for begin, gram in enumerate(winnow(own, n)):
            span = slice(lo + begin, lo + begin + n)
            text = _words(raw, starts[span], ends[span])
            out.append((items[row], int(n), int(grams[gram]), int(gram - begin), text))
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)],
        names=["item_id", "length", "finger", "at", "words"],
    )


CANDIDATE_SCHEMA = (
    "row long, doc_id long, mark long, n_words long, length int, finger long, pos long, before int, "
    "around array<string>"
)


def _candidates(held, lengths: list[int]):
    """Per document one row with its word count, and one per candidate position."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, offsets = text_buffer(batch.column(3))
        words, starts, ends, first = hash_words(raw, offsets, _TABLE)
        counts = np.diff(first)
        docs, length, finger, pos, before, around = [], [], [], [], [], []
        for n in lengths:
            k = min(GRAM, n)
            # Windows over two rows only add positions, which the test below rejects.
            picked = np.unique(winnow(words, n))
            if not len(picked):
                continue
            grams = _finger(hash_grams(words, k), n)
            hit = picked[held(grams[picked])]
            row = np.searchsorted(first, hit, side="right") - 1
            inside = hit + k <= first[row + 1]  # the gram does not cross a row bound
            for g, r in zip(hit[inside].tolist(), row[inside].tolist()):
                lo, hi = int(first[r]), int(first[r + 1])
                a, b = max(lo, g - (n - k)), min(hi, g + n)
                if b - a < n:
                    continue  # no whole window around it
                docs.append(r)
                length.append(n)
                finger.append(int(grams[g]))
                pos.append(g - lo)
                before.append(g - a)
                around.append(_words(raw, starts[a:b], ends[a:b]).split(" "))
        rows = np.concatenate([np.arange(batch.num_rows), np.array(docs, np.int64)])
        blank = [None] * batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i).take(pa.array(rows)) for i in range(3)),
                pa.array(counts.tolist() + [None] * len(docs), pa.int64()),
                pa.array(blank + length, pa.int32()),
                pa.array(blank + finger, pa.int64()),
                pa.array(blank + pos, pa.int64()),
                pa.array(blank + before, pa.int32()),
                pa.array(blank + around, pa.list_(pa.string())),
            ],
            names=["row", "doc_id", "mark", "n_words", "length", "finger", "pos", "before", "around"],
        )

    return run


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a benchmark-sized table if it is small, else leave it to a shuffle join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def text_mark(docs: DataFrame) -> Column:
    """A hash of the text: with the doc_id, rows of equal mark have equal texts."""
    return F.xxhash64(docs["text"].cast("string"))


def scan(
    ws: Workspace, docs: DataFrame, benchmark: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, hits, items): word counts; hit windows; items of each window.

    ``hits`` holds (row, doc_id, mark, pos, length, window): a window's words occur in
    the document from word ``pos`` on.  ``row`` numbers the documents of the scan as it
    was written; (doc_id, mark), mark the text's hash, finds them in their own table.
    """
    items = benchmark.select(
        benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].cast("string")
    )
    found = ws.keep(map_batches(items, _window_batch, WINDOW_SCHEMA), "item-windows")
    named = found.withColumn("window", sha256_hex(F.col("words")))
    owners = ws.keep(named.select("window", "item_id").distinct(), "owners")
    windows = ws.keep(
        named.groupBy("window").agg(
            *(F.first(c).alias(c) for c in ("length", "finger", "at", "words"))
        ),
        "windows",
    )
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most 10
    held = KeyFilter(windows.select("finger").distinct(), "finger", per_key=1024).lookup()
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        text_mark(docs).alias("mark"),
        docs["text"].cast("string").alias("text"),
    )
    scanned = ws.keep(map_batches(texts, _candidates(held, lengths), CANDIDATE_SCHEMA), "scanned")
    candidates = scanned.filter("finger is not null").drop("n_words")
    # the window would begin ``at`` words before the fingerprint
    begin = F.col("before") - F.col("at")
    same = F.array_join(F.slice("around", begin + 1, F.col("length")), " ") == F.col("words")
    hits = (
        candidates.join(_small(windows), ["finger", "length"])
        .filter(begin >= 0)
        .filter(same)
        .select("row", "doc_id", "mark", (F.col("pos") - F.col("at")).alias("pos"), "length", "window")
    )
    return scanned.filter("n_words is not null").select("row", "doc_id", "n_words"), hits, owners


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document."""
    ws = Workspace(docs.sparkSession, "decontaminate")
    documents, hits, owners = scan(ws, docs, benchmark)
    hits = ws.keep(hits, "hits")
    # words inside the union of the windows, window by window in text order
    end = F.col("pos") + F.col("length")
    before = (
        Window.partitionBy("row")
        .orderBy("pos", "length")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.greatest("pos", F.coalesce(F.max(end).over(before), F.lit(0)))
    n_hit = (
        hits.select("row", F.greatest(end - reached, F.lit(0)).alias("new"))
        .groupBy("row")
        .agg(F.sum("new").alias("n_hit"))
    )
    items = (
        hits.select("row", "window")
        .distinct()
        .join(_small(owners), "window")
        .select("row", "item_id")
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    out = documents.join(n_hit.join(items, "row"), "row", "left")
    n = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        n.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        sha256_hex(F.array_join(names, ",")).alias("items_sha256"),
        (n > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, all columns as they came.

    Only rows whose text may be a contaminated one are shuffled.
    """
    ws = Workspace(docs.sparkSession, "decontaminate")
    _, hits, _ = scan(ws, docs, benchmark)
    bad = ws.keep(hits.select("doc_id", "mark").distinct(), "contaminated")
    free, maybe = split_by_keys(docs, text_mark(docs), bad.select("mark"))
    same = maybe["doc_id"].cast("long").eqNullSafe(bad["doc_id"]) & (text_mark(maybe) == bad["mark"])
    return free.unionByName(maybe.join(bad, same, "left_anti"))
