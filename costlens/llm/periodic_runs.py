"""Operator 13: periodic runs of words, found with string synchronising sets.

A *stretch* of period p is a maximal block of words in which words p apart are
equal and whose smallest period is p.  All stretches of three periods or more are
found; those of four or more (and of six words or more) are the runs reported.

Periods p below ``FIRST`` are found directly, by comparing each word with the one p
further on.  For every dyadic scale s from 4 on, the periods 1.5 s <= p < 3 s are
proposed by a synchronising set: position i belongs to it if the smallest hash
among the s-word windows starting at i .. i+s is that of the first or of the last
of them.  Whether a position belongs depends on its 2s words alone, so equal
contexts are chosen alike wherever they stand.  Windows inside a highly periodic
region (period up to s/3) take no part: the smaller scales found these regions
already, and with them the small periods this scale leaves out.  Chosen positions
with equal contexts (2s words, or 3s for the longer periods) that follow each
other at a distance p propose the period p.

Why none is lost: in a stretch of three periods p some chosen position lies among
the first max(s, p - 5s/3 + 1), since otherwise its windows would all share a
period of at most s/3 and so would the stretch; that position and the one p
further on have equal contexts inside the stretch; and a context at least p - 1
words long does not come back within a stretch at a distance below p.

A proposal is compared word by word with the text and extended to both sides until
it ends, so a wrong one does no harm.  Words are numbered exactly; window hashes
have 64 bits, and a collision could only hide a run by lying inside it.  The work
is the words times the scales, done for many documents at once; scales that a
document is too short for leave it out.

Defined results: null or empty texts, and those of white space alone, have no words,
no runs and an empty ``collapsed``; a null key is kept as it is; repeated rows give
repeated results; an empty table gives an empty result; further input columns,
whatever their names, are ignored.  A text of any length is taken whole, by one
task, at about 100 bytes of memory a word.  One pass over the texts, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import map_batches, mix64, sha256_hex

MIN_WORDS = 6
MIN_PERIODS = 4
FIRST = 6  # the smallest period that synchronising sets propose (1.5 times their first scale)
GROUP_WORDS = 400_000  # documents are searched together up to this many words
SPLIT_BYTES = 1 << 20  # bytes cut into words at once

_LEFT, _RIGHT, _THIRD = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

Stretches = list[tuple[int, int, int]]  # (start, end, period)


class Numbers(dict):
    """Numbers words in the order they come; ``words`` lists them."""

    def __init__(self):
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n

    def of(self, raw: bytes) -> np.ndarray:
        """The word numbers of a text, cut in parts that end at white space."""
        parts, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + SPLIT_BYTES)
            while end < len(raw) and raw[end : end + 1].strip():
                end += 1
            words = raw[at:end].split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.int32, len(words)))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def blocks(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the blocks of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def short_periods(words: np.ndarray) -> Stretches:
    """All stretches of three periods or more with a period below ``FIRST``."""
    found: Stretches = []
    by_period: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for p in range(1, FIRST):
        if len(words) <= p:
            break
        start, end = blocks(words[:-p] == words[p:])
        end = end + p
        long = end - start >= 3 * p
        start, end = start[long], end[long]
        for q in range(1, p):
            if p % q == 0 and len(start) and len(by_period[q][0]):
                own_start, own_end = by_period[q]
                at = np.searchsorted(own_start, start, "right") - 1
                smaller = (at >= 0) & (own_end[at] >= end)  # its smallest period is q
                start, end = start[~smaller], end[~smaller]
        by_period[p] = start, end
        found += zip(start.tolist(), end.tolist(), [p] * len(start))
    return found


def sliding_min(values: np.ndarray, reach: int) -> np.ndarray:
    """Minimum of values[i : i + reach + 1], reach a power of two (shorter at the end)."""
    low, step = values.copy(), 1
    while step < reach:  # low covers ``step`` values
        low[:-step] = np.minimum(low[:-step], low[step:])
        step *= 2
    out = low.copy()
    out[:-reach] = np.minimum(low[:-reach], values[reach:])
    return out


def synchronising(hashes: np.ndarray, scale: int, periodic: Stretches) -> np.ndarray:
    """The chosen positions at one scale; ``periodic`` are the regions left out."""
    ids = hashes.copy()
    if periodic:
        marks = np.zeros(len(ids) + 1, np.int32)
        start, end, _ = np.array(periodic).T
        np.add.at(marks, start, 1)
        np.add.at(marks, end - scale + 1, -1)
        ids[np.cumsum(marks[:-1]) > 0] = _NONE
    low = sliding_min(ids, scale)
    chosen = ids == low
    chosen[:-scale] |= ids[scale:] == low[:-scale]
    return np.flatnonzero(chosen & (low != _NONE))


def proposals(at: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of chosen positions whose next equal context is low..high on."""
    if high < low or len(at) < 2:
        return at[:0], at[:0]
    keys = context[at]
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    distance = np.diff(at)
    pick = (keys[1:] == keys[:-1]) & (distance >= low) & (distance <= high)
    return at[:-1][pick], distance[pick]


def merged(at: np.ndarray, period: np.ndarray, context: int) -> Stretches:
    """Proposals of one period that overlap by a period or more, as one block each."""
    if not len(at):
        return []
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(period) != 0) | (np.diff(at) > context)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    ends = at[last] + period[last] + context
    return list(zip(at[first].tolist(), ends.tolist(), period[first].tolist()))


def extended(words: np.ndarray, start: int, end: int, p: int) -> tuple[int, int] | None:
    """The maximal block of period p around words[start:end]; None if it has no such period."""
    if not np.array_equal(words[start : end - p], words[start + p : end]):
        return None  # windows of equal hash, not of equal words
    step = p
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + p : start + p])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, 2 * step
    step = p
    while end < len(words):
        high = min(len(words), end + step)
        differ = np.flatnonzero(words[end - p : high - p] != words[end:high])
        if len(differ):
            end += int(differ[0])
            break
        end, step = high, 2 * step
    return start, end


def stretches(texts: list[np.ndarray]) -> list[Stretches]:
    """Per text of word numbers: its stretches of three periods or more, by start and period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    kept = np.arange(len(texts))  # texts still looked at
    out: list[Stretches] = [[] for _ in texts]

    def joined(parts: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        return np.concatenate([x for part, end in zip(parts, ends) for x in (part, end)])

    # a sign of its own ends every text, so that no two blocks across an end are equal
    words = joined([t.astype(np.int64) for t in texts], -1 - kept[:, None])
    begins = np.cumsum(lengths + 1) - lengths - 1

    def add(found: Stretches) -> None:
        if not found:
            return
        of = np.searchsorted(begins, [start for start, _, _ in found], "right") - 1
        for k, (start, end, p) in zip(of.tolist(), found):
            base = int(begins[k])
            out[kept[k]].append((start - base, end - base, p))

    add(short_periods(words))
    hashes, scale = mix64(words.view(np.uint64) * _LEFT + _RIGHT), 1
    while True:
        if 2 * scale >= FIRST:
            fit = 2 * lengths[kept] >= 9 * scale  # three periods of 1.5 scales
            if not fit.any():
                break
            rest = int((lengths[kept] + 1)[fit].sum())
            if 2 * rest <= len(words):  # short texts leave
                own = np.repeat(fit, lengths[kept] + 1)
                words, hashes, kept = words[own], hashes[own], kept[fit]
                begins = np.cumsum(lengths[kept] + 1) - lengths[kept] - 1
            double = hashes * _LEFT
            double[:-scale] += hashes[scale:] * _RIGHT
            double = mix64(double)
            triple = double * _LEFT
            triple[: -2 * scale] += hashes[2 * scale :] * _THIRD
            triple = mix64(triple)
            periodic = [
                (int(begins[k]) + start, int(begins[k]) + end, p)
                for k, text in enumerate(kept.tolist())
                for start, end, p in out[text]
                if 3 * p <= scale <= end - start
            ]
            at = synchronising(hashes, scale, periodic)
            found = set()
            for context, size, low, high in (
                (double, 2 * scale, (3 * scale + 1) // 2, min(2 * scale + 1, 3 * scale - 1)),
                (triple, 3 * scale, 2 * scale + 2, 3 * scale - 1),
            ):
                for start, end, p in merged(*proposals(at, context, low, high), size):
                    whole = extended(words, start, end, p)
                    if whole is not None and whole[1] - whole[0] >= 3 * p:
                        found.add((*whole, p))
            add(sorted(found))
            hashes = double
        else:
            double = hashes * _LEFT
            double[:-scale] += hashes[scale:] * _RIGHT
            hashes = mix64(double)
        scale *= 2
    for text in out:
        text.sort(key=lambda s: (s[0], s[2]))
    return out


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _results(keys: list[pa.Scalar], key_type: pa.DataType, names: list[str], numbers: Numbers, texts: list[np.ndarray]):
    found = stretches(texts)
    all_runs, collapsed = [], []
    for own, text in zip(found, texts):
        runs = [
            {"start": start, "length": end - start, "period": p}
            for start, end, p in own
            if end - start >= max(MIN_WORDS, MIN_PERIODS * p)
        ]
        keep = np.ones(len(text), bool)
        for r in runs:
            keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
        all_runs.append(runs)
        collapsed.append(b" ".join(map(numbers.words.__getitem__, text[keep].tolist())))
    columns = [
        pa.array([k.as_py() for k in keys], key_type),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array(all_runs, _RUNS_TYPE),
        pa.array(collapsed, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def repeated_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, n_words, runs (start, length, period; by start and period) and collapsed.

    ``collapsed`` holds the words joined by one space, without those that a run
    repeats: each run keeps its first period.  It is UTF-8 in a binary column.
    """
    names = [key, "n_words", "runs", "collapsed"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, texts, numbers, words = [], [], Numbers(), 0
        for own, value in zip(batch.column(0), batch.column(1)):
            keys.append(own)
            texts.append(numbers.of(value.as_py() or b""))
            words += len(texts[-1])
            if words >= GROUP_WORDS:
                yield _results(keys, batch.column(0).type, names, numbers, texts)
                keys, texts, numbers, words = [], [], Numbers(), 0
        if keys:
            yield _results(keys, batch.column(0).type, names, numbers, texts)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words long, runs {RUNS}, collapsed binary"
    rows = docs.select(docs[key], docs[text].cast("string").cast("binary").alias("text"))
    return map_batches(rows, run, schema)


def planted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and text, every tenth text or so with words repeated as its key's crc32 says.

    With h = crc32(decimal key), g = floor(h / 10) and n words, n > 0 and h % 10 = 0:
    word i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).
    The other texts, those of null keys too, stay as they are.
    """
    h = F.crc32(docs[key].cast("string"))
    rows = docs.select(
        docs[key],
        docs[text].cast("string").alias("text"),
        F.floor(h / 10).alias("g"),
        F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"),
    )
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))

    def source(i: Column) -> Column:
        moved = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.element_at("words", (moved + 1).cast("int"))

    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), source), " ")
    return rows.select(key, F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The columns of the query: the run of greatest exponent and digests of all runs and words."""
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    # by start and period, so that a tie leaves the earlier one
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda top, r: F.when(
            top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r
        ).otherwise(top),
    )
    top = F.col("top")
    return found.withColumn("top", best).select(
        F.col(key),
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        sha256_hex(text).alias("runs_sha256"),
        sha256_hex(F.col("collapsed")).alias("collapsed_sha256"),
    )
