"""Operator 12: spelling variants, grouped by asymmetric q-chunks.

Words are counted over all texts (maximal runs of Latin letters, A-Z lower-cased);
those of at least ``MIN_CHARS`` characters and ``MIN_COUNT`` occurrences take part.  Two
words are near if one inserted, deleted or replaced character turns one into the
other.

The shorter word of a pair (either, if equally long) contributes **two disjoint
chunks**, its halves; the other contributes its positional grams of the chunks'
lengths.  One edit spoils one chunk at most, so the other comes back in the second
word, where it stood or one further on, and the two words meet there: the first
chunk in place, the second shifted by the difference in length.  Grams at other
places cannot meet a chunk within shift one and are not sent.  Every meeting is
verified by the edit distance of the whole words.

Hot chunks.  Where a chunk's group would make more than ``PAIRS`` comparisons, the
same rule is applied to what the chunk leaves over: the rest of the shorter word
is cut into two chunks again, one of which survives the edit, and the words meet
on both chunks.  This repeats until groups are small or the rest is a single
character, when a group holds no more words than one character has values (twice
that power for the longer words).  No pair is lost, no group is taken whole.  Which
chunks are cut again is told by a bitmap of bounded size (``KeyFilter``); if it lets
further chunks through they are cut too, which changes no result.

Each word's *form* is its near word of largest count (ties: the smaller one in
code-point order) if that count is at least ``RATIO`` times its own, else null;
its *root* is where the forms lead to.  Counts grow by ``RATIO`` at each step, so
the chains are as long as a logarithm of the largest count, and doubling their
steps ends after the logarithm of that.

Defined results: null and empty texts have no words; a null key is written as the
empty string where keys matter (``drop_every``); repeated rows count again; an
empty table gives an empty result; further input columns, whatever their names, are
ignored.  Whole texts are read, in stretches.  Counts are added up in the tasks
(at most ``COUNTS_KEPT`` words at a time) before they are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import Workspace, bound_batches, split_by_keys

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
PAIRS = 1024  # comparisons of one chunk's group; larger groups are cut again
COUNTS_KEPT = 200_000
STRETCH = 1 << 20


def letter_table() -> bytes:
    """Latin-1 letters U+00C0-U+00FF and a-z as they are, A-Z lower-cased, others a blank."""
    out = bytearray(b" " * 256)
    for c in (*range(0x61, 0x7B), *range(0xC0, 0x100)):
        out[c] = c
    for c in range(0x41, 0x5B):
        out[c] = c + 32
    return bytes(out)


LETTERS = letter_table()


def words_of(text: str) -> Counter:
    """Lower-cased runs of letters of a text (Latin-1 bytes) and how often they occur."""
    # a character beyond Latin-1 becomes one sign that is no letter
    raw = text.encode("latin-1", "replace").translate(LETTERS)
    found: Counter = Counter()
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + STRETCH) if len(raw) - at > STRETCH else len(raw)
        end = len(raw) if end < 0 else end
        found.update(raw[at:end].split())
        at = end
    return found


def misspelt(word: bytes, prefix: int, every: int) -> bytes:
    """The word (Latin-1) less one character, if its hash after ``prefix`` says so."""
    h = crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    drop_every: int = 0,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """word, n: all words of ``min_chars`` characters and ``min_count`` occurrences.

    With ``drop_every`` (a planting of misspellings, for trials) a word loses the
    character h % length wherever that number divides h = crc32(``<key>:<word>``).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for own, value in zip(batch.column(0), batch.column(1)):
                found = words_of(value.as_py() or "")
                prefix = crc32(f"{own.as_py() or ''}:".encode()) if drop_every else 0
                for word, n in found.items():
                    if len(word) < min_chars:
                        continue
                    if drop_every:
                        word = misspelt(word, prefix, drop_every)
                        if len(word) < min_chars:
                            continue
                    total[word] += n
                if len(total) >= COUNTS_KEPT:
                    yield out()
                    total.clear()
        if total:
            yield out()

    bound_batches(docs.sparkSession)
    rows = docs.select(docs[key].cast("string"), docs[text].cast("string"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _whole(words: DataFrame, min_chars: int) -> DataFrame:
    """Every word as a shorter or equally long one (shift 0) and as the longer one (shift 1).

    ``size`` characters of the shorter word, from ``at`` on, are not matched yet; the
    longer word has ``shift`` more.  ``key`` holds the shorter word's length and,
    later, the chunks matched.
    """
    length = F.length("word")
    shift = F.explode(F.when(length > min_chars, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = words.select("word", "n", shift.alias("shift"))
    size = F.length("word") - F.col("shift")
    return rows.select(
        "word", "n", "shift", F.lit(0).alias("at"), size.alias("size"), size.cast("long").alias("key")
    )


def _cut(rows: DataFrame) -> DataFrame:
    """The unmatched stretch cut into its two chunks: a row for each of them as the match."""
    half = F.floor(F.col("size") / 2).cast("int")

    def met(which: int, start: Column, length: Column, at: Column, size: Column) -> Column:
        chunk = F.substring("word", start + 1, length)
        key = F.xxhash64("key", F.lit(which), chunk)
        return F.struct(at.alias("at"), size.alias("size"), key.alias("key"))

    first = met(0, F.col("at"), half, F.col("at") + half, F.col("size") - half)
    second = met(1, F.col("at") + half + F.col("shift"), F.col("size") - half, F.col("at"), half)
    cut = rows.select("word", "n", "shift", F.explode(F.array(first, second)).alias("c"))
    return cut.select("word", "n", "shift", "c.at", "c.size", "c.key")


def near_pairs(ws: Workspace, words: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """a, a_n, b, b_n: every pair of near words once, the shorter (smaller) one first."""
    rows, found = _whole(words, min_chars), []
    while True:
        rows = ws.keep(_cut(rows), "chunks")
        sizes = rows.groupBy("key").agg(
            F.count_if(F.col("shift") == 0).alias("chunks"),
            F.count("*").alias("grams"),
            F.min("size").alias("size"),
        )
        hot = sizes.filter((F.col("chunks") * F.col("grams") > PAIRS) & (F.col("size") > 1)).select("key")
        hot = ws.keep(hot, "hot")
        again = not hot.isEmpty()
        met, rows = split_by_keys(rows, "key", hot) if again else (rows, None)
        chunk, gram = met.filter("shift = 0").alias("a"), met.alias("b")
        pairs = (
            chunk.join(gram, F.col("a.key") == F.col("b.key"))
            .filter((F.col("b.shift") == 1) | (F.col("a.word") < F.col("b.word")))
            .filter(F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
        )
        pairs = pairs.select(
            F.col("a.word").alias("a"), F.col("a.n").alias("a_n"),
            F.col("b.word").alias("b"), F.col("b.n").alias("b_n"),
        )
        found.append(ws.keep(pairs, "pairs"))
        if not again:
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def variants(ws: Workspace, words: DataFrame, min_chars: int = MIN_CHARS, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words (word, n) of ``word_counts``."""
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent, or they could lead in circles")
    pairs = ws.keep(near_pairs(ws, words, min_chars), "near")
    both = pairs.unionByName(
        pairs.select(
            F.col("b").alias("a"), F.col("b_n").alias("a_n"),
            F.col("a").alias("b"), F.col("a_n").alias("b_n"),
        )
    )
    top = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")))
    near = both.groupBy("a", "a_n").agg(F.count("*").alias("n_near"), top.alias("top"))
    frequent = -F.col("top.less") >= ratio * F.col("a_n")
    near = near.select(
        F.col("a").alias("word"),
        "n_near",
        F.when(frequent, F.col("top.form")).alias("form"),
        F.when(frequent, -F.col("top.less")).alias("form_n"),
    )
    near = ws.keep(near, "forms")

    chain = near.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    low, high = words.agg(F.min("n"), F.max("n")).first()
    longest = 1 + int(math.log(high / low, ratio)) if high else 0  # steps of the longest chain
    done = 1
    while done < longest:
        ahead = chain.select(F.col("word").alias("by"), F.col("root").alias("beyond"))
        chain = chain.join(ahead, chain["root"] == ahead["by"], "left").select(
            "word", F.coalesce("beyond", "root").alias("root")
        )
        chain = ws.keep(chain, "roots")
        done *= 2
    return (
        words.join(near, "word", "left")
        .join(chain, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


def spelling_groups(docs: DataFrame, drop_every: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Words of all texts with their near words' number, form and root."""
    ws = Workspace(docs.sparkSession, "spelling")
    words = ws.keep(word_counts(docs, drop_every=drop_every, text=text, key=key), "words")
    return variants(ws, words)
