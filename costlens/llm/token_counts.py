"""Operator 11: token counts by heap-and-linked-list byte-pair merging.

The tokenizer file is a merge list with word ends: a text is brought into NFC,
lower-cased character by character and cut by the file's own pattern; every
piece starts as its bytes, the last one marked as a word's end.  The symbols of a
piece form a doubly linked list and the ranks of its adjacent pairs a heap.  The
lowest rank is popped, leftmost pair first, its two symbols become one and the two
new pairs beside it are queued; a queued pair that has changed since is passed
over.  Each merge takes one symbol away, so **the count is the initial symbols
minus the merges**; no identifier is ever made.  Pairs of equal rank wait in one
list per rank, so the heap holds ranks, not positions, and a piece costs about
twenty bytes of memory per byte, whatever its length.  Counts of short pieces
and of short stretches between white space are memoised in one table of bounded size.

Strings of the file's added tokens inside a text are taken out first and count as
one token each, as the tokenizer library does by default; no begin, end or other
special tokens are added, nothing is cut off or padded.

Defined results: null text counts as empty (0 bytes, 0 tokens); a text of white
space alone has 0 tokens; repeated rows give repeated results; an empty table
gives an empty result; further input columns, whatever their names, are ignored.
A text of any length is counted whole, in stretches of about ``STRETCH``
characters that end at white space.  The file is read on the driver (its size is
fixed by the vocabulary, under ``MAX_FILE_BYTES``) and broadcast.  One pass over
the texts, no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from costlens.llm.common import map_batches

MAX_FILE_BYTES = 64 << 20
LIMIT = 2048  # tokens of a training sequence
STRETCH = 1 << 20  # characters looked at together
STRINGS_KEPT = 1_000_000  # memoised stretches and pieces per worker (about 120 MB)
KEPT_CHARS = 40
LONG = 4096  # bytes from which a piece is held in arrays of machine integers
GONE = -(1 << 30)  # a symbol merged into the one before it; makes no pair

WHITE = regex.compile(r"\p{White_Space}+")
# Capitals that str.lower gets wrong.  It turns a sigma at a word's end
# into another letter, and does not know the two letters of Unicode 16 yet.
CAPITALS = {"Σ": "σ", "\ua7cb": "\u0264", "\ua7dc": "\u019b"}
# Control signs that str.split takes for white space, unlike the Unicode property.
NOT_WHITE = regex.compile(r"[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Bytes that print as themselves in Latin-1 keep their letter, the others get
    the letters from U+0100 on, in order.
    """
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class PairMerger:
    """Counts tokens as one merge-list file with word ends would give them."""

    def __init__(self, spec: dict):
        model, norm = spec["model"], spec["normalizer"]["normalizers"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        steps = [n["type"] for n in norm]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-casing merge-list tokenizer")
        if split["behavior"] != "Removed" or not split["invert"] or not model["end_of_word_suffix"]:
            raise ValueError("not a tokenizer of pieces with word ends")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        added = spec.get("added_tokens", [])
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens are matched as plain strings only")
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, strings))) if strings else None

        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]  # symbol of each byte
        self.last = [vocab[c + end] for c in letters]  # the same at a word's end
        self.width = max(vocab.values()) + 1
        self.ranks: dict[int, int] = {}  # left symbol * width + right symbol -> rank
        self.merged: list[int] = []  # rank -> symbol
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[left] * self.width + vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self._known: dict[str, int] = {}

    def merges(self, piece: bytes) -> int:
        """How many merges the bytes of one piece undergo."""
        n, width, merged, rank_of = len(piece), self.width, self.merged, self.ranks.get
        symbols = [*map(self.inner.__getitem__, piece)] if n < LONG else array("i", map(self.inner.__getitem__, piece))
        symbols[-1] = self.last[piece[-1]]
        after, before = range(1, n + 1), range(-1, n - 1)  # n and -1: none
        after, before = ([*after], [*before]) if n < LONG else (array("i", after), array("i", before))
        waiting: dict[int, list[int] | array] = {}  # rank -> left ends of pairs of that rank
        for at in range(n - 1):
            rank = rank_of(symbols[at] * width + symbols[at + 1])
            if rank is not None:
                if rank in waiting:
                    waiting[rank].append(at)
                else:
                    waiting[rank] = [at] if n < LONG else array("i", (at,))
        heap = list(waiting)
        heapify(heap)

        def queue(rank: int, at: int) -> None:
            if rank in waiting:
                waiting[rank].append(at)
            else:
                waiting[rank] = [at] if n < LONG else array("i", (at,))
                heappush(heap, rank)

        done = 0
        while heap:
            rank = heappop(heap)
            places = waiting.pop(rank)
            if len(places) > 1:
                places = sorted(places) if n < LONG else array("i", np.sort(places).tobytes())
            for turn, at in enumerate(places):
                right = after[at]
                if right == n or rank_of(symbols[at] * width + symbols[right]) != rank:
                    continue  # the pair has changed since it was queued
                symbol = symbols[at] = merged[rank]
                symbols[right] = GONE
                after[at] = beyond = after[right]
                done += 1
                if beyond < n:
                    before[beyond] = at
                    new = rank_of(symbol * width + symbols[beyond])
                    if new is not None:
                        queue(new, at)
                left = before[at]
                if left >= 0:
                    new = rank_of(symbols[left] * width + symbol)
                    if new is not None:
                        queue(new, left)
                if heap and heap[0] < rank:  # a lower rank came up: the rest waits
                    for rest in places[turn + 1 :]:
                        queue(rank, rest)
                    break
        return done

    def _keep(self, string: str, count: int) -> None:
        if len(string) <= KEPT_CHARS:
            if len(self._known) >= STRINGS_KEPT:
                self._known.clear()
            self._known[string] = count

    def _chunk(self, chunk: str) -> int:
        """Tokens of one stretch without white space: initial symbols minus merges.

        Pieces are memoised beside the stretches they come from: the pattern finds
        a piece again when it stands alone, so one table serves both.
        """
        total = 0
        for match in self.pattern.finditer(chunk):
            piece = match[0]
            n = self._known.get(piece)
            if n is None:
                raw = piece.encode()
                n = len(raw) - self.merges(raw)
                self._keep(piece, n)
            total += n
        self._keep(chunk, total)
        return total

    def _plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        text = unicodedata.normalize("NFC", text)
        for capital, small in CAPITALS.items():
            text = text.replace(capital, small)
        text = text.lower()
        split = WHITE.split if NOT_WHITE.search(text) else str.split
        known, new = self._known.get, self._chunk
        total = 0
        for part in stretches(text):
            for chunk in split(part):
                n = known(chunk)
                total += new(chunk) if n is None else n
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        total = at = 0
        for match in self.added.finditer(text):
            total += self._plain(text[at : match.start()]) + 1
            at = match.end()
        return total + self._plain(text[at:])


def stretches(text: str) -> Iterator[str]:
    """The text in parts of at least ``STRETCH`` characters that end before white space."""
    at = 0
    while len(text) - at > STRETCH:
        gap = WHITE.search(text, at + STRETCH)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


_MERGERS: dict[str, PairMerger] = {}  # one per worker process


def _merger(data: bytes) -> PairMerger:
    key = hashlib.sha256(data).hexdigest()
    if key not in _MERGERS:
        _MERGERS.clear()
        _MERGERS[key] = PairMerger(json.loads(data))
    return _MERGERS[key]


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    limit: int = LIMIT,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Bytes and tokens of every text: key, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    data = Path(tokenizer_file).read_bytes()
    if len(data) > MAX_FILE_BYTES:
        raise ValueError("the tokenizer file is larger than a vocabulary can be")
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        merger = _merger(shared.value)
        sizes, counts = [], []
        for value in batch.column(1):
            own = value.as_py() or ""
            sizes.append(len(own.encode()))
            counts.append(merger.count(own))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([n > limit for n in counts], pa.bool_()),
            ],
            names=[key, "n_bytes", "n_tokens", "over_limit"],
        )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(docs.select(docs[key], docs[text].cast("string")), run, schema)
