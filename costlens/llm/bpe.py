"""Operator 2: byte-level BPE encoding and decoding.

Encoding.  A text is split by the tokenizer's pattern; each piece is encoded on
its own.  A piece that is itself a token is that token.  Any other piece is read
left to right: an Aho-Corasick automaton over the vocabulary (bytes mapped to
Latin-1 characters) lists the tokens that start at each position, the longest
one is tried first, and it is taken only if it is *compatible* with the token
before it, that is if the merges of both, undone down to the place where they
meet, would not have merged across it.  Where no token fits, the last token is
taken back and its next shorter alternative is tried; positions found to lead
nowhere are marked and never entered again, so the work is linear in the piece.
Compatibility of token pairs and the ids of short pieces are memoised in tables
of bounded size.  A piece longer than ``LONG_PIECE`` keeps the matches of a few
blocks at a time, found anew should the reading go back further, and some ten
bytes of state per byte.  The result equals the merges in rank order, id for id.

Decoding joins the bytes of the ids.

Defined results: null text encodes as empty (no ids); an empty text has no ids
and the digest of zero bytes; special-token strings in a text are plain text;
repeated rows give repeated results; an empty table gives an empty result;
further input columns, whatever their names, are ignored.  The rank file is
read on the driver (its size is fixed by the vocabulary, under
``MAX_RANK_BYTES``) and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from itertools import chain
from pathlib import Path

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from costlens.llm.common import map_batches

MAX_RANK_BYTES = 64 << 20
PIECES_KEPT = 400_000  # memoised pieces per worker; longer pieces are not kept
PIECE_KEPT_BYTES = 48
PAIRS_KEPT = 1_000_000
LONG_PIECE = 1 << 16  # bytes; longer pieces are matched block by block
MATCH_BLOCK = 1 << 14
BLOCKS_KEPT = 2


class BytePairCodec:
    """Encoder and decoder over one rank file (``base64 rank`` per line)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._parts: dict[int, tuple[int, int]] = {}  # the two tokens a token is merged from
        self._merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self._learn(token, rank)
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if rank in self._parts:
                self._automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self._automaton.make_automaton()
        self._longest = max(map(len, ranks), default=0)
        self._own = {r: r for r in self.bytes_of}  # one integer object per id

    @classmethod
    def from_rank_file(cls, data: bytes, pattern: str) -> BytePairCodec:
        ranks = {}
        for line in data.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        return cls(ranks, pattern)

    def _learn(self, token: bytes, rank: int) -> None:
        """Find the pair of lower-ranked tokens that rank-order merging turns into it.

        A token that merging never produces gets no parts: it is only used for
        pieces equal to it.
        """
        if len(token) == 1:
            self._parts[rank] = (rank, rank)
            return
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
            if left is None or right is None or left >= rank or right >= rank:
                continue
            if left in self._parts and right in self._parts and self._meets(left, right):
                self._parts[rank] = (left, right)
                self._merged[left, right] = rank
                return

    def _meets(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` as neighbours.

        The later of the two merges is undone step by step; a merge across the
        boundary that comes earlier than every merge undone so far rules it out.
        """
        bound = 1 << 62  # merges across the boundary count only below this rank
        while True:
            across = self._merged.get((left, right))
            if across is not None and across < bound:
                return False
            undo_left = self._parts[left][1] != left  # not a single byte
            undo_right = self._parts[right][0] != right
            if not undo_left and not undo_right:
                return True
            if undo_left and (left > right or not undo_right):
                bound, left = left, self._parts[left][1]
            else:
                # equal ranks merge left to right, so a tie goes to the boundary
                bound, right = right + 1, self._parts[right][0]

    def _compatible(self, left: int, right: int) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= PAIRS_KEPT:
                self._pairs.clear()
            known = self._pairs[left, right] = self._meets(left, right)
        return known

    def _encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        if n > LONG_PIECE:
            return self._encode_long(piece)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (rank, length) in self._automaton.iter(piece.decode("latin-1")):
            starting[end + 1 - length].append((rank, length))
        for options in starting:
            options.sort(key=lambda x: -x[1])
        dead = bytearray(n + 1)
        tried = [0] * n  # how many of a position's options were used up
        out: list[int] = []
        path: list[int] = []  # positions where the tokens of ``out`` begin
        at = 0
        while at < n:
            options = starting[at]
            i = tried[at]
            while i < len(options):
                rank, length = options[i]
                i += 1
                if not dead[at + length] and (not out or self._compatible(out[-1], rank)):
                    tried[at] = i
                    out.append(rank)
                    path.append(at)
                    at += length
                    break
            else:
                # nothing fits here after any token that may end here
                tried[at] = 0
                dead[at] = 1
                out.pop()
                at = path.pop()
        return tuple(out)

    def _encode_long(self, piece: bytes) -> tuple[int, ...]:
        """``_encode_bytes`` for a piece of any length, in memory of some ten bytes a byte."""
        n, text = len(piece), piece.decode("latin-1")
        blocks: dict[int, list[list[tuple[int, int]]]] = {}

        def block(number: int) -> list[list[tuple[int, int]]]:
            lo = number * MATCH_BLOCK
            hi = min(n, lo + MATCH_BLOCK)
            starting: list[list[tuple[int, int]]] = [[] for _ in range(hi - lo)]
            for end, (rank, length) in self._automaton.iter(text[lo : hi + self._longest]):
                first = end + 1 - length
                if first < hi - lo:
                    starting[first].append((rank, length))
            for options in starting:
                options.sort(key=lambda x: -x[1])
            return starting

        def options_at(at: int) -> list[tuple[int, int]]:
            number, within = divmod(at, MATCH_BLOCK)
            if number not in blocks:
                if len(blocks) >= BLOCKS_KEPT:  # the one furthest from here
                    del blocks[max(blocks, key=lambda b: abs(b - number))]
                blocks[number] = block(number)
            return blocks[number][within]

        dead = bytearray(n + 1)
        tried = array("H", bytes(2 * n))
        out = array("q")
        at = 0
        while at < n:
            options = options_at(at)
            for i in range(tried[at], len(options)):
                rank, length = options[i]
                if not dead[at + length] and (not out or self._compatible(out[-1], rank)):
                    tried[at] = i + 1
                    out.append(rank)
                    at += length
                    break
            else:
                tried[at] = 0
                dead[at] = 1
                at -= len(self.bytes_of[out.pop()])
        return tuple(map(self._own.__getitem__, out))

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        ids = self._encode_bytes(raw)
        if len(raw) <= PIECE_KEPT_BYTES:
            if len(self._pieces) >= PIECES_KEPT:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known, new = self._pieces.get, self._encode_piece
        return list(
            chain.from_iterable(known(p) or new(p) for p in self.pattern.findall(text))
        )

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], BytePairCodec] = {}  # one codec per worker process


def _codec(data: bytes, pattern: str) -> BytePairCodec:
    key = (hashlib.sha256(data).hexdigest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BytePairCodec.from_rank_file(data, pattern)
    return _CODECS[key]


def encode(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    text: str = "text",
    key: str = "doc_id",
    with_ids: bool = True,
) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns key, n_tokens, ids_sha256, decoded_sha256 and, unless ``with_ids`` is
    off, ``token_ids``.  One pass over the texts, no shuffle.
    """
    data = Path(rank_file).read_bytes()
    if len(data) > MAX_RANK_BYTES:
        raise ValueError("the rank file is larger than a vocabulary can be")
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batch: pa.RecordBatch):
        codec = _codec(shared.value, pattern)
        n_tokens, ids_hash, text_hash, all_ids = [], [], [], []
        for value in batch.column(1):
            ids = codec.encode(value.as_py() or "")
            n_tokens.append(len(ids))
            joined = ",".join(map(codec.text_of.__getitem__, ids))
            ids_hash.append(hashlib.sha256(joined.encode()).hexdigest())
            text_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if with_ids:
                all_ids.append(ids)
        columns = [
            batch.column(0),
            pa.array(n_tokens, pa.int64()),
            pa.array(ids_hash, pa.string()),
            pa.array(text_hash, pa.string()),
        ]
        names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            names.append("token_ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", token_ids array<int>"
    return map_batches(docs.select(docs[key], docs[text].cast("string")), run, schema)
