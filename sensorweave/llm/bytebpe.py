"""Byte-level BPE by longest matches and backtracking.

The vocabulary's byte strings are read as Latin-1, one character a byte, so that one Aho-Corasick
automaton finds the longest token at any place of any bytes. A sequence of tokens is the result of
the merges if and only if every two neighbours are *compatible*: the merges, run on their joined
bytes alone, give just these two. So a piece is encoded from the left: the longest token that is
compatible with the one before it is taken; where none is, the last token is given up for the next
shorter one. Places from which the rest cannot be encoded are marked and never tried again, so the
work is linear in the length of the piece. Compatibility is worked out once per pair of tokens and
remembered; so are the pieces met lately.

A text is split by the vocabulary's pattern, piece by piece without holding them all. Every table is
read by each worker from the vocabulary file; encoding is a map over rows without a shuffle.

Defined results: a NULL text is empty; an empty text has no ids; equal rows have equal results; a text
of any length is encoded whole, also when it is a single piece; extra columns are ignored; an empty
table gives an empty table. Decoding joins the bytes of the ids: it gives back the text's bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import utf8, widened

PIECES = 1 << 16  # pieces in hand at once
REMEMBERED = 200_000  # pieces of one generation; two are kept
AT_ONCE = 1 << 20  # characters of a text whose pieces are listed at once
LONGEST = 64  # characters of a piece that is remembered
PAIRS = 2_000_000  # remembered compatibilities


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 and number in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBPE:
    """Encoder and decoder of one vocabulary: `ranks` of byte strings, all single bytes included."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = ahocorasick.Automaton()
        # a token that the merges never leave whole cannot be part of a result
        self.whole = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.merged(token) == [rank]}
        for token, rank in self.whole.items():
            self.longest.add_word(token.decode("latin-1"), rank)
        self.longest.make_automaton()
        self.reach = max(map(len, self.whole))
        self._shorter: dict[int, int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        self._young_trips: dict[str, tuple[int, bytes, bytes]] = {}
        self._old_trips: dict[str, tuple[int, bytes, bytes]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """The ids that merging the lowest rank first gives: the definition, for short strings."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        none = len(self.ranks)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == none:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of `a` and `b` leaves these two tokens."""
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self._pairs[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of `token`; -1 for a single byte."""
        known = self._shorter.get(token)
        if known is None:
            raw = self.bytes_of[token]
            known = next((self.whole[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in self.whole), -1)
            self._shorter[token] = known
        return known

    def backtracked(self, piece: str) -> list[int]:
        """Ids of a piece given as Latin-1."""
        size, at = len(piece), 0
        dead = bytearray(size + 1)  # places from which the rest cannot be encoded
        ids: list[int] = []
        token = self.match(piece, 0)
        while at < size:
            while token >= 0:
                stop = at + len(self.bytes_of[token])
                if not dead[stop] and (not ids or self.compatible(ids[-1], token)):
                    ids.append(token)
                    at = stop
                    token = self.match(piece, at) if at < size else -1
                    break
                token = self.shorter(token)
            else:
                dead[at] = 1
                last = ids.pop()
                at -= len(self.bytes_of[last])
                token = self.shorter(last)
        return ids

    def match(self, piece: str, at: int) -> int:
        """The longest token at a place; a window of the longest token's length is all that is read."""
        return next(self.longest.iter_long(piece[at : at + self.reach]))[1]

    def made(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of text, worked out."""
        raw = utf8(piece)
        rank = self.ranks.get(raw)  # a piece that is a token is that token
        return (rank,) if rank is not None else tuple(self.backtracked(raw.decode("latin-1")))

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of text."""
        known = self._young.get(piece)
        if known is not None:
            return known
        known = self._old.get(piece) or self.made(piece)
        if len(piece) <= LONGEST:
            if len(self._young) >= REMEMBERED:
                self._old, self._young = self._young, {}
            self._young[piece] = known
        return known

    def trip(self, piece: str) -> tuple[int, bytes, bytes]:
        """Of one piece of text: number of ids, the ids in decimal with a space before each, the bytes they decode to."""
        known = self._old_trips.get(piece)
        if known is None:
            ids = self.made(piece)
            known = len(ids), b"".join([b" %d" % i for i in ids]), self.decode(ids)
        if len(piece) <= LONGEST:
            if len(self._young_trips) >= REMEMBERED:
                self._old_trips, self._young_trips = self._young_trips, {}
            self._young_trips[piece] = known
        return known

    def pieces(self, text: str | None) -> Iterator[list[str]]:
        """The pieces of a text, some at a time."""
        if text and len(text) <= AT_ONCE:
            yield [m.group() for m in self.pattern.finditer(text)] if self.pattern.groups else self.pattern.findall(text)
            return
        found = map(regex.Match.group, self.pattern.finditer(text or ""))
        while batch := list(islice(found, PIECES)):
            yield batch

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Ids of a text, some pieces at a time."""
        for batch in self.pieces(text):
            yield [i for p in batch for i in self.piece(p)]

    def round_trip(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids in decimal with one space between, sha256 of the bytes they decode to."""
        n, ids_sum, back = 0, hashlib.sha256(), hashlib.sha256()
        for batch in self.pieces(text):
            known = self._young_trips  # replaced by a new one where it is full
            trips = [known.get(p) or self.trip(p) for p in batch]
            if not trips:
                continue
            counts, spelled, raw = zip(*trips)
            ids = b"".join(spelled)
            ids_sum.update(ids if n else ids[1:])
            n += sum(counts)
            back.update(b"".join(raw))
        return n, ids_sum.hexdigest(), back.hexdigest()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBPE:
    """A worker's coder, built once."""
    return ByteBPE(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id", to: str = "ids") -> DataFrame:
    """Per row: key, ids (array of int)."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))

    def run(batches):
        own = coder(path, pattern)
        for batch in batches:
            ids = [[i for part in own.encode(t) for i in part] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, to])

    return rows.mapInArrow(run, widened(rows.drop("_text"), f"`{to}` array<int>"))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", key: str = "doc_id", to: str = "text") -> DataFrame:
    """Per row of `encode`: key, the decoded bytes (binary: part of a text may end inside a character)."""
    rows = rows.select(F.col(key).alias(key), F.col(ids).alias("_ids"))

    def run(batches):
        own = coder(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(i or ()) for i in batch.column(1).to_pylist()], pa.binary())], names=[key, to])

    return rows.mapInArrow(run, widened(rows.drop("_ids"), f"`{to}` binary"))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 (of the ids in decimal, one space between), decoded_sha256
    (of the bytes that the ids decode to). Ids are made, decoded and let go part by part."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))

    def run(batches):
        own = coder(path, pattern)
        for batch in batches:
            trips = [own.round_trip(t) for t in batch.column(1).to_pylist()]
            counts, sums, backs = (list(c) for c in zip(*trips)) if trips else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(backs, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, widened(rows.drop("_text"), "n_tokens long, ids_sha256 string, decoded_sha256 string"))
