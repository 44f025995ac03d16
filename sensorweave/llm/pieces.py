"""SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model joins neighbouring symbols, best score first, from an agenda. With dropout each
candidate that comes up is skipped when a keyed hash of (seed, text, place of the word in it, place
and length in the word) falls below the dropout rate. So every occurrence of a word is drawn anew,
and a seed gives one segmentation whatever the partitions or retries, other seeds give others.
Without dropout the ids are those of the library.

No piece of such a vocabulary holds a space mark after another character (checked on loading), so a
text is encoded word by word: the words of many texts together, in rounds that make the next merge
of each (`merging`); a long word alone, from a heap. Both give the same ids.

Lossless: characters without a piece become byte pieces; so does the space mark itself where a text
contains it. Decoding joins the pieces and takes the one mark away that encoding put in front.

Defined results: a NULL text has NULL ids; an empty one has none; a long run without spaces is one
word and costs n log n; repeated rows get equal ids; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm import merging
from sensorweave.llm.common import GOLDEN, mix64, utf8, widened
from sensorweave.llm.merging import Merges

MARK = "▁"
REMEMBERED, LONGEST = 1 << 14, merging.LONGEST  # words of a group; the longest of them, others are merged alone
CHARACTERS = 1 << 20  # of the texts that are in hand at a time
_MASK = (1 << 64) - 1
_LENGTH = 32  # a place and a length in a word are one number: place << _LENGTH | length


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.costs: dict[str, float] = {}  # minus the score: the best is on top of the agenda
        self.bytes = [0] * 256
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                if re.search(f"[^{MARK}]{MARK}", piece):
                    raise ValueError("a piece spans words; words cannot be encoded one by one")
                self.ids[piece] = i
                self.costs[piece] = -model.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.costs), default=0)

    def merged(self, word: str, skipped: Callable[[int], bool] | None = None) -> list[str]:
        """Symbols of one word by agenda merging; `skipped` tells of place << _LENGTH | length."""
        symbols = list(word)
        n = len(symbols)
        cost = self.costs.get
        ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            price = cost(joined)
            if price is not None:
                agenda.append((price, i, i + 1, joined))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            first, second = symbols[left], symbols[right]
            # out of date when one side has been merged meanwhile
            if first is None or second is None or ahead[left] != right or len(first) + len(second) != len(joined):
                continue
            if skipped is not None and skipped(left << _LENGTH | len(joined)):
                continue
            symbols[left], symbols[right] = joined, None
            after = ahead[left] = ahead[right]
            before = behind[left]
            if after < n:
                behind[after] = left
                wider = joined + symbols[after]
                price = cost(wider)
                if price is not None:
                    heapq.heappush(agenda, (price, left, after, wider))
            if before >= 0:
                wider = symbols[before] + joined
                price = cost(wider)
                if price is not None:
                    heapq.heappush(agenda, (price, before, left, wider))
        return [s for s in symbols if s is not None]

    def segment(self, word: str, skipped: Callable[[int], bool] | None = None) -> list[int]:
        """Ids of one word."""
        out = []
        for s in self.merged(word, skipped):
            found = self.ids.get(s)
            if found is None:
                out += [self.bytes[b] for b in s.encode("utf-8", "surrogatepass")]
            else:
                out.append(found)
        return out

    def spans(self, word: str) -> list[int]:
        """All places and lengths in a word that a merge can come up for."""
        n, priced = len(word), self.costs
        return [i << _LENGTH | (j - i) for i in range(n - 1) for j in range(i + 2, min(n, i + self.longest) + 1) if word[i:j] in priced]


class Coder:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str, dropout: float = 0.0, seed: int = 0):
        self.vocabulary = Vocabulary(path)
        self.secret = hashlib.blake2b(str(seed).encode(), digest_size=16).digest()
        self.limit = int(dropout * (1 << 64))
        costs = self.vocabulary.costs
        self.symbols = {piece: i for i, piece in enumerate(costs)}  # pieces, then characters that only parts of pieces are
        rank = np.unique(list(costs.values()), return_inverse=True)[1]
        parts = [(piece[:k], piece[k:], made) for piece, made in self.symbols.items() for k in range(1, len(piece))]
        for a, b, _ in parts:
            for side in (a, b):
                if len(side) == 1:
                    self.symbols.setdefault(side, len(self.symbols))
        self.mark = self.symbols.setdefault(MARK, len(self.symbols))
        self.literal, self.other, edge = range(len(self.symbols), len(self.symbols) + 3)  # a mark that is text; a character without pieces
        known = [(self.symbols[a], self.symbols[b], made) for a, b, made in parts if a in self.symbols and b in self.symbols]
        left, right, made = np.array(known, np.int64).reshape(-1, 3).T
        self.merges = Merges(left, right, rank[made], made, edge)
        self.ids = np.full(edge, -1, np.int64)  # -1: byte pieces
        self.ids[[self.symbols[piece] for piece in self.vocabulary.ids]] = list(self.vocabulary.ids.values())
        self.characters = np.full(sys.maxunicode + 1, self.other, np.int32)
        single = [c for c in self.symbols if len(c) == 1]
        self.characters[[ord(c) for c in single]] = [self.symbols[c] for c in single]
        self.characters[ord(" ")], self.characters[ord(MARK)] = self.mark, self.literal

    def _skips(self, key: np.ndarray | np.uint64, place, length) -> np.ndarray:
        """Whether the merges of these places and lengths, of words with these keys, are left out."""
        with np.errstate(over="ignore"):
            h = mix64(key ^ (np.uint64(1 << _LENGTH) * np.asarray(place, np.uint64) | np.asarray(length, np.uint64)) * np.uint64(GOLDEN))
        return h < np.uint64(self.limit) if self.limit <= _MASK else np.ones(h.shape, bool)

    def _alone(self, word: str, key: int) -> list[str]:
        """Symbols of a word that is too long for a group."""
        if not self.limit:
            return self.vocabulary.merged(word)
        limit = self.limit

        def skipped(span: int) -> bool:
            x = key ^ (span * GOLDEN & _MASK)  # mix64 of one number
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _MASK
            x = (x ^ x >> 27) * 0x94D049BB133111EB & _MASK
            return x ^ x >> 31 < limit

        return self.vocabulary.merged(word, skipped)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (int32) of every text; texts of so many characters are in hand at a time, or one."""
        out: list[np.ndarray] = []
        held: list[str] = []
        size = 0
        for text in texts:
            if held and size + len(text) > CHARACTERS:
                out += self._encode(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        return out + self._encode(held)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [MARK + t if t else "" for t in texts]
        codes = np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), "<u4").copy()
        stops = np.cumsum([len(t) for t in whole])
        if not len(codes):
            return [np.empty(0, "<i4") for _ in texts]
        symbols = self.characters[codes]
        begins = np.flatnonzero(np.diff(stops, prepend=0))  # texts that are not empty
        first = np.concatenate([[0], stops[begins][:-1]])
        symbols[first] = self.mark
        codes[codes == ord(" ")] = ord(MARK)
        # words: marks, then what is no mark; a mark that is text stands alone
        mark, literal = symbols == self.mark, symbols == self.literal
        opens = literal.copy()
        opens[1:] |= literal[:-1] | (mark[1:] & ~mark[:-1])
        opens[first] = True
        starts = np.flatnonzero(opens & ~literal)
        sizes = np.diff(np.append(np.flatnonzero(opens), len(codes)))[~literal[opens]]
        if self.limit:
            base = np.array([int.from_bytes(hashlib.blake2b(utf8(texts[i]), digest_size=8, key=self.secret).digest(), "little") for i in begins.tolist()], np.uint64)
            origin = np.searchsorted(starts, first)  # first word of each text
            owner = np.repeat(np.arange(len(begins)), np.diff(np.append(origin, len(starts))))
            with np.errstate(over="ignore"):
                keys = mix64(base[owner] + np.uint64(GOLDEN) * (np.arange(1, len(starts) + 1) - origin[owner]).astype(np.uint64))
        else:
            keys = np.zeros(len(starts), np.uint64)
        short = sizes <= min(LONGEST, merging.LONGEST)
        group = keys[short]
        self.merges.merge(symbols, starts[short], sizes[short], (lambda word, place, length: self._skips(group[word], place, length)) if self.limit else None, REMEMBERED)
        for i in np.flatnonzero(~short).tolist():
            at, size = int(starts[i]), int(sizes[i])
            word = codes[at : at + size].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            found = self._alone(word, int(keys[i]))
            symbols[at : at + size] = -1
            places = at + np.cumsum([0, *map(len, found[:-1])])
            symbols[places] = [self.symbols.get(s, self.other) for s in found]
        kept = np.flatnonzero(symbols >= 0)
        ids = self.ids[symbols[kept]]
        ends = np.searchsorted(kept, stops)
        spelt = ids < 0
        if spelt.any():
            different, which = np.unique(codes[kept[spelt]], return_inverse=True)
            table = np.full((len(different), 4), -1, np.int64)
            for row, code in zip(table, different.tolist()):
                raw = chr(code).encode("utf-8", "surrogatepass")
                row[: len(raw)] = [self.vocabulary.bytes[b] for b in raw]
            wide = table[which]
            counts = np.ones(len(ids), np.int64)
            counts[spelt] = (wide >= 0).sum(axis=1)
            ends = np.concatenate([[0], np.cumsum(counts)])[ends]
            ids, spelt = np.repeat(ids, counts), np.repeat(spelt, counts)
            ids[spelt] = wide[wide >= 0]
        ids = ids.astype("<i4")
        return [ids[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def decode(self, ids: np.ndarray) -> str:
        raw = self.vocabulary.raw
        joined = b"".join([raw[i] for i in ids.tolist()])
        return joined.decode("utf-8", "surrogatepass")[1:]


_coders: dict[tuple, Coder] = {}  # per worker process


def coder(path: str, dropout: float = 0.0, seed: int = 0) -> Coder:
    key = (path, dropout, seed)
    if key not in _coders:
        _coders[key] = Coder(path, dropout, seed)
    return _coders[key]


def encode(docs: DataFrame, model: str, text: str = "text", dropout: float = 0.0, seed: int = 0, out: str = "pieces") -> DataFrame:
    """`docs` with the array column `out` of piece ids."""
    place = docs.columns.index(text)
    schema = widened(docs, f"`{out}` array<int>")

    def run(batches):
        own = coder(model, dropout, seed)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            coded = own.encode_all([t or "" for t in texts])
            ids = [None if t is None else c for t, c in zip(texts, coded)]
            kept = [c for c, name in zip(batch.columns, batch.schema.names) if name != out]
            names = [n for n in batch.schema.names if n != out]
            found = pa.array(ids, pa.list_(pa.int32()))
            at = schema.names.index(out)
            yield pa.RecordBatch.from_arrays([*kept[:at], found, *kept[at:]], names=[*names[:at], out, *names[at:]])

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: str, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """`docs` with the string column `out` decoded from the ids in `pieces`."""
    place = docs.columns.index(pieces)
    schema = widened(docs, f"`{out}` string")

    def run(batches):
        own = coder(model)
        for batch in batches:
            lists = batch.column(place)
            texts = [None if not lists[i].is_valid else own.decode(lists[i].values.to_numpy()) for i in range(len(lists))]
            at = schema.names.index(out)
            kept = [c for c, name in zip(batch.columns, batch.schema.names) if name != out]
            names = [n for n in batch.schema.names if n != out]
            yield pa.RecordBatch.from_arrays([*kept[:at], pa.array(texts, pa.string()), *kept[at:]], names=[*names[:at], out, *names[at:]])

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """Per row: key, n_chars, n_pieces, n_bytes (byte pieces), pieces_crc32, lossless."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        own = coder(model, dropout, seed)
        first, last = min(own.vocabulary.bytes), max(own.vocabulary.bytes)
        for batch in batches:
            out = []
            texts = batch.column(1).to_pylist()
            for t, ids in zip(texts, own.encode_all([t or "" for t in texts])):
                spelt = int(((ids >= first) & (ids <= last)).sum())
                out.append((len(t or ""), len(ids), spelt, zlib.crc32(ids.tobytes()), own.decode(ids) == (t or "")))
            long = pa.int64()
            columns = [pa.array([o[i] for o in out], k) for i, k in enumerate([long, long, long, long, pa.bool_()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "n_chars", "n_pieces", "n_bytes", "pieces_crc32", "lossless"])

    return rows.mapInArrow(run, f"`{key}` {kind}, n_chars long, n_pieces long, n_bytes long, pieces_crc32 long, lossless boolean")
