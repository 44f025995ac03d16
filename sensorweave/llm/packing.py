"""Packing along a space-filling curve.

Documents are tokenised whole. Their signed hashed token counts, damped and scaled to length one,
are projected to `DIMS` dimensions; the coordinates, standardised over the corpus, become a Hilbert
key. Documents are range-sorted by that key and laid end to end along the curve; the line is cut
every `LENGTH` tokens. So neighbours on the curve share sequences, every token lies in exactly one
piece, and only the last sequence of all is padded.

The tokens are written once. Keys and lengths (a few bytes a document) are sorted and summed, the
totals of the partitions are added up, and each document gets its start from there.

Defined results: a NULL or empty text is one end token; repeated rows and ties on the key are laid
one after the other, in the order of their key, then of the row; very long texts span sequences;
an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm import merging
from sensorweave.llm.common import cut, give_back, mix64

LENGTH = 2048
DIMS, BITS = 4, 12
HASHED = 1024
REMEMBERED = 500_000  # words, and pieces of words, of each of two generations in a worker
CHARACTERS = 1 << 20  # of the texts that are merged at a time

_coders: dict[str, WordCoder] = {}  # per worker process
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")  # the vocabulary's splitter
_CLOSE = "</w>"  # the vocabulary's mark of a piece's last token
_SIGNS = "!#$%&()*+,-./:;=?@[]^_{|}~"


class Memory(dict):
    """A bounded memory: what was not asked for during a whole generation is forgotten."""

    def __init__(self, size: int):
        self.size, self.older = size, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older[word]
        self[word] = found
        return found

    def turn(self) -> None:
        if len(self) > self.size:
            self.older = {}  # let go before the copy is made
            self.older = dict(self)
            self.clear()

    def unknown(self, words: set[str]) -> list[str]:
        return [w for w in words.difference(self) if w not in self.older]


class WordCoder:
    """Ids of whole texts, those of the tokenizer.

    Where it is known what the tokenizer does before splitting, the pieces of many texts are found by
    kinds of characters and merged together (`merging`). Of other texts, word by word: the vocabulary's
    splitter drops white space, so no token spans a blank; the ids of a text are those of its
    blank-separated words, and the ids of a word those of its pieces after the splitter. Both are
    remembered. Words that the tokenizer might change before splitting go to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.pieces = Memory(REMEMBERED), Memory(REMEMBERED)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a piece
        self.closing[[i for token, i in vocabulary.items() if token.endswith(_CLOSE)]] = True
        pairs = json.loads(self.tokenizer.to_str())["model"]["merges"]
        left, right, made = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], np.int64).reshape(-1, 3).T
        self.merges = merging.Merges(left, right, np.arange(len(pairs)), made, len(self.closing))
        # bytes have printable names: those that are none themselves have the characters from 256 on, in order
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        names = [chr(b if b in own else next(others)) for b in range(256)]
        self.inner, self.last = (np.array([vocabulary[name + suffix] for name in names], np.int32) for suffix in ("", _CLOSE))
        self.kinds = np.full(sys.maxunicode + 1, 3, np.uint8)  # 0 blank, 1 letter, 2 number, 3 other
        signs = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
        for kind, pattern in enumerate([r"\s", r"\p{L}", r"\p{N}"]):
            self.kinds[np.frombuffer("".join(regex.findall(pattern, signs)).encode("utf-32-le"), "<u4")] = kind

    @staticmethod
    def single(piece: str) -> bool:
        """Whether the splitter is certain to leave it whole."""
        if piece.isalpha():
            return piece.isascii() or (piece == piece.lower() and unicodedata.is_normalized("NFC", piece))
        return bool(piece) and not piece.strip(_SIGNS)

    @staticmethod
    def split(word: str) -> list[str]:
        """Pieces that the splitter makes of a word; the word itself where that is not certain."""
        low = word.lower()
        # what the tokenizer does before splitting is known for these: it folds case letter by letter
        if word.isascii() or (len(low) == len(word) and "Σ" not in word and unicodedata.is_normalized("NFC", low)):
            core = low.rstrip(_SIGNS)
            if core.isalpha():  # letters, then signs: the common case
                return [core, low[len(core) :]] if len(core) < len(low) else [core]
            if word.isprintable() and "<|" not in word:
                return _PIECES.findall(low)
        return [word]

    @staticmethod
    def plain(text: str) -> str | None:
        """The text as the splitter gets it, up to the kind and number of blanks; None where that is not certain."""
        spaced = text.replace("\n", " ").replace("\r", " ").replace("\t", " ")
        low = spaced.lower()
        if "<|" in spaced or not spaced.isprintable():
            return None
        if spaced.isascii() or (len(low) == len(spaced) and "Σ" not in spaced and unicodedata.is_normalized("NFC", spaced) and unicodedata.is_normalized("NFC", low)):
            return low
        return None

    def _merged(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of plain texts."""
        whole = "".join([t + "  " for t in texts])  # two blanks: what is looked up behind a sign exists
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        raw = np.frombuffer(whole.encode(), np.uint8)
        kind = self.kinds[codes]
        opens = kind != 0
        opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        at = np.flatnonzero(opens & (codes == ord("'")))
        one = at[np.isin(codes[at + 1], [ord(c) for c in "stmd"])]
        following = codes[at + 1].astype(np.uint64) << np.uint64(32) | codes[at + 2]
        two = at[np.isin(following, np.array([ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")], np.uint64))]
        opens[one + 1] = opens[two + 1] = False
        for rest in (one + 2, two + 3):
            opens[rest[kind[rest] == 1]] = True
        places = np.append(np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)), 0)  # in bytes: behind a character; the last: before the first
        edges = np.flatnonzero(opens | (kind == 0))
        starts = places[edges - 1]
        sizes = np.diff(np.append(starts, len(raw)))
        piece = opens[edges]
        blanks = starts[~piece]
        starts, sizes = starts[piece], sizes[piece]
        symbols = self.inner[raw]
        final = starts + sizes - 1
        symbols[final] = self.last[raw[final]]
        symbols[blanks] = -1
        short = sizes <= merging.LONGEST
        self.merges.merge(symbols, starts[short], sizes[short])
        for start, size in zip(starts[~short].tolist(), sizes[~short].tolist()):
            ids = self.tokenizer.encode(raw[start : start + size].tobytes().decode(), add_special_tokens=False).ids
            symbols[start : start + size] = -1
            symbols[start : start + len(ids)] = ids
        stops = places[np.cumsum([len(t) + 2 for t in texts]) - 1]  # behind each text
        symbols[stops - 1] = end
        kept = np.flatnonzero(symbols >= 0)
        ids = symbols[kept].astype("<u4")
        ends = np.searchsorted(kept, stops).tolist()
        return [ids[i:j] for i, j in zip([0, *ends], ends)]

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        unsure, held, size = [], [], 0
        for i, text in enumerate(texts):
            low = self.plain(text or "")
            if low is None:
                unsure.append(i)
                continue
            if held and size + len(low) > CHARACTERS:
                self._fill(out, held, end)
                held, size = [], 0
            held.append((i, low))
            size += len(low)
        if held:
            self._fill(out, held, end)
        if unsure:
            for i, ids in zip(unsure, self._by_words([texts[i] for i in unsure], end)):
                out[i] = ids
        return out

    def _fill(self, out: list, held: list[tuple[int, str]], end: int) -> None:
        for (i, _), ids in zip(held, self._merged([low for _, low in held], end)):
            out[i] = ids

    def _by_words(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        self.words.turn()
        self.pieces.turn()
        parts = [(w, self.split(w)) for w in self.words.unknown(set().union(*split))]
        new = self.pieces.unknown({p for _, found in parts for p in found})
        single, rest = [], []
        for piece in new:
            (single if self.single(piece) else rest).append(piece)
        for i in range(0, len(single), 4096):
            # one text of many pieces costs less than many texts; a piece ends with its closing token
            chunk = single[i : i + 4096]
            # the fast form leaves out the offsets, which nobody reads
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(chunk)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.closing[ids]) + 1
            if len(stops) != len(chunk):
                raise ValueError("the vocabulary splits pieces in a way that is not known here")
            raw, stops = ids.tobytes(), (stops * 4).tolist()
            self.pieces.update(zip(chunk, map(raw.__getitem__, map(slice, [0, *stops], stops))))
        for piece in rest:
            self.pieces[piece] = np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()
        known = self.pieces.__getitem__
        for word, found in parts:
            self.words[word] = known(found[0]) if len(found) == 1 else b"".join(map(known, found))
        close = np.array([end], "<u4").tobytes()
        known = self.words.__getitem__
        return [np.frombuffer(b"".join(map(known, w)) + close, "<u4") for w in split]


def encode(texts: list[str | None], path: str, end: int) -> list[np.ndarray]:
    """Token ids (uint32) of whole texts, each followed by `end`."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path].encode(texts, end)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer cells (rows x dims), `bits` bits a dimension."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    level = np.uint64(1 << (bits - 1))
    while level > one:  # undo the rotations, from the top bit down
        low = level - one
        for i in range(dims):
            on = (x[i] & level) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        level >>= one
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = np.uint64(1 << (bits - 1))
    while level > one:
        flip ^= np.where((x[dims - 1] & level) != 0, level - one, np.uint64(0))
        level >>= one
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.astype(np.int64)


def _projector(dims: int, seed: int):
    """Function from token ids to coordinates."""
    plane = np.random.default_rng(seed).standard_normal((HASHED, dims))
    hashes = mix64(np.arange(1 << 18, dtype=np.uint64) + np.uint64(seed))
    cells, signs = (hashes % np.uint64(HASHED)).astype(np.int64), np.where(hashes >> np.uint64(63), 1.0, -1.0)

    def place(ids: np.ndarray) -> np.ndarray:
        ids = ids % len(cells)  # no known vocabulary is larger
        counts = np.bincount(cells[ids], signs[ids], HASHED)
        v = np.sign(counts) * np.log1p(np.abs(counts))
        norm = np.sqrt(v @ v)
        return (v / norm if norm else v) @ plane

    return place


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    end: int = 1,
    length: int = LENGTH,
    dims: int = DIMS,
    bits: int = BITS,
    seed: int = 5,
) -> DataFrame:
    """One row per piece: key, start, length, ids (binary, little-endian unsigned 32 bits), ids_crc32,
    doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    place = _projector(dims, seed)
    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def tokens(batches):
        give_back()
        for batch in batches:
            ids = encode(batch.column(2).to_pylist(), tokenizer, end)
            spots = [place(i) for i in ids]
            # two bytes an id where the vocabulary allows
            kept = [i.astype("<u2").tobytes() if i.max() < 65536 else i.tobytes() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(kept, pa.binary()), pa.array([len(i) for i in ids], pa.int64()), pa.array(spots, pa.list_(pa.float64()))],
                names=["key", "row", "ids", "n", "spot"],
            )

    encoded = cut(rows.mapInArrow(tokens, f"key {key_type}, row long, ids binary, n long, spot array<double>"), "tokens")
    shape = encoded.agg(*[f(F.col("spot")[i]) for f in (F.avg, F.stddev_pop) for i in range(dims)]).first()
    middle = np.array([x or 0.0 for x in shape[:dims]])
    spread = np.array([x or 1.0 for x in shape[dims:]])

    def curve(batches):
        for batch in batches:
            spot = batch.column(3).flatten().to_numpy().reshape(-1, dims)
            z = (spot - middle) / spread
            share = 1 / (1 + np.exp(-1.702 * z))  # about the normal distribution function: cells of like weight
            cells = np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hilbert(cells, bits))], names=["key", "row", "n", "curve"])

    keyed = encoded.select("key", "row", "n", "spot").mapInArrow(curve, f"key {key_type}, row long, n long, curve long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.repartitionByRange(parts, "curve", "key", "row").sortWithinPartitions("curve", "key", "row").select("row", "n")

    def summed(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n), pa.array(ends)], names=["row", "part", "at", "stop"]
            )
            at = int(ends[-1]) if len(n) else at

    starts = cut(keyed.mapInArrow(summed, "row long, part long, at long, stop long"), "starts")
    totals = starts.groupBy("part").agg(F.max("stop").alias("total")).orderBy("part").collect()  # a row a partition
    sums = np.cumsum([0, *[r.total for r in totals]]).tolist()
    base = spark.createDataFrame([(r.part, sums[i]) for i, r in enumerate(totals)], "part long, base long")
    starts = starts.join(F.broadcast(base), "part").select("row", (F.col("at") + F.col("base")).alias("at"))

    def pieces(batches):
        for batch in batches:
            out: list[tuple] = []
            index = []
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for i, (ids, n, at) in enumerate(zip(*columns)):
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    offset = (at + start) % length
                    size = min(n - start, length - offset)
                    body = ids[start : start + size].tobytes()
                    out.append((start, size, body, zlib.crc32(body), n, (at + start) // length, offset))
                    index.append(i)
                    start += size
            long = pa.int64()
            kinds = [long, long, pa.binary(), long, long, long, long]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, long)), *[pa.array([o[j] for o in out], t) for j, t in enumerate(kinds)]],
                names=[key, "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    joined = encoded.select("key", "row", "ids", "n").join(starts.hint("shuffle_hash"), "row").select("key", "ids", "n", "at")
    return joined.mapInArrow(
        pieces, f"`{key}` {key_type}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
