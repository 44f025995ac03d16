"""Phrase collocations by set-oriented relational mining (SETM).

The relation R_k holds every occurrence of a frequent phrase of k words: (piece, position, phrase),
sorted by piece and position. It is persisted, and each length follows from the one before:

1. merge-join: two occurrences of k words at adjacent positions of a piece (which share k - 1 words)
   make an occurrence of k + 1 words. A phrase is frequent only if both its parts are, so no other
   occurrence can count.
2. group-count: the occurrences are counted per chunk of the corpus, and the counts summed over chunks.
3. semi-join: occurrences of phrases below the support are dropped before the next length.

Storage. A chunk holds whole documents of one language, about `CHUNK` words; piece and position are
one number in it, its slot: slots count words, and a gap stands between pieces. A relation is a row
per chunk with the sorted slots and, for each, the place of its phrase in the sorted list of the
chunk's different phrases.

Counting. Every chunk sends its different phrases with their counts, not its occurrences, so a
phrase that a third of all words belong to is one entry per chunk. Entries are dealt out by a hash
over slices of about `SLICE` entries (their number follows the size of the relation) and travel packed,
a row per chunk and slice. A slice is summed in one task and gives each chunk its frequent phrases
back. Nothing is broadcast, and no group grows with the data.

Scores are exact: counts are longs, products decimals of 38 digits. Ranks are given by a range
shuffle (`ranks`), so no language lies in one task.

Defined results: NULL texts are empty; a NULL language is `und`, together with texts marked so;
empty texts and pieces hold no words; repeated rows count each; words of any length and texts of any
length are taken whole; equal scores are ordered by count, then by the phrase's bytes; extra columns
are ignored; an empty table, or one without frequent phrases, gives an empty table.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import cut, mix64, utf8
from sensorweave.llm.ranks import ranked

CHUNK = 2_000_000  # words of a chunk, about
HELD = 4_000_000  # words of unfinished chunks in a task
SLICE = 1_000_000  # entries that are counted in one task, about
BREAKS = re.compile(rb"[.,;:!?\n-\r]+")
BREAK = b"."  # cannot be a word
EXACT = "decimal(19,0)"

RELATION = "chunk long, lang string, size long, names binary, relation binary"
# what a slice gives back: rows of chunks (places and ids of its frequent phrases) and rows of phrases
KEPT = pa.schema({"chunk": pa.int64(), "entries": pa.binary(), "id": pa.int64(), "lang": pa.string(), "word": pa.binary(), "left": pa.int64(), "right": pa.int64(), "a": pa.int64()})
KEPT_DDL = "chunk long, entries binary, id long, lang string, word binary, left long, right long, a long"


def tokens(text: str | None) -> list[bytes]:
    """Words and breaks between pieces. On bytes, folding touches A-Z alone."""
    return BREAKS.sub(b" . ", utf8(text).lower()).split()


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, as small as they go; the first one is sorted and kept as steps."""
    parts = []
    for i, c in enumerate(columns):
        c = np.diff(c, prepend=0) if i == 0 else c
        wide = "<i4" if not len(c) or -(1 << 31) <= c.min() and c.max() < 1 << 31 else "<i8"
        # bytes of like weight side by side
        parts.append(wide[2:].encode() + np.ascontiguousarray(c, wide).view(np.uint8).reshape(-1, int(wide[2])).T.tobytes())
    raw = b"".join([len(columns[0]).to_bytes(8, "little"), *parts])
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, at, columns = int.from_bytes(raw[:8], "little"), 8, []
    while at < len(raw):
        wide = int(raw[at : at + 1])
        body = np.frombuffer(raw, np.uint8, n * wide, at + 1).reshape(wide, n)
        columns.append(np.ascontiguousarray(body.T).view(f"<i{wide}").ravel().astype(np.int64))
        at += 1 + n * wide
    columns[0] = np.cumsum(columns[0])
    return columns


class _Chunk:
    """The words of some documents of one language."""

    def __init__(self):
        self.index: defaultdict = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[BREAK]
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, found: list[bytes]) -> None:
        found.append(BREAK)  # documents are apart
        self.codes.append(np.fromiter(map(self.index.__getitem__, found), np.int32, len(found)))
        self.size += len(found)

    def row(self, chunk: int, lang: str) -> pa.RecordBatch:
        line = np.concatenate(self.codes)
        slots = np.flatnonzero(line)
        names = zstandard.ZstdCompressor(level=1).compress(b"\n".join(list(self.index)[1:]))  # a word holds no line end
        columns = [[chunk], [lang], [len(slots)], [names], [_packed(slots, line[slots] - 1)]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, STORED.types)], schema=STORED)


STORED = pa.schema({"chunk": pa.int64(), "lang": pa.string(), "size": pa.int64(), "names": pa.binary(), "relation": pa.binary()})


def first_relation(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """All words, a row per chunk: `names` are its different words, `relation` slots and words, `size` their number."""

    def run(batches):
        task, made, held = TaskContext.get().partitionId() << 32, 0, 0
        open_: dict[str, _Chunk] = {}
        for batch in batches:
            for where, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chunk = open_.setdefault(where, _Chunk())
                held -= chunk.size
                chunk.add(tokens(found))
                held += chunk.size
                full = where if chunk.size >= CHUNK else max(open_, key=lambda k: open_[k].size) if held >= HELD else None
                if full is not None:
                    done = open_.pop(full)
                    held -= done.size
                    made += 1
                    yield done.row(task + made, full)
        for name, done in open_.items():
            made += 1
            yield done.row(task + made, name)

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return cut(rows.mapInArrow(run, RELATION), "words")


def _slices(relation: DataFrame) -> int:
    total = relation.agg(F.sum("size")).first()[0] or 0
    return -(-total // SLICE) or 1


def _dealt(keys: np.ndarray, slices: int) -> list[np.ndarray]:
    """Places of the keys of each slice, in order."""
    home = (mix64(keys.astype(np.uint64)) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    return np.split(order, np.searchsorted(home[order], np.arange(1, slices)))


def _rows(names: list[str], columns: list[list], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


ENTRIES = "slice long, chunk long, lang string, entries binary, words binary"
_ENTRIES = (["slice", "chunk", "lang", "entries", "words"], [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()])


def _kept(base: int, chunks: np.ndarray, locals_: np.ndarray, group: np.ndarray, n: np.ndarray, least: int, describe) -> list[pa.Table]:
    """The groups with a sum of at least `least`, numbered from `base`: their entries by chunk, and themselves.

    Entries come chunk by chunk; `describe` gives lang, word, left and right of entries."""
    total = np.zeros(int(group.max()) + 1, np.int64)
    np.add.at(total, group, n)
    often = total >= least
    at = np.flatnonzero(often[group])
    if not len(at):
        return []
    ids = base + (np.cumsum(often) - 1)[group[at]]
    start = np.flatnonzero(np.r_[True, np.diff(chunks[at]) != 0])
    packed = [_packed(local, number) for local, number in zip(np.split(locals_[at], start[1:]), np.split(ids, start[1:]))]
    named, one = np.unique(ids, return_index=True)
    phrase = pa.Table.from_arrays([pa.nulls(len(named), pa.int64()), pa.nulls(len(named), pa.binary()), pa.array(named), *describe(at[one]), pa.array(total[group[at[one]]])], schema=KEPT)
    blank = [pa.nulls(len(start), k) for k in KEPT.types[2:]]
    return [pa.Table.from_arrays([pa.array(chunks[at][start]), pa.array(packed, pa.binary()), *blank], schema=KEPT), phrase]


def frequent_words(relation: DataFrame, least: int) -> DataFrame:
    """Group-count of all words: `KEPT` rows of the frequent ones."""
    slices = _slices(relation)

    def deal(batches):
        for batch in batches:
            for chunk, lang, size, names, stored in zip(*[c.to_pylist() for c in batch.columns]):
                if not size:
                    continue
                words = zstandard.ZstdDecompressor().decompress(names).split(b"\n")
                n = np.bincount(_unpacked(stored)[1], minlength=len(words))
                keys = np.fromiter(map(crc32, words), np.int64, len(words))
                parts = [(s, at) for s, at in enumerate(_dealt(keys, slices)) if len(at)]
                picked = [zstandard.ZstdCompressor(level=1).compress(b"\n".join([words[i] for i in at.tolist()])) for _, at in parts]
                columns = [[s for s, _ in parts], [chunk] * len(parts), [lang] * len(parts), [_packed(at, n[at]) for _, at in parts], picked]
                yield _rows(_ENTRIES[0], columns, _ENTRIES[1])

    def count(table: pa.Table) -> pa.Table:
        done, base = [], 0
        langs = table.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            part = table.filter(pa.array([x == lang for x in langs]))
            entries = [_unpacked(e) for e in part.column("entries").to_pylist()]
            words = [w for blob in part.column("words").to_pylist() for w in zstandard.ZstdDecompressor().decompress(blob).split(b"\n")]
            chunks = np.repeat(part.column("chunk").to_numpy(), [len(e[0]) for e in entries])
            group, different = pd.factorize(np.array(words, object))

            def describe(at):
                none = pa.nulls(len(at), pa.int64())
                return pa.array([lang] * len(at), pa.string()), pa.array([words[i] for i in at.tolist()], pa.binary()), none, none

            local, n = (np.concatenate(c) for c in zip(*entries))
            done += _kept((table.column("slice")[0].as_py() << 32) + base, chunks, local, group, n, least, describe)
            base += len(different)
        return pa.concat_tables(done) if done else KEPT.empty_table()

    return cut(relation.mapInArrow(deal, ENTRIES).groupBy("slice").applyInArrow(count, KEPT_DDL), "frequent")


def _adjacent(names: bytes, stored: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a chunk's relation with itself, one position on: left and right phrase of each
    different pair, in order, its count, and the slots and pairs of the occurrences."""
    ids = _unpacked(names)[0]
    slots, items = _unpacked(stored)
    at = np.flatnonzero(np.diff(slots) == 1)
    pairs, item, n = np.unique(items[at] * len(ids) + items[at + 1], return_inverse=True, return_counts=True)
    return ids[pairs // len(ids)], ids[pairs % len(ids)], n, slots[at], item, pairs


def frequent_pairs(relation: DataFrame, least: int) -> DataFrame:
    """Group-count of the adjacent pairs of R_k: `KEPT` rows of the frequent ones."""
    slices = _slices(relation)

    def deal(batches):
        for batch in batches:
            for chunk, lang, size, names, stored in zip(*[c.to_pylist() for c in batch.columns]):
                left, right, n, *_ = _adjacent(names, stored)
                if not len(left):
                    continue
                parts = [(s, at) for s, at in enumerate(_dealt(mix64(left.astype(np.uint64)) + right.astype(np.uint64), slices)) if len(at)]
                entries = [_packed(at, n[at], np.diff(left[at], prepend=0), right[at] >> 32, right[at] & 0xFFFFFFFF) for _, at in parts]
                columns = [[s for s, _ in parts], [chunk] * len(parts), [lang] * len(parts), entries, [None] * len(parts)]
                yield _rows(_ENTRIES[0], columns, _ENTRIES[1])

    def count(table: pa.Table) -> pa.Table:
        entries = [_unpacked(e) for e in table.column("entries").to_pylist()]
        chunks = np.repeat(table.column("chunk").to_numpy(), [len(e[0]) for e in entries])
        local, n = (np.concatenate([e[i] for e in entries]) for i in (0, 1))
        left = np.concatenate([np.cumsum(e[2]) for e in entries])
        right = np.concatenate([(e[3] << 32) + e[4] for e in entries])
        order = np.lexsort((right, left))
        new = np.r_[False, (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new)

        def describe(at):
            return pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.binary()), pa.array(left[at]), pa.array(right[at])

        done = _kept(table.column("slice")[0].as_py() << 32, chunks, local, group, n, least, describe)
        return pa.concat_tables(done) if done else KEPT.empty_table()

    return cut(relation.mapInArrow(deal, ENTRIES).groupBy("slice").applyInArrow(count, KEPT_DDL), "frequent")


def semi_joined(relation: DataFrame, kept: DataFrame, words: bool) -> DataFrame:
    """The occurrences of frequent phrases: R_1 from all words, or R_(k+1) from the pairs of R_k."""

    def keep(stored: pa.Table, known: pa.Table) -> pa.Table:
        if not (stored.num_rows and known.num_rows):
            return STORED.empty_table()
        row = stored.to_pylist()[0]
        slots, items = _unpacked(row["relation"]) if words else _adjacent(row["names"], row["relation"])[3:5]
        local, ids = (np.concatenate(c) for c in zip(*map(_unpacked, known.column("entries").to_pylist())))
        order = np.argsort(ids)
        place = np.full(int(items.max()) + 1, -1, np.int64)
        place[local[order]] = np.arange(len(ids))
        items = place[items]
        slots, items = slots[items >= 0], items[items >= 0]
        columns = [[row["chunk"]], [row["lang"]], [len(slots)], [_packed(ids[order])], [_packed(slots, items)]]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, STORED.types)], schema=STORED)

    known = kept.where("chunk IS NOT NULL").select("chunk", "entries")
    sides = relation.groupBy("chunk").cogroup(known.groupBy("chunk"))
    return cut(sides.applyInArrow(keep, RELATION), "relation")


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5) -> tuple[list[DataFrame], DataFrame]:
    """All frequent phrases, and (lang, n): the word occurrences of each language.

    Per length from 1 to `longest` a table (id, lang, words, a, heads, tails, left, right): `heads[k]` and
    `tails[k]` are the counts of the first and the last k + 1 words; `left` and `right` the ids of the
    phrase without its last and without its first word.
    """
    relation = first_relation(docs, text, lang)
    sizes = relation.groupBy("lang").agg(F.sum("size").alias("n"))
    kept = frequent_words(relation, least)
    relation = semi_joined(relation, kept, words=True)
    none = F.lit(None).cast("long")
    own = kept.where("chunk IS NULL").select("id", "lang", F.array(F.col("word").cast("string")).alias("words"), "a")
    found = [cut(own.withColumns({"heads": F.array("a"), "tails": F.array("a"), "left": none, "right": none}), "phrases")]
    for k in range(2, longest + 1):
        kept = frequent_pairs(relation, least)
        if k < longest:
            relation = semi_joined(relation, kept, words=False)
        left = found[-1].select(F.col("id").alias("left"), "lang", "words", "heads")
        right = found[-1].select(F.col("id").alias("right"), F.element_at("words", -1).alias("last"), "tails")
        new = kept.where("chunk IS NULL").select("id", "left", "right", "a").join(left, "left").join(right, "right")
        grown = [F.concat(c, F.array(e)).alias(c) for c, e in (("words", "last"), ("heads", "a"), ("tails", "a"))]
        found.append(cut(new.select("id", "lang", grown[0], "a", *grown[1:], "left", "right"), "phrases"))
    return found, sizes


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, top: int | None = 2000, percent: int = 100
) -> DataFrame:
    """Per language the best `top` phrases (None: all) of two words or more: lang, rank, phrase, a, l, r, n, score.

    Cutting a phrase in two gives floor(1000 a n / (l r)), with n words of the language and counts a, l, r of the
    phrase and its parts; the lowest cut counts, the first of equal ones. A phrase inside a longer one that is
    seen at least `percent` % as often is left out (it is enough to look one word further: what lies
    between is seen at least as often as the longer one).
    """
    found, sizes = phrases(docs, text, lang, least, longest)
    rest = []
    for i, table in enumerate(found[1:], 2):
        if i < longest:
            inside = found[i].select(F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("_longer"))
            inside = inside.groupBy("id").agg(F.max("_longer").alias("_longer"))
            table = table.join(inside, "id", "left").where(f"_longer IS NULL OR 100 * CAST(_longer AS {EXACT}) < {percent} * CAST(a AS {EXACT})")
        rest.append(table.select("lang", "words", "a", "heads", "tails"))
    whole = reduce(DataFrame.union, rest).join(sizes, "lang")
    product = "1000 * CAST(a AS decimal(19,0)) * CAST(n AS decimal(19,0))"
    parts = "CAST(heads[k - 1] AS decimal(19,0)) * CAST(tails[size(words) - k - 1] AS decimal(19,0))"
    cuts = f"transform(sequence(1, size(words) - 1), k -> struct(({product}) div ({parts}) AS score, k AS at, heads[k - 1] AS l, tails[size(words) - k - 1] AS r))"
    whole = whole.withColumn("cut", F.expr(f"array_min({cuts})"))
    whole = whole.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    placed = ranked(whole, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], "scored").withColumn("rank", F.col("rank") + 1)
    if top is not None:
        placed = placed.where(F.col("rank") <= top)
    return placed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(table: str = "documents", least: int = 100, longest: int = 5, top: int = 2000) -> str:
    """The same for DuckDB: all phrases of all pieces unfolded, products as 128-bit integers."""
    lengths = " UNION ALL ".join(
        f"SELECT lang, w[i:i + {m - 1}] AS p FROM pieces, unnest(range(1, len(w) - {m - 2})) AS t(i)" for m in range(1, longest + 1)
    )
    return f"""
WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS piece FROM {table})),
f AS (SELECT lang, p, count(*) AS a FROM ({lengths}) GROUP BY lang, p HAVING count(*) >= {least}),
n AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
cuts AS (SELECT f.lang, f.p, f.a, k, x.a AS l, y.a AS r, n.n, (1000 * f.a::HUGEINT * n.n) // (x.a::HUGEINT * y.a::HUGEINT) AS score
  FROM f JOIN n ON n.lang = f.lang, unnest(range(1, len(f.p))) AS t(k)
  JOIN f x ON x.lang = f.lang AND x.p = f.p[1:k] JOIN f y ON y.lang = f.lang AND y.p = f.p[k + 1:]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT lang, p[i:j] AS p, a FROM f, unnest(range(1, len(p) + 1)) AS t(i), unnest(range(i + 1, len(p) + 1)) AS u(j) WHERE j - i + 1 < len(p)),
kept AS (SELECT s.* FROM scored s WHERE NOT EXISTS (SELECT 1 FROM inside o WHERE o.lang = s.lang AND o.p = s.p AND 100 * o.a >= 100 * s.a))
SELECT lang, row_number() OVER w AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) QUALIFY rank <= {top}"""
