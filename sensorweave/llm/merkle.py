"""Document fingerprints: Merkle trees over sections, paragraphs and word groups.

A paragraph is a line, cut into leaves where a word's hash says so (content-defined, about
`LEAF_WORDS` words), so an edit changes the leaves it touches and no others. Paragraphs form
sections, cut at blank lines and where a paragraph's hash says so. Every byte of the text is in one
leaf; a node's hash is made of its children's. The fingerprint is

    root ":" section ("/" section)*,  section = hash8 "=" paragraph ("." paragraph)*

where a paragraph is the 8-digit hashes of its leaves. Equal roots mean equal texts; `changed`
compares two fingerprints from the top and names the differing paragraphs.

Defined results: a NULL text is an empty one; an empty text has a root and no section; two empty
texts have likeness 1, an empty and another one 0; texts without letters or of one word are trees
of one leaf; repeated rows have equal fingerprints; rows of one key are ordered by text; a NULL key
comes last; an empty table gives an empty table. A document that is alone is its own next one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import mix64, utf8

LEAF_WORDS = 6
SECTION_PARAGRAPHS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = np.random.default_rng(99).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _rolled(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash for each run of `values`, order-dependent."""
    lengths = np.diff(np.append(starts, len(values)))
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, np.uint64))
    return mix64(np.add.reduceat(values * powers[place], starts) + lengths.astype(np.uint64))


def _starts(last: np.ndarray) -> np.ndarray:
    """Starts of the runs that end where `last` is set (the final run ends anyway)."""
    return np.flatnonzero(np.concatenate(([True], last[:-1])))


def tree(text: str | None) -> tuple[str, np.ndarray]:
    """Fingerprint of a whole text, and its sorted distinct leaf hashes (32 bits)."""
    raw = np.frombuffer(utf8(text), np.uint8)
    if not len(raw):
        return hashlib.blake2b(b"", digest_size=8).hexdigest() + ":", np.empty(0, np.uint32)
    with np.errstate(over="ignore"):
        solid = ~_SPACE[raw]
        begin = np.flatnonzero(solid & ~np.concatenate(([False], solid[:-1])))
        begin = np.union1d([0], begin[1:]) if len(begin) else np.array([0])  # words carry the white space after them
        word = _rolled(_BYTES[raw], begin)
        breaks = np.add.reduceat((raw == 10).astype(np.int64), begin)
        leaf_start = _starts((breaks > 0) | (word % np.uint64(LEAF_WORDS) == 0))
        leaf = _rolled(word, leaf_start)
        leaf_breaks = np.add.reduceat(breaks, leaf_start)
        para_start = _starts(leaf_breaks > 0)
        para = _rolled(leaf, para_start)
        blank = np.maximum.reduceat(leaf_breaks, para_start) > 1
        section_start = _starts(blank | (para % np.uint64(SECTION_PARAGRAPHS) == 0))
        section = _rolled(para, section_start)
    root = hashlib.blake2b(section.tobytes() + leaf.tobytes() + len(raw).to_bytes(8, "little"), digest_size=8).hexdigest()
    short = (leaf >> np.uint64(32)).astype(np.uint32)
    digits = short.astype(">u4").tobytes().hex()
    ends = np.append(para_start[1:], len(leaf))
    paragraphs = [digits[8 * a : 8 * b] for a, b in zip(para_start.tolist(), ends.tolist())]
    heads = (section >> np.uint64(32)).astype(">u4").tobytes().hex()
    stops = np.append(section_start[1:], len(para)).tolist()
    parts = [heads[8 * i : 8 * i + 8] + "=" + ".".join(paragraphs[a:b]) for i, (a, b) in enumerate(zip(section_start.tolist(), stops))]
    return root + ":" + "/".join(parts), np.unique(short)


def likeness(a: np.ndarray, b: np.ndarray, same_root: bool = False) -> float:
    """Jaccard similarity of two leaf sets."""
    if same_root or (not len(a) and not len(b)):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def leaves(fingerprint: str) -> np.ndarray:
    """Sorted distinct leaf hashes of a fingerprint."""
    body = "".join(p.split("=", 1)[1] for p in fingerprint.split(":", 1)[1].split("/") if p).replace(".", "")
    return np.unique(np.frombuffer(bytes.fromhex(body), ">u4").astype(np.uint32))


def changed(before: str, after: str) -> list[tuple[int, int]]:
    """(section, paragraph) places of `before` whose branch does not occur in `after`."""
    if before.split(":", 1)[0] == after.split(":", 1)[0]:
        return []
    split = [[p.split("=", 1) for p in f.split(":", 1)[1].split("/") if p] for f in (before, after)]
    sections = {s for s, _ in split[1]}
    paragraphs = {p for s, body in split[1] for p in body.split(".")}
    return [
        (i, j)
        for i, (head, body) in enumerate(split[0])
        if head not in sections
        for j, p in enumerate(body.split("."))
        if p not in paragraphs
    ]


class _Row:
    __slots__ = ("found", "key", "print_", "text")

    def __init__(self, key, text):
        self.key, self.text = key, text or ""
        self.print_, self.found = tree(self.text)


def _edited(row: _Row, after: _Row) -> tuple:
    n = len(row.text)
    text = row.text[: n - n // 3] + after.text[: n // 3]
    print_, found = tree(text)
    same = print_ == row.print_
    return (
        row.key, n, hashlib.sha256(utf8(text)).hexdigest(), row.print_, print_,
        likeness(row.found, found, same), likeness(row.found, after.found, row.print_ == after.print_),
    )


def _placed(docs: DataFrame, key: str, count: int) -> tuple[np.ndarray, list[tuple]]:
    """Bounds that deal the keys out evenly, and per non-empty part its largest key and the part before it.

    Only keys are read; a number per partition comes back.
    """
    share = [i / count for i in range(1, count)]
    found = docs.agg(F.percentile_approx(key, share, 100 * count)).first()[0] if share else []
    bounds = np.unique(np.array(found or [], np.int64))
    heads = docs.select(F.col(key).alias("key")).withColumn("part", _part(bounds)("key"))
    tops = heads.groupBy("part").agg(F.max("key").alias("top")).orderBy("part").collect()
    return bounds, [(r.top, tops[i - 1].part) for i, r in enumerate(tops)]


def _part(bounds: np.ndarray):
    """Arrow function: part of a key, by descending keys, NULL last."""

    @F.pandas_udf("int")
    def part(key: pd.Series) -> pd.Series:
        missing = key.isna()
        place = np.searchsorted(bounds, key.fillna(0).to_numpy().astype(np.int64), side="right")
        return pd.Series(np.where(missing, len(bounds), len(bounds) - place).astype(np.int32))

    return part


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are dealt out once, by ranges of the (whole-number) key, and read in descending order. The
    first row of a part also goes to the part before it, where it is the next document of the last
    row; that of the first part goes to the last one.
    """
    spark = docs.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    bounds, tops = _placed(rows.select("key"), "key", count)
    heads = spark.createDataFrame(tops, "top long, before int")  # a row a part
    rows = rows.withColumn("part", _part(bounds)("key"))
    rows = rows.join(F.broadcast(heads), F.col("key").eqNullSafe(F.col("top")), "left")
    own = F.struct(F.col("part"), F.lit(0).alias("seam"))
    copy = F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("part"), F.lit(1).alias("seam")))
    rows = rows.select("key", "text", F.explode(F.array_compact(F.array(own, copy))).alias("at")).select("at.*", "key", "text")
    rows = rows.repartitionById(len(bounds) + 1, F.col("part"))
    rows = rows.sortWithinPartitions("seam", F.col("key").desc_nulls_last(), "text").select("seam", "key", "text")
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        before, closed = None, False
        for batch in batches:
            out = []
            for seam, k, t in zip(*(c.to_pylist() for c in batch.columns)):
                if closed:  # rows that share the key of the first row of the next part
                    continue
                row = _Row(k, t)
                if before is not None:
                    out.append(_edited(before, row))
                before, closed = row, bool(seam)
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)

    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(run, schema).withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
