"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: words, word pairs, n-grams of character-class runs
(so `Abc!!` and `XYZ!!` share one) and runs of a repeated word. The document frequencies of both
classes, over *all* labelled rows, give each feature a log-count ratio; the indicators are scaled
by it, and a linear hinge-loss model is fitted by dual coordinate descent on a bounded sample.

Defined results: a NULL or empty text has no feature and gets the score of the bias; NULL labels
are not learned from; NULL keys fall in no fold and count as not held out; repeated rows score
alike; an empty table scores to an empty table; without both classes every score is the share of
the class that is there (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorweave.llm.common import cut, mix64, utf8, widened

BITS = 18
SAMPLE_PER_CLASS = 2000  # documented bound: rows of each class that the hinge-loss model is fitted on

_CLASS = np.arange(256, dtype=np.uint8)  # other bytes stand for themselves
_CLASS[list(b" \t\x0b\x0c\r")] = 32
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWERS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _ngrams(codes: np.ndarray, n: int, space: int) -> np.ndarray:
    """Hashes of the n-grams of `codes` in the name space `space`."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    h = np.full(len(codes) - n + 1, space, np.uint64)
    for i in range(n):
        h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(h)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    raw = np.frombuffer(utf8(text), np.uint8)
    if not len(raw):
        return np.empty(0, np.int32)
    with np.errstate(over="ignore"):
        kind = _CLASS[raw]
        starts = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
        lengths = np.diff(np.append(starts, len(raw)))
        sign = kind[starts] > 3
        runs = kind[starts].astype(np.uint64) * np.uint64(4) + np.where(sign, np.minimum(lengths, 3), 0).astype(np.uint64)
        found = [_ngrams(runs, n, n) for n in (1, 2, 3, 4)]

        solid = ~np.isin(raw, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], solid.view(np.int8), [0]))))
        begin = edge[::2]
        if len(begin):
            start = np.zeros(len(raw), np.int64)
            start[begin] = begin
            inside = np.minimum(np.arange(len(raw)) - np.maximum.accumulate(start), 63)
            weighed = np.where(solid, _LOWER[raw].astype(np.uint64) * _POWERS[inside], np.uint64(0))
            words = mix64(np.add.reduceat(weighed, begin))
            same = words[1:] == words[:-1]
            repeats = np.append(same, False).astype(np.uint64)
            found += [_ngrams(words, 1, 11), _ngrams(words, 2, 12), _ngrams(repeats, 3, 13)]
        hashes = np.concatenate(found)
    seen = np.zeros(1 << BITS, bool)
    seen[(hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # per feature, log-count ratio already multiplied in
    bias: float

    def score(self, found: np.ndarray) -> float:
        margin = float(self.weights[found].sum()) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -60, 60))))


def descend(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray, c: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss; the bias is a constant feature."""
    weights, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = [ratio[r] for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            slope = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), c)
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-6 * c:
            break
    return weights, bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "quality",
    key: str = "doc_id",
    sample_per_class: int = SAMPLE_PER_CLASS,
    c: float = 1.0,
    epochs: int = 20,
    smooth: float = 1.0,
    seed: int = 7,
) -> Model:
    """Fit on the documents that `labels` gives a 0/1 label.

    Log-count ratios are taken over all of them; the hinge-loss model sees at most
    `sample_per_class` of each class, those with the smallest keyed hash of the key. The texts are
    joined and read once: one pass leaves the counts and the features of the sample.
    """
    marked = labels.where(F.col(label).isin(0, 1)).select(
        F.col(key).alias("key"), F.col(label).cast("int").alias("label"), F.xxhash64(F.lit(seed), F.col(key)).alias("draw")
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy("draw"))
    last = marked.withColumn("rank", rank).where(F.col("rank") <= sample_per_class).groupBy("label").agg(F.max("draw"))
    bound = {0: None, 1: None} | dict(last.collect())  # two rows
    chosen = F.coalesce(F.col("draw") <= F.when(F.col("label") == 0, F.lit(bound[0])).otherwise(F.lit(bound[1])), F.lit(False))
    # labels grow with the documents: a shuffle join at every size, never a broadcast
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(marked.hint("merge"), "key")
    rows = rows.select("text", "label", chosen.alias("chosen"))

    def read(batches):
        totals = np.zeros((2, 1 << BITS), np.int64)
        size = [0, 0]
        names = ["feature", "n0", "n1", "label", "found"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
        for batch in batches:
            drawn = []
            for words, y, chosen in zip(*(c.to_pylist() for c in batch.columns)):
                found = features(words)
                totals[y, found] += 1
                size[y] += 1
                if chosen:
                    drawn.append((y, found))
            blank = [None] * len(drawn)
            columns = [blank, blank, blank, [d[0] for d in drawn], [d[1] for d in drawn]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        place = np.flatnonzero(totals.any(axis=0))
        counts = [np.append(place, -1), np.append(totals[0, place], size[0]), np.append(totals[1, place], size[1])]
        blank = [None] * (len(place) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*counts, blank, blank], kinds)], names=names)

    once = cut(rows.mapInArrow(read, "feature long, n0 long, n1 long, label int, found array<int>"), "features")
    tally = once.where("feature IS NOT NULL").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    tally = tally.toArrow().to_pandas()  # at most 2^BITS + 1 rows
    size = tally[tally.feature == -1][["n0", "n1"]].to_numpy().sum(axis=0)
    if not len(size) or size.min() == 0:
        share = 0.5 if not len(size) or size.max() == 0 else float(size[1] > 0)
        return Model(np.zeros(1 << BITS, np.float32), {0.5: 0.0, 1.0: 30.0, 0.0: -30.0}[share])
    tally = tally[tally.feature >= 0]
    log_ratio = np.log((tally.n1 + smooth) / (size[1] + 2 * smooth)) - np.log((tally.n0 + smooth) / (size[0] + 2 * smooth))
    ratio = np.zeros(1 << BITS)
    ratio[tally.feature.to_numpy()] = log_ratio.to_numpy()

    sample = once.where("feature IS NULL").select("label", "found").toArrow()  # bounded by the sample
    lists = sample.column(1).combine_chunks()
    found = [lists[i].values.to_numpy() for i in range(len(lists))]
    sign = np.where(sample.column(0).to_numpy() == 1, 1.0, -1.0)
    # one row order whatever the partitions, so that the fit is repeatable
    order = sorted(range(len(sample)), key=lambda i: (sign[i], found[i].tobytes()))
    weights, bias = descend([found[i] for i in order], sign[order], ratio, c, epochs, seed)
    return Model((weights * ratio).astype(np.float32), bias)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns plus `score` (0 to 1) and `predicted` (1 from 0.5 on) of each whole text."""
    columns = [F.col(c) for c in keep]
    schema = widened(docs.select(*columns), "score double, predicted int")
    names = schema.names

    def run(batches):
        for batch in batches:
            scores = np.array([model.score(features(t)) for t in batch.column(batch.num_columns - 1).to_pylist()], float)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=names)

    return docs.select(*columns, F.col(text).alias("_text")).mapInArrow(run, schema)


def accept(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose score is at least `least`."""
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            mask = [model.score(features(t)) >= least for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
