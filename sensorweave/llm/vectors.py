"""Near duplicates among embeddings by an inverted multi-index.

Vectors are scaled to length one and cut in halves. Each half has its own codebook, fitted on a
bounded sample; the pairs of code words form a grid of cells, and every vector lies in one cell.
For a query, the distance to the bisector between its own code word and another bounds from below
how far any vector of that other word must be. The two sorted lists of bounds are walked together,
nearest cells first, until the summed bound leaves the reach: the full radius, so that nothing can
be missed. (`recall` below 1 shortens the reach to where that share was found when the sample was
perturbed alike in all directions; real neighbours of vectors near few dimensions are missed more
often than that.) All pairs met are verified in double precision.

Equal vectors are one class with a multiplicity. The rows of a cell are dealt out in blocks of at
most `BLOCK` queries and `BLOCK` vectors; a block returns counts and a spanning forest of its
links, never its pairs, so dense groups cost arithmetic but no rows.

Defined results: a vector that is NULL, zero, empty, or has NULL or non-finite components, and one
with a NULL label, links with nothing and is its own component; vectors of different lengths do
not link; repeated rows are links of each other (ids are taken to be unique); a NULL id links with nothing
and has a NULL component; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import cut, widened
from sensorweave.llm.components import components

BLOCK = 2048
SAMPLE = 20_000  # documented bound: vectors that the codebooks are fitted on
OCCUPANCY = 256  # vectors of a label and cell aimed at
MOST_WORDS = 256


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """Rows as float64 arrays; NULL components become NaN, NULL rows empty."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.array([0 if n is None else n for n in (column.value_lengths().to_pylist())], np.int64)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Codebook:
    """Two codebooks for vectors of one length, and the reach of a search."""

    def __init__(self, sample: np.ndarray, words: int, radius2: float, recall: float, seed: int = 3):
        half = (sample.shape[1] + 1) // 2
        self.cuts = [slice(0, half), slice(half, sample.shape[1])]
        draw = np.random.default_rng(seed)
        self.words = [self._fit(sample[:, c], words, draw) for c in self.cuts]
        self.radius2 = radius2
        self.reach = radius2 + 1e-9 if recall >= 1 else self._calibrate(sample, recall, draw)

    @staticmethod
    def _fit(x: np.ndarray, words: int, draw, rounds: int = 8) -> np.ndarray:
        x = np.unique(x, axis=0)
        code = x[draw.choice(len(x), min(words, len(x)), replace=False)].copy()
        for _ in range(rounds):
            own = ((code * code).sum(1)[None] - 2 * x @ code.T).argmin(axis=1)
            size = np.bincount(own, minlength=len(code))
            total = np.zeros_like(code)
            np.add.at(total, own, x)
            code[size > 0] = total[size > 0] / size[size > 0, None]
        return code

    def bounds(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per half: own code word, and squared lower bounds of the distance to each word's cell."""
        owns, low = [], []
        for part, code in zip(self.cuts, self.words):
            y = x[:, part]
            d = (y * y).sum(1)[:, None] - 2 * y @ code.T + (code * code).sum(1)[None]
            own = d.argmin(axis=1)
            apart = np.sqrt(np.maximum((code * code).sum(1)[:, None] - 2 * code @ code.T + (code * code).sum(1)[None], 1e-18))
            bound = np.maximum(0.0, (d - d[np.arange(len(y)), own][:, None]) / (2 * apart[own]))
            bound[np.arange(len(y)), own] = 0.0
            owns.append(own)
            low.append(bound * bound)
        return owns, low

    def _calibrate(self, x: np.ndarray, recall: float, draw, tries: int = 10) -> float:
        needed = []
        step = np.sqrt(self.radius2 * (1 - self.radius2 / 4))  # tangent length of a chord of the radius
        _, low = self.bounds(x)
        for _ in range(tries):
            off = draw.standard_normal(x.shape)
            off -= (off * x).sum(1, keepdims=True) * x
            near = (1 - self.radius2 / 2) * x + step * unit(off)
            there = [((code * code).sum(1)[None] - 2 * near[:, part] @ code.T).argmin(1) for part, code in zip(self.cuts, self.words)]
            every = np.arange(len(x))
            needed.append(low[0][every, there[0]] + low[1][every, there[1]])
        return float(min(np.quantile(np.concatenate(needed), recall) * 1.05 + 1e-9, self.radius2 + 1e-9))

    def cells(self, x: np.ndarray) -> np.ndarray:
        owns, _ = self.bounds(x)
        return owns[0].astype(np.int64) * len(self.words[1]) + owns[1]

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all visits: for each word of the first half, nearest first, the words of
        the second half as long as the summed bound stays in reach."""
        _, low = self.bounds(x)
        order = [np.argsort(v, axis=1, kind="stable") for v in low]
        ranked = [np.take_along_axis(v, o, 1) for v, o in zip(low, order)]
        rows, cells = [], []
        live = np.arange(len(x))
        for i in range(low[0].shape[1]):
            live = live[ranked[0][live, i] <= self.reach]
            there = live
            for j in range(low[1].shape[1]):
                there = there[ranked[0][there, i] + ranked[1][there, j] <= self.reach]
                if not len(there):
                    break
                rows.append(there)
                cells.append(order[0][there, i].astype(np.int64) * low[1].shape[1] + order[1][there, j])
            if not len(live):
                break
        return np.concatenate(rows), np.concatenate(cells)


def _prepared(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label, vector, size, digest; a NULL digest marks a vector that links with nothing."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    schema = widened(rows, "size int, digest binary")

    def run(batches):
        for batch in batches:
            digests = []
            vectors = _matrix(batch.column(2))
            for v in vectors:
                fit = len(v) > 0 and np.isfinite(v).all() and v.any()
                digests.append(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() if fit else None)
            sizes = pa.array(np.array([len(v) for v in vectors], np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, pa.array(digests, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _forest(linked: np.ndarray, queries: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of the block's component, for queries and for index vectors."""
    top = np.iinfo(np.int64).max
    q, v = queries.copy(), index.copy()
    while True:
        near = np.where(linked, v[None, :], top).min(axis=1, initial=top)
        q2 = np.minimum(q, near)
        back = np.where(linked, q2[:, None], top).min(axis=0, initial=top)
        v2 = np.minimum(v, back)
        if (q2 == q).all() and (v2 == v).all():
            return q, v
        q, v = q2, v2


def near_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = 0.98,
    recall: float = 1.0,
    block: int = BLOCK,
    sample: int = SAMPLE,
    words: int | None = None,
) -> DataFrame:
    """One row per vector: the key, `n_links`, `component_id`, `kept`. Only equal labels compare."""
    rows = cut(_prepared(df, key, vector, label), "vectors")
    able = rows.where("digest IS NOT NULL AND label IS NOT NULL AND id IS NOT NULL")
    classes = able.groupBy("label", "size", "digest").agg(F.min(F.struct("id", "vector")).alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = cut(classes.select("label", "size", "digest", "least.id", "least.vector", "copies"), "classes")

    # codebooks per vector length, on a bounded sample
    largest = classes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    wanted = words or int(min(MOST_WORDS, max(1, np.ceil(np.sqrt(largest / OCCUPANCY)))))
    drawn = classes.select("size", "vector").orderBy(F.xxhash64("label", "id")).limit(sample).toArrow()
    books: dict[int, Codebook] = {}
    radius2 = 2.0 - 2.0 * cosine
    if drawn.num_rows:
        vectors = _matrix(drawn.column(1).combine_chunks())
        sizes = drawn.column(0).to_numpy()
        for n in np.unique(sizes):
            x = unit(np.stack([vectors[i] for i in np.flatnonzero(sizes == n)]))
            books[int(n)] = Codebook(x, wanted if n > 1 else 1, radius2, recall)

    def placed(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            vectors = _matrix(batch.column(3))
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                x = unit(np.stack([vectors[i] for i in at]))
                book = books.get(int(n))  # a length outside the sample has one cell
                home = book.cells(x) if book else np.zeros(len(at), np.int64)
                seen, cells = book.visits(x) if book else (np.arange(len(at)), np.zeros(len(at), np.int64))
                take = pa.array(np.r_[at, at[seen]])
                query = pa.array(np.r_[np.zeros(len(at), bool), np.ones(len(seen), bool)])
                got = batch.take(take)
                yield pa.RecordBatch.from_arrays([*got.columns, pa.array(np.r_[home, cells]), query], names=[*batch.schema.names, "cell", "query"])

    source = classes.select("label", "size", "id", "vector", "copies")
    schema = widened(source, "cell long, query boolean")
    dealt = cut(source.mapInArrow(placed, schema), "placed")

    # large cells are dealt out: each block of queries meets each block of vectors once
    cell = ["label", "size", "cell"]
    counts = dealt.groupBy(*cell).agg(F.count_if("query").alias("q"), F.count_if(~F.col("query")).alias("v"))
    large = counts.where((F.col("q") > block) | (F.col("v") > block))
    large = large.select(*cell, F.ceil(F.col("q") / block).cast("int").alias("nq"), F.ceil(F.col("v") / block).cast("int").alias("nv"))
    # NULL-free keys; at most 2 * rows / block entries
    both = dealt.join(F.broadcast(large), cell, "left").withColumns({"nq": F.coalesce("nq", F.lit(1)), "nv": F.greatest(F.coalesce("nv", F.lit(1)), F.lit(1))})
    own = F.pmod(F.xxhash64("id"), F.when(F.col("query"), F.greatest("nq", F.lit(1))).otherwise(F.col("nv"))).cast("int")
    across = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), F.col("nv")).otherwise(F.greatest("nq", F.lit(1))) - 1))
    both = both.withColumn("own", own).withColumn("other", across)
    both = both.withColumn("bq", F.when(F.col("query"), F.col("own")).otherwise(F.col("other")))
    both = both.withColumn("bv", F.when(F.col("query"), F.col("other")).otherwise(F.col("own")))

    def met(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy()
        out = [np.empty(0, np.int64)] * 3
        if query.any() and not query.all():
            x = unit(np.stack(_matrix(table.column("vector").combine_chunks())))
            copies = table.column("copies").to_numpy()[~query]
            q, v = ids[query], ids[~query]
            parts = []
            for i in range(0, len(q), block):  # a block by hash may be somewhat larger than `block`
                linked = x[query][i : i + block] @ x[~query].T >= cosine
                linked &= q[i : i + block, None] != v[None, :]
                low_q, low_v = _forest(linked, q[i : i + block], v)
                n = linked @ copies
                told = (n > 0) | (low_q < q[i : i + block])
                hooked = low_v < v
                parts.append((np.r_[q[i : i + block][told], v[hooked]], np.r_[n[told], np.zeros(hooked.sum(), np.int64)], np.r_[low_q[told], low_v[hooked]]))
            out = [np.concatenate(c) for c in zip(*parts)]
        return pa.table({"id": out[0].astype(np.int64), "n": out[1].astype(np.int64), "low": out[2].astype(np.int64)})

    found = both.groupBy(*cell, "bq", "bv").applyInArrow(met, "id long, n long, low long")
    found = cut(found, "met")
    labels = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    linked = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = classes.join(linked, "id", "left").join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("label", "size", "digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    done = rows.join(named, ["label", "size", "digest"], "left")
    known = F.col("id").isNotNull()
    component = F.when(known, F.coalesce("component", "id"))
    return done.select(
        F.col("id").alias(key), F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def sql(table: str = "embeddings", cosine: float = 0.98) -> str:
    """The same for DuckDB, for small tables: all pairs of a label, then all reachable ids."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM {table} WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {cosine}),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r(a, c) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a),
m AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT t.vec_id, coalesce(n.n, 0) AS n_links, coalesce(m.c, t.vec_id) AS component_id, coalesce(m.c, t.vec_id) = t.vec_id AS kept
FROM {table} t LEFT JOIN n ON n.a = t.vec_id LEFT JOIN m ON m.a = t.vec_id"""
