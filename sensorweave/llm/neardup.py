"""Near duplicates by a multi-index Hamming join of MinHash signatures.

A document is the set of its word shingles. Its signature has `CHUNKS` x `WIDTH` symbols of
`SYMBOL_BITS` bits, each the low bits of a MinHash, so two signatures differ in a symbol about as
often as the sets are unlike. By the pigeonhole principle two signatures at a Hamming distance of
at most 2 * CHUNKS - 1 agree in some chunk up to one symbol; enumerating the one allowed error of
each chunk (a key per left-out symbol) therefore finds *all* pairs within that distance. Beyond it
pairs are still found with high probability: a pair of similarity 0.8 is missed once in 70,000.

1. Equal sets form classes (a digest, combined before the shuffle); only the smallest id of a class
   goes on.
2. Keys without errors link each member of a bucket to the bucket's smallest id; links are
   confirmed on the full sets and contracted. That takes dense groups of near copies together.
3. Keys with one error: a bucket is reduced to one row per component *before* the shuffle, so that
   a bucket that a third of all rows share stays small. Pairs between components are confirmed.
4. Buckets where step 3 leaves pairs between components open (a third component, or further
   members of one) make clusters. Their documents are compared block by block inside tasks, between
   components, behind a signature distance test, on the full sets; only links come out.

Pairs inside a component are never compared, pairs are never rows, and no link that could join two
components is left out.

Defined results: NULL text, or text without words, is an empty set that links with nothing; a text
shorter than a shingle is one shingle; repeated rows get equal results (ids are taken to be unique:
rows of one id with different texts are each linked by their own); a NULL id links with nothing and
has a NULL component; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import GOLDEN, cut, mix64, utf8
from sensorweave.llm.components import components

CHUNKS, WIDTH, SYMBOL_BITS = 16, 8, 16
SYMBOLS = CHUNKS * WIDTH
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000  # what one block of a cluster holds about
FAR = 54  # at similarity 0.8 a signature distance beyond this has a chance below 1e-8
LOCAL_ROWS = 8192  # signatures whose keys are combined before the shuffle

_draw = np.random.default_rng(20240229)
_BYTES = _draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = (_draw.integers(0, 1 << 31, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_B = _draw.integers(0, 1 << 32, SYMBOLS, dtype=np.uint64).astype(np.uint32)
_CELL = _draw.integers(0, 1 << 63, (CHUNKS, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WITHOUT = mix64(np.arange(1, CHUNKS * (WIDTH + 1) + 1, dtype=np.uint64) * np.uint64(GOLDEN)).reshape(CHUNKS, WIDTH + 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def words_at(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 bytes, A-Z lower-cased, and where the words begin."""
    solid = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], solid.view(np.int8), [0]))))
    begin = edge[::2]
    if not len(begin):
        return np.empty(0, np.uint64), begin
    start = np.zeros(len(raw), np.int64)
    start[begin] = begin
    place = np.arange(len(raw)) - np.maximum.accumulate(start)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE, np.uint64))
        weighed = np.where(solid, _BYTES[_LOWER[raw]] * powers[place], np.uint64(0))
        return mix64(np.add.reduceat(weighed, begin)), begin


def word_hashes(raw: np.ndarray) -> np.ndarray:
    return words_at(raw)[0]


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `words` words; fewer words make one shingle."""
    found = word_hashes(np.frombuffer(utf8(text), np.uint8))
    if not len(found):
        return found
    n = min(words, len(found))
    with np.errstate(over="ignore"):
        h = np.full(len(found) - n + 1, n, np.uint64)
        for i in range(n):
            h = mix64(h * np.uint64(GOLDEN) + found[i : len(found) - n + 1 + i])
    return np.unique(h)


def signature(found: np.ndarray) -> np.ndarray:
    """`SYMBOLS` low bits of MinHashes; blocks of the set bound the memory."""
    low = np.full(SYMBOLS, 0xFFFFFFFF, np.uint32)
    part = (found >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(part), 1024):
            low = np.minimum(low, (part[i : i + 1024, None] * _A + _B).min(axis=0))
    return low.astype(np.uint16)


def keys(signatures: np.ndarray, errors: int) -> np.ndarray:
    """Keys (rows x keys) of the signatures (flat) whose chunks leave out exactly `errors` (0 or 1) symbols."""
    with np.errstate(over="ignore"):
        cell = signatures.reshape(-1, CHUNKS, WIDTH).astype(np.uint64) * _CELL
        whole = cell.sum(axis=2, dtype=np.uint64)
        if errors == 0:
            found = mix64(whole + _WITHOUT[:, WIDTH])
        else:
            found = mix64(whole[:, :, None] - cell + _WITHOUT[None, :, :WIDTH])
    return found.reshape(len(cell), -1).view(np.int64)


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x, np.int64))


def sketch(docs: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """Per row: id, n (set size), digest of the set, signature."""

    def run(batches):
        for batch in batches:
            sizes, digests, signs = [], [], []
            for t in batch.column(1).to_pylist():
                found = shingles(t, words)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signs.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _longs(sizes), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], names=["id", "n", "digest", "signature"]
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n long, digest binary, signature binary")


def _first(order: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Mask of the first of each run of equal `columns` taken in `order`."""
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for c in columns:
            c = c[order]
            new[1:] |= c[1:] != c[:-1]
    return new


def buckets(nodes: DataFrame, errors: int) -> DataFrame:
    """(key, part, id, more): per key and component the smallest id; `more`: it has other members.

    `nodes` has id, part (component) and signature. Rows are combined over `LOCAL_ROWS` signatures.
    """

    def combined(ids, parts, signs):
        ids, parts = np.asarray(ids, np.int64), np.asarray(parts, np.int64)
        rows = np.lexsort((ids, parts))  # so that one stable sort by key leaves (part, id) in order
        ids, parts = ids[rows], parts[rows]
        found = keys(np.frombuffer(b"".join(signs), np.uint16).reshape(len(rows), -1)[rows].ravel(), errors)
        n, key = found.shape[1], found.ravel()
        order = np.argsort(key, kind="stable")
        key, row = key[order], (order // n).astype(np.int32)
        part = parts[row]
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
        more = np.diff(np.append(start, len(key))) > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(key[start]), pa.array(part[start]), pa.array(ids[row[start]]), pa.array(more)], names=["key", "part", "id", "more"]
        )

    def run(batches):
        held = [[], [], []]
        for batch in batches:
            for column, values in zip(held, batch.columns):
                column.extend(values.to_pylist())
            if len(held[0]) >= LOCAL_ROWS:
                yield combined(*held)
                held = [[], [], []]
        if held[0]:
            yield combined(*held)

    return nodes.select("id", "part", "signature").mapInArrow(run, "key long, part long, id long, more boolean")


def _partition(batches) -> list[np.ndarray]:
    columns = [[], [], [], []]
    for batch in batches:
        for column, values in zip(columns, batch.columns):
            column.append(values.to_numpy(zero_copy_only=False))
    return [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]


def star_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, mixed): in each bucket with several components, every one against the smallest.

    One row per pair and partition. Where that leaves pairs between components open (a third
    component, or further members of one), the bucket's key comes as `mixed`, with NULL a and b.
    """

    def run(batches):
        key, part, ident, more = _partition(batches)
        order = np.lexsort((ident, part, key))
        key, part, ident, more = key[order], part[order], ident[order], more.astype(bool)[order]
        every = np.arange(len(order))
        bucket = np.cumsum(_first(every, key)) - 1
        cell_new = _first(every, key, part)
        cell = np.cumsum(cell_new) - 1
        if not len(order):
            return
        cells = np.bincount(bucket, cell_new)
        several = np.zeros(cell[-1] + 1, bool)
        np.logical_or.at(several, cell, more)
        several |= np.bincount(cell) > 1
        first = np.flatnonzero(cell_new)  # row of the smallest id of each cell
        home = bucket[first]
        wide = cells[home] > 1
        head = np.minimum.reduceat(ident[first], np.flatnonzero(_first(np.arange(len(first)), home)))
        a, b = ident[first][wide], head[home][wide]
        pairs = np.unique(np.stack([a[a != b], b[a != b]], 1), axis=0) if len(a) else np.empty((0, 2), np.int64)
        open_pairs = (np.bincount(home, several) > 0) | (cells > 2)
        mixed = np.unique(key[first][wide & open_pairs[home]])
        n, m = len(pairs), len(mixed)
        empty = np.zeros(m, np.int64)
        blank = np.r_[np.zeros(n, bool), np.ones(m, bool)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[pairs[:, 0], empty], mask=blank),
                pa.array(np.r_[pairs[:, 1], empty], mask=blank),
                pa.array(np.r_[np.zeros(n, np.int64), mixed], mask=~blank),
            ],
            names=["a", "b", "mixed"],
        )

    return rows.repartition("key").mapInArrow(run, "a long, b long, mixed long")


def full_sets(ids: DataFrame, docs: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """(id, found): the whole shingle sets of the documents in `ids`."""

    def run(batches):
        for batch in batches:
            found = [shingles(t, words).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "found"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    return cut(rows.mapInArrow(run, "id long, found array<long>"), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, text: str, key: str, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    sets = full_sets(wanted, docs, text, key, words)
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("found").alias("x")), "a")
    joined = joined.join(sets.select(F.col("id").alias("b"), F.col("found").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    return joined.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def _members(nodes: DataFrame, mixed: DataFrame) -> DataFrame:
    """(key, part, id) of all members of the buckets `mixed`."""

    def run(batches):
        for batch in batches:
            signs = batch.column(2).to_pylist()
            if signs:
                found = keys(np.frombuffer(b"".join(signs), np.uint16), 1)
                place = pa.array(np.repeat(np.arange(len(signs)), found.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ravel()), batch.column(1).take(place), batch.column(0).take(place)], names=["key", "part", "id"]
                )

    rows = nodes.select("id", "part", "signature").mapInArrow(run, "key long, part long, id long")
    return cut(rows.join(mixed, "key", "left_semi"), "members")


def _links_of(table: pa.Table, percent: int) -> pa.Table:
    """Links between components in one pair of blocks: a spanning forest of all that hold on the full sets."""
    own = table.column("own").to_numpy()
    first, second = table.column("bi")[0].as_py(), table.column("bj")[0].as_py()
    ids, root = table.column("id").to_numpy(), table.column("part").to_numpy().copy()
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
    lists = table.column("found").combine_chunks()
    size = lists.value_lengths().to_numpy().astype(np.int64)
    code = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    stop = np.cumsum(size)
    mark = np.zeros(int(code.max()) + 1, bool)
    places = np.arange(len(ids))
    found = []
    for a in np.flatnonzero(own == first):
        other = (root != root[a]) & (places > a if first == second else own == second)
        near = np.flatnonzero(other)
        near = near[100 * np.minimum(size[near], size[a]) >= percent * np.maximum(size[near], size[a])]
        near = near[(signs[near] != signs[a]).sum(axis=1) <= FAR]
        if not len(near):
            continue
        mark[code[stop[a] - size[a] : stop[a]]] = True
        both = np.array([mark[code[stop[b] - size[b] : stop[b]]].sum() for b in near])
        mark[code[stop[a] - size[a] : stop[a]]] = False
        for b in near[100 * both >= percent * (size[near] + size[a] - both)]:
            if root[b] != root[a]:
                found.append((ids[a], ids[b]))
                root[root == root[b]] = root[a]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def crowded_links(nodes: DataFrame, mixed: DataFrame, docs: DataFrame, text: str, key: str, words: int, percent: int) -> DataFrame:
    """Links (a, b) between components that meet in the buckets `mixed`.

    Members of one bucket belong to one cluster. A cluster is dealt out in blocks of bounded size;
    every pair of blocks is compared in one task, on the full sets, and gives links only, as many as
    join components at most: the pairs themselves are never rows.
    """
    members = _members(nodes, mixed)
    heads = members.groupBy("key").agg(F.min("id").alias("head"), (F.min("part") != F.max("part")).alias("several")).where("several")
    stars = cut(members.join(heads, "key").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct(), "stars")
    named = components(stars)
    inside = stars.select(F.col("a").alias("node")).distinct().join(named, "node", "left")
    inside = cut(inside.select(F.col("node").alias("id"), F.coalesce("component", "node").alias("cluster")), "clusters")
    sets = full_sets(inside.select("id"), docs, text, key, words)
    rows = inside.join(nodes, "id").join(sets, "id").select("cluster", "id", "part", "signature", "found")
    rows = cut(rows, "clustered")
    pieces = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum(F.size("found")) / BLOCK_SHINGLES)).cast("int")
    sizes = rows.groupBy("cluster").agg(pieces.alias("pieces"), (F.min("part") != F.max("part")).alias("several")).where("several")
    dealt = rows.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    dealt = dealt.withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other")})
    dealt = dealt.repartition("cluster", "bi", "bj")  # else a whole cluster would stay in one task
    return dealt.groupBy("cluster", "bi", "bj").applyInArrow(lambda table: _links_of(table, percent), "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: the key, `n_shingles`, `component_id`, `kept`."""
    rows = cut(sketch(docs, text, key, words), "sketch")
    classes = rows.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("id", "signature")).alias("least"), F.count(F.lit(1)).alias("copies"), F.max("id").alias("last")
    )
    classes = cut(classes.select("digest", "least.id", "least.signature", (F.col("last") != F.col("least.id")).alias("copied")), "classes")

    links = None
    labels = None

    def nodes() -> DataFrame:
        if labels is None:
            return classes.select("id", F.col("id").alias("part"), "signature")
        found = labels.select(F.col("node").alias("id"), "component")
        return classes.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("part"), "signature")

    def accept(pairs: DataFrame) -> None:
        nonlocal links, labels
        found = cut(confirmed(pairs, docs, text, key, words, percent), "confirmed")
        links = found if links is None else links.unionByName(found)
        labels = components(links)

    def pairs_of(found: DataFrame) -> DataFrame:
        return cut(found.where("a IS NOT NULL").select("a", "b").distinct(), "pairs")

    # keys without errors; each member is first tried with one head only: the one of most buckets
    found = star_pairs(buckets(nodes(), 0)).where("a IS NOT NULL").groupBy("a", "b").count()
    accept(cut(found.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b")), "pairs"))

    # keys with one error, between components
    found = cut(star_pairs(buckets(nodes(), 1)), "found")
    tried = pairs_of(found)
    accept(tried)

    mixed = cut(found.where("mixed IS NOT NULL").select(F.col("mixed").alias("key")).distinct(), "mixed")
    if not mixed.isEmpty():
        rest = cut(crowded_links(nodes(), mixed, docs, text, key, words, percent), "rest")
        if not rest.isEmpty():
            labels = components(links.unionByName(rest))

    found = labels.select(F.col("node").alias("id"), "component")
    named = classes.join(found, "id", "left").where("copied OR component IS NOT NULL")
    named = named.select("digest", F.coalesce("component", "id").alias("component"))
    done = rows.join(named, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return done.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def sql(table: str = "documents", words: int = 4, percent: int = 80) -> str:
    """The same for DuckDB, for small tables: all pairs that share a shingle, then all reachable ids."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {words - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) AS g
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
r(a, c) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a),
m AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id, coalesce(m.c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.a = w.doc_id"""
