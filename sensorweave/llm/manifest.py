"""A Merkle manifest of a dataset, stored in a van Emde Boas layout.

Every row is a leaf: a hash over its fields, each with its length in front. The leaves of a tree
(one per value of a column) stand in a total order; every two consecutive nodes have the hash of
their digests as parent, a node left over is hashed alone, up to the subroot. The subroots are the
leaves of one more tree, whose root stands for the whole dataset.

Layout. A tree of height H is split at half its height into a top tree and the bottom trees below
it, and these again. A subtree of at most `MOST` levels of edges is one stored row: an array of
digests, laid out inside by the same rule down to single nodes. Where a node lies follows from its
depth and index alone (`addresses`), so a path of h nodes inside a row touches O(log h) distant
places, whatever the size of a cache line.

On Spark. Leaves are ranked by a range shuffle (`ranks`), grouped by subtree and built in tasks that
hold at most 2 ** `MOST` leaves; the roots of the subtrees are the leaves of the next slab, up to one
root per tree. Proofs go the other way: each stored row gets the path of its root from the row
above, and hands it on with its own siblings. A tree of 10 ** 10 leaves has five slabs. No group
grows with the data: one tree with a third of all rows just has more subtrees.

Defined results: NULL fields are `-`; a NULL tree key is a tree of its own, before the others;
leaves of equal order are ordered by their digest, so repeated rows are neighbours and equal rows
are interchangeable, each with a leaf and a proof; empty texts are values of length 0; extra columns
are ignored; an empty table has no tree, no root and gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sensorweave.llm.common import cut
from sensorweave.llm.ranks import ranked

MOST = 10  # height of the largest subtree that is one stored row
DIGEST = 32  # bytes
ALONE, LEFT, RIGHT = b"-", b"l", b"r"  # where the sibling of a node stands
STEP = DIGEST + 1  # bytes of a path step with a sibling


def row_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 over the fields: `-` for NULL, else UTF-8 byte count, `:`, value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def heights(height: int) -> list[int]:
    """Heights of the slabs of stored rows, from the leaves up: halves of halves, until they fit."""
    if height <= MOST:
        return [height]
    top = height // 2
    return heights(height - top) + heights(top)


@functools.cache
def _splits(height: int) -> list[tuple[int, int, int]]:
    """For each depth below the root: depth of the root of the top tree over it, nodes of that top
    tree, nodes of a bottom tree that begins here."""
    found: list[tuple[int, int, int]] = [(0, 0, 0)] * (height + 1)

    def split(first: int, levels: int) -> None:
        if levels > 1:
            upper = levels // 2
            found[first + upper] = (first, (1 << upper) - 1, (1 << levels - upper) - 1)
            split(first, upper)
            split(first + upper, levels - upper)

    split(0, height + 1)
    return found


def addresses(height: int, index: np.ndarray) -> list[np.ndarray]:
    """Per depth, where the nodes on the paths from the root to the leaves `index` are stored."""
    splits, found = _splits(height), [np.zeros(len(index), np.int64)]
    for depth in range(1, height + 1):
        above, top, bottom = splits[depth]
        node = index >> (height - depth)
        found.append(found[above] + top + (node & top) * bottom)
    return found


def _hash(*digests: bytes) -> bytes:
    """Digest of digests, which are hashed as hexadecimal text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def subtree(leaves: list[bytes], height: int) -> tuple[bytes, bytes]:
    """The stored array of a subtree (missing nodes are zero) and its root."""
    nodes = np.zeros((2 << height) - 1, f"V{DIGEST}")
    level = leaves
    for depth in range(height, -1, -1):
        nodes[_at(height, depth, np.arange(len(level)))] = np.frombuffer(b"".join(level), f"V{DIGEST}")
        if depth:
            level = [_hash(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return nodes.tobytes(), level[0]


def _at(height: int, depth: int, node: np.ndarray) -> np.ndarray:
    """Places of the nodes `node` of a depth."""
    return addresses(height, node << (height - depth))[depth]


def siblings(nodes: bytes, height: int, n: int, index: np.ndarray) -> list[bytes]:
    """Paths of the leaves `index` of a stored subtree with `n` leaves: per level, from the leaf up,
    where the sibling stands, and its digest if there is one."""
    counts = [-(-n >> (height - depth)) for depth in range(height + 1)]  # nodes of each depth
    steps: list[list[bytes]] = [[] for _ in index]
    for depth in range(height, 0, -1):
        node = index >> (height - depth)
        other = node ^ 1
        for step, i, j, p in zip(steps, node.tolist(), other.tolist(), _at(height, depth, other).tolist()):
            if j >= counts[depth]:
                step.append(ALONE)
            else:
                step.append((LEFT if j < i else RIGHT) + nodes[p * DIGEST : (p + 1) * DIGEST])
    return [b"".join(s) for s in steps]


def fold(digest: bytes, path: bytes) -> tuple[bytes, bytes]:
    """The root that follows from a digest and the siblings on its path, and the hash of the siblings."""
    met, at = [], 0
    while at < len(path):
        side = path[at : at + 1]
        if side == ALONE:
            digest, at = _hash(digest), at + 1
            continue
        other = path[at + 1 : at + STEP]
        met.append(other)
        digest = _hash(other, digest) if side == LEFT else _hash(digest, other)
        at += STEP
    return digest, _hash(*met)


@dataclass
class Trees:
    """Stored subtrees of trees of one kind, by slab from the leaves up; `leaves` has rank and block."""

    leaves: DataFrame
    slabs: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest): one row per tree."""
        done = [s.where(F.size("slabs") == i + 1).select("tree", F.col("root").alias("digest")) for i, s in enumerate(self.slabs)]
        return functools.reduce(DataFrame.union, done)


STORED = pa.schema(
    {"tree": pa.binary(), "block": pa.int64(), "height": pa.int32(), "slabs": pa.list_(pa.int32()), "n": pa.int32(), "nodes": pa.binary(), "root": pa.binary()}
)


def _stored(rows: DataFrame) -> DataFrame:
    """The subtrees of a slab from (tree, block, index, digest, height, slabs)."""

    def build(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("index").to_numpy())
        leaves = table.column("digest").take(pa.array(order)).to_pylist()
        nodes, root = subtree(leaves, table.column("height")[0].as_py())
        head = {c: table.column(c)[0].as_py() for c in ("tree", "block", "height", "slabs")}
        return pa.Table.from_pylist([head | {"n": len(leaves), "nodes": nodes, "root": root}], STORED)

    return rows.groupBy("tree", "block").applyInArrow(build, "tree binary, block long, height int, slabs array<int>, n int, nodes binary, root binary")


def grow(leaves: DataFrame, order: Sequence[Column], label: str) -> Trees:
    """Trees over `leaves` (tree binary, digest binary, and what `order` and the caller need)."""
    plan = F.expr("array({})".format(", ".join("array({})".format(", ".join(map(str, heights(h)))) for h in range(64))))
    height = F.when(F.col("size") == 1, 0).otherwise(F.length(F.bin(F.col("size") - 1)))
    rows = ranked(leaves, "tree", order, label).withColumn("slabs", F.element_at(plan, height + 1))
    rows = rows.withColumn("block", F.expr("shiftright(rank, slabs[0])"))
    slabs: list[DataFrame] = []
    level = rows.select("tree", "block", F.col("rank").alias("index"), "digest", F.col("slabs")[0].alias("height"), "slabs")
    while True:
        slabs.append(cut(_stored(level), f"{label}-slab"))
        s = len(slabs)
        level = slabs[-1].where(F.size("slabs") > s)
        if level.isEmpty():
            return Trees(rows, slabs)
        level = level.select("tree", F.expr(f"shiftright(block, slabs[{s}])").alias("block"), F.col("block").alias("index"), F.col("root").alias("digest"), F.col("slabs")[s].alias("height"), "slabs")


UP = "path binary, subroot binary, top binary"


def _handed_down(rows: DataFrame) -> DataFrame:
    """(tree, index, digest, path, subroot, top) of the leaves of stored subtrees, from subtrees with the
    path, subroot and top of their own roots."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for tree, block, height, n, nodes, path, subroot, top in zip(*[c.to_pylist() for c in batch.columns]):
                places = _at(height, height, np.arange(n)).tolist()
                for i, step in enumerate(siblings(nodes, height, n, np.arange(n))):
                    digest = nodes[places[i] * DIGEST : (places[i] + 1) * DIGEST]
                    for column, value in zip(out, (tree, (block << height) + i, digest, step + path, subroot, top)):
                        column.append(value)
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["tree", "index", "digest", "path", "subroot", "top"])

    columns = rows.select("tree", "block", "height", "n", "nodes", "path", "subroot", "top")
    return columns.mapInArrow(run, f"tree binary, index long, digest binary, {UP}")


def _paths(trees: Trees, tops: DataFrame) -> DataFrame:
    """(tree, block, path, subroot, top) of the stored rows of the lowest slab; `tops` has
    (tree, path, subroot, top) of each tree's root."""
    above = None
    for s in range(len(trees.slabs) - 1, -1, -1):
        slab = trees.slabs[s].drop("root")
        ends = slab.where(F.size("slabs") == s + 1).join(tops, "tree").select("tree", "block", "path", "subroot", "top")
        if above is not None:
            ends = ends.union(above.select("tree", F.col("index").alias("block"), "path", "subroot", "top"))
        if s == 0:
            return cut(ends, "paths")
        above = cut(_handed_down(slab.join(ends, ["tree", "block"])), "handed-down")
    raise AssertionError("a tree has a slab")


@dataclass
class Manifest:
    """The trees of a dataset and the tree over their subroots."""

    trees: Trees
    over: Trees

    def root(self) -> str | None:
        """Hex root of the dataset; None without rows."""
        row = self.over.roots().first()
        return row.digest.hex() if row else None

    def proofs(self, claim: str, keep: Sequence[str]) -> DataFrame:
        """Per leaf: `keep`, leaf, subroot, root, proof_sha256, folded_root (hex), verified.

        `claim` is a binary column of the leaves: the digest that is checked against the root.
        """
        whole = self.over.roots().select("tree", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("top"))
        slab = self.over.slabs[0].drop("root").join(_paths(self.over, whole), ["tree", "block"])
        order = self.over.leaves.select(F.col("rank").alias("index"), "name")
        tops = cut(_handed_down(slab).join(order, "index").select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "top"), "tops")
        below = self.trees.slabs[0].drop("root", "slabs").join(_paths(self.trees, tops), ["tree", "block"])
        leaves = self.trees.leaves.select("tree", "block", F.col("rank").alias("index"), F.col("digest").alias("leaf"), F.col(f"k_{claim}").alias("claim"), *[F.col(f"k_{c}") for c in keep])
        schema = StructType([StructField(c, self.trees.leaves.schema[f"k_{c}"].dataType) for c in keep])
        text = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
        for name in text:
            schema = schema.add(name, "string")
        schema = schema.add("verified", "boolean")

        def check(rows: pa.Table, stored: pa.Table) -> pa.Table:
            found = {k: v[0] for k, v in stored.drop_columns(["tree", "block"]).to_pydict().items()}
            index = rows.column("index").to_numpy() & ((1 << found["height"]) - 1)
            subroot, top = found["subroot"].hex(), found["top"].hex()
            out: list[list] = [[], [], [], [], [], []]
            steps = siblings(found["nodes"], found["height"], found["n"], index)
            for leaf, claimed, step in zip(rows.column("leaf").to_pylist(), rows.column("claim").to_pylist(), steps):
                folded, proof = fold(claimed, step + found["path"])
                for column, value in zip(out, (leaf.hex(), subroot, top, proof.hex(), folded.hex(), folded == found["top"])):
                    column.append(value)
            return pa.table([*[rows.column(f"k_{c}") for c in keep], *map(pa.array, out)], names=[*keep, *text, "verified"])

        return leaves.groupBy("tree", "block").cogroup(below.groupBy("tree", "block")).applyInArrow(check, schema)


def build(rows: DataFrame, digest: str, tree: str, order: Sequence[str]) -> Manifest:
    """The manifest of `rows`: `digest` is a column of hex leaf digests, `tree` the string column that
    names the tree of a row, `order` the columns that order the leaves (NULL first)."""
    # a key that is never NULL and sorts NULL first, then by UTF-8 bytes
    key = F.when(F.col(tree).isNull(), F.lit(b"\0")).otherwise(F.concat(F.lit(b"\1"), F.col(tree).cast("binary")))
    leaves = rows.withColumn("_tree", key).withColumn("_digest", F.unhex(digest))
    kept = [F.col(c).alias(f"k_{c}") for c in rows.columns]
    leaves = leaves.select(F.col("_tree").alias("tree"), F.col("_digest").alias("digest"), *kept)
    trees = grow(leaves, [*[F.col(f"k_{c}") for c in order], F.col("digest")], "leaves")
    roots = trees.roots().select(F.lit(b"").alias("tree"), F.col("tree").alias("name"), "digest")
    return Manifest(trees, grow(roots, [F.col("name")], "subroots"))


def sql(table: str = "documents", modulus: int = 7) -> str:
    """The same for DuckDB: both trees level by level, CRC-32 by its table, proofs folded as lists."""
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')".format
    leaf = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
    return f"""
WITH RECURSIVE crc(i, step, c) AS (SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM crc WHERE step < 8),
byte AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE step = 8),
d AS (SELECT doc_id, lang, {leaf.format(n="n_chars")} AS leaf, {leaf.format(n="(n_chars::HUGEINT + 1)")} AS altered,
  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
    lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT)), lambda a, b: xor(a >> 8, byte.t[(xor(a, b) & 255) + 1]))) % {modulus} = 0 AS chosen
  FROM {table}, byte),
l AS (SELECT *, CASE WHEN chosen THEN altered ELSE leaf END AS claim, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY lang) AS n FROM d),
low(lang, level, i, n, h) AS (SELECT lang, 0, i, n, leaf FROM l
  UNION ALL SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lang, level, i // 2, n),
sub AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
up(level, i, n, h) AS (SELECT 0, i, n, h FROM sub
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY level, i // 2, n),
step AS (SELECT l.lang, l.i, o.level, CASE WHEN o.i = (l.i >> o.level) THEN '-' WHEN o.i < (l.i >> o.level) THEN 'l' || o.h ELSE 'r' || o.h END AS s
  FROM l JOIN low o ON o.lang IS NOT DISTINCT FROM l.lang AND o.n > 1
    AND o.i = CASE WHEN xor(l.i >> o.level, 1) < o.n THEN xor(l.i >> o.level, 1) ELSE l.i >> o.level END),
step_up AS (SELECT s.lang, o.level, CASE WHEN o.i = (s.i >> o.level) THEN '-' WHEN o.i < (s.i >> o.level) THEN 'l' || o.h ELSE 'r' || o.h END AS s
  FROM sub s JOIN up o ON o.n > 1 AND o.i = CASE WHEN xor(s.i >> o.level, 1) < o.n THEN xor(s.i >> o.level, 1) ELSE s.i >> o.level END),
path AS (SELECT lang, i, list(s ORDER BY level) AS p FROM step GROUP BY ALL),
path_up AS (SELECT lang, list(s ORDER BY level) AS p FROM step_up GROUP BY ALL),
whole AS (SELECT l.doc_id, l.leaf, sub.h AS subroot, (SELECT h FROM up WHERE n = 1) AS root, l.claim,
  list_concat(coalesce(path.p, []), coalesce(path_up.p, [])) AS p
  FROM l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang LEFT JOIN path ON path.lang IS NOT DISTINCT FROM l.lang AND path.i = l.i
  LEFT JOIN path_up ON path_up.lang IS NOT DISTINCT FROM l.lang),
done AS (SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: substr(x, 2)), '')) AS proof_sha256,
  list_reduce(list_prepend(claim, p), lambda a, x: sha256(CASE substr(x, 1, 1) WHEN '-' THEN a WHEN 'l' THEN substr(x, 2) || a ELSE a || substr(x, 2) END)) AS folded_root FROM whole)
SELECT *, folded_root = root AS verified FROM done"""
