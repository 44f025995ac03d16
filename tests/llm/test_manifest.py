"""Merkle manifest: stored layout, roots and proofs against a plain tree and against SQL."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorweave.llm import manifest
from sensorweave.llm.queries import op11_manifest


def h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def plain(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and paths by lists of lists."""
    paths: list[list] = [[] for _ in leaves]
    at, level = list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, i in zip(paths, at):
            path.append(("-", "") if i ^ 1 >= len(level) else ("l" if i & 1 else "r", level[i ^ 1]))
        at = [i >> 1 for i in at]
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


@pytest.mark.parametrize("height", range(9))
def test_addresses_name_each_node_once(height):
    """All nodes have places of their own, without gaps; a bottom tree is one stretch."""
    places = {}
    for depth, column in enumerate(manifest.addresses(height, np.arange(1 << height))):
        for leaf, place in enumerate(column.tolist()):
            places.setdefault((depth, leaf >> (height - depth)), set()).add(place)
    assert all(len(p) == 1 for p in places.values())
    assert sorted(p for (p,) in places.values()) == list(range((2 << height) - 1))
    cut = (height + 1) // 2
    for root in range(1 << cut) if height else ():
        inside = [p for (depth, i), (p,) in places.items() if depth >= cut and i >> (depth - cut) == root]
        assert max(inside) - min(inside) == len(inside) - 1


def test_heights_are_halves():
    assert manifest.heights(0) == [0] and manifest.heights(10) == [10]
    assert manifest.heights(33) == [9, 8, 8, 8]
    assert all(sum(manifest.heights(n)) == n and max(manifest.heights(n)) <= manifest.MOST for n in range(64))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_subtree_and_folding(n):
    leaves = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]
    height = (n - 1).bit_length()
    nodes, root = manifest.subtree(leaves, height)
    want, paths = plain([x.hex() for x in leaves])
    assert root.hex() == want
    for leaf, step, path in zip(leaves, manifest.siblings(nodes, height, n, np.arange(n)), paths):
        folded, proof = manifest.fold(leaf, step)
        assert folded == root and proof.hex() == h(*[d for _, d in path])
        assert manifest.fold(bytes(32), step)[0] != root


def _fields(row) -> str:
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, row.text))


@pytest.mark.parametrize("most", [2, 10])
def test_against_plain_trees(docs, corpus, monkeypatch, most):
    """Trees of every shape, small stored rows, NULL and repeated keys, two trees of one leaf."""
    monkeypatch.setattr(manifest, "MOST", most)
    draw = random.Random(most)
    rows = [(i, draw.choice(["", "a b", None, "ü" * 50]), draw.choice(["en", "en", "de", None]), draw.choice(["s", None])) for i in range(70)]
    rows += [(7, "other", "en"), (7, "other", "en"), (None, "x", "en"), (None, "y", "en"), (900, "x", "zz"), (901, "long " * 50_000, "")]
    table = docs(rows).withColumn("rank", F.lit(1)).withColumn("tree", F.lit("clash"))  # columns of the same names as ours
    table = table.withColumn("n_chars", F.when(F.col("doc_id") % 5 != 0, F.col("n_chars")))
    leaf = manifest.row_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    claim = F.when(F.col("doc_id") == 3, F.unhex(F.sha2(F.lit("no").cast("binary"), 256))).otherwise(F.unhex(leaf))
    built = manifest.build(table.select("*", leaf.alias("leaf"), claim.alias("claim")), "leaf", "lang", ["doc_id"])
    got = built.proofs("claim", keep=["doc_id", "rank"]).collect()

    trees: dict = {}
    for row in table.collect():
        trees.setdefault(row.lang, []).append((row.doc_id is not None, row.doc_id or 0, hashlib.sha256(_fields(row).encode()).hexdigest()))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    roots = {t: plain([x[2] for x in sorted(trees[t])]) for t in names}
    root, above = plain([roots[t][0] for t in names])
    want = []
    for t, up in zip(names, above):
        for (_, _, digest), path in zip(sorted(trees[t]), roots[t][1]):
            want.append((digest, roots[t][0], root, h(*[d for _, d in path + up])))
    assert sorted((g.leaf, g.subroot, g.root, g.proof_sha256) for g in got) == sorted(want)
    assert built.root() == root
    assert [g.doc_id for g in got if not g.verified] == [3]
    assert all((g.folded_root == root) == g.verified for g in got)


def test_empty_table(docs):
    table = docs([]).select("doc_id", "lang", F.lit("00").alias("leaf"), F.lit(b"0").alias("claim"))
    built = manifest.build(table, "leaf", "lang", ["doc_id"])
    assert built.root() is None and built.proofs("claim", keep=["doc_id"]).collect() == []


def test_query_against_sql(docs, corpus, tmp_path):
    rows = [(i, f"text {i}\n", [None, "en", "de", "en"][i % 4], None if i % 6 == 0 else "s") for i in range(90)] + [(5, "text 5\n", "en"), (200, None, "xx")]
    table = docs(rows).withColumn("n_chars", F.when(F.col("doc_id") != 21, F.col("n_chars")))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_manifest(corpus, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(manifest.sql()).fetchall()
    rows = sorted(tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())
    assert rows == sorted(want)
    assert {v for *_, v in rows} == {True, False}
