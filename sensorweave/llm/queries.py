"""The driver queries of the corpus operators: thin calls that derive the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm import bytebpe, htmltext, langid, linededup, manifest, merkle, neardup, packing, phrases, pieces, ppm, quality, vectors
from sensorweave.llm.common import fold, public_tokenizer, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from the labelled ones outside the held-out fold."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = quality.fit(docs.where(fold("doc_id", 3) != 1), labels.where(fold("doc_id", 3) != 1))
    held = docs.withColumn("held_out", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)))
    return quality.score(held, model, keep=("doc_id", "held_out"))


@query
def op2_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near duplicates among all documents: four-word shingles, similarity 0.8."""
    return neardup.near_duplicates(read(spark, folder, "documents"), words=4, percent=80)


@query
def op3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    return pieces.round_trip(read(spark, folder, "documents"), public_tokenizer("piece_bpe_32k.model"))


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt outside the held-out fold."""
    docs = read(spark, folder, "documents")
    content = langid.fit(docs.where(fold("doc_id", 4) != 2))
    held = docs.withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    return langid.predict(held, content, keep=("doc_id", "held_out"))


@query
def op5_ppm(spark: SparkSession, folder: str) -> DataFrame:
    """Word unigram and byte PPM scores of every document, learnt outside the held-out fold."""
    docs = read(spark, folder, "documents").withColumn("held_out", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)))
    return ppm.score(docs, train="crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 <> 2", keep=("held_out",))


@query
def op6_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    done = linededup.drop_boilerplate(read(spark, folder, "documents"), counts=("n_lines", "n_dropped"))
    return done.select("doc_id", "text", "n_lines", "n_dropped")




@query
def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, folder, "pages")
    return htmltext.extract(pages, htmltext.fit(pages))


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed along the curve into sequences of 2048 tokens."""
    done = packing.pack(read(spark, folder, "documents"), public_tokenizer("word_bpe_49k.json"))
    return done.drop("ids")


@query
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and of its edited text."""
    return merkle.fingerprints(read(spark, folder, "documents"))


@query
def op10_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups of near-equal embeddings of equal label, cosine 0.98."""
    return vectors.near_vectors(read(spark, folder, "embeddings"))


@query
def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle manifest of all documents, and the proof of each against the root, some after tampering."""
    docs = read(spark, folder, "documents")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaf, altered = (manifest.row_digest([F.col(c) for c in ("doc_id", "source", "lang")] + [n, F.col("text")]) for n in (F.col("n_chars"), more))
    claim = F.when((fold("doc_id", 7) == 0) & F.col("n_chars").isNotNull(), altered).otherwise(leaf)
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.unhex(claim).alias("claim"))
    return manifest.build(rows, "leaf", "lang", ["doc_id"]).proofs("claim", keep=["doc_id"])


@query
def op12_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded as byte-level BPE and decoded again."""
    import public_tokenizers

    return bytebpe.round_trip(read(spark, folder, "documents"), public_tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of two to five words of each language."""
    return phrases.collocations(read(spark, folder, "documents"))


SQL |= {"op2_neardup": neardup.sql(), "op6_lines": linededup.sql(), "op10_vectors": vectors.sql(), "op11_manifest": manifest.sql(), "op13_phrases": phrases.sql()}
