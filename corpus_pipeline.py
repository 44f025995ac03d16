"""A corpus cleaning pipeline: each stage works on what its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm import langid, linededup, neardup, packing, quality
from sensorweave.llm.common import cut, prepare, public_tokenizer
from sensorweave.session import shared_folder

MARGIN = 0.001  # a smaller lead of one language over the next is rejected


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones, does not reject."""
    prepare(spark)
    return quality.accept(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear lead."""
    prepare(spark)
    return langid.accept(docs, langid.fit(docs), margin=MARGIN)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    prepare(spark)
    done = linededup.drop_boilerplate(docs)
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8).

    Rows are told apart by a number of their own, not by `doc_id`: of identical rows one stays, whatever
    their ids, and a document that shares its id with a near duplicate is judged by its own text. The
    row with the smallest `doc_id` of a group stays (NULL last). Documents without words stay.
    """
    prepare(spark)
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = neardup.near_duplicates(rows, key="_row").select("_row", "component_id")
    found = found.join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("first")
    stay = found.groupBy("component_id").agg(first).select(F.col("first._row").alias("_row"))
    return rows.join(stay, "_row", "left_semi").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed along the curve into sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, public_tokenizer("word_bpe_49k.json")).drop("ids")


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("lines", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{shared_folder(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
