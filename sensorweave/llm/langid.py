"""Language identification by compression.

Each language gets a zstandard raw-content dictionary cut from its training texts. A text is
compressed once per language; the dictionary that leaves the fewest bytes names the language, and
the relative lead over the runner-up says how sure that is. Case is folded. Long texts are compressed in pieces of
`PIECE` bytes, every piece counted, so that the dictionary matters along the whole text. A text of
fewer than `SHORT` bytes is measured by what it adds to `PROBES` short probes of the language (kept
out of the dictionary), which tells fractions of a byte.

Defined results: a NULL text or one without a letter is `und` with score 0; a narrow margin is
rejected by `accept` (and is named anyway by `predict`, with its low score); NULL languages and
NULL texts are not learned from; ties go to the alphabetically first language; without any
training text everything is `und`; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorweave.llm.common import utf8, widened

PIECE = 4096
LEVEL, SHORTEST_MATCH = 8, 3  # matches of three bytes count: short function words tell languages apart
SAMPLE_PER_LANGUAGE = 400  # documented bound: training texts of a language that its dictionary is cut from
DICTIONARY_BYTES = 64 << 10
SHORT, PROBES, PROBE_BYTES = 256, 16, 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    dictionary_bytes: int = DICTIONARY_BYTES,
    seed: int = 11,
) -> dict[str, bytes]:
    """Dictionary content per language, from at most `sample_per_language` texts of each.

    Of a sampled text, slices at places drawn by a keyed hash over its whole length fill its share of the
    dictionary, so that one very long text cannot fill it alone and no part of a text is left out by rule.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("draw")
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    last = rows.select("lang", "draw").withColumn("rank", rank).where(F.col("rank") <= sample_per_language)
    bound = {r[0]: r[1] for r in last.groupBy("lang").agg(F.max("draw")).collect()}  # one row per language
    if not bound:
        return {}
    limits = labelled.sparkSession.createDataFrame(sorted(bound.items()), "lang string, most long")
    share, slices = max(64, dictionary_bytes // sample_per_language), 2
    size = F.lit(share // slices)
    room = F.greatest(F.char_length("text") - size, F.lit(0)) + 1  # places at which a slice may begin
    spots = [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), F.col("text")), room.cast("long")).cast("int") for i in range(slices)]
    taken = [F.substring(F.col("text"), spot + 1, size) for spot in spots]
    drawn = rows.join(F.broadcast(limits), "lang").where("draw <= most")
    parts = drawn.select("lang", "draw", F.concat_ws("\n", *taken).alias("part")).collect()  # bounded by the sample
    content: dict[str, list[bytes]] = {}
    for row in sorted(parts, key=lambda r: (r.lang, r.draw, r.part)):
        content.setdefault(row.lang, []).append(utf8(row.part.lower()))
    return {name: b"\n".join(got)[-dictionary_bytes:] for name, got in content.items()}


class Judge:
    """The compressors of one worker."""

    def __init__(self, content: dict[str, bytes]):
        self.names = sorted(content)
        self.coders, self.probes, self.alone = [], [], []
        for name in self.names:
            # at most a quarter of the content goes to the probes, the rest is the dictionary
            size = min(PROBE_BYTES, max(1, len(content[name]) // (4 * PROBES)))
            probes = [content[name][i * size : (i + 1) * size] + b"\n" for i in range(PROBES)]
            body = content[name][PROBES * size :]
            table = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL,
                source_size=PIECE,
                dict_size=len(body),
                min_match=SHORTEST_MATCH,
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            )
            table.precompute_compress(compression_params=how)
            coder = zstandard.ZstdCompressor(compression_params=how, dict_data=table)
            self.coders.append(coder)
            self.probes.append(probes)
            self.alone.append(sum(len(coder.compress(p)) for p in probes))

    def sizes(self, raw: bytes) -> list[float]:
        """Compressed size of the bytes with each language's dictionary."""
        if len(raw) < SHORT:
            added = (sum(len(coder.compress(p + raw)) for p in probes) for coder, probes in zip(self.coders, self.probes))
            return [max(1, whole - alone) / PROBES for whole, alone in zip(added, self.alone)]
        pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        return [sum(len(coder.compress(p)) for p in pieces) for coder in self.coders]

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and lead: 1 - best size / next best size."""
        if not self.names or not has_letter(text):
            return UNKNOWN, 0.0
        sizes = self.sizes(utf8(text.lower()))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        return self.names[best], 1.0 - sizes[best] / min(others) if others else 1.0


def predict(docs: DataFrame, content: dict[str, bytes], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns plus `lang_pred` and `score` (0 to 1, the lead over the runner-up)."""
    kept = [F.col(c) for c in keep]
    schema = widened(docs.select(*kept), "lang_pred string, score double")
    names = schema.names

    def run(batches):
        judge = Judge(content)
        for batch in batches:
            got = [judge(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            langs, scores = pa.array([g[0] for g in got], pa.string()), pa.array(np.array([g[1] for g in got], float))
            yield pa.RecordBatch.from_arrays([*columns, langs, scores], names=names)

    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(run, schema)


def accept(docs: DataFrame, content: dict[str, bytes], text: str = "text", margin: float = 0.01) -> DataFrame:
    """The rows of `docs`, all columns, whose language is named with a lead of at least `margin`."""
    place = docs.columns.index(text)

    def run(batches):
        judge = Judge(content)
        for batch in batches:
            got = [judge(t) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([g[0] != UNKNOWN and g[1] >= margin for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
