"""Language-model scores by prediction by partial matching over bytes.

A trie of byte contexts of up to `ORDER` bytes is counted over all training texts (each padded in
front and closed by an end symbol). A symbol is coded in the longest context known; where it was
not seen there, an escape is coded (method C: as many escape counts as distinct symbols) and the
next shorter context is asked, with the symbols of the longer one excluded. The score of a text is
the base-10 logarithm of its probability, the end symbol included.

Counts of a shorter context are sums over longer ones, so only the longest n-grams are counted.
What a worker holds is bounded: per order the contexts above a count threshold, chosen from a
histogram so that at most `ENTRIES` (context, symbol) pairs remain; thresholds never rise towards
shorter contexts, so a kept context's shorter ones are kept too. Because seen sets are nested,
exclusion needs one number per context, and scoring is a handful of array lookups per byte.
Symbols whose contexts are not all held, though they may have been seen, are looked up in the full
tables by shuffle joins; so every score is that of the whole trie, whatever the bound.

Next to it stands a unigram base score over words with add-one smoothing. Counts of frequent words
(bounded in number, chosen by the same histogram rule) travel to the scorers, all other words are
joined by a shuffle; every word is counted and looked up exactly.

Defined results: NULL texts are empty; an empty text is its end symbol; a NULL key is in no fold
and so neither held out nor learnt from; repeated rows score alike and count each in training;
without training texts all counts are zero and the model is uniform; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.skew import SALT, spread_hot_keys
from sensorweave.llm.common import cut, utf8, widened

ORDER = 5  # 6 symbols of 9 bits; 6 is one too many for 63 bits
ENTRIES = 1_500_000  # bound of (context, symbol) pairs held by a worker per order
FREQUENT = 200_000  # bound of words whose counts travel to the scorers
STEPS = 16  # of a histogram of counts, to a doubling
END, START, RADIX, DIGIT = 256, 257, 512, 9
SYMBOLS = 257  # bytes and the end; the start only pads
CHUNK = 2_000_000  # symbols in hand at once
TEXT_END = b" "  # cannot be a word


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes. On bytes, folding touches A-Z alone and splitting the six blanks alone."""
    return utf8(text).lower().split()


def grams(texts: list[str | None], order: int):
    """Codes of all (context, symbol) of the texts with the number of each one's text, in windows of
    at most `CHUNK` symbols, whatever the lengths of the texts."""
    pad, end = np.full(order, START, np.uint16), np.array([END], np.uint16)
    parts, starts, at = [], [], 0
    for t in texts:
        raw = np.frombuffer(utf8(t), np.uint8)
        parts += [pad, raw, end]
        starts.append(at)
        at += order + len(raw) + 1
    line = np.concatenate(parts, dtype=np.uint16) if parts else np.empty(0, np.uint16)
    for begin in range(order, len(line), CHUNK):
        part = line[begin - order : begin + CHUNK].astype(np.int64)
        size = len(part) - order
        code = np.zeros(size, np.int64)
        for i in range(order + 1):
            code = (code << DIGIT) | part[i : i + size]
        real = np.flatnonzero(part[order:] != START)
        owner = np.searchsorted(starts, begin + real, side="right") - 1
        yield code[real], owner


def _tally(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    frame = pd.DataFrame({"c": np.concatenate(codes), "n": np.concatenate(counts)}).groupby("c", sort=False).n.sum()
    return frame.index.to_numpy(), frame.to_numpy()


def count(docs: DataFrame, text: str, order: int) -> DataFrame:
    """(word, code, n): words (code NULL), text ends, and n-grams (word NULL) of all texts."""

    def run(batches):
        seen: Counter = Counter()
        codes, counts, held = [], [], 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for t in texts:
                seen.update(words(t))
            seen[TEXT_END] += len(texts)
            for code, _ in grams(texts, order):
                part = pd.Series(code).value_counts(sort=False)
                codes.append(part.index.to_numpy())
                counts.append(part.to_numpy())
                held += len(part)
            if held > CHUNK:
                merged = _tally(codes, counts)
                codes, counts, held = [merged[0]], [merged[1]], 0
            if len(seen) > 500_000:
                yield table(list(seen), list(seen.values()), [], [])
                seen = Counter()
        merged = _tally(codes, counts) if codes else ([], [])
        yield table(list(seen), list(seen.values()), *merged)

    def table(found, n, codes, counts):
        size = len(codes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(found + [None] * size, pa.binary()),
                pa.concat_arrays([pa.nulls(len(found), pa.int64()), pa.array(codes, pa.int64())]),
                pa.array(np.concatenate([np.array(n, np.int64), np.array(counts, np.int64)])),
            ],
            names=["word", "code", "n"],
        )

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, code long, n long")
    return cut(rows.groupBy("word", "code").agg(F.sum("n").alias("n")), "counts")


def _threshold(sizes: DataFrame, most: int) -> int:
    """A count t, the lowest found, such that at most `most` of the entries (n, entries) have n >= t."""
    step = F.floor(F.log2("n") * STEPS)  # logarithmic, so that no count is too large to be told apart
    steps = sizes.groupBy(step.alias("step")).agg(F.min("n").alias("n"), F.sum("entries").alias("entries"))
    got = steps.toArrow().to_pandas().sort_values("n", ascending=False)  # at most 63 * STEPS rows
    fits = got[got.entries.cumsum() <= most]
    if len(fits) == len(got):
        return 1
    return int(fits.n.min()) if len(fits) else 1 << 62


def _smallest(n: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the narrowest type that holds them."""
    return n.astype(np.min_scalar_type(int(n.max()) if len(n) else 0))


def _find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of `wanted` in the sorted `table` without repeats; -1 where it is not there."""
    if not len(table):
        return np.full(len(wanted), -1, np.int64)
    place = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    place[table[place] != wanted] = -1
    return place


class Model:
    """The bounded trie of one worker: per order, sorted codes and the numbers of each context.

    Sorted arrays are searched by halving, so that a worker holds nothing beside them: no hash table,
    and each number in the narrowest type.
    """

    def __init__(self, edges: list[tuple[np.ndarray, np.ndarray]], least: list[int]):
        """`edges[j]`: codes (context of j symbols, symbol) and counts of the contexts seen `least[j]` times."""
        self.order = len(edges) - 1
        self.least = least
        self.levels = []
        lower = None
        for j, (code, n) in enumerate(edges):
            rank = np.argsort(code)
            code, n = code[rank], _smallest(n[rank])
            context, start = np.unique(code // RADIX, return_index=True)
            owner = _smallest(np.repeat(np.arange(len(context)), np.diff(np.append(start, len(code)))))
            total = np.bincount(owner, n, len(context))
            distinct = _smallest(np.bincount(owner, minlength=len(context)))
            excluded = np.zeros(len(context))
            if lower is not None and len(code):
                place = np.searchsorted(lower[0], code % RADIX**j)  # the same symbol in the next shorter context
                excluded = np.bincount(owner, lower[1][place], len(context))
            self.levels.append((code, n, owner, context, total, distinct, excluded))
            lower = (code, n)

    def held(self, code: np.ndarray) -> np.ndarray:
        """Where the longest context that was seen, and so the probability, is sure to be known here."""
        sure = np.ones(len(code), bool)
        open_ = np.arange(len(code))  # contexts of all orders so far not held
        for j in range(self.order, -1, -1):
            met = _find(self.levels[j][3], (code[open_] >> DIGIT) & ((1 << DIGIT * j) - 1)) >= 0
            if self.least[j] <= 1:  # held whole: a context not met here was never seen, nor were longer ones
                sure[open_[~met]] = True
                break
            if j == self.order:
                sure[open_[~met]] = False
            open_ = open_[~met]
        return sure

    def logs(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each coded symbol."""
        out = np.zeros(len(code))
        open_ = np.arange(len(code))
        beyond = np.zeros(len(code))  # counts and number of the symbols excluded so far
        known = np.zeros(len(code))
        for j in range(self.order, -1, -1):
            edges, n, owner, contexts, total, distinct, excluded = self.levels[j]
            if not len(n):
                continue
            here = code[open_] & ((1 << DIGIT * (j + 1)) - 1)
            edge = _find(edges, here)
            hit = edge >= 0
            if hit.any():
                at, place = edge[hit], owner[edge[hit]]
                weight = total[place] - beyond[hit] + distinct[place] - known[hit]
                out[open_[hit]] += np.log10(n[at] / weight)
            miss = ~hit
            open_, here, beyond, known = open_[miss], here[miss], beyond[miss], known[miss]
            if not len(open_):
                return out
            node = _find(contexts, here >> DIGIT)
            met = node >= 0
            place = node[met]
            fresh = distinct[place] - known[met]
            weight = total[place] - beyond[met] + fresh
            step = np.zeros(len(place))
            some = fresh > 0  # else nothing new is here and the escape is certain
            step[some] = np.log10(fresh[some] / weight[some])
            out[open_[met]] += step
            beyond[met], known[met] = excluded[place], distinct[place]
            beyond[~met], known[~met] = 0.0, 0.0
            # counts excluded at the next shorter context are those of the symbols seen here
        left = SYMBOLS - known
        out[open_] -= np.log10(np.maximum(left, 1.0))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Sums by this trie alone."""
        total = np.zeros(len(texts))
        for code, owner in grams(texts, self.order):
            place, different = pd.factorize(code, sort=True)
            total += np.bincount(owner, self.logs(different)[place], len(texts))
        return total

    def read(self, texts: list[str | None]):
        """A window at a time: (texts, their sums over what is `held`), (texts, codes, times) of the rest."""
        for code, owner in grams(texts, self.order):
            if not len(code):  # a window of padding alone
                continue
            place, different = pd.factorize(code)  # each symbol in context is looked up once
            rank = np.argsort(different)  # neighbours lie together in the tables
            held = self.held(different[rank])
            sure, logs = np.zeros(len(rank), bool), np.zeros(len(rank))
            sure[rank] = held
            logs[rank[held]] = self.logs(different[rank[held]])
            first, last = owner[0], owner[-1]  # owners ascend
            sums = np.bincount(owner - first, logs[place], last - first + 1)
            out = np.flatnonzero(~sure[place])
            pairs = pd.Series(owner[out] * len(different) + place[out]).value_counts(sort=False)
            at, spot = np.divmod(pairs.index.to_numpy(np.int64), max(1, len(different)))
            yield (np.arange(first, last + 1), sums), (at, different[spot], pairs.to_numpy(np.int64))


def tables(counts: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """The whole trie from the counts of `count`: (code, n) of every order."""
    levels = [cut(counts.where("code IS NOT NULL").select("code", "n"), "grams")]
    for j in range(order - 1, -1, -1):  # marginal sums: drop the oldest symbol
        shorter = levels[0].select((F.col("code") % F.lit(RADIX ** (j + 1))).alias("code"), "n")
        levels.insert(0, cut(shorter.groupBy("code").agg(F.sum("n").alias("n")), "grams"))
    return levels


def _context() -> Column:
    return F.shiftright("code", DIGIT)


def _frequent(levels: list[DataFrame], entries: int) -> Model:
    kept, lowest, least = [], [], 1
    for level in levels:
        by_context = level.groupBy(_context().alias("context")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("entries"))
        least = max(least, _threshold(by_context, entries))
        if least > 1:
            chosen = by_context.where(F.col("n") >= least).select("context")
            level = level.withColumn("context", _context()).join(chosen, "context", "left_semi")
        got = level.select("code", "n").toArrow()  # at most `entries` rows
        kept.append((got.column(0).to_numpy(), got.column(1).to_numpy()))
        lowest.append(least)
    return Model(kept, lowest)


def fit(counts: DataFrame, order: int = ORDER, entries: int = ENTRIES) -> Model:
    """The worker's part of the trie from the counts of `count`."""
    return _frequent(tables(counts, order), entries)


def looked_up(asked: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(code, log) of different codes of the longest order, from the whole trie.

    From the shortest order up: `log` is the probability with nothing excluded, `tail` that of a symbol
    not seen in its context. Both of one order follow from those of the order below, which at most 258
    codes share, as at most 257 share a context; so no key is hot.
    """
    wanted = [asked.select("code")]
    for j in range(len(levels) - 2, -1, -1):
        wanted.insert(0, cut(wanted[0].select((F.col("code") % F.lit(RADIX ** (j + 1))).alias("code")).distinct(), "asked"))
    state = None
    for j, (codes, level) in enumerate(zip(wanted, levels)):
        edges = level.withColumn("context", _context())
        codes = codes.withColumn("context", _context())
        edges = edges.join(codes.select("context").distinct(), "context", "left_semi")
        if j:
            lower = levels[j - 1].select(F.col("code").alias("below"), F.col("n").alias("below_n"))
            edges = edges.withColumn("below", F.col("code") % F.lit(RADIX**j)).join(lower, "below")
        else:
            edges = edges.withColumn("below_n", F.lit(0))
        contexts = edges.groupBy("context").agg(
            F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).cast("double").alias("different"), F.sum("below_n").cast("double").alias("excluded")
        )
        codes = codes.join(contexts, "context", "left").join(level.select("code", F.col("n").cast("double").alias("n")), "code", "left")
        if j:
            codes = codes.withColumn("below", F.col("code") % F.lit(RADIX**j)).join(state, "below")
            fresh = F.col("b_different") - F.col("different")
            weight = F.col("b_total") - F.col("excluded") + fresh
            # the weight is 0 only where the symbol was seen in the longer context, and no tail is needed
            escaped = F.when(fresh > 0, F.log10(F.try_divide(fresh, weight))).otherwise(0.0) + F.col("b_tail")
            tail = F.when(F.col("b_n").isNotNull(), F.log10(F.try_divide(F.col("b_n"), weight))).otherwise(escaped)
            unmet = F.col("b_log")
        else:
            tail = -F.log10(F.greatest(SYMBOLS - F.col("different"), F.lit(1.0)))
            unmet = F.lit(-float(np.log10(SYMBOLS)))
        codes = codes.withColumn("tail", tail)
        weight = F.col("total") + F.col("different")
        met = F.when(F.col("n").isNotNull(), F.log10(F.col("n") / weight)).otherwise(F.log10(F.col("different") / weight) + F.col("tail"))
        codes = codes.withColumn("log", F.when(F.col("total").isNull(), unmet).otherwise(met))
        state = codes.select(F.col("code").alias("below"), *[F.col(c).alias(f"b_{c}") for c in ("total", "different", "n", "tail", "log")])
        state = cut(state, "looked-up")
    return state.select(F.col("below").alias("code"), F.col("b_log").alias("log"))


def score(
    docs: DataFrame,
    train: str = "true",
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
    order: int = ORDER,
    entries: int = ENTRIES,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row: key, `keep`, n_tokens, n_known, train_tokens, base_score, score.

    `train` is the SQL condition of the rows that are learnt from.
    """
    counts = count(docs.where(train), text, order)
    levels = tables(counts, order)
    model = _frequent(levels, entries)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most `entries` an order

    vocabulary = counts.where("word IS NOT NULL").select("word", "n")
    sizes = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = int(sizes[0]), int(sizes[1])
    least = _threshold(vocabulary.select("n", F.lit(1).alias("entries")), frequent)
    top = vocabulary.where(F.col("n") >= least).toArrow()  # at most `frequent` rows
    known = dict(zip(top.column(0).to_pylist(), np.log10(top.column(1).to_numpy() + 1.0).tolist()))
    last = vocabulary.where(F.col("word") == F.lit(bytearray(TEXT_END))).first()
    ends = float(np.log10((last.n if last else 0) + 1))
    has_end = int(last is not None)
    known.pop(TEXT_END, None)

    # two hashes of key and text name a row; repeated rows share a name and are divided again
    rows = docs.select(
        F.col(key).alias("key"), *[F.col(k) for k in keep], F.xxhash64(key, text).alias("h1"), F.hash(text, key).alias("h2"), F.col(text).alias("text")
    )

    def rare(batches):
        for batch in batches:
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            place, found, n = [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                for w, c in Counter(words(t)).items():
                    if w not in known:
                        place.append(i)
                        found.append(w)
                        n.append(c)
                place.append(i)  # marks the row; a blank is in no word
                found.append(b" %d" % (h1[i] % 100_003))
                n.append(0)
            at = np.array(place, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[at]), pa.array(h2[at]), pa.array(found, pa.binary()), pa.array(n, pa.int64())], names=["h1", "h2", "word", "tf"]
            )

    looked = rows.select("h1", "h2", "text").mapInArrow(rare, "h1 long, h2 int, word binary, tf long").join(vocabulary, "word", "left")
    looked = looked.withColumn("log", F.lit(0.0))

    def read(batches):  # the texts are read once: sums of what is held (code NULL), and what must be looked up
        for batch in batches:
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for (mine, sums), (at, code, n) in sent.value.read(batch.column(2).to_pylist()):
                both = np.concatenate([mine, at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1[both]),
                        pa.array(h2[both]),
                        pa.concat_arrays([pa.nulls(len(mine), pa.int64()), pa.array(code, pa.int64())]),
                        pa.concat_arrays([pa.nulls(len(mine), pa.int64()), pa.array(n, pa.int64())]),
                        pa.concat_arrays([pa.array(sums), pa.nulls(len(at), pa.float64())]),
                    ],
                    names=["h1", "h2", "code", "tf", "log"],
                )

    done = cut(rows.select("h1", "h2", "text").mapInArrow(read, "h1 long, h2 int, code long, tf long, log double"), "read")
    found = done.where("code IS NULL").select("h1", "h2", "log")
    if model.least[-1] > 1:
        missed = done.where("code IS NOT NULL").select("h1", "h2", "code", "tf")
        asked = cut(missed.groupBy("code").agg(F.count(F.lit(1)).alias("n")), "asked")
        values = looked_up(asked, levels).join(asked, "code")
        missed, values = spread_hot_keys(missed, values, ["code"], by="h1")
        missed = missed.join(values.drop("n"), ["code", SALT])
        found = found.unionByName(missed.select("h1", "h2", (F.col("tf") * F.col("log")).alias("log")))
    looked = looked.unionByName(found, allowMissingColumns=True)
    looked = looked.groupBy("h1", "h2").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf") * F.log10(F.col("n") + 1.0)).otherwise(0.0)).alias("rare_sum"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known"),
        F.count_if(F.col("tf") == 0).alias("copies"),
        F.sum("log").alias("log_sum"),
    )

    schema = widened(rows.drop("text"), "n_tokens long, top_known long, top_sum double")

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            n, seen, sums = [], [], []
            for t in texts:
                got = words(t)
                values = [v for v in map(known.get, got) if v is not None]
                n.append(len(got) + 1)
                seen.append(len(values) + has_end)
                sums.append(sum(values) + ends)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(seen, pa.int64()), pa.array(sums, pa.float64())], names=schema.names
            )

    done = rows.mapInArrow(run, schema).join(looked, ["h1", "h2"], "left")
    base = F.col("top_sum") + F.col("rare_sum") / F.col("copies") - F.col("n_tokens") * float(np.log10(total + distinct + 1))
    return done.select(
        F.col("key").alias(key),
        *keep,
        "n_tokens",
        (F.col("top_known") + (F.col("rare_known") / F.col("copies")).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("log_sum") / F.col("copies")).alias("score"),
    )
