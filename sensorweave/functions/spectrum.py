"""Discrete Fourier transforms of windows of any length, one row per sample.

A window of n = p q samples is decimated: the p subsequences of every p-th sample are transformed
by themselves, q values each, and the p results for one bin residue are combined with twiddle
factors into the p bins of that residue. Both steps are grouped sums, so a window of n samples is
dealt out over about 2 sqrt(n) groups of about sqrt(n) values, and no task holds a window. p is the
largest divisor up to sqrt(n); a window of at most `dftLength` samples is one subsequence.

A long window without a good divisor (a prime number of samples) goes through a chirp: its
transform is a convolution with exp(i pi j^2 / n), which is done by three transforms of a power of
two of at least 2 n - 1 values, decimated in the same way.

The sums inside a group are array expressions ('native': n log n, passes of pairwise joins, after a
chirp where the length is no power of two) or a fast transform of the group's values in Arrow batches
('arrow'); what is grouped and how is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from sensorweave.settings import setting

COMPLEX = ["re", "im"]
SHORT = 16  # values up to which a group is summed by definition


def divisor(n: str, longest: int) -> str:
    """SQL for the number of subsequences of a window of `n` samples; NULL where none is good."""
    best = f"array_max(filter(sequence(1, CAST(floor(sqrt({n})) AS INT)), d -> {n} % d = 0))"
    return f"IF({n} <= {longest}, 1, IF({n} / {best} <= greatest({longest}, 4 * sqrt({n})), {best}, NULL))"


@F.pandas_udf(StructType([StructField(part, ArrayType(DoubleType())) for part in COMPLEX]))
def _fast(j: pd.Series, re: pd.Series, im: pd.Series, length: pd.Series, shift: pd.Series, whole: pd.Series) -> pd.DataFrame:
    """Sums of (re, im) at places j, turned by j * shift / whole, over the `length` bins of a short transform."""
    out = []
    for at, a, b, size, turn, n in zip(j, re, im, length, shift, whole):
        at = np.asarray(at, np.int64)
        values = np.zeros(size, complex)
        values[at] = (np.asarray(a) + 1j * np.asarray(b)) * np.exp(-2j * np.pi * ((at * turn) % n) / n)
        found = np.fft.fft(values)
        out.append((found.real, found.imag))
    return pd.DataFrame(out, columns=COMPLEX)


def _let(name: str, value: str, body: str) -> str:
    """SQL for `body`, in which `name` stands for `value`, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


ZERO = "named_struct('re', 0D, 'im', 0D)"


def _times(re: str, im: str, angle: str) -> str:
    """(re + i im) * exp(i angle) as a struct."""
    return f"named_struct('re', {re} * cos({angle}) - {im} * sin({angle}), 'im', {re} * sin({angle}) + {im} * cos({angle}))"


def _halving(values: str, size: str) -> str:
    """Transform of an array of `size` (re, im), a power of two, in log2(size) passes over it.

    A pass joins pairs of transforms of `_s` doublings: place o takes values j and j + size / 2 of the pass before."""
    half = f"CAST({size} div 2 AS INT)"
    angle = "-pi() * (j & (shiftleft(1, _s) - 1)) / shiftleft(1, _s)"
    turned = f"transform(slice(_x, {half} + 1, {half}), (b, j) -> named_struct('re', b.re, 'im', b.im, 'c', cos({angle}), 's', sin({angle})))"
    pairs = f"zip_with(slice(_x, 1, {half}), {turned}, (a, b) -> named_struct('ar', a.re, 'ai', a.im, 'br', b.re * b.c - b.im * b.s, 'bi', b.re * b.s + b.im * b.c))"
    place = "_pairs[shiftleft(shiftright(o, _s + 1), _s) | (o & (shiftleft(1, _s) - 1))]"
    dealt = f"transform(sequence(0, CAST({size} - 1 AS INT)), o -> {place})"
    sign = "(1 - 2 * (shiftright(o, _s) & 1))"
    joined = f"transform({dealt}, (e, o) -> named_struct('re', e.ar + {sign} * e.br, 'im', e.ai + {sign} * e.bi))"
    steps = f"sequence(0, CAST(round(log2({size})) AS INT) - 1)"
    return f"IF({size} = 1, {values}, aggregate({steps}, {values}, (_x, _s) -> {_let('_pairs', pairs, joined)}))"


def _convolved(values: str, size: str) -> str:
    """Transform of an array of any `size` by a chirp: three transforms of a power of two."""
    angle = f"pi() * ((CAST(j AS BIGINT) * j) % (2 * {size})) / {size}"
    padded = f"concat(transform({values}, (e, j) -> {_times('e.re', 'e.im', f'-({angle})')}), array_repeat({ZERO}, CAST(_long - {size} AS INT)))"
    chirp = f"transform(transform(sequence(0L, _long - 1), o -> least(o, _long - o)), j -> IF(j < {size}, named_struct('re', cos({angle}), 'im', sin({angle})), {ZERO}))"
    product = "(a, b) -> named_struct('re', a.re * b.re - a.im * b.im, 'im', -(a.re * b.im + a.im * b.re))"  # conjugate
    back = _halving(f"zip_with({_halving(padded, '_long')}, {_halving(chirp, '_long')}, {product})", "_long")
    turned = f"transform(slice({back}, 1, CAST({size} AS INT)), (e, j) -> {_times('(e.re / _long)', '(-e.im / _long)', f'-({angle})')})"
    return _let("_long", f"shiftleft(1L, CAST(ceil(log2(2 * {size} - 1)) AS INT))", turned)


def _native(values: str, size: str) -> str:
    """Transform of an array of `size` (re, im): by its definition if short, else in passes."""
    angle = f"-2 * pi() * ((CAST(j AS BIGINT) * k) % {size}) / {size}"
    turned = f"transform(_v0, (e, j) -> {_times('e.re', 'e.im', angle)})"
    add = "(s, e) -> named_struct('re', s.re + e.re, 'im', s.im + e.im)"
    plain = f"transform(sequence(0L, {size} - 1), k -> aggregate({turned}, {ZERO}, {add}))"
    power = f"{size} = shiftleft(1L, CAST(round(log2({size})) AS INT))"
    return _let("_v0", values, f"CASE WHEN {power} THEN {_halving('_v0', size)} WHEN {size} <= {SHORT} THEN {plain} ELSE {_convolved('_v0', size)} END")


def _grouped(rows: DataFrame, group: Sequence[str], index: str, length: str, shift: str, step: str, whole: str, top: str, how: str) -> DataFrame:
    """Per group the sums over its values v_j of v_j exp(-2 pi i j k / whole), a row (k, re, im) per bin
    k = shift, shift + step, ... of `length` bins, up to `top`.

    Groups are few bytes and much arithmetic: they are dealt out by number, which AQE does not undo."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vectors = rows.repartition(parts, *group).groupBy(*group).agg(F.expr(f"sort_array(collect_list(struct({index} AS j, re, im))) AS _v"))
    vectors = vectors.selectExpr(*[f"`{g}`" for g in group], "_v", f"{length} AS _length", f"{shift} AS _shift", f"{whole} AS _whole", f"{step} AS _step", f"{top} AS _top")
    if how == "arrow":
        vectors = vectors.withColumn("_sum", _fast("_v.j", "_v.re", "_v.im", "_length", "_shift", "_whole"))
        bins = "transform(sequence(0L, _length - 1), i -> _shift + _step * i)"
        sums = f"transform({bins}, (k, i) -> named_struct('k', k, 're', _sum.re[i], 'im', _sum.im[i]))"
    else:
        holes = "transform(array_except(sequence(0L, _length - 1), _all.j), j -> named_struct('j', j, 're', 0D, 'im', 0D))"
        dense = _let("_all", "_v", f"IF(size(_all) = _length, _all, sort_array(concat(_all, {holes})))")
        values = f"transform({dense}, e -> {_times('e.re', 'e.im', '(-2 * pi() * ((e.j * _shift) % _whole) / _whole)')})"
        sums = f"transform({_native(values, '_length')}, (e, i) -> named_struct('k', _shift + _step * i, 're', e.re, 'im', e.im))"
    return vectors.select(*group, F.expr(f"explode(filter({sums}, s -> s.k <= _top)) AS _bin")).select(*group, "_bin.*")


def transform(rows: DataFrame, keys: Sequence[str], how: str = "native", top: str = "_n - 1") -> DataFrame:
    """Bins (`keys`, _n, k, re, im) of windows with a row (_n, _p, pos, re, im) per sample.

    `_n` is the length and `_p` divides it; missing samples are zero. `top` is the last bin wanted.
    """
    window = [*keys, "_n", "_p"]
    rows = rows.selectExpr(*[f"`{w}`" for w in window], "pos % _p AS _r", "pos div _p AS _j", "re", "im")
    parts = _grouped(rows, [*window, "_r"], "_j", "_n div _p", "0L", "1L", "_n div _p", "_n", how)
    parts = parts.withColumnRenamed("k", "_m")
    whole = _grouped(parts, [*window, "_m"], "_r", "_p", "_m", "_n div _p", "_n", top, how)
    return whole.select(*keys, "_n", "k", *COMPLEX)


def _turned(re: str, im: str, sign: str, j: str) -> list[str]:
    """(re + i im) * exp(`sign` i pi j^2 / _size)."""
    angle = f"pi() * (({j} * {j}) % (2 * _size)) / _size"
    return [f"{re} * cos({angle}) - {sign}1 * {im} * sin({angle}) AS re", f"{im} * cos({angle}) + {sign}1 * {re} * sin({angle}) AS im"]


def chirped(rows: DataFrame, keys: Sequence[str], how: str = "native") -> DataFrame:
    """As `transform`, up to the middle bin, for windows of any length n; real rows (_n, pos, re)."""
    names = [f"`{k}`" for k in keys]
    power = "CAST(ceil(log2(2 * _n - 1)) AS INT)"
    padded = [f"shiftleft(1L, {power}) AS _n", f"shiftleft(1L, {power} div 2) AS _p", "_n AS _size"]
    signal = rows.selectExpr(*names, *padded, "pos", "re", "0D AS im").selectExpr(*names, "_n", "_p", "_size", "pos", *_turned("re", "im", "-", "pos"))
    signal = transform(signal, [*keys, "_size"], how)
    chirp = rows.select("_n").distinct().selectExpr(*padded, "explode(sequence(0L, _n - 1)) AS j")
    chirp = chirp.selectExpr("_n", "_p", "_size", "explode(IF(j = 0, array(j), array(j, _n - j))) AS pos", *_turned("1D", "0D", "+", "j"))
    chirp = transform(chirp, ["_size"], how).selectExpr("_size", "k", "re AS c_re", "im AS c_im")
    product = signal.join(chirp, ["_size", "k"]).selectExpr(
        *names, "_size", "_n", "shiftleft(1L, CAST(log2(_n) AS INT) div 2) AS _p", "k AS pos",
        "re * c_re - im * c_im AS re", "-(re * c_im + im * c_re) AS im",  # conjugate: the way back is a transform, too
    )
    back = transform(product, [*keys, "_size"], how, top="_size div 2").selectExpr(*names, "_size", "k", "re / _n AS re", "-im / _n AS im")
    return back.selectExpr(*names, "_size AS _n", "k", *_turned("re", "im", "-", "k"))


def spectrum(samples: DataFrame, keys: Sequence[str], how: str = "native") -> DataFrame:
    """Per window (`keys`): amplitude and bin of the peak (without bin 0) and total energy of the bins
    0..n/2, from a row (_n samples in the window, pos from 0, value without its mean) per sample.

    The samples are read twice, or oftener where long windows need a chirp: a table, if they cost much."""
    longest = setting(samples, "dftLength")
    rows = samples.selectExpr(*[f"`{k}`" for k in keys], "_n", "CAST(pos AS BIGINT) AS pos", "value AS re", "0D AS im")
    rows = rows.withColumn("_p", F.expr(f"CAST({divisor('_n', longest)} AS BIGINT)"))
    bins = transform(rows.where("_p IS NOT NULL"), keys, how, top="_n div 2")
    if not rows.where("_p IS NULL").isEmpty():
        bins = bins.unionByName(chirped(rows.where("_p IS NULL"), keys, how))
    bins = bins.withColumn("_e", F.expr("re * re + im * im"))
    peak = F.expr("max(IF(k > 0 OR _n = 1, struct(_e AS e, -k AS bin), NULL)) AS _peak")
    found = bins.groupBy(*keys).agg(peak, F.sum("_e").alias("fft_energy_total"))
    return found.select(*keys, F.sqrt("_peak.e").alias("fft_peak_amp"), (-F.col("_peak.bin")).cast("double").alias("fft_peak_bin"), "fft_energy_total")
