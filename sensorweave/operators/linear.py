"""Linear and logistic regression from sums over the rows.

Both need the rows only through a few sums, which combine on the map side: a row of statistics
travels to the driver, however large the data. Features are scaled first; a feature that the ones before
it determine (within `DEPENDENT`) gets the weight 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPENDENT = 1e-9  # share of a feature's variance that is its own
STEPS = 50  # Newton steps at most
STILL = 1e-10  # a step below this ends the search


def _lacking(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))


def solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a symmetric system with a diagonal of about 1, by elimination in the given order;
    0 for unknowns whose pivot is at most `DEPENDENT`."""
    work = np.column_stack([matrix, right]).astype(float)
    used = np.zeros(len(work), bool)
    for i in range(len(work)):
        if work[i, i] > DEPENDENT:
            used[i] = True
            work[i] /= work[i, i]
            others = np.arange(len(work)) != i
            work[others] -= np.outer(work[others, i], work[i])
    return np.where(used, work[:, -1], 0.0)


@dataclass
class Scaled:
    """`intercept` plus weighted features, each less its mean and divided by its deviation."""

    columns: list[str]
    means: list[float]
    deviations: list[float]
    weights: list[float]
    intercept: float

    def margin(self) -> Column:
        """The weighted sum of a row; raises where a feature is missing."""
        terms = [F.lit(w) * (F.col(c) - F.lit(m)) / F.lit(d) for c, m, d, w in zip(self.columns, self.means, self.deviations, self.weights)]
        total = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return F.when(_lacking(self.columns), F.raise_error(F.lit("a feature is missing"))).otherwise(total)


class LinearModel(Scaled):
    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.margin())


class LogisticModel(Scaled):
    def transform(self, df: DataFrame) -> DataFrame:
        score = 1 / (1 + F.exp(-self.margin()))
        return df.withColumn("score", score).withColumn("prediction", (F.col("score") > 0.5).cast("double"))


@dataclass
class LeastSquares:
    """Ordinary least squares in closed form."""

    columns: Sequence[str]
    label: str

    def fit(self, train: DataFrame) -> LinearModel:
        """One aggregate: means and the covariances of all pairs, each mergeable and stable by itself."""
        names = [*self.columns, self.label]
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        row = train.agg(
            F.count_if(_lacking(names)).alias("lacking"),
            F.count(F.lit(1)).alias("n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
            *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
        ).first()
        if row["lacking"] or not row["n"]:
            raise ValueError(f"{row['lacking']} of {row['n']} training rows lack a feature or the label")
        covariance = np.zeros((len(names), len(names)))
        for i, j in pairs:
            covariance[i, j] = covariance[j, i] = row[f"c{i}_{j}"]
        k = len(self.columns)
        deviation = np.sqrt(np.maximum(np.diag(covariance)[:k], 0.0))
        deviation[deviation == 0] = 1.0
        weights = solve(covariance[:k, :k] / np.outer(deviation, deviation), covariance[:k, k] / deviation)
        means = [row[f"m{i}"] for i in range(k)]
        return LinearModel(list(self.columns), means, deviation.tolist(), weights.tolist(), row[f"m{k}"])


@dataclass
class Logistic:
    """Logistic regression with an L2 penalty of 1 / (2 `c`) on the weights of scaled features."""

    columns: Sequence[str]
    label: str = "label"
    c: float = 1.0

    def fit(self, train: DataFrame) -> LogisticModel:
        """Newton's method; each step is one aggregate of loss, gradient and Hessian."""
        names, k = list(self.columns), len(self.columns)
        row = train.agg(
            F.count_if(_lacking([*names, self.label])).alias("lacking"),
            F.count(F.lit(1)).alias("n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
            *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(names)],
        ).first()
        if row["lacking"] or not row["n"]:
            raise ValueError(f"{row['lacking']} of {row['n']} training rows lack a feature or the label")
        means = [row[f"m{i}"] for i in range(k)]
        deviations = [row[f"d{i}"] or 1.0 for i in range(k)]

        def model(w: np.ndarray) -> LogisticModel:
            return LogisticModel(names, means, deviations, w[1:].tolist(), float(w[0]))

        penalty = np.r_[0.0, np.full(k, 1.0 / self.c)]
        weights, step, best = np.zeros(k + 1), np.zeros(k + 1), math.inf
        for _ in range(STEPS):
            loss, slope, curve = self._sums(train, model(weights + step), k)
            loss += float(penalty @ (weights + step) ** 2) / 2
            if loss > best + 1e-9 * abs(best):
                step = step / 2  # too far: half the way
                continue
            weights, best = weights + step, loss
            step = -np.linalg.solve(curve + np.diag(penalty), slope + penalty * weights)
            if np.abs(step).max() < STILL:
                break
        return model(weights)

    def _sums(self, train: DataFrame, at: LogisticModel, k: int) -> tuple[float, np.ndarray, np.ndarray]:
        x = [F.lit(1.0)] + [(F.col(c) - F.lit(m)) / F.lit(d) for c, m, d in zip(at.columns, at.means, at.deviations)]
        rows = train.select(F.col(self.label).cast("double").alias("_y"), at.margin().alias("_z"), *[f.alias(f"_x{i}") for i, f in enumerate(x)])
        rows = rows.withColumn("_p", 1 / (1 + F.exp(-F.col("_z"))))
        off, bend = F.col("_p") - F.col("_y"), F.col("_p") * (1 - F.col("_p"))
        loss = F.greatest("_z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z"))) - F.col("_y") * F.col("_z")
        pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
        row = rows.agg(
            F.sum(loss).alias("loss"),
            *[F.sum(off * F.col(f"_x{i}")).alias(f"g{i}") for i in range(k + 1)],
            *[F.sum(bend * F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        curve = np.zeros((k + 1, k + 1))
        for i, j in pairs:
            curve[i, j] = curve[j, i] = row[f"h{i}_{j}"]
        return row["loss"], np.array([row[f"g{i}"] for i in range(k + 1)]), curve
