"""Training sets, splits, baselines, models and their scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.ordered import CHUNK, CHUNKING, with_chunks, with_neighbour, with_position
from sensorweave.functions.totals import running_totals
from sensorweave.operators.grid import pivot_wide
from sensorweave.operators.linear import LeastSquares, Logistic
from sensorweave.operators.windows import SPECTRAL_FEATURES, TIME_FEATURES

KEY = ("deployment_id",)
FEATURE_NAMES = TIME_FEATURES + SPECTRAL_FEATURES
NOT_FEATURES = ["deployment_id", "ts_utc", "value", "y_next", "quality_code", "quality_next"]
SEED = 42
DEEPEST = 30  # Spark's own bound
TREES = 200


# --- next-value data set -----------------------------------------------------------

def with_next(
    measurements: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ("ts_utc",)
) -> DataFrame:
    """Value and quality of the following measurement of the deployment (one variable)."""
    rows = with_neighbour(
        with_chunks(measurements, keys), keys, ["value", "quality_code"], order, "_next", ahead=True
    )
    return rows.withColumns({"y_next": F.col("_next.value"), "quality_next": F.col("_next.quality_code")}).drop(
        "_next", *CHUNKING
    )


def pivot_features(features: DataFrame, names: Sequence[str] = tuple(FEATURE_NAMES)) -> DataFrame:
    return pivot_wide(features, ("deployment_id", "ts_utc"), names, names="feature", how=F.avg)


def supervised(features_wide: DataFrame, measurements: DataFrame) -> DataFrame:
    """Features joined to the measurement of the same time, rows with a target only."""
    rows = with_next(measurements).select(
        "deployment_id", "ts_utc", "value", "y_next", "quality_code", "quality_next"
    )
    joined = features_wide.join(rows, ["deployment_id", "ts_utc"], "inner")
    return joined.where(F.col("y_next").isNotNull())


def clean_rows(dataset: DataFrame) -> DataFrame:
    """Rows whose current and next measurement are both good."""
    return dataset.where((F.col("quality_code") == 0) & (F.col("quality_next") == 0))


def feature_columns(dataset: DataFrame, excluded: Sequence[str] = tuple(NOT_FEATURES)) -> list[str]:
    return [c for c in dataset.columns if c not in excluded]


# --- splits ------------------------------------------------------------------------

def ordered_split(
    df: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ("ts_utc",), train: float = 0.7, ts: str = "ts_utc"
) -> DataFrame:
    """Mark the first `floor(train * n)` rows of each deployment with `is_train`."""
    ranked = with_position(with_chunks(df, keys, ts), keys, order).drop(*CHUNKING)
    sizes = df.groupBy(*keys).agg(F.floor(F.count(F.lit(1)) * train).alias("_train_rows"))
    return (
        ranked.join(sizes, list(keys), "left")
        .withColumn("is_train", F.col("_pos") < F.col("_train_rows"))
        .drop("_pos", "_train_rows")
    )


SPREAD_DIGITS = 4  # hash digits that name a bucket


def stratified_split(
    df: DataFrame, label: str, row_id: str, test: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Mark `round(test * n)` rows of each label, drawn by a seeded hash of the row id, as test.

    The hash range is cut into equal buckets that play the part of chunks, so a label of
    any size is ranked in small groups.
    """
    drawn = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))))
    drawn = drawn.withColumn(CHUNK, F.conv(F.substring("_hash", 1, SPREAD_DIGITS), 16, 10).cast("long"))
    ranked = with_position(drawn, [label], ["_hash", row_id]).drop(CHUNK, "_hash")
    sizes = df.groupBy(label).agg(F.round(F.count(F.lit(1)) * test).cast("long").alias("_test_rows"))
    return (
        ranked.join(F.broadcast(sizes), label, "left")  # one row per class
        .withColumn("is_test", F.col("_pos") < F.col("_test_rows"))
        .drop("_pos", "_test_rows")
    )


# --- scores ------------------------------------------------------------------------

def regression_error(df: DataFrame, truth: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    error = F.col(prediction) - F.col(truth)
    return df.groupBy(*keys).agg(
        F.count(error).alias("n"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def persistence(df: DataFrame) -> DataFrame:
    """Baseline: the next value equals the current one."""
    return df.withColumn("prediction", F.col("value"))


def binary_quality(code: Column) -> Column:
    """1 for any anomaly code, else 0."""
    return F.when(code > 0, 1).otherwise(0)


def confusion(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(truth, prediction).agg(F.count(F.lit(1)).alias("n"))


def class_scores(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0 where a ratio is undefined."""
    y, p = F.col(truth) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "accuracy": ratio(tp + F.col("tn"), F.col("n")),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    })


def _roc_table(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Per distinct score: positives and negatives at it (`_p`, `_n`), at it or higher, and in total."""
    counted = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(truth) == 1).alias("_p"), F.count_if(F.col(truth) != 1).alias("_n")
    )
    return running_totals(counted, [F.desc("score")], ["_p", "_n"])


def roc_points(df: DataFrame, score: str = "score", truth: str = "label") -> DataFrame:
    """One point per distinct score: false and true positive rate of 'this score or higher'."""
    return _roc_table(df, score, truth).selectExpr(
        "score", "try_divide(_upto_n, _all_n) AS fpr", "try_divide(_upto_p, _all_p) AS tpr"
    )


def auc(df: DataFrame, score: str = "score", truth: str = "label") -> DataFrame:
    """Area under the ROC curve: per score the step in fpr times the mean tpr across it."""
    return _roc_table(df, score, truth).agg(
        F.expr("sum(try_divide(_n, _all_n) * try_divide(_upto_p - _p / 2, _all_p)) AS auc")
    )


# --- models ------------------------------------------------------------------------

def category_codes(df: DataFrame, column: str = "variable", output: str = "variable_cat") -> DataFrame:
    """0-based rank of the category in lexicographic order, -1 for NULL.

    The distinct categories are counted by range partitions; they are written on the way.
    """
    names = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_one", F.lit(1))
    codes = running_totals(names, [F.asc(column)], ["_one"]).select(column, (F.col("_upto_one") - 1).cast("int").alias(output))
    return df.join(codes, column, "left").withColumn(output, F.coalesce(F.col(output), F.lit(-1)))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose features are all there. Models raise on others: dropping them is a choice made here."""
    return df.dropna(how="any", subset=list(columns))


def incomplete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: `n_incomplete`, rows with a missing feature."""
    lacking = F.lit(False)
    for c in columns:
        lacking = lacking | F.col(c).isNull()
    return df.agg(F.count_if(lacking).alias("n_incomplete"))


def _assembled(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def linear_regression(columns: Sequence[str], label: str = "y_next") -> LeastSquares:
    return LeastSquares(columns, label)


def forest_regression(
    columns: Sequence[str], label: str = "y_next", trees: int = TREES, depth: int = DEEPEST, seed: int = SEED
) -> Pipeline:
    """Trees grow out, as far as Spark lets them."""
    forest = RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="all"
    )
    return Pipeline(stages=[_assembled(columns), forest])


def logistic_regression(columns: Sequence[str], label: str = "label") -> Logistic:
    """L2 with C = 1 over features of unit deviation."""
    return Logistic(columns, label)


def forest_classifier(
    columns: Sequence[str], label: str = "label", trees: int = TREES, depth: int = DEEPEST, seed: int = SEED
) -> Pipeline:
    forest = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[_assembled(columns), forest])


def index_variable(df: DataFrame, column: str = "variable", output: str = "variable_cat") -> DataFrame:
    """`category_codes` by the ML indexer, for use inside a saved model."""
    indexer = StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="keep")
    return indexer.fit(df).transform(df)


def with_score(predictions: DataFrame) -> DataFrame:
    """Probability of class 1 as a plain column."""
    return predictions.withColumn("score", vector_to_array("probability")[1])


def fit_classifier(pipeline: Pipeline | Logistic, train: DataFrame, label: str = "label"):
    """Fit, or return a constant predictor when the training rows have a single class.

    Training on clean rows only is such a case: every label is 0.
    """
    span = train.agg(F.min(label).alias("low"), F.max(label).alias("high")).first()
    if span["low"] == span["high"]:
        return ConstantModel(float(span["low"]))
    return pipeline.fit(train)


class ConstantModel:
    """Predicts the one class it has seen."""

    def __init__(self, value: float):
        self.value = value

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.value)).withColumn("score", F.lit(self.value))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# Names of the two classes.
GOOD, BAD = "BUENO", "MALO"


def classify(model, df: DataFrame) -> DataFrame:
    """Score a batch and name the class."""
    scored = model.transform(df)
    return scored.withColumn("verdict", F.when(F.col("prediction") == 0, GOOD).otherwise(BAD))
