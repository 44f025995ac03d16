"""Data sets, splits, scores, models."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from fixtures import at
from pyspark.sql import functions as F

from sensorweave.operators import learn


@pytest.fixture(scope="module")
def measured(spark):
    rows = [(d, at("01 00:00:00") + dt.timedelta(hours=i), float(i * d), i % 3) for d, n in ((1, 10), (2, 7)) for i in range(n)]
    return spark.createDataFrame(rows, "deployment_id long, ts_utc timestamp, value double, quality_code int")


def test_next_value(measured, sizes):
    rows = learn.with_next(measured).where("deployment_id = 2").orderBy("ts_utc").collect()
    assert [r.y_next for r in rows] == [2.0, 4.0, 6.0, 8.0, 10.0, 12.0, None]
    assert [r.quality_next for r in rows] == [1, 2, 0, 1, 2, 0, None]


def test_ordered_split(measured, sizes):
    rows = learn.ordered_split(measured)
    train = {r.deployment_id: (r.n, r.last) for r in rows.where("is_train").groupBy("deployment_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts_utc").alias("last")).collect()}
    assert train == {1: (7, at("01 06:00:00")), 2: (4, at("01 03:00:00"))}


def test_stratified_split(spark):
    df = spark.range(1000).select(F.col("id").alias("row"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    marked = learn.stratified_split(df, "label", "row")
    assert {r.label: r.n for r in marked.where("is_test").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: 180, 1: 20}
    assert marked.count() == 1000
    again = learn.stratified_split(df.repartition(5), "label", "row")
    assert sorted(marked.where("is_test").collect()) == sorted(again.where("is_test").collect())


def test_class_scores(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4, "label int, prediction int")
    row = learn.class_scores(df).first()
    assert (row.accuracy, row.precision, row.recall) == (0.7, 0.6, 0.75)
    assert row.f1 == pytest.approx(2 / 3)
    nothing = learn.class_scores(df.where("label = 0 AND prediction = 0")).first()
    assert (nothing.precision, nothing.recall, nothing.f1) == (0.0, 0.0, 0.0)


def test_roc(spark):
    """Against pair counting: share of (1, 0) pairs in the right order, ties half."""
    rows = [(i * 7 % 13 / 4, int(i * 5 % 11 > 6)) for i in range(60)]
    df = spark.createDataFrame(rows, "score double, label int")
    ones, zeros = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert learn.auc(df).first().auc == pytest.approx(want)
    points = learn.roc_points(df).orderBy(F.desc("score")).collect()
    for p in points:
        assert p.tpr == pytest.approx(sum(s >= p.score for s in ones) / len(ones))
        assert p.fpr == pytest.approx(sum(s >= p.score for s in zeros) / len(zeros))


def test_linear_model_recovers_a_line(spark):
    df = spark.range(200).selectExpr("id * 1.0D AS a", "id % 7 * 1.0D AS b", "3 * id - 2 * (id % 7) + 1.0D AS y_next")
    scored = learn.linear_regression(["a", "b"]).fit(df).transform(df)
    assert learn.regression_error(scored, "y_next", "prediction").first().rmse < 1e-6


def test_forest_is_saved_and_loaded(spark, tmp_path):
    df = spark.range(300).selectExpr("id", "id % 10 * 1.0D AS value", "0 AS variable_cat", "int(id % 10 > 6) AS label")
    model = learn.forest_classifier(["value", "variable_cat"], trees=10).fit(df)
    learn.save_model(model, str(tmp_path / "model"))
    scored = learn.classify(learn.load_model(str(tmp_path / "model")), df)
    assert scored.where("(label = 1) <> (verdict = 'MALO')").count() == 0


def test_one_class_gives_a_constant(spark):
    df = spark.range(5).selectExpr("id * 1.0D AS value", "0 AS label")
    model = learn.fit_classifier(learn.logistic_regression(["value"], 5), df)
    assert {r.verdict for r in learn.classify(model, df).collect()} == {"BUENO"}


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "variable string")
    assert sorted((r.variable or "", r.variable_cat) for r in learn.category_codes(df).collect()) == [("", -1), ("a", 0), ("a", 0), ("b", 1), ("c", 2)]


def test_roc_with_an_extreme_score(spark):
    """One score far off leaves the others in many buckets, and the area as it is."""
    draw = np.random.default_rng(2)
    rows = [(float(x), int(draw.random() < x)) for x in draw.random(3000)] + [(1e9, 1), (float("-1e12"), 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos, neg = [x for x, y in rows if y], np.sort([x for x, y in rows if not y])
    want = sum(np.searchsorted(neg, x, "left") + np.searchsorted(neg, x, "right") for x in pos) / (2 * len(pos) * len(neg))
    assert learn.auc(df).first().auc == pytest.approx(want)
    assert learn.roc_points(df).count() == len({x for x, _ in rows})


def test_missing_features_are_not_dropped_silently(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 4.0)], "x double, y_next double")
    assert learn.incomplete_rows(df, ["x"]).first().n_incomplete == 1
    with pytest.raises(Exception):  # noqa: B017
        learn.linear_regression(["x"]).fit(df)
    assert learn.linear_regression(["x"]).fit(learn.complete_rows(df, ["x"])).transform(df.limit(1)).count() == 1


def test_dependent_features_and_constants(spark):
    """A feature that others determine, and a constant, get the weight 0; the fit is that of least squares."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 2)) * [1, 1e6] + [0, 1e7]
    y = 3 * x[:, 0] - 2e-6 * x[:, 1] + draw.normal(size=300)
    rows = [(float(a), float(b), float(2 * a - 1), 5.0, float(t)) for (a, b), t in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y_next double")
    model = learn.linear_regression(["a", "b", "c", "d"]).fit(df)
    assert model.weights[2:] == [0.0, 0.0]
    want = np.linalg.lstsq(np.column_stack([np.ones(300), x]), y, rcond=None)[0]
    found = np.array([r.prediction for r in model.transform(df).collect()])
    assert found == pytest.approx(want[0] + x @ want[1:], rel=1e-7, abs=1e-7)


def test_logistic_gradient_vanishes(spark):
    """At the solution the gradient of loss and penalty is 0, in SQL; separable labels do not diverge."""
    draw = np.random.default_rng(5)
    a, b = draw.normal(3, 2, 400), draw.normal(size=400)
    for label in (draw.random(400) < 1 / (1 + np.exp(3 - a)), a > 3):
        df = spark.createDataFrame([(float(u), float(v), int(t)) for u, v, t in zip(a, b, label)], "a double, b double, label int")
        model = learn.logistic_regression(["a", "b"]).fit(df)
        scored = model.transform(df).selectExpr("score - label AS off", f"(a - {model.means[0]}) / {model.deviations[0]} AS x1", f"(b - {model.means[1]}) / {model.deviations[1]} AS x2")
        row = scored.selectExpr("sum(off) AS g0", f"sum(off * x1) + {model.weights[0]} AS g1", f"sum(off * x2) + {model.weights[1]} AS g2").first()
        assert tuple(row) == pytest.approx((0, 0, 0), abs=1e-6)


def test_missing_label_or_nothing_to_learn(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "a double, y_next double")
    for rows in (df, df.where("false")):
        with pytest.raises(ValueError, match="training rows"):
            learn.linear_regression(["a"]).fit(rows)
