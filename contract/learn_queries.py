"""Training sets, splits, scores, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.feature_queries import EXPECTED_S, K, NAMES, WINDOW_S, WINDOWS, _windows, flagged
from contract.registry import query, r6, sql_quality, sql_r6, us
from contract.source_queries import _folder
from sensorweave.operators import learn, linear, windows
from sensorweave.session import materialise

# measurements of the main signal with the following one, joined to the windows ending there
NEXT = f"""nx AS (SELECT deployment_id, us, value, quality_code,
    lead(value) OVER w AS y_next, lead(quality_code) OVER w AS quality_next
  FROM q WHERE variable = 'acc_rms_radial' WINDOW w AS (PARTITION BY deployment_id ORDER BY us))"""
DATASET = f"""{WINDOWS}, {NEXT},
ds AS (SELECT ft.deployment_id, ft.ts_us, {', '.join(f'ft.{n}' for n in NAMES)}, nx.value, nx.y_next, nx.quality_code, nx.quality_next
  FROM ft JOIN nx ON ft.deployment_id = nx.deployment_id AND ft.ts_us = nx.us WHERE nx.y_next IS NOT NULL)"""


def _signal(spark, folder):
    return flagged(spark, folder).where(F.col("variable") == "acc_rms_radial")


def _dataset(spark, folder):
    rows = flagged(spark, folder)
    features = learn.pivot_features(windows.features_long(windows.window_features(rows, WINDOW_S)))
    return learn.supervised(features, rows.where(F.col("variable") == "acc_rms_radial"))


@query("feature_pivot", f"WITH {WINDOWS} SELECT deployment_id, ts_us, {', '.join(f'{sql_r6(n)} AS {n}' for n in NAMES)} FROM ft")
def feature_pivot(spark, folder):
    wide = learn.pivot_features(windows.features_long(_windows(spark, folder)))
    return wide.select("deployment_id", us("ts_utc").alias("ts_us"), *[r6(n).alias(n) for n in NAMES])


@query("next_value", f"WITH {sql_quality(K, EXPECTED_S)}, {NEXT} SELECT deployment_id, us AS ts_us, {sql_r6('y_next')} AS y_next, quality_next FROM nx")
def next_value(spark, folder):
    rows = learn.with_next(_signal(spark, folder))
    return rows.select("deployment_id", us("ts_utc").alias("ts_us"), r6("y_next").alias("y_next"), "quality_next")


@query("next_value_dataset", f"""WITH {DATASET} SELECT deployment_id, ts_us, {', '.join(f'{sql_r6(n)} AS {n}' for n in NAMES)}, {sql_r6('value')} AS value,
  {sql_r6('y_next')} AS y_next, quality_code, quality_next, quality_code = 0 AND quality_next = 0 AS is_clean FROM ds""")
def next_value_dataset(spark, folder):
    data = _dataset(spark, folder)
    clean = (F.col("quality_code") == 0) & (F.col("quality_next") == 0)
    return data.select(
        "deployment_id", us("ts_utc").alias("ts_us"), *[r6(n).alias(n) for n in NAMES], r6("value").alias("value"),
        r6("y_next").alias("y_next"), "quality_code", "quality_next", clean.alias("is_clean"),
    )


SPLIT = f"""{sql_quality(K, EXPECTED_S)}, sg AS (SELECT * FROM q WHERE variable = 'acc_rms_radial'),
pt AS (SELECT *, row_number() OVER (PARTITION BY deployment_id ORDER BY us) <= floor(0.7 * count(*) OVER (PARTITION BY deployment_id)) AS is_train FROM sg)"""


@query("ordered_split", f"WITH {SPLIT} SELECT reading_id, deployment_id, is_train FROM pt")
def ordered_split(spark, folder):
    return learn.ordered_split(_signal(spark, folder)).select("reading_id", "deployment_id", "is_train")


def _error(source: str, name: str) -> str:
    return f"SELECT '{name}' AS scenario, count(*) AS n, {sql_r6('avg(abs(value - y_next))')} AS mae, {sql_r6('sqrt(avg(pow(value - y_next, 2)))')} AS rmse FROM {source}"


@query("persistence_error", f"""WITH {sql_quality(K, EXPECTED_S)}, {NEXT}, al AS (SELECT * FROM nx WHERE y_next IS NOT NULL AND value IS NOT NULL),
cl AS (SELECT * FROM al WHERE quality_code = 0 AND quality_next = 0) {_error('al', 'dirty')} UNION ALL {_error('cl', 'clean')}""")
def persistence_error(spark, folder):
    """Error of 'the next value equals this one' on all rows and on clean rows, in one pass."""
    rows = learn.persistence(learn.with_next(_signal(spark, folder))).where("y_next IS NOT NULL AND value IS NOT NULL")
    clean = (F.col("quality_code") == 0) & (F.col("quality_next") == 0)
    scenarios = F.when(clean, F.array(F.lit("dirty"), F.lit("clean"))).otherwise(F.array(F.lit("dirty")))
    errors = learn.regression_error(rows.withColumn("scenario", F.explode(scenarios)), "y_next", "prediction", ["scenario"])
    return errors.withColumns({"mae": r6("mae"), "rmse": r6("rmse")})


def _labelled(spark, folder):
    rows = flagged(spark, folder).where("value IS NOT NULL")
    rows = rows.withColumn("label", learn.binary_quality(F.col("quality_code")))
    return rows.select("reading_id", "variable", "value", "quality_code", "label")


LABELLED = f"{sql_quality(K, EXPECTED_S)}, lb AS (SELECT reading_id, variable, value, (quality_code > 0)::INT AS label FROM q WHERE value IS NOT NULL)"


@query("quality_label", f"WITH {LABELLED} SELECT reading_id, label FROM lb")
def quality_label(spark, folder):
    return _labelled(spark, folder).select("reading_id", "label")


@query("category_codes", f"WITH {LABELLED} SELECT reading_id, variable, (dense_rank() OVER (ORDER BY variable) - 1)::INT AS variable_cat FROM lb")
def category_codes(spark, folder):
    return learn.category_codes(_labelled(spark, folder)).select("reading_id", "variable", "variable_cat")


@query("class_metrics", f"""WITH {LABELLED}, pr AS (SELECT label, (value > 200)::INT AS prediction FROM lb),
c AS (SELECT count(*) AS n, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM pr)
SELECT n, tp, fp, fn, tn, {sql_r6('(tp + tn) / n')} AS accuracy, {sql_r6('tp / (tp + fp)')} AS precision, {sql_r6('tp / (tp + fn)')} AS recall,
  {sql_r6('2 * tp / (2 * tp + fp + fn)')} AS f1 FROM c""")
def class_metrics(spark, folder):
    rows = _labelled(spark, folder).withColumn("prediction", (F.col("value") > 200).cast("int"))
    return learn.class_scores(rows).withColumns({c: r6(c) for c in ["accuracy", "precision", "recall", "f1"]})


@query("confusion", f"WITH {LABELLED} SELECT label, (value > 200)::INT AS prediction, count(*) AS n FROM lb GROUP BY ALL")
def confusion(spark, folder):
    return learn.confusion(_labelled(spark, folder).withColumn("prediction", (F.col("value") > 200).cast("int")))


ROC = f"""{LABELLED}, sc AS (SELECT value AS score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM lb GROUP BY value),
rc AS (SELECT score, p, n, sum(n) OVER (ORDER BY score DESC) / sum(n) OVER () AS fpr, sum(p) OVER (ORDER BY score DESC) / sum(p) OVER () AS tpr,
  sum(n) OVER () AS an, sum(p) OVER () AS ap FROM sc)"""


@query("roc_points", f"WITH {ROC} SELECT {sql_r6('score')} AS score, {sql_r6('fpr')} AS fpr, {sql_r6('tpr')} AS tpr FROM rc")
def roc_points(spark, folder):
    points = learn.roc_points(_labelled(spark, folder), score="value")
    return points.select(r6("score").alias("score"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("roc_auc", f"WITH {ROC} SELECT {sql_r6('sum(n / an * (tpr - p / ap / 2))')} AS auc FROM rc")
def roc_auc(spark, folder):
    return learn.auc(_labelled(spark, folder), score="value").withColumn("auc", r6("auc"))


@query("stratified_split", f"""WITH {LABELLED}, h AS (SELECT reading_id, label,
  row_number() OVER (PARTITION BY label ORDER BY md5('{learn.SEED}:' || reading_id), reading_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM lb)
SELECT reading_id, label, k <= round(n * 0.2) AS is_test FROM h""")
def stratified_split(spark, folder):
    rows = learn.stratified_split(_labelled(spark, folder), "label", "reading_id")
    return rows.select("reading_id", "label", "is_test")


# --- models ------------------------------------------------------------------------

# the data set with its split; `clean` rows have a good current and next measurement
SPLIT_DATASET = f"""{DATASET},
dt AS (SELECT *, row_number() OVER (PARTITION BY deployment_id ORDER BY ts_us) <= floor(0.7 * count(*) OVER (PARTITION BY deployment_id)) AS is_train,
  quality_code = 0 AND quality_next = 0 AS clean FROM ds)"""


def _swept(matrix: str, k: int, name: str) -> str:
    """CTEs `name`_sweep: a system of `k` unknowns, in `matrix` (m: k rows of k + 1), after elimination."""
    pivot = "m[step][step]"
    row = f"CASE WHEN i = step THEN list_transform(r, lambda x: x / {pivot}) ELSE list_transform(r, lambda x, j: x - r[step] * m[step][j] / {pivot}) END"
    return f"""{name}_sweep(step, m) AS (SELECT 1, m FROM {matrix} UNION ALL
  SELECT step + 1, CASE WHEN {pivot} > {linear.DEPENDENT!r} THEN list_transform(m, lambda r, i: {row}) ELSE m END FROM {name}_sweep WHERE step <= {k})"""


def _least_squares(name: str, condition: str) -> str:
    """CTEs up to `name`_pr: test rows of a scenario with the prediction of the line fitted to its training rows."""
    k = len(NAMES)
    deviation = [f"coalesce(nullif(stddev_pop({c}), 0), 1)" for c in NAMES]
    rows = [", ".join([*[f"covar_pop({a}, {b}) / ({da} * {db})" for b, db in zip(NAMES, deviation)], f"covar_pop({a}, y_next) / {da}"]) for a, da in zip(NAMES, deviation)]
    terms = " + ".join(f"w[{i}] * ({c} - mean_of[{i}]) / dev[{i}]" for i, c in enumerate(NAMES, 1))
    return f"""{name}_m AS (SELECT [{', '.join(f'[{r}]' for r in rows)}] AS m, [{', '.join(f'avg({c})' for c in NAMES)}] AS mean_of,
  [{', '.join(deviation)}] AS dev, avg(y_next) AS level FROM dt WHERE is_train AND {condition}),
{_swept(f'{name}_m', k, name)},
{name}_w AS (SELECT list_transform(m, lambda r, i: CASE WHEN r[i] > 0.5 THEN r[{k + 1}] ELSE 0 END) AS w FROM {name}_sweep WHERE step = {k + 1}),
{name}_pr AS (SELECT '{name}' AS scenario, value, y_next, level + {terms} AS prediction FROM dt, {name}_m, {name}_w WHERE NOT is_train AND {condition})"""


LINES = f"{SPLIT_DATASET}, {_least_squares('dirty', 'true')}, {_least_squares('clean', 'clean')}, pr AS (FROM dirty_pr UNION ALL FROM clean_pr)"


def _split_dataset(spark, folder):
    return materialise(learn.ordered_split(_dataset(spark, folder)), "dataset")


SCENARIOS = (("dirty", lambda rows: rows), ("clean", learn.clean_rows))


def _predicted(data, pipeline):
    """Test rows of both scenarios with the predictions of a model fitted to their training rows."""
    done = []
    for scenario, chosen in SCENARIOS:
        rows = chosen(data)
        columns = learn.feature_columns(rows.drop("is_train", "prediction"))
        model = pipeline(columns).fit(learn.complete_rows(rows.where("is_train"), columns))
        done.append(model.transform(rows.where("NOT is_train")).select(F.lit(scenario).alias("scenario"), "value", "y_next", "prediction"))
    return done[0].unionByName(done[1])


def _scored(rows, *keys):
    errors = learn.regression_error(rows, "y_next", "prediction", ["scenario", *keys])
    return errors.withColumns({"mae": r6("mae"), "rmse": r6("rmse")})


def _scores_of(source: str, prediction: str, more: str = "") -> str:
    return f"""SELECT scenario, {more} count({prediction} - y_next) AS n, {sql_r6(f'avg(abs({prediction} - y_next))')} AS mae,
  {sql_r6(f'sqrt(avg(pow({prediction} - y_next, 2)))')} AS rmse FROM {source} GROUP BY scenario"""


@query("linreg", f"WITH RECURSIVE {LINES} {_scores_of('pr', 'prediction')}")
def linreg(spark, folder):
    return _scored(_predicted(_split_dataset(spark, folder), learn.linear_regression))


@query("model_table", f"""WITH RECURSIVE {LINES} {_scores_of('pr', 'prediction', "'line' AS model,")}
UNION ALL {_scores_of('pr', 'value', "'persistence' AS model,")}""")
def model_table(spark, folder):
    """The fitted line next to 'the next value equals this one', on the same test rows."""
    line = _predicted(_split_dataset(spark, folder), learn.linear_regression).withColumn("model", F.lit("line"))
    return _scored(line.unionByName(learn.persistence(line).withColumn("model", F.lit("persistence"))), "model")


@query("rf_reg", f"""WITH {SPLIT_DATASET}, te AS (SELECT 'dirty' AS scenario FROM dt WHERE NOT is_train UNION ALL SELECT 'clean' FROM dt WHERE NOT is_train AND clean)
SELECT scenario, count(*) AS n, 0::BIGINT AS n_outside, true AS beats_persistence FROM te GROUP BY scenario""")
def rf_reg(spark, folder):
    """What must hold of any forest: it predicts every test row, between the smallest and the largest
    label it was shown, and errs less than persistence does."""
    data = _split_dataset(spark, folder)
    shown = []
    for scenario, chosen in SCENARIOS:
        shown.append(chosen(data).where("is_train").agg(F.min("y_next").alias("low"), F.max("y_next").alias("high")).withColumn("scenario", F.lit(scenario)))
    rows = _predicted(data, learn.forest_regression).join(F.broadcast(shown[0].unionByName(shown[1])), "scenario")  # two rows
    error, before = F.col("prediction") - F.col("y_next"), F.col("value") - F.col("y_next")
    outside = ~F.coalesce(F.col("prediction").between(F.col("low") - 1e-9, F.col("high") + 1e-9), F.lit(False))
    return rows.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(outside).alias("n_outside"), (F.avg(error * error) < F.avg(before * before)).alias("beats_persistence")
    )


CLASS_FEATURES = ["value", "variable_cat"]
LABELLED_SPLIT = f"""{LABELLED}, cd AS (SELECT *, dense_rank() OVER (ORDER BY variable) - 1 AS variable_cat,
  row_number() OVER (PARTITION BY label ORDER BY md5('{learn.SEED}:' || reading_id), reading_id) <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM lb)"""
PAIRS = [(i, j) for i in range(3) for j in range(i, 3)]


def _newton(steps: int = 30) -> str:
    """CTEs up to `lg`: test rows with the score of a logistic regression by Newton's method, C = 1.

    Each step solves three equations by Cramer's rule."""
    x = ["1.0::DOUBLE", "(value - mv) / dv", "(variable_cat - mc) / dc"]
    z = "b0 + b1 * x1 + b2 * x2"
    h = {(i, j): f"h{min(i, j)}{max(i, j)}" for i in range(3) for j in range(3)}

    def det(m) -> str:
        return " + ".join(f"{m[0][i]} * ({m[1][(i + 1) % 3]} * {m[2][(i + 2) % 3]} - {m[1][(i + 2) % 3]} * {m[2][(i + 1) % 3]})" for i in range(3))

    matrix = [[h[i, j] for j in range(3)] for i in range(3)]
    steps_of = [det([[f"g{i}" if j == c else matrix[i][j] for j in range(3)] for i in range(3)]) for c in range(3)]
    sums = ", ".join([*[f"sum((p - label) * x{i}){f' + b{i}' if i else ''} AS g{i}" for i in range(3)],
                      *[f"sum(p * (1 - p) * x{i} * x{j}){' + 1' if i == j and i else ''} AS h{i}{j}" for i, j in PAIRS]])
    return f"""{LABELLED_SPLIT},
sc AS (SELECT avg(value) AS mv, stddev_pop(value) AS dv, avg(variable_cat) AS mc, stddev_pop(variable_cat) AS dc FROM cd WHERE NOT is_test),
xs AS (SELECT reading_id, label, is_test, {', '.join(f'{e} AS x{i}' for i, e in enumerate(x))} FROM cd, sc),
nt(step, b0, b1, b2) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
  SELECT step + 1, {', '.join(f'b{c} - ({s}) / ({det(matrix)})' for c, s in enumerate(steps_of))} FROM (
    SELECT step, b0, b1, b2, {sums} FROM (SELECT nt.*, xs.*, 1 / (1 + exp(-({z}))) AS p FROM nt, xs WHERE NOT is_test) GROUP BY step, b0, b1, b2)
  WHERE step < {steps}),
lg AS (SELECT reading_id, label, 1 / (1 + exp(-({z}))) AS score FROM xs, nt WHERE is_test AND step = {steps})"""


def _classified(spark, folder):
    rows = learn.category_codes(_labelled(spark, folder))
    return materialise(learn.stratified_split(rows, "label", "reading_id"), "labelled")


def _logistic(spark, folder):
    rows = _classified(spark, folder)
    model = learn.fit_classifier(learn.logistic_regression(CLASS_FEATURES), rows.where("NOT is_test"))
    return model.transform(rows.where("is_test"))


METRICS = f"""c AS (SELECT count(*) AS n, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM pr)
SELECT n, tp, fp, fn, tn, {sql_r6('(tp + tn) / n')} AS accuracy, {sql_r6('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
  {sql_r6('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall, {sql_r6('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM c"""


@query("logreg", f"WITH RECURSIVE {_newton()}, pr AS (SELECT label, (score > 0.5)::INT AS prediction FROM lg), {METRICS}")
def logreg(spark, folder):
    return learn.class_scores(_logistic(spark, folder)).withColumns({c: r6(c) for c in ["accuracy", "precision", "recall", "f1"]})


@query("logreg_scores", f"WITH RECURSIVE {_newton()} SELECT reading_id, label, {sql_r6('score')} AS score FROM lg")
def logreg_scores(spark, folder):
    return _logistic(spark, folder).select("reading_id", "label", r6("score").alias("score"))


@query("logreg_auc", f"""WITH RECURSIVE {_newton()}, sc2 AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM lg GROUP BY score),
rc AS (SELECT p, n, sum(p) OVER (ORDER BY score DESC) / sum(p) OVER () AS tpr, sum(n) OVER () AS an, sum(p) OVER () AS ap FROM sc2)
SELECT {sql_r6('sum(n / an * (tpr - p / ap / 2))')} AS auc FROM rc""")
def logreg_auc(spark, folder):
    """Area under the ROC curve of the fitted classifier on the test rows."""
    return learn.auc(_logistic(spark, folder)).withColumn("auc", r6("auc"))


@query("rf_cls", f"""WITH {LABELLED_SPLIT} SELECT reading_id, label, true AS in_range, true AS same_when_loaded, true AS verdict_agrees FROM cd WHERE is_test""")
def rf_cls(spark, folder):
    """Forest trained, saved, loaded and used on the test rows: what must hold of any forest.

    Scores are probabilities, the loaded model says what the fitted one says, and the name of the class
    follows the prediction."""
    rows = _classified(spark, folder)
    model = learn.fit_classifier(learn.forest_classifier(CLASS_FEATURES), rows.where("NOT is_test"))
    path = _folder(spark, "forest")
    learn.save_model(model, path)
    test = rows.where("is_test")
    own = learn.with_score(model.transform(test)).select("reading_id", F.col("prediction").alias("own"), F.col("score").alias("own_score"))
    scored = learn.with_score(learn.classify(learn.load_model(path), test)).join(own, "reading_id")
    verdict = F.when(F.col("score") > 0.5, learn.BAD).otherwise(learn.GOOD)
    return scored.select(
        "reading_id", "label", F.col("score").between(0, 1).alias("in_range"),
        ((F.col("own") == F.col("prediction")) & (F.col("own_score") == F.col("score"))).alias("same_when_loaded"),
        (F.col("verdict") == verdict).alias("verdict_agrees"),
    )


@query("rf_clean_only", f"""WITH {LABELLED} SELECT count(*) AS n, 0::BIGINT AS tp, 0::BIGINT AS fp, count(*) FILTER (label = 1) AS fn,
  count(*) FILTER (label = 0) AS tn FROM lb""")
def rf_clean_only(spark, folder):
    """A classifier that saw clean rows only has one class: it calls every row clean."""
    rows = learn.category_codes(_labelled(spark, folder))
    model = learn.fit_classifier(learn.forest_classifier(CLASS_FEATURES), rows.where("label = 0"))
    scores = learn.class_scores(model.transform(rows))
    return scores.select("n", "tp", "fp", "fn", "tn")
