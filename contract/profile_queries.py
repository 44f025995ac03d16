"""Exploratory summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.inputs import readings, table
from contract.registry import query, r6, sql_quality, sql_r6, sql_readings
from contract.grid_queries import GRID, _completed
from sensorweave import catalog
from sensorweave.operators import profile

K = 8
STATS = ["mean", "std", "min", "max", "p25", "p50", "p75"]


def _describe(source: str, key: str = "variable") -> str:
    return f"""SELECT {key}, count(value) AS count, {sql_r6('avg(value)')} AS mean, {sql_r6('stddev_samp(value)')} AS std,
  {sql_r6('min(value)')} AS min, {sql_r6('max(value)')} AS max, {sql_r6('quantile_cont(value, 0.25)')} AS p25,
  {sql_r6('quantile_cont(value, 0.5)')} AS p50, {sql_r6('quantile_cont(value, 0.75)')} AS p75 FROM {source} GROUP BY {key}"""


@query("describe", f"WITH {sql_readings(K)} {_describe('r')}")
def describe(spark, folder):
    return profile.describe(readings(spark, folder, K)).withColumns({c: r6(c) for c in STATS})


COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_frame", f"""WITH x AS ({' UNION ALL '.join(f"SELECT '{c}' AS variable, {c} AS value FROM lineitem" for c in COLUMNS)}) {_describe('x')}""")
def describe_frame(spark, folder):
    return profile.describe_frame(table(spark, folder, "lineitem"), COLUMNS).withColumns({c: r6(c) for c in STATS})


@query("iqr_outlier_table", f"""WITH {sql_readings(K)}, x AS (SELECT * FROM r WHERE value IS NOT NULL AND variable <> 'bearing_condition'),
s AS (SELECT variable, count(value) AS count, avg(value) AS mean, min(value) AS min, max(value) AS max,
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM x GROUP BY variable)
SELECT s.variable, s.count, {sql_r6('s.mean')} AS mean, {sql_r6('s.min')} AS min, {sql_r6('s.max')} AS max, {sql_r6('q1')} AS q1, {sql_r6('q3')} AS q3,
  {sql_r6('q3 - q1')} AS iqr, (SELECT count(*) FROM x WHERE x.variable = s.variable AND x.value > s.q3 + 3 * (s.q3 - s.q1)) AS outliers_above FROM s""")
def iqr_outlier_table(spark, folder):
    stats = ["mean", "min", "max", "q1", "q3", "iqr"]
    return profile.outlier_table(readings(spark, folder, K)).withColumns({c: r6(c) for c in stats})


@query("variable_exclusion", f"WITH {sql_readings(K)} SELECT reading_id, variable FROM r WHERE value IS NOT NULL AND variable NOT IN ('bearing_condition', 'output_power')")
def variable_exclusion(spark, folder):
    return profile.without_variables(readings(spark, folder, K), ["bearing_condition", "output_power"]).select("reading_id", "variable")


@query("missing_ratio", f"WITH {GRID} SELECT variable, {sql_r6('avg((value IS NULL)::INT)')} AS missing_ratio FROM g GROUP BY variable")
def missing_ratio(spark, folder):
    return profile.missing_ratio(_completed(spark, folder)).withColumn("missing_ratio", r6("missing_ratio")).orderBy(F.desc("missing_ratio"))


@query("categorical_summary", f"""WITH {sql_readings(K)}, c AS (SELECT variable, value, count(*) AS n FROM r WHERE variable = 'bearing_condition' AND value IS NOT NULL GROUP BY ALL)
SELECT variable, value, n, (sum(n) OVER w)::BIGINT AS count, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) = 1 AS is_most_frequent
FROM c WINDOW w AS (PARTITION BY variable)""")
def categorical_summary(spark, folder):
    return profile.categorical_summary(readings(spark, folder, K))


@query("value_counts", f"""WITH {sql_readings(K)} SELECT variable, value, count(*) AS n FROM r WHERE variable = 'bearing_condition' GROUP BY ALL""")
def value_counts(spark, folder):
    return profile.value_counts(readings(spark, folder, K).where(F.col("variable") == "bearing_condition"))


@query("percentiles", f"""WITH {sql_readings(K)} SELECT deployment_id, variable, {sql_r6('quantile_cont(value, 0.5)')} AS p50,
  {sql_r6('quantile_cont(value, 0.95)')} AS p95, {sql_r6('quantile_cont(value, 0.99)')} AS p99 FROM r WHERE value IS NOT NULL GROUP BY ALL""")
def percentiles(spark, folder):
    return profile.percentiles(readings(spark, folder, K), ("deployment_id", "variable")).withColumns({c: r6(c) for c in ["p50", "p95", "p99"]})


P99 = f"""{sql_readings(K)}, t AS (SELECT variable, quantile_cont(value, 0.99) AS p99 FROM r WHERE value IS NOT NULL GROUP BY variable)
SELECT reading_id, variable FROM r JOIN t USING (variable) WHERE value"""


@query("percentile_filter", f"WITH {P99} <= p99")
def percentile_filter(spark, folder):
    return profile.split_at_percentile(readings(spark, folder, K)).select("reading_id", "variable")


@query("above_percentile", f"WITH {P99} > p99")
def above_percentile(spark, folder):
    return profile.split_at_percentile(readings(spark, folder, K), above=True).select("reading_id", "variable")


@query("histogram", f"""WITH {sql_readings(K)}, x AS (SELECT variable, value FROM r WHERE value IS NOT NULL),
s AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM x GROUP BY variable),
b AS (SELECT variable, lo, (hi - lo) / 40 AS width, least(floor((value - lo) / ((hi - lo) / 40)), 39)::BIGINT AS bin FROM x JOIN s USING (variable))
SELECT variable, bin, {sql_r6('lo + bin * width')} AS bin_start, {sql_r6('lo + (bin + 1) * width')} AS bin_end, count(*) AS n FROM b GROUP BY variable, bin, lo, width""")
def histogram(spark, folder):
    return profile.histogram(readings(spark, folder, K)).withColumns({c: r6(c) for c in ["bin_start", "bin_end"]})


BOX = f"""{sql_readings(K)}, x AS (SELECT reading_id, variable, value FROM r WHERE value IS NOT NULL),
s AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM x GROUP BY variable),
y AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM x JOIN s USING (variable))"""


@query("boxplot", f"""WITH {BOX} SELECT variable, {sql_r6('q1')} AS q1, {sql_r6('median')} AS median, {sql_r6('q3')} AS q3,
  {sql_r6('min(value) FILTER (value >= lo)')} AS whisker_low, {sql_r6('max(value) FILTER (value <= hi)')} AS whisker_high,
  count(*) FILTER (value < lo OR value > hi) AS outliers FROM y GROUP BY variable, q1, median, q3""")
def boxplot(spark, folder):
    return profile.boxplot(readings(spark, folder, K)).withColumns({c: r6(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]})


@query("boxplot_outliers", f"WITH {BOX} SELECT reading_id, variable, {sql_r6('value')} AS value FROM y WHERE value < lo OR value > hi")
def boxplot_outliers(spark, folder):
    return profile.boxplot_outliers(readings(spark, folder, K)).select("reading_id", "variable", r6("value").alias("value"))
