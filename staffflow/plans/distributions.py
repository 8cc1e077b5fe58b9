"""Queries of the distribution family."""

from itertools import combinations

from pyspark.sql import functions as F

from staffflow.operators import distributions as ops
from staffflow.operators.clean import exit_category
from staffflow.plans.registry import query
from staffflow.sources.tables import on_panel, panel

NUMBERS = ["age", "salary", "overtime", "absence_days", "switching_readiness", "satisfaction", "tenure"]


def union_all(template: str, columns=NUMBERS) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@query(
    "skew_kurtosis",
    on_panel(union_all(
        "SELECT '{c}' AS variable, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis FROM panel"
    )),
)
def skew_kurtosis(spark, sf_dir):
    return ops.rounded(ops.skew_kurtosis(panel(spark, sf_dir, NUMBERS), NUMBERS), 6, ["skewness", "kurtosis"])


HISTOGRAM_SQL = """SELECT '{c}' AS variable, CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin,
  round(lo + CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER) * ((hi - lo) / 30), 6) AS bin_start,
  round(lo + (CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER) + 1) * ((hi - lo) / 30), 6) AS bin_end,
  count(*) AS count
  FROM (SELECT CAST({c} AS DOUBLE) AS v FROM panel), (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM panel)
  GROUP BY ALL"""


@query("histogram_bins", on_panel(union_all(HISTOGRAM_SQL)))
def histogram_bins(spark, sf_dir):
    return ops.rounded(ops.histogram_bins(panel(spark, sf_dir, NUMBERS), NUMBERS), 6, ["bin_start", "bin_end"])


PCT_SQL = """SELECT '{c}' AS variable, status, floor({c} / CAST({w} AS DOUBLE)) * {w} AS bin_start, count(*) AS count,
  round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY status), 6) AS percent FROM panel
  GROUP BY status, floor({c} / CAST({w} AS DOUBLE))"""


@query(
    "histogram_pct_by_status",
    on_panel(PCT_SQL.format(c="age", w=5) + " UNION ALL " + PCT_SQL.format(c="salary", w=10000)),
)
def histogram_pct_by_status(spark, sf_dir):
    src = panel(spark, sf_dir, ["age", "salary", "status"])
    parts = [
        ops.histogram_pct_by_status(src, c, w).select(F.lit(c).alias("variable"), "*")
        for c, w in [("age", 5), ("salary", 10000)]
    ]
    return ops.rounded(parts[0].unionByName(parts[1]), 6, ["percent"])


@query(
    "kde_grid",
    on_panel("""SELECT i, round(x, 6) AS x, round(sum(w * exp(-0.5e0 * ((x - v) / bw) * ((x - v) / bw)))
        / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 6) AS density
      FROM (SELECT switching_readiness AS v, CAST(count(*) AS DOUBLE) AS w FROM panel GROUP BY 1),
        (SELECT i, lo - 3 * bw + i * ((hi - lo + 6 * bw) / 199) AS x, n, bw FROM
          (SELECT CAST(count(*) AS DOUBLE) AS n, stddev_samp(switching_readiness) * pow(count(*), -0.2e0) AS bw,
             min(switching_readiness) AS lo, max(switching_readiness) AS hi FROM panel),
          (SELECT CAST(range AS INTEGER) AS i FROM range(200)))
      GROUP BY i, x"""),
)
def kde_grid(spark, sf_dir):
    return ops.rounded(ops.kde_grid(panel(spark, sf_dir, ["switching_readiness"]), "switching_readiness"), 6, ["x", "density"])


@query(
    "correlation_long",
    on_panel(" UNION ALL ".join(
        f"SELECT '{x}' AS column_a, '{y}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM panel"
        for a, b in combinations(NUMBERS, 2) for x, y in [(a, b), (b, a)]
    )),
)
def correlation_long(spark, sf_dir):
    return ops.rounded(ops.correlation_long(panel(spark, sf_dir, NUMBERS)), 6, ["correlation"])


BOXED = ["salary", "overtime", "satisfaction"]


@query(
    "box_stats",
    on_panel(union_all(
        """SELECT '{c}' AS variable, p.status AS exit_category, round(q1, 4) AS q1, round(median, 4) AS median,
             round(q3, 4) AS q3,
             CAST(min({c}) FILTER ({c} >= q1 - 1.5e0 * (q3 - q1) AND {c} <= q3 + 1.5e0 * (q3 - q1)) AS DOUBLE) AS whisker_low,
             CAST(max({c}) FILTER ({c} >= q1 - 1.5e0 * (q3 - q1) AND {c} <= q3 + 1.5e0 * (q3 - q1)) AS DOUBLE) AS whisker_high,
             count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS n_outliers
           FROM panel p JOIN (SELECT status, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
             quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
             FROM panel GROUP BY status) q ON p.status = q.status GROUP BY p.status, q1, median, q3""", BOXED)),
)
def box_stats(spark, sf_dir):
    src = exit_category(panel(spark, sf_dir, [*BOXED, "status"]))
    return ops.rounded(ops.box_stats(src, BOXED), 4, ["q1", "median", "q3"])


DESCRIBE = """SELECT {by}'{c}' AS variable, count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM {src}"""
DESCRIBE_ROUND = ["mean", "std", "q1", "median", "q3"]


@query("describe_numeric", on_panel(" UNION ALL ".join(DESCRIBE.format(by="", c=c, src="panel") for c in NUMBERS)))
def describe_numeric(spark, sf_dir):
    return ops.rounded(ops.describe_numeric(panel(spark, sf_dir, NUMBERS), NUMBERS), 4, DESCRIBE_ROUND)


@query(
    "extreme_salary_groups",
    on_panel(
        " UNION ALL ".join(DESCRIBE.format(by="grp, ", c=c, src="extremes GROUP BY grp") for c in NUMBERS),
        """cuts AS (SELECT quantile_cont(salary, 0.05) AS low, quantile_cont(salary, 0.95) AS high FROM panel),
extremes AS (SELECT *, CASE WHEN salary > high THEN 'high' ELSE 'low' END AS grp FROM panel, cuts
  WHERE salary > high OR salary < low)""",
    ),
)
def extreme_salary_groups(spark, sf_dir):
    return ops.rounded(ops.extreme_groups(panel(spark, sf_dir, NUMBERS), "salary", NUMBERS), 4, DESCRIBE_ROUND)


SCATTERED = ["age", "overtime", "salary", "satisfaction"]


@query(
    "scatter_pairs",
    on_panel(" UNION ALL ".join(
        f"""SELECT status, '{a}' AS column_x, '{b}' AS column_y, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y
          FROM panel""" for a, b in combinations(SCATTERED, 2)
    )),
)
def scatter_pairs(spark, sf_dir):
    return ops.scatter_pairs(panel(spark, sf_dir, [*SCATTERED, "status"]), SCATTERED, ["status"])
