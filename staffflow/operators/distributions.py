"""The numbers behind distribution charts: moments, bins, densities, correlations, boxes."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.functions.ordered import join_groups, quantiles
from staffflow.schema import numeric_columns

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def melt(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Wide to long as doubles: (by, variable, value); nulls are left out."""
    by = by or []
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(by, columns, "variable", "value").filter(F.col("value").isNotNull())


def per_column(df: DataFrame, columns: list[str], by: list[str], stats: dict[str, object]) -> DataFrame:
    """One pass over the wide table, then one long row per group and column.

    ``stats`` maps a name to a function from a column to an aggregate, so no row
    is multiplied by the number of columns.
    """
    wide = df.groupBy(*by).agg(
        *[fn(F.col(c)).alias(f"_{n}_{i}") for i, c in enumerate(columns) for n, fn in stats.items()]
    )
    cells = [x for i, c in enumerate(columns) for x in (F.lit(c), *[F.col(f"_{n}_{i}") for n in stats])]
    return wide.select(*by, F.stack(F.lit(len(columns)), *cells).alias("variable", *stats))


def skew_kurtosis(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis; null below 3 and 4 values, 0 for a constant column."""
    columns = columns or numeric_columns(df)
    got = per_column(
        df,
        columns,
        [],
        {
            "n": lambda c: F.count(c),
            "g1": lambda c: F.skewness(c.cast("double")),
            "g2": lambda c: F.kurtosis(c.cast("double")),
        },
    )
    n = F.col("n").cast("double")
    flat = F.col("g2").isNull()
    skew = F.when(n > 2, F.when(flat, 0.0).otherwise(F.sqrt(n * (n - 1)) / (n - 2) * F.col("g1")))
    kurt = F.when(n > 3, F.when(flat, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)))
    return got.select("variable", skew.alias("skewness"), kurt.alias("kurtosis"))


def histogram_bins(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's minimum and maximum, the last closed on the right.

    A constant column gets a range of one around its value.
    """
    spans = per_column(
        df, columns, [], {"lo": lambda c: F.min(c.cast("double")), "hi": lambda c: F.max(c.cast("double"))}
    )
    flat = F.col("lo") == F.col("hi")
    spans = spans.select(
        "variable",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    cells = melt(df, columns).join(F.broadcast(spans), "variable")  # one row per column
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    return (
        cells.groupBy("variable", "lo", "hi", index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "variable",
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            "count",
        )
    )


def histogram_pct_by_status(df: DataFrame, column: str, width: float) -> DataFrame:
    """Share in percent of each fixed-width bin within its status."""
    bins = F.floor(F.col(column) / F.lit(float(width))).cast("int")
    counts = df.filter(F.col(column).isNotNull()).groupBy("status", bins.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    totals = df.filter(F.col(column).isNotNull()).groupBy("status").agg(F.count(F.lit(1)).alias("total"))
    return join_groups(counts, totals, ["status"]).select(
        "status",
        (F.col("bin") * F.lit(float(width))).alias("bin_start"),
        "count",
        (F.col("count") * 100.0 / F.col("total")).alias("percent"),
    )


def kde_grid(df: DataFrame, column: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density on a grid of ``points`` with Scott's bandwidth, every distinct value a kernel of its own."""
    clean = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n = F.col("n").cast("double")
    shape = clean.agg(
        F.count("v").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi")
    ).select(n.alias("n"), (F.col("sd") * F.pow(n, F.lit(-0.2))).alias("bw"), "lo", "hi")
    shape = shape.filter(F.col("bw") > 0)  # a constant column has no density
    shape = shape.withColumn("start", F.col("lo") - cut * F.col("bw"))
    shape = shape.withColumn("width", F.col("hi") - F.col("lo") + 2 * cut * F.col("bw"))
    return _density(clean, shape, points)


def _density(clean: DataFrame, shape: DataFrame, points: int) -> DataFrame:
    """Equal values share one kernel; every kernel adds to the grid points, which combine map-side."""
    weights = clean.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("w"))
    laid = weights.crossJoin(F.broadcast(shape)).select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.col("start") + F.col("i") * (F.col("width") / (points - 1))
    z = (x - F.col("v")) / F.col("bw")
    height = F.col("w") * F.exp(F.lit(-0.5) * z * z) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    return laid.groupBy("i").agg(F.first(x).alias("x"), F.sum(height).alias("density"))


def correlation_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of different numeric columns, missing values skipped pairwise."""
    columns = columns or numeric_columns(df)
    if len(columns) < 2:
        raise ValueError("the table has no pair of numeric columns to correlate")
    pairs = list(combinations(columns, 2))

    # corr() fails on a constant column under ANSI arithmetic; its square and its sign do not
    wide = df.agg(
        *[F.regr_r2(F.col(b).cast("double"), F.col(a).cast("double")).alias(f"_s{i}") for i, (a, b) in enumerate(pairs)],
        *[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)],
    )
    cells = [x for i, (a, b) in enumerate(pairs) for x in (F.lit(a), F.lit(b), F.col(f"_s{i}"), F.col(f"_c{i}"))]
    long = wide.select(F.stack(F.lit(len(pairs)), *cells).alias("a", "b", "square", "cov"))
    constant = (F.col("square") == 1) & (F.col("cov") == 0)
    half = long.select("a", "b", F.when(~constant, F.signum("cov") * F.sqrt("square")).alias("r"))
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("column_a"), F.col("b").alias("column_b"), "r"),
            F.struct(F.col("b").alias("column_a"), F.col("a").alias("column_b"), "r"),
        )
    )
    return half.select(both.alias("p")).select("p.column_a", "p.column_b", F.col("p.r").alias("correlation"))


def box_stats(df: DataFrame, columns: list[str], category: str = "exit_category") -> DataFrame:
    """Quartiles, whiskers at the outermost values within 1.5 interquartile ranges, outlier counts."""
    long = melt(df, columns, [category])
    keys = [category, "variable"]
    boxes = quantiles(long, keys, "value", QUARTILES)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    marked = join_groups(counts, F.broadcast(boxes), keys).withColumn(
        "inside", (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    )
    return marked.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(F.col("inside"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("inside"), F.col("value"))).alias("whisker_high"),
        F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("n_outliers"),
    )


def describe_numeric(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles and max per column, optionally per group."""
    by = by or []
    moments = per_column(
        df,
        columns,
        by,
        {
            "count": lambda c: F.count(c),
            "mean": lambda c: F.avg(c.cast("double")),
            "std": lambda c: F.stddev_samp(c.cast("double")),
            "min": lambda c: F.min(c.cast("double")),
            "max": lambda c: F.max(c.cast("double")),
        },
    )
    quarts = quantiles(melt(df, columns, by), [*by, "variable"], "value", QUARTILES)
    out = join_groups(moments, quarts, [*by, "variable"])
    return out.select(*by, "variable", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def extreme_groups(df: DataFrame, column: str, columns: list[str], low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Describe the rows strictly above the high and strictly below the low percentile."""
    cuts = quantiles(df.select(column), [], column, {"low": low, "high": high}).first()  # two numbers
    value = F.col(column)
    grp = F.when(value > F.lit(cuts["high"]), "high").when(value < F.lit(cuts["low"]), "low")
    return describe_numeric(df.withColumn("grp", grp).filter(F.col("grp").isNotNull()), columns, ["grp"])


def scatter_pairs(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """All points of every pair of columns: a projection without a shuffle, nothing sampled away."""
    by = by or []
    pairs = [
        F.struct(
            F.lit(a).alias("column_x"), F.lit(b).alias("column_y"),
            F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"),
        )
        for a, b in combinations(columns, 2)
    ]
    return df.select(*by, F.explode(F.array(*pairs)).alias("p")).select(*by, "p.*")


def rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


