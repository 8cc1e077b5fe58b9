"""Segments: fitting, assignment to given centres, profiles, silhouettes."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.operators.preparation import standardise


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def kmeans_segments(df: DataFrame, features: list[str], k: int = 3, seed: int = 42) -> tuple[DataFrame, list[list[float]]]:
    """Cluster the standardised features; clusters are numbered by their centres, smallest first."""
    scaled = standardise(df.na.drop(subset=features), features)
    inputs = VectorAssembler(inputCols=[f"z_{c}" for c in features], outputCol="_vector")
    ready = inputs.transform(scaled)
    model = KMeans(k=k, seed=seed, featuresCol="_vector", predictionCol="_raw").fit(ready)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    number = F.create_map(*[F.lit(x) for new, old in enumerate(order) for x in (old, new)])
    out = model.transform(ready).withColumn("cluster", number[F.col("_raw")]).drop("_raw", "_vector")
    return out, [centres[i] for i in order]


def group_centres(df: DataFrame, features: list[str], group: str, labels: list[str]) -> dict[str, list[float]]:
    """Mean of the features per listed group: one aggregate, one number per group and feature."""
    row = df.agg(
        *[F.avg(F.when(F.col(group) == g, F.col(c))).alias(f"{g}_{c}") for g in labels for c in features]
    ).first()
    return {g: [row[f"{g}_{c}"] for c in features] for g in labels}


def assign_to_centroids(df: DataFrame, features: list[str], centres: dict[str, list[float]]) -> DataFrame:
    """Add ``cluster``: the label of the nearest centre, the first label winning ties; and its squared distance."""
    gaps = {
        label: _total([(F.col(c) - m) * (F.col(c) - m) for c, m in zip(features, centre)])
        for label, centre in centres.items()
    }
    out = df.withColumns({f"_gap_{label}": gap for label, gap in gaps.items()})
    best = F.least(*[F.col(f"_gap_{label}") for label in gaps])
    pick = reduce(
        lambda chain, label: chain.when(F.col(f"_gap_{label}") == best, label),
        list(gaps)[1:],
        F.when(F.col(f"_gap_{next(iter(gaps))}") == best, next(iter(gaps))),
    )
    return out.withColumn("cluster", pick).withColumn("gap", best).drop(*[f"_gap_{label}" for label in gaps])


def cluster_profile(df: DataFrame, features: list[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(f"mean_{c}") for c in features]
    )


def silhouette_rows(df: DataFrame, features: list[str], labels: list, cluster: str = "cluster") -> DataFrame:
    """Add ``silhouette`` from squared Euclidean distances.

    The mean squared distance of a row to a cluster follows from the cluster's
    size, sum of vectors and sum of squared norms, so one aggregate replaces all pairs.
    """
    norm = _total([F.col(c) * F.col(c) for c in features])
    parts = []
    for i, g in enumerate(labels):
        member = F.col(cluster) == F.lit(g)
        parts.append(F.count(F.when(member, 1)).cast("double").alias(f"n{i}"))
        parts.append(F.sum(F.when(member, norm)).alias(f"q{i}"))
        parts += [F.sum(F.when(member, F.col(c))).alias(f"s{i}_{c}") for c in features]
    sums = df.agg(*parts).first()  # a few numbers per cluster
    out = df.withColumn("_norm", norm)
    present = [i for i in range(len(labels)) if sums[f"n{i}"] > 0]
    total = {
        i: F.col("_norm") * sums[f"n{i}"]
        + sums[f"q{i}"]
        - 2 * _total([F.col(c) * sums[f"s{i}_{c}"] for c in features])
        for i in present
    }
    mine = {i: F.col(cluster) == F.lit(labels[i]) for i in present}
    own = F.coalesce(
        F.lit(None).cast("double"), *[F.when(mine[i], total[i] / (sums[f"n{i}"] - 1)) for i in present if sums[f"n{i}"] > 1]
    )
    # the nearest other cluster
    none = F.lit(None).cast("double")
    other = F.least(none, none, *[F.when(~mine[i], total[i] / sums[f"n{i}"]) for i in present])
    out = out.withColumn("_a", own).withColumn("_b", other)
    top = F.greatest("_a", "_b")
    value = F.when(F.col("_a").isNull() | F.col("_b").isNull() | (top == 0), F.lit(0.0)).otherwise((F.col("_b") - F.col("_a")) / top)
    return out.withColumn("silhouette", value).drop("_norm", "_a", "_b")
