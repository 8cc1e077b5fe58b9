"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def join_metrics_fit(metrics: DataFrame, fit: DataFrame) -> DataFrame:
    """One row per model on both sides."""
    return metrics.join(fit, "model")


def compare_models(tops: DataFrame, models: list[str]) -> DataFrame:
    """Score of every listed employee under each model, in how many models listed, match if more than one.

    A pivot over the long table replaces a chain of outer joins: one shuffle for any number of models.
    """
    wide = tops.groupBy("name", "employee_id").pivot("model", models).agg(F.max("churn_probability"))
    listed = sum((F.col(m).isNotNull().cast("int") for m in models), F.lit(0))
    return wide.select(
        "name",
        "employee_id",
        *[F.col(m).alias(f"churn_{m}") for m in models],
        listed.alias("frequency_in_models"),
        (listed > 1).alias("match"),
    )


def sort_by_name_id(df: DataFrame) -> DataFrame:
    return df.orderBy("name", "employee_id")


def parameter_table(spark: SparkSession, values: dict[str, object], key: str, value: str, kind: str) -> DataFrame:
    """A fixed dictionary as a table; its size is the literal's size."""
    return spark.createDataFrame(list(values.items()), f"{key} string, {value} {kind}")


def lookup_parameters(df: DataFrame, params: DataFrame, key: str, value: str, default: object) -> DataFrame:
    """Dictionary lookup with default. ``params`` is a small fixed table built by :func:`parameter_table`."""
    renamed = params.withColumnRenamed(key, "_key")
    out = df.join(F.broadcast(renamed), F.col(key) == F.col("_key"), "left").drop("_key")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def attach_scores_by_key(df: DataFrame, scored: DataFrame, keys: list[str]) -> DataFrame:
    """Put scores back on source rows by key, never by position."""
    return df.join(scored, keys, "left")


def model_overlap(flagged: DataFrame) -> DataFrame:
    """In how many models each employee is flagged; duplicates inside a model count once."""
    pairs = flagged.select("employee_id", "model").distinct()
    return pairs.groupBy("employee_id").agg(F.count(F.lit(1)).alias("n_models"))
