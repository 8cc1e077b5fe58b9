"""Feature preparation: scaling, dummies, splits, alignment."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.functions.ordered import hash_rank
from staffflow.operators.clean import sick_absence_only
from staffflow.operators.filters import drop_retired

MISSING = "nan"  # a missing category is a category of its own


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population std per column as ``z_*``; a constant column divides by one.

    Fitting is one aggregate that returns two numbers per column.
    """
    fitted = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    return df.withColumns(
        {
            f"z_{c}": (F.col(c).cast("double") - F.lit(fitted[f"m_{c}"])) / F.lit(fitted[f"s_{c}"] or 1.0)
            for c in columns
        }
    )


def _texts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in columns})


def _encoder_stages(columns: list[str]) -> list:
    index = [f"_i_{c}" for c in columns]
    # descending alphabet + dropped last = the alphabetically first category is the base
    return [
        StringIndexer(inputCols=columns, outputCols=index, stringOrderType="alphabetDesc", handleInvalid="error"),
        OneHotEncoder(inputCols=index, outputCols=[f"_v_{c}" for c in columns], dropLast=True),
    ]


def one_hot_drop_first(df: DataFrame, columns: list[str]) -> DataFrame:
    """Dummy columns ``column_value`` without the alphabetically first value; unknown values are errors later."""
    model = Pipeline(stages=_encoder_stages(columns)).fit(_texts(df, columns))
    coded = model.transform(_texts(df, columns))
    kept = [c for c in df.columns if c not in columns]
    dummies = []
    for c, labels in zip(columns, model.stages[0].labelsArray):
        values = vector_to_array(F.col(f"_v_{c}"))
        dummies += [values[i].cast("int").alias(f"{c}_{label}") for i, label in enumerate(labels[:-1])]
    return coded.select(*kept, *dummies)


def fit_features(df: DataFrame, numeric: list[str], categorical: list[str]) -> PipelineModel:
    """Fitted encoder, scaler and assembler as one reusable artefact; output column ``features``.

    Numbers are scaled by mean and population std, two numbers per column from one aggregate; a
    constant column divides by one. Dummies stay 0/1.
    """
    fitted = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in numeric], *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric]
    ).first()
    scaled = ", ".join(f"(`{c}` - ({fitted[f'm_{c}']!r}D)) / {fitted[f's_{c}'] or 1.0!r}D AS `_z_{c}`" for c in numeric)
    scaler = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    columns = [*[f"_z_{c}" for c in numeric], *[f"_v_{c}" for c in categorical]]
    everything = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")
    return Pipeline(stages=[*_encoder_stages(categorical), scaler, everything]).fit(df)


def model_inputs(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """What every model sees, in training and in scoring: nobody retired, absence days of illness only.

    Numbers come as ``x_*`` doubles beside the other columns, categories as texts without nulls.
    """
    rows = sick_absence_only(drop_retired(df))
    return prepare_inputs(rows.withColumns({f"x_{c}": F.col(c).cast("double") for c in numeric}), [], categorical)


def prepare_inputs(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Types the pipeline expects: doubles and texts without nulls."""
    return _texts(df, categorical).withColumns({c: F.col(c).cast("double") for c in numeric})


def feature_names(model: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    labels = model.stages[0].labelsArray
    return [*numeric, *[f"{c}_{label}" for c, kinds in zip(categorical, labels) for label in kinds[:-1]]]


def feature_profile(features: DataFrame, names: list[str]) -> DataFrame:
    """Mean and population std of every feature."""
    values = vector_to_array("features")
    aggs = [
        F.struct(F.lit(n).alias("feature"), F.avg(values[i]).alias("mean"), F.stddev_pop(values[i]).alias("std"))
        for i, n in enumerate(names)
    ]
    return features.agg(F.array(*aggs).alias("_a")).select(F.explode("_a").alias("_f")).select("_f.*")


def key_hash(keys: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def hash_fold(df: DataFrame, keys: list[str], train: float = 0.8) -> DataFrame:
    """Add ``fold``: stateless and stable, no shuffle; classes keep their shares in expectation."""
    edge = f"{int(train * 65536):04x}"
    return df.withColumn("fold", F.when(F.substring(key_hash(keys), 1, 4) < edge, "train").otherwise("test"))


def stratified_split(df: DataFrame, label: str, keys: list[str], train: float = 0.8) -> DataFrame:
    """Add ``fold`` with the exact share of every class: the first rows of each class in hash order train."""
    ranked = hash_rank(df, [label], keys, "_rank")
    last = F.floor(F.col("_size") * F.lit(train))
    return ranked.withColumn("fold", F.when(F.col("_rank") <= last, "train").otherwise("test")).drop("_rank", "_size")


def align_features(df: DataFrame, saved: list[str], keys: list[str], strict: bool = False) -> DataFrame:
    """The saved features in their order: missing ones are 0, extra ones go; strict refuses both."""
    have = [c for c in df.columns if c not in keys]
    if strict and sorted(have) != sorted(saved):
        raise ValueError("the table does not hold exactly the saved features")
    return df.select(*keys, *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in saved])


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
