"""Queries of feature preparation, and the labelled training table the model queries share."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staffflow.operators import preparation as ops
from staffflow.operators.distributions import rounded
from staffflow.operators.oversampling import smote_balance
from staffflow.operators.rules import exit_risk_components
from staffflow.plans.registry import query
from staffflow.plans.rules import RISK_COLUMNS, RISK_SQL, staff
from staffflow.session import cut_lineage
from staffflow.sources.tables import STAFF_SQL, on_panel, panel

KEY = ["employee_id", "year", "month"]
NUMERIC = ["age", "salary", "overtime", "switching_readiness", "satisfaction"]
HIGH_RISK = 0.9  # a row at or above this exit risk is labelled as leaving: about one in ten

# The features the reference trains on, as far as the tables hold them.
MODEL_NUMERIC = [
    "year", "month", "age", "overtime", "absence_days", "salary", "satisfaction", "switching_readiness",
    "training_costs", "tenure",
]
MODEL_INPUTS = [f"x_{c}" for c in MODEL_NUMERIC]
MODEL_CATEGORICAL = [
    "position", "gender", "location", "work_model", "married", "children", "job_role_progression", "job_level",
]

LABELLED_SQL = [
    STAFF_SQL,
    RISK_SQL,
    f"labelled AS (SELECT *, CAST(exit_risk >= {HIGH_RISK} - 1e-9 AS INTEGER) AS turnover FROM risks WHERE status <> 'Retired')",
]


DELIVERED = [
    *KEY, "name", "status", "absence_reason", *[c for c in MODEL_NUMERIC if c not in KEY], *MODEL_CATEGORICAL,
]


def delivered(spark, sf_dir):
    """The raw rows an upload holds: everyone, all absence days with their reasons, mixed texts."""
    columns = [*RISK_COLUMNS, "gender", "location", "work_model", "children", "tenure", "absence_reason"]
    return staff(spark, sf_dir, columns)


def labelled(spark, sf_dir):
    """Raw rows of everyone not retired; the label is a high rule-based exit risk, which can be learned."""
    rows = exit_risk_components(delivered(spark, sf_dir).filter(F.col("status") != "Retired"))
    label = (F.col("exit_risk") >= HIGH_RISK - 1e-9).cast("int")
    return rows.select(*DELIVERED, label.alias("turnover"))


def training_inputs(rows):
    """The one preparation of raw rows for training and for scoring."""
    return ops.model_inputs(rows, MODEL_NUMERIC, MODEL_CATEGORICAL)


def features(spark, sf_dir):
    """Labelled rows with the fitted feature vector as an array."""
    inputs = cut_lineage(training_inputs(labelled(spark, sf_dir)))
    model = ops.fit_features(inputs, MODEL_INPUTS, MODEL_CATEGORICAL)
    out = model.transform(inputs)
    return cut_lineage(out.select(*KEY, "turnover", vector_to_array("features").alias("vector")))


def smote_rows(spark, sf_dir):
    return smote_balance(features(spark, sf_dir), "turnover", KEY)


@query(
    "standardise",
    on_panel("SELECT employee_id, year, month, "
             + ", ".join(f"round(({c} - (SELECT avg({c}) FROM panel)) / (SELECT stddev_pop({c}) FROM panel), 6) AS z_{c}"
                         for c in NUMERIC) + " FROM panel"),
)
def standardise(spark, sf_dir):
    out = ops.standardise(panel(spark, sf_dir, [*KEY, *NUMERIC]), NUMERIC)
    return rounded(out.drop(*NUMERIC), 6, [f"z_{c}" for c in NUMERIC])


DUMMIES = {
    "position": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "gender": ["Male"],
    "work_model": ["Homeoffice", "Part-time"],
    "absence_reason": ["Parental Leave", "Sabbatical", "nan", "none"],
}


@query(
    "one_hot_drop_first",
    on_panel("SELECT employee_id, year, month, " + ", ".join(
        f"CAST(coalesce({c}, 'nan') = '{v}' AS INTEGER) AS \"{c}_{v}\"" for c, vs in DUMMIES.items() for v in vs
    ) + " FROM panel"),
)
def one_hot_drop_first(spark, sf_dir):
    return ops.one_hot_drop_first(panel(spark, sf_dir, [*KEY, *DUMMIES]), list(DUMMIES))


FEATURE_SQL = " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, 0e0 AS mean, CAST(stddev_pop({c}) > 0 AS INTEGER) * 1e0 AS std FROM ill" for c in MODEL_NUMERIC]
    + [
        f"""SELECT '{c}_' || v, round(n / total, 6), round(sqrt(n / total * (1 - n / total)), 6) FROM (
        SELECT coalesce({c}, 'nan') AS v, count(*) * 1e0 AS n, sum(count(*)) OVER () AS total,
          row_number() OVER (ORDER BY coalesce({c}, 'nan')) AS rn FROM ill GROUP BY 1) WHERE rn > 1"""
        for c in MODEL_CATEGORICAL
    ]
)
ILL_SQL = "ill AS (SELECT * REPLACE (CASE WHEN absence_reason = 'Illness' THEN absence_days ELSE 0 END AS absence_days) FROM labelled)"


@query("feature_pipeline", on_panel(FEATURE_SQL, *LABELLED_SQL, ILL_SQL))
def feature_pipeline(spark, sf_dir):
    """Mean and spread of every fitted feature over all rows."""
    inputs = training_inputs(labelled(spark, sf_dir))
    model = ops.fit_features(inputs, MODEL_INPUTS, MODEL_CATEGORICAL)
    names = ops.feature_names(model, MODEL_NUMERIC, MODEL_CATEGORICAL)
    profile = ops.feature_profile(model.transform(inputs), names)
    # no negative zero
    return profile.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("mean", "std")})


@query(
    "smote_balance",
    on_panel("""SELECT turnover, greatest(count(*), (SELECT max(c) FROM (SELECT count(*) AS c FROM labelled GROUP BY turnover)))
      AS n_rows, CAST(0 AS BIGINT) AS n_off_segment FROM labelled GROUP BY turnover""", *LABELLED_SQL),
)
def smote(spark, sf_dir):
    """Class sizes after balancing, and how many synthetic rows lie off the segment they were drawn on."""
    between = F.forall(
        F.arrays_zip(F.col("vector").alias("v"), F.col("base_vector").alias("b"), F.col("neighbour_vector").alias("n")),
        lambda e: (e["v"] >= F.least(e["b"], e["n"]) - 1e-9) & (e["v"] <= F.greatest(e["b"], e["n"]) + 1e-9),
    )
    off = F.count(F.when(F.col("is_synthetic") & ~between, 1))
    return smote_rows(spark, sf_dir).groupBy("turnover").agg(F.count(F.lit(1)).alias("n_rows"), off.alias("n_off_segment"))


@query(
    "class_balance",
    on_panel("SELECT turnover, count(*) AS count FROM labelled GROUP BY turnover", *LABELLED_SQL),
)
def class_balance(spark, sf_dir):
    return ops.class_balance(labelled(spark, sf_dir), "turnover")


SPLIT_SQL = """SELECT employee_id, year, month, turnover, CASE WHEN rn <= floor(n * 0.8e0) THEN 'train' ELSE 'test' END AS fold
  FROM (SELECT *, count(*) OVER (PARTITION BY turnover) AS n, row_number() OVER (PARTITION BY turnover
    ORDER BY md5(employee_id || '|' || year || '|' || month), employee_id, year, month) AS rn FROM labelled)"""


@query("stratified_split", on_panel(SPLIT_SQL, *LABELLED_SQL))
def stratified_split(spark, sf_dir):
    return ops.stratified_split(labelled(spark, sf_dir).select(*KEY, "turnover"), "turnover", KEY)


@query(
    "align_features",
    on_panel("""SELECT employee_id, year, month, salary, CAST(0 AS DOUBLE) AS bonus, age,
      CAST(gender = 'Male' AS INTEGER) AS "gender_Male" FROM panel"""),
)
def align_features(spark, sf_dir):
    have = ops.one_hot_drop_first(panel(spark, sf_dir, [*KEY, "age", "salary", "tenure", "gender"]), ["gender"])
    return ops.align_features(have, ["salary", "bonus", "age", "gender_Male"], KEY)
