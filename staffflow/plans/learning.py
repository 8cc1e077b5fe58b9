"""Queries that train, save, load and score models.

The training set and the fitted models of one input folder are kept for the
session, as a saved model would be: several queries look at the same models.
"""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from staffflow.operators import artefacts
from staffflow.operators import learning as ops
from staffflow.operators.clean import clean_panel, label_turnover
from staffflow.operators.filters import filter_year_range, latest_period_snapshot
from staffflow.operators.evaluation import best_model_name, fit_flags
from staffflow.operators.ranking import critical_employees, display, top_n_at_risk, top_per_model
from staffflow.plans.preparation import (
    KEY,
    LABELLED_SQL,
    DELIVERED,
    MODEL_CATEGORICAL,
    MODEL_INPUTS,
    delivered,
    labelled,
    training_inputs,
)
from staffflow.plans.registry import query
from staffflow.session import cut_lineage, new_path
from staffflow.sources import files
from staffflow.sources.tables import FULL_SHARE, now_sql, on_panel
from staffflow.streaming.uploads import UPLOADED

_SETS: dict[tuple[str, str], ops.TrainingSet] = {}
_MODELS: dict[tuple[str, str, str], object] = {}


def forget() -> None:
    """Drop the models kept for the session; the training set stays."""
    _MODELS.clear()


def _session(spark, sf_dir):
    """Session, folder and the state of the tables the panel is built from: new data gives new models."""
    listed = [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "nation", "region")]
    files = spark.read.format("binaryFile").load(listed).select("path", "modificationTime", "length")
    return spark.sparkContext.applicationId, sf_dir, tuple(sorted(tuple(r) for r in files.collect()))


def data(spark, sf_dir) -> ops.TrainingSet:
    key = _session(spark, sf_dir)
    if key not in _SETS:
        rows = training_inputs(labelled(spark, sf_dir))
        _SETS[key] = ops.training_set(rows, MODEL_INPUTS, MODEL_CATEGORICAL, KEY)
    return _SETS[key]


def model(spark, sf_dir, name: str):
    key = (*_session(spark, sf_dir), name)
    if key not in _MODELS:
        _MODELS[key] = ops.TRAINERS[name](data(spark, sf_dir))
    return _MODELS[key]


def artefact(spark, sf_dir, name: str = "logistic_regression"):
    return ops.as_artefact(data(spark, sf_dir), name, model(spark, sf_dir, name))


# rows of the test fold, as operators.preparation.hash_fold deals them
TESTED_SQL = [*LABELLED_SQL, "tested AS (SELECT * FROM labelled WHERE substr(md5(employee_id || '|' || year || '|' || month), 1, 4) >= 'cccc')"]
CHECKED_SQL = """count(*) AS n_rows, CAST(sum(turnover) AS BIGINT) AS n_positive, true AS in_bounds, true AS ranks_well FROM tested"""


def checked(metrics):
    """What holds for any well trained model: its cells add up, its measures are in range, it ranks well."""
    shares = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    within = F.lit(True)
    for c in shares:
        within &= F.col(c).between(0, 1)
    return metrics.select(
        "model", (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n_rows"),
        (F.col("tp") + F.col("fn")).alias("n_positive"), (within & (F.col("log_loss") >= 0)).alias("in_bounds"),
        (F.col("roc_auc") > 0.8).alias("ranks_well"),
    )


def evaluated(spark, sf_dir, name: str):
    """All metrics of one trained model."""
    return ops.evaluate(data(spark, sf_dir), {name: model(spark, sf_dir, name)}, KEY)


def metrics_query(key: str, name: str):
    @query(key, on_panel(f"SELECT '{name}' AS model, {CHECKED_SQL}", *TESTED_SQL))
    def build(spark, sf_dir):
        return checked(evaluated(spark, sf_dir, name))

    return build


metrics_query("train_logistic", "logistic_regression")
metrics_query("train_random_forest", "random_forest")
metrics_query("train_gbt_depthwise", "gbt_depthwise")
metrics_query("train_gbt_leafwise", "gbt_leafwise")
metrics_query("train_mlp", "neural_network")


@query(
    "train_selected",
    on_panel(f"""SELECT model, outcome, CASE WHEN model <> 'broken' THEN n_rows END AS n_rows,
      CASE WHEN model <> 'broken' THEN n_positive END AS n_positive, CASE WHEN model <> 'broken' THEN in_bounds END AS in_bounds,
      CASE WHEN model <> 'broken' THEN ranks_well END AS ranks_well
      FROM (VALUES ('logistic_regression', 'trained'), ('neural_network', 'trained'), ('broken', 'failed: ValueError'))
        AS v(model, outcome), (SELECT {CHECKED_SQL})""", *TESTED_SQL),
)
def train_selected(spark, sf_dir):
    """Two families and one that fails: metrics of the first two, the failure reported in its row."""

    def broken(_data):
        raise ValueError("no such family")

    trainers = {n: (lambda _d, n=n: model(spark, sf_dir, n)) for n in ("logistic_regression", "neural_network")}
    trainers["broken"] = broken
    models, failed = ops.train_selected(data(spark, sf_dir), list(trainers), trainers)
    report = spark.createDataFrame(
        [(n, "trained") for n in models] + [(n, f"failed: {why}") for n, why in failed.items()],
        "model string, outcome string",
    )
    return report.join(checked(ops.evaluate(data(spark, sf_dir), models, KEY)), "model", "left")


#: Families whose passes leave the session's settings alone, so that they can be trained at the same time.
TOGETHER = ("gbt_leafwise", "gbt_depthwise", "random_forest")


def all_models(spark, sf_dir):
    """Every family; those of trees at the same time, as the boosted ones keep few cores busy."""
    data(spark, sf_dir)
    for name in ops.TRAINERS:
        if name not in TOGETHER:
            model(spark, sf_dir, name)
    with ThreadPoolExecutor(len(TOGETHER)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(model), spark, sf_dir, name) for name in TOGETHER]
    for one in started:
        one.result()
    return {name: model(spark, sf_dir, name) for name in ops.TRAINERS}


def all_scores(spark, sf_dir):
    """The chance of leaving of every labelled row under every model."""
    coded = data(spark, sf_dir).encoder.transform(training_inputs(labelled(spark, sf_dir)))
    return ops.score_all_models(coded, all_models(spark, sf_dir), [*KEY, "turnover"])


@query(
    "score_all_models",
    on_panel("""SELECT model, turnover, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM labelled,
      (VALUES ('logistic_regression'), ('random_forest'), ('gbt_depthwise'), ('gbt_leafwise'), ('neural_network')) AS v(model)
      GROUP BY model, turnover""", *LABELLED_SQL),
)
def score_all_models(spark, sf_dir):
    """Rows scored per model and label, and how many scores are no percentage."""
    outside = F.count(F.when(~F.coalesce(F.col("churn_probability").between(0, 100), F.lit(False)), 1))
    return all_scores(spark, sf_dir).groupBy("model", "turnover").agg(F.count(F.lit(1)).alias("n_rows"), outside.alias("n_outside"))


def latest_scores(spark, sf_dir):
    """The people still there in the latest period, scored by every trained model."""
    rows = latest_period_snapshot(labelled(spark, sf_dir).withColumn("turnover", (F.col("status") == "Left").cast("int")), full_share=FULL_SHARE)
    coded = data(spark, sf_dir).encoder.transform(training_inputs(rows))
    return ops.score_all_models(coded, all_models(spark, sf_dir), [*KEY, "name", "position"])


STILL_SQL = f"""still AS (SELECT * FROM labelled WHERE status <> 'Left'
  AND year * 12 + month = {now_sql("labelled")})"""


@query(
    "critical_employees_trained",
    on_panel("""SELECT model, least(15, n) AS n_listed, true AS in_order, true AS all_there FROM
      (SELECT count(DISTINCT employee_id) AS n FROM still),
      (VALUES ('logistic_regression'), ('random_forest'), ('gbt_depthwise'), ('gbt_leafwise'), ('neural_network')) AS v(model)""",
      *LABELLED_SQL, STILL_SQL),
)
def critical_employees_trained(spark, sf_dir):
    """The lists of the people most at risk under every trained model: their length, order and members."""
    return listed(latest_scores(spark, sf_dir), critical_lists(spark, sf_dir), ["model"])


def critical_lists(spark, sf_dir):
    """The fifteen people most at risk under every trained model in the latest period."""
    return top_per_model(latest_scores(spark, sf_dir), threshold=-1.0)


def listed(scored, tops, by):
    """Per list: its length, whether nobody left out scores above it, whether all of it is in ``scored``."""
    lowest = tops.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_listed"), F.min("churn_probability").alias("lowest"), F.collect_set("employee_id").alias("ids")
    )
    both = scored.join(lowest, by) if by else scored.crossJoin(F.broadcast(lowest))
    inside = F.array_contains("ids", F.col("employee_id"))
    ordered = F.max(F.when(~inside, F.col("churn_probability")))
    members = F.count_distinct(F.when(inside, F.col("employee_id")))
    out = both.groupBy(*by, "n_listed", "lowest").agg(ordered.alias("next"), members.alias("members"))
    return out.select(
        *by, "n_listed", F.coalesce(F.col("next") <= F.col("lowest"), F.lit(True)).alias("in_order"),
        (F.col("members") == F.col("n_listed")).alias("all_there"),
    )


def best_of_all(spark, sf_dir) -> str:
    """The model that neither over- nor underfits with the best ROC-AUC; the best of all if none is fit."""
    metrics = cut_lineage(ops.evaluate(data(spark, sf_dir), all_models(spark, sf_dir), KEY))
    try:
        return best_model_name(metrics, fit_flags(metrics))
    except ValueError:
        return metrics.orderBy(F.desc("roc_auc"), "model").first()["model"]


@query(
    "best_model_ranking",
    on_panel("""SELECT least(15, count(DISTINCT employee_id)) AS n_listed, true AS in_order, true AS all_there FROM still""",
             *LABELLED_SQL, STILL_SQL),
)
def best_model_ranking(spark, sf_dir):
    """Train, evaluate, choose, rank: the list of the best model of all families."""
    scored = cut_lineage(latest_scores(spark, sf_dir).filter(F.col("model") == best_of_all(spark, sf_dir)))
    return listed(scored, top_per_model(scored, threshold=-1.0), [])


def unlike(coded, family: str, before, after):
    """Rows that both copies of a model score, those they score unlike, and scores that are no percentage."""
    scores = ops.score_all_models(coded, {"before": before, "after": after}, KEY)
    wide = scores.groupBy(*KEY).agg(*[F.max(F.when(F.col("model") == c, F.col("churn_probability"))).alias(c) for c in ("before", "after")])
    return wide.groupBy(F.lit(family).alias("model")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(~F.col("before").eqNullSafe(F.col("after")), 1)).alias("n_different"),
        F.count(F.when(~F.coalesce(F.col("after").between(0, 100), F.lit(False)), 1)).alias("n_outside"),
    )


@query(
    "save_load_pipeline",
    on_panel("""SELECT model, 'absent' AS first_time, 'loaded' AS second_time, 'incompatible' AS other_features, count(*) AS n_rows,
      CAST(0 AS BIGINT) AS n_different, CAST(0 AS BIGINT) AS n_outside FROM labelled,
      (VALUES ('logistic_regression'), ('random_forest'), ('gbt_depthwise'), ('gbt_leafwise'), ('neural_network')) AS v(model)
      GROUP BY model""", *LABELLED_SQL),
)
def save_load_pipeline(spark, sf_dir):
    """Every family saved where nothing was, found again, and refused for other features; rows its two copies score unlike."""
    names, report, counted = data(spark, sf_dir).names, [], None
    coded = cut_lineage(data(spark, sf_dir).encoder.transform(training_inputs(labelled(spark, sf_dir))).select(*KEY, "features"))

    def never():
        raise AssertionError("the saved model should have been loaded")

    for family in ops.TRAINERS:
        path = new_path(spark, "model")
        fresh, first = ops.load_or_train(path, names, lambda f=family: artefact(spark, sf_dir, f))
        loaded, second = ops.load_or_train(path, names, never)
        try:
            artefacts.load(spark, path, names[1:])
            third = "loaded"
        except artefacts.Incompatible:
            third = "incompatible"
        report.append((family, first, second, third))
        # the second copy of a model goes before the next family's is loaded
        found = cut_lineage(unlike(coded, family, fresh.model, loaded.model))
        counted = found if counted is None else counted.unionByName(found)
    return spark.createDataFrame(report, "model string, first_time string, second_time string, other_features string").join(counted, "model")


def score_rows(pipeline, rows, years: tuple[int, int] | None = None):
    """Typed upload rows to rows with their chance of leaving in percent, prepared as for training.

    All rows are scored, whatever their year; ``years``, a first and a last one, leaves out others.
    """
    if years is not None:
        rows = filter_year_range(rows, *years)
    scored = pipeline.transform(training_inputs(label_turnover(rows)))
    percent = (ops.probability("logistic_regression") * 100).alias("churn_probability")
    kept = [c for c in (UPLOADED,) if c in rows.columns]
    return scored.select(*KEY, "name", "position", F.col("age"), "status", "turnover", percent, *kept)


def write_upload(spark, sf_dir, path: str) -> None:
    """The raw panel as it would be delivered."""
    files.write_panel(delivered(spark, sf_dir).select(*DELIVERED), path, "csv")


def scored_upload(spark, sf_dir):
    """The rows of an uploaded file, cleaned and scored with the saved model."""
    upload, saved = new_path(spark, "upload"), new_path(spark, "model")
    write_upload(spark, sf_dir, upload)
    ops.save_pipeline(artefact(spark, sf_dir), saved)
    rows = clean_panel(files.scan_panel_csv(spark, upload))
    return score_rows(ops.load_pipeline(saved), rows)


def ranked_upload(spark, sf_dir):
    """The people most at risk in an uploaded file; the columns shown to the reader."""
    return display(top_n_at_risk(critical_employees(scored_upload(spark, sf_dir), 0.0)))


SCORED_SQL = """SELECT year, turnover, count(*) AS n_rows, CAST(count(DISTINCT employee_id * 12 + month) AS BIGINT) AS n_keys,
  CAST(0 AS BIGINT) AS n_outside FROM (SELECT *, CAST(status = 'Left' AS INTEGER) AS turnover FROM panel WHERE status <> 'Retired')
  GROUP BY year, turnover"""


def scored_counts(scored):
    """Rows, distinct employee-months and scores that are no percentage, per year and label."""
    outside = F.count(F.when(~F.coalesce(F.col("churn_probability").between(0, 100), F.lit(False)), 1))
    keys = F.count_distinct(F.col("employee_id") * 12 + F.col("month"))
    return scored.groupBy("year", "turnover").agg(F.count(F.lit(1)).alias("n_rows"), keys.alias("n_keys"), outside.alias("n_outside"))


@query("upload_score", on_panel(SCORED_SQL))
def upload_score(spark, sf_dir):
    return scored_counts(scored_upload(spark, sf_dir))
